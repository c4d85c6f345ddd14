"""Hashes without built-in collisions, tokenizers other than the one that units suit, bounded slices of batches."""

import numpy as np
import pyarrow as pa
import pytest

from semlayer.llm import decontamination, exchange, ngram_jaccard, packing, substring_dedup
from semlayer.llm import words as W
from semlayer.llm.queries import tokenizer_path


def thue_morse(n, zero, one):
    """Two sequences of n letters that every polynomial modulo a power of two takes for one, from n = 1,024."""
    bits = [bin(i).count("1") % 2 for i in range(n)]
    return [(one if b else zero) for b in bits], [(zero if b else one) for b in bits]


@pytest.mark.parametrize("n", [1024, 2048, 4096])
def test_thue_morse_words_differ(n):
    a, b = ("".join(s) for s in thue_morse(n, "a", "b"))
    one, other = W.words_of(W.texts_of(pa.array([a, b]), lower=False)).code
    assert one != other
    code = W.words_of(W.texts_of(pa.array([" ".join(s) for s in thue_morse(n, "x", "y")]), lower=False)).code
    assert W.whole_code(code[:n]) != W.whole_code(code[n:])


def test_runs_are_equal_wherever_they_start():
    dice = np.random.default_rng(1)
    code = dice.integers(0, 1 << 64, 5000, dtype=np.uint64)
    code = np.concatenate((code, code[100:400], code[4000:]))
    found = W.sequence_codes(code, 100)
    assert (found[5000:5200] == found[100:300]).all() and len(np.unique(found)) == len(found) - 201 - 901
    assert [int(x) for x in W.remainder(np.array([0, W.PRIME - 1, W.PRIME, (1 << 62) + 5, (1 << 64) - 1], np.uint64))] == [
        x % W.PRIME for x in (0, W.PRIME - 1, W.PRIME, (1 << 62) + 5, (1 << 64) - 1)
    ]


@pytest.mark.parametrize("n", [1024, 4096])
def test_operators_tell_thue_morse_words_apart(spark, documents, n):
    a, b = ("".join(s) for s in thue_morse(n, "a", "b"))
    tail = " ".join(f"w{i}" for i in range(34))
    table = documents([(1, f"{a} {tail}"), (2, f"{b} {tail}")])
    removed = substring_dedup.remove_repeated_windows(table).collect()
    assert [row.n_removed for row in removed] == [0, 0]
    short = documents([(1, a), (2, b)])
    near = {row.doc_id: row.component_id for row in ngram_jaccard.near_duplicates(short).collect()}
    assert near == {1: 1, 2: 2}
    items = spark.createDataFrame([(7, a)], "item_id bigint, text string")
    found = {row.doc_id: row.contaminated for row in decontamination.contamination(short, items).collect()}
    assert found == {1: True, 2: False}


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_tokenizer_in_any_order(name):
    from tokenizers import Tokenizer

    texts = ["hello world", "Hello  WORLD it's 12 <|endoftext|> ok", "", "ünïcode ßtraße 日本語 x²", "a\r\n\tb" * 50]
    for path in (tokenizer_path("word_bpe_49k.json"), tokenizer_path(name), tokenizer_path("word_bpe_49k.json")):
        tokenizer = Tokenizer.from_file(path)
        found = packing.UnitEncoder(path).encode(texts)
        for text, ids in zip(texts, found):
            expected = [*tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
            assert np.frombuffer(ids, "<u4").tolist() == expected
    assert packing.UnitEncoder(tokenizer_path(name)).by_units == name.startswith("word")


def test_slices_cover_a_batch_and_are_bounded():
    texts = ["x" * n for n in (0, 10, 5000, 3, 3, 3)] + [None, "y" * 9000, ""]
    batch = pa.record_batch({"text": pa.array(texts), "n": pa.array(range(len(texts)))})
    parts = list(exchange.text_slices(batch, most=4000))
    assert [n for part in parts for n in part["n"].to_pylist()] == list(range(len(texts)))
    assert all(part.num_rows == 1 or sum(len(t or "") for t in part["text"].to_pylist()) <= 4000 for part in parts)
    assert list(exchange.text_slices(batch.slice(0, 0))) == []


def test_a_training_sample_is_bounded_and_by_text(spark, tmp_path):
    from semlayer.llm.queries import labelled

    docs = spark.createDataFrame([(i, f"text {i % 50}", i, "clash") for i in range(400)], "doc_id bigint, text string, size int, code string")
    labels = spark.createDataFrame([(i, int(i % 50 == 7), 1) for i in range(400)], "doc_id bigint, toxic int, size int")
    labels.write.parquet(str(tmp_path / "labels.parquet"))
    rows = labelled(spark, docs, str(tmp_path)).distinct().collect()
    assert {row.text for row in rows} == {f"text {i}" for i in range(50)}
    assert {row.text for row in rows if row.toxic} == {"text 7"}


def test_decontamination_of_equal_words_short_and_repeated_items(spark):
    """Windows that many items share count once; every occurrence in a long text of one word is verified."""
    dice = np.random.default_rng(7)
    texts = ["a " * 20_000, None, "", "B c", *(" ".join(dice.choice(list("abc"), dice.integers(0, 40))) for _ in range(60))]
    items = ["a " * 200, "a " * 190, "b c", "c", None, "", *(" ".join(dice.choice(list("abc"), dice.integers(1, 14))) for _ in range(25))]
    items.append(items[0])
    docs = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id bigint, text string")
    bench = spark.createDataFrame([(i % 30, t) for i, t in enumerate(items)], "item_id bigint, text string")
    windows = {}
    for i, text in enumerate(items):
        own = (text or "").lower().split()
        size = min(10, len(own))
        for k in range(len(own) - size + 1 if size else 0):
            windows.setdefault(tuple(own[k : k + size]), set()).add(str(i % 30))
    for most_bytes in (1 << 24, 900):
        found = {row.doc_id: row for row in decontamination.contamination(docs, bench, most_bytes=most_bytes).collect()}
        for doc_id, text in enumerate(texts):
            own, hit, which = (text or "").lower().split(), set(), set()
            for size in {len(w) for w in windows}:
                for k in range(len(own) - size + 1):
                    if (w := tuple(own[k : k + size])) in windows:
                        hit.update(range(k, k + size))
                        which |= windows[w]
            row = found[doc_id]
            assert (row.n_words, row.n_hit, row.items) == (len(own), len(hit), sorted(which))
            assert sum(s.end - s.start for s in row.spans) == len(hit)


def test_verification_takes_a_window_once(spark):
    found = decontamination.item_words(["a " * 200])
    groups = decontamination.item_windows(found, 10)
    keys = np.unique(decontamination.shingles_at(found, groups[0], slice(None)))
    index = decontamination.built(found, groups, ["one"], keys, np.ones(len(keys), np.int64))
    text = W.words_of(W.texts_of(pa.array(["a " * 4000]), lower=True), W.NOT_ALNUM_TABLE)
    start, window = decontamination.verified_windows(index, text, [3])
    assert len(index.code) == 1 and start.tolist() == list(range(3991)) and not window.any()
