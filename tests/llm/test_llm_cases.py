"""Odd inputs, and what each operator does beyond its registered query."""

import random

import numpy as np
import pyarrow as pa
import pytest
from conftest import *  # noqa: F403

from semlayer.llm.components import components
from semlayer.llm.context_tree import score_texts
from semlayer.llm.decontamination import contamination
from semlayer.llm.kneser_ney import score_toxicity, train
from semlayer.llm.licenses import full_text, license_scan, sampled_paragraphs
from semlayer.llm.merkle import differing_paragraphs, fingerprint, fingerprints_of_edits, likeness
from semlayer.llm.ngram_jaccard import near_duplicates, parity_bits
from semlayer.llm.packing import hilbert_keys, packed
from semlayer.llm.pii import base_spans, instances, masked, personal_data
from semlayer.llm.queries import tokenizer_path
from semlayer.llm.substring_dedup import remove_repeated_windows
from semlayer.llm.token_counts import token_counts


def toxicity(docs):
    rows = [(f"you idiot number{i} scum", 1) for i in range(40)] + [(f"a fine day number{i} here", 0) for i in range(80)]
    return score_toxicity(docs, train(docs.sparkSession.createDataFrame(rows, "text string, toxic int")))


def decontaminated(docs):
    items = [(1, "a b c"), (2, None), (3, ""), (None, "one")]
    return contamination(docs, docs.sparkSession.createDataFrame(items, "item_id bigint, text string"))


OPERATORS = {
    "pii": personal_data,
    "substrings": remove_repeated_windows,
    "near": near_duplicates,
    "licenses": license_scan,
    "scores": lambda docs: score_texts(docs.selectExpr("*", "doc_id % 2 = 0 AS train")),
    "tokens": lambda docs: token_counts(docs, tokenizer_path("piece_bpe_32k.model")),
    "decontamination": decontaminated,
    "toxicity": toxicity,
    "merkle": fingerprints_of_edits,
}


@pytest.mark.parametrize("name", sorted(OPERATORS))
def test_odd_rows_each_give_one_row(odd, nothing, name):
    rows = OPERATORS[name](odd).collect()
    assert sorted((row.doc_id for row in rows), key=repr) == sorted((1, 2, 3, 4, 4, 5, 6, None, 7), key=repr)
    assert OPERATORS[name](nothing).collect() == []


def test_packing_of_odd_rows(odd, nothing):
    pieces = packed(odd, tokenizer_path()).collect()
    assert sum(row.length for row in pieces) == sum(row.doc_tokens for row in pieces if row.start == 0)
    assert {row.doc_tokens for row in pieces if row.doc_id in (1, 2, 3)} == {1}
    assert packed(nothing, tokenizer_path()).collect() == []


def test_copies_and_repeated_rows_share_a_component(odd):
    found = {row.doc_id: row for row in near_duplicates(odd).collect()}
    assert found[6].component_id == found[5].component_id == 5
    assert [found[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    removed = {row.doc_id: row for row in remove_repeated_windows(odd).collect()}
    assert removed[5].n_removed == 30_000 and len(removed[5].removed) == 1


@pytest.mark.parametrize("seed", range(3))
def test_near_duplicates_against_all_pairs(spark, documents, seed):
    random.seed(seed)
    base = [[f"t{random.randrange(40)}" for _ in range(random.randrange(1, 60))] for _ in range(12)]
    rows = []
    for i in range(150):
        words = list(random.choice(base))
        for _ in range(random.randrange(0, 4)):
            words[random.randrange(len(words))] = f"t{random.randrange(60)}"
        rows.append((i, " ".join(words)))
    sets = {}
    for i, text in rows:
        w = text.split()
        sets[i] = {tuple(w[k : k + 5]) for k in range(max(1, len(w) - 4))}
    root = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                both = len(sets[a] & sets[b])
                if 100 * both >= 75 * (len(sets[a]) + len(sets[b]) - both) and root[a] != root[b]:
                    root[a] = root[b] = min(root[a], root[b])
                    changed = True
    found = {row.doc_id: row.component_id for row in near_duplicates(documents(rows)).collect()}
    assert found == root


def test_components(spark):
    edges = [(i, i + 1) for i in range(1, 20)] + [(100, 101), (102, 101), (5, 5)]
    found = dict(map(tuple, components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()))
    assert found == {i: 1 for i in range(1, 21)} | {100: 100, 101: 100, 102: 100}


def test_patterns_discover_unseen_identifiers(documents):
    rows = [(i, f"intro text {i} please call me: +1 ({100 + i}) 555-{2000 + i} soon") for i in range(30)]
    rows += [(900, "then please call me: +1 (999) 555-12 now"), (901, "order 4711-22 of 1999-12-31")]
    found = {row.doc_id: row for row in personal_data(documents(rows)).collect()}
    assert all(found[i].n_phone == 1 for i in range(30))
    text = "my mail is a.b@c.de, card 4111 1111 1111 1111 at 10.0.0.1"
    (row,) = personal_data(documents([(1, text)])).collect()
    assert masked(text, row.spans) == "my mail is <email>, card <card> at <ip>"
    mails = [(i, f"staff id: user{i}@corp{i}.example and so on") for i in range(20)] + [(99, "staff id: user77@intranet and so on")]
    found = {row.doc_id: row for row in personal_data(documents(mails)).collect()}
    assert (found[99].n_email, found[99].spans) == (0, "email:10:25")


def test_benchmark_blocks_give_what_one_gives(spark, documents):
    docs = documents([(i, " ".join(f"u{(i * 7 + k) % 90}" for k in range(60))) for i in range(40)])
    items = spark.createDataFrame(
        [(i, " ".join(f"u{(i * 11 + k) % 90}" for k in range(25))) for i in range(30)], "item_id bigint, text string"
    )
    one = sorted(map(str, contamination(docs, items).collect()))
    assert one == sorted(map(str, contamination(docs, items, most_bytes=600).collect()))


def test_tree_locates_edits():
    lines = [f"line {i} with some words of its own {i * i}" for i in range(60)]
    changed = [*lines[:30], "something else", *lines[31:]]
    a, b = fingerprint("\n".join(lines)), fingerprint("\n".join(changed))
    assert differing_paragraphs(a, b) == [30] and differing_paragraphs(a, a) == []
    assert 0.9 < likeness(a, b) < 1 and likeness(a, a) == 1 and likeness(a, fingerprint("no such words")) == 0


def test_hilbert_neighbours_are_adjacent_cells():
    import numpy as np

    cells = np.array([(x, y, z) for x in range(8) for y in range(8) for z in range(8)])
    order = np.argsort(hilbert_keys(cells, 3))
    assert sorted(hilbert_keys(cells, 3)) == list(range(512))
    assert set(np.abs(np.diff(cells[order], axis=0)).sum(axis=1)) == {1}


def test_byte_probabilities_sum_to_one():
    import numpy as np

    from semlayer.llm import context_tree as C

    parts = [b"abracadabra abracadabra\n", b"\xc3\xa9t\xc3\xa9 abra\n"]
    keys, counts = C.batch_sums(parts, [True, True])
    levels = C.tree(keys, counts, 0)
    stops = [C.stops(levels[d], d == C.DEPTH) for d in range(C.DEPTH + 1)]
    for context in (keys[3], keys[10], np.uint64(0x7A7A7A7A7A00)):
        every = (context & ~np.uint64(255)) | np.arange(256, dtype=np.uint64)
        assert (10 ** C.log_probabilities(every, stops)).sum() == pytest.approx(1.0)


def test_parities_differ_in_no_more_cells_than_sets_differ_in_codes():
    draw = np.random.default_rng(3)
    for size in (1, 5, 130, 3000):
        a = np.unique(draw.integers(0, 1 << 62, size, dtype=np.uint64))
        b = np.unique(np.concatenate((a[len(a) // 3 :], draw.integers(0, 1 << 62, size // 2, dtype=np.uint64))))
        apart = sum(((x ^ y) % (1 << 64)).bit_count() for x, y in zip(parity_bits(a), parity_bits(b)))
        assert apart <= len(np.setxor1d(a, b))
        assert parity_bits(a) == parity_bits(a[::-1])


def test_distinct_words_count_beyond_a_word_that_fills_the_text():
    from semlayer.llm import kneser_ney as N
    from semlayer.llm import words as W

    codes = [int(N.tokens_of(W.texts_of(pa.array([w]), lower=True)).code[0]) for w in ("best", "second", "third", "fourth")]
    order = np.argsort(np.array(codes, np.uint64))
    single = np.array([4.0, 3.0, 2.0, 1.0])
    none = np.zeros(0, np.uint64)
    model = N.Model(np.array(codes, np.uint64)[order], single[order], none, np.zeros(0), -1.0, (0.0, 1.0, 0.0, 0.0, 0.0))
    texts = ["best " * 300 + "second third fourth", "", "third best", "best second third fourth"]
    seen = N.evidence(model, W.texts_of(pa.array(texts), lower=True))
    assert seen[:, :3].tolist() == [[4.0, 3.5, 2.5], [0, 0, 0], [4.0, 3.0, 1.5], [4.0, 3.5, 2.5]]
    assert seen[0, 3] == pytest.approx((300 * 4 + 6) / 303)


def test_instances_are_runs_of_digit_groups_and_tokens():
    def forms(text):
        return [one["form"] for one in instances(text, base_spans(text)) if one["kind"] is None]

    assert forms("jane@intranet called (415) 555 0137, then 020 7946 0958.") == ["(415) 555 0137", "020 7946 0958", "jane@intranet"]
    assert forms("card 4111 1111 1111 1112 (see 12)") == ["4111 1111 1111 1112", "12"]
    assert forms("in 1999. 20 of id77-8 and 10.0.0.1 8080") == ["1999", "20", "8", "id77-8", "8080"]
    assert forms("x" * 90 + "@" + "y" * 90) == ["x" * 90 + "@" + "y" * 90]
    word = "w" * 60
    assert instances(f"{word} {word} 4711", [])[0]["patterns"] == [f"{word}\t9", f"{word} {word}\t9"]


def test_unseen_forms_of_seeds_are_discovered(documents):
    rows = [(i, f"intro text {i} please call me: +1 ({100 + i}) 555-{2000 + i} soon") for i in range(40)]
    rows += [(900, "then please call me: +1 (999) 555-12 now"), (901, "order 4711-22 of 1999-12-31")]
    rows += [(902, "so please call me: (415) 555 0137 or"), (903, "so please call me: 020 7946 0958.")]
    found = {row.doc_id: row for row in personal_data(documents(rows)).collect()}
    assert (found[900].n_phone, found[900].spans, found[901].spans) == (0, "phone:21:36", "")
    assert (found[902].spans, found[903].spans) == ("phone:19:33", "phone:19:32")


def test_rounds_go_on_until_nothing_is_added(documents):
    names, sizes = ["zero", "one", "two", "three", "four"], [160, 64, 26, 10, 4]
    rows = [(i, f"chain zero: +1 ({100 + i}) 555-{2000 + i} end") for i in range(400)]
    for k, n in enumerate(sizes):
        for i in range(n):
            rows += [(1000 * k + 1000 + i, f"chain {name}: 77 {k:03} {i:03} end") for name in names[k : k + 2]]
    found = personal_data(documents(rows))
    spans = {row.doc_id: row.spans for row in found.where("doc_id >= 5000").collect()}
    assert len(spans) == 4 and all(s.startswith("phone:") for s in spans.values())


def test_licences_in_prose_identifiers_and_full_texts(documents):
    prose = "the garden was quiet in the morning and nobody came down to the river before the bells had rung"
    mit = full_text("mit")
    cases = [
        ("SPDX-License-Identifier: MIT", {"mit"}),
        ("An MIT-licensed tool for gardens", {"mit"}),
        (f"{prose} Released under the MIT License. {prose} {prose}", {"mit"}),
        (max(mit, key=len), {"mit"}),
        (next(line for line in mit if line.startswith("to use, copy, modify")), {"mit"}),
        (f"{prose} SPDX-License-Identifier: Apache-2.0 {prose}", {"apache-2.0"}),
        (f"Licensed under CC BY-NC 4.0. {prose} {prose}", {"cc-by-nc-4.0"}),
        (f"MIT License for the code, {prose}, and Licensed under CC BY 4.0. for the text", {"mit", "cc-by-4.0"}),
        (prose, set()),
        ("", set()),
    ]
    filler = [f"{prose} {i} {' '.join(f'word{(i * k) % 97}' for k in range(1, 9))}" for i in range(300)]
    rows = [(i, text) for i, (text, _) in enumerate(cases)] + [(1000, "\n".join(filler))]
    found = {row.doc_id: row for row in license_scan(documents(rows)).collect()}
    for i, (text, families) in enumerate(cases):
        assert {x.family for x in found[i].found} - {"unknown"} == families, (text, found[i])
        assert found[i].n_license == min(len(families), 1)
    assert found[1000].n_license == 0


def test_negatives_are_distinct(documents):
    rows = [(i, "one line that is everywhere\n" * 30 + f"line number {i} of its own") for i in range(50)]
    lines = sampled_paragraphs(documents(rows), 20)
    assert len(lines) == len(set(lines)) == 20


def test_edits_are_located_in_the_result(documents):
    lines = [f"line {i} with some words of its own {i * i}" for i in range(60)]
    twice = "\n".join(["same line"] * 3 + lines)
    once = "\n".join(["same line"] * 2 + lines)
    assert differing_paragraphs(fingerprint(twice), fingerprint(once)) == [2]
    found = {row.doc_id: row for row in fingerprints_of_edits(documents([(2, "\n".join(lines)), (1, "x" * 3000)])).collect()}
    text = "\n".join(lines)
    same = text[: len(text) - len(text) // 3].count("\n")
    assert found[2].differing == list(range(same, 60))
    assert fingerprints_of_edits(documents([(1, "a")])).first().differing == []
