"""Near copies in bounded slices, ids from distinct words."""

import random
import sys

import numpy as np
import pyarrow as pa

from semlayer.llm import ngram_jaccard, packing
from semlayer.llm.queries import tokenizer_path


class Called:
    """Stands for a DataFrame: keeps the function that would run in tasks."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_sets_of_a_large_batch_are_made_in_slices(monkeypatch):
    texts = [" ".join(f"w{i % 7}x{k}" for k in range(100)) for i in range(12_000)] + [None, "", "one"]
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    whole = ngram_jaccard.shingle_sets(ngram_jaccard.W.texts_of(batch["text"], lower=True), 5)
    sizes, made = [], ngram_jaccard.shingle_sets

    def measured(found, shingle):
        sizes.append(len(found.data))
        return made(found, shingle)

    monkeypatch.setattr(ngram_jaccard, "shingle_sets", measured)
    called = ngram_jaccard.members_of(Called())
    rows = [row for out in called.run(iter([batch])) for row in out.to_pylist()]
    assert sum(sizes) == sum(len(t or "") for t in texts) > 6 << 20 and max(sizes) <= 2 << 20
    assert [row["doc_id"] for row in rows] == list(range(len(texts)))
    assert [row["n_shingles"] for row in rows] == [len(s) for s in whole]
    assert [row["class"] for row in rows] == [ngram_jaccard.set_code(s) if len(s) else None for s in whole]


def test_a_word_is_split_once(monkeypatch):
    split, scanned = packing.UNITS, []

    class Counted:
        def findall(self, text):
            scanned.append(len(text))
            return split.findall(text)

    monkeypatch.setattr(packing, "UNITS", Counted())
    texts = ["Zzyzxq's  qwvkx, 12!" * 3 + " qwvkx,\n" * 5000, "qwvkx, " * 4000, ""]
    encoder = packing.UnitEncoder(tokenizer_path())
    found = encoder.encode(texts)
    assert sum(scanned) < 200
    for text, ids in zip(texts, found):
        expected = encoder.tokenizer.encode(text, add_special_tokens=False).ids
        assert np.frombuffer(ids, "<u4").tolist() == [*expected, packing.END]


def test_ids_of_odd_characters_and_forgotten_words(monkeypatch):
    dice = random.Random(3)
    letters = [*"abcXYZ stsre'vml d  \t\n\x0b\x0c\r\x1c\x1f\x85\xa0019<|>!?.,-_\0", *"ĊĠÉéß²¼ªİΣς日本ÿŸﬁ😀", "\u0301", "e\u0301", "\u2003"]
    letters += ["<|endoftext|>", "<|startoftext|>", "<|x", "'LL", "'Re"]
    texts = ["".join(dice.choice(letters) for _ in range(dice.randrange(40))) for _ in range(3000)]
    monkeypatch.setattr(packing, "REMEMBERED_BYTES", 4000)
    state = sys.modules.get("semlayer_worker_state")
    if state is not None:
        monkeypatch.setattr(state, "units", {}, raising=False)
    encoder = packing.UnitEncoder(tokenizer_path())
    found = [ids for low in range(0, len(texts), 100) for ids in encoder.encode(texts[low : low + 100])]
    again = encoder.encode(texts[:50])
    assert again == found[:50] and encoder.by_units
    for text, ids in zip(texts, found):
        assert np.frombuffer(ids, "<u4").tolist() == [*encoder.tokenizer.encode(text, add_special_tokens=False).ids, packing.END]
