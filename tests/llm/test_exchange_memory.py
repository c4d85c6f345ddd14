"""What an exchange of keys holds at a time in a Python worker, and that it gives the same blocks and sums."""

import tracemalloc

import numpy as np
import pyarrow as pa

from semlayer.llm import exchange as X
from semlayer.llm import ngram_jaccard as N
from semlayer.llm import words as W


class Captured:
    """Stands for a frame: keeps the function that it would be given to run."""

    def groupBy(self, *by):
        return self

    def applyInArrow(self, function, schema):
        self.function = function
        return self


def peak(function, *args):
    """The result, and the most bytes held meanwhile."""
    tracemalloc.start()
    try:
        result = function(*args)
        return result, tracemalloc.get_traced_memory()[1]
    finally:
        tracemalloc.stop()


def test_adding_up_a_bucket_holds_few_copies_of_its_keys():
    rng = np.random.default_rng(5)
    sent = [np.unique(rng.integers(0, 1 << 20, 6000, dtype=np.uint64)) for _ in range(120)]
    ones = [np.ones(len(keys), np.uint32) for keys in sent]
    table = pa.table(
        {
            "batch": pa.array(np.arange(len(sent))),
            "bucket": pa.array(np.zeros(len(sent), np.int64)),
            "keys": pa.array(map(X.packed_keys, sent), pa.binary()),
            "weights": pa.array(map(X.planes, ones), pa.binary()),
        }
    )
    frame = X.answers_of(Captured(), lambda total: total, np.uint32, np.uint64)
    answers, most = peak(frame.function, table)
    times = np.bincount(np.concatenate(sent).astype(np.int64))
    for keys, answer in zip(sent, answers["answers"].to_pylist()):
        assert X.unplanes(answer, np.uint64).tolist() == times[keys.astype(np.int64)].tolist()
    assert most < 5 * 8 * sum(map(len, sent))


def test_blocks_of_a_batch_hold_few_copies_of_its_keys():
    keys = np.unique(np.random.default_rng(6).integers(0, 1 << 64, 400_000, dtype=np.uint64))

    def extract(table):
        return X.distinct_sums(np.concatenate([keys, keys[::2]]), own=True)

    frame = X.blocks_of(Captured(), extract, 50, np.uint32)
    rows, most = peak(frame.function, pa.table({"batch": [7]}))
    back = [X.unpacked_keys(x) for x in rows["keys"].to_pylist()]
    assert rows["batch"].to_pylist() == [7] * 50 and rows["bucket"].to_pylist() == list(range(50))
    assert np.concatenate(back).tolist() == keys.tolist()
    weights = np.concatenate([X.unplanes(x, np.uint32) for x in rows["weights"].to_pylist()])
    assert weights.tolist() == [2, 1] * (len(keys) // 2) + [2] * (len(keys) % 2)
    assert most < 5.5 * keys.nbytes


def test_distinct_sums_leaves_keys_of_others_alone():
    keys = np.array([3, 1, 3, 2], np.uint64)
    for own in (False, True):
        mine = keys.copy()
        distinct, count = X.distinct_sums(mine, own=own)
        assert (distinct.tolist(), count.tolist()) == ([1, 2, 3], [1, 1, 2])
        assert own or mine.tolist() == keys.tolist()


def test_sets_of_classes_hold_the_words_of_one_slice():
    rng = np.random.default_rng(7)
    texts = [" ".join(f"w{n}" for n in rng.integers(0, 5000, 800)) for _ in range(500)]
    code = np.array(N.set_codes(N.shingle_sets(W.texts_of(pa.array(texts), lower=True), 5)), np.int64)
    order = [*range(500), 3, 499, 0]
    table = pa.table({"class": code[order], "text": [texts[i] for i in order]})
    sets, most = peak(N.sets_of_classes, table, 5)
    assert list(sets) == code.tolist()
    for i in range(0, 500, 50):
        assert sets[code[i]].tolist() == N.shingle_sets(W.texts_of(pa.array([texts[i]]), lower=True), 5)[0].tolist()
    whole = sum(own.nbytes for own in sets.values())
    assert most - whole < 16 * X.MB
