"""Sets of shingles: their values, and array work that does not grow by a call for each text."""

import random

import numpy as np
import pyarrow as pa

from semlayer.llm import ngram_jaccard as N


class Called:
    """Stands for a DataFrame: keeps the function that would run in tasks."""

    def mapInArrow(self, run, schema):
        self.run = run
        return self


def test_sets_are_sorted_distinct_shingles_and_coded_together(monkeypatch):
    dice = random.Random(6)
    texts = [" ".join(dice.choices("abc", k=dice.randint(0, 40))) for _ in range(500)] + [None, "", "a", "a b c d e"] + ["a " * 30] * 2
    sets = N.shingle_sets(N.W.texts_of(pa.array(texts), lower=True), 5)
    numbers = {}
    for text, own in zip(texts, sets):
        words = (text or "").split()
        runs = {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, min(len(words), 1)))}
        assert len(own) == len(runs) and (own[1:] > own[:-1]).all()
        numbers.setdefault(frozenset(runs), set()).add(tuple(own.tolist()))
    assert all(len(own) == 1 for own in numbers.values()) and len({next(iter(own)) for own in numbers.values()}) == len(numbers)

    calls, mixed, unique = [], N.W.mixed, np.unique
    monkeypatch.setattr(N.W, "mixed", lambda x: calls.append(len(x)) or mixed(x))
    monkeypatch.setattr(N.np, "unique", lambda *a, **k: calls.append(0) or unique(*a, **k))
    batch = pa.record_batch({"doc_id": pa.array(range(len(texts))), "text": pa.array(texts)})
    rows = [row for out in N.members_of(Called()).run(iter([batch])) for row in out.to_pylist()]
    assert [row["n_shingles"] for row in rows] == [len(s) for s in sets]
    short = sum(0 < len((t or "").split()) < 5 for t in texts)
    assert len(calls) - short < 10
    monkeypatch.undo()
    assert [row["class"] for row in rows] == [N.set_code(s) if len(s) else None for s in sets]
    classes = {row["class"] for row in rows if row["class"] is not None}
    assert len(classes) == len(numbers) - 1


def test_a_prefix_is_that_of_least_cost():
    dice = np.random.default_rng(8)
    for n in (1, 2, 3, 7, 8, 9, 200):
        for percent in (1, 75, 100):
            frequency = np.sort(dice.integers(1, 50, n).astype(np.uint64))
            need = N.required(n, percent)
            lengths = [min(n, n - need + m) for m in range(1, N.MOST_MATCHES + 1)]
            cost = [sum(int(f) - 1 for f in frequency[:k]) * (1 + N.VERIFY_COST / m) for m, k in enumerate(lengths, 1) if m <= need]
            assert N.choose_prefix(frequency, percent) == (cost.index(min(cost)) + 1, lengths)
