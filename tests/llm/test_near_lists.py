"""Near duplicates in lists of very common shingles, against all pairs."""

import random

import pytest

from semlayer.llm import ngram_jaccard as near


def shingles(text):
    words = text.lower().split()
    return {tuple(words[i : i + 5]) for i in range(max(len(words) - 4, 1))} if words else set()


def components_by_all_pairs(rows):
    sets = {i: shingles(text) for i, text in rows}
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for a, one in sets.items():
        for b, other in sets.items():
            if a < b and one and other and 100 * len(one & other) >= 75 * len(one | other):
                low, high = sorted((find(a), find(b)))
                root[high] = low
    return {i: find(i) for i in sets}


def edited(dice, words, edits):
    out = list(words)
    for _ in range(edits):
        at = dice.randrange(len(out))
        kind = dice.randrange(3)
        out[at : at + (kind != 0)] = [] if kind == 1 else [f"e{dice.randrange(10**9)}"]
    return out


def corpus(dice):
    """Copies with up to seven edits, shared edits too; one passage, or two, amid own words; parts of a passage."""
    text, passage, other = ([f"{name}{i}" for i in range(n)] for name, n in (("t", 90), ("p", 40), ("q", 35)))
    variants = [edited(dice, text, 3) for _ in range(4)]
    rows = [edited(dice, dice.choice([text, text, *variants]), dice.randrange(8)) for _ in range(260)]
    for _ in range(200):
        own = [f"o{dice.randrange(10**9)}" for _ in range(dice.randrange(16))]
        cut = dice.randrange(len(own) + 1)
        middle = dice.choice([passage, passage, passage + other, other + passage, passage[: dice.randrange(5, 41)]])
        rows.append(own[:cut] + middle + own[cut:])
    rows += [passage, text, other, passage + other, text[:70]]
    dice.shuffle(rows)
    return [(i, " ".join(words)) for i, words in enumerate(rows)]


@pytest.mark.parametrize("seed", [1, 2, 3])
def test_components_of_common_passages_are_those_of_all_pairs(documents, seed):
    rows = corpus(random.Random(seed))
    found = {row.doc_id: row.component_id for row in near.near_duplicates(documents(rows)).collect()}
    assert found == components_by_all_pairs(rows)


def test_pivots_settle_most_of_a_large_group(spark, documents):
    dice = random.Random(5)
    text = [f"t{i}" for i in range(120)]
    rows = [(i, " ".join(edited(dice, text, dice.randrange(1, 8)))) for i in range(400)] + [(400, " ".join(text))]
    sets = near.written(near.prefixes(documents(rows), 5, 75), "sets")
    overlaps = near.written(near.pivot_overlaps(sets, 75), "overlaps")
    stars = near.written(near.components(near.pivot_links(overlaps, 75)), "stars")
    assert near.crossing_pairs(sets, overlaps, stars, 75).count() < 400
