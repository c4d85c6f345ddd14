"""Spelling variants, source mixing and conversation repair against brute force, and on odd tables."""

import collections
import hashlib
import heapq
import itertools
import random
import zlib

import pytest

from semlayer.llm import mixing, repair, spelling

CONVERSATION = "conv_id bigint, turn bigint, role string, text string, audit string, fault int, digest string, dropped int"


# -- spelling variants ------------------------------------------------------------------------


def one_edit(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) == len(short) + 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def brute_forms(counts):
    rows = {}
    for word, n in counts.items():
        near = [other for other in counts if one_edit(word, other)]
        best = min(near, key=lambda other: (-counts[other], other), default=None)
        form = best if best is not None and counts[best] >= 5 * n else None
        rows[word] = form, len(near)
    result = {}
    for word, (form, n_near) in rows.items():
        root = word
        while rows[root][0] is not None:
            root = rows[root][0]
        result[word] = form, root, counts[word], n_near, counts.get(form)
    return result


def random_words(seed, n, letters, sizes):
    dice = random.Random(seed)
    words = {"".join(dice.choice(letters) for _ in range(dice.choice(sizes))) for _ in range(n)}
    return {word: int(5 * 7 ** (5 * dice.random())) for word in words}


@pytest.mark.parametrize(
    "counts, options",
    [
        (random_words(1, 700, "abé", (6, 7, 8)), {}),
        (random_words(2, 700, "abcd", (6, 7)), {"sample_words": 50, "cell_words": 20}),
        (random_words(3, 300, "aÿ", (6, 7, 9)), {"sample_words": 10, "cell_words": 5}),
        ({"a" * 200: 5, "a" * 201: 30, "a" * 200 + "b": 7, "b" + "a" * 199: 9}, {}),
        ({"".join(p): 5 + i for i, p in enumerate(itertools.permutations("abcdef"))}, {"cell_words": 30}),
    ],
)
def test_forms_against_brute_force(spark, counts, options):
    words = spark.createDataFrame(list(counts.items()), "word string, n bigint")
    rows = {row.word: tuple(row)[1:] for row in spelling.spelling_forms(words, **options).collect()}
    assert rows == brute_forms(counts)


def test_forms_follow_forms(spark):
    chain = {"variant" + "abcdefg"[:k]: 5**k for k in range(1, 7)}
    words = spark.createDataFrame([(w, 5 * n) for w, n in chain.items()], "word string, n bigint")
    rows = spelling.spelling_forms(words).collect()
    assert {row.root for row in rows} == {"variantabcdef"}


def test_vocabulary_damages_by_id(spark, documents):
    word, hits = "wörterbuch", []
    for i in range(3000):
        h = zlib.crc32(f"{i}:{word}".encode())
        if h % 199 == 0:
            at = h % len(word)
            hits.append(word[:at] + word[at + 1 :])
    rows = documents([(i, "WöRTERBUCH, short wÖrterbuch") for i in range(3000)])
    found = {row.word: row.n for row in spelling.vocabulary(rows).collect()}
    expected = collections.Counter(hits)
    # The second run has another letter (only A-Z are lower-cased), so its hash differs.
    other = "wÖrterbuch"
    for i in range(3000):
        h = zlib.crc32(f"{i}:{other}".encode())
        expected[other[: h % 10] + other[h % 10 + 1 :] if h % 199 == 0 else other] += 1
    expected[word] += 3000 - len(hits)
    assert found == {w: n for w, n in expected.items() if n >= 5 and len(w) >= 6}


def test_spelling_of_odd_tables(spark, odd, nothing, documents):
    assert spelling.spelling_forms(spelling.vocabulary(nothing)).count() == 0
    assert spelling.spelling_forms(spelling.vocabulary(odd)).count() == 0
    repeated = documents([(None, "repeated")] * 3 + [(1, "repeated"), (1, "repeated repeateds")] + [(2, None)])
    rows = spelling.spelling_forms(spelling.vocabulary(repeated)).collect()
    assert [tuple(row) for row in rows] == [("repeated", None, "repeated", 5, 0, None)]


# -- mixing -----------------------------------------------------------------------------------


@pytest.fixture
def sourced(spark):
    schema = "doc_id bigint, text string, source string, size int, key string, block int, target int, slots int"

    def make(rows):
        return spark.createDataFrame([(i, t, s, 0, "k", 1, 2, 3) for i, t, s in rows], schema)

    return make


def brute_targets(sizes, most=3):
    """Share by weight; stop at the limit; share what is left again, until nothing is above."""
    names = sorted((s for s in sizes if s is not None)) + [None] * (None in sizes)
    weight = {s: k % 3 + 1 for k, s in enumerate(names)}
    left, free, target = sum(sizes.values()), set(names), {}
    while free:
        total = sum(weight[s] for s in free)
        full = {s for s in free if left * weight[s] > most * sizes[s] * total}
        if not full:
            return target | {s: left * weight[s] / total for s in free}
        target |= {s: most * sizes[s] for s in full}
        left -= sum(most * sizes[s] for s in full)
        free -= full
    return target


def mix_rows(dice):
    words = lambda n: " ".join(f"w{dice.randrange(99)}" for _ in range(n))
    hot = [(i, words(dice.randrange(0, 90)), "hot") for i in range(300)]
    small = [(1000 + i, words(dice.randrange(0, 9)), dice.choice(["a", "b", "z", None, "é"])) for i in range(120)]
    odd = [(None, words(5), "a")] * 3 + [(700, "same text", "b")] * 4 + [(800, None, "a"), (900, "", None), (901, "only", "lone"), (902, "", "void")]
    return hot + small + odd + [(5000, words(30_000), "long")]


def test_targets_and_mix(spark, sourced):
    rows = mix_rows(random.Random(5))
    found = mixing.taken_words(sourced(rows)).collect()
    assert sorted((r.doc_id is None, r.doc_id, r.size) for r in found) == sorted((i is None, i, len((t or "").split())) for i, t, _ in rows)
    sizes = collections.Counter()
    for _, text, source in rows:
        sizes[source] += len((text or "").split())
    source_of = {i: s for i, _, s in rows}
    targets, taken = brute_targets(sizes), collections.Counter()
    for row in found:
        source = source_of[row.doc_id]
        assert row.source_size == sizes[source] and row.target == pytest.approx(targets[source])
        assert row.taken <= 3 * row.size
        taken[source] += row.taken
    for source, target in targets.items():
        assert abs(taken[source] - target) <= max(1, 0.02 * target), (source, taken[source], target)
    again = mixing.taken_words(sourced(rows[::-1]).repartition(7)).collect()
    assert sorted(map(repr, found)) == sorted(map(repr, again))


def test_schedule_is_even_and_blocks_are_whole(spark, sourced):
    sources, slots, parts = mixing.mixed(sourced(mix_rows(random.Random(6))), block_tokens=64, least_slots=16)
    quota = {row.source_id: row for row in sources.collect()}
    order = [row.source_id for row in slots.orderBy("slot").collect()]
    assert collections.Counter(order) == {i: q.slots for i, q in quota.items() if q.slots}
    seen = collections.Counter()
    for n, source in enumerate(order, 1):
        seen[source] += 1
        assert all(abs(seen[i] - n * q.slots / len(order)) < 12 for i, q in quota.items())
    for row in slots.collect():
        assert row.block < quota[row.source_id].blocks and row.epoch < 3
    sizes = collections.defaultdict(list)
    for row in parts.groupBy("source_id", "block").sum("length").where("block IS NOT NULL").collect():
        sizes[row.source_id].append(row["sum(length)"])
    for i, q in quota.items():
        assert sum(sizes[i]) == q.source_size and len(sizes[i]) == q.blocks
        assert not sizes[i] or max(sizes[i]) - min(sizes[i]) <= 1


def test_mix_of_odd_tables(sourced):
    assert mixing.taken_words(sourced([])).count() == 0
    empty = mixing.taken_words(sourced([(1, None, "a"), (2, "", None), (2, "", None)])).collect()
    assert sorted(tuple(row) for row in empty) == [(1, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0), (2, 0, 0, 0.0, 0)]


# -- conversation repair ----------------------------------------------------------------------

FOLLOWS = {"": "su", "s": "u", "u": "a", "a": "u"}


def brute_repair(rows):
    """Cheapest and ASCII-least edits of (initial, fault) rows, by uniform-cost search over whole edit strings."""
    heap, done = [(0, "", 0, "")], set()
    while heap:
        cost, path, i, state = heapq.heappop(heap)
        if (i, state) in done:
            continue
        done.add((i, state))
        if i == len(rows) and state in ("", "a"):
            return cost, path
        after = "a" if state == "u" else "u"
        heapq.heappush(heap, (cost + 3, path + "I", i, after))
        if i < len(rows):
            kind, fault = rows[i]
            heapq.heappush(heap, (cost + 4, path + "D", i + 1, state))
            if fault < repair.BLANK:
                cut = 3 if fault == repair.CUT else 0
                if kind and kind in FOLLOWS[state]:
                    heapq.heappush(heap, (cost + cut, path + "K", i + 1, kind))
                heapq.heappush(heap, (cost + 3 + cut, path + "R", i + 1, after))


@pytest.mark.parametrize("segment", [1, 3, 64])
def test_search_against_brute_force(segment):
    dice = random.Random(segment)
    for _ in range(1500):
        rows = [(dice.choice("suauaua") if dice.random() < 0.95 else "", dice.choice((0, 0, 0, 0, 1, 2, 3))) for _ in range(dice.randrange(0, 10))]
        kinds = bytes(repair.ROLES.index(kind) if kind else 0 for kind, _ in rows)
        assert repair.cheapest_edits(kinds, bytes(fault for _, fault in rows), segment) == brute_repair(rows), rows


def test_long_conversations_are_linear():
    dice = random.Random(3)
    kinds = bytes(2 + (i + (dice.random() < 0.05)) % 2 for i in range(20_000))
    faults = bytes(dice.choice((0,) * 15 + (1, 2, 3)) for _ in range(20_000))
    cost, audit = repair.cheapest_edits(kinds, faults)
    assert sum(edit != "I" for edit in audit) == 20_000 and cost >= 4 * sum(f >= 2 for f in faults)
    assert (cost, audit) == repair.cheapest_edits(kinds, faults, segment=37)


def test_repaired_rows_are_what_the_digest_hashes(spark):
    dice = random.Random(9)
    say = lambda: dice.choice(["Yes.", "No?", "well", "", " \t", "Yes.", "text " * dice.randrange(1, 9) + "."])
    rows = [
        (c, dice.choice([t, t, t, None, 3]), dice.choice(["system", "user", "assistant", "user", "assistant", "tool", None]), say(), "x", 1, "y", 0)
        for c in [*range(40), None]
        for t in range(dice.randrange(1, 12))
    ]
    damaged = repair.damaged(spark.createDataFrame(rows, CONVERSATION)).checkpoint()
    found = repair.audits(damaged).checkpoint()
    assert {row.conv_id for row in found.collect()} == {*range(40), None}
    repaired, digests = repair.repaired_rows(damaged, found), repair.repaired_digests(damaged, found)
    lines = collections.defaultdict(list)
    for row in repaired.orderBy("conv_id", "position").collect():
        assert row.position == len(lines[row.conv_id])
        lines[row.conv_id].append((row.role, row.text, row.edit))
    audits = {row.conv_id: row for row in found.collect()}
    for row in digests.collect():
        own = lines[row.conv_id]
        assert row.repaired_sha256 == hashlib.sha256("\n".join(f"{r}:{t}" for r, t, _ in own).encode()).hexdigest()
        roles = "".join(r[0] for r, _, _ in own)
        assert roles.lstrip("s") == "ua" * (len(roles.lstrip("s")) // 2) and roles.count("s") <= 1 and roles != "s"
        assert "".join(e for _, _, e in own) == audits[row.conv_id].audit.replace("D", "")


def test_repair_of_odd_tables(spark):
    nothing = repair.damaged(spark.createDataFrame([], CONVERSATION))
    assert repair.audits(nothing).count() == 0
    dropped = next(i for i in range(99) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    kept = next(i for i in range(99) if zlib.crc32(f"{i}: ".encode()) % 20 > 4)
    rows = [(dropped, 0, "user", "gone.", "", 0, "", 0), (kept, None, None, None, "", 0, "", 0), (kept, None, "user", "End. \n", "", 0, "", 0)]
    table = repair.damaged(spark.createDataFrame(rows, CONVERSATION))
    found = {row.conv_id: tuple(row)[1:] for row in repair.audits(table).collect()}
    assert found == {dropped: (0, 0, 0, 0, 0, 0, ""), kept: (0, 1, 0, 0, 1, 7, "DKI")}
