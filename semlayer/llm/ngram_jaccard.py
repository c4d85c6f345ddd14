"""N-gram Jaccard self-join with adaptive multi-match prefixes.

A document's set is its distinct shingles of five words.  Two sets of Jaccard similarity t or
more share at least m of the first |set| - ceil(t * |set|) + m shingles, for every m, if both are
ordered by rarity.  A longer prefix costs more list entries but leaves fewer candidates, so each
document takes the m of least estimated cost (entries scanned, and candidates verified), and a
pair must share the smaller of its two m within the prefixes of that m before it is verified.

Documents with equal sets form one class, of which one member takes part.  Then, in order:

1. document frequencies of all shingles, counted in packed blocks (see `exchange`);
2. prefixes and m of each class; shingles of one class only have no partner and are left out;
3. in each prefix list every class is verified against two pivots, the smallest class and the one
   whose shingles are the most common.  No list whose classes are of one component by now needs
   any more pairs;
4. of the other lists, long ones lose the entries whose links the pivots decide (see `unsettled`):
   documents of one common passage or template, however many they are;
5. what is left of the lists joins classes of different components, each list without pairs inside
   its largest one.  Lengths, parity bits, positions and shared prefix shingles are tested within
   the join, so a pair comes out once, not once for each shared shingle; long lists carry whole
   sets and verify there;
6. verified links of both kinds give the final components.

The result is complete for components: a pair that is never verified lies in one component.
Lists that keep many classes of many components, which share common shingles beyond both pivots,
cost the product of their sizes (see the README).
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import words as W
from .components import components, written

SHINGLE = 5
PERCENT = 75
#: The largest m, the cost of a verification in list entries, and the prefix entries that a
#: list row carries along.
MOST_MATCHES = 8
VERIFY_COST = 8
HEAD = 64
#: Lists of this size verify within the join, for sets of up to so many shared shingles.
HEAVY = 64
MOST_CARRIED = 512
#: The pivots of a list: its smallest class, and the class whose shingles are the most common.
PIVOTS = ("low", "high")
#: 64-bit numbers of a set's parity bits.
SKETCH = 16
#: Bytes of text whose words and shingles a worker holds at a time.
SLICE = X.MB // 2


def shingle_sets(texts: W.Texts, shingle: int) -> list[np.ndarray]:
    """Sorted distinct shingle codes of each text; a shorter text is one shingle, an empty one has none."""
    found = W.words_of(texts)
    codes = W.sequence_codes(found.code, shingle)
    sets = []
    for low, high in zip(found.first[:-1].tolist(), found.first[1:].tolist()):
        if high - low >= shingle:
            own = codes[low : high - shingle + 1]
            own.sort()
            sets.append(own[np.concatenate(([True], own[1:] != own[:-1]))])
        elif high > low:
            sets.append(np.array([W.whole_code(found.code[low:high])], np.uint64))
        else:
            sets.append(np.zeros(0, np.uint64))
    return sets


def set_codes(sets: list[np.ndarray]) -> list[int | None]:
    """One 64-bit code of each set, as a signed number; null for an empty one."""
    size = np.array([len(s) for s in sets], np.int64)
    full = np.flatnonzero(size)
    out: list[int | None] = [None] * len(sets)
    if len(full):
        begin = (np.cumsum(size) - size)[full]
        total = np.add.reduceat(W.mixed(np.concatenate(sets) ^ np.uint64(0x9E3779B97F4A7C15)), begin)
        for i, code in zip(full.tolist(), W.long_id(W.mixed(total + size[full].astype(np.uint64))).tolist()):
            out[i] = code
    return out


def sets_of_classes(table: pa.Table, shingle: int) -> dict[int, np.ndarray]:
    """The set of each class of a batch (class, text), of whose rows one is read, in their order."""
    code, at = np.unique(table["class"].to_numpy(), return_index=True)
    texts = table.select(["text"])
    if len(at) < len(texts):
        texts = texts.take(pa.array(np.sort(at)))
    slices = (part["text"] for whole in texts.to_batches() for part in X.text_slices(whole, most=SLICE))
    sets = (own for text in slices for own in shingle_sets(W.texts_of(text, lower=True), shingle))
    return dict(zip(code[np.argsort(at)].tolist(), sets))


def set_code(codes: np.ndarray) -> int:
    """The code of one set that is not empty."""
    return set_codes([codes])[0]


def parity_bits(codes: np.ndarray) -> list[int]:
    """Whether each of 64 * SKETCH cells has an odd number of codes.

    Two sets differ in at least as many codes as their parities differ in cells.
    """
    cell = (W.mixed(codes) % np.uint64(64 * SKETCH)).astype(np.int64)
    odd = (np.bincount(cell, minlength=64 * SKETCH) & 1).astype(np.uint8)
    return np.packbits(odd).view(np.int64).tolist()


def required(n: int, percent: int) -> int:
    """The least overlap of a set of n with any set that it links to."""
    return -(-percent * n // 100)


def choose_prefix(frequency: np.ndarray, percent: int) -> tuple[int, list[int]]:
    """m of least estimated cost for shingle frequencies in rarity order, and prefix lengths by m."""
    n = len(frequency)
    need = required(n, percent)
    matches = np.arange(1, MOST_MATCHES + 1)
    lengths = np.minimum(n, n - need + matches)
    scanned = np.cumsum(frequency[: lengths[-1]].astype(np.int64) - 1)
    cost = (scanned[lengths - 1] * (1 + VERIFY_COST / matches))[:need]
    return int(np.argmin(cost)) + 1, lengths.tolist()


def members_of(docs: DataFrame, shingle: int = SHINGLE) -> DataFrame:
    """doc_id, n_shingles and the code of the set (null if empty) of each row."""

    def run(batches):
        for batch in (part for whole in batches for part in X.text_slices(whole, most=SLICE)):
            sets = shingle_sets(W.texts_of(batch["text"], lower=True), shingle)
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_shingles": pa.array([len(s) for s in sets], pa.int64()),
                    "class": pa.array(set_codes(sets), pa.int64()),
                }
            )

    return docs.mapInArrow(X.given_back(run), "doc_id bigint, n_shingles bigint, class bigint")


def prefixes(docs: DataFrame, shingle: int, percent: int) -> DataFrame:
    """A row for each class whose prefix has a shingle of another class.

    class, n, level (its m), weight (mean frequency of its shingles), tokens (shared shingles of its
    prefix, rarest first), place (their positions among all shingles), reach (how many tokens the
    prefix of each m has), shared (all its shingles that another class has, in the same order, so
    that it begins with tokens) and parity (see `parity_bits`).
    """
    spark = docs.sparkSession
    total = X.text_bytes(docs)
    batches, buckets = X.batch_count(spark, total), X.bucket_count(spark, total)

    def first_of_class(tables):
        seen: set[int] = set()
        for table in (part for whole in tables for part in X.text_slices(whole, most=SLICE)):
            keep, codes = [], []
            for i, code in enumerate(set_codes(shingle_sets(W.texts_of(table["text"], lower=True), shingle))):
                if code is not None and code not in seen:
                    seen.add(code)
                    keep.append(i)
                    codes.append(code)
            kept = table.take(pa.array(keep, pa.int64()))
            code = np.array(codes, np.int64)
            yield pa.record_batch(
                {"batch": pa.array(code % batches, pa.int64()), "class": pa.array(code), "text": kept["text"]}
            )

    def extract(table: pa.Table):
        return X.distinct_sums(np.concatenate(list(sets_of_classes(table, shingle).values())), own=True)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        found = prefixes_of(table, answers)
        X.give_back()
        return found

    def prefixes_of(table: pa.Table, answers: pa.Table) -> pa.Table:
        sets = sets_of_classes(table, shingle)
        codes = np.concatenate(list(sets.values()))
        keys, _ = X.distinct_sums(codes)
        frequency = X.looked_up(keys, X.answered(answers, len(keys), np.uint64), codes)
        ends = np.cumsum([len(s) for s in sets.values()])[:-1]
        single = {name: [] for name in ("class", "n", "level", "weight")}
        lists = {name: [] for name in ("tokens", "place", "reach", "shared", "parity")}
        for (code, codes), own in zip(sets.items(), np.split(frequency, ends)):
            if own.max() < 2:
                continue
            order = np.lexsort((codes, own))
            own = own[order]
            level, lengths = choose_prefix(own, percent)
            place = np.flatnonzero(own[: lengths[level - 1]] > 1)
            if len(place):
                weight = float(own.sum(dtype=np.int64)) / len(codes)
                for name, value in zip(single, (code, len(codes), level, weight)):
                    single[name].append(value)
                shared = W.long_id(codes[order[own > 1]])
                reach = np.searchsorted(place, lengths[:level])
                tokens = W.long_id(codes[order[place]])
                for name, values in zip(lists, (tokens, place, reach, shared, np.array(parity_bits(codes)))):
                    lists[name].append(values)
        columns = {name: pa.array(values, pa.float64() if name == "weight" else pa.int64()) for name, values in single.items()}
        return pa.table(columns | {name: X.list_column(values) for name, values in lists.items()})

    dealt = docs.select("text").mapInArrow(X.given_back(first_of_class), "batch bigint, class bigint, text string")
    blocks = X.blocks_of(dealt, extract, buckets, np.uint32)
    answers = X.answers_of(blocks, lambda total: total, np.uint32, np.uint64)
    return (
        dealt.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInArrow(
            finish,
            "class bigint, n bigint, level bigint, weight double, tokens array<bigint>, place array<bigint>, reach array<bigint>, "
            "shared array<bigint>, parity array<bigint>",
        )
    )


def verified(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Those pairs (a, b) of classes whose sets are similar enough."""
    left = sets.select(F.col("class").alias("a"), F.col("n").alias("an"), F.col("shared").alias("aset"))
    right = sets.select(F.col("class").alias("b"), F.col("n").alias("bn"), F.col("shared").alias("bset"))
    overlap = F.size(F.array_intersect("aset", "bset"))
    return (
        pairs.join(left, "a")
        .join(right, "b")
        .where((100 + percent) * overlap >= percent * (F.col("an") + F.col("bn")))
        .select("a", "b")
    )


def lists_of(sets: DataFrame, *more: str) -> DataFrame:
    """A row for each entry of each prefix list: token, at (its index among the tokens), place."""
    entry = F.posexplode(F.arrays_zip("tokens", "place")).alias("at", "entry")
    return sets.select("class", "n", *more, entry).select(
        F.col("entry.tokens").alias("token"), "class", "n", *more, (F.col("at") + 1).alias("at"), F.col("entry.place").alias("place")
    )


def pivots_of(name: str) -> Column:
    """A list's pivot of that name: its smallest class, or the one whose shingles are the most common."""
    return F.min(F.struct("n", "class")) if name == "low" else F.max(F.struct("weight", "n", "class"))


def pivot_overlaps(sets: DataFrame, percent: int) -> DataFrame:
    """What each class has in common with the two pivots of each of its lists.

    class, pivot, n, pivot_n, overlap, and last: the index of the class's most common shared shingle
    that the pivot lacks (0 for none).  In short lists only pivots of a size that allows a link count.
    """
    entries = lists_of(sets, "weight")
    pivots = entries.groupBy("token").agg(*(pivots_of(p).alias(p) for p in PIVOTS), F.count("*").alias("total"))
    ends = F.explode(F.array(*(F.struct(f"{p}.n", f"{p}.class") for p in PIVOTS))).alias("p")
    pairs = (
        entries.join(pivots.where("total > 1"), "token")
        .select("class", "n", "total", ends)
        .where("class <> p.class")
        .where((F.col("total") >= HEAVY) | (100 * F.least("n", "p.n") >= percent * F.greatest("n", "p.n")))
        .select("class", F.col("p.class").alias("pivot"))
        .distinct()
    )
    own = sets.select("class", "n", "shared")
    other = sets.select(F.col("class").alias("pivot"), F.col("n").alias("pivot_n"), F.col("shared").alias("pivot_shared"))
    both = pairs.join(own, "class").join(other, "pivot").withColumn("rest", F.array_except("shared", "pivot_shared"))
    last = F.when(F.size("rest") > 0, F.array_position("shared", F.element_at("rest", -1))).otherwise(0)
    return both.select(
        "class", "pivot", "n", "pivot_n", (F.size("shared") - F.size("rest")).alias("overlap"), last.alias("last")
    )


def pivot_links(overlaps: DataFrame, percent: int) -> DataFrame:
    """The links (a, b) among the pairs of classes and pivots."""
    return (
        overlaps.where((100 + percent) * F.col("overlap") >= percent * (F.col("n") + F.col("pivot_n")))
        .select(F.least("class", "pivot").alias("a"), F.greatest("class", "pivot").alias("b"))
        .distinct()
    )


def unsettled(entries: DataFrame, overlaps: DataFrame, percent: int) -> DataFrame:
    """The entries of long lists that may have a link which the pivots have not found.

    If all that A shares from a list's token on lies within the pivot c, then so does what it has in
    common with any B of which this token is the rarest common one: |A & B| is at most |A & c| and at
    most |B & c|.  So A and B link only if both overlaps allow their two sizes.  Such an A is settled

    - if its overlap with c allows no size that the list has; or
    - if it links to c and is no smaller: a B that it links to then links to c as well.

    Adds overlap_<pivot> and last_<pivot>, by which pairs are tested again within the join.
    """
    for p in PIVOTS:
        own = overlaps.select(
            F.col("class").alias("of"), F.col("pivot").alias("to"), F.col("overlap").alias(f"overlap_{p}"), F.col("last").alias(f"last_{p}")
        )
        itself = F.col("class") == F.col(f"{p}.class")
        entries = (
            entries.join(own, (F.col("class") == F.col("of")) & (F.col(f"{p}.class") == F.col("to")), "left")
            .drop("of", "to")
            .withColumn(f"overlap_{p}", F.when(itself, F.col("n")).otherwise(F.coalesce(f"overlap_{p}", "n")))
            .withColumn(f"last_{p}", F.when(itself, 0).otherwise(F.coalesce(f"last_{p}", "at")))
        )
        allowed = (100 + percent) * F.col(f"overlap_{p}")
        none = allowed < percent * (F.col("n") + F.col("low.n"))
        through = (F.col("n") >= F.col(f"{p}.n")) & (allowed >= percent * (F.col("n") + F.col(f"{p}.n")))
        entries = entries.where(~((F.col("at") > F.col(f"last_{p}")) & (none | through)))
    return entries


def open_lists_of(entries: DataFrame, *pivots: Column) -> DataFrame:
    """token, main (the component of most entries) and total of each list of several components."""
    return (
        entries.groupBy("token", "root")
        .agg(F.count("*").alias("size"), *pivots)
        .groupBy("token")
        .agg(
            F.max(F.struct("size", "root")).alias("most"),
            F.count("*").alias("roots"),
            F.sum("size").alias("total"),
            *((F.min if p == "low" else F.max)(p).alias(p) for p in PIVOTS[: len(pivots)]),
        )
        .where("roots > 1")
        .select("token", F.col("most.root").alias("main"), "total", *PIVOTS[: len(pivots)])
    )


def crossing_pairs(sets: DataFrame, overlaps: DataFrame, stars: DataFrame, percent: int) -> DataFrame:
    """Candidates between classes of different components that share a prefix list."""
    rooted = sets.join(stars.withColumnRenamed("node", "class"), "class", "left").withColumn("root", F.coalesce("root", "class"))
    entries = lists_of(rooted, "weight", "root")
    lists = written(open_lists_of(entries, *(pivots_of(p).alias(p) for p in PIVOTS)), "near-lists")
    slim = entries.join(lists, "token")
    left = unsettled(slim.where(F.col("total") >= HEAVY), overlaps, percent).drop("main", "total", *PIVOTS)
    left = written(left, "near-unsettled")
    left = left.join(open_lists_of(left), "token")
    bounds = [c for p in PIVOTS for c in (f"overlap_{p}", f"last_{p}")]
    few = slim.where(F.col("total") < HEAVY)
    few = few.withColumns({c: F.col("n" if c.startswith("overlap") else "at") for c in bounds})
    names = ["token", "class", "n", "at", "place", "root", "main", "total", *bounds]
    more = sets.select("class", "level", "reach", "parity", F.slice("tokens", 1, HEAD).alias("head"))
    small = few.select(*names).join(more, "class").withColumn("shared", F.lit(None).cast("array<bigint>"))
    whole = sets.select("class", F.when(F.size("shared") <= MOST_CARRIED, F.col("shared")).alias("shared"))
    heavy = left.select(*names).join(more, "class").join(whole, "class")
    pairs = [crossing_within(written(some, "near-open"), percent) for some in (small, heavy.select(*small.columns))]
    return pairs[0].union(pairs[1]).distinct()


def crossing_within(open_lists: DataFrame, percent: int) -> DataFrame:
    """Pairs of one list and two components that may link; where whole sets are at hand, those that do."""
    left = open_lists.where("root <> main").alias("l")
    right = open_lists.alias("r")
    m = F.least("l.level", "r.level").cast("int")
    reach = {s: F.element_at(f"{s}.reach", m).cast("int") for s in "lr"}
    least = percent * F.expr("l.n + r.n")
    apart = F.expr(" + ".join(f"bit_count(l.parity[{i}] ^ r.parity[{i}])" for i in range(SKETCH)))
    settled = [
        ((F.col("l.at") > F.col(f"l.last_{p}")) | (F.col("r.at") > F.col(f"r.last_{p}")))
        & ((100 + percent) * F.least(f"l.overlap_{p}", f"r.overlap_{p}") < least)
        for p in PIVOTS
    ]
    near = left.join(
        right,
        (F.col("l.token") == F.col("r.token"))
        & (F.col("l.root") != F.col("r.root"))
        & ((F.col("r.root") == F.col("r.main")) | (F.col("l.class") < F.col("r.class")))
        & (100 * F.least("l.n", "r.n") >= percent * F.greatest("l.n", "r.n"))
        & ~(settled[0] | settled[1])
        & ((100 + percent) * apart <= (100 - percent) * F.expr("l.n + r.n")),
    )
    common = F.array_intersect(*(F.slice(f"{s}.head", F.lit(1), F.least(reach[s], F.lit(HEAD))) for s in "lr"))
    overlap = F.when(
        F.col("l.shared").isNotNull() & F.col("r.shared").isNotNull(), F.size(F.array_intersect("l.shared", "r.shared"))
    )
    costly = F.struct(
        ((F.col("l.at") <= reach["l"]) & (F.col("r.at") <= reach["r"])).alias("within"),
        ((F.col("l.at") > HEAD) | (F.col("r.at") > HEAD)).alias("beyond"),
        ((reach["l"] > HEAD) | (reach["r"] > HEAD)).alias("cut"),
        common.alias("common"),
        overlap.alias("overlap"),
    )
    tested = near.select(
        F.least("l.class", "r.class").alias("a"),
        F.greatest("l.class", "r.class").alias("b"),
        F.col("l.token").alias("token"),
        m.alias("m"),
        least.alias("least"),
        F.least(F.expr("l.n - l.place"), F.expr("r.n - r.place")).alias("bound"),
        # An array of one element: its costly tests stay out of the join's own loop.
        F.explode(F.array(costly)).alias("t"),
    )
    first = (F.element_at("t.common", 1) == F.col("token")) & (F.col("t.cut") | (F.size("t.common") >= F.col("m")))
    reachable = (100 + percent) * F.col("bound") >= F.col("least")
    links = F.col("t.overlap").isNull() | ((100 + percent) * F.col("t.overlap") >= F.col("least"))
    return tested.where("t.within").where((F.col("t.beyond") | (reachable & first)) & links).select("a", "b")


def merged(stars: DataFrame, pairs: DataFrame) -> DataFrame:
    """Components (node, root) of the links behind `stars` and of `pairs` (a, b) together.

    Only distinct pairs of roots go into the second search, however many links join two stars.
    """
    ends = pairs.select("a", "b")
    for end in ("a", "b"):
        root = stars.select(F.col("node").alias(end), F.col("root").alias(f"{end}_root"))
        ends = ends.join(root, end, "left").withColumn(end, F.coalesce(f"{end}_root", end)).select("a", "b")
    above = written(components(ends.distinct()), "near-roots")
    lifted = stars.join(above.toDF("root", "over"), "root", "left").select("node", F.coalesce("over", "root").alias("root"))
    return lifted.union(above.join(stars.select("node"), "node", "left_anti").select("node", "root"))


def near_duplicates(documents: DataFrame, shingle: int = SHINGLE, percent: int = PERCENT) -> DataFrame:
    """doc_id, n_shingles and component_id for each row of `documents` (doc_id, text).

    Words are split at ASCII white space after lower-casing A-Z.  component_id is the smallest
    doc_id that links reach, the row's own included.  A null or empty text has no shingle and no
    link.  Rows of equal text share a component; other columns are ignored.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    members = written(members_of(docs, shingle), "near-members")
    sets = written(prefixes(docs, shingle, percent), "near-sets")
    overlaps = written(pivot_overlaps(sets, percent), "near-overlaps")
    stars = written(components(pivot_links(overlaps, percent)), "near-stars")
    more = verified(crossing_pairs(sets, overlaps, stars, percent), sets, percent)
    roots = merged(stars, more)
    ids = (
        members.where("class is not null")
        .groupBy("class")
        .agg(F.min("doc_id").alias("least"))
        .join(roots.withColumnRenamed("node", "class"), "class", "left")
        .withColumn("root", F.coalesce("root", "class"))
    )
    smallest = ids.groupBy("root").agg(F.min("least").alias("component_id"))
    names = ids.join(smallest, "root").select("class", "component_id")
    return members.join(names, "class", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )
