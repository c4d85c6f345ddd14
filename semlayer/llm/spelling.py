"""Spelling variants: words one edit apart, found by range searches in k-d trees of letter counts.

A word is the vector of how often it has each letter.  A replaced letter moves the vector by an L1
distance of two, an inserted or deleted one by one, so the words near a word of length L lie within two
of it among those of length L, and within one among those of length L - 1 and L + 1.  The k-d tree of a
length cuts its space into cells; every word is dealt to the cell it lies in, and as a query to
each cell whose box is within its distance.  A cell is then one group: a k-d tree over its words,
whose tight boxes prune the queries, and a comparison of the letters' order for what is left.

The cuts of a length's tree come from about SAMPLE_WORDS words, drawn by a hash; they only decide how
even the cells are.  Cells reach over all of space, so words that were not drawn are found all the
same.  Where more words share one vector than a cell should have, they are dealt to several
groups and queries go to each.  A query leaves a cell as one row, its number of near words and the
best of them, so pairs are never written.

Results for odd input: a null or empty text has no words; a null doc_id is an empty string in the
damage's key; repeated rows count each time; ties of the best form go to the smallest word;
no rows give no rows.  Columns other than doc_id and text are not read.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import chain

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .components import written
from .exchange import partitions_of

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
LEAST_LETTERS, LEAST_COUNT = 6, 5
DAMAGED_ONE_IN = 199
#: A form is at least this many times as frequent.
FORM_TIMES = 5
#: Words that the cuts of the cells are taken from: all, or a share by hash that is about as many.
SAMPLE_WORDS = 100_000
CELL_WORDS = (256, 16_384)
LEAF_WORDS = 12
BLOCK_BYTES = 1 << 20
#: Letter counts are cut off here, which makes distances smaller and never larger.
MOST_OF_A_LETTER = 31
CELLS_OF_A_LENGTH = 1 << 24


def vocabulary(documents: DataFrame) -> DataFrame:
    """(word, n): words of the texts, of LEAST_LETTERS letters and LEAST_COUNT occurrences, after damage.

    Only A-Z are lower-cased.  Where crc32(doc_id:run) is a multiple of DAMAGED_ONE_IN, the run loses
    the letter at that number modulo its length.
    """
    whole_runs = f"[A-Za-z\u00C0-\u00FF]{{{LEAST_LETTERS},}}"
    runs = documents.select(
        F.coalesce(F.col("doc_id").cast("string"), F.lit("")).alias("id"),
        F.explode(F.regexp_extract_all(F.col("text").cast("string"), F.lit(whole_runs), F.lit(0))).alias("run"),
    )
    lowered = F.when(F.col("run").rlike("[A-Z]"), F.translate("run", UPPER, LOWER)).otherwise(F.col("run"))
    coded = runs.select("id", lowered.alias("run")).select("run", F.crc32(F.concat("id", F.lit(":"), "run")).alias("h"))
    lost = "cast(h % length(run) as int)"
    word = F.when(F.col("h") % DAMAGED_ONE_IN == 0, F.expr(f"concat(substring(run, 1, {lost}), substring(run, {lost} + 2))"))
    words = coded.select(F.coalesce(word, "run").alias("word")).where(F.length("word") >= LEAST_LETTERS)
    return words.groupBy("word").agg(F.count("*").alias("n")).where(F.col("n") >= LEAST_COUNT)


# -- vectors and trees ------------------------------------------------------------------------


def letter_rows(words: list[str]) -> np.ndarray:
    """The letters of words of one length, a row a word; all of them are below U+0100."""
    return np.frombuffer("".join(words).encode("latin-1"), np.uint8).reshape(len(words), -1)


def vectors(letters: np.ndarray) -> np.ndarray:
    """Letter counts of each row: a to z, then U+00C0 to U+00FF."""
    place = letters.astype(np.int64) - np.where(letters < 0xC0, ord("a"), 0xC0 - 26)
    flat = np.arange(len(letters))[:, None] * 90 + place
    counts = np.bincount(flat.ravel(), minlength=len(letters) * 90).reshape(len(letters), 90)
    return np.minimum(counts, MOST_OF_A_LETTER).astype(np.int8)


class Unary:
    """Letter counts as bits, one for each count that is reached, so that an L1 distance is a number of bits.

    A letter has a bit more than the points reach, and the letters that no point has share three;
    counts beyond that look smaller, so distances do, and never larger.
    """

    def __init__(self, points: np.ndarray):
        most = points.max(0).astype(np.int64)
        self.letters = np.flatnonzero(most)
        self.other = np.flatnonzero(most == 0)
        self.of = np.repeat(np.arange(len(self.letters) + 1), np.append(most[self.letters] + 1, 3))
        self.reached = np.arange(len(self.of)) - np.searchsorted(self.of, self.of)

    def __call__(self, counts: np.ndarray) -> np.ndarray:
        other = counts[:, self.other].max(1, initial=0)
        if other.any():
            other = np.minimum(counts[:, self.other].sum(1, dtype=np.int64), 3).astype(np.int8)
        columns = np.concatenate((counts[:, self.letters], other[:, None]), axis=1)
        bits = np.zeros((len(counts), -(-len(self.of) // 64) * 64), bool)
        np.greater(columns[:, self.of], self.reached, out=bits[:, : len(self.of)])
        return np.ascontiguousarray(np.packbits(bits, axis=1).view(np.uint64).T)


def number_of_bits(parts: Iterator[np.ndarray]) -> np.ndarray:
    """How many bits are set, over some arrays of equal length."""
    total = np.bitwise_count(next(parts)).astype(np.int32)
    for part in parts:
        total += np.bitwise_count(part)
    return total


class Tree:
    """A k-d tree in arrays: each node's box (low to high, both inside), and its children or points.

    With `tight`, boxes are those of the points; else they cut all of space, so that every vector
    lies in one leaf.  Boxes and points are kept as the bits of `unary`.
    """

    def __init__(self, points: np.ndarray, leaf: int, tight: bool):
        self.unary = Unary(points)
        lows, highs, self.left, self.first, self.last = [], [], [], [], []
        self.order = np.arange(len(points))

        def add(first, last, low, high):
            lows.append(low)
            highs.append(high)
            self.left.append(-1)
            self.first.append(first)
            self.last.append(last)

        ends = np.zeros(points.shape[1], np.int8), np.full(points.shape[1], MOST_OF_A_LETTER, np.int8)
        add(0, len(points), *((points.min(0), points.max(0)) if tight else ends))
        node = 0
        while node < len(self.left):
            first, last = self.first[node], self.last[node]
            own = points[self.order[first:last]]
            cut = self._cut(own) if last - first > leaf else None
            if cut is not None:
                letter, value = cut
                below = own[:, letter] <= value
                self.order[first:last] = self.order[first:last][np.argsort(~below, kind="stable")]
                middle = first + int(below.sum())
                self.left[node] = len(self.left)
                if tight:
                    add(first, middle, own[below].min(0), own[below].max(0))
                    add(middle, last, own[~below].min(0), own[~below].max(0))
                else:
                    low, high = lows[node].copy(), highs[node].copy()
                    low[letter], high[letter] = value + 1, value
                    add(first, middle, lows[node], high)
                    add(middle, last, low, highs[node])
            node += 1
        self.low, self.beyond = self.unary(np.array(lows)), ~self.unary(np.array(highs))
        self.left, self.first, self.last = map(np.array, (self.left, self.first, self.last))

    @staticmethod
    def _cut(points: np.ndarray) -> tuple[int, int] | None:
        """The letter and count that cut the points most evenly; None where all are equal."""
        best = None
        for value in range(int(points.min()), int(points.max())):
            share = (points <= value).mean(0)
            share[(share == 0) | (share == 1)] = np.inf
            letter = int(np.abs(share - 0.5).argmin())
            if np.isfinite(share[letter]) and (best is None or abs(share[letter] - 0.5) < best[0]):
                best = abs(share[letter] - 0.5), letter, value
        return best and best[1:]

    def leaves_within(self, queries: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs of a query (in bits) and a leaf whose box is within an L1 distance of it."""
        query, node = np.arange(queries.shape[1]), np.zeros(queries.shape[1], np.int64)
        found = []
        while len(query):
            at = queries[:, query]
            low, beyond = (low[node] & ~bits for low, bits in zip(self.low, at)), (over[node] & bits for over, bits in zip(self.beyond, at))
            kept = number_of_bits(chain(low, beyond)) <= radius
            query, node = query[kept], node[kept]
            leaf = self.left[node] < 0
            found.append((query[leaf], node[leaf]))
            query, left = query[~leaf], self.left[node[~leaf]]
            query, node = np.concatenate((query, query)), np.concatenate((left, left + 1))
        return tuple(map(np.concatenate, zip(*found))) if found else (np.zeros(0, np.int64), np.zeros(0, np.int64))


def one_edit_apart(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Which rows of letters differ by one edit; b's rows are as long as a's, or one longer."""
    if a.shape[1] == b.shape[1]:
        return (a != b).sum(1) == 1
    ahead, behind = a != b[:, :-1], a != b[:, 1:]
    width = a.shape[1]
    same_start = np.where(ahead.any(1), ahead.argmax(1), width)
    same_end = np.where(behind.any(1), behind[:, ::-1].argmax(1), width)
    return same_start + same_end >= width


def near_pairs(tree: Tree, points: np.ndarray, letters: np.ndarray, queries: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(query, point) pairs that are one edit apart; all queries have one length, and all points (in bits)."""
    longer = queries.shape[1] - letters.shape[1]
    radius = 1 if longer else 2
    step = max(1, BLOCK_BYTES // max(90 * 4, queries.shape[1]))
    for start in range(0, len(queries), step):
        block = queries[start : start + step]
        bits = tree.unary(vectors(block))
        query, leaf = tree.leaves_within(bits, radius)
        size = tree.last[leaf] - tree.first[leaf]
        room = max(BLOCK_BYTES // max(90, queries.shape[1]), 1)
        ends = np.cumsum(size)
        done = 0
        while done < len(query):
            # As many leaves as fit, and at least one; their points are one run of the order each.
            upto = max(done + 1, int(np.searchsorted(ends, (ends[done - 1] if done else 0) + 16 * room, "right")))
            some, n = query[done:upto], size[done:upto]
            inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            q, p = np.repeat(some, n), tree.order[np.repeat(tree.first[leaf[done:upto]], n) + inside]
            gap = number_of_bits(mine[q] ^ theirs[p] for mine, theirs in zip(bits, points))
            close = (gap <= radius) & ((gap > 0) | (queries.shape[1] > MOST_OF_A_LETTER))
            q, p = q[close], p[close]
            for k in range(0, len(q), room):
                a, b = block[q[k : k + room]], letters[p[k : k + room]]
                near = one_edit_apart(b, a) if longer > 0 else one_edit_apart(a, b)
                yield start + q[k : k + room][near], p[k : k + room][near]
            done = upto


# -- cells ------------------------------------------------------------------------------------


class Cells:
    """The cells of each length: a tree, and into how many groups the points of a leaf are dealt."""

    def __init__(self, sample: list[str], scale: float, cell_words: int):
        by_length: dict[int, list[str]] = {}
        for word in sample:
            by_length.setdefault(len(word), []).append(word)
        self.of: dict[int, tuple[Tree, np.ndarray, np.ndarray]] = {}
        for length, words in by_length.items():
            tree = Tree(vectors(letter_rows(words)), max(1, int(cell_words / scale)), tight=False)
            groups = np.where(tree.left < 0, np.ceil((tree.last - tree.first) * scale / cell_words), 0).astype(np.int64)
            groups = np.maximum(groups, tree.left < 0)
            self.of[length] = tree, groups, np.cumsum(groups) - groups

    def home(self, length: int, counts: np.ndarray, salts: np.ndarray) -> np.ndarray:
        """The group of each word of a length."""
        if length not in self.of:
            return np.full(len(counts), length * CELLS_OF_A_LENGTH)
        tree, groups, first = self.of[length]
        query, leaf = tree.leaves_within(tree.unary(counts), 0)
        cell = np.empty(len(counts), np.int64)
        cell[query] = length * CELLS_OF_A_LENGTH + first[leaf] + salts[query] % groups[leaf]
        return cell

    def met(self, length: int, counts: np.ndarray, radius: int) -> tuple[np.ndarray, np.ndarray]:
        """(query, group) for every group of a length that may have words within the radius."""
        if length not in self.of:
            return np.arange(len(counts)), np.full(len(counts), length * CELLS_OF_A_LENGTH)
        tree, groups, first = self.of[length]
        query, leaf = tree.leaves_within(tree.unary(counts), radius)
        n = groups[leaf]
        inside = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        return np.repeat(query, n), length * CELLS_OF_A_LENGTH + np.repeat(first[leaf], n) + inside


def by_lengths(words: pa.Array) -> Iterator[tuple[int, np.ndarray, list[str]]]:
    """(length, positions, words) for each length, in runs of about BLOCK_BYTES letters."""
    values = words.to_pylist()
    lengths = np.fromiter(map(len, values), np.int64, len(values))
    for length in np.unique(lengths).tolist():
        at = np.flatnonzero(lengths == length)
        step = max(1, BLOCK_BYTES // max(length, 360))
        for k in range(0, len(at), step):
            yield length, at[k : k + step], [values[i] for i in at[k : k + step]]


def dealt(words: DataFrame, cells: Cells) -> DataFrame:
    """(cell, home, word, n): each word in its own cell (home), and in every other it must search."""

    def run(batches):
        for batch in batches:
            salts = batch["salt"].to_numpy()
            for length, at, own in by_lengths(batch["word"]):
                counts = vectors(letter_rows(own))
                home = cells.home(length, counts, salts[at])
                row, cell = [at], [home]
                for other, radius in ((length - 1, 1), (length, 2), (length + 1, 1)):
                    if other >= LEAST_LETTERS:
                        query, group = cells.met(other, counts, radius)
                        kept = group != home[query]
                        row.append(at[query[kept]])
                        cell.append(group[kept])
                rows = np.concatenate(row)
                chosen = batch.select(["word", "n"]).take(pa.array(rows))
                columns = [pa.array(np.concatenate(cell)), pa.array(np.arange(len(rows)) < len(at)), *chosen.columns]
                yield pa.record_batch(columns, names=["cell", "home", "word", "n"])

    salted = words.select("word", "n", F.pmod(F.xxhash64("word"), F.lit(1 << 20)).alias("salt"))
    return salted.mapInArrow(run, "cell bigint, home boolean, word string, n bigint")


def searched(table: pa.Table) -> pa.Table:
    """Each query of a cell that has near words there: word, n, how many, and the best one with its count."""
    table = table.combine_chunks()
    homes = table.filter(table["home"])
    out: dict[str, list] = {"word": [], "n": [], "n_near": [], "best_n": [], "best": []}
    if len(homes):
        points = homes["word"].to_pylist()
        point_n = homes["n"].to_numpy()
        rank = np.empty(len(points), np.int64)
        rank[sorted(range(len(points)), key=points.__getitem__)] = np.arange(len(points))
        letters = letter_rows(points)
        tree = Tree(vectors(letters), LEAF_WORDS, tight=True)
        bits = tree.unary(vectors(letters))
        n = table["n"].to_numpy()
        for _, at, own in by_lengths(table["word"]):
            for query, point in near_pairs(tree, bits, letters, letter_rows(own)):
                order = np.lexsort((rank[point], -point_n[point], query))
                query, point = query[order], point[order]
                first = np.flatnonzero(np.diff(query, prepend=-1))
                out["word"] += [own[i] for i in query[first]]
                out["n"] += n[at[query[first]]].tolist()
                out["n_near"] += np.diff(np.append(first, len(query))).tolist()
                out["best_n"] += point_n[point[first]].tolist()
                out["best"] += [points[i] for i in point[first]]
    return pa.table(out, FOUND_ARROW)


FOUND = "word string, n bigint, n_near bigint, best_n bigint, best string"
FOUND_ARROW = pa.schema(
    [("word", pa.string()), ("n", pa.int64()), ("n_near", pa.int64()), ("best_n", pa.int64()), ("best", pa.string())]
)


# -- whole tables -----------------------------------------------------------------------------


def near_words(words: DataFrame, sample_words: int = SAMPLE_WORDS, cell_words: int | None = None) -> DataFrame:
    """Per word: word, n, n_near, and its near word of the largest n with that n (best, best_n)."""
    total = words.count()
    if cell_words is None:
        least, most = CELL_WORDS
        cell_words = min(most, max(least, total // (2 * partitions_of(words.sparkSession))))
    share = min(1 << 32, (sample_words << 32) // max(total, 1))
    sample = [row.word for row in words.where(F.pmod(F.xxhash64("word"), F.lit(1 << 32)) < share).select("word").collect()]
    cells = Cells(sample, total / max(len(sample), 1), cell_words)
    found = dealt(words, cells).groupBy("cell").applyInArrow(searched, FOUND)
    alone = words.select("word", "n", F.lit(0).cast("bigint"), F.lit(None).cast("bigint"), F.lit(None).cast("string"))
    best = F.min(F.when(F.col("best").isNotNull(), F.struct((-F.col("best_n")).alias("less"), "best")))
    rows = alone.toDF("word", "n", "n_near", "best_n", "best").union(found).groupBy("word", "n")
    rows = rows.agg(F.sum("n_near").alias("n_near"), best.alias("best"))
    return rows.select("word", "n", "n_near", F.col("best.best").alias("best"), (-F.col("best.less")).alias("best_n"))


def spelling_forms(words: DataFrame, times: int = FORM_TIMES, **options) -> DataFrame:
    """Per word: word, form, root, n, n_near, form_n.

    A form is `times` as frequent as its word, so forms of forms end after as many steps as the
    largest count has powers of `times`; each round of joins doubles the steps.
    """
    is_form = F.col("best_n") >= times * F.col("n")
    near = near_words(words, **options)
    rows = written(
        near.select("word", "n", "n_near", _where(is_form, "best").alias("form"), _where(is_form, "best_n").alias("form_n")), "spelling"
    )
    links = rows.where("form IS NOT NULL").select("word", F.col("form").alias("root"))
    while True:
        onward = links.select(F.col("word").alias("root"), F.col("root").alias("beyond"))
        longer = written(links.join(onward, "root", "left").select("word", "root", "beyond"), "spelling-roots")
        links = longer.select("word", F.coalesce("beyond", "root").alias("root"))
        if longer.where("beyond IS NOT NULL").isEmpty():
            break
    return rows.join(links, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")


def _where(condition: Column, name: str) -> Column:
    return F.when(condition, F.col(name))
