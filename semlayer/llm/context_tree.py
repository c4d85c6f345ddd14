"""Language-model scoring by context-tree weighting.

A text is the bytes of its lower-cased words, joined by one blank, and a line feed at the end.  A byte
is eight binary decisions; each decision (the bits before it in its byte) has a context tree of
its own over the DEPTH bytes before, nearest first.  A node's Krichevsky-Trofimov estimate of its training
counts is weighted, half and half, against the product of its children's weighted probabilities:

    P_w(s) = KT(s) / 2 + product of P_w(children) / 2,     P_w = KT at full depth.

From these follow the weights of stopping at each node of a path, and so the probability of each bit
as a mixture over all depths.  Below a context that training never saw there is nothing to mix, and
the deepest known node takes the rest of the weight.

The counts of all contexts of the corpus come from packed blocks: each batch of documents sends its
distinct byte sequences, grouped by the two nearest bytes, so that all nodes of depth two and more
of one group meet in one task.  Depths 0 and 1 have at most 257 contexts of 255 decisions,
whatever the corpus, and are combined on the driver.  Each batch gets back one log-probability for each
of its sequences.  Word counts for the base score take the same way.
"""

from __future__ import annotations

import math

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import words as W
from .components import written

DEPTH = 5
SEGMENT = 1 << 20
LOG_HALF = math.log(0.5)
U8 = np.uint64(8)


def log_gamma(x: np.ndarray) -> np.ndarray:
    """Stirling's series after a shift beyond 10; good to about 1e-12."""
    x = np.asarray(x, float)
    shift = np.zeros_like(x)
    for _ in range(10):
        small = x < 10
        shift = np.where(small, shift - np.log(np.where(small, x, 1.0)), shift)
        x = np.where(small, x + 1, x)
    series = 1 / (12 * x) - 1 / (360 * x**3) + 1 / (1260 * x**5) - 1 / (1680 * x**7)
    return shift + (x - 0.5) * np.log(x) - x + 0.5 * math.log(2 * math.pi) + series


def log_kt(n0: np.ndarray, n1: np.ndarray) -> np.ndarray:
    """log of the Krichevsky-Trofimov probability of n0 zeros and n1 ones."""
    return log_gamma(n0 + 0.5) + log_gamma(n1 + 0.5) - log_gamma(n0 + n1 + 1.0) - math.log(math.pi)


def streams(column) -> list[bytes]:
    """The bytes that are modelled, of each text."""
    texts = W.texts_of(column, lower=True)
    data = texts.data.tobytes()
    return [b" ".join(data[a:b].split()) + b"\n" for a, b in zip(texts.bounds[:-1], texts.bounds[1:])]


def sequences(parts: list[bytes]) -> np.ndarray:
    """Of every byte: its DEPTH predecessors, nearest first, and itself, as one number."""
    pad = b"\0" * DEPTH
    data = pad + pad.join(parts) + b"\0" * 8
    n = len(data) - DEPTH - 8
    # Eight bytes from each position on, the first in the lowest place: the nearest of DEPTH is the highest.
    before = np.ndarray(n, "<u8", data, strides=(1,)) & np.uint64((1 << 8 * DEPTH) - 1)
    code = (before << U8) | np.frombuffer(data, np.uint8)[DEPTH : DEPTH + n]
    own = np.ones(n, dtype=bool)
    begin = np.cumsum([len(p) + DEPTH for p in parts])[:-1]
    own[(begin[:, None] - np.arange(1, DEPTH + 1)).ravel()] = False
    return code[own]


def segments(parts: list[bytes]):
    """Runs of texts of about SEGMENT bytes, as index ranges."""
    low, total = 0, 0
    for i, p in enumerate(parts):
        total += len(p)
        if total >= SEGMENT or i == len(parts) - 1:
            yield low, i + 1
            low, total = i + 1, 0


def batch_sums(parts: list[bytes], train: list[bool]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct sequences of a batch and how often each occurs in training texts."""
    keys, counts = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for low, high in segments(parts):
        for learn in (True, False):
            mine = [p for p, t in zip(parts[low:high], train[low:high]) if t == learn]
            if mine:
                k, n = X.distinct_sums(sequences(mine))
                keys.append(k)
                counts.append(n if learn else np.zeros(len(k), np.int64))
    return X.distinct_sums(np.concatenate(keys), np.concatenate(counts))


def bucket_of(keys: np.ndarray, buckets: int) -> np.ndarray:
    """By the two nearest bytes."""
    near = keys >> np.uint64(8 * (DEPTH - 1))
    return (W.mixed(near + np.uint64(1)) % np.uint64(buckets)).astype(np.int64)


def grouped(keys: np.ndarray, buckets: int):
    """(bucket, positions of its keys in sorted order) for each bucket that has any."""
    if not len(keys):
        return
    bucket = bucket_of(keys, buckets)
    order = np.argsort(bucket, kind="stable")
    cut = np.flatnonzero(np.diff(bucket[order], prepend=-1))
    for low, high in zip(cut, [*cut[1:], len(order)]):
        yield int(bucket[order[low]]), order[low:high]


def decisions(keys: np.ndarray, depth: int) -> tuple[np.ndarray, np.ndarray]:
    """For each key its eight nodes at a depth (context, bits so far) and the bits decided there."""
    context = keys >> np.uint64(8 * (DEPTH - depth) + 8)
    byte = keys & np.uint64(255)
    nodes = np.empty((8, len(keys)), np.uint64)
    bits = np.empty((8, len(keys)), np.int64)
    for b in range(8):
        nodes[b] = (context << U8) | ((byte | np.uint64(256)) >> np.uint64(8 - b))
        bits[b] = (byte >> np.uint64(7 - b)) & np.uint64(1)
    return nodes, bits


def tree(keys: np.ndarray, counts: np.ndarray, top: int) -> dict[int, tuple[np.ndarray, ...]]:
    """Nodes of depths DEPTH to `top`: sorted codes, counts of zeros and ones, log KT and log P_w."""
    seen = counts > 0
    keys, counts = keys[seen], counts[seen].astype(float)
    out: dict[int, tuple[np.ndarray, ...]] = {}
    nodes, bits = decisions(keys, DEPTH)
    ones = (bits * counts).ravel()
    node, where = np.unique(nodes.ravel(), return_inverse=True)
    n1 = np.bincount(where, ones, len(node))
    n0 = np.bincount(where, np.tile(counts, 8), len(node)) - n1
    weighted = log_kt(n0, n1)
    out[DEPTH] = (node, n0, n1, weighted, weighted)
    for depth in range(DEPTH - 1, top - 1, -1):
        out[depth] = lifted(*out[depth + 1])
    return out


def lifted(node, n0, n1, _, weighted) -> tuple[np.ndarray, ...]:
    """The nodes one byte of context above."""
    above = ((node >> np.uint64(16)) << U8) | (node & np.uint64(255))
    parent, where = np.unique(above, return_inverse=True)
    p0, p1 = np.bincount(where, n0, len(parent)), np.bincount(where, n1, len(parent))
    own, children = log_kt(p0, p1), np.bincount(where, weighted, len(parent))
    return parent, p0, p1, own, LOG_HALF + np.logaddexp(own, children)


def stops(level: tuple[np.ndarray, ...], deepest: bool) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Codes, the probability of a one, and the weight of stopping at each node."""
    node, n0, n1, own, weighted = level
    stop = np.ones(len(node)) if deepest else np.exp(np.minimum(LOG_HALF + own - weighted, 0.0))
    return node, (n1 + 0.5) / (n0 + n1 + 1.0), stop


def log_probabilities(keys: np.ndarray, levels: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> np.ndarray:
    """log10 of the probability of each key's byte in its context."""
    at, known, bits = [], [], None
    for depth, (node, _, _) in enumerate(levels):
        wanted, bits = decisions(keys, depth)
        place = np.minimum(np.searchsorted(node, wanted.ravel()), max(len(node) - 1, 0))
        at.append(place)
        known.append(node[place] == wanted.ravel() if len(node) else np.zeros(place.shape, dtype=bool))
    p, rest = np.zeros(8 * len(keys)), np.ones(8 * len(keys))
    for depth, (node, one, stop) in enumerate(levels):
        if not len(node):
            continue
        deeper = known[depth + 1] if depth + 1 < len(levels) else np.zeros(len(p), dtype=bool)
        weight = np.where(known[depth], rest * np.where(deeper, stop[at[depth]], 1.0), 0.0)
        p += weight * np.where(bits.ravel() == 1, one[at[depth]], 1.0 - one[at[depth]])
        rest = rest - weight
    p += np.where(rest > 1e-12, rest * 0.5, 0.0)
    return np.log10(p).reshape(8, -1).sum(axis=0)


def words_in(column, train: list[bool]) -> tuple[W.Words, np.ndarray]:
    """Words of lower-cased texts, and whether each is of a training text."""
    found = W.words_of(W.texts_of(column, lower=True))
    return found, np.repeat(np.array(train, dtype=bool), np.diff(found.first))


def score_texts(documents: DataFrame) -> DataFrame:
    """Scores of each row of `documents` (doc_id, text, train boolean; null: not for training).

    doc_id, train, n_tokens (words and one end), n_known (tokens that training has), train_tokens, base_score
    (log10, add-one unigram), score (log10, context tree), bits_per_byte.  A null text is empty, and
    its one token is the end.
    """
    spark = documents.sparkSession
    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.col("text").cast("string").alias("text"),
        F.coalesce(F.col("train"), F.lit(False)).alias("train"),
    )
    total = X.text_bytes(docs)
    batches = max(2 * X.partitions_of(spark), -(-total // (16 << 20)))
    buckets = 2 * X.partitions_of(spark) + total // (64 << 20)
    dealt = X.in_batches(docs, batches, "doc_id", "text")

    def tree_blocks(table: pa.Table) -> pa.Table:
        keys, counts = batch_sums(streams(table["text"]), table["train"].to_pylist())
        rows = [(b, X.packed_keys(keys[at]), X.planes(counts[at].astype(np.uint32))) for b, at in grouped(keys, buckets)]
        batch = table["batch"][0].as_py()
        names = ["batch", "bucket", "keys", "weights"]
        kinds = [pa.int64(), pa.int64(), pa.binary(), pa.binary()]
        columns = list(zip(*((batch, *r) for r in rows))) or [[]] * 4
        return pa.table([pa.array(c, k) for c, k in zip(columns, kinds)], names)

    def merged(table: pa.Table) -> tuple[list[np.ndarray], np.ndarray, np.ndarray]:
        parts = [X.unpacked_keys(x) for x in table["keys"].to_pylist()]
        counts = np.concatenate([X.unplanes(x, np.uint32) for x in table["weights"].to_pylist()])
        return parts, *X.distinct_sums(np.concatenate(parts), counts)

    def upward(table: pa.Table) -> pa.Table:
        _, keys, counts = merged(table)
        node, n0, n1, _, weighted = tree(keys, counts, 2)[2]
        above = ((node >> np.uint64(16)) << U8) | (node & np.uint64(255))
        parent, where = np.unique(above, return_inverse=True)
        sums = [np.bincount(where, x, len(parent)).astype(float) for x in (n0, n1, weighted)]
        return pa.table({"node": parent.astype(np.int64), "n0": sums[0], "n1": sums[1], "weighted": sums[2]})

    blocks = dealt.groupBy("batch").applyInArrow(tree_blocks, X.BLOCK_SCHEMA)
    blocks = written(blocks, "context-tree")
    up = blocks.groupBy("bucket").applyInArrow(upward, "node bigint, n0 double, n1 double, weighted double")
    first = up.groupBy("node").agg(*(F.sum(c).alias(c) for c in ("n0", "n1", "weighted"))).toPandas().sort_values("node")
    n0, n1 = first["n0"].to_numpy(), first["n1"].to_numpy()
    own = log_kt(n0, n1)
    one = (first["node"].to_numpy().astype(np.uint64), n0, n1, own, LOG_HALF + np.logaddexp(own, first["weighted"].to_numpy()))
    top = [stops(lifted(*one), False), stops(one, False)]

    def answer(table: pa.Table) -> pa.Table:
        parts, keys, counts = merged(table)
        levels = tree(keys, counts, 2)
        below = [stops(levels[d], d == DEPTH) for d in range(2, DEPTH + 1)]
        value = np.empty(len(keys), np.float32)
        for low in range(0, len(keys), 100_000):
            value[low : low + 100_000] = log_probabilities(keys[low : low + 100_000], [*top, *below])
        sent = [X.planes(value[np.searchsorted(keys, part)]) for part in parts]
        return pa.table({"batch": table["batch"], "bucket": table["bucket"], "answers": pa.array(sent, pa.binary())})

    def word_keys(table: pa.Table):
        found, learn = words_in(table["text"], table["train"].to_pylist())
        return X.distinct_sums(found.code, learn)

    word_blocks = written(X.blocks_of(dealt, word_keys, X.bucket_count(spark, total, 40), np.uint32), "words")
    sums = word_blocks.groupBy("bucket").applyInArrow(
        lambda t: pa.table(dict(zip(("n", "v"), ([int(x)] for x in _totals(t))))), "n bigint, v bigint"
    )
    seen = sums.agg(F.sum("n").alias("n"), F.sum("v").alias("v")).first()
    ends = docs.where("train").count()
    tokens, distinct = (seen["n"] or 0) + ends, (seen["v"] or 0) + (1 if ends else 0)
    counts = X.answers_of(word_blocks, lambda total: total, np.uint32, np.uint64)
    marks = blocks.groupBy("bucket").applyInArrow(answer, X.ANSWER_SCHEMA)
    answers = marks.withColumn("kind", F.lit(0)).union(counts.withColumn("kind", F.lit(1)))

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        kind = answers["kind"].to_numpy()
        of = [answers.filter(pa.array(kind == k)) for k in (0, 1)]
        parts, train = streams(table["text"]), table["train"].to_pylist()
        keys, _ = batch_sums(parts, train)
        value = np.empty(len(keys), np.float64)
        sent = dict(zip(of[0]["bucket"].to_pylist(), of[0]["answers"].to_pylist()))
        for bucket, at in grouped(keys, buckets):
            value[at] = X.unplanes(sent[bucket], np.float32)
        score = np.empty(len(parts))
        for low, high in segments(parts):
            size = np.array([len(p) for p in parts[low:high]])
            each = X.looked_up(keys, value, sequences(parts[low:high]))
            score[low:high] = np.add.reduceat(each, np.cumsum(size) - size)
        found, _ = words_in(table["text"], train)
        word, _ = X.distinct_sums(found.code)
        count = X.looked_up(word, X.answered(of[1], len(word), np.uint64), found.code)
        scale = math.log10(tokens + distinct + 1)
        each = np.concatenate(([0.0], np.cumsum(np.log10(count + 1.0) - scale)))
        known = np.concatenate(([0], np.cumsum(count > 0)))
        low, high = found.first[:-1], found.first[1:]
        size = np.array([len(p) for p in parts])
        return pa.table(
            {
                "doc_id": table["doc_id"],
                "train": table["train"],
                "n_tokens": pa.array(high - low + 1, pa.int64()),
                "n_known": pa.array(known[high] - known[low] + (1 if ends else 0), pa.int64()),
                "train_tokens": pa.array(np.full(len(size), tokens), pa.int64()),
                "base_score": each[high] - each[low] + math.log10(ends + 1) - scale,
                "score": score,
                "bits_per_byte": -score / size * math.log2(10),
            }
        )

    return (
        dealt.groupBy("batch")
        .cogroup(answers.groupBy("batch"))
        .applyInArrow(
            finish,
            "doc_id bigint, train boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, "
            "score double, bits_per_byte double",
        )
    )


def _totals(table: pa.Table) -> tuple[int, int]:
    keys = np.concatenate([X.unpacked_keys(x) for x in table["keys"].to_pylist()])
    counts = np.concatenate([X.unplanes(x, np.uint32) for x in table["weights"].to_pylist()])
    _, total = X.distinct_sums(keys, counts)
    return total.sum(), (total > 0).sum()
