"""Substring deduplication by Rabin-Karp hashes of every window of words.

Every window of `length` consecutive words of a document gets a rolling hash.  Spark counts the
hashes of the whole corpus in packed blocks (see `exchange`); windows that occur more than once
merge into maximal intervals, and the words these cover are removed.

Windows are judged on the input: if two documents share a passage, both lose it, and exact
copies lose every word that lies in a window.  A document with fewer words than `length` has no
window and keeps everything.  A null text has no words.  Equal windows are always found; two
different ones are taken for equal with a probability of 2**-64 a pair.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import words as W

WINDOW = 35
COLUMNS = "doc_id bigint, n_words bigint, n_removed bigint, kept_sha256 string, removed array<struct<start:bigint,end:bigint>>"


def _windows(table: pa.Table, length: int) -> tuple[W.Texts, W.Words, np.ndarray, np.ndarray]:
    texts = W.texts_of(table["text"], lower=False)
    found = W.words_of(texts)
    codes = W.sequence_codes(found.code, length)
    return texts, found, codes, W.whole_starts(found.first, length, len(found.code))


def covered(repeated: np.ndarray, n_words: int, length: int) -> np.ndarray:
    """Which words lie in a repeated window, given which positions start one."""
    change = np.zeros(n_words + 1, np.int64)
    at = np.flatnonzero(repeated)
    np.add.at(change, at, 1)
    np.add.at(change, at + length, -1)
    return np.cumsum(change[:-1]) > 0


def intervals(flags: np.ndarray) -> list[tuple[int, int]]:
    """Maximal runs of true, end exclusive."""
    edge = np.flatnonzero(np.diff(np.concatenate(([0], flags.astype(np.int8), [0]))))
    return list(zip(edge[::2].tolist(), edge[1::2].tolist()))


def remove_repeated_windows(documents: DataFrame, length: int = WINDOW) -> DataFrame:
    """One row for each row of `documents` (doc_id, text; other columns are ignored).

    Returns doc_id, n_words, n_removed, kept_sha256 (of the kept words joined by one blank) and
    `removed`, the maximal intervals of removed word positions, end exclusive.
    """
    spark = documents.sparkSession
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    total = X.text_bytes(docs)
    buckets = X.bucket_count(spark, total)
    dealt = X.in_batches(docs, X.batch_count(spark, total), "doc_id", "text")

    def extract(table: pa.Table):
        _, _, codes, fits = _windows(table, length)
        keys, count = X.distinct_sums(codes[fits])
        return keys, np.minimum(count, 2)

    def finish(table: pa.Table, answers: pa.Table) -> pa.Table:
        texts, found, codes, fits = _windows(table, length)
        keys, _ = X.distinct_sums(codes[fits])
        repeated_keys = keys[X.answered(answers, len(keys), np.uint8) > 0]
        repeated = np.zeros(len(codes), dtype=bool)
        if len(repeated_keys):
            near = np.minimum(np.searchsorted(repeated_keys, codes), len(repeated_keys) - 1)
            repeated = fits & (repeated_keys[near] == codes)
        gone = covered(repeated, len(found.code), length)
        ids, n_words, n_removed, digest, spans = table["doc_id"], [], [], [], []
        data = texts.data.tobytes()
        for i in range(len(ids)):
            low, high = found.first[i], found.first[i + 1]
            mine = gone[low:high]
            kept = data[texts.bounds[i] : texts.bounds[i + 1]].split() if high > low else []
            if len(kept) != high - low:
                kept = [data[s:e] for s, e in zip(found.start[low:high], found.end[low:high])]
            runs = intervals(mine) if mine.any() else []
            for s, e in reversed(runs):
                del kept[s:e]
            n_words.append(int(high - low))
            n_removed.append(int(mine.sum()))
            digest.append(hashlib.sha256(b" ".join(kept)).hexdigest())
            spans.append([{"start": s, "end": e} for s, e in runs])
        kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))
        return pa.table(
            {
                "doc_id": ids,
                "n_words": pa.array(n_words, pa.int64()),
                "n_removed": pa.array(n_removed, pa.int64()),
                "kept_sha256": pa.array(digest, pa.string()),
                "removed": pa.array(spans, kind),
            }
        )

    blocks = X.blocks_of(dealt, extract, buckets, np.uint8)
    answers = X.answers_of(blocks, lambda total: total > 1, np.uint8, np.uint8)
    return dealt.groupBy("batch").cogroup(answers.groupBy("batch")).applyInArrow(finish, COLUMNS)
