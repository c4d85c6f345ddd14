"""A corpus-wide exchange of hashed keys in packed blocks.

Counting every window or shingle of a corpus as a row of its own costs a shuffle of many times
the text.  Here documents are dealt to batches of a few megabytes; each batch sends its sorted
distinct keys with their local weights as one binary block for each range of keys; a range gets
one block from each batch, adds up, and answers every batch with one value for each key it sent.
A key of a third of all rows is one entry for each batch, whatever its count.

Batches are dealt by a hash of the document, so a batch that is computed again on another
executor has the same rows, and its blocks do not depend on their order.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MB = 1 << 20
BLOCK_SCHEMA = "batch bigint, bucket bigint, keys binary, weights binary"
ANSWER_SCHEMA = "batch bigint, bucket bigint, answers binary"


def text_bytes(documents: DataFrame, text: str = "text") -> int:
    """Bytes of all texts; one narrow aggregate."""
    return int(documents.agg(F.sum(F.octet_length(F.col(text).cast("string")))).first()[0] or 0)


def partitions_of(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def text_slices(batch: pa.RecordBatch, column: str = "text", most: int = 2 * MB) -> Iterator[pa.RecordBatch]:
    """Runs of rows of about `most` bytes of a string column, and one row at least: bounds what becomes Python objects."""
    size = np.cumsum(pc.fill_null(pc.binary_length(batch[column]), 0).to_numpy(zero_copy_only=False).astype(np.int64))
    low = 0
    while low < batch.num_rows:
        high = max(low + 1, int(np.searchsorted(size, (size[low - 1] if low else 0) + most, "right")))
        yield batch.slice(low, high - low)
        low = high


def give_back() -> None:
    """Returns freed memory to the system: Python workers live on."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # not the C library of GNU
        pass


def given_back(run: Callable) -> Callable:
    """A function of batches that returns freed memory to the system at its end."""

    def wrapped(batches):
        yield from run(batches)
        give_back()

    return wrapped


def list_column(values: list[np.ndarray]) -> pa.ListArray:
    """A column of lists of 64-bit numbers from arrays, without an object for each number."""
    low = np.cumsum([0, *map(len, values)]).astype(np.int32)
    return pa.ListArray.from_arrays(pa.array(low), pa.array(np.concatenate([np.zeros(0, np.int64), *values])))


def batch_count(spark: SparkSession, total: int) -> int:
    """Batches of 4 to 64 MB of text, and enough of them to occupy every shuffle partition."""
    size = min(64 * MB, max(4 * MB, total // 4096))
    return max(2 * partitions_of(spark), -(-total // size))


def bucket_count(spark: SparkSession, total: int, key_bytes: int = 6, most: int = 2_000_000) -> int:
    """Key ranges of about `most` keys at one key for `key_bytes` bytes of text."""
    return max(2 * partitions_of(spark), -(-total // (key_bytes * most)))


def planes(values: np.ndarray) -> bytes:
    """Fixed-width integers as byte planes, so that leading zeros lie together for the codec."""
    return np.ascontiguousarray(values.view(np.uint8).reshape(len(values), values.itemsize).T).tobytes()


def unplanes(data: bytes, kind: type) -> np.ndarray:
    width = np.dtype(kind).itemsize
    flat = np.frombuffer(data, np.uint8).reshape(width, -1).T
    return np.ascontiguousarray(flat).view(kind).reshape(-1)


def packed_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as byte planes of their differences."""
    return planes(np.diff(keys, prepend=np.uint64(0)))


def unpacked_keys(data: bytes) -> np.ndarray:
    return np.cumsum(unplanes(data, np.uint64), dtype=np.uint64)


def cuts(keys: np.ndarray, buckets: int) -> np.ndarray:
    """Where sorted keys pass from one of `buckets` equal ranges to the next."""
    edges = np.array([(b << 64) // buckets for b in range(1, buckets)], dtype=np.uint64)
    return np.concatenate(([0], np.searchsorted(keys, edges), [len(keys)]))


def distinct_sums(keys: np.ndarray, weights: np.ndarray | None = None, own: bool = False) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct keys and the sum of the weights of each (without weights, its count).

    With `own`, keys without weights are sorted in place: nobody else reads them.
    """
    if len(keys) == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    if weights is None:
        if own:
            keys.sort()
        else:
            keys = np.sort(keys)
    else:
        order = np.argsort(keys, kind="stable")
        keys, weights = keys[order], weights[order]
        del order
    head = np.empty(len(keys), dtype=bool)
    head[0] = True
    np.not_equal(keys[1:], keys[:-1], out=head[1:])
    at = np.flatnonzero(head)
    del head
    distinct = keys[at]
    if weights is not None:
        return distinct, np.add.reduceat(weights, at, dtype=np.int64)
    count = np.empty_like(at)
    np.subtract(at[1:], at[:-1], out=count[:-1])
    count[-1] = len(keys) - at[-1]
    return distinct, count


def looked_up(keys: np.ndarray, values: np.ndarray, codes: np.ndarray, most: int = 1 << 18) -> np.ndarray:
    """The value of each code, by its place among the sorted distinct keys, which hold it.

    `most` codes at a time are sorted first: equal ones are searched once, and the search passes the
    keys in order instead of anywhere in memory.
    """
    found = np.empty(len(codes), values.dtype)
    for low in range(0, len(codes), most):
        at = np.argsort(codes[low : low + most])
        run = codes[low : low + most][at]
        head = np.flatnonzero(np.concatenate(([True], run[1:] != run[:-1])))
        each = values[np.searchsorted(keys, run[head])]
        found[low : low + most][at] = np.repeat(each, np.diff(head, append=len(run)))
    return found


def planes_column(parts: Iterator[np.ndarray], cut: np.ndarray, kind: type) -> pa.Array:
    """The byte planes of each part, as a binary column; part i has the values cut[i]:cut[i + 1] of all."""
    width = np.dtype(kind).itemsize
    data = np.empty(width * int(cut[-1]), np.uint8)
    for values, low, high in zip(parts, cut[:-1].tolist(), cut[1:].tolist()):
        data[width * low : width * high].reshape(width, -1)[:] = values.view(np.uint8).reshape(-1, width).T
    return pa.Array.from_buffers(pa.binary(), len(cut) - 1, [None, pa.py_buffer((width * cut).astype(np.int32)), pa.py_buffer(data)])


def block_rows(batch: int, keys: np.ndarray, weights: np.ndarray, buckets: int) -> pa.Table:
    """One row for each bucket that has keys of this batch."""
    cut = cuts(keys, buckets)
    full = np.flatnonzero(cut[1:] > cut[:-1])
    cut = np.append(cut[:-1][full], len(keys)).astype(np.int64)
    spans = [slice(*ends) for ends in zip(cut[:-1].tolist(), cut[1:].tolist())]
    steps = (np.diff(keys[own], prepend=np.uint64(0)) for own in spans)
    return pa.table(
        {
            "batch": pa.array(np.full(len(full), batch, np.int64)),
            "bucket": pa.array(full.astype(np.int64)),
            "keys": planes_column(steps, cut, np.uint64),
            "weights": planes_column((weights[own] for own in spans), cut, weights.dtype),
        }
    )


def in_batches(documents: DataFrame, batches: int, *by: str) -> DataFrame:
    """A column `batch`, dealt by a hash of the columns `by`."""
    return documents.withColumn("batch", F.pmod(F.xxhash64(*by), F.lit(batches)))


def blocks_of(dealt: DataFrame, extract: Callable, buckets: int, kind: type) -> DataFrame:
    """Blocks of each batch; extract(table) gives its sorted distinct keys and their weights."""

    def make(table: pa.Table) -> pa.Table:
        keys, weights = extract(table)
        weights = weights.astype(kind)
        rows = block_rows(table["batch"][0].as_py(), keys, weights, buckets)
        del keys, weights
        give_back()
        return rows

    return dealt.groupBy("batch").applyInArrow(make, BLOCK_SCHEMA)


def answers_of(blocks: DataFrame, answer: Callable, kind: type, out: type) -> DataFrame:
    """For each batch and bucket, answer(totals) of each key it sent, in the order of its keys."""

    def add_up(table: pa.Table) -> pa.Table:
        distinct, total = distinct_sums(
            np.concatenate([unpacked_keys(x.as_buffer()) for x in table["keys"]]),
            np.concatenate([unplanes(x.as_buffer(), kind) for x in table["weights"]]),
        )
        values = answer(total).astype(out)
        del total
        # Keys are unpacked again, a block at a time, rather than kept beside the sums.
        sent = (planes(values[np.searchsorted(distinct, unpacked_keys(x.as_buffer()))]) for x in table["keys"])
        rows = pa.table({"batch": table["batch"], "bucket": table["bucket"], "answers": pa.array(sent, pa.binary())})
        del distinct, values, sent
        give_back()
        return rows

    return blocks.groupBy("bucket").applyInArrow(add_up, ANSWER_SCHEMA)


def answered(table: pa.Table, n_keys: int, out: type) -> np.ndarray:
    """The answers to one batch in the order of its sorted distinct keys."""
    rows = sorted(zip(table["bucket"].to_pylist(), table["answers"].to_pylist()))
    values = np.concatenate([unplanes(x, out) for _, x in rows]) if rows else np.zeros(0, out)
    if len(values) != n_keys:
        raise ValueError(f"{len(values)} answers to {n_keys} keys")
    return values
