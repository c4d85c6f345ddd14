"""Benchmark decontamination by a prefix-filtered set join.

A window is `length` consecutive words of a benchmark item, or a whole shorter item.  Its set
is its shingles of three words.  A window is contained in a document only if all its shingles are,
so its prefix is one shingle, the rarest by occurrences in all documents.  A document position
whose shingle is in a prefix gives candidates; the shingle's place in the window says where the
window would start (positional bound), which has to fit into the document (length bound), and the
whole window is then verified there.

The benchmark's index is shipped to every task, so its size is checked: items are dealt to
blocks of at most `most_bytes` of text, and each block is one pass over the documents that adds to
the hits of the passes before.  Usual benchmarks are one block.
"""

from __future__ import annotations

import hashlib
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import exchange as X
from . import words as W
from .components import written

WINDOW = 10
SHINGLE = 3
MOST_BYTES = 16 << 20
#: Windows whose shingles are looked at together.
PART = 1 << 16


class Windows(NamedTuple):
    """The windows of some items, all of `size` words: their first words among `found`, and items."""

    size: int
    start: np.ndarray
    item: np.ndarray

    @property
    def shingle(self) -> int:
        return min(SHINGLE, self.size)


class Index(NamedTuple):
    """Distinct windows; those with the prefix key[i] are order[first[i]:first[i + 1]].

    `items` holds for each window the ids of the items that have it, sorted as strings.
    """

    key: np.ndarray
    first: np.ndarray
    order: np.ndarray
    offset: np.ndarray
    length: np.ndarray
    code: np.ndarray
    items: np.ndarray


def item_words(texts: list[str | None]) -> W.Words:
    return W.words_of(W.texts_of(pa.array(texts, pa.string()), lower=True), W.NOT_ALNUM_TABLE)


def item_windows(found: W.Words, length: int) -> list[Windows]:
    """Every window of every item, by number of words."""
    count = np.diff(found.first)
    groups = []
    for size in np.unique(np.minimum(count[count > 0], length)).tolist():
        of_size = np.repeat(np.minimum(count, length) == size, count)
        start = np.flatnonzero(W.whole_starts(found.first, size, len(found.code)) & of_size[: len(found.code) - size + 1])
        groups.append(Windows(size, start, np.searchsorted(found.first, start, "right") - 1))
    return groups


def shingles_at(found: W.Words, group: Windows, chosen: slice) -> np.ndarray:
    """A row of shingle codes for each of the chosen windows."""
    within = np.arange(group.size - group.shingle + 1)
    return W.sequence_codes(found.code, group.shingle)[group.start[chosen, None] + within]


def parts_of(group: Windows) -> list[slice]:
    return [slice(low, low + PART) for low in range(0, len(group.start), PART)]


def in_sorted(keys: np.ndarray, codes: np.ndarray) -> np.ndarray:
    """Positions of codes that are among the sorted keys; a bit table spares most searches."""
    if not len(keys) or not len(codes):
        return np.zeros(0, np.int64)
    mask = np.uint64((1 << 20) - 1)
    table = np.zeros(1 << 20, dtype=bool)
    table[keys & mask] = True
    near = np.flatnonzero(table[codes & mask])
    at = np.minimum(np.searchsorted(keys, codes[near]), len(keys) - 1)
    return near[keys[at] == codes[near]]


def occurrences(documents: DataFrame, keys: np.ndarray, lengths: list[int]) -> np.ndarray:
    """How often each of these shingles occurs in all documents, summed in each task first."""
    shared = documents.sparkSession.sparkContext.broadcast((keys, lengths))

    def run(batches):
        wanted, sizes = shared.value
        total = np.zeros(len(wanted), np.int64)
        for batch in (part for whole in batches for part in X.text_slices(whole)):
            found = W.words_of(W.texts_of(batch["text"], lower=True), W.NOT_ALNUM_TABLE)
            for size in sizes:
                codes = W.sequence_codes(found.code, size)
                at = in_sorted(wanted, codes)
                at = at[W.whole_starts(found.first, size, len(found.code))[at]]
                total += np.bincount(np.searchsorted(wanted, codes[at]), minlength=len(wanted))
        some = np.flatnonzero(total)
        yield pa.record_batch({"key": pa.array(W.long_id(wanted[some])), "n": pa.array(total[some])})

    counted = documents.select("text").mapInArrow(run, "key bigint, n bigint").groupBy("key").agg(F.sum("n").alias("n"))
    total = np.zeros(len(keys), np.int64)
    rows = counted.toArrow()
    total[np.searchsorted(keys, rows["key"].to_numpy().view(np.uint64))] = rows["n"].to_numpy()
    return total


def built(found: W.Words, groups: list[Windows], items: list[str], keys: np.ndarray, frequency: np.ndarray) -> Index:
    """The distinct windows under their rarest shingle, by its number of occurrences and then its code."""
    key, offset, length, code, owners = [], [], [], [], []
    for group in groups:
        codes = W.sequence_codes(found.code, group.size)[group.start]
        order = np.argsort(codes, kind="stable")
        _, first = np.unique(codes[order], return_index=True)
        for own in np.split(group.item[order], first[1:]):
            owners.append(sorted({items[i] for i in own.tolist()}))
        distinct = group._replace(start=group.start[order[first]])
        for part in parts_of(distinct):
            shingles = shingles_at(found, distinct, part)
            rows = np.arange(len(shingles))
            count = frequency[np.searchsorted(keys, shingles)]
            rarest = np.where(count == count.min(axis=1, keepdims=True), shingles, np.uint64(0xFFFFFFFFFFFFFFFF)).argmin(axis=1)
            key.append(shingles[rows, rarest])
            offset.append(rarest)
        length.append(np.full(len(first), group.size))
        code.append(codes[order[first]])
    key = np.concatenate([np.zeros(0, np.uint64), *key])
    order = np.argsort(key, kind="stable")
    distinct, first = np.unique(key[order], return_index=True)
    lists = np.empty(len(owners), object)
    lists[:] = owners
    return Index(
        distinct,
        np.append(first, len(key)),
        order,
        np.concatenate([np.zeros(0, np.int64), *offset]),
        np.concatenate([np.zeros(0, np.int64), *length]),
        np.concatenate([np.zeros(0, np.uint64), *code]),
        lists,
    )


def verified_windows(index: Index, found: W.Words, lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
    """(start, window) of every occurrence of a window in the texts, in order of the starts."""
    start, window, end_of = [], [], np.repeat(found.first[1:], np.diff(found.first))
    begin_of = np.repeat(found.first[:-1], np.diff(found.first))
    for size in lengths:
        codes = W.sequence_codes(found.code, size)
        at = in_sorted(index.key, codes)
        group = np.searchsorted(index.key, codes[at])
        count = index.first[group + 1] - index.first[group]
        within = np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
        w = index.order[np.repeat(index.first[group], count) + within]
        p = np.repeat(at, count)
        s = p - index.offset[w]
        keep = (np.minimum(SHINGLE, index.length[w]) == size) & (s >= begin_of[p]) & (s + index.length[w] <= end_of[p])
        start.append(s[keep])
        window.append(w[keep])
    s = np.concatenate(start) if start else np.zeros(0, np.int64)
    w = np.concatenate(window) if window else np.zeros(0, np.int64)
    right = np.zeros(len(s), dtype=bool)
    for size in np.unique(index.length[w]):
        mine = np.flatnonzero(index.length[w] == size)
        right[mine] = W.sequence_codes(found.code, int(size))[s[mine]] == index.code[w[mine]]
    s, w = s[right], w[right]
    order = np.argsort(s, kind="stable")
    return s[order], w[order]


def joined_spans(start: np.ndarray, end: np.ndarray) -> tuple[list[int], list[int]]:
    """Spans in order of their starts, those that overlap or touch as one."""
    reach = np.maximum.accumulate(end)
    new = np.flatnonzero(start[1:] > reach[:-1]) + 1
    return start[np.concatenate(([0], new))].tolist(), reach[np.append(new - 1, len(end) - 1)].tolist()


HITS = "doc_id bigint, text string, starts array<bigint>, ends array<bigint>, items array<string>"


def marked(documents: DataFrame, index: Index, lengths: list[int]) -> DataFrame:
    """The rows with the word spans and items that this index adds."""
    shared = documents.sparkSession.sparkContext.broadcast((tuple(index), lengths))

    def run(batches):
        fields, sizes = shared.value
        own = Index(*fields)
        for batch in (part for whole in batches for part in X.text_slices(whole)):
            found = W.words_of(W.texts_of(batch["text"], lower=True), W.NOT_ALNUM_TABLE)
            s, w = verified_windows(own, found, sizes)
            rows = {name: batch[name].to_pylist() for name in ("starts", "ends", "items")}
            text = np.searchsorted(found.first, s, "right") - 1
            hit, low = np.unique(text, return_index=True)
            for row, a, b in zip(hit.tolist(), low.tolist(), np.append(low[1:], len(text)).tolist()):
                start = s[a:b] - found.first[row]
                starts, ends = joined_spans(start, start + own.length[w[a:b]])
                rows["starts"][row] = rows["starts"][row] + starts
                rows["ends"][row] = rows["ends"][row] + ends
                items = set(rows["items"][row])
                items.update(*own.items[np.unique(w[a:b])])
                rows["items"][row] = sorted(items)
            longs = pa.list_(pa.int64())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "text": batch["text"],
                    "starts": pa.array(rows["starts"], longs),
                    "ends": pa.array(rows["ends"], longs),
                    "items": pa.array(rows["items"], pa.list_(pa.string())),
                }
            )

    return documents.mapInArrow(X.given_back(run), HITS)


def summed_up(documents: DataFrame) -> DataFrame:
    def run(batches):
        for batch in (part for whole in batches for part in X.text_slices(whole)):
            first = W.words_of(W.texts_of(batch["text"], lower=True), W.NOT_ALNUM_TABLE).first
            n_words, n_hit, digest, spans = np.diff(first), [], [], []
            for n, starts, ends, items in zip(n_words, *(batch[c].to_pylist() for c in ("starts", "ends", "items"))):
                hit = np.zeros(n, dtype=bool)
                for s, e in zip(starts, ends):
                    hit[s:e] = True
                edge = np.flatnonzero(np.diff(np.concatenate(([0], hit.astype(np.int8), [0]))))
                spans.append([{"start": s, "end": e} for s, e in zip(edge[::2].tolist(), edge[1::2].tolist())])
                n_hit.append(int(hit.sum()))
                digest.append(hashlib.sha256(",".join(items).encode()).hexdigest())
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_words": pa.array(n_words.astype(np.int64)),
                    "n_hit": pa.array(n_hit, pa.int64()),
                    "n_items": pa.array([len(x) for x in batch["items"].to_pylist()], pa.int64()),
                    "items_sha256": pa.array(digest, pa.string()),
                    "contaminated": pa.array([n > 0 for n in n_hit], pa.bool_()),
                    "items": batch["items"],
                    "spans": pa.array(spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())]))),
                }
            )

    return documents.mapInArrow(
        run,
        "doc_id bigint, n_words bigint, n_hit bigint, n_items bigint, items_sha256 string, contaminated boolean, "
        "items array<string>, spans array<struct<start:bigint,end:bigint>>",
    )


def contamination(
    documents: DataFrame, benchmark: DataFrame, length: int = WINDOW, most_bytes: int = MOST_BYTES
) -> DataFrame:
    """One row for each row of `documents` (doc_id, text) against `benchmark` (item_id, text).

    n_words, n_hit (words inside any occurrence of a window), n_items and `items` (ids of the items with
    an occurring window, sorted as strings), items_sha256 of these joined by commas,
    contaminated, and `spans`, the hit word positions, end exclusive.  A null or empty text has no words and
    an item without words has no window.  Items without an id are left out; repeated ones count once.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    empty = (F.array().cast(f"array<{t}>").alias(c) for c, t in (("starts", "bigint"), ("ends", "bigint"), ("items", "string")))
    rows = docs.select("doc_id", "text", *empty)
    items = benchmark.where("item_id is not null").select(
        F.col("item_id").cast("string").alias("item_id"), F.col("text").cast("string").alias("text")
    ).distinct()
    blocks = max(1, -(-X.text_bytes(items) // most_bytes))
    for block in range(blocks):
        part = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()
        found = item_words([row["text"] for row in part])
        groups = item_windows(found, length)
        lengths = sorted({group.shingle for group in groups})
        pieces = [np.unique(shingles_at(found, group, chosen)) for group in groups for chosen in parts_of(group)]
        keys = np.unique(np.concatenate([np.zeros(0, np.uint64), *pieces]))
        frequency = occurrences(docs, keys, lengths) if len(keys) else np.zeros(0, np.int64)
        index = built(found, groups, [row["item_id"] for row in part], keys, frequency)
        rows = marked(rows if block == 0 else written(rows, "decontamination"), index, lengths)
    return summed_up(rows)
