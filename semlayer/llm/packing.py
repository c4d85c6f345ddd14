"""Packing in the order of a space-filling curve.

A document's tokens are hashed into a vector, projected to three dimensions by fixed random signs and
scaled by its length, so documents of like vocabulary lie close together.  Their Hilbert keys sort
the corpus by ranges; the tokens of neighbouring documents follow one another without gaps, and
a sequence is every 4096 of them.  Only the last sequence of the corpus is padded.

Tokens are made once and written to the shared folder.  Range borders come from quantiles of the keys,
which carry some bits of doc_id and text, so a group of copies spreads over ranges.  Token
totals of the ranges (a number for each) give every range the place of its first token, and
the ranges then place their documents independently.
"""

from __future__ import annotations

import json
import os
import re
import sys
import types
import zlib
from collections.abc import Callable
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .components import written
from .exchange import MB, given_back, partitions_of, text_bytes, text_slices
from .words import mixed

LENGTH = 4096
END = 2
DIMENSIONS = 3
BITS = 8
#: Bytes of words, and of units, with their ids, that a worker remembers.
REMEMBERED_BYTES = 12 << 20
#: Units that are encoded in one call.
UNITS_A_CALL = 8192
#: A special token of the tokenizer, which always stands alone.
SEPARATOR = "<|endoftext|>"
SEED = 4096


def hilbert_keys(points: np.ndarray, bits: int) -> np.ndarray:
    """Hilbert indexes of rows of integers below 2**bits (Skilling's transform)."""
    x = points.T.astype(np.int64).copy()
    n = len(x)
    q = 1 << (bits - 1)
    while q > 1:
        p = q - 1
        for i in range(n):
            flip = (x[i] & q) > 0
            swap = (x[0] ^ x[i]) & p
            x[0] = np.where(flip, x[0] ^ p, x[0] ^ swap)
            x[i] = np.where(flip, x[i], x[i] ^ swap)
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    t = np.zeros(x.shape[1], np.int64)
    q = 1 << (bits - 1)
    while q > 1:
        t = np.where((x[n - 1] & q) > 0, t ^ (q - 1), t)
        q >>= 1
    x ^= t
    key = np.zeros(x.shape[1], np.int64)
    for b in range(bits - 1, -1, -1):
        for i in range(n):
            key = (key << 1) | ((x[i] >> b) & 1)
    return key


def signs(vocabulary: int) -> np.ndarray:
    """A fixed direction for each token id: hashed to 1,024 cells, each cell a random vector."""
    cell = (mixed(np.arange(vocabulary, dtype=np.uint64)) & np.uint64(1023)).astype(np.int64)
    return np.random.default_rng(SEED).normal(size=(1024, DIMENSIONS))[cell]


def curve_keys(ids: np.ndarray, low: np.ndarray, directions: np.ndarray) -> np.ndarray:
    """The Hilbert keys of documents ids[low[i]:low[i + 1]]; each has an id at least, its END."""
    if len(low) < 2:
        return np.zeros(0, np.int64)
    sums = np.add.reduceat(directions[ids % len(directions)], low[:-1])
    mean = sums / np.diff(low)[:, None]
    points = ((np.tanh(2.0 * mean) + 1) * (1 << (BITS - 1))).astype(np.int64)
    return hilbert_keys(np.clip(points, 0, (1 << BITS) - 1), BITS)


# The tokenizer's own split of lower-cased text, for characters up to U+00FF.  Fixed values.
LETTERS = "a-z\xaa\xb5\xba\xdf-\xf6\xf8-\xff"
NUMBERS = "0-9\xb2\xb3\xb9\xbc-\xbe"
#: How the tokenizer that is encoded by units describes itself.  Fixed values.
BLANKS_TO_ONE = {"Regex": "\\s+"}
UNIT_PATTERN = {"Regex": "'s|'t|'re|'ve|'m|'ll|'d|[\\p{L}]+|[\\p{N}]|[^\\s\\p{L}\\p{N}]+"}
UNITS = re.compile(
    f"\n|'s|'t|'re|'ve|'m|'ll|'d|[{LETTERS}]+|[{NUMBERS}]|[^\t-\r \x85\xa0{LETTERS}{NUMBERS}]+"
)
#: What a word must not hold for that split: other scripts, or the form of a special token.
OTHER = r"[^\x{0}-\x{ff}]|<\|"


class Ids(NamedTuple):
    """Ids of some strings one after another; those of string i are all[low[i]:low[i + 1]]."""

    all: np.ndarray
    low: np.ndarray

    def at(self, index: np.ndarray) -> Ids:
        """The ids of the strings of `index`, in that order."""
        each = np.diff(self.low)[index]
        low = np.concatenate((np.zeros(1, np.int64), np.cumsum(each)))
        return Ids(self.all[np.arange(low[-1]) + np.repeat(self.low[index] - low[:-1], each)], low)

    def and_then(self, *more: Ids) -> Ids:
        lows = [self.low]
        for part in more:
            lows.append(lows[-1][-1] + part.low[1:])
        return Ids(np.concatenate([self.all, *(part.all for part in more)]), np.concatenate(lows))


NO_IDS = Ids(np.zeros(0, "<u4"), np.zeros(1, np.int64))


def ids_of(parts: list[list[int]]) -> Ids:
    low = np.cumsum([0, *map(len, parts)], dtype=np.int64)
    return Ids(np.fromiter((i for part in parts for i in part), "<u4", low[-1]), low)


def between(ids: np.ndarray, mark: int, parts: int) -> Ids:
    """The ids of so many parts that marks separate."""
    marks = ids == mark if parts > 1 else np.zeros(len(ids), dtype=bool)
    cut = np.flatnonzero(marks)
    if len(cut) != parts - 1:
        raise ValueError(f"{len(cut)} marks between {parts} parts")
    return Ids(ids[~marks], np.concatenate(([0], cut - np.arange(len(cut)), [len(ids) - len(cut)])))


class Remembered:
    """Ids of strings; beyond a bound, those that were met again since the last time stay.

    The first string is one that no text yields, with the ids given for it.
    """

    def __init__(self, first: str, ids: list[int]):
        self.keys, self.ids, self.again = pa.array([first], pa.string()), ids_of([ids]), np.ones(1, dtype=bool)

    def bound(self) -> None:
        if self.keys.nbytes + sum(x.nbytes for x in self.ids) <= REMEMBERED_BYTES:
            return
        kept = np.flatnonzero(self.again)
        if 2 * len(kept) > len(self.keys):
            kept = kept[:1]
        self.keys, self.ids = self.keys.take(pa.array(kept)), self.ids.at(kept)
        self.again = np.zeros(len(kept), dtype=bool)
        self.again[0] = True

    def places(self, wanted: pa.Array, learned: Callable) -> np.ndarray:
        """Which of its strings each distinct one of `wanted` is; learned(strings) gives the ids of new ones."""
        self.bound()
        found = pc.index_in(wanted, value_set=self.keys)
        new = np.flatnonzero(found.is_null().to_numpy(zero_copy_only=False))
        place = found.fill_null(0).to_numpy().astype(np.int64)
        self.again[place] = True
        place[new] = len(self.keys) + np.arange(len(new))
        if len(new):
            strings = wanted.take(pa.array(new))
            self.ids = self.ids.and_then(learned(strings))
            self.keys = pa.concat_arrays([self.keys, strings])
            self.again = np.concatenate((self.again, np.zeros(len(new), dtype=bool)))
        return place


def remembered(path: str) -> tuple[Remembered, Remembered]:
    """What a Python worker keeps of a tokenizer from task to task: words, and units."""
    state = sys.modules.setdefault("semlayer_worker_state", types.ModuleType("semlayer_worker_state"))
    kept = state.__dict__.setdefault("units", {})
    if path not in kept:
        kept.clear()
        kept[path] = Remembered(" ", [END]), Remembered("\n", [])
    return kept[path]


def split_as_units(tokenizer) -> bool:
    """Whether a tokenizer lower-cases and splits words as UNITS does, each byte a letter of its model."""
    if tokenizer.normalizer is None or tokenizer.pre_tokenizer is None:
        return False
    steps = json.loads(tokenizer.normalizer.__getstate__()).get("normalizers", [])
    splits = json.loads(tokenizer.pre_tokenizer.__getstate__()).get("pretokenizers", [])
    if [step["type"] for step in steps] != ["NFC", "Replace", "Lowercase"] or steps[1]["pattern"] != BLANKS_TO_ONE:
        return False
    if len(splits) != 2 or splits[0].get("pattern") != UNIT_PATTERN or splits[1]["type"] != "ByteLevel":
        return False
    return not splits[1]["add_prefix_space"] and not splits[1].get("use_regex", True)


def strings_of(strings: pa.Array) -> list[str]:
    return strings.to_numpy(zero_copy_only=False).tolist()


class UnitEncoder:
    """Ids of whole texts, from ids of their distinct words where the tokenizer splits texts into units.

    No unit goes across ASCII white space, so each distinct word is encoded once.  Words of other scripts, or
    with the form of a special token, go through the whole tokenizer; the others are split and
    lower-cased here, and their distinct units meet the tokenizer's model alone.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer
        from tokenizers.pre_tokenizers import ByteLevel, Split

        self.tokenizer = Tokenizer.from_file(path)
        self.by_units = split_as_units(self.tokenizer)
        self.separator = self.tokenizer.token_to_id(SEPARATOR)
        self.words, self.units = remembered(path)
        if self.by_units:
            level = ByteLevel(add_prefix_space=False, use_regex=False)
            self.letters = {c: "".join(part for part, _ in level.pre_tokenize_str(chr(c))) for c in range(256)}
            self.model = Tokenizer(self.tokenizer.model)
            self.model.pre_tokenizer = Split(self.letters[10], "isolated")
            (self.mark,) = self.model.encode(self.letters[10], add_special_tokens=False).ids

    def _whole(self, words: list[str]) -> Ids:
        """Ids of words by the whole tokenizer; the separator's id shows where each ends."""
        (coded,) = self.tokenizer.encode_batch_fast([SEPARATOR.join(words)], add_special_tokens=False)
        return between(np.array(coded.ids, "<u4"), self.separator, len(words))

    def _of_units(self, units: pa.Array) -> Ids:
        """Ids of units by the model; the line feed's id shows where each ends."""
        ids = []
        for low in range(0, len(units), UNITS_A_CALL):
            some = strings_of(units[low : low + UNITS_A_CALL])
            (coded,) = self.model.encode_batch_fast(["\n".join(some).translate(self.letters)], add_special_tokens=False)
            ids.append(between(np.array(coded.ids, "<u4"), self.mark, len(some)))
        return NO_IDS.and_then(*ids)

    def _of_words(self, words: pa.Array) -> Ids:
        """Ids of distinct words."""
        other = pc.match_substring_regex(words, OTHER).to_numpy(zero_copy_only=False)
        plain = strings_of(words.filter(pa.array(~other)))
        split = pa.array(UNITS.findall("\n".join([*plain, ""]).lower()) if plain else [], pa.string()).dictionary_encode()
        units = self.units.places(split.dictionary, self._of_units)[split.indices.to_numpy()]
        laid = self.units.ids.at(units)
        ids = Ids(laid.all, np.concatenate(([0], laid.low[1:][units == 0])))
        if not other.any():
            return ids
        rest = strings_of(words.filter(pa.array(other)))
        apart = [w for w in rest if SEPARATOR in w]
        joined = [w for w in rest if SEPARATOR not in w]
        ids = ids.and_then(*([self._whole(joined)] if joined else []), *(self._whole([w]) for w in apart))
        place = {w: i for i, w in enumerate([*joined, *apart], len(plain))}
        index = np.cumsum(~other) - 1
        index[other] = [place[w] for w in rest]
        return ids.at(index)

    def coded(self, texts: pa.Array) -> Ids:
        """Ids of each text and END."""
        texts = pc.fill_null(texts, "")
        if not self.by_units:
            coded = self.tokenizer.encode_batch_fast(texts.to_pylist(), add_special_tokens=False)
            return ids_of([[*one.ids, END] for one in coded])
        split = pc.ascii_split_whitespace(texts)
        words, bounds = split.flatten().dictionary_encode(), split.offsets.to_numpy().astype(np.int64)
        place = self.words.places(words.dictionary, self._of_words)
        ids, low = self.words.ids.at(np.insert(place[words.indices.to_numpy()], bounds[1:], 0))
        return Ids(ids, low[bounds + np.arange(len(bounds))])

    def encode(self, texts: list[str]) -> list[bytes]:
        """Ids of each text and END, as 32-bit little-endian numbers."""
        ids, low = self.coded(pa.array(texts, pa.string()))
        return [ids[a:b].tobytes() for a, b in zip(low[:-1], low[1:])]


TOKENS = "doc_id bigint, curve bigint, doc_tokens bigint, ids binary"


def tokenized(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, curve (sort key), doc_tokens and ids (32-bit little-endian) of each row."""

    def run(batches):
        encoder, directions = UnitEncoder(path), signs(1 << 16)
        for batch in (part for whole in batches for part in text_slices(whole, most=3 * MB)):
            ids, low = encoder.coded(batch["text"])
            key = curve_keys(ids, low, directions)
            salt = batch["salt"].to_numpy() & ((1 << 32) - 1)
            buffers = [None, pa.py_buffer((4 * low).astype(np.int32)), pa.py_buffer(ids)]
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "curve": pa.array((key << 32) | salt, pa.int64()),
                    "doc_tokens": pa.array(np.diff(low)),
                    "ids": pa.Array.from_buffers(pa.binary(), batch.num_rows, buffers),
                }
            )

    docs = documents.select(
        F.col("doc_id").cast("bigint").alias("doc_id"),
        F.xxhash64("doc_id", F.col("text").cast("string")).alias("salt"),
        F.col("text").cast("string").alias("text"),
    )
    return docs.mapInArrow(given_back(run), TOKENS)


PIECES = (
    "doc_id bigint, start bigint, length bigint, ids_crc32 bigint, doc_tokens bigint, sequence_id bigint, "
    "offset bigint, curve bigint"
)


def packed(documents: DataFrame, path: str, length: int = LENGTH, with_ids: bool = False) -> DataFrame:
    """Pieces of all rows of `documents` (doc_id, text) in sequences of `length` tokens.

    doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, curve; with `with_ids` also the ids
    of each piece.  A document ends with END; a null text is empty and has that token only.
    """
    spark = documents.sparkSession
    slots = max(2 * partitions_of(spark), -(-text_bytes(documents) // (64 << 20)))
    rows = written(tokenized(documents, path), "tokens")
    splits = rows.agg(
        F.percentile_approx("curve", F.array(*(F.lit(i / slots) for i in range(1, slots))), 10 * slots).alias("at")
    ).first()["at"]
    splits = sorted(set(splits or []))
    edges = F.array(*map(F.lit, splits)) if splits else F.array().cast("array<bigint>")
    dealt = rows.withColumn("slot", F.size(F.filter(edges, lambda edge: edge < F.col("curve"))))
    totals = sorted(map(tuple, dealt.groupBy("slot").agg(F.sum("doc_tokens").alias("n")).collect()))
    first, at = {}, 0
    for slot, n in totals:
        first[slot] = at
        at += n

    def run(batches):
        slot, place = None, 0
        for batch in batches:
            out = []
            columns = [batch[c].to_pylist() for c in ("slot", "doc_id", "curve", "doc_tokens")]
            for own, doc_id, curve, n, ids in zip(*columns, batch["ids"]):
                ids = ids.as_py()
                if own != slot:
                    slot, place = own, first[own]
                start = 0
                while start < n:
                    offset = (place + start) % length
                    size = min(length - offset, n - start)
                    piece = ids[4 * start : 4 * (start + size)]
                    row = (doc_id, start, size, zlib.crc32(piece), n, (place + start) // length, offset, curve)
                    out.append((*row, piece) if with_ids else row)
                    start += size
                place += n
            if not out:
                continue
            names = [c.strip().split(" ")[0] for c in PIECES.split(",")] + ["ids"] * with_ids
            kinds = [pa.int64()] * 8 + [pa.binary()] * with_ids
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return (
        dealt.repartition(partitions_of(spark), "slot")
        .sortWithinPartitions("slot", "curve", "doc_id", "ids")
        .mapInArrow(given_back(run), PIECES + (", ids binary" if with_ids else ""))
    )
