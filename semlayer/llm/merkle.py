"""Document fingerprints: Merkle trees over sections, paragraphs and pieces.

A paragraph is a line.  Sections are runs of paragraphs that end at an empty line, or after a
paragraph whose hash is a multiple of four, so that an edit moves no border but those beside it.
A paragraph's hash is that of its bytes, a section's that of its paragraph hashes, the root's
that of all section hashes: equal roots mean equal texts.  Below a paragraph lie pieces, runs
of words that end where a word's hash is a multiple of four; they carry the likeness of two
trees.  A fingerprint holds the whole tree as four fields of fixed-width hexadecimal records:

    root (32 digits) / sections (16 hash, 8 paragraphs) / paragraphs (16 hash, 8 pieces)
    / pieces (10 hash, 6 length in bytes)
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import words as W
from .exchange import partitions_of, text_bytes

BORDER = 4


def _digest(data: bytes, size: int) -> bytes:
    return hashlib.blake2b(data, digest_size=size).digest()


def pieces_of(found: W.Words, lines: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Hash, size and line of every piece; lines are the byte positions where lines begin."""
    n = len(found.code)
    if n == 0:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64)
    line = np.searchsorted(lines, found.start, "right") - 1
    last = found.code % np.uint64(BORDER) == 0
    last[:-1] |= line[1:] != line[:-1]
    last[-1] = True
    end = np.flatnonzero(last) + 1
    begin = np.concatenate(([0], end[:-1]))
    place = (np.arange(n) - np.repeat(begin, end - begin)).astype(np.uint64)
    code = np.add.reduceat(W.mixed(found.code + place * np.uint64(W.WORD_BASE)), begin)
    size = found.end[end - 1] - found.start[begin] + 1
    return W.mixed(code), np.minimum(size, (1 << 24) - 1), line[begin]


def fingerprint(text: str | None) -> str:
    """The tree of one text; null as the empty text."""
    data = (text or "").encode()
    found = W.words_of(W.texts_of(pa.array([text or ""]), lower=False))
    lines = data.split(b"\n")
    begins = np.cumsum([0, *(len(x) + 1 for x in lines[:-1])])
    code, size, line = pieces_of(found, begins)
    count = np.bincount(line, minlength=len(lines)) if len(line) else np.zeros(len(lines), np.int64)
    hashes = [_digest(x, 8) for x in lines]
    sections, run = [], []
    for raw, own in zip(lines, hashes):
        run.append(own)
        if not raw.strip() or own[-1] % BORDER == 0:
            sections.append(run)
            run = []
    if run:
        sections.append(run)
    tops = [_digest(b"".join(run), 8) for run in sections]
    head = np.ascontiguousarray(code.astype(">u8")).view(np.uint8).reshape(-1, 8)[:, :5]
    tail = np.ascontiguousarray(size.astype(">u4")).view(np.uint8).reshape(-1, 4)[:, 1:]
    return "/".join(
        (
            _digest(b"".join(tops), 16).hex(),
            "".join(t.hex() + f"{len(run):08x}" for t, run in zip(tops, sections)),
            "".join(h.hex() + f"{c:08x}" for h, c in zip(hashes, count.tolist())),
            np.concatenate((head, tail), axis=1).tobytes().hex(),
        )
    )


def root(print_: str) -> str:
    return print_.split("/", 1)[0]


def _pieces(print_: str) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(bytes.fromhex(print_.rsplit("/", 1)[1]), np.uint8).reshape(-1, 8).astype(np.int64)
    code = raw[:, :5] @ (1 << np.arange(32, -8, -8))
    return code, raw[:, 5:] @ np.array([1 << 16, 1 << 8, 1])


def likeness(a: str, b: str) -> float:
    """1 for equal roots, else the share of bytes in pieces that both have (each as often).

    Taking equal sections and paragraphs out of both first would leave the sum as it is, since equal branches
    have equal pieces.
    """
    if root(a) == root(b):
        return 1.0
    (x, m), (y, n) = _pieces(a), _pieces(b)
    total = int(m.sum() + n.sum())
    if not total:
        return 0.0
    both = np.concatenate((x, y))
    keys, where = np.unique(both, return_inverse=True)
    in_a = np.bincount(where[: len(x)], minlength=len(keys))
    in_b = np.bincount(where[len(x) :], minlength=len(keys))
    size = np.zeros(len(keys), np.int64)
    size[where] = np.concatenate((m, n))
    return min(float(2 * (np.minimum(in_a, in_b) * size).sum() / total), 1.0 - 1e-9)


def differing_paragraphs(a: str, b: str) -> list[int]:
    """Paragraphs of a that b lacks, each as often: from the roots down, equal sections are passed over whole."""
    if root(a) == root(b):
        return []

    def sections(print_: str) -> list[tuple[str, list[str]]]:
        tops, leaves = ([raw[i : i + 24] for i in range(0, len(raw), 24)] for raw in print_.split("/")[1:3])
        out, at = [], 0
        for top in tops:
            n = int(top[16:], 16)
            out.append((top[:16], [leaf[:16] for leaf in leaves[at : at + n]]))
            at += n
        return out

    theirs, own = sections(b), sections(a)
    spare = Counter(code for code, _ in own)
    rest: Counter[str] = Counter()
    for code, paragraphs in theirs:
        if spare[code]:
            spare[code] -= 1
        else:
            rest.update(paragraphs)
    equal = Counter(code for code, _ in theirs)
    out, at = [], 0
    for code, paragraphs in own:
        if equal[code]:
            equal[code] -= 1
        else:
            for k, paragraph in enumerate(paragraphs, at):
                if rest[paragraph]:
                    rest[paragraph] -= 1
                else:
                    out.append(k)
        at += len(paragraphs)
    return out


def in_descending_order(documents: DataFrame) -> DataFrame:
    """Rows (slot, guest, doc_id, text) in ranges of descending doc_id, one slot after another.

    After each slot's own rows comes a guest, the row that follows them in the whole order: the first row
    of the next slot that has any, and after the last row of all the first of all.  Ranges come
    from approximate quantiles of doc_id; null ids come last, equal ids are ordered by text.
    """
    spark = documents.sparkSession
    slots = max(4 * partitions_of(spark), -(-text_bytes(documents) // (64 << 20)))
    splits = documents.agg(
        F.percentile_approx("doc_id", F.array(*(F.lit(i / slots) for i in range(1, slots))), 10 * slots).alias("at")
    ).first()["at"]
    splits = sorted(set(splits or []), reverse=True)
    edges = F.array(*map(F.lit, splits)) if splits else F.array().cast("array<bigint>")
    slot = F.when(F.col("doc_id").isNull(), len(splits)).otherwise(
        F.size(F.filter(edges, lambda edge: edge > F.col("doc_id")))
    )
    dealt = documents.select(slot.cast("int").alias("slot"), F.lit(0).alias("guest"), "doc_id", "text")
    firsts = dealt.groupBy("slot").agg(F.max("doc_id").alias("id")).collect()
    used = sorted(row["slot"] for row in firsts)
    ids = [row["id"] for row in firsts if row["id"] is not None]
    heads = dealt.where(F.col("doc_id").isNull() | F.col("doc_id").isin(ids)).groupBy("slot", "doc_id")
    heads = heads.agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
    before = dict(zip(used, used[-1:] + used[:-1]))
    back = F.create_map(*(F.lit(x) for pair in before.items() for x in pair)) if used else F.lit(None).cast("map<int,int>")
    guests = heads.select(
        F.element_at(back, F.col("slot")).alias("slot"), F.lit(1).alias("guest"), "doc_id", "text"
    )
    return (
        dealt.union(guests)
        .repartition(partitions_of(spark), "slot")
        .sortWithinPartitions("slot", "guest", F.desc_nulls_last("doc_id"), F.coalesce("text", F.lit("")))
    )


def chained(rows: Iterator[tuple[int, int, int | None, str]]) -> Iterator[tuple[int | None, str, str, str, str]]:
    """(doc_id, text, its fingerprint, next text, its fingerprint) of each row that is no guest."""
    held = None
    for slot, guest, doc_id, text in rows:
        own = fingerprint(text)
        if held is not None and held[0] == slot:
            yield (*held[1:], text, own)
        held = None if guest else (slot, doc_id, text, own)


def edited_text(text: str, following: str) -> str:
    """The last third of the code points replaced by the first as many (or all) of another text."""
    n = len(text) // 3
    return text[: len(text) - n] + following[:n]


RESULT = (
    "doc_id bigint, n_chars bigint, edited_sha256 string, fingerprint string, edited_fingerprint string, "
    "near_edited double, near_next double, differing array<bigint>"
)


def fingerprints_of_edits(documents: DataFrame) -> DataFrame:
    """The fingerprint of each row of `documents` (doc_id, text), of its edited text, and their likeness.

    `differing` has the paragraphs of the text that its edited text lacks, counted from 0.

    The next document is the one of the next smaller doc_id, after the last the first; one row
    alone is its own next.  A null text is empty.  Each row is one row of the result.
    """
    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = [part.strip().split(" ")[0] for part in RESULT.split(",")]
    kinds = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64(), pa.list_(pa.int64())]

    def run(batches):
        def rows():
            for batch in batches:
                columns = [batch[c].to_pylist() for c in ("slot", "guest", "doc_id", "text")]
                yield from ((s, g, d, t or "") for s, g, d, t in zip(*columns))

        out, size = [], 0
        for doc_id, text, own, following, theirs in chained(rows()):
            changed = edited_text(text, following)
            print_ = own if changed == text else fingerprint(changed)
            digest = hashlib.sha256(changed.encode()).hexdigest()
            near = likeness(own, print_), likeness(own, theirs)
            out.append((doc_id, len(text), digest, own, print_, *near, differing_paragraphs(own, print_)))
            size += len(own) + len(print_)
            if size > 4 << 20:
                yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)
                out, size = [], 0
        if out:
            yield pa.record_batch([pa.array(c, k) for c, k in zip(zip(*out), kinds)], names)

    return in_descending_order(docs).mapInArrow(run, RESULT)
