"""Token counts by dynamic programming over a trie of pre-tokens.

A unigram tokenizer splits a pre-token into the pieces of greatest total score.  The best score and
token count up to a character depend on the prefix alone, so pre-tokens that share a prefix share
that work: the distinct pre-tokens of a batch are walked in sorted order, which is a depth-first walk of
their trie, and each trie node is scored once, on the path kept from its parent.  Terminal nodes hold
the counts of their pre-tokens.

Pieces come from a public vocabulary file; a piece's score is -log(rank + 2), by rank in the file.
A character that no piece covers counts as its UTF-8 bytes, each with the score of the last rank
less ten.  Among splits of equal score the one with fewer tokens counts.
"""

from __future__ import annotations

import math
from collections.abc import Iterable

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

MARK = "▁"
SPACES = " \t\n\v\f\r"
_TABLE = str.maketrans(dict.fromkeys(SPACES, " "))


def vocabulary(path: str) -> dict[str, float]:
    """Scores of the pieces of a sentencepiece model, without its control and byte pieces."""
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    pieces = [
        model.id_to_piece(i)
        for i in range(model.get_piece_size())
        if not (model.is_control(i) or model.is_unknown(i) or model.is_byte(i))
    ]
    return {piece: -math.log(rank + 2) for rank, piece in enumerate(pieces)}


def piece_trie(scores: dict[str, float]) -> dict:
    """Nested dictionaries by character; the score of a piece is under the empty string."""
    root: dict = {}
    for piece, score in scores.items():
        node = root
        for c in piece:
            node = node.setdefault(c, {})
        node[""] = score
    return root


def pre_tokens(text: str | None) -> list[str]:
    """Words between ASCII white space, each with the mark of a word's start."""
    return [MARK + w for w in (text or "").translate(_TABLE).split(" ") if w]


def counts_of(words: Iterable[str], trie: dict, n_pieces: int) -> dict[str, int]:
    """Tokens of each distinct pre-token, by one walk over their trie.

    The stack holds, for every character of the current path, the best (score, -tokens) up to it and the
    pieces that are still open there (their node, and the best before their start).
    """
    worst = -math.log(n_pieces + 2) - 10.0
    terminal: dict[str, int] = {}
    best: list[tuple[float, int]] = [(0.0, 0)]
    open_: list[list[tuple[dict, tuple[float, int]]]] = [[]]
    last = ""
    for word in sorted(set(words)):
        shared, most = 0, min(len(last), len(word))
        while shared < most and last[shared] == word[shared]:
            shared += 1
        del best[shared + 1 :], open_[shared + 1 :]
        for c in word[shared:]:
            before, going = best[-1], []
            n = len(c.encode("utf-8", "surrogatepass"))
            top = (before[0] + n * worst, before[1] - n)
            for node, start in (*open_[-1], (trie, before)):
                node = node.get(c)
                if node is not None:
                    going.append((node, start))
                    score = node.get("")
                    if score is not None:
                        top = max(top, (start[0] + score, start[1] - 1))
            best.append(top)
            open_.append(going)
        terminal[word] = -best[-1][1]
        last = word
    return terminal


def token_counts(documents: DataFrame, path: str) -> DataFrame:
    """doc_id, n_pre_tokens and n_tokens of each row of `documents` (doc_id, text); null is empty."""
    scores = vocabulary(path)
    shared = documents.sparkSession.sparkContext.broadcast(scores)

    def run(batches):
        scores = shared.value
        trie = piece_trie(scores)
        for batch in batches:
            words = [pre_tokens(t) for t in batch["text"].to_pylist()]
            terminal = counts_of((w for ws in words for w in ws), trie, len(scores))
            yield pa.record_batch(
                {
                    "doc_id": batch["doc_id"],
                    "n_pre_tokens": pa.array([len(ws) for ws in words], pa.int64()),
                    "n_tokens": pa.array([sum(map(terminal.__getitem__, ws)) for ws in words], pa.int64()),
                }
            )

    docs = documents.select(F.col("doc_id").cast("bigint").alias("doc_id"), F.col("text").cast("string").alias("text"))
    return docs.mapInArrow(run, "doc_id bigint, n_pre_tokens bigint, n_tokens bigint")
