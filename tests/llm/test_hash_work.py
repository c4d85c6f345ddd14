"""Hashes, byte sequences and look-ups: the values of their definitions, in bounded scratch memory."""

import tracemalloc

import numpy as np
import pyarrow as pa

from semlayer.llm import context_tree, exchange
from semlayer.llm import words as W

MB = 1 << 20


def peak(run, *args) -> int:
    """Bytes that a call held at most, after one that filled its tables."""
    run(*args)
    tracemalloc.start()
    run(*args)
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most


def plain_code(values: list[int], base: int, length: int) -> int:
    """The hash of one run as the module describes it, in Python's whole numbers."""
    wrapping = sum(v * pow(base, i, 1 << 64) for i, v in enumerate(values)) + length
    prime = sum(v * pow(base, i, W.PRIME) for i, v in enumerate(values)) % W.PRIME
    return int(W.mixed(np.array([(wrapping + prime * W.BYTE_BASE) % (1 << 64)], np.uint64))[0])


def test_hashes_are_those_of_their_definition_across_segments():
    dice = np.random.default_rng(2)
    own = ["", "a", "Word", "q" * (W.SEGMENT + 50), *("x" * int(n) for n in dice.integers(1, 30, 9000))]
    found = W.words_of(W.texts_of(pa.array([" ".join(own), None, "\x00 ß"]), lower=True))
    table = W._byte_values()[0].tolist()
    words = [w.lower() for w in own if w] + ["\x00", "ß"]
    assert len(found.code) == len(words) and found.first.tolist() == [0, len(words) - 2, len(words) - 2, len(words)]
    for i in (0, 1, 2, 3, 4000, len(words) - 3, len(words) - 2, len(words) - 1):
        data = words[i].encode()
        assert int(found.code[i]) == plain_code([table[b] for b in data], W.BYTE_BASE, len(data))
    codes = dice.integers(0, 1 << 64, W.SEGMENT + 300, dtype=np.uint64)
    codes[:4] = [0, W.PRIME, (1 << 64) - 1, 1 << 31]
    for length in (1, 5, 35):
        runs = W.sequence_codes(codes, length)
        assert len(runs) == len(codes) - length + 1
        for i in (0, 3, W.SEGMENT - 1, W.SEGMENT, len(runs) - 1):
            assert int(runs[i]) == plain_code(codes[i : i + length].tolist(), W.WORD_BASE, length)


def test_words_are_hashed_in_segments_that_fit_a_cache():
    texts = W.texts_of(pa.array(["some words " * 200_000]), lower=True)
    assert peak(W.words_of, texts) < 12 * len(texts.data) + 4 * MB
    code = W.words_of(texts).code
    assert peak(W.sequence_codes, code, 5) < 8 * len(code) + 4 * MB


def test_sequences_are_the_bytes_before_and_the_byte():
    parts = [b"\n", b"abcdefgh\n", b"\n", "ß\x00\x00 日本\n".encode()]
    depth, expected = context_tree.DEPTH, []
    for part in parts:
        for i in range(len(part)):
            before = (bytes(depth) + part)[i : i + depth]
            expected.append(int.from_bytes(before[::-1] + part[i : i + 1], "big"))
    assert context_tree.sequences(parts).tolist() == expected
    long = [b"some words of a text\n" * 5000] * 10
    assert peak(context_tree.sequences, long) < 30 * sum(map(len, long))


def test_equal_codes_are_searched_once_and_in_order(monkeypatch):
    dice = np.random.default_rng(3)
    keys = np.unique(dice.integers(0, 1 << 64, 5000, dtype=np.uint64))
    values = dice.random(len(keys))
    at = dice.integers(0, 300, 20_000)
    searched, search = [], np.searchsorted

    def recorded(sorted_keys, wanted):
        searched.append(wanted)
        return search(sorted_keys, wanted)

    monkeypatch.setattr(exchange.np, "searchsorted", recorded)
    found = exchange.looked_up(keys, values, keys[at], most=7000)
    assert (found == values[at]).all() and found.dtype == values.dtype
    assert len(searched) == 3 and all(len(w) <= 300 and (w[1:] > w[:-1]).all() for w in searched)
    assert exchange.looked_up(keys, values, keys[:0]).tolist() == []
