"""Words and rolling hashes of whole texts, vectorised over the bytes of an Arrow array.

A polynomial hash over random byte values is taken modulo 2**64 and modulo the prime 2**31 - 1, and
both are mixed into 64 bits; the same function over word hashes gives the hashes of word sequences.
Equal sequences always have equal hashes.  Modulo a power of two alone, some sequences collide
whatever the values are (those of Thue and Morse); modulo a prime no such pairs exist, and two
sequences that differ have one hash only if both remainders meet.
"""

from __future__ import annotations

from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

# The odd multipliers of the polynomials and the seed of the byte values.  Fixed values.
BYTE_BASE = 0x9E3779B97F4A7C15
WORD_BASE = 0xD1342543DE82EF95
SEED = 20260801
PRIME = (1 << 31) - 1
#: Bytes of text, or words, hashed at a time: their arrays stay in the cache.
SEGMENT = 1 << 15

#: Bytes that separate words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = (0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D)


def separators(values) -> np.ndarray:
    """A table of 256 flags, true for bytes that separate words."""
    table = np.zeros(256, dtype=bool)
    table[list(values)] = True
    return table


BLANK_TABLE = separators(BLANKS)
#: Everything in ASCII but digits and letters.
NOT_ALNUM_TABLE = separators(
    b for b in range(128) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)
)


class Texts(NamedTuple):
    """The bytes of some texts one after another; text i is data[bounds[i]:bounds[i + 1]]."""

    data: np.ndarray
    bounds: np.ndarray


class Words(NamedTuple):
    """Words of some texts: their byte spans and hashes; text i has words first[i]:first[i + 1]."""

    start: np.ndarray
    end: np.ndarray
    code: np.ndarray
    first: np.ndarray


def texts_of(column, lower: bool) -> Texts:
    """The bytes of a string column, null as empty; with `lower`, A-Z become a-z."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    bounds = np.frombuffer(column.buffers()[1], dtype=np.int64)[column.offset : column.offset + n + 1]
    if n == 0 or column.buffers()[2] is None:
        return Texts(np.zeros(0, np.uint8), np.zeros(n + 1, np.int64))
    data = np.frombuffer(column.buffers()[2], dtype=np.uint8)[bounds[0] : bounds[-1]]
    if lower:
        data = data + ((data - np.uint8(65)) < 26).astype(np.uint8) * np.uint8(32)
    return Texts(data, bounds - bounds[0])


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


class _Tables(dict):
    """Tables that each process builds for itself; they never travel with a function."""

    def __reduce__(self):
        return (_Tables, ())


_tables = _Tables()


def _powers(base: int, n: int) -> tuple[np.ndarray, ...]:
    """base**i and base**-i for i up to n, modulo 2**64 and modulo PRIME."""
    have = _tables.get(base)
    if have is None or len(have[0]) <= n:
        size = max(n + 1, 2 * SEGMENT)
        up, down = np.empty(size, np.uint64), np.empty(size, np.uint64)
        up[0] = down[0] = 1
        up[1:] = np.uint64(base)
        down[1:] = np.uint64(pow(base, -1, 1 << 64))
        wrapping = np.cumprod(up, dtype=np.uint64), np.cumprod(down, dtype=np.uint64)
        have = _tables[base] = (*wrapping, _prime_powers(base % PRIME, size), _prime_powers(pow(base, -1, PRIME), size))
    return have


def _prime_powers(base: int, n: int) -> np.ndarray:
    """base**i modulo PRIME for i below n, by doubling."""
    powers = np.ones(n, np.uint64)
    done = 1
    while done < n:
        more = min(done, n - done)
        powers[done : done + more] = remainder(powers[:more] * np.uint64(pow(base, done, PRIME)))
        done += more
    return powers.astype(np.uint32)


def folded(x: np.ndarray) -> np.ndarray:
    """A number of at most 34 bits (32 for x below 2**62, and after a second fold) with the same remainder."""
    return (x & np.uint64(PRIME)) + (x >> np.uint64(31))


def remainder(x: np.ndarray) -> np.ndarray:
    """x modulo PRIME, where a power of two is one less than the prime plus two: shifts do."""
    x = folded(folded(x))
    return np.minimum(x, x - np.uint64(PRIME))  # below PRIME the difference wraps


def _runs(values: np.ndarray, residues: np.ndarray, base: int, start, end, length) -> np.ndarray:
    """A hash of values[start:end] for each pair of indexes (arrays, or two slices of one length).

    Equal for equal runs, wherever they start; residues are the values modulo PRIME, of at most 32 bits.
    """
    up, down, prime_up, prime_down = _powers(base, len(values))
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * up[: len(values)], out=sums[1:])
    wrapping = (sums[end] - sums[start]) * down[start] + length
    np.cumsum(folded(residues * prime_up[: len(values)]), out=sums[1:])
    prime = remainder(folded(folded(sums[end] - sums[start])) * prime_down[start])
    # An odd multiple of the remainder: one sum for two remainders is impossible.
    return mixed(wrapping + prime * np.uint64(BYTE_BASE))


def _byte_values() -> tuple[np.ndarray, np.ndarray]:
    """The values of the 256 bytes, and their remainders."""
    if SEED not in _tables:
        values = np.random.default_rng(SEED).integers(1, 1 << 63, 256, dtype=np.uint64) | np.uint64(1)
        _tables[SEED] = values, remainder(values)
    return _tables[SEED]


def words_of(texts: Texts, table: np.ndarray = BLANK_TABLE) -> Words:
    """All words of all texts; a word ends at a separator of `table` or at its text's end."""
    data, bounds = texts
    blank = table[data]
    inside = ~blank
    edge = np.zeros(len(data) + 1, dtype=bool)
    edge[bounds] = True
    before = np.empty(len(data), dtype=bool)
    if len(data):
        before[0] = True
        before[1:] = blank[:-1]
    after = np.empty(len(data), dtype=bool)
    if len(data):
        after[-1] = True
        after[:-1] = blank[1:]
    start = np.flatnonzero(inside & (before | edge[:-1]))
    end = np.flatnonzero(inside & (after | edge[1:])) + 1
    first = np.searchsorted(start, bounds)
    values, residues = _byte_values()
    code = np.empty(len(start), np.uint64)
    done = 0
    while done < len(start):
        low = start[done]
        upto = max(done + 1, int(np.searchsorted(end, low + SEGMENT, "right")))
        own, own_start, own_end = data[low : end[upto - 1]], start[done:upto], end[done:upto]
        size = (own_end - own_start).astype(np.uint64)
        code[done:upto] = _runs(values[own], residues[own], BYTE_BASE, own_start - low, own_end - low, size)
        done = upto
    return Words(start, end, code, first)


def sequence_codes(code: np.ndarray, length: int) -> np.ndarray:
    """Hashes of every run of `length` codes, by the position of its first; shorter by length - 1."""
    n = len(code) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    out = np.empty(n, np.uint64)
    step = max(SEGMENT, length)
    for low in range(0, n, step):
        high = min(n, low + step)
        own = code[low : high + length - 1]
        ends = slice(length, length + high - low)
        out[low:high] = _runs(own, folded(folded(own)), WORD_BASE, slice(0, high - low), ends, np.uint64(length))
    return out


def whole_starts(first: np.ndarray, length: int, n_codes: int) -> np.ndarray:
    """Which positions start a run of `length` words that lies within one text."""
    count = np.diff(first)
    fits = np.zeros(max(n_codes - length + 1, 0), dtype=bool)
    if len(fits):
        change = np.zeros(len(fits) + 1, dtype=np.int64)
        long = count >= length
        np.add.at(change, first[:-1][long], 1)
        np.add.at(change, (first[1:] - length + 1)[long], -1)
        fits = np.cumsum(change[:-1]) > 0
    return fits


def whole_code(code: np.ndarray) -> int:
    """The hash of one whole word sequence, as `sequence_codes` gives it."""
    return int(sequence_codes(code, len(code))[0])


def long_id(code: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's signed bigint."""
    return code.view(np.int64)
