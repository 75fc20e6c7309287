"""Vectorised hashing of words and windows in Arrow text columns (numpy, inside tasks).

A document is a slice of the UTF-8 buffer of an Arrow column, so words are found and hashed for
thousands of documents at once and no Python object is made per word. All hashes are 64 bits and
depend on nothing but the bytes: any task, run or machine gives the same values.

The sums are polynomials modulo 2**64 over random values of the bytes, followed by a bijective
mix. Chance collisions of two different words or windows have odds of about 2**-64 per pair.
"""

from __future__ import annotations

from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

#: Bytes of text which are hashed at a time; work arrays take about 40 times as much.
CHUNK_BYTES = 1 << 20

_ODD_BASE = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(values: np.ndarray, salt: int = 0) -> np.ndarray:
    """A bijection of 64 bit values whose output bits all depend on all input bits."""
    z = values + np.uint64((salt * 0xD1342543DE82EF95 + 0x9E3779B97F4A7C15) & _MASK)
    z = (z ^ (z >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    z = (z ^ (z >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return z ^ (z >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(256, dtype=np.uint64), salt=1)


class Powers:
    """Powers of an odd base and of its inverse modulo 2**64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def to(self, n: int) -> Powers:
        if len(self.up) < n:
            size = 1 << (n - 1).bit_length()
            self.up = self._table(_ODD_BASE, size)
            self.down = self._table(pow(_ODD_BASE, -1, 1 << 64), size)
        return self

    @staticmethod
    def _table(base: int, size: int) -> np.ndarray:
        table = np.full(size, base, dtype=np.uint64)
        table[0] = 1
        return np.multiply.accumulate(table)


_POWERS = Powers()


def prefix_sums(values: np.ndarray) -> np.ndarray:
    """``n + 1`` polynomial prefix sums; ``range_hash`` reads the hash of any range from them."""
    sums = np.zeros(len(values) + 1, dtype=np.uint64)
    np.cumsum(values * _POWERS.to(len(values) + 1).up[: len(values)], out=sums[1:])
    return sums


def range_hash(sums: np.ndarray, starts: np.ndarray, ends: np.ndarray, salt: int) -> np.ndarray:
    """Hash of the values of each range ``[start, end)``, the same wherever the range lies."""
    powers = _POWERS.to(len(sums))
    return mix((sums[ends] - sums[starts]) * powers.down[starts] + (ends - starts).astype(np.uint64), salt)


class Alphabet(NamedTuple):
    """Which bytes belong to words, and the byte each one counts as."""

    in_word: np.ndarray
    folded: np.ndarray

    def values(self, data: np.ndarray) -> np.ndarray:
        return _BYTE_VALUES[self.folded[data]]


def _alphabet(separators: set[int], lower: bool) -> Alphabet:
    in_word = np.ones(256, dtype=bool)
    in_word[list(separators)] = False
    folded = np.arange(256, dtype=np.uint8)
    if lower:
        folded[ord("A") : ord("Z") + 1] += 32
    return Alphabet(in_word, folded)


_BLANKS = {0x20, *range(0x09, 0x0E)}
#: Words are runs without ASCII white space, taken as they are.
PLAIN = _alphabet(_BLANKS, lower=False)
#: The same with A-Z in lower case.
LOWERED = _alphabet(_BLANKS, lower=True)
#: Words of ASCII letters, digits and all characters beyond ASCII, A-Z in lower case.
LETTERS_DIGITS = _alphabet(
    {b for b in range(0x80) if not (0x30 <= b <= 0x39 or 0x41 <= b <= 0x5A or 0x61 <= b <= 0x7A)},
    lower=True,
)


class Chunk(NamedTuple):
    """Consecutive documents of a batch: rows ``first ..``, their bytes, and where each begins."""

    first: int
    data: np.ndarray
    offsets: np.ndarray  # n + 1 positions in data

    @property
    def size(self) -> int:
        return len(self.offsets) - 1


def texts(column: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes and ``n + 1`` offsets of a text column; a null is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    column = column.cast(pa.large_binary())
    _, offsets, data = column.buffers()
    bounds = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    return np.frombuffer(data or b"", dtype=np.uint8), bounds


def chunks(column: pa.Array | pa.ChunkedArray, limit: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """Cut a text column in runs of whole documents of about ``limit`` bytes (one at least)."""
    data, bounds = texts(column)
    first, n = 0, len(bounds) - 1
    while first < n:
        last = max(first + 1, int(np.searchsorted(bounds, bounds[first] + limit, side="right")) - 1)
        yield Chunk(first, data[bounds[first] : bounds[last]], bounds[first : last + 1] - bounds[first])
        first = last


class Words(NamedTuple):
    """Words of a chunk in order: hashes, bytes ``[start, end)``, and per document its first word."""

    hashes: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    offsets: np.ndarray  # n + 1 positions in the arrays above

    def counts(self) -> np.ndarray:
        return np.diff(self.offsets)


def words(chunk: Chunk, alphabet: Alphabet) -> Words:
    """Find and hash the words of a chunk; no word crosses a document's end.

    A document longer than a chunk is taken in pieces which end between two words.
    """
    if len(chunk.data) <= 2 * CHUNK_BYTES or chunk.size > 1:
        return _words(chunk, alphabet)
    parts, low = [], 0
    while low < len(chunk.data):
        high = min(low + CHUNK_BYTES, len(chunk.data))
        while high < len(chunk.data) and alphabet.in_word[chunk.data[high]]:
            blanks = np.flatnonzero(~alphabet.in_word[chunk.data[high : high + CHUNK_BYTES]])
            high = high + int(blanks[0]) if len(blanks) else min(high + CHUNK_BYTES, len(chunk.data))
        piece = _words(Chunk(0, chunk.data[low:high], np.array([0, high - low])), alphabet)
        parts.append((piece.hashes, piece.starts + low, piece.ends + low))
        low = high
    hashes, starts, ends = (np.concatenate(column) for column in zip(*parts))
    return Words(hashes, starts, ends, np.array([0, len(hashes)]))


def _words(chunk: Chunk, alphabet: Alphabet) -> Words:
    inside = alphabet.in_word[chunk.data]
    before = np.zeros(len(inside), dtype=bool)
    before[1:] = inside[:-1]
    after = np.zeros(len(inside), dtype=bool)
    after[:-1] = inside[1:]
    edges = chunk.offsets[(chunk.offsets > 0) & (chunk.offsets < len(inside))]
    before[edges] = False
    after[edges - 1] = False
    starts = np.flatnonzero(inside & ~before)
    ends = np.flatnonzero(inside & ~after) + 1
    sums = prefix_sums(alphabet.values(chunk.data))
    return Words(range_hash(sums, starts, ends, 2), starts, ends, np.searchsorted(starts, chunk.offsets))


def owners(offsets: np.ndarray) -> np.ndarray:
    """The document each element belongs to, by ``n + 1`` offsets."""
    return np.repeat(np.arange(len(offsets) - 1), np.diff(offsets))


def inside_mask(offsets: np.ndarray, length: int) -> np.ndarray:
    """Positions at which a window of ``length`` elements still fits into its document."""
    ends = np.repeat(offsets[1:], np.diff(offsets))
    return ends - np.arange(len(ends)) >= length
