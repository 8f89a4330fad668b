"""Words of whole Arrow text columns as arrays of 64-bit hashes.

No Python object is made per word: word borders come from a byte table, and a
word's bytes are read eight at a time. Two different words share a hash with a
probability of about 2**-64.
"""
from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass
from hashlib import blake2b

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

U64 = np.uint64
# Odd multipliers of the mixer.
MULTIPLIERS = (U64(0xBF58476D1CE4E5B9), U64(0x94D049BB133111EB))
# Text bytes that are worked on at a time, whatever a batch holds.
SLICE_BYTES = 4 << 20
LONG_WORD = 256
_MASKS = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=U64)


def _table(word_bytes: np.ndarray) -> np.ndarray:
    table = np.zeros(256, dtype=bool)
    table[word_bytes] = True
    return table


_BYTES = np.arange(256)
_LOWER = np.where((_BYTES >= 65) & (_BYTES <= 90), _BYTES + 32, _BYTES).astype(np.uint8)


@dataclass(frozen=True)
class Rule:
    """Which bytes make words, and what case they are compared in."""

    word: np.ndarray
    fold: np.ndarray | None


_NOT_SPACE = _table(_BYTES[(_BYTES != 32) & ((_BYTES < 9) | (_BYTES > 13))])
#: ``[^\x20\x09-\x0D]+``, unchanged
PLAIN = Rule(_NOT_SPACE, None)
#: the same with A-Z lower-cased
LOWER = Rule(_NOT_SPACE, _LOWER)
#: digits, letters and everything beyond ASCII, with A-Z lower-cased
ALPHANUMERIC = Rule(
    _table(_BYTES[((_BYTES >= 48) & (_BYTES <= 57)) | ((_BYTES >= 97) & (_BYTES <= 122)) | (_BYTES >= 128)]),
    _LOWER,
)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> U64(30))
    x *= MULTIPLIERS[0]
    x ^= x >> U64(27)
    x *= MULTIPLIERS[1]
    x ^= x >> U64(31)
    return x


@dataclass
class Words:
    """Words of the rows ``first`` to ``last`` of a batch: row ``first + i`` has
    the hashes from ``bounds[i]`` to ``bounds[i + 1]``."""

    first: int
    last: int
    hashes: np.ndarray
    bounds: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    data: np.ndarray

    def rows(self) -> np.ndarray:
        """The row, from 0, of each word."""
        return np.repeat(np.arange(self.last - self.first), np.diff(self.bounds))


def row_slices(column: pa.Array, size: int) -> Iterator[tuple[int, pa.Array]]:
    """First row and rows of parts of a text column of about ``size`` bytes each;
    a longer text is a part of its own."""
    lengths = pc.fill_null(pc.binary_length(column), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(lengths, dtype=np.int64) // size
    borders = [*np.flatnonzero(np.diff(part, prepend=-1)).tolist(), len(column)]
    for first, last in zip(borders, borders[1:]):
        yield first, column.slice(first, last - first)


def words_of(column: pa.Array | pa.ChunkedArray, rule: Rule) -> Iterator[Words]:
    """The words of a text column, some rows at a time. A null has no words."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if not len(column):
        return
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + len(column) + 1]
    data = np.frombuffer(data, dtype=np.uint8) if data is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < len(column):
        last = int(np.searchsorted(offsets, offsets[first] + SLICE_BYTES, side="right")) - 1
        last = max(first + 1, min(last, len(column)))
        yield _words(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first], first, last, rule)
        first = last


def _words(data: np.ndarray, offsets: np.ndarray, first: int, last: int, rule: Rule) -> Words:
    size = len(data)
    padded = np.zeros(size + 16, dtype=np.uint8)
    padded[:size] = data if rule.fold is None else rule.fold[data]
    inside = np.zeros(size + 2, dtype=bool)
    inside[1:-1] = rule.word[padded[:size]]
    starting = inside[1:-1] & ~inside[:-2]
    ending = inside[1:-1] & ~inside[2:]
    borders = offsets[1:-1][(offsets[1:-1] > 0) & (offsets[1:-1] < size)]
    starting[borders] = inside[borders + 1]
    ending[borders - 1] = inside[borders]
    starts, ends = np.flatnonzero(starting), np.flatnonzero(ending) + 1
    return Words(first, last, _hashes(padded, starts, ends), np.searchsorted(starts, offsets), starts, ends, data)


def _hashes(padded: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    eight = np.ndarray((max(0, len(padded) - 7),), dtype="<u8", buffer=padded, strides=(1,))
    lengths = ends - starts
    hashes = mix((eight[starts] & _MASKS[np.minimum(lengths, 8)]) + lengths.astype(U64) * MULTIPLIERS[1])
    for i in np.flatnonzero(lengths > LONG_WORD):
        digest = blake2b(padded[starts[i] : ends[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    at, rest = 8, np.flatnonzero((lengths > 8) & (lengths <= LONG_WORD))
    while len(rest):
        chunk = eight[starts[rest] + at] & _MASKS[np.minimum(lengths[rest] - at, 8)]
        hashes[rest] = mix(hashes[rest] ^ chunk)
        at += 8
        rest = rest[lengths[rest] > at]
    return hashes


# Fixed value: odd base of the rolling hash, and its inverse modulo 2**64.
BASE = 0x9E3779B97F4A7C15
_INVERSE = pow(BASE, -1, 1 << 64)


def _powers(base: int, count: int) -> np.ndarray:
    powers = np.full(count, base, dtype=U64)
    if count:
        powers[0] = 1
    return np.multiply.accumulate(powers)


class Rolling:
    """Hashes of any runs of words, by differences of one running sum."""

    def __init__(self, hashes: np.ndarray) -> None:
        self.sums = np.zeros(len(hashes) + 1, dtype=U64)
        np.cumsum(hashes * _powers(BASE, len(hashes)), out=self.sums[1:])
        self.back = _powers(_INVERSE, len(hashes) + 1)

    def runs(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        value = (self.sums[ends] - self.sums[starts]) * self.back[starts]
        return mix(value + (ends - starts).astype(U64) * MULTIPLIERS[0])


def as_long(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)


def longest_bytes(column: pa.Array) -> int:
    return pc.max(pc.binary_length(column)).as_py() or 0
