"""Words, their hashes and shingles for whole Arrow batches at once.

A word is a maximal run of bytes other than space and 0x09-0x0D; texts are
handled as UTF-8 bytes, so all positions here are byte positions.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: The same word definition for Spark and DuckDB regular expressions.
WORD = r"[^\x20\x09-\x0D]+"
CHUNK_BYTES = 1 << 19

_rng = np.random.Generator(np.random.Philox(20240229))
_BYTE = _rng.integers(0, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BYTE_LOWER = _BYTE.copy()
_BYTE_LOWER[65:91] = _BYTE[97:123]
_RADIX = 0x9E3779B97F4A7C15 | 1
_PLACE = _rng.integers(0, 1 << 63, 64, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
_WORD = np.ones(256, bool)
_WORD[[9, 10, 11, 12, 13, 32]] = False
#: ASCII letters and digits and all of what is beyond ASCII.
PLAIN = np.array([b >= 128 or chr(b).isalnum() for b in range(256)])


def mix(values: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every bit."""
    x = values.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def different(values: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """As ``np.unique`` with the first places and the inverse, without its stable sort of 64-bit numbers."""
    if not len(values):
        return values, np.empty(0, np.int64), np.empty(0, np.int64)
    order = np.argsort(values)
    ordered = values[order]
    new = np.ones(len(values), bool)
    new[1:] = ordered[1:] != ordered[:-1]
    which = np.empty(len(values), np.int64)
    which[order] = np.cumsum(new) - 1
    return ordered[new], np.minimum.reduceat(order, np.flatnonzero(new)), which


def in_shards(keys: np.ndarray, shards: int) -> tuple[np.ndarray, np.ndarray]:
    """The places of the keys in order of shard, otherwise as they are, and where each shard's start in that order."""
    shard = (mix(keys) % np.uint64(shards)).astype(np.uint16 if shards <= 1 << 16 else np.int64)  # two bytes are sorted by digits
    return np.argsort(shard, kind="stable"), np.concatenate([[0], np.cumsum(np.bincount(shard, minlength=shards))])


@dataclass
class Chunk:
    """Rows ``first`` to ``last`` of a batch with the words of their texts."""

    first: int
    last: int
    data: np.ndarray          # UTF-8 bytes of the rows, one after another
    bounds: np.ndarray        # byte position where each row starts, and the end
    starts: np.ndarray        # of words
    ends: np.ndarray
    offsets: np.ndarray       # first word of each row, and the number of words

    def hashes(self, lower: bool = False) -> np.ndarray:
        """A 64-bit hash of each word."""
        if not len(self.starts):
            return np.empty(0, np.uint64)
        lengths = self.ends - self.starts
        inside = np.repeat(self.starts - np.concatenate([[0], np.cumsum(lengths)[:-1]]), lengths)
        at = np.arange(len(inside)) + inside
        place = at - np.repeat(self.starts, lengths)
        powers = np.cumprod(np.concatenate([[np.uint64(1)],
                                            np.full(int(lengths.max()), _RADIX, np.uint64)]), dtype=np.uint64)
        table = _BYTE_LOWER if lower else _BYTE
        terms = table[self.data[at]] * powers[place]
        firsts = np.concatenate([[0], np.cumsum(lengths)[:-1]])
        return mix(np.add.reduceat(terms, firsts) + lengths.astype(np.uint64))

    def prefixes(self, sizes: Sequence[int]) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Per size: the words longer than it, and the hash of so many first bytes."""
        lengths, total, power = self.ends - self.starts, np.zeros(len(self.starts), np.uint64), np.uint64(1)
        for place in range(max(sizes, default=0)):
            long = lengths > place
            total[long] += _BYTE[self.data[self.starts[long] + place]] * power
            power = np.uint64(int(power) * _RADIX & 0xFFFFFFFFFFFFFFFF)
            if place + 1 in sizes:
                words = np.flatnonzero(lengths > place + 1)
                yield words, mix(total[words] + np.uint64(1 << 32 | place))

    def rows_of_words(self) -> np.ndarray:
        return np.repeat(np.arange(self.last - self.first), np.diff(self.offsets))


def chunks(column: pa.Array, limit: int = CHUNK_BYTES, inside: np.ndarray = _WORD) -> Iterator[Chunk]:
    """Cut a string column into runs of rows of about ``limit`` bytes; null is an empty text.

    ``inside`` tells which bytes words are made of.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.fill_null("")
    wide = pa.types.is_large_string(column.type)
    _, where, raw = column.buffers()
    where = np.frombuffer(where, np.int64 if wide else np.int32)[column.offset:column.offset + len(column) + 1]
    where = where.astype(np.int64)
    whole = np.frombuffer(raw, np.uint8) if raw is not None else np.empty(0, np.uint8)
    first = 0
    while first < len(column):
        last = max(first + 1, int(np.searchsorted(where, where[first] + limit, "right")) - 1)
        yield _cut(first, last, whole[where[first]:where[last]], where[first:last + 1] - where[first], inside)
        first = last
    release_memory()


def release_memory() -> None:
    """Give freed memory back to the system: workers stay, idle, when their task is done."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def _cut(first: int, last: int, data: np.ndarray, bounds: np.ndarray, kinds: np.ndarray) -> Chunk:
    inside = kinds[data]
    edge = np.zeros(len(data) + 1, bool)
    edge[bounds] = True
    before = np.empty(len(data), bool)
    if len(data):
        before[0] = False
        before[1:] = inside[:-1]
    starts = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    ends = np.flatnonzero(inside & (~after | edge[1:])) + 1
    return Chunk(first, last, data, bounds, starts, ends, np.searchsorted(starts, bounds))


def runs(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hash of ``size`` consecutive entries, starting at each one that has so many after it."""
    count = len(hashes) - size + 1
    if count <= 0:
        return np.empty(0, np.uint64)
    total = np.zeros(count, np.uint64)
    for place in range(size):
        total += hashes[place:place + count] * _PLACE[place % len(_PLACE)]
    return mix(total)
