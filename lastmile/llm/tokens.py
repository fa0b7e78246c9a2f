"""Words of UTF-8 texts in Arrow buffers, hashed with numpy.

A word is a run of bytes other than space and the bytes 9 to 13; no byte of a longer
UTF-8 sequence is one of these, so this equals ``[^\\x20\\x09-\\x0D]+`` on code points.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa

#: Bytes of text worked on at once; one longer document is a slice of its own.
SLICE_BYTES = 1 << 20
#: Bytes hashed at once: their numbers stay in a core's cache.
HASH_BYTES = 1 << 15

_U = np.uint64
LOWERED = np.arange(256, dtype=np.uint8)
LOWERED[65:91] += 32

_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)


def mixed(x: np.ndarray) -> np.ndarray:
    """The finishing steps of splitmix64, on every number of a uint64 array."""
    x = x ^ (x >> _U(30))
    x *= _U(0xBF58476D1CE4E5B9)
    x ^= x >> _U(27)
    x *= _U(0x94D049BB133111EB)
    x ^= x >> _U(31)
    return x


def constants(n: int, seed: int) -> np.ndarray:
    """``n`` fixed odd 64-bit numbers."""
    return mixed(np.arange(1, n + 1, dtype=_U) * _U(_BASE) + _U(seed)) | _U(1)


_BYTE = constants(256, 77)
_BYTE_LOWERED = _BYTE[LOWERED]
_powers: list[np.ndarray] = []


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, HASH_BYTES + 1)
        tables = []
        for base in (_BASE, _INVERSE):
            t = np.full(size, base, _U)
            t[0] = 1
            tables.append(np.multiply.accumulate(t))
        _powers[:] = tables
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = True) -> np.ndarray:
    """A 64-bit hash of each span of bytes, A-Z lower-cased unless told otherwise.

    Prefix sums of a polynomial give every span in one pass. A long buffer is cut between
    spans so that the tables of powers stay small.
    """
    out = np.empty(len(starts), _U)
    codes = _BYTE_LOWERED if lower else _BYTE
    at = 0
    while at < len(starts):
        left = int(starts[at])
        to = max(at + 1, int(np.searchsorted(ends, left + min(HASH_BYTES, SLICE_BYTES), "right")))
        right = int(ends[to - 1])
        power, inverse = _power_tables(right - left + 1)
        sums = np.zeros(right - left + 1, _U)
        terms = np.take(codes, data[left:right])
        terms *= power[: right - left]
        np.cumsum(terms, out=sums[1:])
        s, e = starts[at:to] - left, ends[at:to] - left
        h = np.take(sums, e)
        h -= np.take(sums, s)
        h *= np.take(inverse, s)
        h += (e - s).astype(_U)
        out[at:to] = mixed(h)
        at = to
    return out


@dataclass
class Words:
    """The words of some documents: ``bounds[i]:bounds[i+1]`` are those of document ``first + i``."""

    first: int
    data: np.ndarray
    offsets: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    bounds: np.ndarray

    def hashes(self, lower: bool = True) -> np.ndarray:
        return span_hashes(self.data, self.starts, self.ends, lower)


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes and offsets (one more than rows) of a string column; null texts are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = column.fill_null("")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    n = len(column)
    if n == 0:
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64 if wide else np.int32)[column.offset : column.offset + n + 1].astype(np.int64)
    raw = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, np.uint8)
    return raw[at[0] : at[-1]], at - at[0]


def slices(offsets: np.ndarray, size: int | None = None) -> Iterator[tuple[int, int]]:
    """Runs of whole documents of about ``size`` bytes each (empty texts count as one byte)."""
    size = size or SLICE_BYTES
    weight = offsets + np.arange(len(offsets))
    lo, n = 0, len(offsets) - 1
    while lo < n:
        hi = max(lo + 1, int(np.searchsorted(weight, weight[lo] + size, "right")) - 1)
        yield lo, min(hi, n)
        lo = min(hi, n)


def words(column: pa.Array, size: int | None = None) -> Iterator[Words]:
    """The words of a string column, some documents at a time, in order."""
    data, offsets = text_bytes(column)
    for lo, hi in slices(offsets, size):
        part = data[offsets[lo] : offsets[hi]]
        at = offsets[lo : hi + 1] - offsets[lo]
        solid = np.zeros(len(part) + 2, bool)
        solid[1:-1] = (part != 32) & (part - np.uint8(9) > 4)  # 9 to 13; lower bytes wrap around
        cut = np.zeros(len(part) + 1, bool)
        cut[at] = True  # two texts that touch are still two words
        starts = np.flatnonzero(solid[1:] & (~solid[:-1] | cut))
        ends = np.flatnonzero(solid[:-1] & (~solid[1:] | cut))
        yield Words(lo, part, at, starts, ends, np.searchsorted(starts, at))


class HashIndex:
    """Numbers of 64-bit keys in an open-addressed numpy table; it doubles as it fills."""

    def __init__(self, bits: int = 12) -> None:
        self.clear(bits)

    def clear(self, bits: int = 12) -> None:
        self.bits, self.count = bits, 0
        self.keys, self.values = np.zeros(1 << bits, _U), np.zeros(1 << bits, np.int32)

    def _place(self, keys: np.ndarray) -> np.ndarray:
        return (keys >> _U(64 - self.bits)).view(np.int64)

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The number of each key, -1 where there is none. Key 0 stands for no key."""
        at, mask = self._place(keys), len(self.keys) - 1
        there = np.take(self.keys, at)
        out = np.take(self.values, at)
        rest = np.flatnonzero(there != keys)
        out[rest] = -1
        rest = rest[there[rest] != 0]
        at = at[rest]
        while len(rest):
            at = at + 1 & mask
            there = self.keys[at]
            hit = there == keys[rest]
            out[rest[hit]] = self.values[at[hit]]
            more = ~hit & (there != 0)
            rest, at = rest[more], at[more]
        return out

    def add(self, keys: np.ndarray, values: np.ndarray) -> None:
        """Keys that are distinct, not 0 and not there yet."""
        if 2 * (self.count + len(keys)) > len(self.keys):
            old = self.keys != 0
            k, v = self.keys[old], self.values[old]
            bits = self.bits
            while 2 * (self.count + len(keys)) > 1 << bits:
                bits += 1
            self.clear(bits)
            self.add(k, v)
        self.count += len(keys)
        at, mask, left = self._place(keys), len(self.keys) - 1, np.arange(len(keys))
        while len(left):
            free = self.keys[at] == 0
            self.keys[at[free]] = keys[left[free]]  # of several at one place, the last stays
            won = self.keys[at] == keys[left]
            self.values[at[won]] = values[left[won]]
            left, at = left[~won], at[~won] + 1 & mask
