"""Vectorised words of Arrow text columns, for operators that run numpy in tasks.

A batch is worked through in pieces of about a megabyte of whole texts, so memory
follows the longest text and not the batch. Words are runs of bytes of a table of
256 flags; UTF-8 makes this the same as runs of characters, as every byte of a
character above ASCII is above 127.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

PIECE_BYTES = 1 << 20

_U64 = np.uint64
_ODD = _U64(0x9E3779B97F4A7C15)
_ODD_INVERSE = _U64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

#: Anything but ASCII whitespace.
NOT_SPACE = np.ones(256, dtype=bool)
NOT_SPACE[[0x20, *range(0x09, 0x0E)]] = False

#: Digits, letters and everything above ASCII, of a lower-cased text.
ALPHANUMERIC = np.ones(256, dtype=bool)
ALPHANUMERIC[0x00:0x30] = ALPHANUMERIC[0x3A:0x61] = ALPHANUMERIC[0x7B:0x80] = False


def mixed(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (splitmix finaliser)."""
    x = x ^ (x >> _U64(30))
    x = x * _U64(0xBF58476D1CE4E5B9)
    x ^= x >> _U64(27)
    x *= _U64(0x94D049BB133111EB)
    x ^= x >> _U64(31)
    return x


def constants(n: int, salt: int = 0) -> np.ndarray:
    """n odd 64-bit numbers, the same ones in every process."""
    seeds = np.arange(1, n + 1, dtype=_U64) * _ODD + _U64(salt)
    return mixed(seeds) | _U64(1)


_BYTE_VALUE = constants(256, 7)
_STEP = constants(64, 11)
_LENGTH = constants(64, 13)
_powers: list[np.ndarray] = []


def _byte_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    if not _powers or len(_powers[0]) < n:
        size = max(n, PIECE_BYTES)
        _powers[:] = [
            np.multiply.accumulate(np.concatenate([[_U64(1)], np.full(size - 1, base)]))
            for base in (_ODD, _ODD_INVERSE)
        ]
    return _powers[0], _powers[1]


class Sums:
    """Numbers for runs of bytes; equal bytes have equal numbers wherever they lie."""

    def __init__(self, data: np.ndarray):
        power, self._inverse = _byte_powers(len(data) + 1)
        self._total = np.zeros(len(data) + 1, dtype=_U64)
        np.cumsum(_BYTE_VALUE[data] * power[: len(data)], out=self._total[1:])

    def between(self, begins: np.ndarray, ends: np.ndarray) -> np.ndarray:
        return (self._total[ends] - self._total[begins]) * self._inverse[begins]

    def all_of(self, size: int) -> np.ndarray:
        """Of every run of ``size`` bytes, by its begin."""
        sums = self._total[size:] - self._total[:-size]
        sums *= self._inverse[: len(sums)]
        return sums


class Words:
    """The words of the texts lo..hi of a batch.

    ``hashes``: 64 bits per word. ``first``: words of text i are first[i]..first[i+1].
    ``data`` and ``bounds``: the (lower-cased) bytes and where each text begins.
    """

    def __init__(self, data: np.ndarray, bounds: np.ndarray, table: np.ndarray, lower: bool):
        self.data = LOWER[data] if lower else data
        self.bounds = bounds
        inside = np.zeros(len(data) + 1, dtype=bool)
        np.take(table, self.data, out=inside[:-1])
        before = np.zeros(len(data) + 1, dtype=bool)
        before[1:] = inside[:-1]
        cut = bounds[:-1]  # a text's first byte never continues a word
        before[cut] = False
        self.starts = np.flatnonzero(inside & ~before)
        after = np.zeros(len(data), dtype=bool)
        after[:] = inside[1:]
        last = bounds[1:] - 1
        after[last[(last >= 0) & (bounds[1:] > cut)]] = False
        self.ends = np.flatnonzero(inside[:-1] & ~after) + 1
        self.first = np.searchsorted(self.starts, bounds)
        self._hashes: np.ndarray | None = None

    @property
    def hashes(self) -> np.ndarray:
        if self._hashes is None:
            power, inverse = _byte_powers(len(self.data) + 1)
            total = np.zeros(len(self.data) + 1, dtype=_U64)
            np.cumsum(_BYTE_VALUE[self.data] * power[: len(self.data)], out=total[1:])
            sums = (total[self.ends] - total[self.starts]) * inverse[self.starts]
            self._hashes = mixed(sums)
        return self._hashes

    def __len__(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def windows(hashes: np.ndarray, first: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``size`` words, and where those of each text begin.

    A text of fewer words, but not none, has its whole sequence as its one window.
    """
    counts = np.diff(first)
    full = np.maximum(counts - size + 1, 0)
    short = (counts > 0) & (counts < size)
    begins = np.concatenate([[0], np.cumsum(full + short)])
    summed = np.zeros(max(len(hashes) - size + 1, 0), dtype=_U64)
    for k in range(size):
        summed += hashes[k : k + len(summed)] * _STEP[k]
    out = np.empty(begins[-1], dtype=_U64)
    at = np.flatnonzero(full)
    if len(at):
        where = np.repeat(first[at] - begins[at], full[at])
        target = np.ones(begins[-1], dtype=bool)
        target[begins[:-1][short]] = False
        out[target] = summed[np.flatnonzero(target) + where]
    for i in np.flatnonzero(short):
        own = hashes[first[i] : first[i + 1]]
        out[begins[i]] = np.sum(own * _STEP[: len(own)] + _LENGTH[len(own)], dtype=_U64)
    return mixed(out), begins


def raw_text(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Bytes of a text column and n + 1 bounds; NULL is an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "" if pa.types.is_string(column.type) else b"")
    wide = pa.types.is_large_string(column.type) or pa.types.is_large_binary(column.type)
    _, offsets, data = column.buffers()
    kind = np.int64 if wide else np.int32
    if len(column) == 0 or offsets is None:
        return np.empty(0, dtype=np.uint8), np.zeros(len(column) + 1, dtype=np.int64)
    bounds = np.frombuffer(offsets, dtype=kind)[column.offset : column.offset + len(column) + 1]
    content = np.empty(0, dtype=np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return content, bounds.astype(np.int64)


def pieces(column: pa.Array, size: int = PIECE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """(lo, hi, bytes, bounds) of runs of whole texts of about ``size`` bytes."""
    content, bounds = raw_text(column)
    lo, rows = 0, len(bounds) - 1
    while lo < rows:
        hi = int(np.searchsorted(bounds, bounds[lo] + size, side="right")) - 1
        hi = min(max(hi, lo + 1), rows)
        yield lo, hi, content[bounds[lo] : bounds[hi]], bounds[lo : hi + 1] - bounds[lo]
        lo = hi


def words_of(
    column: pa.Array, table: np.ndarray = NOT_SPACE, lower: bool = True, size: int = PIECE_BYTES
) -> Iterator[tuple[int, int, Words]]:
    for lo, hi, data, bounds in pieces(column, size):
        yield lo, hi, Words(data, bounds, table, lower)


def summed_by(values: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Sum of values[begins[i]:begins[i+1]] for every i; 0 where there is none."""
    total = np.concatenate([[0], np.cumsum(values)])
    return total[begins[1:]] - total[begins[:-1]]
