"""Words and word n-grams of many texts at once, as 64-bit hashes in numpy arrays."""

from __future__ import annotations

import contextlib
import ctypes
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Texts are worked on in groups of about this many bytes, or alone where longer.
GROUP_BYTES = 1 << 20
BASE = 0x9E3779B97F4A7C15 | 1
_U = np.uint64


def mix(h: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values that spreads every bit (the finaliser of splitmix64)."""
    h = (h ^ (h >> _U(30))) * _U(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> _U(27))) * _U(0x94D049BB133111EB)
    return h ^ (h >> _U(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, dtype=_U)
    out[:1] = 1
    return np.multiply.accumulate(out)


def _trim() -> None:
    pa.default_memory_pool().release_unused()
    with contextlib.suppress(OSError, AttributeError):  # only glibc has it
        ctypes.CDLL(None).malloc_trim(0)


def lean(run: Callable[..., Iterator]) -> Callable[..., Iterator]:
    """run, which gives memory that it freed back to the system at its ends: Python workers wait for further stages and would hold it."""

    def trimmed(*given) -> Iterator:
        try:
            yield from run(*given)
        finally:
            _trim()

    return trimmed


def lean_table(run: Callable[[pa.Table], pa.Table]) -> Callable[[pa.Table], pa.Table]:
    """lean() of a function of one group."""

    def trimmed(table: pa.Table) -> pa.Table:
        try:
            return run(table)
        finally:
            _trim()

    return trimmed


class Texts:
    """UTF-8 bytes of some texts and where each begins; null texts are empty."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray) -> None:
        self.data, self.offsets = data, offsets

    def __len__(self) -> int:
        return len(self.offsets) - 1


def groups(column: pa.Array | pa.ChunkedArray, most: int = GROUP_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, row after the last, texts) for groups of rows of a string column."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = pc.fill_null(column.cast(pa.large_string()), "")
    n = len(column)
    if not n:
        return
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(column.buffers()[2] or b"", np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + most, "right")) - 1)
        yield first, last, Texts(data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


class Words:
    """Word hashes of a group of texts. at[i]:at[i + 1] are the words of text i."""

    _pow = _powers(BASE, 1)
    _inv = _powers(pow(BASE, -1, 1 << 64), 1)

    def __init__(self, texts: Texts, lower: bool = True, hashes: bool = True) -> None:
        data, offsets = texts.data, texts.offsets
        inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
        edges = offsets[1:-1]
        edges = edges[(edges > 0) & (edges < len(data))]
        before = np.empty_like(inside)
        before[:1] = False
        before[1:] = inside[:-1]
        before[edges] = False
        after = np.empty_like(inside)
        after[-1:] = False
        after[:-1] = inside[1:]
        after[edges - 1] = False
        self.start = np.flatnonzero(inside & ~before)
        self.end = np.flatnonzero(inside & ~after) + 1
        self.at = np.searchsorted(self.start, offsets)
        if not hashes:
            return
        low = data + ((data >= 65) & (data <= 90)).astype(np.uint8) * np.uint8(32) if lower else data
        cls = type(self)
        if len(cls._pow) <= len(data):
            cls._pow, cls._inv = _powers(BASE, 2 * len(data) + 1), _powers(pow(BASE, -1, 1 << 64), 2 * len(data) + 1)
        total = np.zeros(len(data) + 1, _U)
        np.cumsum((low.astype(_U) + _U(1)) * cls._pow[: len(data)], out=total[1:])
        self._total = total
        self.hash = self.span_hash(self.start, self.end)

    def span_hash(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Hashes of byte ranges of the texts."""
        return mix((self._total[end] - self._total[start]) * self._inv[start])

    def ngrams(self, n: int, short: bool = False) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of all n-grams, and at as for words. short: a text with 1 to n - 1 words has all of them as one."""
        count = np.diff(self.at)
        total = len(self.hash)
        grams = np.zeros(max(0, total - n + 1), _U)
        for k in range(n):
            grams = grams * _U(BASE) + self.hash[k : total - n + 1 + k] if total >= n else grams
        each = np.maximum(count - n + 1, 0)
        keep = np.ones(len(grams), bool)
        for k in range(1, n):  # windows that begin with the last words of a text reach into the next
            ends = self.at[1:] - k
            ends = ends[(count >= k) & (ends < len(grams))]
            keep[ends] = False
        grams = mix(grams[keep] + _U(n))
        if short and len(few := np.flatnonzero((count > 0) & (count < n))):
            whole = np.array([self._all(self.hash[self.at[i] : self.at[i + 1]]) for i in few], _U)
            at = np.concatenate([[0], np.cumsum(each)])
            grams = np.insert(grams, at[few], whole)
            each[few] = 1
        return grams, np.concatenate([[0], np.cumsum(each)]).astype(np.int64)

    @staticmethod
    def _all(hashes: np.ndarray) -> int:
        h = 0
        for x in hashes.tolist():
            h = (h * BASE + x) & 0xFFFFFFFFFFFFFFFF
        return int(mix(np.array([h + (len(hashes) << 8)], _U))[0])
