"""Words of Arrow text columns as numpy arrays.

A word is a run of bytes outside ``\\x20\\x09-\\x0D``.  Words are known by 64-bit polynomial
hashes of their bytes, worked out for a whole stretch of text with prefix sums, so no Python
object is made per word.  Text is taken in stretches that end between words, which bounds the
memory for texts of any length.
"""

from __future__ import annotations

import ctypes
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa

SPACE = np.zeros(256, dtype=bool)
SPACE[[9, 10, 11, 12, 13, 32]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
PLAIN = np.arange(256, dtype=np.uint8)

_STRETCH = 1 << 18
_STEP = 0x9E3779B97F4A7C15
_BASE = 0xD1342543DE82EF95


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that spreads every input bit over the output."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUE = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_STEP)) | np.uint64(1)


class _Powers:
    def __init__(self) -> None:
        self.up = np.ones(1, dtype=np.uint64)
        self.down = np.ones(1, dtype=np.uint64)

    def upto(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n + 1:
            size = max(n, _STRETCH)
            for name, base in (("up", _BASE), ("down", pow(_BASE, -1, 1 << 64))):
                steps = np.full(size + 1, base, dtype=np.uint64)
                steps[0] = 1
                setattr(self, name, np.cumprod(steps, dtype=np.uint64))
        return self.up, self.down


_POWERS = _Powers()


class Text(NamedTuple):
    """Rows ``first`` to ``first + rows - 1`` of a batch: their bytes and where each row begins."""

    first: int
    rows: int
    data: np.ndarray
    offsets: np.ndarray


class Words(NamedTuple):
    """Where each word starts and ends in ``Text.data``, its row, its hash, and the hashes of its first bytes."""

    start: np.ndarray
    end: np.ndarray
    row: np.ndarray
    code: np.ndarray
    heads: tuple[np.ndarray, ...] = ()


def slices(column: pa.Array, limit: int = 1 << 20) -> Iterator[Text]:
    """Consecutive rows with about ``limit`` bytes of text; a longer text comes alone.  Null is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string()) if not pa.types.is_large_string(column.type) else column
    n = len(column)
    if n == 0:
        return
    _, where, values = column.buffers()
    offsets = np.frombuffer(where, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.frombuffer(values, dtype=np.uint8) if values is not None else np.zeros(0, dtype=np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(offsets, offsets[first] + limit, side="right")) - 1
        last = min(n, max(first + 1, last))
        yield Text(first, last - first, data[offsets[first] : offsets[last]], offsets[first : last + 1] - offsets[first])
        first = last


def freeing(work: Callable[[Iterator], Iterator]) -> Callable[[Iterator], Iterator]:
    """``work`` on the batches of a task, after which the worker gives its memory back: idle workers stay."""

    def run(batches: Iterator) -> Iterator:
        try:
            yield from work(batches)
        finally:
            release()

    return run


def release() -> None:
    """Give freed memory back to the system, where its C library can."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):
        pass


def _stretches(space: np.ndarray, breaks: np.ndarray) -> Iterator[tuple[int, int]]:
    """Parts of about ``_STRETCH`` bytes; none ends inside a word."""
    n, low = len(space), 0
    while low < n:
        high = min(n, low + _STRETCH)
        if high < n:
            row = breaks[np.searchsorted(breaks, high, side="right") - 1]
            gaps = np.flatnonzero(space[low:high])
            best = max(int(row), low + int(gaps[-1]) + 1 if len(gaps) else 0)
            if best <= low:  # one word fills the part: go on to its end
                later = breaks[np.searchsorted(breaks, high, side="left")] if high < breaks[-1] else n
                rest = np.flatnonzero(space[high : int(later)])
                best = high + int(rest[0]) if len(rest) else int(later)
            high = best
        yield low, high
        low = high


def _trimmed(data: np.ndarray, s: np.ndarray, e: np.ndarray, edge: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Spans without bytes of ``edge`` at their ends; a span of nothing else stays as it is."""
    a, b = s.copy(), e.copy()
    for move, at, step in ((a, lambda: a, 1), (b, lambda: b - 1, -1)):
        todo = np.flatnonzero(a < b)
        while len(todo):
            todo = todo[edge[data[at()[todo]]]]
            move[todo] += step
            todo = todo[a[todo] < b[todo]]
    empty = a >= b
    a[empty], b[empty] = s[empty], e[empty]
    return a, b


def words(text: Text, fold: np.ndarray = PLAIN, edge: np.ndarray | None = None, heads: tuple[int, ...] = ()) -> Words:
    """All words of the rows, in order.

    ``fold`` maps bytes before hashing (``LOWER``: A-Z to a-z), ``edge`` marks bytes to leave out of
    the hash at both ends of a word, ``heads`` asks for hashes of the first bytes (of all, if fewer).
    """
    data, offsets = text.data, text.offsets
    space = SPACE[data]
    starts, ends, codes, firsts = [], [], [], []
    row_start = np.zeros(len(data) + 1, dtype=bool)
    row_start[offsets] = True
    for low, high in _stretches(space, offsets):
        inside = ~space[low:high]
        begin = inside.copy()
        begin[1:] &= space[low : high - 1] | row_start[low + 1 : high]
        finish = inside.copy()
        finish[:-1] &= space[low + 1 : high] | row_start[low + 1 : high]
        s = np.flatnonzero(begin)
        e = np.flatnonzero(finish) + 1
        up, down = _POWERS.upto(high - low)
        total = np.zeros(high - low + 1, dtype=np.uint64)
        np.cumsum(_BYTE_VALUE[fold[data[low:high]]] * up[: high - low], out=total[1:])
        a, b = (s, e) if edge is None else _trimmed(data[low:high], s, e, edge)
        codes.append(mix((total[b] - total[a]) * down[a]))
        firsts.append([mix((total[np.minimum(a + n, b)] - total[a]) * down[a]) for n in heads])
        starts.append(s + low)
        ends.append(e + low)
    if not starts:
        none = np.zeros(0, dtype=np.int64)
        nothing = np.zeros(0, dtype=np.uint64)
        return Words(none, none, none, nothing, (nothing,) * len(heads))
    start = np.concatenate(starts)
    row = np.searchsorted(offsets, start, side="right") - 1
    first = tuple(np.concatenate([f[i] for f in firsts]) for i in range(len(heads)))
    return Words(start, np.concatenate(ends), row, np.concatenate(codes), first)


def row_bounds(found: Words, rows: int) -> np.ndarray:
    """Where each row's words begin, and the end of the last."""
    return np.searchsorted(found.row, np.arange(rows + 1))
