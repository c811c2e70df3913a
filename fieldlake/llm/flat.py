"""Whole Arrow batches of texts as flat numpy arrays.

A batch is cut into slices of a few MB of text and at most SLICE_ROWS rows (a
longer document is a slice of its own), so the arrays below stay small whatever the batch holds.  Words
are maximal runs of bytes other than the ASCII white space 0x20, 0x09-0x0D;
UTF-8 continuation bytes never collide with those."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

SLICE_BYTES = 2 << 20
SLICE_ROWS = 1 << 15

SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True
MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], np.uint64)
ODD = np.uint64(0x9E3779B97F4A7C15)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError, TypeError):   # another C library
    _trim = None


def give_back() -> None:
    """Free memory goes back to the system: a Python worker that waits for its
    next task, or another stage's, shares its executor's memory."""
    pa.default_memory_pool().release_unused()
    if _trim:
        _trim(0)


def mix(x: np.ndarray) -> np.ndarray:
    """Scramble 64-bit integers (the splitmix64 finaliser); returns a new array."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def ragged(lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Row number and index within the row of every element of rows of the given lengths."""
    row = np.repeat(np.arange(len(lengths)), lengths)
    first = np.cumsum(lengths) - lengths
    return row, np.arange(len(row)) - first[row]


def tidy(run):
    """``run`` over a task's batches; what it freed goes back to the system when the task ends."""
    def tidied(batches):
        try:
            yield from run(batches)
        finally:
            give_back()
    return tidied


def small(batches, most: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of about ``most`` bytes, for what makes Python objects of them."""
    for b in batches:
        rows = max(1, int(b.num_rows * most / max(1, b.nbytes)))
        for first in range(0, b.num_rows, rows):
            yield b.slice(first, rows)


class Texts:
    """``data`` (uint8, 8 zero bytes appended) and ``offsets`` of a slice's
    documents; ``rows`` says which rows of the batch they are."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, rows: range):
        self.data, self.offsets, self.rows = data, offsets, rows

    def __len__(self) -> int:
        return len(self.offsets) - 1

    def text(self, i: int) -> bytes:
        return self.data[self.offsets[i]:self.offsets[i + 1]].tobytes()


def slices(column, max_bytes: int = SLICE_BYTES) -> Iterator[Texts]:
    """The texts of an Arrow string or binary column, slice by slice; null counts as empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_binary()).fill_null(b"")
    n = len(column)
    if not n:
        return
    at = np.frombuffer(column.buffers()[1], np.int64)[column.offset:column.offset + n + 1]
    body = column.buffers()[2]
    whole = np.frombuffer(body, np.uint8) if body is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = max(first + 1, int(np.searchsorted(at, at[first] + max_bytes, "right")) - 1)
        last = min(last, n, first + SLICE_ROWS)
        size = int(at[last] - at[first])
        data = np.zeros(size + 8, np.uint8)
        data[:size] = whole[at[first]:at[last]]
        yield Texts(data, at[first:last + 1] - at[first], range(first, last))
        first = last
    if len(whole) > max_bytes:
        give_back()


class Words:
    """Start and end byte of every word, the number of words of each document
    and the first word of each document (``first`` has one entry more)."""

    def __init__(self, t: Texts, space: np.ndarray = SPACE):
        data, off = t.data[:-8], t.offsets
        solid = ~space[data]
        start, end = solid.copy(), solid.copy()
        start[1:] &= ~solid[:-1]
        end[:-1] &= ~solid[1:]
        has = off[1:] > off[:-1]
        a, b = off[:-1][has], off[1:][has] - 1
        start[a], end[b] = solid[a], solid[b]
        self.start, self.end = np.flatnonzero(start), np.flatnonzero(end) + 1
        self.first = np.searchsorted(self.start, off)
        self.count = np.diff(self.first)
        self.doc = np.repeat(np.arange(len(t)), self.count)

    def hashes(self, t: Texts) -> np.ndarray:
        return span_hashes(t, self.start, self.end)


def span_hashes(t: Texts, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes and length, eight bytes a step."""
    view = np.ndarray((len(t.data) - 7,), "<u8", t.data, strides=(1,))
    size = end - start
    h = mix(view[start] & MASK[np.minimum(size, 8)]) + size.astype(np.uint64) * ODD
    done, left = 8, np.flatnonzero(size > 8)
    while len(left):
        piece = view[start[left] + done] & MASK[np.minimum(size[left] - done, 8)]
        h[left] = mix(h[left] * ODD ^ piece)
        done += 8
        left = left[size[left] > done]
    return mix(h)


def powers(base: int, n: int) -> np.ndarray:
    """base**0 .. base**(n-1) modulo 2**64, by doubling."""
    out = np.ones(max(n, 1), np.uint64)
    have = 1
    while have < n:
        step = min(have, n - have)
        out[have:have + step] = out[:step] * np.uint64(pow(base, have, 1 << 64))
        have += step
    return out[:n]


class Windows:
    """Hashes of k consecutive units (words or bytes) from prefix sums of
    unit * base**i modulo 2**64.  A unit is a scrambled 64-bit value."""

    def __init__(self, units: np.ndarray, base: int = 0x9FB21C651E98DF25):
        self.n = len(units)
        self.prefix = np.zeros(self.n + 1, np.uint64)
        np.cumsum(units * powers(base, self.n), out=self.prefix[1:])
        self.back = powers(pow(base, -1, 1 << 64), self.n + 1)

    def all(self, k: int) -> np.ndarray:
        """Of every window of k units, those across documents included."""
        if self.n < k:
            return np.zeros(0, np.uint64)
        return mix((self.prefix[k:] - self.prefix[:-k]) * self.back[:self.n - k + 1])

    def at(self, start: np.ndarray, k) -> np.ndarray:
        return mix((self.prefix[start + k] - self.prefix[start]) * self.back[start])


def sliding_min(x: np.ndarray, width: int) -> np.ndarray:
    """Minimum of every ``width`` consecutive entries, by doubling."""
    have, out = 1, x
    while have < width:
        step = min(have, width - have)
        out = np.minimum(out[:-step], out[step:])
        have += step
    return out


def anchors(gram: np.ndarray, width: int, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """For every ``width`` consecutive grams, where the smallest is (the
    leftmost of equal ones); ``inside`` marks the windows (by first gram) that
    lie in one document.  Returns the distinct places and, for each, the first
    window it serves and how many; those are consecutive.  Equal windows are
    served by equal grams at equal offsets, wherever they stand."""
    count = max(0, len(gram) - width + 1)
    low = np.uint64((1 << 26) - 1)
    place = np.empty(count, np.int64)
    step = (1 << 26) - width
    for begin in range(0, count, step):
        part = gram[begin:begin + step + width - 1]
        key = (part & ~low) | np.arange(len(part), dtype=np.uint64)
        place[begin:begin + step] = (sliding_min(key, width) & low).astype(np.int64) + begin
    window = np.flatnonzero(inside[:count])
    place = place[window]
    new = np.flatnonzero(np.diff(place, prepend=-1))
    return place[new], window[new], np.diff(new, append=len(place))
