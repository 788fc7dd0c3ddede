"""Whole texts as word hashes, a few megabytes at a time.

A word is a run of anything but the six ASCII white-space bytes, so words can be found in UTF-8 bytes directly. All
functions work on one Arrow column slice and return NumPy arrays; the tasks of the operators call them batch by batch.
Hashes are 64 bits wide and depend on nothing but the bytes, so they agree between tasks, runs and machines.
"""

from __future__ import annotations

import string
from collections.abc import Callable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: White space as Java's and DuckDB's regular expressions spell it.
SPACE_CLASS = r"[\x20\x09-\x0D]"
SPACES = " \t\n\x0b\x0c\r"
CHUNK_BYTES = 1 << 20

IS_SPACE = np.zeros(256, bool)
IS_SPACE[[0x20, *range(0x09, 0x0E)]] = True
#: White space and ASCII punctuation.
IS_SPACE_OR_MARK = IS_SPACE.copy()
IS_SPACE_OR_MARK[[ord(c) for c in string.punctuation]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the entropy of 64-bit values over all bits (a bijection)."""
    x = np.asarray(x, np.uint64)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xFF51AFD7ED558CCD)
    x = (x ^ (x >> np.uint64(33))) * np.uint64(0xC4CEB9FE1A85EC53)
    return x ^ (x >> np.uint64(33))


_BYTE = mix(np.arange(1, 257, dtype=np.uint64))


class _Rolling:
    """Polynomial hashes of ranges of a sequence, modulo 2**64, from one prefix sum."""

    def __init__(self, base: int) -> None:
        self.base, self.inverse = base, pow(base, -1, 1 << 64)
        self.up = self.down = np.ones(1, np.uint64)

    def _grow(self, n: int) -> None:
        if len(self.up) < n:
            n = max(n, 1 << 16)
            for name, factor in (("up", self.base), ("down", self.inverse)):
                powers = np.full(n, factor, np.uint64)
                powers[0] = 1
                setattr(self, name, np.multiply.accumulate(powers))

    def ranges(self, values: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        n = len(values)
        self._grow(n + 1)
        prefix = np.zeros(n + 1, np.uint64)
        np.cumsum(values * self.up[:n], out=prefix[1:])
        return mix((prefix[end] - prefix[start]) * self.down[start])


_WORD = _Rolling(0x9E3779B97F4A7C15)
_GRAM = (_Rolling(0xD6E8FEB86659FD93), _Rolling(0xA0761D6478BD642F))


@dataclass
class Words:
    """The words of a run of texts: byte range and hash of each, and where each text's words begin."""

    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    first: np.ndarray  # one longer than there are texts

    def __len__(self) -> int:
        return len(self.start)

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)

    @property
    def text_of(self) -> np.ndarray:
        """The number of the text that each word belongs to."""
        return np.repeat(np.arange(len(self.first) - 1), self.counts)

    def strings(self, lo: int, hi: int) -> list[bytes]:
        return [self.data[a:b].tobytes() for a, b in zip(self.start[lo:hi], self.end[lo:hi], strict=True)]

    def joined(self, index: np.ndarray) -> bytes:
        """The words numbered in ``index``, joined by one space."""
        if not len(index):
            return b""
        length = self.end[index] - self.start[index] + 1
        stop = np.cumsum(length)
        at = np.arange(stop[-1]) + np.repeat(self.start[index] - (stop - length), length)
        at[stop - 1] = 0
        out = self.data[at]
        out[stop - 1] = 0x20
        return out[:-1].tobytes()


def slices(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The batch in runs of rows whose ``column`` holds about ``limit`` bytes; a longer text is a run of its own."""
    if not batch.num_rows:
        return
    sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
    total = np.cumsum(sizes, dtype=np.int64)
    at = 0
    while at < batch.num_rows:
        before = total[at - 1] if at else 0
        to = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
        yield batch.slice(at, to - at)
        at = to


def split_words(
    column: pa.Array,
    lower: bool = False,
    between: np.ndarray = IS_SPACE,
    apart: Callable[[np.ndarray], tuple[np.ndarray, np.ndarray]] | None = None,
) -> Words:
    """The words of a text column (NULL: none); ``lower`` turns A-Z to a-z and nothing else.

    ``between`` marks the bytes that separate words. ``apart`` finds in the bytes the places of more of these, and
    places at which a word begins even if the byte before belongs to one.
    """
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string() if pa.types.is_string(column.type) else column.type)
    column = pc.fill_null(column, "").cast(pa.large_binary())
    offsets = np.frombuffer(column.buffers()[1], np.int64)[column.offset : column.offset + len(column) + 1]
    body = column.buffers()[2]
    data = np.frombuffer(body, np.uint8)[offsets[0] : offsets[-1]] if body is not None else np.zeros(0, np.uint8)
    bounds = offsets - offsets[0]
    if lower:
        data = _LOWER[data]
    inside = ~between[data]
    edges = bounds[(bounds > 0) & (bounds < len(data))]
    if apart is not None:
        gaps, cuts = apart(data)
        inside[gaps] = False
        edges = np.concatenate([edges, cuts[(cuts > 0) & (cuts < len(data))]])
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    begins[edges] = inside[edges]
    ends[edges - 1] = inside[edges - 1]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    return Words(data, start, end, _WORD.ranges(_BYTE[data], start, end), np.searchsorted(start, bounds, "left"))


def gram_hashes(hashes: np.ndarray, size: int, lane: int = 0) -> np.ndarray:
    """The hash of the ``size`` words that start at each word, as far as there are so many; it may cross texts."""
    n = max(0, len(hashes) - size + 1)
    start = np.arange(n)
    return _GRAM[lane].ranges(hashes, start, start + size)


def gram_starts(words: Words, size: int) -> np.ndarray:
    """The numbers of the words at which ``size`` words of one text start."""
    n = max(0, len(words) - size + 1)
    stop = np.repeat(words.first[1:], words.counts)[:n]
    return np.flatnonzero(np.arange(n) + size <= stop)


def range_hashes(hashes: np.ndarray, start: np.ndarray, end: np.ndarray, lane: int = 0) -> np.ndarray:
    return _GRAM[lane].ranges(hashes, start, end)


def sliding_argmin(keys: np.ndarray, width: int) -> np.ndarray:
    """For each run of ``width`` keys the place of the smallest, the leftmost of equals (by the upper 40 bits)."""
    n = len(keys) - width + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    if len(keys) >= 1 << 24:
        half = 1 << 23
        left = sliding_argmin(keys[: half + width - 1], width)
        return np.concatenate([left, half + sliding_argmin(keys[half:], width)])
    low = np.uint64((1 << 24) - 1)
    best = (keys & ~low) | np.arange(len(keys), dtype=np.uint64)
    span = 1
    while span * 2 <= width:
        best = np.minimum(best[:-span], best[span:])
        span *= 2
    if span < width:
        best = np.minimum(best[: n], best[width - span : width - span + n])
    return (best[:n] & low).astype(np.int64)


def signed(x: np.ndarray) -> np.ndarray:
    """Spark's long holds the same 64 bits."""
    return x.view(np.int64)


def unsigned(x: np.ndarray) -> np.ndarray:
    return np.ascontiguousarray(x, np.int64).view(np.uint64)
