"""Words and word n-grams of Arrow text columns as numpy arrays.

The operators that look at every word of the corpus read the bytes of an Arrow column in place
and work on 64-bit hashes, a few megabytes at a time, so a task's memory does not depend on the
number of rows in a batch. A word is a run of bytes other than ``[\\x20\\x09-\\x0D]``; as these are
ASCII, cutting UTF-8 bytes and cutting code points give the same words.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

CHUNK_BYTES = 2 << 20
SECTION_BYTES = 1 << 18  # a worker keeps two numbers of 64 bits for each byte

SPACE = np.zeros(256, dtype=bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True

_ODD = 0x9E3779B97F4A7C15 | 1
_MASK = (1 << 64) - 1


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection on 64 bits that spreads every bit over all others."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.empty(n, dtype=np.uint64)
    out[0] = 1
    done = 1
    while done < n:
        more = min(done, n - done)
        out[done : done + more] = out[:more] * np.uint64(pow(base, done, 1 << 64))
        done += more
    return out


BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(_ODD))
LOWER = np.arange(256, dtype=np.uint8)
LOWER[ord("A") : ord("Z") + 1] += 32

_up = _powers(_ODD, 1 << 12)
_down = _powers(pow(_ODD, -1, 1 << 64), 1 << 12)


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first ``n`` powers of the byte hash's base and of its inverse, kept between calls."""
    global _up, _down
    if len(_up) < n:
        size = 1 << (n - 1).bit_length()
        _up, _down = _powers(_ODD, size), _powers(pow(_ODD, -1, 1 << 64), size)
    return _up[:n], _down[:n]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each byte span; spans are sorted and do not overlap."""
    out = np.empty(len(starts), dtype=np.uint64)
    first = 0
    while first < len(starts):
        base = starts[first]
        last = max(first + 1, int(np.searchsorted(ends, base + SECTION_BYTES, side="right")))
        stop = ends[last - 1]
        up, down = powers(int(stop - base) + 1)
        total = np.zeros(int(stop - base) + 1, dtype=np.uint64)
        np.cumsum(BYTE_VALUES[data[base:stop]] * up[1:], out=total[1:])
        s, e = starts[first:last] - base, ends[first:last] - base
        out[first:last] = mix((total[e] - total[s]) * down[s] + (e - s).astype(np.uint64))
        first = last
    return out


@dataclass
class Chunk:
    """The words of some consecutive rows: hash, place of the bytes, and each row's words."""

    first_row: int
    data: np.ndarray
    starts: np.ndarray
    ends: np.ndarray
    hashes: np.ndarray
    bounds: np.ndarray  # row i has the words bounds[i]:bounds[i + 1]
    offsets: np.ndarray  # and the bytes offsets[i]:offsets[i + 1]

    @property
    def rows(self) -> int:
        return len(self.bounds) - 1

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.bounds)

    def row_of_word(self) -> np.ndarray:
        return np.repeat(np.arange(self.rows), self.counts)

    def grams(self, k: int) -> tuple[np.ndarray, np.ndarray]:
        """The hash of the ``k`` words from each word on, and where these are of one row."""
        n = len(self.hashes)
        if n < k:
            return np.zeros(n, dtype=np.uint64), np.zeros(n, dtype=bool)
        whole = np.zeros(n, dtype=np.uint64)
        total = self.hashes[: n - k + 1].copy()
        for j in range(1, k):
            total *= np.uint64(0xD6E8FEB86659FD93)
            total += self.hashes[j : n - k + 1 + j]
        whole[: n - k + 1] = mix(total)
        left = np.repeat(self.bounds[1:], self.counts) - np.arange(n)
        return whole, left >= k


def bytes_of(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """All bytes and the rows' offsets of a text column; NULL is empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if column.null_count:
        column = pc.fill_null(column, "")
    column = column.cast(pa.large_binary())
    n = len(column)
    if n == 0:
        return np.zeros(0, dtype=np.uint8), np.zeros(1, dtype=np.int64)
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, dtype=np.int64)[column.offset : column.offset + n + 1]
    data = np.zeros(0, np.uint8) if data is None else np.frombuffer(data, dtype=np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def row_chunks(offsets: np.ndarray, chunk_bytes: int = CHUNK_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of rows of about ``chunk_bytes``; a longer row is a range of its own."""
    row, n = 0, len(offsets) - 1
    while row < n:
        last = int(np.searchsorted(offsets, offsets[row] + chunk_bytes, side="right")) - 1
        last = min(max(last, row + 1), n)
        yield row, last
        row = last


def word_chunks(column: pa.Array, lower: bool = False, chunk_bytes: int = CHUNK_BYTES) -> Iterator[Chunk]:
    """The words of a text column, in chunks of whole rows. ``lower`` maps A-Z to a-z first."""
    data, offsets = bytes_of(column)
    for row, last in row_chunks(offsets, chunk_bytes):
        part = data[offsets[row] : offsets[last]]
        if lower:
            part = LOWER[part]
        own = offsets[row : last + 1] - offsets[row]
        inside = ~SPACE[part]
        n = len(part)
        cut = np.zeros(n + 1, dtype=bool)
        cut[own] = True
        before = np.ones(n, dtype=bool)
        before[1:] = ~inside[:-1]
        before |= cut[:-1]
        after = np.ones(n, dtype=bool)
        after[:-1] = ~inside[1:]
        after |= cut[1:]
        starts = np.flatnonzero(inside & before)
        ends = np.flatnonzero(inside & after) + 1
        yield Chunk(row, part, starts, ends, span_hashes(part, starts, ends), np.searchsorted(starts, own), own)


def signed(x: np.ndarray) -> np.ndarray:
    """64-bit hashes as Spark's long."""
    return x.view(np.int64)


def sliding_min(values: np.ndarray, width: int) -> np.ndarray:
    """The minimum of ``values[i : i + width]`` for each i that has so many."""
    n = len(values)
    if n < width:
        return values[:0]
    pad = -n % width
    blocks = np.concatenate([values, np.full(pad, np.iinfo(values.dtype).max, values.dtype)]).reshape(-1, width)
    ahead = np.minimum.accumulate(blocks, axis=1).ravel()
    back = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[: n - width + 1], ahead[width - 1 : n])
