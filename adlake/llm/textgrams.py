"""Vectorised word hashing over Arrow string columns.

A batch of texts is one UTF-8 byte buffer with document offsets.  Words are
maximal runs without ASCII white space (0x20, 0x09-0x0D), so they can be found
in the bytes alone.  A running polynomial hash over a block of the buffer gives
the 64-bit hash of any byte range in it by one subtraction and one
multiplication, so no Python object is made for a word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Bytes of text handled at once; a longer single document is handled alone.
CHUNK_BYTES = 1 << 19
#: Bytes of a buffer that are hashed together.
HASH_BYTES = 1 << 17

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INVERSE = np.uint64(pow(int(_BASE), -1, 1 << 64))

_SPACE = np.zeros(256, bool)
_SPACE[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[ord("A") : ord("Z") + 1] += 32


class _Powers:
    """Powers of the hash base and of its inverse modulo 2^64, grown on demand."""

    def __init__(self) -> None:
        self.up = np.ones(1, np.uint64)
        self.down = np.ones(1, np.uint64)

    def get(self, n: int) -> tuple[np.ndarray, np.ndarray]:
        if len(self.up) < n:
            for name, base in (("up", _BASE), ("down", _BASE_INVERSE)):
                a = np.full(n, base, np.uint64)
                a[0] = 1
                setattr(self, name, np.cumprod(a, dtype=np.uint64))
        return self.up[:n], self.down[:n]


_POWERS = _Powers()


def mix(x: np.ndarray) -> np.ndarray:
    """A 64-bit finaliser: every input bit reaches every output bit."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def join_hashes(*parts: np.ndarray) -> np.ndarray:
    """The hash of a sequence of hashes; the order counts."""
    h = parts[0]
    for p in parts[1:]:
        h = mix(h * np.uint64(0xD6E8FEB86659FD93) + p)
    return h


class Texts:
    """Some documents of a batch as one byte buffer."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, lower: bool = False) -> None:
        self.data = _LOWER[data] if lower else data
        self.offsets = offsets
        self.n = len(offsets) - 1

    def range_hash(self, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
        """64-bit hashes of the byte ranges, whose starts and ends both rise."""
        out = np.empty(len(starts), np.uint64)
        k = 0
        while k < len(starts):
            low = int(starts[k])
            # the ranges that end in this block; a longer range is a block of its own
            stop = max(k + 1, int(np.searchsorted(ends, low + HASH_BYTES, "right")))
            s, e = starts[k:stop] - low, ends[k:stop] - low
            size = int(e[-1])
            up, down = _POWERS.get(size + 1) if size <= HASH_BYTES else _Powers().get(size + 1)
            prefix = np.zeros(size + 1, np.uint64)
            np.cumsum((self.data[low : low + size].astype(np.uint64) + np.uint64(1)) * up[:-1], out=prefix[1:])
            out[k:stop] = mix((prefix[e] - prefix[s]) * down[s] + (e - s).astype(np.uint64))
            k = stop
        return out

    def words(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Byte starts and ends of all words, and the first word's number of each document (n + 1 long)."""
        solid = ~_SPACE[self.data]
        before = np.zeros(len(solid) + 1, bool)
        before[1:] = solid
        after = np.zeros(len(solid) + 1, bool)
        after[:-1] = solid
        before[self.offsets] = False  # a document's edge parts words
        edges = self.offsets[1:]
        starts = np.flatnonzero(solid & ~before[:-1])
        after_next = after[1:].copy()
        after_next[edges[edges > 0] - 1] = False
        ends = np.flatnonzero(solid & ~after_next) + 1
        return starts, ends, np.searchsorted(starts, self.offsets)

    def owner(self, first: np.ndarray) -> np.ndarray:
        """The document of each item, from the items' first numbers."""
        return np.repeat(np.arange(self.n), np.diff(first))


def chunks(column: pa.Array, lower: bool = False, size: int = CHUNK_BYTES) -> Iterator[tuple[int, int, Texts]]:
    """(first row, end row, Texts) of consecutive rows with about *size* bytes; a null counts as an empty text."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = pc.fill_null(column, "")
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1] if len(column) else np.zeros(1, np.int64)
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    row = 0
    while row < len(column):
        end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + size, "right")) - 1)
        yield row, end, Texts(data[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row], lower)
        row = end


def per_document(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    """Sums of each document's slice of *values* (zero for an empty slice)."""
    total = np.zeros(len(values) + 1, np.float64 if values.dtype.kind == "f" else np.int64)
    np.cumsum(values, out=total[1:])
    return total[first[1:]] - total[first[:-1]]
