"""Numpy helpers that the operators run inside Spark tasks on Arrow batches.

A *word* is a maximal run of bytes other than space, tab, line feed, vertical
tab, form feed and carriage return. All helpers work on the bytes of a whole
batch at once, in pieces of a few megabytes, so a very long text costs memory
in proportion to its own length only. A null text counts as an empty one.
"""

from __future__ import annotations

import ctypes
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 2 << 20  # rows are taken together up to this much text
CHUNK_BYTES = 1 << 20  # bytes hashed at a time
_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_BASE_INV = np.uint64(pow(0x9E3779B97F4A7C15 | 1, -1, 1 << 64))

BLANK = np.zeros(256, bool)
BLANK[[0x20, *range(0x09, 0x0E)]] = True
CONTINUATION = (np.arange(256) & 0xC0) == 0x80


def mix(x) -> np.ndarray:
    """A fixed bijection of 64-bit integers that spreads every bit (splitmix64 finaliser)."""
    x = np.asarray(x, np.uint64)
    with np.errstate(over="ignore"):
        x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
        x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_AS_IS = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x632BE59BD9B4E019))
_LOWER = _AS_IS.copy()
_LOWER[65:91] = _AS_IS[97:123]
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    if len(_powers[0]) < n:
        for k, base in enumerate((_BASE, _BASE_INV)):
            p = np.full(n, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


def span_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, lower: bool = False) -> np.ndarray:
    """A 64-bit hash of the bytes of each span; equal bytes give equal hashes wherever they stand."""
    out = np.empty(len(starts), np.uint64)
    table, k = _LOWER if lower else _AS_IS, 0
    while k < len(starts):
        base = int(starts[k])
        j = max(k + 1, int(np.searchsorted(ends, base + CHUNK_BYTES, "right")))
        top = int(ends[j - 1])
        up, down = _power_tables(max(top - base, 1))
        sums = np.zeros(top - base + 1, np.uint64)
        np.cumsum(table[data[base:top]] * up[: top - base], out=sums[1:])
        s, e = starts[k:j] - base, ends[k:j] - base
        out[k:j] = mix((sums[e] - sums[s]) * down[np.minimum(s, len(down) - 1)] + (e - s).astype(np.uint64))
        k = j
    return out


@dataclass
class Texts:
    """The texts of some rows as one array of bytes; row r has ``data[offsets[r]:offsets[r + 1]]``."""

    data: np.ndarray
    offsets: np.ndarray

    @property
    def rows(self) -> int:
        return len(self.offsets) - 1

    def per_row(self, flags: np.ndarray) -> np.ndarray:
        """How many bytes of each row are flagged."""
        total = np.zeros(len(flags) + 1, np.int64)
        np.cumsum(flags, out=total[1:])
        return total[self.offsets[1:]] - total[self.offsets[:-1]]

    def row_of(self, starts: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.offsets, starts, "right") - 1

    def word_spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every word, in order; a word never crosses rows."""
        solid = ~BLANK[self.data]
        edge = np.zeros(len(solid) + 1, bool)
        edge[self.offsets] = True
        begins, closes = solid.copy(), solid.copy()
        begins[1:] &= ~solid[:-1] | edge[1:-1]
        closes[:-1] &= ~solid[1:] | edge[1:-1]
        return np.flatnonzero(begins), np.flatnonzero(closes) + 1

    def line_spans(self) -> tuple[np.ndarray, np.ndarray]:
        """Start and end of every line (text between line feeds), in order; an empty text has one empty line."""
        breaks = np.flatnonzero(self.data == 10)
        first, last = self.offsets[:-1], self.offsets[1:]
        every, of_break = np.arange(self.rows), self.row_of(breaks)
        starts, ends = np.r_[first, breaks + 1], np.r_[breaks, last]
        by_start, by_end = np.lexsort((starts, np.r_[every, of_break])), np.lexsort((ends, np.r_[of_break, every]))
        return starts[by_start], ends[by_end]


def text_array(column: pa.Array) -> Texts:
    """The bytes of an Arrow string column; nulls become empty."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, np.int64, len(column) + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return Texts(raw[at[0]: at[-1]], at - at[0])


def release() -> None:
    """Give freed memory back to the system: an idle worker keeps its process, and so would keep the memory."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL("libc.so.6").malloc_trim(0)
    except (OSError, AttributeError):  # another C library
        pass


def text_slices(batches: Iterator[pa.RecordBatch], column: str = "text",
                limit: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, Texts]]:
    """The rows of the batches with their texts, in slices of at most ``limit`` bytes of text or one row."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
        total = np.cumsum(sizes)
        first = 0
        while first < batch.num_rows:
            before = int(total[first - 1]) if first else 0
            last = max(first + 1, int(np.searchsorted(total, before + limit, "right")))
            part = batch.slice(first, last - first)
            yield part, text_array(part.column(column))
            first = last
    release()


def one_of_each(keys: np.ndarray) -> np.ndarray:
    """The place of one occurrence of each distinct key, places in order."""
    if not len(keys):
        return np.zeros(0, np.int64)
    order = np.argsort(keys)  # not stable, and several times faster for that
    ordered = keys[order]
    own = order[np.r_[True, ordered[1:] != ordered[:-1]]]
    own.sort()
    return own


def signed(x: np.ndarray) -> np.ndarray:
    """The same 64 bits as Spark's long."""
    return np.ascontiguousarray(x, np.uint64).view(np.int64)


def lists(values: pa.Array, sizes: np.ndarray) -> pa.Array:
    """An Arrow list column from flat values and the length of each row's list."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(sizes)].astype(np.int32)), values)
