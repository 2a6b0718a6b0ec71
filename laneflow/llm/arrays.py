"""Texts as flat byte arrays inside Arrow tasks: words, hashes, bounded batches."""

from __future__ import annotations

import ctypes
from collections.abc import Iterator

import numpy as np
import pyarrow as pa

#: Text bytes that a task works on at once; a longer document is worked alone.
BATCH_BYTES = 1 << 20

U64 = np.uint64

#: A-Z to a-z, all other bytes as they are.
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Mask of 256 with the bytes of the ranges, both ends included."""
    mask = np.zeros(256, dtype=bool)
    for low, high in ranges:
        mask[low : high + 1] = True
    return mask


#: Separators of words `[^\x20\x09-\x0D]+`.
BLANKS = byte_set((0x20, 0x20), (0x09, 0x0D))
#: Separators of words `[^\x00-\x2F\x3A-\x60\x7B-\x7F]+`.
NON_WORD = byte_set((0x00, 0x2F), (0x3A, 0x60), (0x7B, 0x7F))


def mix(x: np.ndarray) -> np.ndarray:
    """Finalizer of splitmix64 on an array of uint64."""
    x = x ^ (x >> U64(30))
    x = x * U64(0xBF58476D1CE4E5B9)
    x ^= x >> U64(27)
    x *= U64(0x94D049BB133111EB)
    return x ^ (x >> U64(31))


def salts(n: int, seed: int = 1) -> np.ndarray:
    """n fixed odd numbers."""
    with np.errstate(over="ignore"):
        return mix(np.arange(1, n + 1, dtype=U64) * U64(0x9E3779B97F4A7C15) + U64(seed)) | U64(1)


_BYTE = salts(256, seed=7)


def _powers(n: int) -> np.ndarray:
    out = np.empty(n, dtype=U64)
    out[0] = 1
    if n > 1:
        out[1:] = U64(0x9E3779B97F4A7C15)
        np.cumprod(out, out=out)
    return out


def texts(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """The column's bytes and n + 1 offsets into them; null counts as empty."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    column = column.cast(pa.large_binary()).fill_null(b"")
    _, places, data = column.buffers()
    offsets = np.frombuffer(places, dtype=np.int64)[column.offset : column.offset + len(column) + 1] if places else np.zeros(1, np.int64)
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    flat = np.frombuffer(data, dtype=np.uint8) if data else np.zeros(0, np.uint8)
    return flat[offsets[0] : offsets[-1]], offsets - offsets[0]


def pieces(batches: Iterator[pa.RecordBatch], text: str = "text", most: int = BATCH_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Slices of the batches with at most so many text bytes, or one row, with their bytes and offsets."""
    for batch in batches:
        flat, offsets = texts(batch.column(batch.schema.get_field_index(text)))
        row, rows = 0, batch.num_rows
        while row < rows:
            end = max(row + 1, int(np.searchsorted(offsets, offsets[row] + most, side="right")) - 1)
            yield batch.slice(row, end - row), flat[offsets[row] : offsets[end]], offsets[row : end + 1] - offsets[row]
            row = end
    give_back()


def give_back() -> None:
    """Returns this worker's freed memory to the machine: a worker outlives its tasks, and others need the room."""
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)
    if trim:
        trim(0)


def word_spans(flat: np.ndarray, offsets: np.ndarray, separators: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of every word; words don't cross rows."""
    n = len(flat)
    if not n:
        return (np.zeros(0, np.int64),) * 3
    inside = ~separators[flat]
    edge = np.zeros(n + 1, dtype=bool)
    edge[offsets] = True
    first, last = inside.copy(), inside.copy()
    first[1:] &= ~inside[:-1] | edge[1:n]
    last[:-1] &= ~inside[1:] | edge[1:n]
    starts = np.flatnonzero(first)
    return starts, np.flatnonzero(last) + 1, np.searchsorted(offsets, starts, side="right") - 1


#: Spans that are hashed at once: short ones stay in a core's cache.
SPANS_AT_ONCE = 2_048


def span_hashes(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of the bytes of each span; spans follow each other and aren't empty."""
    if not len(starts):
        return np.zeros(0, U64)
    lengths = ends - starts
    powers, sums = _powers(int(lengths.max())), np.empty(len(starts), U64)
    for at in range(0, len(starts), SPANS_AT_ONCE):
        some = slice(at, at + SPANS_AT_ONCE)
        n = lengths[some]
        first = np.cumsum(n) - n
        place = np.arange(first[-1] + n[-1], dtype=np.int64) - np.repeat(first, n)
        body = flat[place + np.repeat(starts[some], n)]
        with np.errstate(over="ignore"):
            sums[some] = np.add.reduceat(_BYTE[body] * powers[place], first)
    with np.errstate(over="ignore"):
        return mix(sums + lengths.astype(U64) * U64(0xD6E8FEB86659FD93))
