"""Vectorised text work on Arrow string columns: byte blocks, word spans, rolling hashes.

Every function takes whole texts as one byte array with row offsets; no text
is cut. Hashes are 64-bit polynomials mod 2^64 with a final mix.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

U64 = np.uint64
BLOCK_BYTES = 2 << 20
_P = 0x9E3779B97F4A7C15 | 1
_PINV = pow(_P, -1, 1 << 64)

SPACE = np.zeros(256, bool)
SPACE[[0x20, 0x09, 0x0A, 0x0B, 0x0C, 0x0D]] = True
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32

_tables: dict[str, np.ndarray] = {}


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """P^0..P^n and their inverses mod 2^64, kept by the worker and grown when a text needs more."""
    have = _tables.get("p")
    if have is None or len(have) <= n:
        size = max(n + 1, BLOCK_BYTES + 1)
        for key, base in (("p", _P), ("i", _PINV)):
            t = np.full(size, base, U64)
            t[0] = 1
            _tables[key] = np.multiply.accumulate(t)
    return _tables["p"], _tables["i"]


def mix(h: np.ndarray) -> np.ndarray:
    h = h ^ (h >> U64(32))
    h *= U64(0xD6E8FEB86659FD93)
    h ^= h >> U64(29)
    h *= U64(0xBF58476D1CE4E5B9)
    h ^= h >> U64(32)
    return h


def string_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(bytes, offsets) of a string column; nulls are empty."""
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    column = column.cast(pa.large_string())
    if column.null_count:
        column = column.fill_null("")
    _, offs, data = column.buffers()
    n = len(column)
    if n == 0:
        return np.empty(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offs, np.int64, n + 1, column.offset * 8)
    raw = np.frombuffer(data, np.uint8) if data is not None and data.size else np.empty(0, np.uint8)
    return raw[offsets[0]:offsets[-1]], offsets - offsets[0]


def blocks(batches, column: str, size: int = BLOCK_BYTES) -> Iterator[tuple[pa.RecordBatch, int, int, np.ndarray, np.ndarray]]:
    """Row ranges of about ``size`` text bytes: (batch, first row, end row, bytes, offsets).

    A longer single text is a block of its own.
    """
    for batch in batches:
        data, offs = string_bytes(batch.column(batch.schema.get_field_index(column)))
        n, at = len(offs) - 1, 0
        while at < n:
            end = int(np.searchsorted(offs, offs[at] + size, "right")) - 1
            end = min(n, max(end, at + 1))
            yield batch, at, end, data[offs[at]:offs[end]], offs[at:end + 1] - offs[at]
            at = end


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """S with S[b]-S[a] = sum of (byte+1)·P^i over i in [a, b)."""
    p, _ = powers(len(data))
    s = np.empty(len(data) + 1, U64)
    s[0] = 0
    np.cumsum((data.astype(U64) + U64(1)) * p[:len(data)], out=s[1:])
    return s


def span_hash(s: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Mixed 64-bit hashes of byte spans, from ``prefix_hash``; equal bytes, equal hash."""
    _, inv = powers(len(s))
    return mix((s[end] - s[start]) * inv[start] + (end - start).astype(U64) * U64(0xA24BAED4963EE407))


def word_spans(data: np.ndarray, offs: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Maximal runs of bytes other than space and \\t..\\r: (starts, ends, words per row)."""
    if not len(data):
        return np.empty(0, np.int64), np.empty(0, np.int64), np.zeros(len(offs) - 1, np.int64)
    word = ~SPACE[data]
    first = word.copy()
    first[1:] &= ~word[:-1]
    inner = offs[1:-1]
    inner = inner[inner < len(data)]
    first[inner] = word[inner]
    last = word.copy()
    last[:-1] &= ~word[1:]
    ends_at = offs[1:-1] - 1
    ends_at = ends_at[ends_at >= 0]
    last[ends_at] = word[ends_at]
    starts, ends = np.flatnonzero(first), np.flatnonzero(last) + 1
    return starts, ends, np.diff(np.searchsorted(starts, offs))
