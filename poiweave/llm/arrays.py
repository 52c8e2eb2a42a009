"""Array helpers for tasks: Arrow text columns as bytes, rolling hashes, words, grouped rows.

Every helper works on one bounded slice of a batch; Spark partitions and shuffles the work.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

SLICE_BYTES = 1 << 20
_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_BYTE_VALUES = np.random.default_rng(20240229).integers(1, 1 << 63, 256, dtype=np.uint64)
SPACE = np.zeros(256, bool)
SPACE[[32, 9, 10, 11, 12, 13]] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_powers = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def mix(h: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    h = (h ^ (h >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(31))


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the hash base and of its inverse, at least ``n`` of each."""
    if len(_powers[0]) < n:
        size = 1 << max(16, (n - 1).bit_length())
        for k, base in enumerate((_BASE, pow(_BASE, -1, 1 << 64))):
            p = np.full(size, base & _MASK, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


def prefix_hash(data: np.ndarray) -> np.ndarray:
    """H with H[e] - H[s] standing for bytes s..e, to be scaled by the inverse power of s."""
    out = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_BYTE_VALUES[data] * powers(len(data) + 1)[0][: len(data)], out=out[1:])
    return out


def span_hash(prefix: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """64-bit hash of each span of bytes, equal for equal bytes wherever they stand."""
    return mix((prefix[end] - prefix[start]) * powers(len(prefix))[1][start] + (end - start).astype(np.uint64))


def column(batch: pa.RecordBatch, name: str):
    return batch.column(batch.schema.get_field_index(name))


def text_bytes(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of all texts in a row, and the offset of each text; null is empty."""
    texts = pc.fill_null(texts, b"" if pa.types.is_binary(texts.type) else "")
    wide = pa.types.is_large_string(texts.type) or pa.types.is_large_binary(texts.type)
    _, offsets, data = texts.buffers()
    kind = np.int64 if wide else np.int32
    at = np.frombuffer(offsets, kind)[texts.offset : texts.offset + len(texts) + 1].astype(np.int64) if offsets else np.zeros(1, np.int64)
    raw = np.frombuffer(data, np.uint8)[at[0] : at[-1]] if data is not None and at[-1] > at[0] else np.zeros(0, np.uint8)
    return raw, at - at[0]


def slices(batches, name: str = "text", most: int = SLICE_BYTES) -> Iterator[tuple[pa.RecordBatch, np.ndarray, np.ndarray]]:
    """Runs of whole rows with about ``most`` bytes of text: the rows, their bytes and offsets."""
    for batch in batches:
        if batch.num_rows == 0:
            continue
        data, at = text_bytes(column(batch, name))
        first = 0
        while first < batch.num_rows:
            last = max(first + 1, int(np.searchsorted(at, at[first] + most, "right")) - 1)
            yield batch.slice(first, last - first), data[at[first] : at[last]], at[first : last + 1] - at[first]
            first = last


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z as a-z; every other byte as it is."""
    return _LOWER[data]


def words(data: np.ndarray, at: np.ndarray, gaps: np.ndarray = SPACE) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each run of bytes that are not ``gaps`` (white space by default)."""
    n = len(data)
    solid = np.zeros(n + 2, bool)
    solid[1:-1] = ~gaps[data]
    starts = solid[1:] & ~solid[:-1]
    edges = at[(at > 0) & (at < n)]
    cut = edges[solid[edges] & solid[edges + 1]]  # words on both sides of a row's end
    starts[cut] = True
    ends = solid[:-1] & ~solid[1:]
    ends[cut] = True
    start, end = np.flatnonzero(starts[:n]), np.flatnonzero(ends)
    return start, end, np.repeat(np.arange(len(at) - 1), np.diff(np.searchsorted(start, at)))


def runs(sorted_keys: np.ndarray) -> np.ndarray:
    """Index of the first element of each run of equal neighbours."""
    return np.flatnonzero(np.r_[True, sorted_keys[1:] != sorted_keys[:-1]]) if len(sorted_keys) else np.zeros(0, np.int64)


def lists(values: np.ndarray, counts: np.ndarray, kind: pa.DataType) -> pa.Array:
    """One list per row, of so many values each."""
    return pa.ListArray.from_arrays(pa.array(np.r_[0, np.cumsum(counts)].astype(np.int32)), pa.array(values, kind))


def blobs(data: np.ndarray, at: np.ndarray) -> pa.Array:
    """A binary column from bytes and offsets."""
    return pa.Array.from_buffers(pa.binary(), len(at) - 1, [None, pa.py_buffer(at.astype(np.int32)), pa.py_buffer(np.ascontiguousarray(data))])
