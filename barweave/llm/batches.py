"""Arrow batches as byte arrays: what the vectorised operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa

#: Text bytes worked on at once. A longer document is a chunk of its own.
CHUNK_BYTES = 1 << 18


def chunks(batch: pa.RecordBatch, text: str, size: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of the batch, in order, of about ``size`` text bytes; a null text counts as empty."""
    at = batch.schema.get_field_index(text)
    column = batch.column(at)
    if column.null_count:
        batch = batch.set_column(at, text, column.fill_null(""))
        column = batch.column(at)
    ends = text_offsets(column)[1:].astype(np.int64)
    start = 0
    while start < batch.num_rows:
        base = ends[start - 1] if start else int(text_offsets(column)[0])
        stop = max(start + 1, int(np.searchsorted(ends, base + size, "right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_offsets(column: pa.StringArray) -> np.ndarray:
    raw = np.frombuffer(column.buffers()[1] or b"\0\0\0\0", np.int32)
    return raw[column.offset : column.offset + len(column) + 1]


def joined(column: pa.StringArray, gap: int) -> tuple[np.ndarray, np.ndarray]:
    """The texts' UTF-8 bytes, each followed by one ``gap`` byte, and where each text begins."""
    offsets = text_offsets(column).astype(np.int64)
    raw = column.buffers()[2]
    data = np.frombuffer(raw, np.uint8) if raw is not None else np.zeros(0, np.uint8)
    data = data[offsets[0] : offsets[-1]]
    offsets = offsets - offsets[0]
    return np.insert(data, offsets[1:], gap), offsets[:-1] + np.arange(len(offsets) - 1)


def byte_set(*ranges: tuple[int, int]) -> np.ndarray:
    """Membership of each byte in the inclusive ranges."""
    out = np.zeros(256, bool)
    for low, high in ranges:
        out[low : high + 1] = True
    return out


#: Words are runs of anything but the six ASCII white-space characters.
SPACES = byte_set((0x09, 0x0D), (0x20, 0x20))
WORD = ~SPACES
LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32


def spans(data: np.ndarray, inside: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Begin and end of every maximal run of bytes that are ``inside``."""
    mask = np.concatenate(([False], inside[data], [False]))
    edges = np.flatnonzero(mask[1:] != mask[:-1])
    return edges[0::2], edges[1::2]


_FACTOR = np.uint64(0x9E3779B97F4A7C15)  # odd, so it has an inverse modulo 2**64
_INVERSE = np.uint64(pow(0x9E3779B97F4A7C15, -1, 1 << 64))
#: Powers that a worker keeps, 16 MB of them. A longer text's are made for it alone.
_KEPT = 1 << 20


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    return _kept_powers() if n <= _KEPT else _new_powers(n)


@lru_cache(1)
def _kept_powers() -> tuple[np.ndarray, np.ndarray]:
    return _new_powers(_KEPT)


def _new_powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    out = []
    for factor in (_FACTOR, _INVERSE):
        powers = np.full(n, factor, np.uint64)
        powers[0] = 1
        out.append(np.cumprod(powers, dtype=np.uint64))
    return out[0], out[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit values in which every input bit moves every output bit."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTE_VALUES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0xD1B54A32D192ED03))


def range_hashes(values: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the values of each range, from prefix sums of a polynomial hash."""
    powers, inverse = _powers(len(values) + 1)
    sums = np.zeros(len(values) + 1, np.uint64)
    np.cumsum(values * powers[: len(values)], dtype=np.uint64, out=sums[1:])
    return mix((sums[end] - sums[begin]) * inverse[begin] + (end - begin).astype(np.uint64))


def span_hashes(data: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each span's bytes."""
    return range_hashes(_BYTE_VALUES[data], begin, end)


def ragged(begin: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The indices begin, begin + 1, ... of every range, one range after the other."""
    ends = np.cumsum(size)
    return np.arange(ends[-1] if len(ends) else 0) + np.repeat(begin - ends + size, size)
