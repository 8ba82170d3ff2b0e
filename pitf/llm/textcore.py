"""Words and hashes of whole Arrow batches of text with numpy: no Python loop over words or characters."""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import SparkSession

#: Odd multiplier of the polynomial hashes, modulo 2^64.
MULTIPLIER = 0x9E3779B97F4A7C15
#: Bytes of text handled at once inside a batch; one longer document is handled alone.
SLICE_BYTES = 4 << 20
#: Bytes of words hashed at once: the hash takes some 24 bytes of memory per byte.
HASH_BYTES = 256 << 10
_BATCH_BYTES = "spark.sql.execution.arrow.maxBytesPerBatch"


def small_batches(spark: SparkSession) -> None:
    """Arrow batches of about a slice, unless the session names a size: an executor holds several of them at once."""
    if spark.conf.get(_BATCH_BYTES, None) is None:
        spark.conf.set(_BATCH_BYTES, str(SLICE_BYTES))


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 bytes of a string column and its n + 1 offsets; a null is an empty text."""
    column = pc.fill_null(column.cast(pa.large_string()), "")
    _, offsets, data = column.buffers()
    if not len(column):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    offsets = np.frombuffer(offsets, np.int64)[column.offset:column.offset + len(column) + 1]
    data = np.frombuffer(data, np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return data[offsets[0]:offsets[-1]], offsets - offsets[0]


def slices(batches: Iterator[pa.RecordBatch], text: str, limit: int = SLICE_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in batches of at most ``limit`` bytes of text (or one row)."""
    for batch in batches:
        sizes = pc.fill_null(pc.binary_length(batch.column(batch.schema.get_field_index(text))), 0).to_numpy(
            zero_copy_only=False)
        start = total = 0
        for i, size in enumerate(sizes.tolist()):
            if total and total + size > limit:
                yield batch.slice(start, i - start)
                start, total = i, 0
            total += size
        if start < len(sizes):
            yield batch.slice(start)


def mix(x: np.ndarray) -> np.ndarray:
    """Spread the bits of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def powers(n: int) -> np.ndarray:
    out = np.full(max(n, 1), MULTIPLIER, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


def words(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and document of every maximal run of bytes other than space and \\x09-\\x0D."""
    n = len(data)
    inside = ~((data == 32) | ((data >= 9) & (data <= 13)))
    first = np.zeros(n + 1, bool)
    first[offsets] = True
    before = np.concatenate(([False], inside[:-1])) if n else inside
    after = np.concatenate((inside[1:], [False])) if n else inside
    start = np.flatnonzero(inside & (~before | first[:-1]))
    end = np.flatnonzero(inside & (~after | first[1:])) + 1
    return start, end, np.searchsorted(offsets, start, "right") - 1


def lowered(data: np.ndarray) -> np.ndarray:
    """A-Z in lower case, everything else as it is."""
    return np.where((data >= 65) & (data <= 90), data + np.uint8(32), data)


def span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of the bytes of each non-empty span, for runs of spans of about ``HASH_BYTES`` bytes at a time."""
    if not len(start):
        return np.zeros(0, np.uint64)
    total = np.cumsum(end - start)
    cuts = np.searchsorted(total, np.arange(HASH_BYTES, int(total[-1]), HASH_BYTES), "right")
    bounds = np.unique(np.concatenate(([0], cuts, [len(start)])))
    if len(bounds) == 2:
        return _span_hashes(data, start, end)
    return np.concatenate([_span_hashes(data, start[lo:hi], end[lo:hi])
                           for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True) if hi > lo])


def _span_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    length = end - start
    at = np.cumsum(length) - length
    place = np.arange(int(length.sum())) - np.repeat(at, length)
    values = data[np.repeat(start, length) + place].astype(np.uint64) + np.uint64(1)
    return mix(np.add.reduceat(values * powers(int(length.max()))[place], at))


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word with A-Z lowered, and its document."""
    start, end, doc = words(data, offsets)
    return span_hashes(lowered(data), start, end), doc


def chain(parts: list[np.ndarray]) -> np.ndarray:
    """One hash of the values in order; the number of parts matters too."""
    out = np.full(len(parts[0]), len(parts), np.uint64)
    for part in parts:
        out = mix(out * np.uint64(MULTIPLIER) + part)
    return out


def shingle_sets(data: np.ndarray, offsets: np.ndarray, width: int) -> Iterator[np.ndarray]:
    """Per document the sorted distinct hashes of its word shingles; fewer words make one shingle, none an empty set."""
    hashes, doc = word_hashes(data, offsets)
    bounds = np.searchsorted(doc, np.arange(len(offsets)))
    whole = chain([hashes[i:len(hashes) - width + 1 + i] for i in range(width)]) if len(hashes) >= width else None
    for lo, hi in zip(bounds[:-1].tolist(), bounds[1:].tolist(), strict=True):
        if hi - lo >= width:
            yield np.unique(whole[lo:hi - width + 1])
        elif hi > lo:
            yield chain([hashes[i:i + 1] for i in range(lo, hi)])
        else:
            yield hashes[:0]
