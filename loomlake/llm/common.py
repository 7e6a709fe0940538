"""Helpers shared by the training-data operators: table access, lineage cuts, byte-level tokens.

Texts are handled as Arrow buffers: one uint8 array of UTF-8 bytes plus row offsets. UTF-8 bytes of
non-ASCII characters are all >= 0x80, so the word classes used here can be decided byte by byte.
"""

from __future__ import annotations

import ctypes
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

from ..storage import cut, discard, remove, shared_dir  # noqa: F401

CHUNK_BYTES = 2_000_000


#: Bounds of Arrow batches that these operators ask for where the session has Spark's defaults: name, default, bound.
BATCHES = (("spark.sql.execution.arrow.maxRecordsPerBatch", "10000", "2000"), ("spark.sql.execution.arrow.maxBytesPerBatch", "67108864b", "16777216b"))


def modest(spark: SparkSession) -> None:
    """Batches of whole texts would take much memory outside of the heap, on both sides of the pipe to Python."""
    for name, default, bound in BATCHES:
        if spark.conf.get(name) == default:
            spark.conf.set(name, bound)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    modest(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def stored(df: DataFrame, label: str, **options: str) -> DataFrame:
    """Like :func:`cut`, as Parquet, for wide rows of which later steps read some columns only."""
    path = f"{shared_dir(df.sparkSession)}/{label}-{uuid.uuid4().hex}"
    df.write.options(**options).parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


try:
    _trim = ctypes.CDLL(None).malloc_trim
except (AttributeError, OSError):  # another C library
    _trim = None


def give_back() -> None:
    """Free memory of a Python worker, which lives on, goes back to the system."""
    pa.default_memory_pool().release_unused()
    if _trim is not None:
        _trim(0)


def released(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The same batches; at the end :func:`give_back`."""
    yield from batches
    give_back()


def chunks(batch: pa.RecordBatch, column: str, limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch with about ``limit`` bytes of text each, one row at least: bounded working memory."""
    if not batch.num_rows:
        return
    ends = np.cumsum(pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False))
    start = 0
    while start < batch.num_rows:
        done = ends[start - 1] if start else 0
        stop = max(start + 1, int(np.searchsorted(ends, done + limit, side="right")))
        yield batch.slice(start, stop - start)
        start = stop


def text_bytes(column: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """(UTF-8 bytes, row offsets); null counts as empty."""
    column = pc.cast(pc.fill_null(column, ""), pa.large_string())
    _, offsets, data = column.buffers()
    at = np.frombuffer(offsets, dtype="<i8", count=len(column) + 1, offset=8 * column.offset)
    whole = np.frombuffer(data, dtype=np.uint8) if data is not None and data.size else np.zeros(0, np.uint8)
    return whole[at[0] : at[-1]], at - at[0]


def byte_class(chars: bytes) -> np.ndarray:
    out = np.zeros(256, np.bool_)
    out[np.frombuffer(chars, np.uint8)] = True
    return out


LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
#: Words of letters and digits: everything but ASCII that is neither.
ALNUM = ~byte_class(bytes([*range(0x00, 0x30), *range(0x3A, 0x61), *range(0x7B, 0x80)]))
#: Words between ASCII white space.
NON_SPACE = ~byte_class(bytes([0x20, *range(0x09, 0x0E)]))


def word_spans(data: np.ndarray, offsets: np.ndarray, is_word: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(starts, ends, first word of each row and one more); words never cross rows."""
    if not len(data):
        return np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(len(offsets), np.int64)
    flag = is_word[data]
    before, after = np.empty_like(flag), np.empty_like(flag)
    before[0], before[1:] = False, flag[:-1]
    after[-1], after[:-1] = False, flag[1:]
    full = offsets[:-1] < offsets[1:]
    before[offsets[:-1][full]] = False
    after[offsets[1:][full] - 1] = False
    starts = np.flatnonzero(flag & ~before)
    ends = np.flatnonzero(flag & ~after) + 1
    return starts, ends, np.searchsorted(starts, offsets)


_K1, _K2 = np.uint64(0x9E3779B97F4A7C15), np.uint64(0xC2B2AE3D27D4EB4F)
_MASK = np.array([(1 << (8 * n)) - 1 for n in range(9)], dtype=np.uint64)


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(29))) * _K1
    h = (h ^ (h >> np.uint64(32))) * _K2
    return h ^ (h >> np.uint64(31))


def word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """64-bit hash of each word, eight bytes at a time."""
    if not len(starts):
        return np.zeros(0, np.uint64)
    padded = np.concatenate([data, np.zeros(8, np.uint8)])
    view = np.ndarray((len(data) + 1,), dtype="<u8", buffer=padded.data, strides=(1,))
    left = ends - starts
    h = mix(left.astype(np.uint64) * _K2 + _K1)
    h = mix(h ^ (view[starts] & _MASK[np.minimum(left, 8)]))
    at, more = 8, np.flatnonzero(left > 8)
    while len(more):
        h[more] = mix(h[more] ^ (view[starts[more] + at] & _MASK[np.minimum(left[more] - at, 8)]))
        at += 8
        more = more[left[more] > at]
    return h


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of the n words from each position on; the last n-1 positions are missing."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    size = len(words) - n + 1
    h = np.full(size, n, dtype=np.uint64)
    for k in range(n):
        h = mix(h * _K2 + words[k : k + size])
    return h
