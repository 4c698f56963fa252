"""Whole texts of an Arrow batch as one byte array, and vectorised work on it.

Everything here is numpy inside a task: Spark partitions the rows, these helpers turn one batch at a time into flat
arrays. Substrings are named by polynomial hashes modulo 2^64 over prefixes, so any substring costs two look-ups.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession

BASE = np.uint64(0x9E3779B97F4A7C15)
BASE_INVERSE = np.uint64(pow(int(BASE), -1, 1 << 64))
#: Bytes of text that are worked on at once; one longer document is still taken whole.
CHUNK_BYTES = 2 << 20
#: Rows of an Arrow batch, so that a batch of long documents still fits a Python worker.
BATCH_ROWS = 512

LOWER = np.arange(256, dtype=np.uint8)
LOWER[65:91] += 32
SPACE = np.zeros(256, bool)
SPACE[[0x20, *range(0x09, 0x0E)]] = True


def small_batches(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", str(BATCH_ROWS))
    return spark


def map_arrow(df: DataFrame, fn, schema: str) -> DataFrame:
    """mapInArrow with bounded batches."""
    small_batches(df.sparkSession)
    return df.mapInArrow(fn, schema)


@dataclass
class Flat:
    """data: all bytes; off: document i has the bytes off[i] to off[i + 1]."""

    data: np.ndarray
    off: np.ndarray

    @property
    def n(self) -> int:
        return len(self.off) - 1

    @property
    def lengths(self) -> np.ndarray:
        return np.diff(self.off)

    def text(self, i: int) -> bytes:
        return self.data[self.off[i]:self.off[i + 1]].tobytes()

    def doc_of(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.off, at, "right") - 1

    def boundaries(self) -> np.ndarray:
        """True where a document begins, with one more place for the end."""
        b = np.zeros(len(self.data) + 1, bool)
        b[self.off] = True
        return b


def flat(col: pa.Array | pa.ChunkedArray) -> Flat:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    col = pc.fill_null(col.cast(pa.string()) if pa.types.is_null(col.type) else col, "").cast(pa.large_binary())
    if not len(col):
        return Flat(np.zeros(0, np.uint8), np.zeros(1, np.int64))
    _, offsets, data = col.buffers()
    off = np.frombuffer(offsets, np.int64)[col.offset:col.offset + len(col) + 1]
    raw = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    return Flat(raw[off[0]:off[-1]], off - off[0])


def chunks(batches: Iterator[pa.RecordBatch], column: str = "text", limit: int = CHUNK_BYTES) -> Iterator[pa.RecordBatch]:
    """The same rows in slices of about ``limit`` bytes of text."""
    for batch in batches:
        if not batch.num_rows:
            continue
        sizes = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False)
        total = np.cumsum(sizes)
        at = 0
        while at < batch.num_rows:
            before = total[at - 1] if at else 0
            end = max(at + 1, int(np.searchsorted(total, before + limit, "right")))
            yield batch.slice(at, end - at)
            at = end


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit integers that scatters them."""
    x = x ^ (x >> np.uint64(30))
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_powers: list[np.ndarray] = [np.ones(1, np.uint64), np.ones(1, np.uint64)]


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """BASE^0.. and its inverses, n of each at least."""
    if len(_powers[0]) < n:
        for k, base in enumerate((BASE, BASE_INVERSE)):
            p = np.full(n + n // 4, base, np.uint64)
            p[0] = 1
            _powers[k] = np.cumprod(p)
    return _powers[0], _powers[1]


class Prefixes:
    """Prefix polynomial hashes of a byte array: ``sub(a, b)`` names the bytes from a to b."""

    def __init__(self, data: np.ndarray):
        up, self.down = powers(len(data) + 1)
        self.sums = np.zeros(len(data) + 1, np.uint64)
        np.cumsum((data.astype(np.uint64) + np.uint64(1)) * up[:len(data)], out=self.sums[1:])

    def sub(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return (self.sums[b] - self.sums[a]) * self.down[a]


@dataclass
class Words:
    """Words of all documents in order: byte ranges, hashes, documents; first[i] is document i's first word."""

    start: np.ndarray
    end: np.ndarray
    hash: np.ndarray
    doc: np.ndarray
    first: np.ndarray

    @property
    def counts(self) -> np.ndarray:
        return np.diff(self.first)


def words(f: Flat, lower: bool = True) -> Words:
    """Runs of bytes other than 0x20 and 0x09 to 0x0D, A-Z lower-cased; a run ends with its document."""
    data = LOWER[f.data] if lower else f.data
    inside = ~SPACE[data]
    edge = f.boundaries()
    before = np.zeros(len(data), bool)
    before[1:] = inside[:-1]
    start = np.flatnonzero(inside & (~before | edge[:-1]))
    after = np.zeros(len(data), bool)
    after[:-1] = inside[1:]
    end = np.flatnonzero(inside & (~after | edge[1:])) + 1
    h = mix(Prefixes(data).sub(start, end) + (end - start).astype(np.uint64))
    first = np.searchsorted(start, f.off, "left")
    first[-1] = len(start)
    return Words(start, end, h, np.repeat(np.arange(f.n), np.diff(first)), first)


def segments(first: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The non-empty ranges among first[i]..first[i + 1]: their indices and starts, as reduceat wants them."""
    full = np.flatnonzero(np.diff(first))
    return full, first[:-1][full]


def sums_by(values: np.ndarray, first: np.ndarray) -> np.ndarray:
    out = np.zeros(len(first) - 1, values.dtype)
    full, start = segments(first)
    if len(full):
        out[full] = np.add.reduceat(values, start)
    return out


def signed(x: np.ndarray) -> np.ndarray:
    """Unsigned 64-bit values as Spark's bigint, bit for bit."""
    return x.view(np.int64)
