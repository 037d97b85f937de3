"""Vectors as integers, in columnar blocks that numpy reads as they are."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark import RDD
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise

SCALE = 1024
BLOCK_BYTES = 4_000_000  # of a block before it is written
_LARGEST = 2.0**62


def usable(vector: str) -> F.Column:
    """Whether a vector is there and all its components are finite numbers."""
    fine = lambda v: v.isNotNull() & ~F.isnan(v) & (F.abs(v) != float("inf"))
    return F.coalesce(F.forall(F.col(vector).cast("array<double>"), fine), F.lit(False))


def integers(column: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """(length, places, floor(1024 * x) as int64 of shape (length, rows)) for each length of the vectors of an Arrow list column."""
    column = column.combine_chunks() if isinstance(column, pa.ChunkedArray) else column
    flat = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    lengths = np.diff(column.offsets.to_numpy())
    starts = np.cumsum(lengths) - lengths
    scaled = np.floor(flat * SCALE)
    if np.abs(scaled).max(initial=0.0) >= _LARGEST:
        raise OverflowError(f"a component times {SCALE} doesn't fit 64 bits")
    whole = scaled.astype(np.int64)
    for length in np.unique(lengths):
        at = np.flatnonzero(lengths == length)
        yield int(length), at, np.ascontiguousarray(whole[starts[at] + np.arange(length)[:, None]])


def _pack(columns: np.ndarray) -> bytes:
    """Columns as 32-bit integers where they fit, else as 64-bit ones."""
    small = np.abs(columns).max(initial=0) < 2**31
    return (b"4" if small else b"8") + columns.astype("<i4" if small else "<i8").tobytes()


def unpack(length: int, rows: int, data: bytes) -> np.ndarray:
    """Columns (length, rows) of a block."""
    return np.frombuffer(data, "<i4" if data[:1] == b"4" else "<i8", offset=1).reshape(length, rows)


def integer_blocks(vectors: DataFrame, column: str) -> tuple[int, DataFrame | None]:
    """(d, blocks (rows, data)) of the usable vectors of the length d that most of them have (of equals the smaller); (0, None) without any.

    A block is a matrix of one row for each component and one column for each
    vector. Blocks are written once to the shared folder: each later pass reads
    them, and a lost executor costs a re-read.
    """

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for length, _, columns in integers(batch.column(0)):
                step = max(1, BLOCK_BYTES // max(1, 8 * length))
                for a in range(0, columns.shape[1], step):
                    part = columns[:, a : a + step]
                    yield pa.RecordBatch.from_arrays([pa.array([length], pa.int32()), pa.array([part.shape[1]], pa.int64()), pa.array([_pack(part)], pa.binary())], names=["length", "rows", "data"])

    kept = vectors.where(usable(column)).select(F.col(column).cast("array<double>").alias("v"))
    blocks = materialise(kept.mapInArrow(pack, "length int, rows long, data binary"), "vector-blocks")
    best = blocks.groupBy("length").agg(F.sum("rows").alias("n")).orderBy(F.col("n").desc(), "length").first()
    if best is None:
        return 0, None
    return best["length"], blocks.where(F.col("length") == best["length"]).select("rows", "data")


def tree_reduce(blocks: DataFrame, length: int, zero: Callable, add: Callable, merge: Callable):
    """What ``add`` makes of every block, from ``zero()`` on, merged through a tree of tasks; one partial result for each branch reaches the driver."""
    rdd: RDD = blocks.rdd.map(lambda r: unpack(length, r["rows"], bytes(r["data"])))
    depth = 2 if rdd.getNumPartitions() <= 256 else 3
    out = rdd.treeAggregate(None, lambda acc, block: add(zero() if acc is None else acc, block), lambda a, b: a if b is None else b if a is None else merge(a, b), depth)
    return zero() if out is None else out
