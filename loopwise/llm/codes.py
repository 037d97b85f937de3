"""Vector code compression: product codes whose codebooks are refined by tree aggregation over columnar blocks."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import materialise
from .vectors import integer_blocks, integers, tree_reduce, usable

PARTS = 4
ENTRIES = 256
ROUNDS = 4
AT_ONCE = 512  # vectors whose distances to all entries are held at once
HOT = 1000  # labels with more than one in so many rows are broadcast: they are fewer than that
_SCHEMA = "vec_id long, code string, error long, label_error long, codebooks_sha256 string"


def padded(columns: np.ndarray) -> np.ndarray:
    """Columns as (parts, width, rows); zeros follow where the length is no multiple of the parts."""
    short = -len(columns) % PARTS
    if short:
        columns = np.concatenate((columns, np.zeros((short, columns.shape[1]), columns.dtype)))
    return columns.reshape(PARTS, -1, columns.shape[1])


def nearest_entries(columns: np.ndarray, book: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """(index, squared distance) of the nearest entry of each column; ties go to the lower index.

    columns: (width, rows), book: (width, entries). Distances grow dimension by
    dimension, in 32 bits where no sum can exceed them.
    """
    width, rows = columns.shape
    reach = int(np.abs(columns).max(initial=0)) + int(np.abs(book).max(initial=0))
    if width * reach * reach >= 2**63:
        raise OverflowError("squared distances of so large components don't fit 64 bits")
    kind = np.int32 if width * reach * reach < 2**31 else np.int64
    columns, book = columns.astype(kind, copy=False), book.astype(kind, copy=False)
    index, error = np.empty(rows, np.int64), np.empty(rows, np.int64)
    for a in range(0, rows, AT_ONCE):
        some = columns[:, a : a + AT_ONCE]
        distance = np.zeros((some.shape[1], book.shape[1]), kind)
        step = np.empty_like(distance)
        for d in range(width):
            np.subtract(some[d][:, None], book[d], out=step)
            np.multiply(step, step, out=step)
            distance += step
        at = distance.argmin(axis=1)
        index[a : a + AT_ONCE] = at
        error[a : a + AT_ONCE] = distance[np.arange(len(at)), at]
    return index, error


def _refine(blocks: DataFrame, length: int, books: np.ndarray) -> np.ndarray:
    """Each entry becomes the floor of the mean of the parts that are nearest to it; unused entries stay."""
    shared = blocks.sparkSession.sparkContext.broadcast(books)
    shape = books.shape  # (parts, width, entries)

    def zero():
        return np.zeros(shape, np.int64), np.zeros((shape[0], shape[2]), np.int64)

    def add(acc, block):
        sums, counts = acc
        for p, columns in enumerate(padded(block)):
            index, _ = nearest_entries(columns, shared.value[p])
            np.add.at(counts[p], index, 1)
            for d, column in enumerate(columns):
                np.add.at(sums[p, d], index, column)
        return acc

    def merge(a, b):
        return a[0] + b[0], a[1] + b[1]

    sums, counts = tree_reduce(blocks, length, zero, add, merge)
    shared.unpersist()
    return np.where(counts[:, None] > 0, sums // np.maximum(counts, 1)[:, None], books)


def train_codebooks(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", entries: int = ENTRIES, rounds: int = ROUNDS) -> tuple[int, np.ndarray | None]:
    """(length of the vectors, codebooks of shape (parts, width, entries)); (0, None) without a usable vector."""
    length, blocks = integer_blocks(vectors, column)
    if blocks is None:
        return 0, None
    first = vectors.where(usable(column) & (F.size(column) == length)).select(F.col(key).cast("long").alias("k"), F.col(column).cast("array<double>").alias("v")).orderBy(F.col("k").asc_nulls_last(), "v").limit(entries)
    start = np.array([r["v"] for r in first.collect()], np.float64).reshape(-1, length)  # at most ``entries`` vectors
    books = padded(np.floor(start * 1024).astype(np.int64).T)
    for _ in range(rounds):
        books = _refine(blocks, length, books)
    return length, books


def fingerprint(books: np.ndarray) -> str:
    """SHA-256 of all components in decimal, by part, entry and position, with commas between."""
    return hashlib.sha256(",".join(map(str, books.transpose(0, 2, 1).ravel().tolist())).encode()).hexdigest()


def _add_totals(coded: DataFrame) -> DataFrame:
    """``coded`` with label_error, the error summed over equal labels; null is a label like others.

    Totals of frequent labels are broadcast: each has over a thousandth of the
    rows, so they are under a thousand. The others meet their rows by a
    shuffle, in which none can be large.
    """
    totals = materialise(coded.groupBy("label").agg(F.sum("error").alias("label_error"), F.count("*").alias("n")), "label-totals")
    rows = totals.agg(F.sum("n")).first()[0] or 0
    hot = totals.where(F.col("n") * HOT > rows).select(F.col("label").alias("l"), "label_error")
    rare = totals.where(F.col("n") * HOT <= rows).select(F.col("label").alias("l"), "label_error")
    same = coded["label"].eqNullSafe(F.col("l"))
    return coded.join(F.broadcast(hot), same).drop("l").unionByName(coded.join(rare.hint("merge"), same).drop("l"))


def vector_codes(vectors: DataFrame, column: str = "embedding", key: str = "vec_id", label: str = "label") -> DataFrame:
    """(vec_id, code, error, label_error, codebooks_sha256): each usable vector as one byte for each of its four parts.

    Components become floor(1024 * x). The codebook of a part starts as that
    part of the 256 vectors with the smallest ids (ids alike: by vector; null
    ids come last; with fewer vectors it has fewer entries) and is refined four
    times: every part goes to the nearest entry, the entries become the floors
    of their parts' means. Each round is one tree aggregation over the blocks;
    the driver gets sums and counts, whose size is that of the codebooks.

    Vectors that are null, or hold null or non-finite components, are left out,
    and so are those of another length than most have. A length that four
    doesn't divide is filled up with zeros. Repeated rows count and come back
    each on its own, extra columns don't matter, an empty table gives none.
    Components so large that squared distances don't fit 64 bits raise an error.
    """
    spark = vectors.sparkSession
    length, books = train_codebooks(vectors, column, key)
    if books is None:
        return spark.createDataFrame([], _SCHEMA)
    shared = spark.sparkContext.broadcast(books)

    def encode(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, at, columns in integers(batch.column("v")):
                codes, errors = zip(*(nearest_entries(c, shared.value[p]) for p, c in enumerate(padded(columns))), strict=True)
                text = [bytes(row).hex() for row in np.stack(codes, axis=1).astype(np.uint8)]
                rows = batch.take(pa.array(at))
                yield pa.RecordBatch.from_arrays([rows.column("vec_id"), rows.column("label"), pa.array(text, pa.string()), pa.array(np.sum(errors, axis=0), pa.int64())], names=["vec_id", "label", "code", "error"])

    rows = vectors.where(usable(column) & (F.size(column) == length)).select(F.col(key).cast("long").alias("vec_id"), F.col(label).alias("label"), F.col(column).cast("array<double>").alias("v"))
    kind = rows.schema["label"].dataType.simpleString()
    coded = materialise(rows.mapInArrow(encode, f"vec_id long, label {kind}, code string, error long"), "codes")
    return _add_totals(coded).select("vec_id", "code", "error", "label_error", F.lit(fingerprint(books)).alias("codebooks_sha256"))
