"""What the corpus operators share: bucketed scratch tables, row keys and numpy hashing."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import materialise, scratch_table

__all__ = ["bucketed", "combine", "each_copy", "materialise", "shuffle_partitions", "split_table", "with_row_key"]

_M1 = np.uint64(0xFF51AFD7ED558CCD)
_M2 = np.uint64(0x9E3779B97F4A7C15)


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def bucketed(df: DataFrame, key: str, name: str) -> DataFrame:
    """Write ``df`` once, bucketed by ``key``, so that later joins on it don't shuffle it again."""
    spark = df.sparkSession
    n = shuffle_partitions(spark)
    table, path = scratch_table(spark, name)
    (
        df.repartition(n, key)
        .write.format("parquet")
        .bucketBy(n, key)
        .option("compression", "zstd")
        .option("path", path)
        .saveAsTable(table)
    )
    return spark.table(table)


def with_row_key(docs: DataFrame) -> tuple[DataFrame, DataFrame | None]:
    """(rid, text) with each key once, and the rows that share keys: (doc_id, rid, copies), or None where rid is doc_id.

    Where doc_id is unique and never null, rid is doc_id. Otherwise rows are
    ordered by (doc_id, nulls first, hash of the text), and rows alike in both
    are one document of several copies.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text"))
    odd = base.groupBy("doc_id").count().where("count > 1 or doc_id is null").limit(1).count()
    if not odd:
        return base.select(F.col("doc_id").alias("rid"), "text"), None
    base = base.withColumn("h", F.xxhash64("text"))
    counted = base.groupBy("doc_id", "h").agg(F.count("*").alias("copies"), F.any_value("text").alias("text"))
    keyed = materialise(counted.orderBy(F.col("doc_id").asc_nulls_first(), "h").withColumn("rid", F.monotonically_increasing_id()), "row-keys")
    return keyed.select("rid", "text"), keyed.select("doc_id", "rid", "copies")


def each_copy(result: DataFrame, ids: DataFrame | None) -> DataFrame:
    """``result`` (rid, ...) as (doc_id, ...), once for each row of the input that has the key."""
    if ids is None:
        return result.withColumnRenamed("rid", "doc_id")
    rest = [c for c in result.columns if c != "rid"]
    rows = ids.join(result, "rid").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("copies"))))
    return rows.select("doc_id", *rest)


def combine(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """A 64-bit name for each ordered pair of 64-bit names."""
    x = a * _M2
    x ^= x >> np.uint64(32)
    x += b
    x *= _M1
    x ^= x >> np.uint64(29)
    return x


def split_table(batch, limit: int, column: str = "text"):
    """Slices of an Arrow batch whose texts hold about ``limit`` bytes each (one long text may exceed it)."""
    import pyarrow.compute as pc

    lengths = pc.fill_null(pc.binary_length(batch.column(column)), 0).to_numpy(zero_copy_only=False).astype(np.int64)
    if not len(lengths):
        return
    part = (np.cumsum(lengths) - lengths) // limit
    edges = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), len(lengths)]
    for a, b in zip(edges, edges[1:], strict=False):
        yield batch.slice(a, b - a)
