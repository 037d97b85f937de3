"""Monthly edges kept up to date by a stream of invoices. An extra: batch runs don't need it."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from ..operators.edges import trade_edges
from ..schemas import TRADES
from ..scratch import Change, complete, journalled, months_of, write_counted


_DONE = "_batch"  # a column of the stored edges: the last batch that changed a month


def merge_batch(batch: DataFrame, path: str, batch_id: int | None = None) -> None:
    """Add a batch of invoices to the edge table: the months of the batch are read, summed with it and replaced, all together.

    A batch that comes again is not added again: with the edges of a month, the
    id of the last batch that changed it is stored, and both are replaced in one
    step. Without ``batch_id`` every batch counts.
    """
    spark = batch.sparkSession
    complete(spark, path)
    new = trade_edges(batch).select(*TRADES.fieldNames())
    months = [r["period"] for r in new.select("period").distinct().collect()]  # one row for each month of a batch
    schema = T.StructType([*TRADES.fields, T.StructField(_DONE, T.LongType())])
    try:
        old = spark.read.schema(schema).parquet(path).where(F.col("period").isin(months))
        done = {r["period"]: r["last"] for r in old.groupBy("period").agg(F.max(_DONE).alias("last")).collect()}
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        old, done = spark.createDataFrame([], schema), {}
    if batch_id is not None:
        months = [m for m in months if done.get(m) is None or done[m] < batch_id]
    if not months:
        return
    both = old.drop(_DONE).unionByName(new).where(F.col("period").isin(months))
    merged = both.groupBy("seller_mst", "buyer_mst", "period").agg(
        F.sum("invoice_count").alias("invoice_count"),
        F.sum("total_amount").alias("total_amount"),
        F.sum("total_vat").alias("total_vat"),
        F.min("first_date").alias("first_date"),
        F.max("last_date").alias("last_date"),
    )
    change = Change(spark, path)
    try:
        # without an id, the month keeps the one that it has
        stamp = F.lit(batch_id) if batch_id is not None else F.coalesce(F.lit(None), *[F.when(F.col("period") == m, F.lit(done.get(m))) for m in months])
        write_counted(merged.withColumn(_DONE, stamp.cast("long")), change.staged, by="period")
        for month in months_of(spark, change.staged):
            change.place(month)
        change.commit()
    except BaseException:
        if not journalled(spark, path):
            change.give_up()
        raise


def upsert_stream(invoices: DataFrame, path: str, checkpoint: str) -> DataStreamWriter:
    """A writer that merges each micro-batch of (seller_mst, buyer_mst, period, day, amount, vat) into the edge table, once."""
    return invoices.writeStream.option("checkpointLocation", checkpoint).foreachBatch(lambda batch, n: merge_batch(batch, path, n))
