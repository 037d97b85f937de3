"""Monthly seller to buyer edges."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise


def trade_edges(invoices: DataFrame) -> DataFrame:
    """Invoices (seller_mst, buyer_mst, period, day, amount, vat) summed over seller, buyer and month; self-trades are dropped.

    One shuffle on the edge key, after partial sums in each input task.
    """
    return (
        invoices.where("seller_mst <> buyer_mst")
        .groupBy("seller_mst", "buyer_mst", "period")
        .agg(
            F.count("*").alias("invoice_count"),
            F.sum("amount").cast("double").alias("total_amount"),
            F.sum("vat").cast("double").alias("total_vat"),
            F.min("day").alias("first_date"),
            F.max("day").alias("last_date"),
        )
    )


def ingest_summary(invoices: DataFrame) -> DataFrame:
    """n_invoices, n_self, n_edges, reduction, period_from, period_to: one row."""
    other = F.col("seller_mst") != F.col("buyer_mst")
    edges = invoices.groupBy("seller_mst", "buyer_mst", "period").agg(F.count("*").alias("n"))
    return edges.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_invoices"),
        F.coalesce(F.sum(F.when(~other, F.col("n"))), F.lit(0)).alias("n_self"),
        F.count_if(other).alias("n_edges"),
        F.min("period").alias("period_from"),
        F.max("period").alias("period_to"),
    ).withColumn("reduction", F.try_divide((F.col("n_invoices") - F.col("n_self")).cast("double"), F.col("n_edges")))


def window_of(trades: DataFrame, period_from: int, period_to: int) -> DataFrame:
    """Edges of a range of months, both ends included; without self-trades, unknown amounts as 0."""
    keep = F.col("period").between(period_from, period_to) & (F.col("seller_mst") != F.col("buyer_mst"))
    rows = trades.where(keep)
    return rows.withColumns({c: F.coalesce(F.col(c).cast("double"), F.lit(0.0)) for c in ("total_amount", "total_vat")})


def participants(trades: DataFrame) -> DataFrame:
    """(mst, sells, buys) of every company that trades."""
    sides = trades.select(F.col("seller_mst").alias("mst"), F.lit(1).alias("s"), F.lit(0).alias("b")).unionAll(trades.select(F.col("buyer_mst"), F.lit(0), F.lit(1)))
    return sides.groupBy("mst").agg((F.max("s") == 1).alias("sells"), (F.max("b") == 1).alias("buys"))


def seeds(trades: DataFrame, most: int | None = None) -> DataFrame:
    """(mst) of companies that both sell and buy; the first ``most`` by key where given."""
    rows = participants(trades).where("sells and buys").select("mst")
    return rows if most is None else rows.orderBy("mst").limit(most)


def seed_summary(trades: DataFrame) -> DataFrame:
    return participants(trades).agg(
        F.count("*").alias("n_participants"),
        F.count_if(F.col("sells") & F.col("buys")).alias("n_seeds"),
    ).withColumn("pruned_share", F.try_divide((F.col("n_participants") - F.col("n_seeds")).cast("double"), F.col("n_participants")))


def trim_to_core(trades: DataFrame, rounds: int = 1, seller: str = "seller_mst", buyer: str = "buyer_mst") -> DataFrame:
    """Edges whose seller also buys and whose buyer also sells, again and again: what is dropped lies on no cycle."""
    for _ in range(rounds):
        sells = trades.select(F.col(seller).alias("k")).distinct()
        buys = trades.select(F.col(buyer).alias("k")).distinct()
        trades = trades.join(buys, trades[seller] == buys["k"], "left_semi").join(sells, F.col(buyer) == sells["k"], "left_semi")
        trades = materialise(trades, "core")
    return trades


def upsert_edges(edges: DataFrame, path: str) -> None:
    """Replace the months that ``edges`` holds; other months of the table stay."""
    edges.write.mode("overwrite").option("partitionOverwriteMode", "dynamic").partitionBy("period").parquet(path)


def external_companies(keys: DataFrame, known: DataFrame) -> DataFrame:
    """(mst) of the keys that the company table doesn't know."""
    return keys.select("mst").distinct().join(known.select("mst"), "mst", "left_anti")


def keep_first(rows: DataFrame, keys: list[str], order: str) -> DataFrame:
    """The first row of each key in the order of the input."""
    from pyspark.sql import Window as W

    return rows.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(order))).where("_n = 1").drop("_n")
