"""From scored cycles back to edges, invoices and companies."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .score import RED, WATCH


def cycle_edges(scored: DataFrame) -> DataFrame:
    """(seller_mst, buyer_mst, period, cycle_id), one row for each edge of each cycle."""
    return scored.select("cycle_id", F.explode("edges").alias("e")).select(F.col("e.src").alias("seller_mst"), F.col("e.dst").alias("buyer_mst"), F.col("e.period").alias("period"), "cycle_id").distinct()


def invoice_flags(invoices: DataFrame, scored: DataFrame, threshold: float = WATCH) -> DataFrame:
    """(einvoice_row_id, is_circular, cycle_ids) of invoices (einvoice_row_id, seller_mst, buyer_mst, period) on edges of flagged cycles.

    Edges are joined first to the sorted ids of their cycles, so that the large side is shuffled once.
    """
    per_edge = cycle_edges(scored.where(F.col("score") >= threshold)).groupBy("seller_mst", "buyer_mst", "period").agg(F.array_sort(F.collect_set("cycle_id")).alias("ids"))
    return invoices.join(per_edge, ["seller_mst", "buyer_mst", "period"]).groupBy("einvoice_row_id").agg(F.lit(True).alias("is_circular"), F.array_sort(F.array_distinct(F.flatten(F.collect_list("ids")))).alias("cycle_ids"))


def hubs(scored: DataFrame, top_n: int | None = None) -> DataFrame:
    """(mst, red_count, best_score) over red cycles, the most frequent first."""
    each = scored.where(F.col("score") >= RED).select(F.explode("members").alias("mst"), "score")
    out = each.groupBy("mst").agg(F.count("*").alias("red_count"), F.max("score").alias("best_score"))
    return out if top_n is None else out.orderBy(F.desc("red_count"), F.desc("best_score"), "mst").limit(top_n)


def top_cycles(scored: DataFrame, top_n: int = 20) -> DataFrame:
    return scored.orderBy(F.desc("score"), "members").limit(top_n)


def loops(scored: DataFrame) -> DataFrame:
    return scored.select("members", "hop_len", "amounts", "periods")


def with_names(scored: DataFrame, companies: DataFrame, unknown: str = "(unknown)") -> DataFrame:
    """``scored`` with an array of its members' names, in their order."""
    each = scored.select("cycle_id", F.posexplode("members").alias("i", "mst")).join(companies.select("mst", "name"), "mst", "left")
    names = each.groupBy("cycle_id").agg(F.array_sort(F.collect_list(F.struct("i", F.coalesce(F.nullif(F.col("name"), F.lit("")), F.lit(unknown)).alias("name")))).alias("n"))
    return scored.join(names.select("cycle_id", F.col("n.name").alias("names")), "cycle_id")


def drill_down(trades: DataFrame, scored: DataFrame) -> DataFrame:
    """The edges of the given cycles, by a semi-join on (seller, buyer, period)."""
    return trades.join(cycle_edges(scored).drop("cycle_id").distinct(), ["seller_mst", "buyer_mst", "period"], "left_semi")


def drill_down_sql(members: list[str], periods: list[int]) -> str:
    """A query for the edges of one cycle."""
    quote = lambda s: "'" + s.replace("'", "''") + "'"
    hop = [f"(seller_mst = {quote(a)} AND buyer_mst = {quote(b)} AND period = {int(p)})" for a, b, p in zip(members, [*members[1:], members[0]], periods, strict=True)]
    return "SELECT * FROM trades WHERE " + " OR ".join(hop)
