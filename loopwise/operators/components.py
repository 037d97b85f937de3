"""Strongly connected components of the trade graph: edges between components lie on no cycle."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..scratch import materialise


def _trimmed(edges: DataFrame, rounds: int) -> DataFrame:
    """Edges (src, dst) without vertices that nothing leads to, or that lead nowhere."""
    for _ in range(rounds):
        out = edges.select(F.col("src").alias("k")).distinct()
        into = edges.select(F.col("dst").alias("k")).distinct()
        edges = edges.join(into, edges["src"] == into["k"], "left_semi").join(out, F.col("dst") == out["k"], "left_semi")
    return materialise(edges, "trimmed")


def _coloured(edges: DataFrame) -> DataFrame:
    """(v, colour) of each vertex: the largest name from which it can be reached, itself included."""
    colours = materialise(edges.select(F.explode(F.array("src", "dst")).alias("v")).distinct().withColumn("colour", F.col("v")).withColumn("new", F.lit(True)), "colours")
    while True:  # each round tells the neighbours of those whose colour has changed
        told = colours.where("new").join(edges, F.col("v") == F.col("src")).groupBy(F.col("dst").alias("w")).agg(F.max("colour").alias("best"))
        new = F.coalesce(F.col("best") > F.col("colour"), F.lit(False))
        colours = materialise(colours.drop("new").join(told, F.col("v") == F.col("w"), "left").select("v", F.when(new, F.col("best")).otherwise(F.col("colour")).alias("colour"), new.alias("new")), "colours")
        if colours.where("new").isEmpty():
            return colours.drop("new")


def _back_within(edges: DataFrame, colours: DataFrame) -> DataFrame:
    """(v, colour) of the vertices that reach the vertex their colour is named after by vertices of that colour alone."""
    a, b = colours.select(F.col("v").alias("src"), F.col("colour").alias("c_src")), colours.select(F.col("v").alias("dst"), F.col("colour").alias("c_dst"))
    own = materialise(edges.join(a, "src").join(b, "dst").where("c_src = c_dst").select("src", "dst"), "own-edges")
    front = materialise(colours.where("v = colour"), "reached")
    reached = front
    while not front.isEmpty():
        step = own.join(front, F.col("dst") == F.col("v")).select(F.col("src").alias("v"), "colour").distinct()
        front = materialise(step.join(reached.select("v"), "v", "left_anti"), "reached")
        reached = reached.unionByName(front)
    return reached


def strong_components(trades: DataFrame, trim_rounds: int = 2) -> DataFrame:
    """(mst, component, size) of the companies on some cycle; component is the smallest of its members.

    Forward-backward colouring: every vertex takes the largest name that reaches
    it; those that reach that vertex back without leaving the colour are its
    component. They are taken out, and the rest is coloured again. All steps are
    joins on one key; a round costs the edges that are left, and what is known
    is written to the shared folder.
    """
    edges = materialise(trades.where("seller_mst <> buyer_mst").select(F.col("seller_mst").alias("src"), F.col("buyer_mst").alias("dst")).distinct(), "graph")
    found = None
    while True:
        edges = _trimmed(edges, trim_rounds)
        if edges.isEmpty():
            break
        members = materialise(_back_within(edges, _coloured(edges)), "component")
        found = members if found is None else found.unionByName(members)
        done = members.select("v")
        edges = edges.join(done, edges["src"] == done["v"], "left_anti").join(done, F.col("dst") == done["v"], "left_anti")
    if found is None:
        return trades.sparkSession.createDataFrame([], "mst string, component string, size bigint")
    groups = found.groupBy("colour").agg(F.min("v").alias("component"), F.count("*").alias("size")).where("size > 1")
    return found.join(groups, "colour").select(F.col("v").alias("mst"), "component", "size")


def within_components(trades: DataFrame) -> DataFrame:
    """The edges whose companies are in one component: all others lie on no cycle."""
    parts = materialise(strong_components(trades).select("mst", "component"), "components")
    a, b = parts.toDF("seller_mst", "_a"), parts.toDF("buyer_mst", "_b")
    return trades.join(a, "seller_mst").join(b, "buyer_mst").where("_a = _b and seller_mst <> buyer_mst").select(*trades.columns)
