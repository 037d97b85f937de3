"""Metrics of the company network."""

from __future__ import annotations

import math
import sys
import tempfile
from collections.abc import Iterator
from functools import partial
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..scratch import materialise

NEW_PARTNER_DAYS = 90

cloudpickle.register_pickle_by_value(sys.modules[__name__])  # workers that don't have the package run the steps of betweenness too


def partners(trades: DataFrame) -> DataFrame:
    """(mst, partner, both): undirected partners, and whether both have sold to each other."""
    pairs = trades.where("seller_mst <> buyer_mst").select(F.col("seller_mst").alias("mst"), F.col("buyer_mst").alias("partner")).distinct()
    sides = pairs.withColumn("n", F.lit(1)).unionByName(pairs.select(F.col("partner").alias("mst"), F.col("mst").alias("partner"), F.lit(1).alias("n")))
    return sides.groupBy("mst", "partner").agg((F.sum("n") > 1).alias("both"))


def degree_and_reciprocity(trades: DataFrame) -> DataFrame:
    """(mst, degree, degree_centrality, reciprocity_ratio)."""
    each = partners(trades).groupBy("mst").agg(F.count("*").alias("degree"), F.count_if("both").alias("n_both"))
    n = each.agg((F.count("*") - 1).alias("n_others"))  # one row
    return each.join(F.broadcast(n)).select(
        "mst",
        "degree",
        F.bround(F.coalesce(F.try_divide(F.col("degree").cast("double"), F.col("n_others")), F.lit(0.0)), 4).alias("degree_centrality"),
        F.bround(F.col("n_both") / F.col("degree"), 4).alias("reciprocity_ratio"),
    )


def first_seen(trades: DataFrame) -> DataFrame:
    """(seller_mst, buyer_mst, first_seen) by the earliest valid first date of each directed pair."""
    day = F.try_to_timestamp("first_date", F.lit("yyyy-MM-dd")).cast("date")
    return trades.where("seller_mst <> buyer_mst").groupBy("seller_mst", "buyer_mst").agg(F.min(day).alias("first_seen")).where("first_seen is not null")


def new_partner_rate(trades: DataFrame, days: int = NEW_PARTNER_DAYS) -> DataFrame:
    """(mst, new_partner_rate_90d): share of partners first met in the last days.

    The last day is the newest first date of any pair; a partner's date is that
    of the outgoing pair, else of the incoming one.
    """
    seen = first_seen(trades)
    ref = seen.agg(F.date_sub(F.max("first_seen"), days).alias("cutoff"))  # one row
    out = seen.select(F.col("seller_mst").alias("mst"), F.col("buyer_mst").alias("partner"), F.col("first_seen").alias("out_first"))
    into = seen.select(F.col("buyer_mst").alias("mst"), F.col("seller_mst").alias("partner"), F.col("first_seen").alias("in_first"))
    met = partners(trades).join(out, ["mst", "partner"], "left").join(into, ["mst", "partner"], "left").withColumn("met", F.coalesce("out_first", "in_first"))
    return met.join(F.broadcast(ref)).groupBy("mst").agg(F.bround(F.count_if(F.col("met") >= F.col("cutoff")) / F.count("*"), 4).alias("new_partner_rate_90d"))


#: Companies that are numbered together, bytes of the adjacency that a task holds in memory, and neighbours that it looks at together.
BLOCK, HELD_BYTES, SLICE = 1024, 1 << 30, 1 << 21


def betweenness(trades: DataFrame, most_rounds: int = 64, batch: int = 8192, block: int = BLOCK) -> DataFrame:
    """(mst, betweenness_centrality): undirected, unweighted, each pair counted once, not normalised.

    Brandes' sums, one source after the other. Companies are numbered in blocks
    of about ``block``; their lists of neighbours, about a byte for each, are
    sent once to each task, which searches from at most ``batch`` sources and
    gives out one sum a company. Nothing of a single source leaves its task.
    A task holds lists (4 bytes a neighbour) of up to HELD_BYTES in memory and
    more in a mapped file. A step looks at the neighbours of the level or at
    those of the companies that are left, whichever are fewer.
    """
    pairs = materialise(trades.where("seller_mst <> buyer_mst").select(F.col("seller_mst").alias("v"), F.col("buyer_mst").alias("w")).distinct(), "pairs")
    each = materialise(pairs.select("v").union(pairs.select("w")).distinct(), "companies")
    n = each.count()
    n_blocks = max(1, -(-n // block))
    bucket = F.pmod(F.xxhash64("v"), F.lit(n_blocks)).cast("int")
    nodes = materialise(each.withColumn("c", bucket).withColumn("i", F.row_number().over(W.partitionBy("c").orderBy("v")) - 1), "places")
    counted = {r.c: r.n for r in nodes.groupBy("c").agg(F.count("*").alias("n")).collect()}
    sizes = [counted.get(c, 0) for c in range(n_blocks)]
    place = F.col("i") + F.element_at(F.array([F.lit(sum(sizes[:c])) for c in range(n_blocks)]), F.col("c") + 1)
    of = lambda end, name: nodes.select(F.col("v").alias(end), place.alias(name))
    numbered = pairs.join(of("v", "a"), "v").join(of("w", "b"), "w")
    sides = numbered.select(F.explode(F.array(F.struct(F.col("a").alias("place"), F.col("b").alias("near")), F.struct(F.col("b").alias("place"), F.col("a").alias("near"))))).select("col.*")
    lists = materialise(sides.groupBy("place").agg(F.collect_list("near").alias("near")).mapInArrow(_coded, "place int, degree long, near binary"), "adjacency")
    n_near = lists.agg(F.coalesce(F.sum("degree"), F.lit(0)).alias("n")).first().n
    cores = trades.sparkSession.sparkContext.defaultParallelism
    tasks = max(1, min(n, cores * -(-n // (batch * cores))))
    dealt = lists.select(F.explode(F.sequence(F.lit(0), F.lit(tasks - 1))).alias("task"), "place", "near").repartitionById(tasks, "task")
    searched = dealt.mapInArrow(partial(_searched, shape=_Shape(sizes, n_near, tasks, most_rounds)), "c int, delta array<double>, ended boolean")
    searched = materialise(searched, "delta")
    if not searched.where("not ended").isEmpty():
        raise RuntimeError(f"shortest paths of {most_rounds} hops and more")
    delta = searched.select("c", F.posexplode("delta").alias("i", "delta")).groupBy("c", "i").agg(F.sum("delta").alias("delta"))
    return nodes.join(delta, ["c", "i"], "left").select(F.col("v").alias("mst"), F.bround(F.coalesce("delta", F.lit(0.0)) / 2, 6).alias("betweenness_centrality"))


class _Shape(NamedTuple):
    """Companies by block, neighbours of all companies, tasks, and most hops."""

    sizes: list[int]
    n_near: int
    tasks: int
    most_rounds: int


def _coded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(place, degree, near): sorted neighbours by their distances from one another, a byte for the rest after a byte of 255 for each 255."""
    for batch in batches:
        near = [np.unique(x.values.to_numpy()) for x in batch.column("near")]
        coded = []
        for x in near:
            steps, rest = np.divmod(np.diff(x, prepend=0), 255)
            ends = np.cumsum(steps + 1) - 1
            code = np.full(ends[-1] + 1, 255, np.uint8)
            code[ends] = rest
            coded.append(code.tobytes())
        yield pa.RecordBatch.from_pydict({"place": batch.column("place"), "degree": pa.array([len(x) for x in near], pa.int64()), "near": pa.array(coded, pa.binary())})


def _searched(batches: Iterator[pa.RecordBatch], shape: _Shape) -> Iterator[pa.RecordBatch]:
    """(c, delta, ended): the sums of all companies by block, over the sources of a task, and whether its searches came to their end."""
    graph, task = _Graph(sum(shape.sizes), shape.n_near), None
    for batch in batches:
        for k, place in enumerate(batch.column("place").to_pylist()):
            graph.add(place, batch.column("near")[k].as_buffer())
        if batch.num_rows:
            task = batch.column("task")[0].as_py()
    if task is None:
        return
    delta, ended = np.zeros(graph.n), True
    for s in range(task, graph.n, shape.tasks):
        ended = ended and graph.carry(s, delta, shape.most_rounds)
    first = 0
    for c, size in enumerate(shape.sizes):
        yield pa.RecordBatch.from_pydict({"c": pa.array([c], pa.int32()), "delta": pa.array([delta[first : first + size]], pa.list_(pa.float64())), "ended": pa.array([ended])})
        first += size


class _Graph:
    """Neighbours of all companies, which are known by their places."""

    def __init__(self, n: int, n_near: int):
        self.n, self.filled = n, 0
        self.first, self.degree = np.zeros(n, np.int64), np.zeros(n, np.int64)
        self.near = np.empty(n_near, np.int32) if 4 * n_near <= HELD_BYTES else np.memmap(tempfile.TemporaryFile(), np.int32, "w+", shape=(n_near,))
        self.component, self.reach = np.full(n, -1, np.int32), []

    def add(self, place: int, code: pa.Buffer) -> None:
        steps = np.frombuffer(code, np.uint8)
        near = np.cumsum(steps, dtype=np.int32)[steps < 255]
        self.first[place], self.degree[place] = self.filled, len(near)
        self.near[self.filled : self.filled + len(near)] = near
        self.filled += len(near)

    def lists(self, places: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        """Some of the places, their degrees and all their neighbours, until all places have come."""
        degree = self.degree[places]
        cuts = np.flatnonzero(np.diff(np.cumsum(degree) // SLICE, prepend=0))
        for some, lengths in zip(np.split(places, cuts), np.split(degree, cuts), strict=True):
            if len(some):
                first = self.first[some]
                if lengths.mean() < 32:
                    yield some, lengths, self.near[np.repeat(first - np.cumsum(lengths) + lengths, lengths) + np.arange(lengths.sum())]
                else:
                    yield some, lengths, np.concatenate([self.near[a:b] for a, b in zip(first.tolist(), (first + lengths).tolist(), strict=True)], dtype=np.intp)

    def spread(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """For each company the sum of the values of those of its neighbours that are among the places."""
        sums, at = np.zeros(self.n), 0
        for some, lengths, near in self.lists(places):
            sums += np.bincount(near, np.repeat(values[at : at + len(some)], lengths), self.n)
            at += len(some)
        return sums

    def gathered(self, places: np.ndarray, values: np.ndarray) -> np.ndarray:
        """For each of the places the sum of the values of its neighbours."""
        sums = [np.add.reduceat(values.take(near), np.cumsum(lengths) - lengths) for _, lengths, near in self.lists(places)]
        return np.concatenate(sums) if sums else np.zeros(0)

    def component_of(self, s: int) -> int:
        """Number of the component of a company, which is looked for once."""
        if self.component[s] < 0:
            number, front = len(self.reach), np.array([s])
            self.component[s] = number
            while front.size and (self.component < 0).any():
                seen = np.zeros(self.n, bool)
                for _, _, near in self.lists(front):
                    seen[near] = True
                front = np.flatnonzero(seen & (self.component < 0))
                self.component[front] = number
            self.reach.append(int(self.degree[self.component == number].sum()))
        return self.component[s]

    def carry(self, s: int, delta: np.ndarray, most_rounds: int) -> bool:
        """Add to ``delta`` what each company carries of the shortest paths from the source; False if they are too long."""
        number = self.component_of(s)
        waiting = self.component == number  # companies that aren't reached yet
        waiting[s] = False
        left = self.reach[number] - self.degree[s]  # their degrees in all
        paths = np.zeros(self.n)
        paths[s] = 1.0
        levels, ends = [np.array([s])], [int(self.degree[s])]
        while left:
            if len(levels) > most_rounds:
                return False
            if ends[-1] <= left:
                sums = self.spread(levels[-1], paths[levels[-1]])
                level = np.flatnonzero(waiting & (sums > 0))
                paths[level] = sums[level]
            else:
                rest, values = np.flatnonzero(waiting), np.zeros(self.n)
                values[levels[-1]] = paths[levels[-1]]
                sums = self.gathered(rest, values)
                level = rest[sums > 0]
                paths[level] = sums[sums > 0]
            waiting[level] = False
            levels.append(level)
            ends.append(int(self.degree[level].sum()))
            left -= ends[-1]
        share = np.zeros(self.n)
        for depth in range(len(levels) - 1, 1, -1):
            far, nearer = levels[depth], levels[depth - 1]
            values = (1 + share[far]) / paths[far]
            if ends[depth] <= ends[depth - 1]:
                share[nearer] = paths[nearer] * self.spread(far, values)[nearer]
            else:
                each = np.zeros(self.n)
                each[far] = values
                share[nearer] = paths[nearer] * self.gathered(nearer, each)
        delta += share
        return True


def _carried(adj: DataFrame, sources: DataFrame, most_rounds: int) -> DataFrame:
    """(v, delta): what each vertex carries of the shortest paths from the sources (v)."""
    levels = [materialise(sources.select(F.col("v").alias("s"), "v", F.lit(1.0).alias("sigma")), "level")]
    for _ in range(1, most_rounds):
        step = levels[-1].join(adj, "v").groupBy("s", F.col("w").alias("v")).agg(F.sum("sigma").alias("sigma"))
        # a neighbour of a level lies in it, in the one before, or in the next
        near = levels[-1].select("s", "v") if len(levels) == 1 else levels[-1].select("s", "v").unionByName(levels[-2].select("s", "v"))
        step = materialise(step.join(near, ["s", "v"], "left_anti"), "level")
        if step.isEmpty():
            break
        levels.append(step)
    else:
        raise RuntimeError(f"shortest paths of {most_rounds} hops and more")
    carried, total = None, sources.sparkSession.createDataFrame([], adj.select("v", F.lit(0.0).alias("delta")).schema)
    for before, level in zip(reversed(levels[:-1]), reversed(levels[1:]), strict=True):
        own = level.withColumn("delta", F.lit(0.0)) if carried is None else level.join(carried, ["s", "v"], "left").withColumn("delta", F.coalesce("delta", F.lit(0.0)))
        own = materialise(own.select("s", "v", "sigma", "delta"), "delta")
        total = total.unionByName(own.select("v", "delta"))
        nearer = before.select("s", F.col("v").alias("u"), F.col("sigma").alias("sigma_u"))
        carried = own.join(adj.select("v", F.col("w").alias("u")), "v").join(nearer, ["s", "u"]).groupBy("s", F.col("u").alias("v")).agg(F.sum(F.col("sigma_u") / F.col("sigma") * (1 + F.col("delta"))).alias("delta"))
    return materialise(total.groupBy("v").agg(F.sum("delta").alias("delta")), "carried")


def sampled_betweenness(trades: DataFrame, samples: int, seed: int = 0, confidence: float = 0.95, most_rounds: int = 64) -> DataFrame:
    """(mst, betweenness_centrality, error): an estimate from the shortest paths of some sources.

    ``samples`` companies, the first by a hash of their names, are the sources;
    what a company carries of their paths is scaled to all. error bounds the
    difference from the exact value for any one company with the stated
    confidence (Hoeffding: a source adds between 0 and n - 2 to the sum that is
    halved). The work is samples times edges, whatever the number of companies.
    With as many samples as companies the values are exact and the error 0.
    """
    adj = materialise(partners(trades).select(F.col("mst").alias("v"), F.col("partner").alias("w")), "adjacency")
    nodes = materialise(adj.select("v").distinct(), "companies")
    n = nodes.count()
    some = materialise(nodes.orderBy(F.xxhash64("v", F.lit(seed)), "v").limit(samples), "sources")
    k = min(n, samples)
    sums = nodes.withColumn("delta", F.lit(0.0))
    if k:
        sums = sums.unionByName(_carried(adj, some, most_rounds))
    error = 0.0 if k in (0, n) else n * max(n - 2, 0) / 2 * math.sqrt(math.log(2 / (1 - confidence)) / (2 * k))
    return sums.groupBy(F.col("v").alias("mst")).agg(F.bround(F.sum("delta") * (n / max(k, 1)) / 2, 6).alias("betweenness_centrality"), F.lit(error).alias("error"))


#: More companies than this have their betweenness estimated from so many sources, unless asked otherwise.
MOST_EXACT, SOURCES = 50_000, 1024


def company_metrics(trades: DataFrame, samples: int | None = None, most_exact: int = MOST_EXACT) -> DataFrame:
    """All four metrics of every company of the window.

    betweenness is exact up to ``most_exact`` companies; beyond, and where
    ``samples`` are asked for, it is estimated and has its error beside it.
    """
    if samples is None and trades.select(F.explode(F.array("seller_mst", "buyer_mst")).alias("k")).distinct().count() > most_exact:
        samples = SOURCES
    between = betweenness(trades) if samples is None else sampled_betweenness(trades, samples)
    return degree_and_reciprocity(trades).drop("degree").join(new_partner_rate(trades), "mst").join(between, "mst")
