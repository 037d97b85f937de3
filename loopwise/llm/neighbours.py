"""Approximate nearest neighbours by inner product: a robust-pruned directed graph for each shard."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import materialise


def _distances(x: np.ndarray, norms: np.ndarray, ids: np.ndarray, q: np.ndarray, qn: np.ndarray) -> np.ndarray:
    """Squared distances of each query to its own list of points."""
    return norms[ids] + qn[:, None] - 2 * np.matmul(x[ids], q[:, :, None])[:, :, 0]


def beam_search(x: np.ndarray, norms: np.ndarray, graph: np.ndarray, entry: int, q: np.ndarray, width: int, at_once: int = 4) -> tuple[np.ndarray, np.ndarray, list[np.ndarray]]:
    """Greedy beam search of all queries together.

    Returns (ids, squared distances) of the ``width`` nearest found, ascending
    (missing: -1, inf), and the nodes that were expanded in each step (-1:
    none). graph: out-neighbours of each node, -1 where there are fewer.
    """
    m, n = len(q), len(x)
    qn = (q * q).sum(axis=1)
    seen = np.zeros((m, n + 1), bool)
    seen[:, n] = True  # where -1 points
    seen[:, entry] = True
    ids = np.full((m, width), -1)
    dist = np.full((m, width), np.inf)
    done = np.ones((m, width), bool)
    ids[:, 0] = entry
    dist[:, 0] = _distances(x, norms, ids[:, :1], q, qn)[:, 0]
    done[:, 0] = False
    expanded: list[np.ndarray] = []
    while True:
        live = np.flatnonzero(~done.all(axis=1))
        if not len(live):
            return ids, dist, expanded
        lr = live[:, None]
        pick = np.argsort(np.where(done[live], np.inf, dist[live]), axis=1, kind="stable")[:, :at_once]
        node = np.where(done[lr, pick], -1, ids[lr, pick])
        done[lr, pick] = True
        out = np.full((m, pick.shape[1]), -1)
        out[live] = node
        expanded.append(out)
        near = np.where(node[:, :, None] >= 0, graph[node], -1).reshape(len(live), -1)
        near = np.sort(near, axis=1)
        near[:, 1:][near[:, 1:] == near[:, :-1]] = -1  # two nodes may share a neighbour
        near = np.where(seen[lr, near], -1, near)
        seen[lr, near] = True
        d = np.where(near >= 0, _distances(x, norms, near, q[live], qn[live]), np.inf)
        all_ids = np.concatenate((ids[live], near), axis=1)
        all_dist = np.concatenate((dist[live], d), axis=1)
        all_done = np.concatenate((done[live], near < 0), axis=1)
        best = np.argsort(all_dist, axis=1, kind="stable")[:, :width]
        k = np.arange(len(live))[:, None]
        ids[live], dist[live], done[live] = all_ids[k, best], all_dist[k, best], all_done[k, best]


def robust_prune(x: np.ndarray, norms: np.ndarray, nodes: np.ndarray, candidates: np.ndarray, degree: int, relax: float) -> np.ndarray:
    """Diverse out-neighbours of each node out of its row of candidates (-1: none).

    The nearest candidate is kept, and every other candidate that is ``relax``
    times nearer to it than to the node is dropped; and so on with what is left.
    """
    c = np.sort(candidates, axis=1)
    c[:, 1:][c[:, 1:] == c[:, :-1]] = -1
    c[c == nodes[:, None]] = -1
    d = np.where(c >= 0, _distances(x, norms, c, x[nodes], norms[nodes]), np.inf)
    order = np.argsort(d, axis=1, kind="stable")
    c, d = np.take_along_axis(c, order, 1), np.take_along_axis(d, order, 1)
    most = int((c >= 0).sum(axis=1).max(initial=0))
    c, d = c[:, :most], np.maximum(d[:, :most], 0)
    out = np.full((len(nodes), degree), -1)
    if not most:
        return out
    v = x[c]
    pair = norms[c][:, :, None] + norms[c][:, None, :] - 2 * np.matmul(v, v.transpose(0, 2, 1))
    alive = c >= 0
    rows = np.arange(len(nodes))
    for k in range(degree):
        first = alive.argmax(axis=1)
        ok = alive[rows, first]
        if not ok.any():
            break
        out[:, k] = np.where(ok, c[rows, first], -1)
        alive &= ~((relax * relax * pair[rows, first] <= d) & ok[:, None])
        alive[rows, first] = False
    return out


def build_graph(x: np.ndarray, degree: int, width: int, relax: float, seed: int = 9) -> tuple[np.ndarray, int]:
    """(out-neighbours, entry node) of a shard: nodes come in growing batches, each found by search of the graph so far."""
    n = len(x)
    norms = (x * x).sum(axis=1)
    entry = int(np.argmin(((x - x.mean(axis=0)) ** 2).sum(axis=1)))
    graph = np.full((n, degree), -1)
    order = np.random.default_rng(seed).permutation(n)
    order = np.concatenate(([entry], order[order != entry]))
    at = 1
    while at < n:
        batch = order[at : at + max(1, min(at, 256))]
        ids, _, expanded = beam_search(x, norms, graph, entry, x[batch], width)
        cand = np.concatenate((ids, *expanded), axis=1)
        # nodes of one batch don't find each other by search
        if len(batch) > 1:
            k = min(8, len(batch) - 1)
            d = norms[batch][:, None] + norms[batch][None, :] - 2 * x[batch] @ x[batch].T
            np.fill_diagonal(d, np.inf)
            cand = np.concatenate((cand, batch[np.argpartition(d, k - 1, axis=1)[:, :k]]), axis=1)
        graph[batch] = robust_prune(x, norms, batch, cand, degree, relax)
        src = np.repeat(batch, degree)
        dst = graph[batch].ravel()
        src, dst = src[dst >= 0], dst[dst >= 0]
        o = np.argsort(dst, kind="stable")
        src, dst = src[o], dst[o]
        target, first, count = np.unique(dst, return_index=True, return_counts=True)
        new = np.full((len(target), int(count.max())), -1)
        new[np.repeat(np.arange(len(target)), count), np.arange(len(dst)) - np.repeat(first, count)] = src
        both = np.concatenate((graph[target], new), axis=1)
        size = (both >= 0).sum(axis=1)
        fits = size <= degree
        packed = -np.sort(-both[fits], axis=1)[:, :degree]
        graph[target[fits]] = packed
        if (~fits).any():
            for a in range(0, int((~fits).sum()), 256):
                t = target[~fits][a : a + 256]
                graph[t] = robust_prune(x, norms, t, both[~fits][a : a + 256], degree, relax)
        at += len(batch)
    return graph, entry


def _usable(v):
    return F.coalesce((F.size(v) > 0) & ~F.exists(v, lambda y: y.isNull() | F.isnan(y) | (F.abs(y) == float("inf"))) & F.exists(v, lambda y: y != 0), F.lit(False))


def nearest(vectors: DataFrame, every: int = 20, k: int = 20, shard_rows: int = 8192, degree: int = 32, build_width: int = 48, width: int = 128, relax: float = 1.2) -> DataFrame:
    """(query_id, rank, vec_id, score): the k largest inner products found for each row whose vec_id is divisible by ``every``.

    vectors: (vec_id, embedding). Rows without id, and vectors that are null,
    zero, or hold a null or non-finite component take no part; vectors of
    different lengths are never compared; rows that share the query's vec_id
    are its own. Rows with one vec_id and different vectors ask together: a
    candidate counts with its largest score. Equal vectors are one node of the graph, with the k + 1
    smallest ids each (more can't be asked for). Inner product becomes distance
    by one more coordinate, which gives all points of a shard the same norm.
    Shards hold about ``shard_rows`` nodes whatever the input. A shard's graph
    stays in one task, which all queries stream through, and each query's best
    of all shards are merged: the rows that move are queries times shards, so
    they grow with the square of the table, but no graph is ever copied.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v")).where("vec_id is not null").where(_usable(F.col("v")))
    rows = materialise(rows, "vectors")
    # the smallest ids of each vector, first within salted parts, so that one frequent vector is spread
    part = W.partitionBy("v", F.pmod(F.xxhash64("vec_id"), F.lit(64))).orderBy("vec_id")
    some = rows.withColumn("i", F.row_number().over(part)).where(F.col("i") <= k + 1).drop("i")
    some = some.withColumn("i", F.row_number().over(W.partitionBy("v").orderBy("vec_id"))).where(F.col("i") <= k + 1)
    nodes = materialise(some.groupBy("v").agg(F.sort_array(F.collect_list("vec_id")).alias("ids")).withColumn("dim", F.size("v")), "nodes")
    sizes = {r["dim"]: r["count"] for r in nodes.groupBy("dim").count().collect()}  # one row for each vector length
    if not sizes:
        return spark.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    shards = {d: -(-n // shard_rows) for d, n in sizes.items()}
    count = F.element_at(F.create_map(*[F.lit(x) for kv in shards.items() for x in kv]), F.col("dim"))

    def build(table: pa.Table) -> pa.Table:
        dim = table.column("dim")[0].as_py()
        x = table.column("v").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, dim)
        norms = (x * x).sum(axis=1)
        far = np.sqrt(np.maximum(norms.max() - norms, 0))
        graph, entry = build_graph(np.column_stack((x, far)), degree, build_width, relax)
        ids = table.column("ids").combine_chunks()
        return pa.table({"dim": [dim], "shard": [table.column("shard")[0].as_py()], "x": [x.tobytes()], "far": [far.tobytes()], "graph": [graph.astype("<i4").tobytes()], "entry": [entry], "ids": [ids.flatten().to_numpy().tobytes()], "edges": [ids.offsets.to_numpy().astype("<i8").tobytes()]}, schema=pa.schema([("dim", pa.int32()), ("shard", pa.int32()), *((c, pa.binary()) for c in ("x", "far", "graph")), ("entry", pa.int32()), ("ids", pa.binary()), ("edges", pa.binary())]))

    sharded = nodes.withColumn("shard", F.pmod(F.xxhash64("v"), count).cast("int"))
    graphs = materialise(sharded.groupBy("dim", "shard").applyInArrow(build, "dim int, shard int, x binary, far binary, graph binary, entry int, ids binary, edges binary"), "graphs")
    asked = rows.where(F.col("vec_id") % every == 0).withColumn("dim", F.size("v")).withColumn("shard", F.explode(F.sequence(F.lit(0), count - 1)))

    def search(batches):
        """Rows sorted by (dim, shard, nothing asked first): a graph, then its queries."""
        at = graph = None
        for batch in batches:
            dims, shards_ = batch.column("dim").to_numpy(), batch.column("shard").to_numpy()
            edges_ = [0, *(np.flatnonzero((np.diff(dims) != 0) | (np.diff(shards_) != 0)) + 1).tolist(), len(dims)]
            for a, b in zip(edges_, edges_[1:], strict=False):
                part = batch.slice(a, b - a)
                if not part.num_rows:
                    continue
                key = dims[a], shards_[a]
                if part.column("x")[0].is_valid:
                    at, graph = key, _unpacked(part.slice(0, 1).to_pylist()[0])
                    part = part.slice(1)
                if at != key:
                    raise RuntimeError("queries came before their graph")
                flat = part.column("q").flatten().to_numpy(zero_copy_only=False).reshape(part.num_rows, int(dims[a]))
                q_ids = part.column("vec_id").to_numpy(zero_copy_only=False)
                for c in range(0, len(q_ids), 256):
                    yield _best_of(graph, q_ids[c : c + 256], flat[c : c + 256], k, width)

    nothing = {"vec_id": F.lit(None).cast("long"), "q": F.lit(None).cast("array<double>")}
    fields = ("x", "far", "graph", "entry", "ids", "edges")
    streams = graphs.withColumns(nothing).unionByName(asked.select("dim", "shard", "vec_id", F.col("v").alias("q")), allowMissingColumns=True)
    streams = streams.repartition(sum(shards.values()), "dim", "shard").sortWithinPartitions("dim", "shard", F.col("vec_id").asc_nulls_first())
    found = streams.select("dim", "shard", "vec_id", "q", *fields).mapInArrow(search, "query_id long, vec_id long, score double")
    best = found.groupBy("query_id", "vec_id").agg(F.max("score").alias("score"))
    rank = F.row_number().over(W.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return best.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def _unpacked(row: dict) -> dict:
    """A shard's arrays, ready to be searched."""
    x, far = np.frombuffer(row["x"]).reshape(-1, row["dim"]), np.frombuffer(row["far"])
    wide = np.column_stack((x, far))
    return {
        "x": x,
        "wide": wide,
        "norms": (wide * wide).sum(axis=1),
        "graph": np.frombuffer(row["graph"], "<i4").reshape(len(x), -1).astype(np.int64),
        "entry": row["entry"],
        "ids": np.frombuffer(row["ids"], np.int64),
        "edges": np.frombuffer(row["edges"], "<i8"),
    }


def _best_of(g: dict, q_ids: np.ndarray, own: np.ndarray, k: int, width: int) -> pa.RecordBatch:
    """(query_id, vec_id, score): the k best of one shard for each query, without the query's own rows."""
    found, _, _ = beam_search(g["wide"], g["norms"], g["graph"], g["entry"], np.column_stack((own, np.zeros(len(own)))), width)
    qi, col = np.nonzero(found >= 0)
    node = found[qi, col]
    score = np.einsum("ij,ij->i", own[qi], g["x"][node])
    edges = g["edges"]
    size = edges[node + 1] - edges[node]
    each = np.repeat(np.arange(len(node)), size)
    vec = g["ids"][np.repeat(edges[node] - (np.cumsum(size) - size), size) + np.arange(int(size.sum()))]
    qi, score = qi[each], score[each]
    other = vec != q_ids[qi]
    qi, vec, score = qi[other], vec[other], score[other]
    o = np.lexsort((vec, -score, qi))
    qi, vec, score = qi[o], vec[o], score[o]
    best = np.arange(len(qi)) - np.searchsorted(qi, qi) < k
    return pa.RecordBatch.from_arrays([pa.array(q_ids[qi[best]].astype(np.int64)), pa.array(vec[best]), pa.array(score[best])], names=["query_id", "vec_id", "score"])
