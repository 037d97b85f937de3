"""Betweenness: what is written and sent grows with companies and edges, not with pairs of companies."""

import random

import numpy as np
import pyarrow as pa
import pytest
from loopwise.operators import metrics
from loopwise.scratch import materialise

from .test_operators import brandes, graph


def some_pairs(seed, n, m):
    rnd = random.Random(seed)
    pairs = {(f"v{rnd.randrange(n)}", f"v{rnd.randrange(n)}") for _ in range(m)} | {(f"x{k}", f"x{k + 1}") for k in range(5)}
    return {(a, b) for a, b in pairs if a != b}


def test_no_table_of_sources_and_companies_is_written(spark, monkeypatch):
    written = {}

    def noted(df, name):
        made = materialise(df, name)
        assert written.setdefault(name, made) is made, f"{name} is written again"
        return made

    monkeypatch.setattr(metrics, "materialise", noted)
    pairs = some_pairs(3, 60, 700)
    got = {r.mst: r.betweenness_centrality for r in metrics.betweenness(graph(spark, [(a, b, 202101, 1, 0) for a, b in pairs])).collect()}
    assert got == pytest.approx(brandes(pairs), abs=1e-5)
    n, near = len(got), {(a, b) for x in pairs for a, b in (x, x[::-1])}
    assert set(written) == {"pairs", "companies", "places", "adjacency", "delta"}
    lists = written["adjacency"].collect()
    assert len(lists) == n and sum(r.degree for r in lists) == sum(len(r.near) for r in lists) == len(near)  # a byte for each
    sums = written["delta"].collect()
    assert len(sums) == spark.sparkContext.defaultParallelism and {len(r.delta) for r in sums} == {n}  # one for all sources of a task


def test_slices_and_mapped_lists(monkeypatch):
    """Slices of any size, in memory or in a mapped file, give the same; companies that are left are looked at where they are fewer."""
    pairs = some_pairs(4, 40, 500) | some_pairs(5, 25, 30)
    names = sorted({x for p in pairs for x in p})
    places = {v: k for k, v in enumerate(names)}
    lists = {k: set() for k in range(len(names))}
    for a, b in pairs:
        lists[places[a]].add(places[b])
        lists[places[b]].add(places[a])
    batch = pa.RecordBatch.from_pydict({"place": pa.array(lists, pa.int32()), "near": pa.array([[*x, *x] for x in lists.values()], pa.list_(pa.int32()))})
    (coded,) = metrics._coded([batch])
    n_near = sum(map(len, lists.values()))
    want = brandes(pairs)
    steps = {"spread": 0, "gathered": 0}
    for name in steps:
        step = getattr(metrics._Graph, name)
        monkeypatch.setattr(metrics._Graph, name, lambda *x, name=name, step=step: steps.update({name: steps[name] + 1}) or step(*x))
    for held, size in ((1 << 30, 1 << 21), (0, 7), (0, 1)):
        monkeypatch.setattr(metrics, "HELD_BYTES", held)
        monkeypatch.setattr(metrics, "SLICE", size)
        dealt = [coded.append_column("task", pa.array([t] * len(names), pa.int32())) for t in range(3)]
        shape = metrics._Shape([20, len(names) - 20], n_near, 3, 64)
        sums = np.zeros(len(names))
        for t in dealt:
            rows = list(metrics._searched([t], shape))
            assert all(r.column("ended")[0].as_py() for r in rows)
            sums += np.concatenate([r.column("delta")[0].values.to_numpy() for r in rows])
        assert dict(zip(names, sums / 2, strict=True)) == pytest.approx({v: want.get(v, 0.0) for v in names}, abs=1e-9)
    assert min(steps.values()) > 0


def test_far_neighbours_are_coded():
    near = [0, 254, 255, 511, 100_000]
    (coded,) = metrics._coded([pa.RecordBatch.from_pydict({"place": pa.array([7], pa.int32()), "near": pa.array([near[::-1]], pa.list_(pa.int32()))})])
    g = metrics._Graph(8, len(near))
    g.add(7, coded.column("near")[0].as_buffer())
    assert g.near.tolist() == near and g.degree[7] == len(near)
