"""Neighbours against brute force: recall, order, ties, and rows that take no part."""

from collections import defaultdict

import numpy as np
from loopwise.llm.neighbours import nearest

SCHEMA = "vec_id long, embedding array<float>, score string"


def brute(rows, every, k):
    ids = np.array([r[0] for r in rows])
    x = np.array([r[1] for r in rows], np.float64)
    out = {}
    for i in np.flatnonzero(ids % every == 0):
        s = x @ x[i]
        out[ids[i]] = [(ids[j], s[j]) for j in np.lexsort((ids, -s)) if ids[j] != ids[i]][:k]
    return out


def collect(df):
    out = defaultdict(list)
    for r in sorted(df.collect(), key=lambda r: (r["query_id"], r["rank"])):
        out[r["query_id"]].append((r["vec_id"], r["score"]))
        assert r["rank"] == len(out[r["query_id"]])
    return out


def test_recall_over_shards(spark):
    rnd = np.random.default_rng(1)
    centres = rnd.normal(size=(8, 24))
    rows = [(i, (centres[i % 8] + rnd.normal(size=24) * (1 + i % 3)).astype(np.float32).tolist(), "x") for i in range(3000)]
    got = collect(nearest(spark.createDataFrame(rows, SCHEMA), shard_rows=1000))
    want = brute(rows, 20, 20)
    assert got.keys() == want.keys()
    hits = [len({v for v, _ in got[q]} & {v for v, _ in want[q]}) / 20 for q in want]
    assert np.mean(hits) >= 0.95
    x = dict((r[0], np.array(r[1], np.float64)) for r in rows)
    for q, found in got.items():
        assert len(found) == 20 and found == sorted(found, key=lambda f: (-f[1], f[0]))
        assert all(abs(s - x[q] @ x[v]) < 1e-9 for v, s in found)


def test_ties_of_a_frequent_vector(spark):
    rows = [(i, [1.0, 0.0] if i % 3 else [0.0, float(i + 1)], None) for i in range(400)]
    got = collect(nearest(spark.createDataFrame(rows, SCHEMA), shard_rows=100))
    want = brute(rows, 20, 20)
    assert {q: [v for v, _ in f] for q, f in got.items()} == {q: [v for v, _ in f] for q, f in want.items()}


def test_rows_that_take_no_part(spark):
    good = [(0, [1.0, 2.0], "a"), (1, [2.0, 1.0], "b"), (20, [0.5, 0.5], "c"), (20, [3.0, 3.0], "again"), (40, [1.0], "short")]
    bad = [(60, None, "n"), (80, [0.0, 0.0], "z"), (100, [1.0, None], "n"), (120, [float("nan"), 1.0], "n"), (140, [float("inf"), 1.0], "i"), (None, [1.0, 1.0], "n"), (160, [], "e")]
    got = collect(nearest(spark.createDataFrame(good + bad, SCHEMA)))
    assert {v for v, _ in got[0]} == {1, 20} and 40 not in got and got.keys() == {0, 20}
    asks_twice = collect(nearest(spark.createDataFrame([*good, (3, [9.0, -9.0], "d")], SCHEMA)))  # 20 has two vectors
    assert dict(asks_twice[20]) == {0: 9.0, 1: 9.0, 3: 0.0}
    assert nearest(spark.createDataFrame([], SCHEMA)).count() == 0
    assert nearest(spark.createDataFrame([(1, [1.0], "x")], SCHEMA)).count() == 0
