"""Sieves drop what can't be joined, and nothing else."""

import random

import pytest
from loopwise.operators import cycles, sieve

from .test_operators import graph


@pytest.mark.parametrize("blocks", [1, 1 << 16])
def test_sieve_loses_no_key(spark, monkeypatch, blocks):
    monkeypatch.setattr(sieve, "MOST_BLOCKS", blocks)
    rows = spark.range(20_000).selectExpr("cast(id AS string) AS a", "id % 7 AS b")
    keys = rows.where("cast(a AS int) % 10 = 0").selectExpr("a AS x", "b AS y")
    kept = sieve.sifted(rows, ["a", "b"], sieve.sieve(keys, ["x", "y"]))
    got = {r.a for r in kept.collect()}
    assert kept.columns == ["a", "b"] and kept.count() == len(got)
    assert {str(i) for i in range(0, 20_000, 10)} <= got
    if blocks > 1:
        assert len(got) < 4_000  # 2 000 keys, and about one in sixteen of 18 000 others


def test_sieve_of_no_key(spark):
    rows = spark.range(10).selectExpr("id AS a")
    assert sieve.sifted(rows, ["a"], sieve.sieve(rows.where("a < 0"), ["a"])).count() == 0


@pytest.mark.parametrize("months", [None, [199603]])
def test_sifted_search_finds_the_same(spark, monkeypatch, months):
    rng = random.Random(5)
    rows = {(f"c{a}", f"c{b}", m): rng.choice([60, 80, 100]) for a, b, m in ((rng.randrange(24), rng.randrange(24), 199601 + rng.randrange(3)) for _ in range(170)) if a != b}
    trades = graph(spark, [(*k, v, v / 10) for k, v in rows.items()])
    hidden = spark.createDataFrame([(f"c{i}", f"g{i % 6}") for i in range(24)], "mst string, grp string")
    risky = spark.createDataFrame([("c3",), ("c11",)], "mst string")
    made = []
    sift = sieve.sifted
    monkeypatch.setattr(cycles, "sifted", lambda *x: made.append(x) or sift(*x))

    def found(least):
        monkeypatch.setattr(cycles, "SIFTED", least)
        rows, _ = cycles.search_cycles(trades, 199601, 199603, bound=10.0, hidden=hidden, risky=risky, months=months)
        return sorted((tuple(r.members), tuple(e.period for e in r.edges)) for r in rows.collect())

    plain = found(10**9)
    assert plain and not made
    assert found(0) == plain and len({len(x[0]) for x in plain}) == 3
    assert made
