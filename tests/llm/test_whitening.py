"""Whitening against exact integers and the definition of its columns."""

import math
from collections import Counter

import numpy as np
import pytest
from loopwise.llm.vectors import integer_blocks
from loopwise.llm.whitening import Moments, exact_moments, exact_scatter, from_residues, primes_over, residue_products, whitened_embeddings

SCHEMA = "vec_id long, embedding array<double>, label int, n string"


def integers(rows):
    return np.array([[math.floor(1024 * c) + 100_000 for c in r[1]] for r in rows], object)


def test_residues_give_exact_integers():
    rnd = np.random.default_rng(1)
    x = rnd.integers(-(2**40), 2**40, (3, 9001))
    n, sums = 9001, [int(s) for s in x.astype(object).sum(axis=1)]
    z = x.astype(object) * n - np.array(sums, object)[:, None]
    want = (z @ z.T).tolist()
    bound = 2 * max(abs(v) for row in want for v in row) + 1
    primes = primes_over(bound)
    assert math.prod(primes) > bound and len(set(primes)) == len(primes) and all(pow(2, p - 1, p) == 1 and p < 2**20 for p in primes)
    assert from_residues(residue_products(x, n, sums, primes), primes) == want


def test_scatter_over_partitions_is_exact(spark):
    rnd = np.random.default_rng(2)
    rows = [(i, (rnd.normal(size=5) * 10.0 ** rnd.integers(0, 6)).tolist(), 0, "") for i in range(500)]
    length, blocks = integer_blocks(spark.createDataFrame(rows, SCHEMA).repartition(6), "embedding")
    moments = exact_moments(blocks, length)
    x = integers(rows)
    sums = x.sum(axis=0)
    z = x * len(rows) - sums
    assert moments == Moments(500, sums.tolist(), int(np.abs(z).max()))
    assert exact_scatter(blocks, length, moments) == (z.T @ z).tolist()


def check(df, rows, most=8):
    assert df.columns == ["vec_id", "component", "n", "deviation", "whitened", "explained", "identity_error"]
    x = integers(rows)
    n = len(rows)
    z = x * n - x.sum(axis=0)
    v = np.array((z.T @ z).tolist(), object) / n**3
    v = v.astype(float)
    e, basis = np.linalg.eigh(v)
    order = np.argsort(-e)[:most]
    e, basis = e[order], basis[:, order]
    keep = e > 1e-10 * e.max()
    e, basis = e[keep], basis[:, keep]
    white = ((z / n).astype(float) @ basis) / np.sqrt(e)
    got = df.collect()
    assert len(got) == n * len(e) and {r["n"] for r in got} == {n}
    by = {}
    for r in got:
        by.setdefault(r["component"], []).append(r)
    assert sorted(by) == list(range(1, len(e) + 1))
    for c, found in by.items():
        want = sorted((str(r[0]), int((z[i] ** 2).sum()), white[i, c - 1]) for i, r in enumerate(rows))
        have = sorted((str(r["vec_id"]), int(r["deviation"]), r["whitened"]) for r in found)
        assert [w[:2] for w in want] == [h[:2] for h in have]
        for sign in (1, -1):
            if np.allclose(sorted(sign * w[2] for w in want), sorted(h[2] for h in have), atol=1e-7):
                if len({r[0] for r in rows}) == n:
                    assert np.allclose([sign * w[2] for w in want], [h[2] for h in have], atol=1e-7)
                break
        else:
            pytest.fail(f"component {c}")
        assert all(abs(r["explained"] / (e[c - 1] / np.trace(v)) - 1) < 1e-6 and 0 <= r["identity_error"] < 1e-6 for r in found)


def test_whitened_rows(spark):
    rnd = np.random.default_rng(4)
    rows = [(i, (rnd.normal(size=12) * np.arange(1, 13) / 9).tolist()) for i in range(400)]
    odd = [(900, None), (901, [None] * 12), (902, [float("nan")] * 12), (903, [float("inf")] * 12), (904, [1.0]), (905, [])]
    df = spark.createDataFrame([(*r, 1, "clash") for r in rows + odd], SCHEMA).repartition(5)
    check(whitened_embeddings(df), rows)


def test_repeated_rows_null_ids_and_fewer_directions(spark):
    rnd = np.random.default_rng(5)
    rows = [(i % 50 if i % 9 else None, rnd.normal(size=3).round(2).tolist()) for i in range(200)]
    rows = [(i, [*v, 2 * v[0], 0.5]) for i, v in rows] + [(7, [0.1, 0.2, 0.3, 0.2, 0.5])] * 30
    check(whitened_embeddings(spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA)), rows)


def test_nothing_to_whiten(spark):
    empty = whitened_embeddings(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns[:2] == ["vec_id", "component"]
    assert whitened_embeddings(spark.createDataFrame([(1, None, 1, "")], SCHEMA)).count() == 0
    assert whitened_embeddings(spark.createDataFrame([(i, [0.5, 0.25], 1, "") for i in range(5)], SCHEMA)).count() == 0
    assert whitened_embeddings(spark.createDataFrame([(1, [], 1, "")], SCHEMA)).count() == 0


def test_deviation_beyond_a_long(spark):
    rows = [(i, [1e9 * i, -3e8 * i * i, 1.0]) for i in range(60)]
    df = whitened_embeddings(spark.createDataFrame([(*r, 1, "") for r in rows], SCHEMA))
    assert dict(df.dtypes)["deviation"] == "decimal(38,0)"
    x = integers(rows)
    z = x * 60 - x.sum(axis=0)
    assert Counter((r["vec_id"], int(r["deviation"])) for r in df.where("component = 1").collect()) == Counter((i, int((z[i] ** 2).sum())) for i in range(60))
