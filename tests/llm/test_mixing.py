"""Mixing: posteriors on planted domains, rates against a plain projected gradient, and copies."""

import math
import random
import zlib

import corpus_pipeline
import numpy as np
import pytest
from loopwise.llm.mixing import TARGETS, calibrated, domain_posteriors, label_domains, mixing_rates, take_copies
from pyspark.sql import functions as F

DOCS = "doc_id long, text string, rate string"
LABELS = "doc_id long, quality int, toxic int"


@pytest.fixture(scope="module")
def corpus(spark):
    rnd = random.Random(5)
    words = [f"word{i}" for i in range(200)]
    docs, labels = [], []
    for i in range(400):
        kind = rnd.choices(["clean", "poor", "toxic"], [6, 2, 2])[0]
        w = rnd.choices(words, k=rnd.randrange(20, 60))
        w = w + ["vile", "nasty", "rotten"] if kind == "toxic" else [x + "###" for x in w[:5]] * 5 if kind == "poor" else w + ["kind", "fair", "sound"]
        docs.append((i, " ".join(w), None))
        if i % 2:
            labels.append((i, int(kind != "poor"), int(kind == "toxic")))
    kinds = [("toxic" if "vile" in t else "poor" if "#" in t else "clean") for _, t, _ in docs]
    return docs, labels, kinds


def test_posteriors(spark, corpus):
    docs, labels, kinds = corpus
    names = sorted(TARGETS)
    rows = domain_posteriors(spark.createDataFrame(docs, DOCS), label_domains(spark.createDataFrame(labels, LABELS)), names).collect()
    right = 0
    for r in rows:
        p = [r[f"p_{d}"] for d in names]
        assert abs(sum(p) - 1) < 2e-3 and min(p) >= 0
        assert r.n_tokens == len(docs[r.doc_id][1].split())
        right += names[p.index(max(p))] == kinds[r.doc_id]
    assert len(rows) == 400 and right > 390


@pytest.mark.parametrize("junk", [str.upper, lambda t: " ".join(str(zlib.crc32(f"{t}{k}".encode())) for k in range(40))])
def test_capitals_and_digits_are_seen(spark, junk):
    rnd = random.Random(9)
    words = [f"{a}{b}{c}" for a in "bdfgk" for b in "aeiou" for c in "lmnrs"]
    texts = [" ".join(rnd.choices(words, k=40)) for _ in range(1000)]
    docs = [(i, junk(t) if i % 2 else t, None) for i, t in enumerate(texts)]
    labels = [(i, 1 - i % 2, 0) for i in range(900)]
    rows = domain_posteriors(spark.createDataFrame(docs, DOCS), label_domains(spark.createDataFrame(labels, LABELS)), sorted(TARGETS)).where("doc_id >= 900").collect()
    assert all((r.p_poor > 0.9) == bool(r.doc_id % 2) for r in rows) and len(rows) == 100


def test_missed_targets_are_told(spark, corpus, caplog):
    docs, labels, _ = corpus
    tables = spark.createDataFrame(docs, DOCS), label_domains(spark.createDataFrame(labels, LABELS))
    assert mixing_rates(*tables, WANTED, most_steps=0).first().largest_miss > 0.01
    assert "did NOT settle after 0 steps" in caplog.text
    caplog.clear()
    assert mixing_rates(*tables, WANTED).first().largest_miss < 2e-3
    assert not caplog.text
    assert mixing_rates(*tables, WANTED, budget=1e6, max_rate=1.0).first().largest_miss > 0.1
    assert "came to rest" in caplog.text and "out of reach" in caplog.text


@pytest.mark.parametrize("sf", ["sf0.01", "sf0.1"])
def test_real_tables_meet_their_targets(spark, sf):
    """The query's own targets, and those of the pipeline's stage where its documents allow them."""
    docs, labels = (spark.read.parquet(f"/root/testdata/{sf}/{t}.parquet") for t in ("documents", "labels"))
    domains = label_domains(labels)
    rows = mixing_rates(docs, domains).join(domains.groupBy("doc_id").agg(F.first("domain").alias("domain")), "doc_id", "left").collect()
    budget = sum(r.n_tokens for r in rows)
    for d, t in TARGETS.items():
        assert abs(sum(r.n_tokens * r[f"p_{d}"] * r.rate for r in rows) / budget - t) < 0.01
    assert all(r.largest_miss < 0.01 for r in rows)
    known = [r for r in rows if r.domain]
    names = sorted(TARGETS)
    clean = [r for r in known if r.domain == "clean"]
    gone = [r for r in rows if r.rate == 0]
    assert sum(r.rate == 0 for r in clean) < len(clean) / 3 and (sf == "sf0.01" or rows[0].largest_miss < 2e-3)
    assert abs(sum(r.n_tokens * r.p_clean for r in gone) / sum(r.n_tokens * r.p_clean for r in rows) - rows[0].dropped) < 1e-9
    right = sum(max(names, key=lambda d: r[f"p_{d}"]) == r.domain for r in known)
    assert right > 0.8 * len(known)  # the labels of these tables are noisy; the largest class is 0.75
    for d in names:  # posteriors agree with the shares of the classes
        assert abs(sum(r[f"p_{d}"] for r in known) - sum(r.domain == d for r in known)) < 0.1 * len(known)
    kept = mixing_rates(docs, domains, max_rate=1.0, keep="clean").collect()
    assert all(r.rate == 1 for r in kept if r.p_clean >= max(r.p_poor, r.p_toxic))
    budget = sum(r.n_tokens * r.p_clean for r in kept) / TARGETS["clean"]
    got = {d: sum(r.n_tokens * r[f"p_{d}"] * r.rate for r in kept) / budget for d in names}
    assert abs(max(abs(got[d] - t) for d, t in TARGETS.items()) - kept[0].largest_miss) < 0.02  # what is out of reach is told
    # no other rates within the bounds come nearer: least squares by many small steps over the rows themselves
    for some, most, held, whole in ((rows, np.inf, False, sum(r.n_tokens for r in rows)), (kept, 1.0, True, budget)):
        p = np.array([[r[f"p_{d}"] for d in names] for r in some])
        n = np.array([r.n_tokens for r in some])
        low = ((p[:, names.index("clean")] >= p.max(axis=1)) & held).astype(float)
        want = np.array([min(TARGETS[d], (most * (n * p[:, k]).sum() / whole)) for k, d in enumerate(names)])
        a = p.T * n / whole
        x, step = np.ones(len(n)), 1 / np.linalg.norm(p.T @ (a.T), 2)
        for _ in range(3000):
            x = np.clip(x - step * (p @ (a @ x - want)), low, most)
        assert abs(np.abs(a @ x - want).max() - np.abs(a @ np.array([r.rate for r in some]) - want).max()) < 4e-3


def test_calibration():
    rnd = random.Random(3)
    rows = [[rnd.gauss(0, 1), rnd.gauss(0, 1)] for _ in range(4000)]
    truth = [int(rnd.random() < 1 / (1 + math.exp(2 * (a - b) - 1))) for a, b in rows]  # scale 2, shift 1
    scale, shift = calibrated(rows, truth)
    assert abs(scale - 2) < 0.2 and abs(shift[1] - shift[0] - 1) < 0.2
    assert calibrated([], []) == (1.0, []) and abs(calibrated(rows[:1], truth[:1])[0] - 1) < 1


def plain(rows, names, share, budget, most):
    """Projected gradient on the same objective, document by document, far beyond convergence."""
    w = [1 / (sum(r.n_tokens * r[f"p_{d}"] ** 2 for r in rows) / budget) for d in names]
    rate = [1.0] * len(rows)
    for _ in range(400):
        off = [sum(r.n_tokens * r[f"p_{d}"] * x for r, x in zip(rows, rate)) / budget - s for d, s in zip(names, share)]
        rate = [min(most or 1e9, max(0.0, x - 0.3 * (sum(wd * r[f"p_{d}"] * o for wd, d, o in zip(w, names, off)) + 1e-3 * (x - 1)))) for r, x in zip(rows, rate)]
    return rate


WANTED = {"clean": 0.5, "poor": 0.3, "toxic": 0.2}


@pytest.mark.parametrize("most", [None, 1.0])
def test_rates_meet_the_targets(spark, corpus, most):
    docs, labels, _ = corpus
    names = sorted(WANTED)
    share = [WANTED[d] for d in names]
    rows = mixing_rates(spark.createDataFrame(docs, DOCS), label_domains(spark.createDataFrame(labels, LABELS)), WANTED, max_rate=most).collect()
    got = [sum(r.n_tokens * r[f"p_{d}"] * r.rate for r in rows) for d in names]
    budget = sum(r.n_tokens for r in rows) if most is None else min(sum(r.n_tokens * r[f"p_{d}"] for r in rows) / s for d, s in zip(names, share))
    assert all(abs(g / budget - s) < 0.01 for g, s in zip(got, share))
    assert all(r.rate >= 0 and (most is None or r.rate <= most) for r in rows)
    want = plain(rows, names, share, budget, most)
    assert max(abs(r.rate - x) for r, x in zip(rows, want)) < 0.03


@pytest.mark.parametrize("n_poor", [6, 0])
def test_scarce_domains_take_nothing_from_clean(spark, tmp_path, n_poor):
    rnd = random.Random(7)
    words = [f"word{i}" for i in range(200)]
    marks = {"clean": "kind fair sound", "toxic": "vile nasty rotten", "poor": "### *** |||"}
    kinds = ["clean"] * 400 + ["toxic"] * 200 + ["poor"] * n_poor
    docs = [(i, " ".join(rnd.choices(words, k=40)) + " " + marks[k], None) for i, k in enumerate(kinds)]
    spark.createDataFrame([(i, int(k != "poor"), int(k == "toxic")) for i, k in enumerate(kinds)], LABELS).write.parquet(f"{tmp_path}/labels.parquet")
    left = [kinds[r.doc_id] for r in corpus_pipeline.mixing(spark, spark.createDataFrame(docs, DOCS), str(tmp_path)).collect()]
    assert left.count("clean") == 400 and left.count("toxic") < 30
    rows = mixing_rates(spark.createDataFrame(docs, DOCS), label_domains(spark.read.parquet(f"{tmp_path}/labels.parquet")), max_rate=1.0).collect()
    assert n_poor or sum(r.rate * r.n_tokens for r in rows) > 0.5 * 400 * 43  # an absent domain has share 0


def test_copies(spark):
    docs = spark.createDataFrame([(i, "t", "x") for i in range(300)] + [(None, "n", "x"), (5, "again", "y")], DOCS)
    rates = spark.createDataFrame([(i, [0.0, 1.0, 2.5][i % 3]) for i in range(300)] + [(None, 1.0)], "doc_id long, rate double")
    out = take_copies(docs, rates)
    n = {r.doc_id: r["count"] for r in out.where("text <> 'again'").groupBy("doc_id").count().collect()}
    assert out.columns == docs.columns and n[None] == 1
    assert all(n.get(i, 0) == [0, 1, n.get(i)][i % 3] for i in range(300)) and {n[i] for i in range(2, 300, 3)} == {2, 3}


def test_no_python_in_the_plan(spark, corpus):
    docs, labels, _ = corpus
    out = mixing_rates(spark.createDataFrame(docs, DOCS), label_domains(spark.createDataFrame(labels, LABELS)))
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Arrow" not in plan and "Pandas" not in plan


def test_edge_rows(spark):
    docs = [(1, None, "x"), (None, "", "x"), (3, "word " * 100_000, "x"), (3, "word", "x")]
    none = spark.createDataFrame([], LABELS)
    rows = mixing_rates(spark.createDataFrame(docs, DOCS), label_domains(none)).collect()
    assert sorted(r.n_tokens for r in rows) == [0, 0, 1, 100_000] and all(r.rate >= 0 for r in rows)
    assert mixing_rates(spark.createDataFrame([], DOCS), label_domains(none)).count() == 0
    assert mixing_rates(spark.createDataFrame(docs[:2], DOCS), label_domains(none)).agg(F.sum("rate")).first()[0] == 2.0
