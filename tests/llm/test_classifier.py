"""The factorisation machine: its linear-time form, held-out accuracy, and what it may learn from."""

import random
import zlib

import numpy as np
from loopwise.llm import classifier
from loopwise.llm.classifier import BUCKETS, STATISTICS, Machine, features, fit, quality_scores

DOCS = "doc_id long, text string, n_chars long, score string"
LABELS = "doc_id long, quality int, toxic int"


def test_pairs_in_linear_time():
    rnd = np.random.default_rng(1)
    x = features(["a b c a", "", None, "é ### x"], [None, 3, None, 10])
    assert len(x.edges) == 5 and (np.diff(x.edges) >= STATISTICS).all()
    m = Machine(0.3, rnd.normal(size=BUCKETS + STATISTICS), rnd.normal(size=(BUCKETS + STATISTICS, 4)))
    raw, _ = m.raw(x)
    for r in range(4):
        i, v = x.index[x.edges[r] : x.edges[r + 1]], x.value[x.edges[r] : x.edges[r + 1]]
        pairs = sum(m.factors[i[a]] @ m.factors[i[b]] * v[a] * v[b] for a in range(len(i)) for b in range(a))
        assert np.isclose(raw[r], 0.3 + m.linear[i] @ v + pairs)


def corpus(n=600):
    rnd = random.Random(2)
    words = [f"word{i}" for i in range(300)]
    docs, labels = [], []
    for i in range(n):
        good = rnd.random() < 0.7
        text = " ".join(rnd.choices(words, k=80)) if good else " ".join(rnd.choices(words[:3], k=40)) if i % 2 else " ".join(w.upper() + "!!" for w in rnd.choices(words, k=50))
        docs.append((i, text, len(text), None))
        labels.append((i, int(good), 0))
    return docs, labels


def test_held_out_accuracy(spark):
    docs, labels = corpus()
    out = quality_scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    truth = {i: q for i, q, _ in labels}
    held = [r for r in out if r.held_out]
    assert len(out) == 600 and 150 < len(held) < 250
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 3 == 1) for r in out)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in out)


def test_held_out_labels_are_not_learnt(spark):
    docs, labels = corpus(200)
    d = spark.createDataFrame(docs, DOCS)
    turned = [(i, 1 - q if zlib.crc32(str(i).encode()) % 3 == 1 else q, t) for i, q, t in labels]
    a, b = (sorted((r.doc_id, r.score) for r in quality_scores(d, spark.createDataFrame(x, LABELS)).collect()) for x in (labels, turned))
    assert a == b


def test_what_the_driver_gets_is_bounded(spark, monkeypatch):
    docs, labels = corpus(200)
    docs += [(0, "again " * 50, 300, None)] * 100  # a labelled id that repeats counts once
    d, lab = spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)
    seen = []
    whole = classifier.fit
    monkeypatch.setattr(classifier, "fit", lambda x, y: seen.append((len(y), len(x.index))) or whole(x, y))
    quality_scores(d, lab)
    ids = sum(zlib.crc32(str(i).encode()) % 3 != 1 for i in range(200))
    assert seen[-1][0] == ids
    quality_scores(d, lab, fit_features=1000)
    assert 0 < seen[-1][1] <= 1000 and 0 < seen[-1][0] < ids
    quality_scores(d, lab, fit_rows=10)
    assert seen[-1][0] == 10


def test_edge_rows(spark):
    docs = [(1, None, None, "x"), (None, "", 5, "x"), (3, "w " * 300_000, None, "x"), (3, "a b", 3, "x"), (4, "c d", 3, "y")]
    labels = [(3, 1, 0), (3, 0, 0), (4, None, 0), (None, 1, 0), (1, 0, 1)]
    out = quality_scores(spark.createDataFrame(docs, DOCS), spark.createDataFrame(labels, LABELS)).collect()
    assert len(out) == 5 and all(0 <= r.score <= 1 for r in out) and [r.held_out for r in out if r.doc_id is None] == [False]
    none = quality_scores(spark.createDataFrame(docs, DOCS).drop("n_chars"), spark.createDataFrame([], LABELS)).collect()
    assert {r.score for r in none} == {0.5}
    assert quality_scores(spark.createDataFrame([], DOCS), spark.createDataFrame(labels, LABELS)).count() == 0
    assert np.isfinite(fit(features(["a"], [None]), np.array([1.0])).bias)
