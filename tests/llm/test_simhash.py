"""SimHash components against all pairs."""

import random

import numpy as np
import pytest
from pyspark.sql import functions as F
import xxhash
from loopwise.llm import simhash
from loopwise.llm.simhash import _bring_forward, _undo, components, fingerprints, link_edges, near_dedup, simhash_components, trie_links

SCHEMA = "doc_id long, text string, fingerprint string"


def print_of(text):
    low = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text or "")
    words = [w for w in "".join(" " if c in " \t\n\x0b\x0c\r" else c for c in low).split(" ") if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def brute(prints, ids):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= 3:
                root[find(i)] = find(j)
    group = {}
    for i, d in enumerate(ids):
        group.setdefault(find(i), []).append(d)
    least = {k: min((d for d in v if d is not None), default=None) for k, v in group.items()}
    return [least[find(i)] for i in range(len(prints))]


def test_fingerprints():
    texts = [None, "", "a", "A b", "a b c", "a b c d É é", " x\ty\x0bz q W e ", "a\xa0b c\x1cd e f g", *(" ".join(random.Random(k).choices("ab", k=k)) for k in range(20))]
    assert fingerprints(texts).tolist() == [print_of(t) for t in texts]


def near(rnd, base):
    return rnd.choice(base) ^ sum(1 << b for b in rnd.sample(range(64), rnd.randrange(5)))


@pytest.mark.parametrize("seed", range(4))
def test_trie_links(seed):
    rnd = random.Random(seed)
    base = [rnd.getrandbits(64) for _ in range(5)]
    fp = sorted({near(rnd, base) for _ in range(300)})
    pairs = set()
    for i, j in trie_links(np.zeros(len(fp), np.int64), np.array(fp, np.uint64), 3, slice_pairs=40):
        pairs |= {tuple(sorted(p)) for p in zip(i.tolist(), j.tolist())}
    assert pairs == {(i, j) for j in range(len(fp)) for i in range(j) if (fp[i] ^ fp[j]).bit_count() <= 3}


def test_blocks_come_back():
    fp = np.array([random.Random(k).getrandbits(64) for k in range(50)], np.uint64)
    for a in range(4):
        for b in range(4):
            for c in range(4):
                x = _bring_forward(_bring_forward(_bring_forward(fp, 0, a, 16), 16, b, 12), 28, c, 9)
                assert (_undo(x, np.full(50, 16 * a + 4 * b + c), 2) == fp).all()


@pytest.mark.parametrize("most", [8192, 4])
def test_components_over_levels(spark, most):
    rnd = random.Random(11)
    base = [rnd.getrandbits(64) for _ in range(6)]
    fp = sorted({near(rnd, base) for _ in range(150)})
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in fp]
    roots = {r.node: r.root for r in components(link_edges(spark.createDataFrame(signed, "fp long"), most=most)).collect()}
    want = brute(fp, [s for (s,) in signed])
    assert [roots.get(s, s) for (s,) in signed] == want


@pytest.mark.parametrize("places", [(0, 20, 54), (1, 21, 54), (37, 44, 51)])
def test_links_of_the_last_level(spark, places):
    """Every trie is dealt down to the last 27 bits; blocks that overlap there lose the first two."""
    fp = random.Random(4).getrandbits(63)
    pair = sorted((fp, fp ^ sum(1 << (63 - b) for b in places)))
    signed = [(x - (1 << 64) if x >> 63 else x,) for x in pair]
    got = {tuple(sorted((r.a, r.b))) for r in link_edges(spark.createDataFrame(signed, "fp long"), most=1).collect()}
    assert got == {tuple(sorted(x for (x,) in signed))}


def test_documents(spark):
    rnd = random.Random(3)
    base = [" ".join(rnd.choices([f"w{i}" for i in range(400)], k=120)) for _ in range(8)]
    rows = []
    for i in range(80):
        words = rnd.choice(base).split()
        words[rnd.randrange(len(words))] = rnd.choice(["x", "y", words[0]])
        rows.append((i, " ".join(words), None))
    rows += [(90, None, "a"), (91, "", "b"), (92, " \n", "c"), (None, rows[0][1], "d"), (7, rows[7][1], "e"), (None, "lone text without any peer", "f")]
    rnd.shuffle(rows)
    got = sorted((str(r.doc_id), r.fingerprint, r.component_id or -1) for r in simhash_components(spark.createDataFrame(rows, SCHEMA)).collect())
    prints = [print_of(t) for _, t, _ in rows]
    want = brute(prints, [d for d, _, _ in rows])
    assert got == sorted((str(d), f"{p:016x}", w or -1) for (d, _, _), p, w in zip(rows, prints, want))
    kept = near_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    roots = brute(prints, list(range(len(rows))))
    assert len(kept) == len(set(roots))
    unique = [(k, t, None) for k, (_, t, _) in enumerate(rows)]
    assert sorted(r.doc_id for r in near_dedup(spark.createDataFrame(unique, SCHEMA)).collect()) == sorted(set(roots))


def test_hot_fingerprints_are_spread(spark):
    prints = spark.createDataFrame([(i, i % 7 and i) for i in range(60)] + [(None, 0)], "doc_id long, fp long")
    of = prints.groupBy("fp").agg(F.count("*").alias("n")).withColumn("component_id", F.col("fp") * 10)
    want = sorted((r.doc_id or -1, r.fp * 10) for r in prints.collect())
    for most in (1, 5, 100):
        rows = simhash._with_labels(prints, of, most=most).collect()
        assert sorted((r.doc_id or -1, r.component_id) for r in rows) == want
    rows = simhash._with_labels(prints, of, most=1, hot_rows=2)  # never more than hot_rows labels
    assert sorted((r.doc_id or -1, r.component_id) for r in rows.collect()) == want


def test_empty(spark):
    assert simhash_components(spark.createDataFrame([], SCHEMA)).count() == 0
    assert near_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    assert simhash.LEVELS == (16, 12, 9, 7)
