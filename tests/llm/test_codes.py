"""Product codes against a plain version of the same rounds."""

import hashlib
from collections import Counter

import numpy as np
import pytest
from loopwise.llm.codes import nearest_entries, vector_codes

SCHEMA = "vec_id long, embedding array<float>, label string, code string"


def brute(rows, rounds=4, entries=256):
    """rows (vec_id, vector, label) of one length; Python integers throughout."""
    rows = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    x = [[int(np.floor(1024 * float(c))) for c in r[1]] + [0] * (-len(r[1]) % 4) for r in rows]
    w = len(x[0]) // 4
    parts = [[v[p * w : (p + 1) * w] for v in x] for p in range(4)]
    books = [part[:entries] for part in parts]

    def near(v, book):
        d = [sum((a - b) ** 2 for a, b in zip(v, e)) for e in book]
        return d.index(min(d)), min(d)

    for _ in range(rounds):
        for p in range(4):
            groups = {}
            for v in parts[p]:
                groups.setdefault(near(v, books[p])[0], []).append(v)
            books[p] = [[sum(c) // len(groups[k]) for c in zip(*groups[k])] if k in groups else e for k, e in enumerate(books[p])]
    last = [[near(v, books[p]) for v in parts[p]] for p in range(4)]
    sha = hashlib.sha256(",".join(str(c) for b in books for e in b for c in e).encode()).hexdigest()
    out = [(r[0], "".join(f"{last[p][i][0]:02x}" for p in range(4)), sum(last[p][i][1] for p in range(4)), r[2]) for i, r in enumerate(rows)]
    totals = Counter()
    for r in out:
        totals[r[3]] += r[2]
    return Counter((i, code, e, totals[label], sha) for i, code, e, label in out)


def got(df):
    assert df.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    return Counter(tuple(r) for r in df.collect())


@pytest.mark.parametrize("length", [8, 6])
def test_rounds_ties_and_odd_rows(spark, length):
    rnd = np.random.default_rng(length)
    rows = [(i, rnd.normal(size=length).astype(np.float32).tolist(), None if i % 5 == 0 else f"l{i % 3}") for i in range(700)]
    rows += [(i, [0.25] * length, "tie") for i in range(40)] + [rows[3]] * 4 + [(None, [1.0] * length, None)] * 2
    odd = [(1, None, "n"), (2, [None] * length, "n"), (3, [float("nan")] * length, "n"), (4, [float("inf")] + [0.0] * (length - 1), "n"), (5, [1.0], "short"), (6, [], "n")]
    df = spark.createDataFrame([(*r, "clash") for r in rows + odd], SCHEMA).repartition(7)
    assert got(vector_codes(df)) == brute(rows)


def test_few_and_no_rows(spark):
    rows = [(5, [0.5, -0.5, 0.1, 0.9], "a"), (2, [0.5, -0.5, 0.2, 0.9], None)]
    assert got(vector_codes(spark.createDataFrame([(*r, "") for r in rows], SCHEMA))) == brute(rows)
    none = vector_codes(spark.createDataFrame([], SCHEMA))
    assert none.count() == 0 and none.columns == ["vec_id", "code", "error", "label_error", "codebooks_sha256"]
    assert vector_codes(spark.createDataFrame([(1, None, "a", "")], SCHEMA)).count() == 0


def test_a_frequent_label_is_summed_whole(spark):
    rows = [(i, [float(i % 7), 0.0, float(i % 3), 1.0], "hot" if i % 3 else f"rare {i}") for i in range(3000)]
    want, found = Counter(), {}
    for r in vector_codes(spark.createDataFrame([(*r, "") for r in rows], SCHEMA)).collect():
        label = rows[r["vec_id"]][2]
        want[label] += r["error"]
        assert found.setdefault(label, r["label_error"]) == r["label_error"]
    assert found == dict(want)


def test_wide_components_are_exact_or_refused():
    rnd = np.random.default_rng(3)
    x, book = rnd.integers(-(2**29), 2**29, (4, 300)), rnd.integers(-(2**29), 2**29, (4, 9))
    index, error = nearest_entries(x, book)
    want = ((x[:, :, None].astype(object) - book[:, None].astype(object)) ** 2).sum(axis=0)
    assert index.tolist() == want.argmin(axis=1).tolist() and error.tolist() == want.min(axis=1).tolist()
    with pytest.raises(OverflowError):
        nearest_entries(x * 16, book)
