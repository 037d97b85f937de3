"""Both substring operators against brute force on small corpora."""

import hashlib
import random

import numpy as np
import pytest
from loopwise.llm import windows
from loopwise.llm.substrings import byte_symbols, factors, matches, rlz_dedup, spans, suffix_dedup, word_symbols

SCHEMA = "doc_id long, text string, lang string"


def corpus(seed, n=60, letters="ab"):
    rnd = random.Random(seed)
    word = lambda: "".join(rnd.choice(letters) for _ in range(rnd.randrange(1, 3)))
    passages = [" ".join(word() for _ in range(rnd.randrange(3, 40))) for _ in range(6)]
    rows = [(0, None, "x"), (1, "", "x"), (2, " \t\n", "x")]
    for i in range(3, n):
        parts = []
        for _ in range(rnd.randrange(0, 5)):
            parts.append(rnd.choice(passages) if rnd.random() < 0.6 else " ".join(word() for _ in range(rnd.randrange(1, 30))))
        rows.append((i, rnd.choice([" ", "  ", "\n"]).join(parts) + rnd.choice(["", " é", " x"]), None))
    rows += [(n + k, rows[5 + k][1], "copy") for k in range(5)]
    rnd.shuffle(rows)
    return rows


def brute_words(rows, W):
    docs = {i: (t or "").encode().split() for i, t, _ in rows}
    first = {}
    for i in sorted(docs):
        for s in range(len(docs[i]) - W + 1):
            first.setdefault(tuple(docs[i][s : s + W]), i)
    out = {}
    for i, w in docs.items():
        gone = set()
        for s in range(len(w) - W + 1):
            if first[tuple(w[s : s + W])] < i:
                gone.update(range(s, s + W))
        out[i] = (len(w), len(gone), hashlib.sha256(b" ".join(x for k, x in enumerate(w) if k not in gone)).hexdigest())
    return out


def brute_bytes(rows, W):
    docs = {i: (t or "").encode() for i, t, _ in rows}
    first, out = {}, {}
    for i in sorted(docs):
        d, gone = docs[i], set()
        for s in range(len(d) - W + 1):
            if first.setdefault(d[s : s + W], (i, s)) != (i, s):
                gone.update(range(s, s + W))
        spans = sum(k - 1 not in gone for k in gone)
        out[i] = (len(d), len(gone), spans, hashlib.sha256(bytes(x for k, x in enumerate(d) if k not in gone)).hexdigest())
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, seed):
    rows = corpus(seed)
    got = {r[0]: tuple(r[1:4]) for r in rlz_dedup(spark.createDataFrame(rows, SCHEMA), window=10, anchor=4).collect()}
    want = brute_words(rows, 10)
    assert sum(x[1] for x in want.values()) > 200
    assert got == want


@pytest.mark.parametrize("seed", [1, 2])
def test_bytes_against_brute_force(spark, seed):
    rows = corpus(seed)
    got = {r[0]: tuple(r[1:5]) for r in suffix_dedup(spark.createDataFrame(rows, SCHEMA), window=24, anchor=8).collect()}
    want = brute_bytes(rows, 24)
    assert sum(x[2] for x in want.values()) > 20
    assert got == want


def test_windows_of_any_size(spark):
    rows = corpus(3)
    docs = spark.createDataFrame(rows, SCHEMA)
    for window in (1, 7, 20):  # shorter than the anchor as well
        assert {r[0]: tuple(r[1:4]) for r in rlz_dedup(docs, window=window).collect()} == brute_words(rows, window)
    assert {r[0]: tuple(r[1:5]) for r in suffix_dedup(docs, window=20).collect()} == brute_bytes(rows, 20)
    long_ = [(i, (t or "") * 12, x) for i, t, x in rows]
    docs = spark.createDataFrame(long_, SCHEMA)
    assert {r[0]: tuple(r[1:5]) for r in suffix_dedup(docs, window=400).collect()} == brute_bytes(long_, 400)
    with pytest.raises(ValueError):
        windows.Windows(W=20, K=12, symbols=word_symbols, strict=True)


def test_texts_longer_than_a_piece(spark, monkeypatch):
    rows = [(i, (t or "") * 30, x) for i, t, x in corpus(5, n=12)]
    spec = windows.Windows(W=24, K=8, symbols=byte_symbols, strict=False)
    symbols, lengths = byte_symbols([t for _, t, _ in rows])
    whole = windows.cells(spec, symbols, lengths)
    got = set()
    for d, offset, sy, le in windows._split_long(spec, symbols, lengths, limit=50):
        x = windows.cells(spec, sy, le)
        for doc, start, n, off in zip(x["doc"] + d, x["start"] + offset, x["n"], x["off"], strict=True):
            got |= {(int(doc), int(start) + k, int(start) + int(off)) for k in range(n)}
    want = {(int(doc), int(start) + k, int(start) + int(off)) for doc, start, n, off in zip(whole["doc"], whole["start"], whole["n"], whole["off"], strict=True) for k in range(n)}
    assert got == want  # the same windows, with the same anchors


def test_runs_are_parted_without_loss():
    spec = windows.Windows(W=100, K=32, symbols=byte_symbols, strict=False)
    assert spec.rounds() == [16, 4, 1]
    p = windows.pack(np.array([0, 5, 90]), np.array([69, 3, 1]), np.array([68, 40, 0]))
    for size in spec.rounds():
        each, q, j, core, length = windows.parted(spec, size, p)
        start, n, off = windows.unpack(q)
        assert [sorted(s + k for s, m, e in zip(start, n, each, strict=True) if e == i for k in range(m)) for i in range(3)] == [list(range(69)), [5, 6, 7], [90]]
        assert (core >= start + n - 1).all() and (core + length <= start + 100).all()  # shared by all windows of the run
        assert (off // size == j).all() and ((off - n + 1) // size == j).all()


def test_factors_and_spans():
    # two matches that overlap: 0-60 in reference 1, 40-90 in reference 2
    runs = np.array([[windows.pack(0, 11, 0), windows.pack(40, 1, 0)], [1, 2], [100, 7]])
    known = matches(runs, 50)
    assert known.T.tolist() == [[0, 60, 1, 100], [40, 90, 2, 7]]
    parse = factors(known)
    assert parse == [(0, 60, 1, 100), (60, 90, 2, 27)]
    assert spans(parse, known, 50) == [(0, 90)]
    assert spans([(60, 90, 2, 27)], known, 50) == [(40, 90)]  # followed back over the boundary
    assert factors(matches(np.zeros((3, 0), np.int64), 50)) == []


def test_production_parameters(spark):
    rnd = random.Random(9)
    word = lambda: "".join(rnd.choice("abcdefgh") for _ in range(5))
    passage = " ".join(word() for _ in range(60))
    rows = [(i, " ".join([*(word() for _ in range(30)), passage, *(word() for _ in range(rnd.randrange(90)))]), None) for i in range(12)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r[0]: tuple(r[1:4]) for r in rlz_dedup(docs).collect()} == brute_words(rows, 50)
    assert {r[0]: tuple(r[1:5]) for r in suffix_dedup(docs).collect()} == brute_bytes(rows, 100)


def test_empty_null_and_repeated_ids(spark):
    assert rlz_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    assert suffix_dedup(spark.createDataFrame([], SCHEMA)).count() == 0
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(None, text, "a"), (7, text, "b"), (7, text, "c"), (7, "other", "d"), (None, None, "e")]
    out = rlz_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.n_words, r.n_removed) for r in out) == [(-1, 0, 0), (-1, 60, 0), (7, 1, 0), (7, 60, 60), (7, 60, 60)]
    n = len(text)
    out = suffix_dedup(spark.createDataFrame(rows, SCHEMA)).collect()
    digest = lambda b: hashlib.sha256(b).hexdigest()
    assert sorted((r.doc_id or -1, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in out) == sorted(
        [(-1, 0, 0, 0, digest(b"")), (-1, n, 0, 0, digest(text.encode())), (7, 5, 0, 0, digest(b"other"))] + 2 * [(7, n, n, 1, digest(b""))]
    )


def test_whole_repeated_rows_keep_one_text(spark):
    """Rows alike in id and text are one document: none of them is removed by another."""
    text = " ".join(f"w{i}" for i in range(60))
    other = text + " and more " + text[:200]
    for rows in ([(1, text, None)] * 2, [(None, text, None)] * 2, [(1, other, None)] * 3):
        docs = spark.createDataFrame(rows, SCHEMA)
        plain = [(0, rows[0][1], None)]
        assert sorted(tuple(r[1:5]) for r in suffix_dedup(docs).collect()) == sorted([brute_bytes(plain, 100)[0]] * len(rows))
        assert sorted(tuple(r[1:4]) for r in rlz_dedup(docs).collect()) == sorted([brute_words(plain, 50)[0]] * len(rows))
    rows = [(None, text, None), (None, text, None), (3, text, None)]
    got = sorted((r.doc_id is None, r.n_removed) for r in suffix_dedup(spark.createDataFrame(rows, SCHEMA)).collect())
    assert got == [(False, len(text)), (True, 0), (True, 0)]
    rows = corpus(4) + [(i, t, "again") for i, t, _ in corpus(4)[:9]]
    got = sorted(tuple(r[:5]) for r in suffix_dedup(spark.createDataFrame(rows, SCHEMA), window=24, anchor=8).collect())
    want = brute_bytes(corpus(4), 24)
    assert got == sorted((i, *want[i]) for i, _, _ in rows)


def test_kept_text(spark):
    text = " ".join(f"w{i}" for i in range(60))
    rows = [(1, text, None), (2, f"a {text} b", None)]
    docs = spark.createDataFrame(rows, SCHEMA)
    assert {r.doc_id: r.kept for r in rlz_dedup(docs, with_text=True).collect()} == {1: text, 2: "a b"}
    assert {r.doc_id: bytes(r.kept) for r in suffix_dedup(docs, with_text=True).collect()}[2] == b"a  b"


def test_symbols():
    assert byte_symbols([None, "aé"])[1].tolist() == [0, 3]
    assert word_symbols([None, " a b c "])[1].tolist() == [0, 2]
