"""Quality rules against a quadratic search for repeats."""

import random

import numpy as np
import pytest
from loopwise.llm.quality import keep_quality, lcp_intervals, per_document, quality_rules, repeats, shared_windows, suffix_array

SCHEMA = "doc_id long, text string, kept string"


def brute(words, least=5):
    covered, longest = set(), 0
    for i in range(len(words)):
        for j in range(i + 1, len(words)):
            n = 0
            while j + n < len(words) and words[i + n] == words[j + n]:
                n += 1
            if n >= least:
                longest = max(longest, n)
                covered.update(range(i, i + n), range(j, j + n))
    return len(covered), longest


@pytest.mark.parametrize("seed", range(3))
def test_repeats(seed):
    rnd = random.Random(seed)
    for _ in range(60):
        docs = []
        for _ in range(rnd.randrange(1, 5)):
            d = [rnd.randrange(rnd.choice([1, 2, 3, 6])) for _ in range(rnd.randrange(70))]
            docs.append(d + d[: rnd.randrange(25)] * (rnd.random() < 0.5))
        got = repeats(np.array([w for d in docs for w in d], np.int64), np.array([len(d) for d in docs]), 5)
        assert [(c, n) for c, n in zip(got["covered"], got["longest"])] == [brute(d) for d in docs]
        assert got["maximal"].tolist() == [maximal(d, 5) for d in docs]
        flat, sizes = np.array([w for d in docs for w in d], np.int64), np.array([len(d) for d in docs])
        assert per_document(shared_windows(flat, sizes, 3), sizes).tolist() == [len({i + k for i in range(len(d) - 2) if sum(d[i : i + 3] == d[j : j + 3] for j in range(len(d) - 2)) > 1 for k in range(3)}) for d in docs]


def maximal(words, least):
    """How many different substrings of ``least`` words and more occur twice, and can be made longer neither to the left nor to the right in all places."""
    seen = {}
    for i in range(len(words)):
        for j in range(i + least, len(words) + 1):
            seen.setdefault(tuple(words[i:j]), []).append((words[i - 1] if i else None, words[j] if j < len(words) else -1))
    return sum(len(x) > 1 and len({a for a, _ in x}) > 1 and (len({b for _, b in x}) > 1 or any(b == -1 for _, b in x)) for x in seen.values())


def test_intervals():
    text = np.array([0, 1, 0, 1, 0, 2])  # ababac
    sa, lcp = suffix_array(text)
    found = {(tuple(text[sa[a] : sa[a] + n]), b - a + 1) for a, b, n in lcp_intervals(lcp, 1)}
    assert found == {((0,), 3), ((0, 1, 0), 2), ((1, 0), 2)}
    assert lcp_intervals(np.zeros(0, np.int64), 1).shape == (0, 3)


def test_limits_decide_in_long_texts(spark):
    rnd = random.Random(5)
    word = lambda k: " ".join(f"w{rnd.randrange(10**9)}" for _ in range(k))
    passage, short = word(900), [word(60) for _ in range(12)]
    texts = {
        1: word(4000) + " " + passage + " " + word(4200) + " " + passage,  # 18 % covered, one long repeat
        2: " ".join([word(8000), *short, word(300), *short[::-1]]),  # 14 % covered by repeats of 60
        3: " ".join([word(8000), *short[:3], word(300), *short[:3][::-1]]),  # 4 % covered
        4: " ".join([word(2000), *(x for s in [word(8) for _ in range(20)] for x in (s, word(3), s))]),  # repeats of 8 words are no business of the limits
    }
    out = {r.doc_id: r for r in quality_rules(spark.createDataFrame([(k, t, None) for k, t in texts.items()], SCHEMA)).collect()}
    assert not any(r.base_failed for r in out.values())
    assert {k: r.kept for k, r in out.items()} == {1: False, 2: False, 3: True, 4: True}
    assert out[1].longest_repeat == 900 and out[2].longest_repeat == 60 and out[2].n_maximal_repeats == 12 and out[4].covered_words == 0
    few = {r.doc_id: r for r in quality_rules(spark.createDataFrame([(k, t, None) for k, t in texts.items()], SCHEMA), least_repeat=5).collect()}
    assert {k: r.n_repeat_words for k, r in few.items()} == {k: r.n_repeat_words for k, r in out.items()}  # the base columns don't follow the parameter


def test_suffix_array():
    rnd = random.Random(8)
    for _ in range(100):
        x = [rnd.randrange(3) for _ in range(rnd.randrange(1, 40))]
        sa, lcp = suffix_array(np.array(x))
        assert sa.tolist() == sorted(range(len(x)), key=lambda i: x[i:])
        for k, n in enumerate(lcp):
            a, b = x[sa[k] :], x[sa[k + 1] :]
            assert a[:n] == b[:n] and a[n : n + 1] != b[n : n + 1]


def test_rows(spark):
    clean = " ".join(f"w{i}" for i in range(200))
    filler = " ".join(f"u{i}" for i in range(500))
    rows = [
        (1, clean, None),
        (2, "a b c " * 50, "x"),
        (3, None, "x"),
        (4, "", "x"),
        (5, "one\none\n\n \n\none two # $", "x"),
        (None, clean, "x"),
        (1, clean, None),
        (6, "a " * 110 + filler, "x"),
    ]
    docs = spark.createDataFrame(rows, SCHEMA)
    out = {}
    for r in quality_rules(docs).collect():
        out.setdefault(r.doc_id, []).append(r)
    assert [r.kept for r in out[1]] == [True, True] and [r.kept for r in out[None]] == [True]
    assert out[2][0].base_failed and out[2][0].n_repeat_words == 150 and out[2][0].longest_repeat == 147
    assert (out[3][0].n_words, out[3][0].kept, out[4][0].word_chars) == (0, False, 0)
    assert (out[5][0].n_words, out[5][0].n_symbols, out[5][0].n_dup_lines, out[5][0].word_chars) == (6, 2, 1, 14)
    assert not out[6][0].base_failed and not out[6][0].kept and out[6][0].longest_repeat == 109
    kept = keep_quality(docs)
    assert kept.columns == docs.columns and sorted(str(r.doc_id) for r in kept.collect()) == ["1", "1", "None"]
    assert quality_rules(spark.createDataFrame([], SCHEMA)).count() == 0


def test_very_long_text(spark):
    text = " ".join(f"w{i % 30_000}" for i in range(200_000))
    r = quality_rules(spark.createDataFrame([(1, text, "x")], SCHEMA)).first()
    assert (r.n_words, r.n_repeat_words, r.longest_repeat) == (200_000, 200_000, 170_000)
