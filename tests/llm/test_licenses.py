"""License scans: the alignment against a recursive definition, scans against planted notices and a scan without cues."""

import random
import time

import pytest
from loopwise.llm.licenses import FOREIGN, TELLING, TEMPLATES, _prepared, _windows, align, scan_licenses, scan_text, words_of

SCHEMA = "doc_id long, text string, license string"


def increasing(pairs):
    best = []
    for k, p in enumerate(pairs):
        best.append(max((b for b in best[:k] if b[-1][1] < p[1]), key=len, default=[]) + [p])
    return max(map(len, best), default=0)


def check(a, b, pairs):
    """The pairs satisfy the definition: equal words, increasing, and no gap leaves an end or anchor unpaired."""
    assert all(a[i] == b[j] for i, j in pairs)
    assert all(p[0] < q[0] and p[1] < q[1] for p, q in zip(pairs, pairs[1:]))
    for (i0, j0), (i1, j1) in zip([(-1, -1), *pairs], [*pairs, (len(a), len(b))]):
        x, y = a[i0 + 1 : i1], b[j0 + 1 : j1]
        if x and y:
            assert x[0] != y[0] and x[-1] != y[-1]
            assert not any(x.count(w) == 1 and y.count(w) == 1 for w in x)


def test_alignment():
    rnd = random.Random(1)
    for _ in range(2000):
        a = [rnd.randrange(rnd.choice([2, 6, 20])) for _ in range(rnd.randrange(18))]
        b = [rnd.randrange(rnd.choice([2, 6, 20])) for _ in range(rnd.randrange(18))]
        check(a, b, align(a, b))


def test_longest_increasing_anchors():
    rnd = random.Random(2)
    for _ in range(300):
        n = rnd.randrange(1, 12)
        a, b = [-1, *range(n), -2], [-3, *rnd.sample(range(n), n), -4]
        assert len(align(a, b)) >= increasing([(i, b.index(i)) for i in range(n)])


def told(name, own, pairs, window):
    if set(FOREIGN.get(name, "").encode().split()) & set(window[pairs[0][0] : pairs[-1][0] + 1]):
        return False
    return set(TELLING.get(name, "").encode().split()) <= {own[j] for _, j in pairs}


def without_cues(text, least=0.8):
    """Every window of every template's length, without the cue words."""
    found = [w for w, _, _ in words_of(text)]
    out = set()
    for name, t in TEMPLATES.items():
        own = [w for w, _, _ in words_of(t)]
        slack = max(2, len(own) // 4)
        for at in range(-len(own), len(found)):
            window = found[max(0, at - slack) : max(0, at + len(own) + slack)]
            pairs = align(window, own)
            if len(pairs) >= least * len(own) - 1e-9 and told(name, own, pairs, window):
                out.add(name)
    return out


def test_planted_notices():
    rnd = random.Random(3)
    filler = ["lorem", "ipsum", "the", "of", "Überall", "under", "and", "7"]
    short = [k for k, v in TEMPLATES.items() if len(v.split()) < 40]
    for _ in range(60):
        name = rnd.choice(short)
        words = TEMPLATES[name].split()
        for _ in range(rnd.randrange(0, 3)):
            words[rnd.randrange(len(words))] = rnd.choice(filler)
        text = " ".join([*rnd.choices(filler, k=rnd.randrange(12)), *words, *rnd.choices(filler, k=rnd.randrange(12))])
        got = scan_text(text)
        assert bool(got) == bool(without_cues(text)), text
        assert {g[0] for g in got} <= without_cues(text)


def every_window(text, least=0.8):
    """The scan by definition: around every word that a template has, whether it is a cue or not; matches picked one by one."""
    found = words_of(text)
    words = [w for w, _, _ in found]
    matches = set()
    for name, t in TEMPLATES.items():
        own = [w for w, _, _ in words_of(t)]
        for i, w in enumerate(words):
            for k in (k for k, x in enumerate(own) if x == w):
                for lo, hi in _windows(i, k, len(own), len(words)):
                    pairs = align(words[lo:hi], own)
                    if pairs and len(pairs) >= least * len(own) - 1e-9 and 2 * len(pairs) >= pairs[-1][0] - pairs[0][0] + 1 and told(name, own, pairs, words[lo:hi]):
                        matches.add((len(pairs), lo + pairs[0][0], lo + pairs[-1][0], name))
    out = []
    for m in sorted(matches, key=lambda m: (-m[0], m[2] - m[1])):
        if all(m[2] < a or m[1] > b for _, a, b, _ in out):
            out.append(m)
    raw = text.encode()
    return {(name, len(raw[: found[a][1]].decode()), len(raw[: found[b][2]].decode())) for _, a, b, name in out}


@pytest.mark.parametrize("seed", range(4))
def test_whole_scan_against_every_window(seed):
    rnd = random.Random(seed)
    filler = ["lorem", "ipsum", "the", "of", "Überall", "under", "and", "7", "license", "é"]
    short = [k for k, v in TEMPLATES.items() if len(v.split()) < 40]
    for _ in range(12):
        parts = []
        for _ in range(rnd.randrange(1, 4)):
            words = TEMPLATES[rnd.choice(short)].split()
            for _ in range(rnd.randrange(0, 1 + len(words) // 8)):
                words[rnd.randrange(len(words))] = rnd.choice(filler)
            at = rnd.randrange(len(words) + 1)
            words[at:at] = rnd.choices(filler[:2], k=rnd.choice([0, 0, len(words) // 3]))
            parts += [*rnd.choices(filler, k=rnd.randrange(12)), *words]
        text = " ".join(parts)
        assert {m[:3] for m in scan_text(text)} == every_window(text), text


def test_words_put_in_between_up_to_the_rule():
    for name, t in TEMPLATES.items():
        words = t.split()
        n = len(words_of(t))
        for at in {1, len(words) // 2, len(words) - 1}:
            for extra in (1, n // 3, n // 2, n - 1, n):
                text = "before it " + " ".join([*words[:at], *(f"q{k}" for k in range(extra)), *words[at:]]) + " after it"
                got = scan_text(text)
                assert (name, 1.0) in {(m[0], m[3]) for m in got}, (name, at, extra)
        at = len(words) // 2
        far = " ".join([*words[:at], *(f"q{k}" for k in range(n + 1)), *words[at:]])
        assert (name, 1.0) not in {(m[0], m[3]) for m in scan_text(far)}


def test_long_hostile_texts():
    notice = TEMPLATES["MIT-notice"] + " "
    cues = [w.decode() for w in _prepared(tuple(TEMPLATES.items()), 0.8)[1]]
    for text in (notice * 30_000, "license " * 120_000, " ".join(random.Random(1).choices(cues, k=100_000)), "é " + notice * 30_000):
        began = time.perf_counter()
        scan_text(text)
        print(len(text), time.perf_counter() - began)
        assert time.perf_counter() - began < 30


def test_spans_and_repeats():
    mit = TEMPLATES["MIT-notice"]
    text = f"é {mit}\n{mit} x {TEMPLATES['MIT']}"
    got = scan_text(text)
    assert [g[0] for g in got] == ["MIT-notice", "MIT-notice", "MIT"]
    assert [text[a:b] for _, a, b, _ in got] == [mit[:-1], mit[:-1], TEMPLATES["MIT"][:-1]]
    assert all(c == 1 for *_, c in got)
    for name, t in TEMPLATES.items():
        assert name in {g[0] for g in scan_text(t)}
    assert all(len(w) for w, _, _ in _prepared(tuple(TEMPLATES.items()), 0.8)[0].values())


def test_near_kin_are_told_apart():
    assert set(TELLING) <= set(TEMPLATES)
    for name, words in TELLING.items():
        assert set(words.encode().split()) <= {w for w, _, _ in words_of(TEMPLATES[name])}, name
    grant = "This {} is free software{} you can redistribute it and/or modify it under the terms of the GNU {}General Public License as published by the Free Software Foundation{} either version {} of the License, or (at your option) any later version."
    for kind, name in (("", "GPL"), ("Lesser ", "LGPL"), ("Affero ", "AGPL")):
        for version in ("2", "2.1", "3"):
            for what, mark in (("program", ";"), ("library", ":"), ("file", ",")):
                got = [m[0] for m in scan_text("// " + grant.format(what, mark, kind, mark, version) + " more")]
                known = f"{name}-{version if '.' in version else version + '.0'}-header"
                assert got == ([known] if known in TEMPLATES else []), (kind, version, got)
    bsd = TEMPLATES["BSD-2-Clause"]
    third = " Neither the name of Example nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission."
    assert [m[0] for m in scan_text(bsd)] == ["BSD-2-Clause"] and [m[0] for m in scan_text(bsd + third)] == ["BSD-3-Clause"]
    for kind in ("BY", "BY-SA", "BY-NC", "BY-ND", "BY-NC-SA", "BY-NC-ND"):
        assert [m[0] for m in scan_text(f"x Licensed under CC {kind} 4.0. y")] == [f"CC-{kind}-4.0-notice"]
        assert scan_text(f"x Licensed under CC {kind} 3.0. y") == []
        long = {"SA": "ShareAlike", "NC": "NonCommercial", "ND": "NoDerivatives"}
        words = "-".join(["Attribution", *(long[k] for k in kind.split("-")[1:])])
        assert [m[0] for m in scan_text(f"This work is licensed under a Creative Commons {words} 4.0 International License.")] == [f"CC-{kind}-4.0"]


def test_edge_rows(spark):
    long = "word " * 40_000 + TEMPLATES["Apache-2.0-notice"]
    rows = [(1, None, "x"), (None, "", None), (3, long, "x"), (3, long, "x"), (4, "licensed license under", "x")]
    out = scan_licenses(spark.createDataFrame(rows, SCHEMA)).collect()
    assert sorted((r.doc_id or -1, r.n_matches, r.license or "") for r in out) == [(-1, 0, ""), (1, 0, ""), (3, 1, "Apache-2.0-notice"), (3, 1, "Apache-2.0-notice"), (4, 0, "")]
    assert scan_licenses(spark.createDataFrame([], SCHEMA)).count() == 0
