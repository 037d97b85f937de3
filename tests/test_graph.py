"""Components, paths, convergence, sampled metrics and refreshed cycles on random graphs, against plain versions."""

import itertools
import random
import time
from collections import defaultdict

import pytest
from loopwise.operators import components, cycles, links, metrics, paths
from loopwise.plans import circular
from pyspark.sql import functions as F

from .test_operators import brandes, brute, collected, graph, parts, random_graph


def reach(pairs):
    after = defaultdict(set)
    for a, b in pairs:
        after[a].add(b)
    out = {}
    for s in {x for p in pairs for x in p}:
        seen, todo = set(), [s]
        while todo:
            for w in after[todo.pop()] - seen:
                seen.add(w)
                todo.append(w)
        out[s] = seen
    return out


@pytest.mark.parametrize("seed", [1, 2])
def test_strong_components(spark, seed):
    rnd = random.Random(seed)
    pairs = {(f"v{rnd.randrange(26)}", f"v{rnd.randrange(26)}") for _ in range(40)} | {(f"t{k}", f"t{k + 1}") for k in range(9)} | {("v0", "t0"), ("x1", "x2"), ("x2", "x1"), ("x2", "x3")}
    pairs = {(a, b) for a, b in pairs if a != b}
    to = reach(pairs)
    want = {}
    for v in to:
        own = {w for w in to[v] if v in to[w]} | {v}
        if len(own) > 1:
            want[v] = (min(own), len(own))
    t = graph(spark, [(a, b, 202101, 1, 0) for a, b in pairs])
    assert {r.mst: (r.component, r["size"]) for r in components.strong_components(t).collect()} == want and want
    kept = {(r.seller_mst, r.buyer_mst) for r in components.within_components(t).collect()}
    assert kept == {(a, b) for a, b in pairs if a in want and want.get(b, (0,))[0] == want[a][0]} and len(kept) < len(pairs)
    assert components.strong_components(graph(spark, [("a", "b", 202101, 1, 0)])).count() == 0


def test_exact_trim_keeps_all_cycles(spark):
    rows = random_graph(3) + [("c0", "tail1", 202101, 90, 9), ("tail1", "tail2", 202101, 90, 9), ("tail2", "tail3", 202101, 90, 9)]
    t = graph(spark, rows)
    got = collected(cycles.enumerate_cycles(t, 202011, 202104, max_hops=4, bound=25.0, exact_trim=True))
    assert len(got) == len(set(got)) and set(got) == brute(rows, 4, 25.0)


def test_return_filter_drops_paths_and_no_cycle(spark, monkeypatch):
    rows = random_graph(3) + [("a1", f"b{i}", 202101, 90, 9) for i in range(5)] + [(f"b{i}", f"d{k}", 202101, 90, 9) for i in range(5) for k in range(5)]
    rows += [(f"d{k}", "e1", 202101, 90, 9) for k in range(5)] + [("e1", "f1", 202101, 90, 9), ("f1", "f2", 202101, 90, 9), ("f2", "a1", 202101, 90, 9)]  # closes with six companies only
    t = graph(spark, rows)
    counts, write = {}, cycles.Budget.write

    def counted(self, df, name):
        out, n = write(self, df, name)
        counts[filtered].append(n)
        return out, n

    monkeypatch.setattr(cycles.Budget, "write", counted)
    for filtered in (False, True):
        counts[filtered] = []
        found, truncated = cycles.search_cycles(t, 202011, 202104, max_hops=5, bound=25.0, row_budget=10**6, return_filter=filtered)
        got = collected(found)
        assert len(got) == len(set(got)) and set(got) == brute(rows, 5, 25.0) and not truncated
    assert len(counts[True]) == len(counts[False]) and all(a <= b for a, b in zip(counts[True], counts[False], strict=True))
    assert sum(counts[True]) < sum(counts[False]) - 50
    empty, _ = cycles.search_cycles(t.where("false"), 202011, 202104, return_filter=True)
    assert empty.count() == 0


def test_shortest_paths(spark):
    rnd = random.Random(5)
    pairs = sorted({(f"v{rnd.randrange(16)}", f"v{rnd.randrange(16)}") for _ in range(34)} - {(f"v{k}", f"v{k}") for k in range(16)})
    after = defaultdict(set)
    for a, b in pairs:
        after[a].add(b)
    ask = [(f"v{rnd.randrange(16)}", f"v{rnd.randrange(16)}") for _ in range(60)] + [("v1", "nowhere")]
    want = {}
    for a, b in ask:
        if a == b:
            continue
        walks = [[a]]
        for hops in range(1, 6):
            walks = [[*w, x] for w in walks for x in after[w[-1]] if x not in w]
            hits = [w for w in walks if w[-1] == b]
            if hits:
                want[a, b] = (hops, len(hits), min(hits))
                break
    t = graph(spark, [(a, b, 202101, 1, 0) for a, b in pairs])
    for most in (4, 5):
        got = paths.shortest_paths(t, spark.createDataFrame(ask, "src string, dst string"), most).collect()
        assert {(r.src, r.dst): (r.hops, r.n_paths, r.path) for r in got} == {k: v for k, v in want.items() if v[0] <= most}
    assert max(v[0] for v in want.values()) >= 4


def test_convergence_and_repeats(spark):
    rnd = random.Random(6)
    pairs = {(f"v{rnd.randrange(40)}", f"v{rnd.randrange(40)}") for _ in range(90)}
    t = graph(spark, [(a, b, m, 1, 0) for a, b in pairs for m in (202101, 202102, 202103)[: 1 + int(a[1:]) % 3]])
    flagged = spark.createDataFrame([(f"v{k}",) for k in range(0, 40, 3)], "mst string")
    want = defaultdict(set)
    for s in (f"v{k}" for k in range(0, 40, 3)):
        level = {s}
        for _ in range(3):
            level = {b for a, b in pairs if a in level and a != b}
            for v in level - {s}:
                want[v].add(s)
    exact = {r.mst: r.n_sources for r in paths.hub_convergence(t, flagged, 3).collect()}
    assert exact == {v: len(s) for v, s in want.items()}
    sketched = {r.mst: r.n_sources for r in paths.hub_convergence(t, flagged, 3, exact=False).collect()}
    assert sketched.keys() == exact.keys() and all(abs(sketched[v] - exact[v]) <= 0.1 * exact[v] for v in exact)
    assert {(r.seller_mst, r.buyer_mst) for r in paths.repeated_pairs(t).collect()} == {(a, b) for a, b in pairs if a != b and int(a[1:]) % 3 == 2}


def test_sampled_betweenness(spark):
    rnd = random.Random(2)
    pairs = {(f"v{rnd.randrange(30)}", f"v{rnd.randrange(30)}") for _ in range(60)}
    pairs = {(a, b) for a, b in pairs if a != b}
    t, exact = graph(spark, [(a, b, 202101, 1, 0) for a, b in pairs]), brandes(pairs)
    whole = metrics.sampled_betweenness(t, 1000).collect()
    assert {r.mst: r.betweenness_centrality for r in whole} == pytest.approx(exact, abs=1e-5) and {r.error for r in whole} == {0.0}
    kept = 0
    for seed in range(4):
        some = metrics.sampled_betweenness(t, 12, seed).collect()
        kept += all(abs(r.betweenness_centrality - exact[r.mst]) <= r.error for r in some)
        assert {r.mst for r in some} == set(exact) and some[0].error > 0
    assert kept == 4
    assert "error" in metrics.company_metrics(t, most_exact=5).columns and "error" not in metrics.company_metrics(t).columns


def fitting(rows, most, hidden, risky):
    """Cycles that can be red, from the definition; hidden: groups."""
    out = set()
    for members, periods in brute(rows, most, 10.0):
        combo = [next(r for r in rows if r[:3] == (a, b, p)) for a, b, p in zip(members, (*members[1:], members[0]), periods)]
        balance, span, _ = parts([r[3] for r in combo], periods, [r[4] for r in combo])
        linked = any(len(set(members) & g) > 1 for g in hidden)
        if balance + span >= 50 - 25 * linked - 15 * bool(set(members) & risky):
            out.add((members, periods))
    return out


@pytest.mark.parametrize("seed", [11, 12])
def test_refreshed_cycles_equal_a_whole_search(spark, seed):
    rnd = random.Random(seed)
    rows = random_graph(seed, n=8, m=60)
    groups = [{"c0", "c1", "c4"}, {"c2", "c5"}, {"c7"}]
    risky = {"c2", "c3"}
    how = {
        "max_hops": 5,
        "bound": 10.0,
        "hidden": spark.createDataFrame([(m, f"g{k}") for k, g in enumerate(groups) for m in g], "mst string, grp string"),
        "risky": spark.createDataFrame([(m,) for m in risky], "mst string"),
    }
    stored, _ = cycles.search_cycles(graph(spark, rows), 202011, 202104, **how)
    before = collected(stored)
    assert len(before) == len(set(before)) and set(before) == fitting(rows, 5, groups, risky)
    new = [r for r in rows if r[2] != 202012] + [(a, b, 202012, rnd.choice([100, 90, 60]), 9) for a, b in {(f"c{rnd.randrange(8)}", f"c{rnd.randrange(8)}") for _ in range(14)}]
    after, truncated = cycles.refreshed(stored, graph(spark, new), 202011, 202104, [202012], **how)
    got = collected(after)
    assert not truncated and len(got) == len(set(got)) and set(got) == fitting(new, 5, groups, risky) != set(before)


def test_a_run_refreshes_the_last_one(spark, tmp_path):
    rows = random_graph(13, n=7, m=50)
    company = spark.createDataFrame([(f"c{k}", f"c{k}", "Đã giải thể" if k == 3 else None) for k in range(7)], "mst string, name string, status string")
    pairs = spark.createDataFrame([("c0", "c1", "x")], "company_a string, company_b string, norm_addr string")
    data = str(tmp_path / "d")
    settings = lambda **x: circular.Settings(max_hops=4, metrics=False, **x)
    tables = lambda r: {"company": company, "trades": graph(spark, r), "shares_address": pairs}
    circular.run(spark, tables(rows), f"{data}/run", settings())
    new = [r for r in rows if r[2] != 202101] + [("c0", "c1", 202101, 100, 10), ("c1", "c2", 202101, 95, 9), ("c2", "c0", 202101, 99, 9)]
    meta = circular.run(spark, tables(new), f"{data}/run", settings(months=[202101]))
    circular.run(spark, tables(new), f"{data}/whole", settings(exact_trim=True))
    read = lambda p: {(r.cycle_id, r.score, tuple(r.periods)) for r in spark.read.parquet(f"{data}/{p}/scored").collect()}
    assert read("run") == read("whole") and [s for s in meta["steps"] if s["step"] == "detect cycles"][0]["refreshed"]
    assert circular.last_found(spark, f"{data}/run", settings(bound=5.0)) is None and circular.last_found(spark, f"{data}/none", settings()) is None


def test_a_run_by_the_rule_of_paths(spark, tmp_path):
    rows = random_graph(6)
    company = spark.createDataFrame([(f"c{k}", f"c{k}", "Đã giải thể" if k == 2 else None) for k in range(7)], "mst string, name string, status string")
    pairs = spark.createDataFrame([("c0", "c1", "x")], "company_a string, company_b string, norm_addr string")
    tables = {"company": company, "trades": graph(spark, rows), "shares_address": pairs}
    every = cycles.enumerate_cycles(tables["trades"], 202011, 202104, max_hops=4, bound=10.0)
    want = cycles.within_path_bound(every, tables["trades"].where("seller_mst <> buyer_mst"), pairs, spark.createDataFrame([("c2",)], "mst string"), 4)
    scored, _ = circular.detect(tables, circular.Settings(max_hops=4, rule="path"))
    got = {tuple(r.members) for r in scored.collect()}
    assert got == {tuple(r.members) for r in want.collect()}
    assert got > {tuple(r.members) for r in circular.detect(tables, circular.Settings(max_hops=4))[0].collect()}


def test_a_time_budget_stops_a_running_level(spark):
    n = 60  # a complete graph: its paths of 3 edges are too many for some seconds
    t = graph(spark, [(f"c{a:02d}", f"c{b:02d}", m, 100, 10) for a, b in itertools.permutations(range(n), 2) for m in (202101, 202102)])
    t.count()
    began = time.monotonic()
    found, truncated = cycles.search_cycles(t, 202101, 202102, max_hops=7, bound=50.0, time_budget_s=12.0)
    assert truncated and time.monotonic() - began < 40
    assert set(r.hop_len for r in found.select("hop_len").distinct().collect()) <= {3, 4, 5}
    assert links.hidden_groups(owns=spark.createDataFrame([("a", "b")], "owner string, owned string")).where(F.col("mst") == "a").count() == 1
