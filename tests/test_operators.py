"""Operators on small hand-made inputs, and against brute force."""

import itertools
import json
import random
from collections import defaultdict

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from loopwise.functions import text as X
from loopwise.operators import contract, cycles, edges, flags, links, metrics, report, score
from loopwise.plans import circular
from loopwise.sources import raw
from loopwise.streaming.monthly import merge_batch
from pyspark.sql import functions as F

TRADES = "seller_mst string, buyer_mst string, period int, invoice_count bigint, total_amount double, total_vat double, first_date string, last_date string"


def graph(spark, rows):
    return spark.createDataFrame([(a, b, p, 1, float(m), float(v), f"{p // 100}-{p % 100:02d}-01", f"{p // 100}-{p % 100:02d}-28") for a, b, p, m, v in rows], TRADES)


def month(p):
    return p // 100 * 12 + p % 100


def parts(amounts, periods, vats):
    top = max(amounts)
    ratio = min(amounts) / top if top else 0.0
    balance = 30.0 if ratio >= 0.8 else max(0.0, 30 * (ratio - 0.3) / 0.5)
    span = max(map(month, periods)) - min(map(month, periods))
    time = 20.0 if span <= 1 else max(0.0, 20.0 - 5 * span)
    rates = sorted(v / a for a, v in zip(amounts, vats) if a)
    vat = 10.0 if rates and max(abs(r - rates[len(rates) // 2]) for r in rates) > 0.03 else 0.0
    return balance, time, vat


def brute(rows, max_hops, bound):
    by = defaultdict(list)
    for a, b, p, m, v in rows:
        if a != b:
            by[a, b].append((p, m, v))
    nodes = sorted({x for pair in by for x in pair})
    out = set()
    for k in range(3, max_hops + 1):
        for members in itertools.permutations(nodes, k):
            if members[0] != min(members):
                continue
            hops = [by.get((a, b), []) for a, b in zip(members, (*members[1:], members[0]))]
            for combo in itertools.product(*hops):
                balance, time, _ = parts([c[1] for c in combo], [c[0] for c in combo], [c[2] for c in combo])
                if balance + time >= bound:
                    out.add((members, tuple(c[0] for c in combo)))
    return out


def random_graph(seed, n=7, m=40):
    rnd = random.Random(seed)
    seen = {(f"c{rnd.randrange(n)}", f"c{rnd.randrange(n)}", rnd.choice([202011, 202012, 202101, 202104])) for _ in range(m)}
    return [(a, b, p, rnd.choice([100, 90, 60, 30, 0]), rnd.choice([10, 5, 9])) for a, b, p in sorted(seen)]


def collected(df):
    return [(tuple(r.members), tuple(e["period"] for e in r.edges)) for r in df.collect()]


@pytest.mark.parametrize("seed,bound", [(1, 50.0), (2, 25.0), (3, float("-inf"))])
def test_cycles_against_brute_force(spark, seed, bound):
    rows = random_graph(seed)
    got = collected(cycles.enumerate_cycles(graph(spark, rows), 202011, 202104, max_hops=4, bound=bound))
    assert len(got) == len(set(got)) and set(got) == brute(rows, 4, bound)


def test_fixed_hops_agree_with_paths(spark):
    t = graph(spark, random_graph(4))
    paths = cycles.best_combinations(cycles.enumerate_cycles(t, 202011, 202104, max_hops=3, bound=float("-inf")))
    fixed = cycles.best_combinations(cycles.fixed_hop_cycles(t, 202011, 202104, 3))
    assert sorted(collected(paths)) == sorted(collected(fixed))
    assert cycles.fixed_hop_cycles(t, 202011, 202104, 3, most_seeds=2, per_seed=1).count() <= 2


def test_budget_is_told(spark):
    t = graph(spark, random_graph(1))
    out = cycles.enumerate_cycles(t, 202011, 202104, max_hops=4, bound=float("-inf"), row_budget=3)
    assert {r.truncated for r in out.select("truncated").distinct().collect()} <= {True}
    assert cycles.search_cycles(t, 202011, 202104, max_hops=4, bound=float("-inf"), row_budget=3)[1]
    few, cut = cycles.search_cycles(t, 202011, 202104, max_hops=5, bound=float("-inf"), time_budget_s=-1.0)
    assert cut and few.count() == 0
    assert not cycles.search_cycles(t, 202011, 202104, max_hops=4, bound=float("-inf"), row_budget=10**6, time_budget_s=600)[1]


def test_signals_lower_the_bound(spark):
    rows = random_graph(7, n=8, m=60)
    t = graph(spark, rows)
    hidden = spark.createDataFrame([("c0", "c1"), ("c2", "c5")], "company_a string, company_b string")
    risky = spark.createDataFrame([("c2",), ("c3",)], "mst string")
    found = cycles.enumerate_cycles(t, 202011, 202104, max_hops=5, bound=10.0, hidden=hidden, risky=risky)
    got = set(collected(cycles.within_member_bound(found, hidden, risky)))
    want = set()
    for members, periods in brute(rows, 5, 10.0):
        combo = [next(r for r in rows if r[:3] == (a, b, p)) for a, b, p in zip(members, (*members[1:], members[0]), periods)]
        balance, time, _ = parts([r[3] for r in combo], periods, [r[4] for r in combo])
        if balance + time >= 50 - 25 * any({a, b} <= set(members) for a, b in (("c0", "c1"), ("c2", "c5"))) - 15 * bool({"c2", "c3"} & set(members)):
            want.add((members, periods))
    assert got == want and len(want) > 5


def test_path_bound_keeps_red_cycles(spark):
    rows = random_graph(6)
    t = graph(spark, rows)
    hidden = spark.createDataFrame([("c0", "c1")], "company_a string, company_b string")
    risky = spark.createDataFrame([("c2",)], "mst string")
    every = cycles.enumerate_cycles(t, 202011, 202104, max_hops=4, bound=float("-inf"))
    kept = set(collected(cycles.within_path_bound(every, t, hidden, risky, 4)))
    for members, periods in collected(every):
        combo = [next(r for r in rows if r[:3] == (a, b, p)) for a, b, p in zip(members, (*members[1:], members[0]), periods)]
        balance, time, _ = parts([r[3] for r in combo], periods, [r[4] for r in combo])
        need = 50 - 25 * ({"c0", "c1"} <= set(members)) - 15 * ("c2" in members)
        assert balance + time < need or (members, periods) in kept


@settings(max_examples=15, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.integers(-5, 200), st.sampled_from([202011, 202012, 202101, 202103, 202110]), st.integers(0, 40)), min_size=3, max_size=5))
def test_score_parts(spark, edges_):
    row = [("x", [(str(i), str(i + 1), p, float(a), float(v)) for i, (a, p, v) in enumerate(edges_)])]
    df = spark.createDataFrame(row, "id string, edges array<struct<src string, dst string, period int, amount double, vat double>>")
    got = df.select(*score.components_of(F.col("edges")).values()).first()
    assert tuple(got) == pytest.approx(parts([e[0] for e in edges_], [e[1] for e in edges_], [e[2] for e in edges_]))


def test_rotation_keeps_direction(spark):
    df = spark.createDataFrame([(["b", "c", "a"], [("b", "c", 1, 1.0, 0.0), ("c", "a", 2, 1.0, 0.0), ("a", "b", 3, 1.0, 0.0)])], "members array<string>, edges array<struct<src string, dst string, period int, amount double, vat double>>")
    r = cycles.canonical(df).first()
    assert r.members == ["a", "b", "c"] and [e["period"] for e in r.edges] == [3, 1, 2]


def test_bounds():
    assert [score.prune_bound(h, r) for h in (False, True) for r in (False, True)] == [50, 35, 25, 10]
    assert score.prune_bound(True, True, no_prune=True) == float("-inf")


def test_text_functions(spark):
    one = lambda f, *v: [r[0] for r in spark.createDataFrame([(i, x) for i, x in enumerate(v)], "i int, x string").orderBy("i").select(f(F.col("x"))).collect()]
    assert one(X.normalize_address, "P. Vĩnh Tuy,  Q.Hai Bà Trưng", "Số 5 Đường X", None, "TP HCM", "é") == ["phuong vinh tuy quan hai ba trung", "so 5 duong x", None, "thanh pho hcm", "e"]
    assert one(X.phone_candidates, "0971359012/09828849", "024-3825-1234", "0912 345 678-01234567890") == [["0971359012"], [], ["0912345678", "01234567890"]]
    assert one(X.normalize_mst, "MST 123", "0123456789-001", None, "abc") == ["0000000123", "0123456789001", "", ""]
    assert one(X.normalize_money, "3.99", "-3.99", "x", None) == [3, -3, 0, 0]
    assert one(X.normalize_date, "44197", "2021-03-15 10:00", "5/3/2021", "soon") == ["2021-01-01", "2021-03-15", "2021-03-05", "soon"]
    assert one(X.to_period, "2021-03-15", " 2021-12-01 ") == [202103, 202112]
    with pytest.raises(Exception, match="not a yyyy-mm-dd"):
        one(X.to_period, "2021-13-01")
    assert spark.range(1).select(X.cutoff_date(202301, 12)).first()[0] == "2022-01-01"
    assert [r[0] for r in spark.createDataFrame([(999.0,), (2.5e6,), (1.2345e12,)], "x double").select(X.format_money(F.col("x"))).collect()] == ["999", "2 tr", "1.234,5 ty"]
    assert report.money(1.2345e12) == "1.234,5 ty" and report.money(2.6e6) == "3 tr" and report.money(999) == "999"


def test_links(spark):
    companies = spark.createDataFrame([("1", "Số 1, P. A"), ("2", "so 1 phuong a"), ("3", "so 1 p A"), ("4", ""), ("5", None)], "mst string, address string")
    assert sorted(tuple(r[:2]) for r in links.address_pairs(companies).collect()) == [("1", "2"), ("1", "3"), ("2", "3")]
    with pytest.raises(links.TooManyPairs, match="so 1 phuong a"):
        links.address_pairs(companies, most=2)
    reps = spark.createDataFrame([("p", str(i)) for i in range(4)], "person_id string, mst string")
    assert links.representative_pairs(reps).count() == 6
    with pytest.raises(links.TooManyPairs, match="'p'"):
        links.representative_pairs(reps, most=5)
    phones = spark.createDataFrame([(str(i), "0900000001") for i in range(6)] + [("1", "0900000003"), ("2", "0900000003"), ("1", "0900000002"), ("2", "0900000002")], "mst string, phone string")
    assert [tuple(r) for r in links.phone_pairs(phones).collect()] == [("1", "2", "0900000002")]
    owns = spark.createDataFrame([("9", "1"), ("1", "9"), ("3", "3")], "owner string, owned string")
    assert [tuple(r) for r in links.hidden_pairs(owns=owns).collect()] == [("1", "9")] and links.hidden_pairs() is None
    risk = spark.createDataFrame([("1", None, None), ("2", "2022-05-01", None), ("3", None, "Đã giải thể"), ("4", "2000-01-01", "ok")], "mst string, established_date string, status string")
    assert sorted(r.mst for r in links.risky_companies(risk, 202301).collect()) == ["2", "3"]
    assert [r.mst for r in links.risky_companies(risk.drop("established_date"), 202301).collect()] == ["3"]


def brandes(pairs):
    adj = defaultdict(set)
    for a, b in pairs:
        adj[a].add(b)
        adj[b].add(a)
    total = dict.fromkeys(adj, 0.0)
    for s in adj:
        dist, sigma, order, before = {s: 0}, defaultdict(float, {s: 1.0}), [s], defaultdict(list)
        for v in order:
            for w in adj[v]:
                if w not in dist:
                    dist[w] = dist[v] + 1
                    order.append(w)
                if dist[w] == dist[v] + 1:
                    sigma[w] += sigma[v]
                    before[w].append(v)
        delta = defaultdict(float)
        for w in reversed(order):
            for v in before[w]:
                delta[v] += sigma[v] / sigma[w] * (1 + delta[w])
            if w != s:
                total[w] += delta[w]
    return {v: c / 2 for v, c in total.items()}


def test_betweenness(spark):
    rnd = random.Random(2)
    pairs = {(f"v{rnd.randrange(14)}", f"v{rnd.randrange(14)}") for _ in range(22)} | {("w1", "w2")}
    pairs = {(a, b) for a, b in pairs if a != b}
    for batch in (4096, 6):
        got = {r.mst: r.betweenness_centrality for r in metrics.betweenness(graph(spark, [(a, b, 202101, 1, 0) for a, b in pairs]), batch=batch).collect()}
        assert got == pytest.approx(brandes(pairs), abs=1e-5)


def test_csv_to_report(spark, tmp_path):
    (tmp_path / "c.csv").write_text("﻿A,Công ty A,x,\"1, Phố X\",5,2021\nB,B,x,1 pho X,,2021,Đã giải thể,\nC,C,x,9 z,7,2021\n,no key,,,,\n", encoding="utf-8")
    (tmp_path / "i.csv").write_text("".join(f"{k},2021-0{m}-15,{a},{b},goods,100.9,10.1,more\n" for k, (a, b, m) in enumerate([("A", "B", 1), ("B", "C", 1), ("C", "A", 2), ("A", "A", 1), ("A", "B", 1)])))
    tables = circular.ingest(spark, str(tmp_path / "c.csv"), str(tmp_path / "i.csv"))
    circular.save(tables, str(tmp_path / "data"))
    tables = raw.read_tables(spark, raw.dataset_dir(str(tmp_path), "data"))
    assert {(r.seller_mst, r.buyer_mst, r.total_amount, r.invoice_count) for r in tables["trades"].collect()} == {("A", "B", 200.0, 2), ("B", "C", 100.0, 1), ("C", "A", 100.0, 1)}
    invoices = spark.createDataFrame([(1, "A", "B", 202101), (2, "A", "A", 202101)], "einvoice_row_id int, seller_mst string, buyer_mst string, period int")
    meta = circular.run(spark, tables, str(tmp_path / "out"), invoices=invoices)
    row = json.loads(spark.read.text(str(tmp_path / "out/graph_risk_flags")).first()[0])
    assert row["members"] == ["A", "B", "C"] and row["score_hidden_link"] == 25 and row["score_risky_member"] == 15 and row["score_balance"] == pytest.approx(12) and row["score"] == 72
    assert meta["summary"]["red"] == 1 and meta["contract"]["can_run"] and meta["period_from"] == 202101
    assert spark.read.json(str(tmp_path / "out/invoice_flags")).collect()[0]["cycle_ids"] == ["A|B|C"]
    text = "\n".join(r[0] for r in spark.read.text(str(tmp_path / "out/report.md"), wholetext=True).collect())
    assert "| A | Công ty A | 202101 | 200 |" in text and "### 1: 72 points" in text
    assert [x["step"] for x in meta["steps"]][:5] == ["check", "detect cycles", "write cycles", "company metrics", "flag invoices"]
    assert spark.sql(flags.drill_down_sql(["A", "B"], [1, 2]).replace("trades", "(SELECT 'A' seller_mst, 'B' buyer_mst, 1 period)")).count() == 1
    with pytest.raises(ValueError):
        raw.dataset_dir(str(tmp_path), "../x")


def test_short_rows_are_errors(spark, tmp_path):
    (tmp_path / "c.csv").write_text("A,B,C\n")
    with pytest.raises(Exception, match="fewer than 6"):
        raw.read_companies(spark, str(tmp_path / "c.csv")).collect()


def test_contract(spark):
    t = {"company": spark.createDataFrame([("1", None)], "mst string, status string"), "trades": graph(spark, [("a", "b", 202101, 1, 0)])}
    checks = {c.id: c.status for c in contract.validate(t)}
    assert checks["company.status"] == "empty" and checks["owns"] == "missing" and checks["trades"] == "pass"
    assert contract.ceiling(contract.validate(t)) == (60, ["hidden_link", "risky_member"]) and "60 of 100" in contract.headline(contract.validate(t))
    with pytest.raises(ValueError, match="Cannot run"):
        contract.gate(contract.validate({"company": t["company"]}))
    ranked = t["trades"].withColumn("rank", F.lit(5))
    assert {c.id: c.status for c in contract.validate(t | {"trades": ranked})}["trades.rank"] == "missing"
    reps = spark.createDataFrame([("p", "1"), ("p", "1"), ("q", "2")], "person_id string, mst string")
    assert {c.id: c.status for c in contract.validate(t | {"legal_reps": reps})}["legal_reps"] == "empty"
    both = {c.id: (c.status, c.count) for c in contract.validate(t | {"legal_reps": reps.union(spark.createDataFrame([("q", "3")], reps.schema))})}
    assert both["legal_reps"] == ("pass", 1)


def test_stream_merge(spark, tmp_path):
    rows = spark.createDataFrame([("A", "B", 202101, "2021-01-02", 5, 1), ("A", "A", 202101, "2021-01-02", 5, 1)], "seller_mst string, buyer_mst string, period int, day string, amount bigint, vat bigint")
    path = str(tmp_path / "trades")
    merge_batch(rows, path)
    merge_batch(rows, path)
    merge_batch(rows.withColumn("period", F.lit(202102)), path)
    assert sorted((r.period, r.invoice_count, r.total_amount) for r in spark.read.parquet(path).collect()) == [(202101, 2, 10.0), (202102, 1, 5.0)]


def test_sections_and_first(spark):
    rows = spark.createDataFrame([(1, "SALES", None), (2, "a", "x"), (3, "Total", None), (4, "lost", "y"), (5, "purchases", None), (6, "b", "z")], "i int, label string, v string")
    got = [(r.label, r.section) for r in raw.sections(rows, "i", "label", {"sales": "out", "purchases": "in"}, "total").orderBy("i").collect()]
    assert got == [("a", "out"), ("b", "in")]
    rows = spark.createDataFrame([(1, "sales", None), (2, " no. ", "number"), (3, "a", " "), (4, "b", "7"), (5, "c", None)], "i int, label string, v string")
    assert [r.label for r in raw.sections(rows, "i", "label", {"sales": "out"}, "total", header="No.", required="v").collect()] == ["b"]
    assert [r.i for r in edges.keep_first(rows.withColumn("k", F.lit(1)), ["k"], "i").collect()] == [1]


def test_betweenness_by_blocks(spark, monkeypatch):
    """Blocks and stripes of any size give the same; no table of sources and companies is joined with the edges."""
    monkeypatch.setattr(metrics, "_carried", lambda *a: pytest.fail("rows of source and company are joined with the edges"))
    rnd = random.Random(5)
    pairs = {(f"v{rnd.randrange(30)}", f"v{rnd.randrange(30)}") for _ in range(45)} | {("w1", "w2")} | {(f"x{k}", f"x{k + 1}") for k in range(6)}
    pairs = {(a, b) for a, b in pairs if a != b}
    t = graph(spark, [(a, b, 202101, 1, 0) for a, b in pairs])
    for batch, block in ((4096, 7), (2, 1024)):
        got = {r.mst: r.betweenness_centrality for r in metrics.betweenness(t, batch=batch, block=block).collect()}
        assert got == pytest.approx(brandes(pairs), abs=1e-5)
    assert metrics.betweenness(t.where("false")).count() == 0
    with pytest.raises(RuntimeError):
        metrics.betweenness(t, most_rounds=3)
