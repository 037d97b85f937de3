"""Groups of companies of any size, without a table of their pairs where one isn't asked for."""

import itertools
import random
from collections import defaultdict

import pytest
from loopwise.operators import cycles, edges, links, paths
from loopwise.plans.queries import QUERIES
from loopwise.scratch import materialise
from loopwise.sources import raw

from .test_operators import collected, graph, parts, random_graph

_pairs = links._pairs


def some_groups():
    rnd = random.Random(8)
    return sorted({(f"v{rnd.randrange(16):02d}", f"g{k}") for k in range(5) for _ in range(6)} | {("alone", "h"), ("v01", "i"), ("v02", "i"), ("v01", "j"), ("v02", "j")})


def pairs_of(groups):
    of = defaultdict(set)
    for mst, grp in groups:
        of[grp].add(mst)
    out = defaultdict(set)
    for grp, members in of.items():
        for pair in itertools.combinations(sorted(members), 2):
            out[pair].add(grp)
    return out


def test_shortest_paths_within_groups(spark):
    rnd = random.Random(7)
    t = graph(spark, [(a, b, 202101, 1, 0) for a, b in sorted({(f"v{rnd.randrange(16):02d}", f"v{rnd.randrange(16):02d}") for _ in range(40)})])
    groups = some_groups()
    ask = [p for a, b in pairs_of(groups) for p in ((a, b), (b, a))]
    for most in (2, 4, 5):
        want = paths.shortest_paths(t, spark.createDataFrame(ask, "src string, dst string"), most).collect()
        got = paths.shortest_paths(t, spark.createDataFrame(groups, "mst string, grp string"), most).collect()
        assert sorted(map(tuple, got)) == sorted(map(tuple, want)) and len(got) > 10


def test_pairs_of_groups(spark):
    groups = some_groups()
    want = pairs_of(groups)
    df = spark.createDataFrame([*groups, groups[0], (None, "g0"), ("v03", None)], "mst string, grp string")
    for block in (2, 1024):  # groups in one block and in several
        once = [tuple(r) for r in links.pairs_of_groups(df, block=block, most_in_task=5).collect()]
        assert sorted(once) == sorted((*p, min(g)) for p, g in want.items())
        each = [tuple(r) for r in links.pairs_of_groups(df, block=block, once=False).collect()]
        assert sorted(each) == sorted((*p, g) for p, gs in want.items() for g in gs)
    assert max(map(len, want.values())) > 1
    assert links.pairs_of_groups(df.where("false")).count() == 0


def test_a_query_gives_all_pairs_of_a_large_group(spark, monkeypatch):
    n = 60
    header = spark.createDataFrame([(f"c{k:02d}", "Nguyễn Văn A", "", "active", 1, f"{k}", None, None) for k in range(n)], "mst string, dai_dien_phap_luat string, dien_thoai_tru_so string, record_status string, ictrl_dt int, ten_cong_ty string, dia_chi string, trang_thai string")
    valid = "'ban' AS chieu, '1' AS ky_hieu_mau_so, 'Hóa đơn mới' AS trang_thai_hd"
    einvoice = header.selectExpr("mst AS mst_ban_goc", "mst AS mst_mua_goc", valid.split(", ")[0], *valid.split(", ")[1:])
    company = header.selectExpr("mst", "'Số 1, P. A' AS address")
    tables = {"header": header, "einvoice": einvoice, "company": company}
    monkeypatch.setattr(links, "_guard", lambda *a: pytest.fail("refused by the number of pairs"))
    for name in ("hidden_pairs_rep", "hidden_pairs_address", "hidden_pairs_union"):
        assert QUERIES[name](tables).select("company_a", "company_b").distinct().count() == QUERIES[name](tables).count() == n * (n - 1) // 2


def test_path_bound_goes_no_further_than_the_hops_left(spark, monkeypatch):
    monkeypatch.setattr(cycles, "reach_layers", lambda *a: pytest.fail("all pairs in reach"))
    written = []
    monkeypatch.setattr(cycles, "materialise", lambda df, name: (written.append(name), materialise(df, name))[1])
    rows = random_graph(9, n=9, m=40)
    t = graph(spark, rows)
    after = defaultdict(set)
    for r in rows:
        after[r[0]].add(r[1])
    hidden = spark.createDataFrame([("c0", "g"), ("c1", "g")], "mst string, grp string")
    risky = spark.createDataFrame([("c2",)], "mst string")
    every = cycles.enumerate_cycles(t, 202011, 202104, bound=float("-inf"), only=3)
    for most in (3, 4, 5):
        written.clear()
        got = set(collected(cycles.within_path_bound(every, t, hidden, risky, most)))
        assert written.count("reached") == max(0, most - 4) * 4  # each level, for both signals, unless there is one only
        want = set()
        for members, periods in collected(every):
            near, level = set(), {members[-1]}
            for _ in range(most - 3):
                level = {x for v in level for x in after[v]}
                near |= level
            near -= set(members)
            combo = [next(r for r in rows if r[:3] == (a, b, p)) for a, b, p in zip(members, (*members[1:], members[0]), periods)]
            balance, time, _ = parts([r[3] for r in combo], periods, [r[4] for r in combo])
            linked, at_risk = {"c0", "c1"} <= set(members) or near & {"c0", "c1"}, "c2" in members or "c2" in near
            if balance + time >= 50 - 25 * bool(linked) - 15 * bool(at_risk):
                want.add((members, periods))
        assert got == want and want


def test_repeated_pairs_take_one_aggregation(spark):
    t = graph(spark, [("a", "b", m, 1, 0) for m in (202101, 202102, 202103)] + [("b", "a", 202101, 1, 0)])
    df = paths.repeated_pairs(t)
    assert df._jdf.queryExecution().optimizedPlan().toString().count("Aggregate") == 1
    assert df._jdf.queryExecution().sparkPlan().toString().count("HashAggregate(") == 2  # partial and final
    assert [(r.seller_mst, r.buyer_mst, r.n_months) for r in df.collect()] == [("a", "b", 3)]


def test_a_csv_record_is_parsed_once(spark, tmp_path):
    (tmp_path / "i.csv").write_text('1,2021-03-15,a,b,"x, ""y""",100,10,more\n2, 2021-4-01,b,a,,7\n', "utf-8")
    (tmp_path / "j.csv").write_text("1,2021-03-15,a,b,x,100,10\n2, 2021-4-01,b,a,,7,\n", "utf-8")
    df = edges.trade_edges(raw.invoices(raw.read_invoices(spark, str(tmp_path / "j.csv"))))
    assert df._jdf.queryExecution().optimizedPlan().toString().lower().count("from_csv") + df._jdf.queryExecution().optimizedPlan().toString().lower().count("csvtostructs") == 1
    assert sorted((r.seller_mst, r.buyer_mst, r.period, r.total_amount) for r in df.collect()) == [("a", "b", 202103, 100.0), ("b", "a", 202104, 7.0)]
    with pytest.raises(Exception, match="fewer than 7 fields"):
        raw.read_invoices(spark, str(tmp_path / "i.csv")).collect()


def test_fixed_hop_cycles_are_found_once_and_turned(spark, monkeypatch):
    rows = random_graph(11, n=6, m=25)
    t = graph(spark, rows)
    asked = []
    search = cycles.search_cycles
    monkeypatch.setattr(cycles, "search_cycles", lambda *a, **k: (asked.append(k), search(*a, **k))[1])
    got = [(tuple(r.members), tuple((e.src, e.dst, e.period) for e in r.edges)) for r in cycles.fixed_hop_cycles(t, 202011, 202104, 3).collect()]
    by = defaultdict(list)
    for r in rows:
        by[r[0]].append(r)
    want = [((a[0], b[0], c[0]), tuple(x[:3] for x in (a, b, c))) for a in rows for b in by[a[1]] for c in by[b[1]] if c[1] == a[0] and len({a[0], b[0], c[0]}) == 3]
    assert sorted(got) == sorted(want) and want and asked == [{"bound": float("-inf"), "only": 3}]


def test_contract_counts_pairs_of_addresses_without_making_them(spark, monkeypatch):
    monkeypatch.setattr(links, "_pairs", lambda groups, key: pytest.fail("pairs of addresses") if key == "norm_addr" else _pairs(groups, key))
    header = spark.createDataFrame([("a", "Nguyễn Văn A", "", "active", 1, "a", None, None)], "mst string, dai_dien_phap_luat string, dien_thoai_tru_so string, record_status string, ictrl_dt int, ten_cong_ty string, dia_chi string, trang_thai string")
    einvoice = header.selectExpr("mst AS mst_ban_goc", "mst AS mst_mua_goc", "'ban' AS chieu", "'1' AS ky_hieu_mau_so", "'Hóa đơn mới' AS trang_thai_hd")
    company = spark.createDataFrame([(f"c{k}", "Số 1, P. A", None, None) for k in range(5)], "mst string, address string, status string, established_date string")
    tables = {"header": header, "einvoice": einvoice, "company": company, "trades": graph(spark, [("a", "b", 202101, 1, 0)])}
    got = {r.id: (r.status, r.n) for r in QUERIES["contract_checks"](tables).collect()}
    assert got["shares_address"] == ("pass", 10) and got["trades"] == ("pass", 1) and got["shares_phone"] == ("empty", 0)


def test_reach_layers_by_lists(spark, monkeypatch):
    """Any size of the blocks of names gives the same; layers are lists, one for each source and block, and not pairs."""
    rnd = random.Random(3)
    pairs = sorted({(a, b) for a, b in ((f"v{rnd.randrange(40):02d}", f"v{rnd.randrange(40):02d}") for _ in range(70)) if a != b})
    t = graph(spark, [(a, b, 202101, 1, 0) for a, b in pairs])
    near = {p: 1 for p in pairs}
    for depth in (2, 3):
        last = [p for p, d in near.items() if d == depth - 1]
        for a, b in last:
            for c, d in pairs:
                if b == c:
                    near.setdefault((a, d), depth)
    written = {}
    monkeypatch.setattr(cycles, "materialise", lambda df, name: written.setdefault(name, []).append(df) or materialise(df, name))
    for names in (7, 30_000):
        got = cycles.reach_layers(t, 3, names=names).collect()
        assert {(r.src, r.dst): r.depth for r in got} == near and len(got) == len(near)
        some = cycles.reach_layers(t, 3, spark.createDataFrame([("v01",), ("v02",)], "mst string"), names=names).collect()
        assert {(r.src, r.dst): r.depth for r in some} == {p: d for p, d in near.items() if p[1] in ("v01", "v02")}
    assert all("dst" not in df.columns for df in written["reach"])
    monkeypatch.setattr(cycles, "MOST_BROADCAST", 3)
    assert cycles.reach_layers(t, 1).count() == len(pairs)
