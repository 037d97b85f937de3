"""The queries over scored cycles: no red cycle is lost to the bound of the search."""

import pytest
from loopwise.plans import queries
from loopwise.plans.queries import QUERIES
from loopwise.scratch import materialise

from .test_operators import graph


@pytest.fixture
def tables(spark):
    rows = [("A", "B", 199601, 100, 10), ("B", "C", 199601, 100, 10), ("C", "A", 199602, 64, 6.4)]  # balance + time 40.4, hidden 25
    rows += [("P", "Q", 199601, 100, 10), ("Q", "R", 199601, 100, 10), ("R", "P", 199603, 45, 4.5)]  # 9 + 10: hidden and risky, still not red
    rows += [(f"v{i}", f"v{(i + 1) % 5}", 199602, 64 if i else 100, 10) for i in range(5)]  # five companies: 40.4, vat 10, risky 15
    address = {"A": "Phố X", "B": "Phố X", "P": "Phố Y", "Q": "Phố Y"}
    status = {"R": "Đã giải thể", "v3": "Đã giải thể"}
    names = sorted({x for r in rows for x in r[:2]})
    company = spark.createDataFrame([(n, n, address.get(n), status.get(n), None) for n in names], "mst string, name string, address string, status string, established_date string")
    return {"trades": graph(spark, rows), "company": company}


def test_red_cycles_under_the_bound_without_signals(tables):
    got = {r.cycle_id: (r.hop_len, r.score) for r in QUERIES["cycles_scored"](tables).collect()}
    assert got == {"A|B|C": (3, 65.4), "P|Q|R": (3, 59.0), "v0|v1|v2|v3|v4": (5, 65.4)}
    assert QUERIES["cycles_level_summary"](tables).first()["red"] == 2
    assert {r.mst for r in QUERIES["hub_companies"](tables).collect()} == {"A", "B", "C", *(f"v{i}" for i in range(5))}


@pytest.fixture
def written(monkeypatch):
    """Rows of the tables that the queries themselves write, by name."""
    out = {}

    def noted(df, name):
        made = materialise(df, name)
        out.setdefault(name, []).append(made)
        return made

    monkeypatch.setattr(queries, "materialise", noted)
    return out


def test_drill_down_reads_trades_of_the_window_once(spark, tables, written):
    tables["trades"] = tables["trades"].unionByName(graph(spark, [("A", "B", 199512, 7, 0), ("A", "B", 199604, 7, 0)]))
    got = {(r.seller_mst, r.buyer_mst, r.period) for r in QUERIES["cycle_drilldown"](tables).collect()}
    assert len(got) == 11 and {r[2] for r in got} == {199601, 199602, 199603}
    (trades,) = written["trades"]
    assert trades.count() == 11


def test_refreshed_cycles_read_trades_of_the_window_once(spark, tables, written):
    tables["trades"] = tables["trades"].unionByName(graph(spark, [("A", "B", 199512, 7, 0), ("A", "B", 199604, 7, 0)]))
    got = {r.cycle_id for r in QUERIES["cycles_refreshed"](tables).collect()}
    assert got == {"A|B|C", "P|Q|R", "v0|v1|v2|v3|v4"}
    (trades,) = written["trades"]
    assert trades.count() == 11


def test_invoice_flags_read_invoices_of_the_window_once(spark, tables, written):
    rows = [(k, r.seller_mst, r.buyer_mst, r.period, r.first_date, int(r.total_amount), 10) for k, r in enumerate(tables["trades"].collect())]
    rows += [(100, "A", "B", 199512, "1995-12-01", 7, 0), (101, "A", "B", 199604, "1996-04-01", 7, 0)]
    invoices = spark.createDataFrame(rows, "einvoice_row_id int, seller_mst string, buyer_mst string, period int, day string, amount bigint, vat bigint")
    flagged = QUERIES["invoice_flags"]({"invoices": invoices, "company": tables["company"]}).collect()  # trades are not asked for
    assert len(flagged) == 11 and {r.cycle_ids for r in flagged} == {"A|B|C", "P|Q|R", "v0|v1|v2|v3|v4"}
    (read,) = written["invoices"]
    assert read.count() == 11


def test_summary_counts_cycles_of_all_levels(spark, tables):
    rows = [("L", "M", 199601, 100, 10), ("M", "N", 199601, 100, 10), ("N", "L", 199601, 40, 4)]  # 6 + 20: below
    rows += [("S", "T", 199601, 100, 10), ("T", "U", 199601, 100, 10), ("U", "S", 199601, 72, 7.2)]  # 25.2 + 20: to watch, by no signal
    rows += [("X", "Y", 199601, 10000, 1000), ("Y", "Z", 199601, 10000, 1000), ("Z", "X", 199601, 7993, 1600)]  # 29.958 + 20 + 10: 60.0 by rounding
    tables["trades"] = tables["trades"].unionByName(graph(spark, rows))
    got = QUERIES["cycles_level_summary"](tables).first().asDict()
    assert got == {"total": 6, "red": 3, "watch": 2, "skipped": 1, "top_score": 65.4, "max_achievable_score": 100.0}
    assert {r.cycle_id for r in QUERIES["cycles_scored"](tables).collect()} == {"A|B|C", "P|Q|R", "v0|v1|v2|v3|v4"}  # those that can be red, as before


def test_summary_tells_what_the_signals_at_hand_allow(spark, tables):
    tables["company"] = tables["company"].where("mst in ('A', 'P', 'R')")  # no address is shared
    assert QUERIES["cycles_level_summary"](tables).first()["max_achievable_score"] == 75.0
    tables["company"] = tables["company"].where("mst = 'A'")
    tables["trades"] = tables["trades"].where("false")
    assert QUERIES["cycles_level_summary"](tables).first().asDict() == {"total": 0, "red": 0, "watch": 0, "skipped": 0, "top_score": None, "max_achievable_score": 60.0}
