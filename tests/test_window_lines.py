"""Queries on a range of months join only the lines of its orders."""

from loopwise.operators import cycles, sieve
from loopwise.plans.queries import QUERIES
from loopwise.sources import testbed
from pyspark.sql import functions as F

SMALL = "/root/testdata/sf0.001"


def test_lines_of_other_months_are_sifted(spark, monkeypatch):
    monkeypatch.setattr(testbed, "SIFTED", 0)
    joined = []
    sift = sieve.sifted
    monkeypatch.setattr(testbed, "sifted", lambda *x: joined.append(sift(*x)) or joined[-1])
    t = testbed.Tables(spark, SMALL)
    got = t.invoices_within(199601, 199603)
    want = t["invoices"].where(F.col("period").between(199601, 199603))
    assert got.schema == want.schema and got.count() == want.count() > 0
    assert got.exceptAll(want).isEmpty()
    (lines,) = joined
    assert lines.count() < t["lineitem"].count() / 5


def test_queries_of_the_window_sift_lines(spark, monkeypatch):
    monkeypatch.setattr(testbed, "SIFTED", 0)
    monkeypatch.setattr(cycles, "SIFTED", 0)
    asked = []
    within = testbed.Tables.invoices_within
    monkeypatch.setattr(testbed.Tables, "invoices_within", lambda t, *x: asked.append(x) or within(t, *x))
    assert QUERIES["cycles_level_summary"](testbed.Tables(spark, SMALL)).count() == 1
    assert asked == [(199601, 199603)]
