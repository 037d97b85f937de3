"""The whole run: tables to scored cycles, loops, metrics, invoice flags and a report."""

from __future__ import annotations

import json
import logging
import time
from collections.abc import Callable, Iterator
from contextlib import contextmanager
from dataclasses import asdict, dataclass
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import components, contract, cycles, edges, flags, links, metrics, report, score
from ..functions.text import normalize_date
from ..schemas import KEYS, RAW_COMPANY, RAW_INVOICE, TABLES
from ..scratch import Change, committed, complete, journalled, months_of, write_counted
from ..sources import lake, raw, workbook

log = logging.getLogger(__name__)


@dataclass
class Settings:
    """max_hops and method as asked for; a bound of None is the one that keeps all red cycles.

    rule: what lowers the bound of a cycle: signals of its members, or (path) also
    of companies that could be reached from its last member in the hops that are
    left, which gives more cycles of the watch list and takes longer.
    samples: sources of betweenness (None: all, exact). months: of which trades
    have been replaced since the run that is being replaced; only cycles with an
    edge in them are looked for anew.
    """

    period_from: int | None = None
    period_to: int | None = None
    max_hops: int = 5
    method: str = "dfs"
    bound: float | None = None
    row_budget: int | None = None
    time_budget_s: float | None = None
    seeds: int = 5000
    per_seed: int | None = None
    threshold: float = score.WATCH
    top_n: int = 20
    metrics: bool = True
    samples: int | None = None
    exact_trim: bool = False
    months: list[int] | None = None
    rule: str = "member"
    return_filter: bool = False


class Steps:
    """Log of what a run does: each step with its seconds, and what it counted."""

    def __init__(self):
        self.done: list[dict] = []

    @contextmanager
    def step(self, name: str) -> Iterator[dict]:
        facts: dict = {}
        began = time.monotonic()
        log.info("%s ...", name)
        try:
            yield facts
        except BaseException:
            log.error("%s failed after %.1f s", name, time.monotonic() - began)
            raise
        self.done.append({"step": name, "seconds": round(time.monotonic() - began, 1)} | facts)
        log.info("%s: %.1f s %s", name, time.monotonic() - began, facts or "")


def _addresses(companies: DataFrame) -> dict[str, DataFrame]:
    """Pairs of companies with the same address; where there would be too many, their groups, which say the same in a row for each company."""
    try:
        return {"shares_address": links.address_pairs(companies)}
    except links.TooManyPairs as e:
        log.warning("shared addresses are kept as groups: %s", e)
        return {"groups": links.hidden_groups(links.normalized_addresses(companies))}


def ingest(spark: SparkSession, company_csv: str, invoice_csv: str) -> dict[str, DataFrame]:
    """The tables of two headerless CSV files."""
    companies = raw.companies(raw.read_companies(spark, company_csv))
    rows = raw.invoices(raw.read_invoices(spark, invoice_csv))
    tables = {
        "company": companies,
        "trades": edges.trade_edges(rows),
        "invoices": raw.invoice_rows(rows),
    }
    return tables | _addresses(companies)


def ingest_workbook(spark: SparkSession, path: str) -> dict[str, DataFrame]:
    """The tables of workbooks whose sheets 'companies' and 'invoices' have a header row and the columns of the CSV files."""
    rows = workbook.read_workbooks(spark, path)
    keyed = lambda sheet, schema, least: workbook.by_position(rows, sheet, schema.fieldNames()).where(F.trim(F.coalesce(F.col(schema.fieldNames()[least]), F.lit(""))) != "")
    companies = raw.companies(keyed("companies", RAW_COMPANY, 0))
    invoices = keyed("invoices", RAW_INVOICE, 2).withColumn("ngay_xuat", normalize_date(F.col("ngay_xuat")))
    invoices = raw.invoices(invoices)
    return {"company": companies, "trades": edges.trade_edges(invoices), "invoices": raw.invoice_rows(invoices)} | _addresses(companies)


def ingest_lake(t: dict[str, DataFrame], period_from: int | None = None, period_to: int | None = None) -> dict[str, DataFrame]:
    """The tables of a lake's tables (see ``lake.read_lake``), of the companies that trade: companies, edges, links, people and invoices."""
    scope = lake.transacting(t["invoices"])
    reps = lake.legal_reps(t["header"], scope)
    addresses, phones = lake.addresses(t["header"], t["filings"], scope), lake.phones(t["header"], scope)
    tables = {
        "company": lake.companies(t["header"], t["filings"], t["items"], t["industry"], t["tax"], t["risk"], scope),
        "trades": lake.trades(t["invoices"], period_from, period_to).withColumns({c: F.col(c).cast("double") for c in ("total_amount", "total_vat")}),
        "shares_phone": links.phone_pairs(phones),
        "legal_reps": reps,
        "persons": lake.persons(reps),
        "invoices": lake.invoice_rows(t["invoices"], period_from, period_to),
    }
    return tables | _addresses(addresses)


def save(tables: dict[str, DataFrame], path: str, steps: Steps | None = None, rebuild: bool = False, merge: bool = False) -> None:
    """Replace tables below ``path``, all or none, each counted after it is written.

    Of trades, the months at hand are replaced; the other tables whole, or with
    ``merge`` by key, the new row taking the place of the old one. ``rebuild``
    drops what was there, tables that are not given included.
    """
    if not tables:
        return
    steps = steps or Steps()
    spark = next(iter(tables.values())).sparkSession
    complete(spark, path)
    old = raw.read_tables(spark, path, partial=True) if merge else {}
    change = Change(spark, path)
    try:
        for name, df in tables.items():
            with steps.step(f"write {name}") as facts:
                if name == "trades" and not rebuild:
                    facts["rows"] = write_counted(df, f"{change.staged}/{name}", by="period")
                    for month in months_of(spark, f"{change.staged}/{name}"):
                        change.place(f"{name}/{month}")
                elif name == "trades":
                    facts["rows"] = write_counted(df, change.place(name), by="period")
                else:
                    if name in old:
                        keys = [F.col(k).eqNullSafe(F.col(f"_new_{k}")) for k in KEYS[name]]
                        new = df.select(*[F.col(k).alias(f"_new_{k}") for k in KEYS[name]]).distinct()
                        df = df.unionByName(old[name].join(new, keys, "left_anti"), allowMissingColumns=True)
                    facts["rows"] = write_counted(df, change.place(name))
        if rebuild:
            for name in set(TABLES) - set(tables):
                change.drop(name)
        change.commit()
    except BaseException:
        if not journalled(spark, path):
            change.give_up()
        raise


def linked_groups(tables: dict[str, DataFrame]) -> DataFrame | None:
    """(mst, grp) of all tables that tell of links."""
    parts = [tables["groups"]] if "groups" in tables else []
    parts += [links.groups_of_pairs(links.unordered(tables[k], "company_a", "company_b")) for k in ("shares_address", "shares_phone") if k in tables]
    if "legal_reps" in tables:
        parts.append(links.hidden_groups(legal_reps=tables["legal_reps"]))
    if "owns" in tables:
        parts.append(links.hidden_groups(owns=tables["owns"]))
    groups = reduce(DataFrame.unionByName, parts) if parts else None
    return None if groups is None else groups.join(groups.groupBy("grp").agg(F.count_distinct("mst").alias("n")).where("n > 1").select("grp"), "grp", "left_semi").select("mst", "grp").distinct()


def detect(tables: dict[str, DataFrame], s: Settings, stored: DataFrame | None = None, keep: str | None = None) -> tuple[DataFrame, dict]:
    """(scored cycles, facts about the run).

    stored: the cycles that an earlier run has found (members, edges, hop_len),
    of which those without an edge in ``s.months`` stay; keep: where to write
    what this one finds.
    """
    trades = tables["trades"]
    if s.period_from is None or s.period_to is None:
        span = trades.agg(F.min("period").alias("a"), F.max("period").alias("b")).first()
        s.period_from, s.period_to = s.period_from or span["a"], s.period_to or span["b"]
    hidden = linked_groups(tables)
    risky = links.risky_companies(tables["company"], s.period_from)
    has_hidden, has_risky = hidden is not None and not hidden.isEmpty(), not risky.isEmpty()
    bound = score.prune_bound(has_hidden, has_risky) if s.bound is None else s.bound
    if s.method == "match":
        found = [cycles.fixed_hop_cycles(trades, s.period_from, s.period_to, k, s.seeds, s.per_seed) for k in range(3, s.max_hops + 1)]
        rows = found[0]
        for x in found[1:]:
            rows = rows.unionByName(x)
        truncated = s.per_seed is not None
    elif s.method == "dfs":
        by_path = s.rule == "path" and s.bound is None
        signals = {"hidden": hidden if has_hidden else None, "risky": risky if has_risky else None} if s.bound is None and not by_path else {}
        how = {"max_hops": s.max_hops, "bound": bound, "row_budget": s.row_budget, "time_budget_s": s.time_budget_s, "exact_trim": s.exact_trim, "return_filter": s.return_filter} | signals
        if stored is not None and s.months and not by_path:
            rows, truncated = cycles.refreshed(stored, trades, s.period_from, s.period_to, s.months, **how)
        else:
            rows, truncated = cycles.search_cycles(trades, s.period_from, s.period_to, **how)
        if by_path:
            rows = cycles.within_path_bound(rows, edges.window_of(trades, s.period_from, s.period_to), hidden if has_hidden else None, risky if has_risky else None, s.max_hops)
        if keep is not None and not truncated and not by_path:  # which cycles a path finds depends on all edges

            rows.write.parquet(keep)
            rows = trades.sparkSession.read.schema(rows.schema).parquet(keep)
    else:
        raise ValueError(f"unknown method: {s.method}")
    scored = score.score_cycles(cycles.best_combinations(rows, turn=s.method == "match"), hidden if has_hidden else None, risky if has_risky else None)
    if s.exact_trim:
        window = edges.window_of(trades, s.period_from, s.period_to)
        kept = {"edges": window.count(), "edges_on_cycles": components.within_components(window).count()}
    else:
        kept = {}
    return scored, kept | {"bound": bound, "has_hidden": has_hidden, "has_risky": has_risky, "truncated": truncated}


FOUND = "_found"  # cycles of a run before the best months are picked
_SAME = ("period_from", "period_to", "max_hops", "method", "bound", "rule")


def last_found(spark: SparkSession, out: str, s: Settings) -> DataFrame | None:
    """The cycles that the last run below ``out`` found, if it was whole and asked for the same; else None, and the search starts anew."""
    try:
        meta = json.loads("".join(r["value"] for r in spark.read.text(f"{out}/meta.json", wholetext=True).collect()))
        found = spark.read.parquet(f"{out}/{FOUND}")
    except Exception as e:
        if "PATH_NOT_FOUND" not in str(e):
            raise
        return None
    asked = asdict(s)
    same = all(asked[k] is None or meta["asked"][k] == asked[k] for k in _SAME) and meta["asked"]["bound"] == asked["bound"]
    if not same:
        log.warning("the last run asked for something else: all cycles are looked for anew")
        return None
    s.period_from, s.period_to = meta["asked"]["period_from"], meta["asked"]["period_to"]
    return found


def run(spark: SparkSession, tables: dict[str, DataFrame], out: str, s: Settings | None = None, invoices: DataFrame | None = None, steps: Steps | None = None) -> dict:
    """Check, detect and write everything below ``out``; returns the facts of meta.json.

    The files appear together when all are written; a run that fails leaves
    ``out`` as it was. Invoices (those of the tables, if none are given) are
    flagged if they can be; the report is worth having without them.
    """
    s, steps = s or Settings(), steps or Steps()
    began = time.time()
    invoices = invoices if invoices is not None else tables.get("invoices")
    with steps.step("check") as facts:
        checks = contract.validate(tables)
        facts |= contract.histogram(checks)
        contract.gate(checks)
    with committed(spark, out) as new:
        with steps.step("detect cycles") as facts:
            stored = last_found(spark, out, s) if s.months else None
            scored, found = detect(tables, s, stored, f"{new}/{FOUND}")
            facts["refreshed"] = stored is not None
            scored.write.parquet(f"{new}/scored")
            scored = spark.read.parquet(f"{new}/scored")
            summary = score.level_summary(scored, found["has_hidden"], found["has_risky"]).first().asDict()
            facts |= summary
        with steps.step("write cycles"):
            scored.drop("edges").write.json(f"{new}/graph_risk_flags")
            flags.loops(scored).write.json(f"{new}/invoice_loops")
        if s.metrics:
            with steps.step("company metrics"):
                metrics.company_metrics(edges.window_of(tables["trades"], s.period_from, s.period_to), s.samples).write.json(f"{new}/company_metrics")
        flagged = None
        if invoices is not None:
            try:
                with steps.step("flag invoices"):
                    flags.invoice_flags(invoices, scored, s.threshold).write.json(f"{new}/invoice_flags")
                flagged = True
            except Exception:  # noqa: BLE001
                log.exception("invoice flags were skipped")
                flagged = False
        with steps.step("report"):
            meta = asdict(s) | {"asked": {k: getattr(s, k) for k in _SAME}} | found | {"summary": summary, "contract": contract.as_dict(checks), "invoice_flags": flagged, "elapsed_sec": round(time.time() - began, 1), "steps": steps.done}
            files = report.report_files(scored, tables["company"], summary, {k: meta[k] for k in ("period_from", "period_to", "max_hops", "method")}, s.top_n)
            for name, text in (files | {"meta.json": json.dumps(meta, ensure_ascii=False, default=str), "validation.json": json.dumps(contract.as_dict(checks), ensure_ascii=False, default=str)}).items():
                spark.createDataFrame([(text,)], "value string").coalesce(1).write.text(f"{new}/{name}")
    return meta
