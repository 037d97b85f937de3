"""python -m loopwise: ingest CSV files or a lake, check tables, detect circular trading."""

from __future__ import annotations

import argparse
import json
import logging

from . import scratch
from .operators import contract
from .plans import circular
from .session import session
from .sources import lake, raw


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="loopwise", description=__doc__)
    p.add_argument("--root", required=True, help="folder of datasets")
    p.add_argument("--dataset", required=True, help="name of the dataset's folder below it")
    source = p.add_argument_group("ingest, from one source")
    source.add_argument("--companies", help="headerless company CSV")
    source.add_argument("--invoices", help="headerless invoice CSV")
    source.add_argument("--workbook", help="workbook (.xlsx) with a sheet 'companies' and a sheet 'invoices'")
    source.add_argument("--datasource", choices=contract.SOURCES, help="the source that the inputs must belong to (default: the one that they fit)")
    source.add_argument("--rebuild", action="store_true", help="drop all tables that were there; else trades are replaced by month")
    source.add_argument("--merge", action="store_true", help="keep rows of other tables whose keys don't come again")
    source.add_argument("--ingest-only", action="store_true", help="stop when the tables are written")
    source.add_argument("--lake", help="folder of Parquet tables, catalog:<schema>, or a jdbc: address")
    source.add_argument("--lake-table", action="append", default=[], metavar="ROLE=NAME", help="a table of the lake that has another name")
    search = p.add_argument_group("search")
    search.add_argument("--from", dest="period_from", type=int, help="first month, yyyymm (default: the first there is)")
    search.add_argument("--to", dest="period_to", type=int)
    search.add_argument("--hops", type=int, default=5)
    search.add_argument("--method", choices=("dfs", "match"), default="dfs")
    search.add_argument("--bound", type=float, help="least balance + time of a cycle (default: what can be red)")
    search.add_argument("--row-budget", type=int, help="stop where a level has more paths than this")
    search.add_argument("--time-budget", type=float, help="stop the search after so many seconds and keep what it has found")
    search.add_argument("--rule", choices=("member", "path"), default="member", help="path: companies that a cycle's last member leads to lower its bound too (more of the watch list, slower)")
    search.add_argument("--exact-trim", action="store_true", help="drop all edges between strongly connected components first")
    search.add_argument("--return-filter", action="store_true", help="drop paths that can't get back to their start in the hops that are left (for graphs where companies reach few others)")
    search.add_argument("--months", type=lambda x: [int(m) for m in x.split(",")], help="months (yyyymm,...) replaced since the last run of this id: only cycles through them are looked for anew")
    search.add_argument("--seeds", type=int, default=5000, help="method match: companies to start from")
    search.add_argument("--per-seed", type=int, help="method match: cycles kept of each")
    out = p.add_argument_group("output")
    out.add_argument("--top-n", type=int, default=20)
    out.add_argument("--threshold", type=float, default=40.0, help="score from which invoices are flagged")
    out.add_argument("--run-id", default="run")
    out.add_argument("--skip-detect", action="store_true", help="check only")
    out.add_argument("--no-metrics", action="store_true")
    out.add_argument("--samples", type=int, help="betweenness from so many sources, with an error bound (default: exact up to 50000 companies)")
    return p


def main(argv: list[str] | None = None) -> int:
    p = parser()
    a = p.parse_args(argv)
    try:
        source = contract.source_of({"companies": a.companies, "invoices": a.invoices, "workbook": a.workbook, "lake": a.lake}, a.datasource)
    except ValueError as e:
        p.error(str(e))
    if a.ingest_only and source == "local_existing":
        p.error("nothing to ingest")
    logging.basicConfig(level=logging.INFO, format="%(asctime)s %(message)s")
    spark = session()
    path = raw.dataset_dir(a.root, a.dataset)
    raw.dataset_dir(a.root, a.run_id)  # a run's name must be safe as well
    steps = circular.Steps()
    try:
        new: dict = {}
        if source == "csv":
            new = circular.ingest(spark, a.companies, a.invoices)
        elif source == "workbook":
            new = circular.ingest_workbook(spark, a.workbook)
        elif source == "lake":
            names = dict(x.split("=", 1) for x in a.lake_table)
            new = circular.ingest_lake(lake.read_lake(spark, a.lake, names), a.period_from, a.period_to)
        circular.save(new, path, steps, rebuild=a.rebuild, merge=a.merge)
        if a.ingest_only:
            print(json.dumps({x["step"]: x["rows"] for x in steps.done if "rows" in x}))
            return 0
        tables = raw.read_tables(spark, path)
        if a.skip_detect:
            print(json.dumps(contract.as_dict(contract.validate(tables)), ensure_ascii=False, default=str))
            return 0
        s = circular.Settings(a.period_from, a.period_to, a.hops, a.method, a.bound, a.row_budget, a.time_budget, a.seeds, a.per_seed, a.threshold, a.top_n, not a.no_metrics, a.samples, a.exact_trim, a.months, a.rule, a.return_filter)
        meta = circular.run(spark, tables, f"{path}/runs/{a.run_id}", s, steps=steps)
        print(json.dumps(meta["summary"] | {"truncated": meta["truncated"]}, default=str))
        return 0
    finally:
        scratch.clear(spark)


if __name__ == "__main__":
    raise SystemExit(main())
