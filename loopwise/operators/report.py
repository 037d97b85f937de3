"""Files for people: report, top list and drill-down queries. Only ``top_n`` rows reach the driver."""

from __future__ import annotations

import json
from collections.abc import Callable, Iterable

from pyspark.sql import DataFrame

from .flags import drill_down_sql, hubs, top_cycles, with_names
from .score import RED

SCORES = {"score_balance": "balance", "score_time": "time", "score_hidden_link": "hidden link", "score_risky_member": "risk", "score_vat": "tax rate"}


def money(n: float) -> str:
    """From a million on in 'tr', from a thousand million on in 'ty'; thousands parted by dots."""
    if n >= 1e9:
        whole, part = f"{n / 1e9:,.1f}".split(".")
        return f"{whole.replace(',', '.')},{part} ty"
    return f"{n / 1e6:,.0f} tr".replace(",", ".") if n >= 1e6 else f"{int(n):,}".replace(",", ".")


def top_lists(scored: DataFrame, companies: DataFrame, top_n: int) -> tuple[list[dict], list[dict]]:
    top = [r.asDict(recursive=True) for r in top_cycles(with_names(top_cycles(scored, top_n), companies), top_n).collect()]
    for r in top:
        del r["edges"]
        r["drill_down"] = drill_down_sql(r["members"], r["periods"])
    heads = hubs(scored, top_n).join(companies.select("mst", "name"), "mst", "left")
    return top, [r.asDict() for r in heads.orderBy("red_count", "best_score", "mst", ascending=[False, False, True]).collect()]


def table(columns: dict[str, Callable[[dict], object]], rows: Iterable[dict]) -> list[str]:
    """A Markdown table: a column for each title, its cells by a function of the row; numbers stand right."""
    rows = list(rows)
    if not rows:
        return ["(none)"]
    cells = [[f(r) for f in columns.values()] for r in rows]
    numeric = [all(isinstance(line[k], (int, float)) for line in cells) for k in range(len(columns))]
    shown = [[f"{x:g}" if isinstance(x, float) else str(x).replace("|", "\\|") for x in line] for line in cells]
    mark = ["---:" if n else "---" for n in numeric]
    return ["| " + " | ".join(line) + " |" for line in (list(columns), mark, *shown)]


def report_text(summary: dict, top: list[dict], heads: list[dict], meta: dict) -> str:
    """Markdown: what was asked, what was found, one small table for each of the top cycles, and the companies in most of them."""
    out = ["# Circular trades", ""]
    out.append(f"Months {meta.get('period_from')} to {meta.get('period_to')}, cycles of 3 to {meta.get('max_hops')} companies, method `{meta.get('method')}`.")
    out.append(f"{summary['total']} cycles: {summary['red']} red, {summary['watch']} to watch, {summary['skipped']} below.")
    if summary["max_achievable_score"] < 100:
        out.append(f"With this data a cycle can reach {summary['max_achievable_score']:.0f} of 100 points.")
    if summary["watch"]:
        out.append(f"Below {RED:.0f} points the list is what the search let through, and not complete.")
    out += ["", "## Cycles with most points", ""]
    hop = {"seller": lambda e: e["mst"], "name": lambda e: e["name"], "month": lambda e: e["period"], "sold on": lambda e: money(e["amount"])}
    for i, r in enumerate(top, 1):
        points = "; ".join(f"{title} {r[k]:g}" for k, title in SCORES.items() if r[k])
        out += [f"### {i}: {r['score']:g} points", "", f"{points or 'no signal'}.", ""]
        out += [*table(hop, ({"mst": m, "name": n, "period": p, "amount": a} for m, n, p, a in zip(r["members"], r["names"], r["periods"], r["amounts"], strict=True))), ""]
    out += ["## Companies in most red cycles", ""]
    out += table({"company": lambda h: h["mst"], "name": lambda h: h["name"] or "", "red cycles": lambda h: h["red_count"], "best score": lambda h: h["best_score"]}, heads)
    return "\n".join(out) + "\n"


def report_files(scored: DataFrame, companies: DataFrame, summary: dict, meta: dict, top_n: int = 20) -> dict[str, str]:
    """File names to contents: report.md, top.json and cycles.sql."""
    top, heads = top_lists(scored, companies, top_n)
    return {
        "report.md": report_text(summary, top, heads, meta),
        "top.json": json.dumps({"meta": meta, "summary": summary, "top_cycles": top, "top_companies": heads}, ensure_ascii=False, indent=2, default=str),
        "cycles.sql": "\n".join(f"-- {r['score']} points, {r['hop_len']} hops\n{r['drill_down']};" for r in top) + "\n",
    }
