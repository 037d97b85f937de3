"""Simple directed trade cycles, by joins of path halves.

A cycle starts at its smallest company, so it comes once for each combination
of its months. It is a front, a path from that company, and a back, a path to
it, that meet in one equi-join on both ends; fronts and backs grow by one edge
a level, to half the longest cycle. Balance and time never rise when an edge
is added, so a half under the bound is dropped as it grows.

Signals lower the bound of a cycle, and only through its members. Companies at
risk come first in the order, so a cycle that has one starts at one: paths from
there grow down to 35, all others to 50. Cycles with a hidden link between two
members are looked for below that, down to 25, or 10 with a member at risk:
from the arcs between linked companies. No path is grown at a bound that nothing
on it can earn.
"""

from __future__ import annotations

import threading
import time
import uuid
from collections.abc import Callable
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import month_index
from ..scratch import materialise, side_by_side
from .components import within_components
from .edges import seeds, trim_to_core, window_of
from .links import groups_of_pairs
from .reach import may_reach, reach_labels
from .score import RED, W_HIDDEN, W_RISKY, W_VAT, balance_of, components_of, flagged_members, time_of
from .sieve import Sieve, sieve, sifted


def _edge() -> F.Column:
    return F.struct(F.col("seller_mst").alias("src"), F.col("buyer_mst").alias("dst"), "period", F.col("total_amount").alias("amount"), F.col("total_vat").alias("vat"))


#: Edges from which on paths are sifted before they are shuffled.
SIFTED = 30_000
#: Companies of a block of names in ``reach_layers`` (their places fit two bytes), and most names that are broadcast.
NAMES, MOST_BROADCAST = 30_000, 1_000_000


def reach_layers(edges: DataFrame, max_hops: int, targets: DataFrame | None = None, names: int = NAMES) -> DataFrame:
    """(src, dst, depth): the fewest hops, up to ``max_hops``, from src to each dst (of ``targets`` (mst) where given).

    Companies have places of two bytes in blocks of about ``names``. A layer is
    one list of places for each src and block; lists go along the edges and are
    put together where they arrive, so that no pair is a row before it is given
    out. A task holds the lists of one src and block at a time.
    """
    hops = materialise(edges.select(F.col("seller_mst").alias("src"), F.col("buyer_mst").alias("dst")).distinct(), "hops")
    companies = materialise(hops.select("dst").distinct(), "companies")
    n = companies.count()
    of_block = W.partitionBy("block").orderBy("dst")
    places = companies.withColumn("block", F.pmod(F.xxhash64("dst"), F.lit(max(1, -(-n // names)))).cast("int"))
    places = materialise(places.withColumn("at", (F.row_number().over(of_block) - 1).cast("smallint")), "places")
    first = hops if targets is None else hops.join(targets.select(F.col("mst").alias("dst")), "dst", "left_semi")
    layer = materialise(first.join(places, "dst").groupBy("src", "block").agg(F.collect_list("at").alias("reached")), "reach")
    seen, out = layer, layer.withColumn("depth", F.lit(1))
    for depth in range(2, max_hops + 1):
        sent = hops.withColumnRenamed("dst", "via").join(layer.withColumnRenamed("src", "via"), "via")
        step = sent.repartition("src", "block").groupBy("src", "block").agg(F.array_distinct(F.flatten(F.collect_list("reached"))).alias("step"))
        layer = step.join(seen, ["src", "block"], "left").select("src", "block", F.when(F.col("reached").isNull(), F.col("step")).otherwise(F.array_except("step", "reached")).alias("reached")).where(F.size("reached") > 0)
        if depth < max_hops:
            layer = materialise(layer, "reach")
            seen = materialise(seen.unionByName(layer).groupBy("src", "block").agg(F.flatten(F.collect_list("reached")).alias("reached")), "reach")
        out = out.unionByName(layer.withColumn("depth", F.lit(depth)))
    named = F.broadcast(places) if n <= MOST_BROADCAST else places
    return out.select("src", "block", F.explode("reached").alias("at"), "depth").join(named, ["block", "at"]).select("src", "dst", "depth")


class BudgetSpent(RuntimeError):
    """The time of a search is over."""


class Budget:
    """Rows and seconds that a search may take. Within seconds, a running job is stopped, and what was written before stays."""

    def __init__(self, rows: int | None, seconds: float | None):
        self.rows, self.seconds, self.began, self.spent = rows, seconds, time.monotonic(), False

    def write(self, df: DataFrame, name: str) -> tuple[DataFrame, int]:
        """(``df`` as a scratch table, its rows)."""
        seen = Observation()
        observed = df.observe(seen, F.count(F.lit(1)).alias("n"))
        if self.seconds is None:
            return materialise(observed, name), seen.get["n"]
        left = self.seconds - (time.monotonic() - self.began)
        if self.spent or left <= 0:
            self.spent = True
            raise BudgetSpent
        context, tag, over = df.sparkSession.sparkContext, f"loopwise-{uuid.uuid4().hex}", threading.Event()

        def stop():
            while not over.is_set():  # a write begins its jobs one by one
                self.spent = True
                context.cancelJobsWithTag(tag)
                over.wait(0.2)

        timer = threading.Timer(left, stop)
        context.addJobTag(tag)
        timer.start()
        try:
            out = materialise(observed, name)
        except Exception as e:
            if self.spent:
                raise BudgetSpent from e
            raise
        finally:
            over.set()
            timer.cancel()
            context.removeJobTag(tag)
        return out, seen.get["n"]


# A path of n edges has the companies v0 .. vn and of edge i = 1 .. n the period p<i>, amount a<i> and tax t<i>;
# of all its edges least and largest amount and month, and whether a seller is at risk. Its columns are put
# together as SQL text: a search has some thousand of them, and each call from Python costs a millisecond.
_FACTS = {"p": "period", "a": "amount", "t": "vat"}
_RANGE = {"mn": "least", "mx": "greatest", "lo": "least", "hi": "greatest", "risk": "greatest"}
_OF_EDGE = {"mn": "amount", "mx": "amount", "lo": "month", "hi": "month", "risk": "at_risk"}


def _flat_columns(n: int) -> list[str]:
    return [f"v{i}" for i in range(n + 1)] + [f"{f}{i}" for i in range(1, n + 1) for f in _FACTS]


def _columns(n: int) -> list[str]:
    return [*_flat_columns(n), *_RANGE]


def _points() -> Column:
    """Balance + time of a path."""
    return balance_of(F.col("mn"), F.col("mx")) + time_of(F.col("lo"), F.col("hi"))


def _steps(edges: DataFrame, back: bool) -> DataFrame:
    """Edges as steps (here, there, ...); those of a back lead against the trade."""
    here, there = ("dst", "src") if back else ("src", "dst")
    return edges.selectExpr(f"{here} AS here", f"{there} AS there", "period", "amount", "vat", "month", "risk AS at_risk")


def _start(steps: DataFrame, rising: bool) -> DataFrame:
    """Steps as paths of one edge; ``rising``: to a larger company only."""
    rows = steps.where("here < there") if rising else steps
    return rows.selectExpr("here AS v0", "there AS v1", *[f"{c} AS {f}1" for f, c in _FACTS.items()], *[f"{c} AS {k}" for k, c in _OF_EDGE.items()])


def _longer(paths: DataFrame, n: int, steps: DataFrame, rising: bool, keep: Column, also: str = "true") -> DataFrame:
    """Paths of n edges with one more, those that ``keep`` (of the new path) and ``also`` (of the old one and the step) let through."""
    on = [f"v{n} = here", "there > v0" if rising else "there <> v0", *[f"there <> v{i}" for i in range(1, n)], also]
    more = [c for c in paths.columns if c not in _columns(n)]
    ranges = [f"{f}({k}, {_OF_EDGE[k]}) AS {k}" for k, f in _RANGE.items()]
    rows = paths.join(steps, F.expr(" AND ".join(on)))
    return rows.selectExpr(*_flat_columns(n), *more, f"there AS v{n + 1}", *[f"{c} AS {f}{n + 1}" for f, c in _FACTS.items()], *ranges).where(keep)


def _meet(fronts: DataFrame, n: int, backs: DataFrame, m: int, closed: bool = True, key: tuple[str, ...] = ()) -> DataFrame:
    """Fronts of n and backs of m edges put together where they end at the same company and share no other, as paths of n + m edges.

    A ``closed`` path also starts where it ends, and vn+m is left out. ``key``:
    further columns that must be equal, and stay.
    """
    other = backs.selectExpr(*[f"{c} AS b_{c}" for c in (*_columns(m), *key)])
    on = [f"v{n} = b_v{m}", *(["v0 = b_v0"] if closed else []), *[f"{k} = b_{k}" for k in key]]
    on += [f"b_v{i} <> v{k}" for i in range(1 if closed else 0, m) for k in range(n)]
    names = [f"b_v{m - i} AS v{n + i}" for i in range(1, m if closed else m + 1)]
    facts = [f"b_{f}{m + 1 - i} AS {f}{n + i}" for i in range(1, m + 1) for f in _FACTS]
    ranges = [f"{f}({k}, b_{k}) AS {k}" for k, f in _RANGE.items()]
    return fronts.join(other, F.expr(" AND ".join(on))).selectExpr(*_flat_columns(n), *names, *facts, *ranges, *key)


def _cycles_of(paths: DataFrame | None, hops: int) -> DataFrame | None:
    """Closed paths as (members, edges, hop_len), by the companies' own names and from the smallest on."""
    if paths is None:
        return None
    name = lambda i: f"substring(v{i % hops}, 2)"
    edge = lambda i: f"named_struct('src', {name(i)}, 'dst', {name(i + 1)}, 'period', p{i + 1}, 'amount', a{i + 1}, 'vat', t{i + 1})"
    return canonical(paths.selectExpr(f"array({', '.join(map(name, range(hops)))}) AS members", f"array({', '.join(map(edge, range(hops)))}) AS edges", f"{hops} AS hop_len"))


def enumerate_cycles(trades: DataFrame, period_from: int, period_to: int, **how) -> DataFrame:
    """(members, edges, hop_len, truncated): what ``search_cycles`` finds, with what it says in all rows."""
    found, truncated = search_cycles(trades, period_from, period_to, **how)
    return found.withColumn("truncated", F.lit(truncated))


@dataclass
class _Sweep:
    """Cycles through the smallest company of all, by fronts and backs of growing length."""

    edges: DataFrame
    lengths: list[int]
    keep: Column  # which paths are grown
    budget: Budget
    returning: bool = False  # drop paths that can't close in the hops that are left
    large: bool = False  # sift fronts by the ends of backs before both are shuffled

    def __post_init__(self):
        self.sieves: dict[int, Sieve] = {}
        self.labels: dict[bool, list[DataFrame]] = {}
        self.levels: dict[tuple[bool, int], DataFrame | None] = {}
        self.full: set[tuple[bool, int]] = set()  # levels that hold more paths than the budget

    def steps(self, front: bool, n: int) -> DataFrame:
        """Steps that make paths of n edges; with ``returning``, each with the label of where it leads."""
        steps = _steps(self.edges, not front)
        if not self.returning:
            return steps
        most = max(self.lengths)
        if front not in self.labels:
            self.labels[front] = reach_labels(steps.selectExpr("here AS src", "there AS dst"), most - 1)
        return steps.join(self.labels[front][most - n - 1].withColumnRenamed("v", "there"), "there")

    def level(self, front: bool, n: int) -> DataFrame | None:
        """Fronts or backs of n edges; None where the row budget forbids to make the level before longer."""
        if (front, n) not in self.levels:
            if n == 1:
                steps = self.steps(front, 1)
                out = _start(steps.where(may_reach("here")) if self.returning else steps, True).where(self.keep)
            else:
                before = self.level(front, n - 1)
                out = None if before is None or (front, n - 1) in self.full else _longer(before, n - 1, self.steps(front, n), True, self.keep, may_reach("v0") if self.returning else "true")
            self.levels[front, n] = None if out is None else self.kept(out, front, n)
        return self.levels[front, n]

    def kept(self, level: DataFrame, front: bool, n: int) -> DataFrame:
        """A level that is read more than once, or must be counted, is written."""
        of = lambda h: (h + 1) // 2 if front else h // 2
        reads = sum(n == of(h) for h in self.lengths) + any(of(h) > n for h in self.lengths)
        if self.large and not front:  # read for the sieve too
            reads += 1
        if self.budget.rows is None and self.budget.seconds is None and (reads < 2 or n == 1):
            return level
        out, rows = self.budget.write(level, "fronts" if front else "backs")
        if self.budget.rows is not None and rows > self.budget.rows:
            self.full.add((front, n))
        return out

    def closed(self, hops: int) -> DataFrame | None:
        n, m = (hops + 1) // 2, hops // 2
        fronts, backs = self.level(True, n), self.level(False, m)
        if fronts is None or backs is None:
            return None
        if self.large and n > 1:
            if m not in self.sieves:
                self.sieves[m] = sieve(backs, [f"v{m}", "v0"])
            fronts = sifted(fronts, [f"v{n}", "v0"], self.sieves[m])
        return _meet(fronts, n, backs, m).where(self.keep)


def _arcs(edges: DataFrame, groups: DataFrame, n: int, keep: Column) -> DataFrame:
    """Paths of n edges whose ends share a group, each once: halves from the members of groups meet on the group and the company between them."""

    def half(m: int, back: bool) -> DataFrame:
        if m == 0:
            return groups.selectExpr("mst AS v0", "grp")
        steps = _steps(edges, back)
        out = _start(steps, False).join(groups.selectExpr("mst AS v0", "grp"), "v0")
        for k in range(1, m):
            out = _longer(out, k, steps, False, keep)
        return out

    fronts = half((n + 1) // 2, False)
    if n == 1:
        rows = fronts.join(groups.selectExpr("mst AS v1", "grp"), ["v1", "grp"]).select(*_columns(1))
    else:
        rows = _meet(fronts, (n + 1) // 2, half(n // 2, True), n // 2, False, ("grp",)).drop("grp")
    return rows.where(keep).dropDuplicates([f"v{i}" for i in range(n + 1)] + [f"p{i}" for i in range(1, n + 1)])


def _through_arcs(arcs: DataFrame, b: int, hops: int, edges: DataFrame, keep: Column, budget: Budget | None = None, few: bool = True) -> DataFrame:
    """Cycles of ``hops`` companies with an arc of b edges: arcs grow from their end, and backs from their start.

    With a ``budget`` the side that is smaller, arcs where they are ``few``, is
    written, and the other one sifted by its ends before both are shuffled.
    """
    a = hops - b
    m = (a + 1) // 2
    n = hops - m
    out = arcs
    for k in range(b, n):
        out = _longer(out, k, _steps(edges, False), False, keep)
    ends = arcs.select("v0").distinct()
    steps = _steps(edges, True)
    backs = _start(steps, False).join(ends, "v0", "left_semi")
    for k in range(1, m):
        backs = _longer(backs, k, steps, False, keep)
    if budget is not None and m > 1:
        if few:
            out, _ = budget.write(out, "grown-arcs")
            backs = sifted(backs, [f"v{m}", "v0"], sieve(out, [f"v{n}", "v0"]))
        else:
            backs, _ = budget.write(backs, "backs")
            out = sifted(out, [f"v{n}", "v0"], sieve(backs, [f"v{m}", "v0"]))
    return _meet(out, n, backs, m).where(keep)


def search_cycles(
    trades: DataFrame,
    period_from: int,
    period_to: int,
    max_hops: int = 5,
    min_hops: int = 3,
    bound: float = 50.0,
    row_budget: int | None = None,
    trim_rounds: int = 1,
    only: int | None = None,
    time_budget_s: float | None = None,
    hidden: DataFrame | None = None,
    risky: DataFrame | None = None,
    months: list[int] | None = None,
    exact_trim: bool = False,
    return_filter: bool = False,
) -> tuple[DataFrame, bool]:
    """(members, edges, hop_len) of every cycle of min_hops..max_hops companies with balance + time >= bound, and whether a budget cut the search.

    members start with the smallest key; edges[i] leads from members[i] to the
    next. With ``hidden`` (pairs company_a, company_b, or groups mst, grp whose
    members are linked) or ``risky`` (mst), ``bound`` is the least that any cycle
    needs, and a cycle must also have 50, less 25 with a hidden pair among its
    members and 15 with a member at risk: those that can be red.

    A level of more than ``row_budget`` paths is not made longer. After
    ``time_budget_s`` seconds the running job is stopped; lengths and signals
    that are done by then are given out. In both cases the search was truncated.
    ``only`` keeps one length. ``months`` keeps cycles with an edge in one of
    them, and grows paths from those edges alone. ``exact_trim`` first drops all
    edges between strongly connected components, which lie on no cycle.
    ``return_filter`` drops paths, as they grow, whose end can't get back to
    their start in the hops that are left: by labels of a fixed size on the
    edges, so without another shuffle of paths. It pays where companies reach
    few others; no cycle is lost.
    """
    budget = Budget(row_budget, time_budget_s)
    spark = trades.sparkSession
    rows = window_of(trades, period_from, period_to)
    if exact_trim:
        rows = within_components(materialise(rows, "window"))
    edges = rows.select(F.col("seller_mst").alias("src"), F.col("buyer_mst").alias("dst"), "period", F.col("total_amount").alias("amount"), F.col("total_vat").alias("vat"), month_index(F.col("period")).alias("month"))
    edges = trim_to_core(materialise(_ranked(edges, risky), "window"), trim_rounds, "src", "dst")
    large = edges.count() > SIFTED  # of fewer edges, paths are sent as they are
    sifting = budget if large else None
    lengths = [only] if only is not None else list(range(max(2, min_hops), max_hops + 1))
    full = max(bound, RED - W_VAT) if hidden is not None or risky is not None else bound
    points = _points()
    at_risk = W_RISKY * F.col("risk")
    need = full if risky is None else F.when(F.col("v0").startswith(_AT_RISK), max(bound, full - W_RISKY)).otherwise(full)
    in_months = lambda hops: F.lit(True) if months is None else reduce(lambda a, b: a | b, (F.col(f"p{i}").isin(months) for i in range(1, hops + 1)))
    once = lambda found: found.withColumn("_periods", F.transform("edges", lambda e: e["period"])).dropDuplicates(["members", "_periods"]).drop("_periods")
    if months is None:
        sweep = _Sweep(edges, lengths, points >= need, budget, return_filter, large)
        parts: list[Callable[[int], DataFrame | None]] = [lambda hops: _cycles_of(sweep.closed(hops), hops)]
    else:
        # a path doesn't know yet whether its cycle has a company at risk
        may_be = points >= (full if risky is None else max(bound, full - W_RISKY))
        anchors = materialise(_start(_steps(edges.where(F.col("period").isin(months)), False), False).where(may_be), "anchors")
        parts = [lambda hops: once(_cycles_of(_through_arcs(anchors, 1, hops, edges, may_be, sifting, few=False).where(points >= F.greatest(F.lit(bound), full - at_risk)), hops))]
    if hidden is not None and bound < full:
        groups = materialise(_ranked(_in_twos(hidden if "grp" in hidden.columns else groups_of_pairs(hidden)), risky, ("mst",)), "groups")
        may_be_linked = points >= max(bound, full - W_HIDDEN - (W_RISKY if risky is not None else 0.0))
        arcs: dict[int, DataFrame] = {}
        full_arcs: set[int] = set()

        def linked(hops: int) -> DataFrame | None:
            """What the sweep's bound leaves out; a cycle with several links comes once."""
            rows = None
            for b in range(1, hops // 2 + 1):
                if b not in arcs:
                    arcs[b], n = budget.write(_arcs(edges, groups, b, may_be_linked), "arcs")
                    if row_budget is not None and n > row_budget:
                        full_arcs.add(b)
                if full_arcs:
                    return None
                closed = _through_arcs(arcs[b], b, hops, edges, may_be_linked, sifting)
                rows = closed if rows is None else rows.unionByName(closed)
            below = F.greatest(F.lit(bound), full - at_risk)
            fine = (points >= F.greatest(F.lit(bound), full - W_HIDDEN - at_risk)) & (points < below)
            return once(_cycles_of(rows.where(fine & in_months(hops)), hops))

        parts.append(linked)

    if time_budget_s is None:  # the sweep and the arcs need nothing of each other
        made = side_by_side(spark, [lambda part=part: [part(hops) for hops in lengths] for part in parts])
        found = [x for each in made for x in each if x is not None]
        truncated = len(found) < len(parts) * len(lengths)
    else:
        truncated, found = False, []
        try:
            for hops in lengths:
                for part in parts:
                    rows = part(hops)
                    if rows is None:
                        truncated = True
                    else:
                        found.append(budget.write(rows, "found")[0])
        except BudgetSpent:
            truncated = True
    if not found:
        return spark.createDataFrame([], "members array<string>, edges array<struct<src: string, dst: string, period: int, amount: double, vat: double>>, hop_len int"), truncated
    out = found[0]
    for x in found[1:]:
        out = out.unionByName(x)
    return out, truncated


_AT_RISK, _OTHER = "0", "1"  # put before the names of companies while cycles are looked for


def _ranked(rows: DataFrame, risky: DataFrame | None, columns: tuple[str, ...] = ("src", "dst")) -> DataFrame:
    """``rows`` with companies at risk before all others in the order of names; of edges also ``risk``, whether their seller is (0 or 1)."""
    for c in columns:
        if risky is not None:
            rows = rows.join(risky.select(F.col("mst").alias(c), F.lit(1).alias(f"_{c}")).distinct(), c, "left")
        rows = rows.withColumn(f"_{c}", F.coalesce(F.col(f"_{c}"), F.lit(0)) if risky is not None else F.lit(0))
    rows = rows.withColumns({c: F.concat(F.when(F.col(f"_{c}") == 1, _AT_RISK).otherwise(_OTHER), F.col(c)) for c in columns})
    return rows.withColumnRenamed("_src", "risk").drop(*[f"_{c}" for c in columns])


def refreshed(stored: DataFrame, trades: DataFrame, period_from: int, period_to: int, months: list[int], **how) -> tuple[DataFrame, bool]:
    """``search_cycles`` after the trades of some months have been replaced, from what it ``stored`` before.

    Cycles without an edge in these months stay as they are; the others are
    looked for anew. Window, bounds and signals must be those of the stored
    search.
    """
    kept = stored.where(~F.exists("edges", lambda e: e["period"].isin(months))).select("members", "edges", "hop_len")
    new, truncated = search_cycles(trades, period_from, period_to, months=months, **how)
    return kept.unionByName(new), truncated


def _in_twos(groups: DataFrame) -> DataFrame:
    """Groups of two members and more; the others link nothing."""
    rows = groups.select("mst", "grp").distinct()
    return rows.join(rows.groupBy("grp").count().where("count > 1").select("grp"), "grp", "left_semi")


def within_member_bound(found: DataFrame, hidden: DataFrame | None, risky: DataFrame | None) -> DataFrame:
    """Those of ``found`` that can be red: balance + time >= 50, less 25 with a hidden pair among the members and 15 with a company at risk."""
    need = F.lit(RED - W_VAT)
    found = materialise(found, "cycles")  # read by each signal
    rows = found.withColumn("cycle_id", F.array_join("members", "|"))
    for name, signal, points in (("_hidden", hidden, W_HIDDEN), ("_risky", risky, W_RISKY)):
        if signal is not None:
            rows = rows.join(flagged_members(found, signal, name), "cycle_id", "left")
            need = need - F.when(F.col(name), points).otherwise(0.0)
    parts = components_of(F.col("edges"))
    return rows.where(parts["score_balance"] + parts["score_time"] >= need).select(*found.columns)


def fixed_hop_cycles(trades: DataFrame, period_from: int, period_to: int, hops: int, most_seeds: int | None = None, per_seed: int | None = None) -> DataFrame:
    """(members, edges, hop_len) of cycles through each seed, one for each member that is a seed; no bound.

    With ``per_seed`` only so many a seed are kept, by their members and months.
    """
    if most_seeds is None:  # whoever is on a cycle buys and sells: each cycle is found once, from its smallest company, and turned
        found, _ = search_cycles(trades, period_from, period_to, bound=float("-inf"), only=hops)
        turned = found.withColumn("_at", F.explode(F.sequence(F.lit(0), F.lit(hops - 1))))
        turn = lambda c: F.concat(F.slice(c, F.col("_at") + 1, F.lit(hops)), F.slice(c, F.lit(1), F.col("_at"))).alias(c)
        closed = turned.select(turn("members"), turn("edges"), "hop_len")
    else:
        edges = window_of(trades, period_from, period_to)
        paths = edges.join(seeds(edges, most_seeds), edges["seller_mst"] == F.col("mst"), "left_semi").select(F.array("seller_mst", "buyer_mst").alias("members"), F.array(_edge()).alias("edges"), F.col("seller_mst").alias("start"), F.col("buyer_mst").alias("last"))
        for _ in range(hops - 2):
            paths = paths.join(edges, (F.col("last") == F.col("seller_mst")) & ~F.array_contains("members", F.col("buyer_mst")))
            paths = paths.select(F.concat("members", F.array("buyer_mst")).alias("members"), F.concat("edges", F.array(_edge())).alias("edges"), "start", F.col("buyer_mst").alias("last"))
        closed = paths.join(edges, (F.col("last") == F.col("seller_mst")) & (F.col("start") == F.col("buyer_mst")))
        closed = closed.select("members", F.concat("edges", F.array(_edge())).alias("edges"), F.lit(hops).alias("hop_len"))
    if per_seed is None:
        return closed
    order = W.partitionBy(F.col("members")[0]).orderBy("members", F.transform("edges", lambda e: e["period"]))
    return closed.withColumn("_n", F.row_number().over(order)).where(F.col("_n") <= per_seed).drop("_n")


def canonical(cycles: DataFrame) -> DataFrame:
    """Members and edges turned so that the smallest member comes first; the direction stays."""
    at = F.array_position("members", F.array_min("members")).cast("int")
    turn = lambda c: F.when(F.col("_at") == 1, F.col(c)).otherwise(F.concat(F.slice(c, F.col("_at"), F.size(c) - F.col("_at") + 1), F.slice(c, 1, F.col("_at") - 1)))
    return cycles.withColumn("_at", at).withColumns({"members": turn("members"), "edges": turn("edges")}).drop("_at")


def best_combinations(cycles: DataFrame, turn: bool = True) -> DataFrame:
    """One row for each member list: the months with the best balance + time + vat, then the smallest months and amounts.

    ``turn``: off for cycles that start with their smallest member, as those of ``search_cycles`` do.
    """
    parts = components_of(F.col("edges"))
    total = parts["score_balance"] + parts["score_time"] + parts["score_vat"]
    rank = F.struct(-total, F.transform("edges", lambda e: e["period"]), F.transform("edges", lambda e: e["amount"]))
    return (canonical(cycles) if turn else cycles).groupBy("members", "hop_len").agg(F.min_by("edges", rank).alias("edges"))


def _reached(hops: DataFrame | None, ends: DataFrame, most: int, marked: DataFrame) -> DataFrame:
    """(src, dst, depth): the fewest of ``most`` hops at most from each of ``ends`` (src) to each company that is ``marked`` (mst)."""
    marked = marked.select(F.col("mst").alias("dst")).distinct()
    level = ends.select("src", F.col("src").alias("v"))
    seen = out = None
    for depth in range(1, most + 1):
        step = level.join(hops.select(F.col("src").alias("v"), F.col("dst").alias("w")), "v").select("src", F.col("w").alias("v")).distinct()
        level = step if depth == most and seen is None else materialise(step if seen is None else step.join(seen, ["src", "v"], "left_anti"), "reached")
        seen = level if seen is None else seen.unionByName(level)
        hit = level.withColumnRenamed("v", "dst").join(marked, "dst", "left_semi").select("src", "dst", F.lit(depth).alias("depth"))
        out = hit if out is None else out.unionByName(hit)
    return ends.select("src", F.col("src").alias("dst"), F.lit(0).alias("depth")).where("false") if out is None else out


def within_path_bound(cycles: DataFrame, trades: DataFrame, hidden: DataFrame | None, risky: DataFrame | None, max_hops: int) -> DataFrame:
    """Of unpruned cycles those that a search with a bound for each path gives out.

    balance + time >= 50 - 25 H - 15 R, where H says that a pair of members is
    hidden, or a company of some hidden pair outside the cycle can be reached
    from its last member in the hops that are left; R is the same for risk.
    hidden: pairs (company_a, company_b), or groups (mst, grp).
    """
    groups = None if hidden is None else _in_twos(hidden if "grp" in hidden.columns else groups_of_pairs(hidden))
    found = materialise(cycles, "cycles")  # read by each signal
    rows = canonical(found).withColumn("cycle_key", F.concat_ws("|", F.col("members"), F.transform("edges", lambda e: e["period"].cast("string"))))
    flat = rows.select("cycle_key", "members", F.element_at("members", -1).alias("src"), (max_hops - F.col("hop_len")).alias("left"))
    # only as far as the shortest cycle leaves hops, and only from last members
    most = flat.agg(F.coalesce(F.max("left"), F.lit(0)).alias("n")).first()["n"]
    ends = materialise(flat.select("src").distinct(), "ends")
    hops = materialise(trades.select(F.col("seller_mst").alias("src"), F.col("buyer_mst").alias("dst")).distinct(), "hops") if most > 0 else None
    flags = {}
    for name, marked, linked in (("_h", None if groups is None else groups.select("mst").distinct(), groups), ("_r", risky, None)):
        if marked is None:
            continue
        near = flat.join(_reached(hops, ends, most, marked), "src").where((F.col("depth") <= F.col("left")) & ~F.array_contains("members", F.col("dst"))).select("cycle_key")
        each = flat.select("cycle_key", F.explode("members").alias("mst"))
        inside = (each.join(marked, "mst", "left_semi") if linked is None else each.join(linked, "mst").groupBy("cycle_key", "grp").count().where("count > 1")).select("cycle_key")
        flags[name] = near.union(inside).distinct().withColumn(name, F.lit(True))
    need = F.lit(50.0)
    for name, points in (("_h", 25.0), ("_r", 15.0)):
        if name in flags:
            rows = rows.join(flags[name], "cycle_key", "left")
            need = need - F.when(F.col(name), points).otherwise(0.0)
    parts = components_of(F.col("edges"))
    return rows.where(parts["score_balance"] + parts["score_time"] >= need).select(*cycles.columns)
