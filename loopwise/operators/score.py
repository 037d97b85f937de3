"""The five signals of a cycle and their sum."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import month_index
from ..scratch import materialise

W_BALANCE, W_TIME, W_HIDDEN, W_RISKY, W_VAT = 30.0, 20.0, 25.0, 15.0, 10.0
RED, WATCH = 60.0, 40.0


def balance_of(low: Column, high: Column) -> Column:
    """Full from a ratio of 0.8 on, none below 0.3, in proportion between."""
    ratio = F.when(high == 0, F.lit(0.0)).otherwise(low / F.when(high == 0, F.lit(1.0)).otherwise(high))
    return F.when(ratio >= 0.8, F.lit(W_BALANCE)).otherwise(F.greatest(F.lit(0.0), W_BALANCE * (ratio - 0.3) / 0.5))


def time_of(first: Column, last: Column) -> Column:
    """Full within neighbouring months, 5 points less for each month of the span beyond."""
    span = last - first
    return F.when(span <= 1, F.lit(W_TIME)).otherwise(F.greatest(F.lit(0.0), W_TIME - 5.0 * span))


def vat_of(edges: Column) -> Column:
    """10 points if a tax rate lies more than 0.03 from the upper median of the cycle's rates."""
    paid = F.filter(edges, lambda e: e["amount"] != 0)
    rates = F.array_sort(F.transform(paid, lambda e: e["vat"] / e["amount"]))
    middle = F.try_element_at(rates, (F.floor(F.size(rates) / 2) + 1).cast("int"))
    return F.when(F.exists(rates, lambda r: F.abs(r - middle) > 0.03), F.lit(W_VAT)).otherwise(F.lit(0.0))


def components_of(edges: Column) -> dict[str, Column]:
    """score_balance, score_time and score_vat of an array of (src, dst, period, amount, vat)."""
    amounts = F.transform(edges, lambda e: e["amount"])
    months = F.transform(edges, lambda e: month_index(e["period"]))
    return {
        "score_balance": balance_of(F.array_min(amounts), F.array_max(amounts)),
        "score_time": time_of(F.array_min(months), F.array_max(months)),
        "score_vat": vat_of(edges),
    }


def prune_bound(has_hidden: bool, has_risky: bool, no_prune: bool = False) -> float:
    """The least balance + time with which a cycle can still get to a red score."""
    if no_prune:
        return float("-inf")
    return RED - W_VAT - (W_HIDDEN if has_hidden else 0.0) - (W_RISKY if has_risky else 0.0)


def flagged_members(cycles: DataFrame, signal: DataFrame, name: str) -> DataFrame:
    """(cycle_id, ``name`` = true) of cycles with a member of ``signal`` (mst), two members of one of its groups (mst, grp), or a pair of members in it (company_a < company_b).

    Members are exploded once for each different list of them and joined to
    the signal by key; the rows are cycles times members (and their groups), or
    pairs of members.
    """
    members = cycles.select(F.array_join("members", "|").alias("cycle_id"), "members").distinct().select("cycle_id", "members", F.explode("members").alias("mst"))
    if "company_a" in signal.columns:
        pairs = members.select("cycle_id", F.col("mst").alias("company_a"), F.explode("members").alias("company_b")).where("company_a < company_b")
        hit = pairs.join(signal, ["company_a", "company_b"], "left_semi")
    elif "grp" in signal.columns:
        hit = members.join(signal.select("mst", "grp").distinct(), "mst").groupBy("cycle_id", "grp").count().where("count > 1")
    else:
        hit = members.join(signal, "mst", "left_semi")
    return hit.select("cycle_id").distinct().withColumn(name, F.lit(True))


def _both_signals(cycles: DataFrame, groups: DataFrame, risky: DataFrame) -> DataFrame:
    """(cycle_id, _hidden, _risky) of cycles with two members of a group or a member at risk; risk is a group that needs one member."""
    members = cycles.select(F.array_join("members", "|").alias("cycle_id"), F.explode("members").alias("mst"))
    signals = groups.select("mst", "grp").unionByName(risky.select("mst", F.lit(None).cast("string").alias("grp"))).distinct()
    hits = members.join(signals, "mst").groupBy("cycle_id", "grp").count().where("grp is null or count > 1")
    return hits.groupBy("cycle_id").agg(F.max(F.col("grp").isNotNull()).alias("_hidden"), F.max(F.col("grp").isNull()).alias("_risky"))


def score_cycles(cycles: DataFrame, hidden: DataFrame | None = None, risky: DataFrame | None = None) -> DataFrame:
    """All scores of deduplicated cycles (members, edges, hop_len)."""
    cycles = materialise(cycles, "best-cycles")  # read by the signals too
    rows = cycles.withColumn("cycle_id", F.array_join("members", "|")).withColumns(components_of(F.col("edges")))
    if hidden is not None and "grp" in hidden.columns and risky is not None:  # one pass over the members for both
        rows = rows.join(_both_signals(cycles, hidden, risky), "cycle_id", "left")
    else:
        for name, signal in (("_hidden", hidden), ("_risky", risky)):
            rows = rows.withColumn(name, F.lit(None).cast("boolean")) if signal is None else rows.join(flagged_members(cycles, signal, name), "cycle_id", "left")
    rows = rows.withColumn("score_hidden_link", F.when(F.col("_hidden"), F.lit(W_HIDDEN)).otherwise(F.lit(0.0))).withColumn("score_risky_member", F.when(F.col("_risky"), F.lit(W_RISKY)).otherwise(F.lit(0.0)))
    three = F.col("score_balance") + F.col("score_time") + F.col("score_vat")
    one = lambda c: F.bround(c, 1)
    return rows.select(
        "cycle_id",
        "members",
        "hop_len",
        one(F.col("score_balance") + F.col("score_time") + F.col("score_hidden_link") + F.col("score_risky_member") + F.col("score_vat")).alias("score"),
        one(three).alias("score_60"),
        one(F.col("score_balance")).alias("score_balance"),
        one(F.col("score_time")).alias("score_time"),
        "score_hidden_link",
        "score_risky_member",
        one(F.col("score_vat")).alias("score_vat"),
        F.transform("edges", lambda e: e["amount"]).alias("amounts"),
        F.transform("edges", lambda e: e["period"]).alias("periods"),
        "edges",
    )


def best_scores(cycles: DataFrame, hidden: DataFrame, risky: DataFrame, most: int = 5) -> DataFrame:
    """(members, score) of each list of at most ``most`` members: the scores that ``best_combinations`` and ``score_cycles`` give, where edges aren't asked for.

    Of all months of a list two numbers are sent on, its most points with and
    without those for tax rates. hidden: groups (mst, grp). The signals of a
    company are joined to its place in the list, so no member is sent on its own.
    """
    parts = components_of(F.col("edges"))
    rows = cycles.select("members", (parts["score_balance"] + parts["score_time"]).alias("points"), parts["score_vat"].alias("vat"))
    rows = rows.groupBy("members").agg(*[F.max(F.when(F.col("vat") == vat, F.col("points"))).alias(name) for name, vat in (("_plain", 0.0), ("_taxed", W_VAT))])
    signals = hidden.select("mst", "grp", F.lit(False).alias("risk")).unionByName(risky.select("mst", F.lit(None).cast("string").alias("grp"), F.lit(True).alias("risk")))
    signals = materialise(signals.groupBy("mst").agg(F.collect_set("grp").alias("groups"), F.max("risk").alias("risk")), "signals")
    for i in range(most):
        of = signals.select(F.col("mst").alias(f"_m{i}"), F.col("groups").alias(f"_g{i}"), F.col("risk").alias(f"_r{i}"))
        rows = rows.join(of, F.try_element_at("members", F.lit(i + 1)) == F.col(f"_m{i}"), "left")
    groups = F.concat(*[F.coalesce(f"_g{i}", F.array().cast("array<string>")) for i in range(most)])
    linked = F.size(groups) > F.size(F.array_distinct(groups))  # those of one company differ
    at_risk = F.greatest(*[F.coalesce(f"_r{i}", F.lit(False)) for i in range(most)])
    member_points = F.when(linked, F.lit(W_HIDDEN)).otherwise(F.lit(0.0)), F.when(at_risk, F.lit(W_RISKY)).otherwise(F.lit(0.0))
    whole = lambda c, vat: F.bround(F.col(c) + member_points[0] + member_points[1] + F.lit(vat), 1)
    return rows.select("members", F.greatest(whole("_plain", 0.0), whole("_taxed", W_VAT)).alias("score"))


def level(score: Column) -> Column:
    return F.when(score >= RED, F.lit("red")).when(score >= WATCH, F.lit("watch")).otherwise(F.lit("skip"))


def level_summary(scored: DataFrame, has_hidden: bool, has_risky: bool) -> DataFrame:
    """One row: cycles in all and by level, the best score, and the score the data could reach at most.

    Counts are those of ``scored``: of a search with a bound, only what can be
    red; all cycles to watch and below come from one without (``no_prune``).
    """
    most = W_BALANCE + W_TIME + W_VAT + (W_HIDDEN if has_hidden else 0) + (W_RISKY if has_risky else 0)
    return scored.agg(
        F.count("*").alias("total"),
        F.count_if(F.col("score") >= RED).alias("red"),
        F.count_if((F.col("score") >= WATCH) & (F.col("score") < RED)).alias("watch"),
        F.count_if(F.col("score") < WATCH).alias("skipped"),
        F.coalesce(F.max("score"), F.lit(0.0)).alias("top_score"),
        F.lit(most).alias("max_achievable_score"),
    )
