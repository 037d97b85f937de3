"""Mixing sources to target weights by soft membership, with DataFrame operations alone.

A naive Bayes classifier, fitted on a labelled table, gives each document a
posterior over domains. Projected gradient least squares then finds
nonnegative document rates whose expected tokens of each domain match targets.
"""

from __future__ import annotations

import logging
import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import materialise

log = logging.getLogger(__name__)

#: Share of expected tokens wanted of each domain that the labels table tells apart.
TARGETS = {"clean": 0.95, "poor": 0.03, "toxic": 0.02}
BUCKETS = 1 << 16
SPACE = "[\\x20\\x09-\\x0D]+"


def label_domains(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of the labels table: toxic, else poor or clean by quality; unlabelled rows are left out."""
    domain = F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "poor").when(F.col("quality") == 1, "clean")
    return labels.select("doc_id", domain.alias("domain")).where("doc_id is not null and domain is not null")


def _with_features(rows: DataFrame) -> DataFrame:
    """``rows`` with n_tokens (words of its column text) and f, its different features: lower-cased words and marks for bins of structure statistics."""
    text = F.coalesce(F.col("text"), F.lit(""))
    words = F.array_remove(F.split(F.lower(text), SPACE), "")
    number = lambda chars: F.length(F.regexp_replace(text, f"[^{chars}]+", ""))
    rows = rows.withColumns({"f_words": words, "f_chars": F.length(text), "f_symbols": number("#*$%&|<>!"), "f_capitals": number("A-Z"), "f_digits": number("0-9")})
    rows = rows.withColumns({"n_tokens": F.size("f_words").cast("long"), "f_lower": F.array_distinct("f_words")})
    n, chars = F.greatest(F.col("n_tokens"), F.lit(1)), F.greatest(F.col("f_chars"), F.lit(1))
    share = lambda count: F.floor(F.log2(1 + 1000 * count / chars)).cast("string")
    marks = F.array(
        F.concat(F.lit("\x00variety "), F.floor(10 * F.size("f_lower") / n).cast("string")),
        F.concat(F.lit("\x00symbols "), share(F.col("f_symbols"))),
        F.concat(F.lit("\x00capitals "), share(F.col("f_capitals"))),
        F.concat(F.lit("\x00digits "), share(F.col("f_digits"))),
        F.concat(F.lit("\x00length "), F.floor(chars / n).cast("string")),
    )
    return rows.withColumn("f", F.concat("f_lower", marks)).drop("f_words", "f_chars", "f_symbols", "f_capitals", "f_digits", "f_lower")


def _bucket(feature: Column) -> Column:
    return F.pmod(F.xxhash64(feature), F.lit(BUCKETS)).cast("int")


def calibrated(scores: list, truth: list[int], start: tuple[float, ...] = (1.0,), ridge: tuple[float, float] = (0.1, 1.0)) -> tuple[float | list[float], list[float]]:
    """(scale, or scales of several kinds, shifts) that make exp(sum of scale * evidence + shift) the likeliest posteriors of some held-out rows.

    scores: of each row, for each domain, its evidence of one or several kinds.
    Multinomial logistic regression of one scale for each kind and a shift for
    each domain, by damped Newton steps; the ridge (of scales, of shifts)
    towards ``start`` and 0 decides where rows are few.
    """
    if not truth:
        return start[0] if len(start) == 1 else list(start), []
    x, y = np.array(scores, float), np.eye(len(scores[0]))[truth]
    x = x.reshape(len(x), y.shape[1], -1)
    domains, kinds = x.shape[1:]
    at = np.concatenate((np.array(start[:kinds], float), np.zeros(domains)))
    base, weight = at.copy(), np.concatenate((np.full(kinds, ridge[0]), np.full(domains, ridge[1])))
    basis = np.concatenate((x, np.broadcast_to(np.eye(domains), (len(x), domains, domains))), axis=2)  # d score / d parameter

    def loss(v):
        z = basis @ v
        top = z.max(axis=1)
        return float((top + np.log(np.exp(z - top[:, None]).sum(axis=1)) - (z * y).sum(axis=1)).sum() + (weight * (v - base) ** 2).sum() / 2)

    for _ in range(50):
        z = basis @ at
        p = np.exp(z - z.max(axis=1, keepdims=True))
        p /= p.sum(axis=1, keepdims=True)
        slope = np.einsum("nk,nkj->j", p - y, basis) + weight * (at - base)
        mean = np.einsum("nk,nkj->nj", p, basis)
        curve = np.einsum("nk,nki,nkj->ij", p, basis, basis) - np.einsum("ni,nj->ij", mean, mean) + np.diag(weight)
        move, size = np.linalg.solve(curve, slope), 1.0
        while loss(at - size * move) > loss(at) and size > 1e-6:
            size /= 2
        at = at - size * move
        if np.abs(size * move).max() < 1e-6:
            break
    scales = np.maximum(at[:kinds], 0.0).tolist()
    return scales[0] if len(start) == 1 else scales, at[kinds:].tolist()


def domain_posteriors(docs: DataFrame, labelled: DataFrame, domains: list[str], fit_rows: int = 20_000, strength: float = 100.0, least_weight: float = 0.2) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>...) for each row of ``docs`` (doc_id, text).

    labelled: (doc_id, domain). The classifier is fitted on at most
    ``fit_rows`` labelled documents, the first by a hash of their id; a
    document labelled twice counts with its first domain by name, and of rows
    with one id one text counts. Two thirds of them give the weights: log
    ratios of shares of documents that have a feature bucket, shrunk to the
    overall share with ``strength`` documents (a fifth of them, if fewer); those under
    ``least_weight`` are noise and dropped. A document's evidence for a
    domain is of three kinds: the sum of its weights over the root of how many
    features it has, as features repeat each other; its largest weight, as one
    telling word may decide; and the sum of the weights of its structure marks.
    The last third, by another hash, weighs the kinds and calibrates the
    posteriors (see ``calibrated``). Posteriors are rounded to
    three digits. Without labelled documents all domains are alike.
    """
    sample = labelled.where(F.col("domain").isin(domains)).groupBy("doc_id").agg(F.min("domain").alias("domain")).orderBy(F.xxhash64("doc_id"), "doc_id").limit(fit_rows)
    sample = materialise(sample.withColumnRenamed("doc_id", "l_id"), "labelled")  # at most fit_rows rows: bounded for the broadcast
    known = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").join(F.broadcast(sample), F.col("doc_id") == F.col("l_id"))
    known = known.groupBy("l_id", "domain").agg(F.min("text").alias("text")).withColumn("held", F.pmod(F.xxhash64("l_id", F.lit(3)), F.lit(3)) == 0)
    # explode_outer, as Spark would put a filter on what explode() takes, and with it the features, below the join
    has = _with_features(known).select("l_id", "domain", "held", F.explode_outer("f").alias("f"))
    mark = F.coalesce(F.col("f").startswith("\x00"), F.lit(False)).alias("mark")
    has = materialise(has.select("l_id", "domain", "held", _bucket(F.col("f")).alias("bucket"), mark), "labelled-features")
    per = has.where("not held").select("l_id", "domain").distinct().groupBy("domain").count()
    size = {r["domain"]: r["count"] for r in per.collect()}  # one row for each domain
    total = max(1, sum(size.values()))
    strength = min(strength, total / 5)  # few labels must still be able to say something
    of = lambda d: F.count_if(F.col("domain") == d)
    table = has.where("not held").groupBy("bucket").agg(*[of(d).alias(f"c{k}") for k, d in enumerate(domains)])
    overall = sum((F.col(f"c{k}") for k in range(len(domains))), F.lit(0.0)) / total
    logs = [F.log((F.col(f"c{k}") + strength * overall) / (size.get(d, 0) + strength)) for k, d in enumerate(domains)]
    mean = sum(logs, F.lit(0.0)) / len(domains)
    weights = table.select("bucket", *[(x - mean).alias(f"w{k}") for k, x in enumerate(logs)])
    weights = weights.where(F.greatest(*[F.abs(f"w{k}") for k in range(len(domains))]) >= least_weight)
    weights = materialise(weights, "domain-weights")  # at most BUCKETS rows
    prior = [math.log((size.get(d, 0) + 1) / (total + len(domains))) for d in domains]
    root = F.sqrt(F.count("*"))
    evidence = []
    for k in range(len(domains)):
        w = F.col(f"w{k}")
        evidence += [(F.coalesce(F.sum(w), F.lit(0.0)) / root + prior[k]).alias(f"s{k}0"), F.coalesce(F.max(w), F.lit(0.0)).alias(f"s{k}1"), F.coalesce(F.sum(F.when(F.col("mark"), w)), F.lit(0.0)).alias(f"s{k}2")]
    held = has.where("held").join(F.broadcast(weights), "bucket", "left").groupBy("l_id", "domain").agg(*evidence).collect()  # at most fit_rows rows
    kinds = (1.0, 0.0, 0.0)
    scale, shift = calibrated([[[r[f"s{k}{e}"] for e in range(len(kinds))] for k in range(len(domains))] for r in held], [domains.index(r["domain"]) for r in held], kinds)
    each = _with_features(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.monotonically_increasing_id().alias("uid")))
    each = each.select("uid", "doc_id", "n_tokens", F.explode_outer("f").alias("f")).select("uid", "doc_id", "n_tokens", _bucket(F.col("f")).alias("bucket"), mark)
    scored = each.join(F.broadcast(weights), "bucket", "left").groupBy("uid", "doc_id", "n_tokens").agg(*evidence)
    score = [sum((x * F.col(f"s{k}{e}") for e, x in enumerate(scale)), F.lit(shift[k] if shift else 0.0)) for k in range(len(domains))]
    top = F.greatest(*score)
    odds = [F.exp(x - top) for x in score]
    whole = sum(odds, F.lit(0.0))
    return scored.select("doc_id", "n_tokens", *[F.round(x / whole, 3).alias(f"p_{d}") for d, x in zip(domains, odds, strict=True)])


def _bounds(domains: list[str], most: float | None, keep: str | None) -> tuple[Column, Column]:
    """The least and largest rate of a row: at least 1 where ``keep`` is the likeliest domain."""
    least = F.lit(0.0) if keep is None else F.when(F.col(f"p_{keep}") >= F.greatest(*[F.col(f"p_{d}") for d in domains]), 1.0).otherwise(0.0)
    return least, F.lit(math.inf if most is None else float(most))


def _rate(domains: list[str], bounds: tuple[Column, Column], history: list[list[float]]) -> Column:
    """The rate after the gradient steps in ``history``, from 1 on, put back into its bounds after each."""
    if not history:
        return F.lit(1.0)
    least, most = bounds

    def once(r, g):
        return F.least(most, F.greatest(least, r - sum((F.col(f"p_{d}") * F.element_at(g, k + 1) for k, d in enumerate(domains)), F.lit(0.0))))

    return F.aggregate(F.array(*[F.array(*map(F.lit, x)) for x in history]), F.lit(1.0), once)


def mixing_rates(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] | None = None, budget: float | None = None, max_rate: float | None = None, tolerance: float = 2e-3, most_steps: int = 40, keep: str | None = None) -> DataFrame:
    """(doc_id, n_tokens, p_<domain>..., rate, largest_miss, dropped): how often to take each row of ``docs`` (doc_id, text).

    targets: the share of each domain; budget: expected tokens in all (None:
    as many as there are; with ``max_rate`` at most as many as the scarcest
    domain allows; with ``keep`` as many as give that domain's tokens its share).
    A domain without tokens has share 0. With ``keep``, documents whose
    likeliest domain it is have rates of 1 and more, and the target of a domain
    that is too scarce is what there is of it.

    Rates r >= 0 (and <= max_rate) minimise the squared miss of the shares
    (sum_i n_i p_id r_i) / budget - t_d by projected gradient steps from 1 on,
    one aggregate each. The miss is measured in the metric in which one step
    would settle it if the rates that are free to move stayed so; a step that
    doesn't lower the largest miss halves the next ones. A step changes rates
    by their posteriors alone, so the steps run over one row for each
    different posterior (rounded to three digits, so their number is bounded),
    and a document's rate is the fold of its posterior over the steps. Steps
    end when all targets are met within ``tolerance``, when several brought no
    gain, or after ``most_steps``. ``largest_miss`` is the same in all rows:
    how far the worst share is from its target; where that is over
    ``tolerance``, a warning tells all of them. ``dropped``, too: the share of
    the expected tokens of the domain with the largest target that is in
    documents of rate 0.

    Null and empty texts have no tokens and get the rate of their posterior;
    null and repeated ids keep their rows; other columns are ignored. An empty
    table gives an empty result.
    """
    targets = targets or TARGETS
    domains = sorted(targets)
    share = {d: targets[d] / sum(targets.values()) for d in domains}
    post = materialise(domain_posteriors(docs, labelled, domains), "posteriors")
    names = [f"p_{d}" for d in domains]
    groups = materialise(post.groupBy(*names).agg(F.sum("n_tokens").alias("tokens")).where("tokens > 0"), "posterior-groups")
    first = groups.agg(F.sum("tokens").alias("all"), *[F.sum(F.col("tokens") * F.col(p)).alias(p) for p in names]).first()
    bounds = _bounds(domains, max_rate, keep)
    best: tuple[float, list[list[float]]] = (0.0, [])
    if first["all"]:
        total = float(first["all"])
        mass = {d: float(first[p]) for d, p in zip(domains, names, strict=True)}
        there = sum(share[d] for d in domains if mass[d])
        share = {d: share[d] / there if mass[d] else 0.0 for d in domains} if there else {d: mass[d] / total for d in domains}
        if budget is None:
            if keep is not None:
                budget = mass[keep] / share[keep] if share[keep] else total
            else:
                budget = total if max_rate is None else min(max_rate * mass[d] / share[d] for d in domains if share[d])
        budget = max(float(budget), 1.0)
        if keep is not None:
            share = {d: min(share[d], (max_rate or math.inf) * mass[d] / budget) for d in domains}
        best = _descend(groups, domains, share, budget, bounds, tolerance, most_steps)
    main = F.col("tokens") * F.col(f"p_{max(domains, key=lambda d: (targets[d], d))}")
    gone = groups.agg(F.try_divide(F.sum(F.when(_rate(domains, bounds, best[1]) == 0, main).otherwise(0.0)), F.sum(main)).alias("x")).first()["x"]
    return post.withColumns({"rate": _rate(domains, bounds, best[1]), "largest_miss": F.lit(best[0]), "dropped": F.lit(float(gone or 0.0))})


def _descend(groups: DataFrame, domains: list[str], share: dict[str, float], budget: float, bounds: tuple[Column, Column], tolerance: float, most_steps: int) -> tuple[float, list[list[float]]]:
    """(largest miss, steps) of the best rates found."""
    names = [f"p_{d}" for d in domains]
    pairs = [(i, j) for i in range(len(domains)) for j in range(i, len(domains))]
    history: list[list[float]] = []
    best, off, size, idle = (math.inf, []), None, 1.0, 0
    told = {}
    for step in range(most_steps + 1):
        rows = groups.select(*names, "tokens", _rate(domains, bounds, history).alias("r"), bounds[0].alias("least"), bounds[1].alias("most"))
        push = sum((F.col(p) * x for p, x in zip(names, off, strict=True)), F.lit(0.0)) if off is not None else F.lit(0.0)
        free = ~(((F.col("r") <= F.col("least")) & (push > 0)) | ((F.col("r") >= F.col("most")) & (push < 0)))
        moved = F.when(free, F.col("tokens")).otherwise(0)
        got = rows.agg(*[F.sum(F.col("tokens") * F.col(p) * F.col("r")).alias(p) for p in names], *[F.sum(moved * F.col(names[i]) * F.col(names[j])).alias(f"{i} {j}") for i, j in pairs]).first()
        off = [got[p] / budget - share[d] for p, d in zip(names, domains, strict=True)]
        miss = max(map(abs, off))
        if miss < 0.99 * best[0]:
            best, idle = (miss, list(history)), 0
            told = dict(zip(domains, off, strict=True))
        else:
            size, idle = max(size / 2, 0.1), idle + 1
        if miss < tolerance or idle >= 6 or step == most_steps:
            break
        square = np.zeros((len(domains), len(domains)))
        for i, j in pairs:
            square[i, j] = square[j, i] = got[f"{i} {j}"] / budget
        ridge = 1e-3 * np.trace(square) + 1e-9
        history.append((size * np.linalg.solve(square + ridge * np.eye(len(domains)), np.array(off))).tolist())
    if best[0] >= tolerance:
        missed = ", ".join(f"{d} by {x:+.4f}" for d, x in told.items() if abs(x) >= tolerance)
        log.warning("mixing rates %s after %d steps; shares missed: %s", "came to rest, the targets are out of reach," if idle >= 6 else "did NOT settle", step, missed)
    return best


def take_copies(docs: DataFrame, rates: DataFrame, seed: int = 8) -> DataFrame:
    """``docs`` with each row taken floor(rate + u) times, u a hash of its id in [0, 1); columns unchanged.

    rates: (doc_id, rate), one row for each doc_id (repeated ids: their largest rate).
    """
    u = F.pmod(F.xxhash64(F.col("_mix_id"), F.lit(seed)), F.lit(1 << 30)) / F.lit(float(1 << 30))
    copies = rates.groupBy(F.col("doc_id").alias("_mix_id")).agg(F.max("rate").alias("_mix_rate"))
    copies = copies.select("_mix_id", F.floor(F.col("_mix_rate") + u).cast("int").alias("_mix_n")).where("_mix_n > 0")
    # the same plan at every size; one rate a document, so the side that is built is spread like the documents
    joined = docs.join(copies.hint("shuffle_hash"), F.col("doc_id").eqNullSafe(F.col("_mix_id")))
    return joined.withColumn("_mix_k", F.explode(F.sequence(F.lit(1), F.col("_mix_n")))).select(*[docs[c] for c in docs.columns])
