"""Hidden links between companies, and companies at risk."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.text import cutoff_date, normalize_address
from ..scratch import materialise

MAX_ADDRESS_PAIRS = 5_000_000
MAX_PHONE_GROUP = 5
# Registry statuses of companies that have stopped or are not where they say.
RISKY_STATUSES = (
    "Tạm ngừng kinh doanh",
    "Đã giải thể",
    "Đang làm thủ tục giải thể",
    "Không hoạt động tại địa chỉ đã đăng ký",
    "Đã bị thu hồi",
    "Ngừng hoạt động",
    "Tạm nghỉ kinh doanh",
    "Ngừng hoạt động vĩnh viễn",
)
NEW_COMPANY_MONTHS = 12


class TooManyPairs(ValueError):
    pass


def normalized_addresses(companies: DataFrame) -> DataFrame:
    rows = companies.select("mst", normalize_address(F.col("address")).alias("norm_addr"))
    return rows.where(F.length("norm_addr") > 0).distinct()


def pair_guard(groups: DataFrame, key: str) -> DataFrame:
    """One row: how many pairs a self-join on ``key`` would make, and the largest group."""
    sizes = groups.groupBy(key).agg(F.count_distinct("mst").alias("n"))
    return sizes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("n_pairs"), F.max_by(key, F.struct("n", key)).alias("worst"), F.max("n").alias("worst_n"))


def _guard(groups: DataFrame, key: str, most: int) -> None:
    guard = pair_guard(groups, key).first()
    if guard["n_pairs"] > most:
        raise TooManyPairs(f"{guard['n_pairs']} pairs; {guard['worst_n']} companies with {key} {guard['worst']!r}")


def _pairs(groups: DataFrame, key: str) -> DataFrame:
    a, b = groups.alias("a"), groups.alias("b")
    on = (F.col(f"a.{key}") == F.col(f"b.{key}")) & (F.col("a.mst") < F.col("b.mst"))
    return a.join(b, on).select(F.col("a.mst").alias("company_a"), F.col("b.mst").alias("company_b"), F.col(f"a.{key}").alias(key))


def shared_groups(groups: DataFrame) -> DataFrame:
    """(mst, grp, also) of groups of two members and more; also: all of them that a company is in, where it is in several."""
    rows = groups.select("mst", "grp").where("mst is not null and grp is not null").distinct()
    rows = rows.join(rows.groupBy("grp").count().where("count > 1").select("grp"), "grp", "left_semi")
    several = rows.groupBy("mst").agg(F.collect_list("grp").alias("also")).where(F.size("also") > 1)
    return rows.join(several, "mst", "left").select("mst", "grp", "also")


def first_shared(grp: str, a: str, b: str) -> Column:
    """Whether ``grp`` is the first group that two companies share, by ``also`` of each."""
    return F.col(a).isNull() | F.col(b).isNull() | (F.col(grp) == F.array_min(F.array_intersect(a, b)))


def pairs_of_groups(groups: DataFrame, block: int = 1024, most_in_task: int = 1_000_000, once: bool = True) -> DataFrame:
    """(company_a < company_b, grp) of all companies that share a group (mst, grp): each pair once, with the first group that they share, or (not ``once``) with each.

    A pair comes from a group alone, so the pairs are neither shuffled nor
    compared with each other. Groups are cut into blocks of about ``block``
    members, and two blocks meet under one key: what is held at once is a
    block, and the tasks are as many as ``most_in_task`` pairs each ask for.
    """
    rows = materialise(shared_groups(groups), "members")
    sizes = materialise(rows.groupBy("grp").agg(F.count("*").alias("n")), "sizes")
    total = sizes.agg(F.coalesce(F.sum(F.expr("n * (n - 1) div 2")), F.lit(0)).alias("n")).first()["n"]
    tasks = int(total // most_in_task) + 1
    last = sizes.select("grp", ((F.col("n") - 1) / block).cast("int").alias("last"))
    cut = rows.join(last, "grp").withColumn("at", F.pmod(F.xxhash64("mst"), F.col("last") + 1).cast("int"))
    a = cut.select("grp", F.col("at").alias("i"), F.explode(F.sequence("at", "last")).alias("j"), F.col("mst").alias("a"), F.col("also").alias("also_a")).repartition(tasks, "grp", "i", "j")
    b = cut.select("grp", F.explode(F.sequence(F.lit(0), F.col("at"))).alias("i"), F.col("at").alias("j"), F.col("mst").alias("b"), F.col("also").alias("also_b")).repartition(tasks, "grp", "i", "j")
    met = a.join(b, ["grp", "i", "j"]).where((F.col("i") < F.col("j")) | (F.col("a") < F.col("b")))
    if once:
        met = met.where(first_shared("grp", "also_a", "also_b"))
    return met.select(F.least("a", "b").alias("company_a"), F.greatest("a", "b").alias("company_b"), "grp")


def _every_pair(groups: DataFrame, key: str) -> DataFrame:
    return pairs_of_groups(groups.withColumnRenamed(key, "grp"), once=False).withColumnRenamed("grp", key)


def address_pairs(companies: DataFrame, most: int | None = MAX_ADDRESS_PAIRS) -> DataFrame:
    """(company_a < company_b, norm_addr). An input that would make more than ``most`` pairs (None: any number is made) is refused, by the worst address."""
    groups = normalized_addresses(companies)
    if most is not None:
        _guard(groups, "norm_addr", most)
        return _pairs(groups, "norm_addr")
    return _every_pair(groups, "norm_addr")


def phone_pairs(phones: DataFrame, most: int = MAX_PHONE_GROUP) -> DataFrame:
    """(company_a < company_b, norm_phone): numbers shared by at most ``most`` companies; of several the smallest."""
    groups = phones.select("mst", F.col("phone").alias("norm_phone")).distinct()
    small = groups.groupBy("norm_phone").agg(F.count("*").alias("n")).where(F.col("n").between(2, most)).select("norm_phone")
    return _pairs(groups.join(small, "norm_phone"), "norm_phone").groupBy("company_a", "company_b").agg(F.min("norm_phone").alias("norm_phone"))


def representative_pairs(legal_reps: DataFrame, most: int | None = MAX_ADDRESS_PAIRS) -> DataFrame:
    """(company_a < company_b, person_id) of companies with the same person; guarded as addresses are."""
    groups = legal_reps.select("mst", "person_id").distinct()
    if most is not None:
        _guard(groups, "person_id", most)
        return _pairs(groups, "person_id")
    return _every_pair(groups, "person_id")


def unordered(df: DataFrame, a: str, b: str) -> DataFrame:
    return df.where(F.col(a) != F.col(b)).select(F.least(a, b).alias("company_a"), F.greatest(a, b).alias("company_b"))


def hidden_pairs(shares_address: DataFrame | None = None, shares_phone: DataFrame | None = None, legal_reps: DataFrame | None = None, owns: DataFrame | None = None) -> DataFrame | None:
    """Distinct (company_a < company_b) over all the sources that are there; None if none is."""
    parts = [unordered(x, "company_a", "company_b") for x in (shares_address, shares_phone) if x is not None]
    if legal_reps is not None:
        parts.append(unordered(representative_pairs(legal_reps), "company_a", "company_b"))
    if owns is not None:
        parts.append(unordered(owns, "owner", "owned"))
    return reduce(DataFrame.unionByName, parts).distinct() if parts else None


def hidden_groups(addresses: DataFrame | None = None, phones: DataFrame | None = None, legal_reps: DataFrame | None = None, owns: DataFrame | None = None, most_phone: int = MAX_PHONE_GROUP) -> DataFrame | None:
    """(mst, grp): companies of one group are linked to each other; None if there is no source.

    addresses (mst, norm_addr), phones (mst, phone), legal_reps (mst, person_id),
    owns (owner, owned). The same links as ``hidden_pairs`` has, but a group of n
    companies is n rows and not n * (n - 1) / 2 pairs, so none is too large.
    Numbers that more than ``most_phone`` companies share link nothing.
    """
    named = lambda df, kind, key: df.where(F.col(key).isNotNull()).select("mst", F.concat_ws("|", F.lit(kind), F.col(key)).alias("grp")).distinct()
    parts = []
    if addresses is not None:
        parts.append(named(addresses, "address", "norm_addr"))
    if phones is not None:
        few = phones.select("mst", "phone").distinct()
        parts.append(named(few.join(few.groupBy("phone").count().where(F.col("count") <= most_phone).select("phone"), "phone", "left_semi"), "phone", "phone"))
    if legal_reps is not None:
        parts.append(named(legal_reps, "person", "person_id"))
    if owns is not None:
        parts.append(groups_of_pairs(unordered(owns, "owner", "owned")))
    return reduce(DataFrame.unionByName, parts) if parts else None


def groups_of_pairs(pairs: DataFrame) -> DataFrame:
    """(mst, grp): each pair (company_a, company_b) as a group of two."""
    both = pairs.select("company_a", "company_b").where("company_a <> company_b").distinct()
    grp = F.concat_ws("|", F.lit("pair"), F.length("company_a"), "company_a", "company_b")
    return both.select(F.explode(F.array("company_a", "company_b")).alias("mst"), grp.alias("grp"))


def risky_companies(companies: DataFrame, period_from: int) -> DataFrame:
    """(mst) that are new, founded within a year before the window or later, or have a bad status; by the columns that are there."""
    terms = []
    if "is_new_company" in companies.columns:
        terms.append(F.coalesce(F.col("is_new_company"), F.lit(False)))
    if "established_date" in companies.columns:
        terms.append(F.coalesce(F.col("established_date") >= cutoff_date(period_from, NEW_COMPANY_MONTHS), F.lit(False)))
    if "status" in companies.columns:
        terms.append(F.coalesce(F.col("status").isin(*RISKY_STATUSES), F.lit(False)))
    return companies.where(reduce(lambda a, b: a | b, terms, F.lit(False))).select("mst").distinct()
