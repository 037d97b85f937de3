"""One registered query for each operator, with the SQL that gives the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import text as X
from ..operators import components, contract, cycles, edges, flags, links, metrics, paths, score
from ..scratch import materialise, scratch_path, side_by_side
from ..sources import lake, raw, testbed
from ..sources.testbed import PERIOD_FROM as FROM
from ..sources.testbed import PERIOD_TO as TO
from ..sources.testbed import with_views

Tables = dict[str, DataFrame]
QUERIES: dict[str, Callable[[Tables], DataFrame]] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None, *views: str):
    """Register a function of the tables under its name, with its SQL over the named views."""

    def add(f: Callable[[Tables], DataFrame]):
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = with_views(sql, *views) if views else sql
        return f

    return add


FIRST, LAST = 0, 999912  # all months


def _invoices(t: Tables) -> DataFrame:
    """Invoices of the months of the search; from the tables of a folder without a shuffle of all others."""
    return t.invoices_within(FROM, TO) if isinstance(t, testbed.Tables) else _within(t["invoices"])


def _trades(t: Tables) -> DataFrame:
    """Trades of the months of the search."""
    return edges.trade_edges(_invoices(t)) if isinstance(t, testbed.Tables) else _within(t["trades"])


def _window(t: Tables) -> DataFrame:
    return edges.window_of(_trades(t), FROM, TO)


def _every(t: Tables) -> DataFrame:
    return edges.window_of(t["trades"], FIRST, LAST)


W_SQL = f"w AS MATERIALIZED (SELECT * FROM trades WHERE period BETWEEN {FROM} AND {TO})"


def _and_w(sql: str) -> str:
    return f"SELECT * FROM (WITH {W_SQL} {sql})"


def _and_all(sql: str) -> str:
    return f"SELECT * FROM (WITH w AS MATERIALIZED (SELECT * FROM trades) {sql})"


# -- ingest ---------------------------------------------------------------------


@query("SELECT seller_mst, buyer_mst, period, invoice_count, total_amount, total_vat, first_date, last_date FROM trades", "trades")
def trades_edges(t):
    return edges.trade_edges(t["invoices"])


@query(
    """SELECT count(*) AS n_invoices, cast(count(*) FILTER (seller_mst = buyer_mst) AS bigint) AS n_self,
       (SELECT count(*) FROM trades) AS n_edges, min(period) AS period_from, max(period) AS period_to,
       cast(count(*) FILTER (seller_mst <> buyer_mst) AS double) / (SELECT count(*) FROM trades) AS reduction FROM invoices""",
    "trades",
)
def self_trade_stats(t):
    return edges.ingest_summary(t["invoices"])


@query(_and_w("SELECT seller_mst, buyer_mst, period, total_amount, total_vat FROM w"), "trades")
def period_filter(t):
    return _window(t).select("seller_mst", "buyer_mst", "period", "total_amount", "total_vat")


_VALID = "chieu = 'ban' AND mst_ban_goc IS NOT NULL AND mst_mua_goc IS NOT NULL AND ky_hieu_mau_so IN ('1', '2') AND trang_thai_hd NOT IN ('Hóa đơn đã bị thay thế', 'Hóa đơn đã bị xóa bỏ/hủy bỏ')"
_DEDUP = f"""dedup AS (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mst_ban, ky_hieu_mau_so, ky_hieu_hd, so_hd ORDER BY ictrl_dt DESC NULLS LAST,
  einvoice_row_id NULLS FIRST, chieu, mst_ban_goc, mst_mua_goc, trang_thai_hd, ngay_lap, tien_chua_thue, tien_thue) AS n
  FROM einvoice WHERE {_VALID} AND ngay_lap IS NOT NULL) WHERE n = 1)"""


@query(f"SELECT * FROM (WITH {_DEDUP} SELECT einvoice_row_id, mst_ban, ky_hieu_mau_so, ky_hieu_hd, so_hd, tien_chua_thue, tien_thue FROM dedup)", "einvoice")
def latest_invoice_dedup(t):
    return lake.deduped_invoices(t["einvoice"]).select("einvoice_row_id", "mst_ban", "ky_hieu_mau_so", "ky_hieu_hd", "so_hd", "tien_chua_thue", "tien_thue")


@query(
    f"""SELECT * FROM (WITH {_DEDUP} SELECT mst_ban_goc AS seller_mst, mst_mua_goc AS buyer_mst, cast(year(ngay_lap) * 100 + month(ngay_lap) AS int) AS period,
    count(*) AS invoice_count, sum(tien_chua_thue) AS total_amount, sum(tien_thue) AS total_vat, strftime(min(ngay_lap), '%Y-%m-%d') AS first_date, strftime(max(ngay_lap), '%Y-%m-%d') AS last_date
    FROM dedup GROUP BY ALL)""",
    "einvoice",
)
def lake_trades(t):
    return lake.trades(t["einvoice"]).withColumns({c: F.col(c).cast("double") for c in ("total_amount", "total_vat")})


@query(f"SELECT einvoice_row_id, trang_thai_hd, ky_hieu_mau_so FROM einvoice WHERE {_VALID}", "einvoice")
def null_safe_void_filter(t):
    return lake.valid_sales(t["einvoice"]).select("einvoice_row_id", "trang_thai_hd", "ky_hieu_mau_so")


_FILING = "SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY so_lan DESC NULLS LAST, ngay_lap_tkhai DESC NULLS LAST, load_ts DESC NULLS LAST) AS n FROM filings) WHERE n = 1"
_HEADER = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY ictrl_dt DESC NULLS LAST, ten_cong_ty NULLS FIRST, dia_chi NULLS FIRST) AS n FROM header
  WHERE record_status = 'active' AND mst IS NOT NULL) WHERE n = 1"""


@query(f"SELECT mst, ten_nnt, dchi_nnt, so_lan, load_ts FROM ({_FILING})", "filings")
def latest_filing(t):
    return lake.latest_filings(t["filings"]).select("mst", "ten_nnt", "dchi_nnt", "so_lan", "load_ts")


@query(f"SELECT mst, ten_cong_ty, dia_chi, trang_thai FROM ({_HEADER})", "header")
def latest_per_key(t):
    return lake.latest_companies(t["header"]).select("mst", "ten_cong_ty", "dia_chi", "trang_thai")


_REVENUE = """SELECT mst, item_value_num AS revenue FROM (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY ictrl_dt DESC) AS n FROM items
  WHERE item_code = 'Ct10' AND statement_code = 'KQKD' AND period_scope = 'nam_nay') WHERE n = 1"""
_SECTOR = """SELECT mst, ten_nganh AS sector FROM (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY CASE WHEN nganh_chinh THEN 0 ELSE 1 END, ictrl_dt DESC NULLS LAST, ten_nganh) AS n FROM industry
  WHERE mst IS NOT NULL AND ten_nganh IS NOT NULL) WHERE n = 1"""


@query(_REVENUE, "items")
def latest_revenue(t):
    return lake.latest_revenue(t["items"])


@query(_SECTOR, "industry")
def main_sector(t):
    return lake.main_sectors(t["industry"])


def _feature(names: dict[str, str]) -> str:
    inner = f"SELECT *, row_number() OVER (PARTITION BY mst, feature_name ORDER BY fiscal_year DESC NULLS LAST, feature_value_num) AS n FROM features WHERE feature_name IN ({', '.join(repr(k) for k in names)})"
    return f"SELECT mst, {', '.join(f'max(CASE WHEN feature_name = {k!r} THEN feature_value_num END) AS {v}' for k, v in names.items())} FROM ({inner}) WHERE n = 1 GROUP BY mst"


_RISK = {lake.ADJUSTMENT_RATE: "invoice_adjustment_rate", lake.BENFORD: "invoice_benford_chi2"}


@query(_feature(_RISK), "features")
def feature_pivot(t):
    return lake.feature_columns(t["features"], _RISK)


_SCOPE = f"SELECT mst_ban_goc AS mst FROM einvoice WHERE {_VALID} UNION SELECT mst_mua_goc FROM einvoice WHERE {_VALID}"


@query(_SCOPE, "einvoice")
def transacting_keys(t):
    return lake.transacting(t["einvoice"])


@query(f"SELECT mst, ten_cong_ty FROM ({_HEADER}) WHERE mst IN ({_SCOPE})", "header", "einvoice")
def transacting_semi(t):
    return lake.latest_companies(t["header"]).join(lake.transacting(t["einvoice"]), "mst", "left_semi").select("mst", "ten_cong_ty")


@query(
    f"""SELECT mst, coalesce(c.ten_cong_ty, f.ten_nnt) AS name, coalesce(nullif(s.sector, ''), 'Chưa rõ') AS sector, coalesce(c.dia_chi, f.dchi_nnt) AS address, coalesce(r.revenue, 0) AS revenue,
    f.ictrl_dt AS report_date, nullif(c.trang_thai, '') AS status, c.ngay_hoat_dong AS established_date, x.book_tax_gap, i.invoice_adjustment_rate, i.invoice_benford_chi2
    FROM ({_HEADER}) c FULL OUTER JOIN ({_FILING}) f USING (mst) LEFT JOIN ({_REVENUE}) r USING (mst) LEFT JOIN ({_SECTOR}) s USING (mst)
    LEFT JOIN ({_feature({lake.BOOK_TAX_GAP: "book_tax_gap"})}) x USING (mst) LEFT JOIN ({_feature(_RISK)}) i USING (mst)""",
    "header",
    "filings",
    "items",
    "industry",
    "features",
)
def company_merge(t):
    return lake.companies(t["header"], t["filings"], t["items"], t["industry"], t["features"], t["features"])


_NORM = "replace(strip_accents(lower({})), 'đ', 'd')"
_NORM = "trim(regexp_replace(regexp_replace(" + _NORM + r", '[.,;:/()-]+', ' ', 'g'), '\s+', ' ', 'g'))"


def _norm(c: str) -> str:
    out = _NORM.format(c)
    for k, v in X.ABBREVIATIONS.items():
        out = rf"regexp_replace({out}, '\b{k}\s', '{v} ', 'g')"
    return rf"trim(regexp_replace({out}, '\s+', ' ', 'g'))"


@query(f"SELECT doc_id, md5({_norm('text')}) AS norm_md5, length({_norm('text')}) AS n FROM documents")
def normalize_text(t):
    rows = t["documents"].select("doc_id", X.normalize_address(F.col("text")).alias("x"))
    return rows.select("doc_id", F.md5("x").alias("norm_md5"), F.length("x").cast("bigint").alias("n"))


_ADDRESSES = f"SELECT mst, coalesce(c.dia_chi, f.dchi_nnt) AS address FROM ({_HEADER}) c FULL OUTER JOIN ({_FILING}) f USING (mst) WHERE mst IN ({_SCOPE}) AND length(trim(coalesce(c.dia_chi, f.dchi_nnt))) > 10"


@query(_ADDRESSES, "header", "filings", "einvoice")
def lake_addresses(t):
    return lake.addresses(t["header"], t["filings"], lake.transacting(t["einvoice"]))


_G_ADDR = f"(SELECT DISTINCT mst, {_norm('address')} AS norm_addr FROM company WHERE length({_norm('address')}) > 0)"
_P_ADDR = f"SELECT a.mst AS company_a, b.mst AS company_b, a.norm_addr FROM {_G_ADDR} a JOIN {_G_ADDR} b ON a.norm_addr = b.norm_addr AND a.mst < b.mst"


@query(_P_ADDR, "company")
def hidden_pairs_address(t):
    return links.address_pairs(t["company"], most=None)


@query(f"SELECT cast(sum(n * (n - 1) // 2) AS bigint) AS n_pairs, max_by(norm_addr, (n, norm_addr)) AS worst, max(n) AS worst_n FROM (SELECT norm_addr, count(DISTINCT mst) AS n FROM {_G_ADDR} GROUP BY norm_addr)", "company")
def pair_guard(t):
    return links.pair_guard(links.normalized_addresses(t["company"]), "norm_addr")


_LATEST_PHONE = """SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY ictrl_dt DESC NULLS LAST, ten_cong_ty NULLS FIRST) AS n FROM header
  WHERE record_status = 'active' AND mst IS NOT NULL AND length(trim(dien_thoai_tru_so)) >= 9) WHERE n = 1"""
_PHONES = rf"""SELECT DISTINCT mst, phone FROM (SELECT mst, regexp_replace(unnest(string_split_regex(dien_thoai_tru_so, '[/-]')), '[^0-9]', '', 'g') AS phone FROM ({_LATEST_PHONE}) WHERE mst IN ({_SCOPE}))
  WHERE regexp_full_match(phone, '0[0-9]{{9,10}}')"""


@query(_PHONES, "header", "einvoice")
def phone_candidates(t):
    return lake.phones(t["header"], lake.transacting(t["einvoice"]))


_P_PHONE = f"""SELECT a.mst AS company_a, b.mst AS company_b, min(a.phone) AS norm_phone FROM ({_PHONES}) a JOIN ({_PHONES}) b ON a.phone = b.phone AND a.mst < b.mst
  WHERE a.phone IN (SELECT phone FROM ({_PHONES}) GROUP BY phone HAVING count(*) BETWEEN 2 AND 5) GROUP BY ALL"""


@query(_P_PHONE, "header", "einvoice")
def hidden_pairs_phone(t):
    return links.phone_pairs(lake.phones(t["header"], lake.transacting(t["einvoice"])))


_REPS = f"""SELECT sha256({_norm('trim(dai_dien_phap_luat)')})[1:16] AS person_id, trim(dai_dien_phap_luat) AS person_name, mst FROM
  (SELECT *, row_number() OVER (PARTITION BY mst ORDER BY ictrl_dt DESC NULLS LAST, ten_cong_ty NULLS FIRST) AS n FROM header
  WHERE record_status = 'active' AND mst IS NOT NULL AND length(trim(dai_dien_phap_luat)) > 0 AND mst IN ({_SCOPE})) WHERE n = 1"""


@query(_REPS, "header", "einvoice")
def person_id(t):
    return lake.legal_reps(t["header"], lake.transacting(t["einvoice"]))


@query(f"SELECT person_id, arg_max(person_name, mst) AS person_name FROM ({_REPS}) GROUP BY person_id", "header", "einvoice")
def person_upsert(t):
    return lake.persons(lake.legal_reps(t["header"], lake.transacting(t["einvoice"])))


_P_REP = f"SELECT a.mst AS company_a, b.mst AS company_b, a.person_id FROM ({_REPS}) a JOIN ({_REPS}) b ON a.person_id = b.person_id AND a.mst < b.mst"


@query(_P_REP, "header", "einvoice")
def hidden_pairs_rep(t):
    return links.representative_pairs(lake.legal_reps(t["header"], lake.transacting(t["einvoice"])), most=None)


_HIDDEN = f"SELECT DISTINCT company_a, company_b FROM (SELECT company_a, company_b FROM ({_P_ADDR}) UNION ALL SELECT company_a, company_b FROM ({_P_PHONE}) UNION ALL SELECT company_a, company_b FROM ({_P_REP}))"


@query(_HIDDEN, "company", "header", "einvoice")
def hidden_pairs_union(t):
    scope = materialise(lake.transacting(t["einvoice"]), "scope")
    groups = links.hidden_groups(links.normalized_addresses(t["company"]), lake.phones(t["header"], scope), lake.legal_reps(t["header"], scope))
    return links.pairs_of_groups(groups).select("company_a", "company_b")


@query("SELECT DISTINCT seller_mst AS mst FROM trades WHERE seller_mst NOT IN (SELECT mst FROM company WHERE status IS NOT NULL)", "trades", "company")
def external_entities_anti(t):
    return edges.external_companies(t["trades"].select(F.col("seller_mst").alias("mst")), t["company"].where("status is not null"))


_SEEDS = "SELECT seller_mst AS mst FROM w INTERSECT SELECT buyer_mst FROM w"


@query(_and_all(_SEEDS), "trades")
def sellers_intersect_buyers(t):
    return edges.seeds(_every(t))


@query(
    _and_all(f"SELECT p AS n_participants, s AS n_seeds, cast(p - s AS double) / p AS pruned_share FROM (SELECT (SELECT count(*) FROM (SELECT seller_mst FROM w UNION SELECT buyer_mst FROM w)) AS p, (SELECT count(*) FROM ({_SEEDS})) AS s)"),
    "trades",
)
def seed_summary(t):
    return edges.seed_summary(_every(t))


_RISKY = f"SELECT mst FROM company WHERE coalesce(established_date >= '1995-01-01', false) OR coalesce(status IN ({', '.join(repr(s) for s in links.RISKY_STATUSES)}), false)"


# -- scalar functions -----------------------------------------------------------------


@query("SELECT o_orderkey, lpad(cast(o_orderkey AS string), cast(greatest(10, length(cast(o_orderkey AS string))) AS int), '0') AS mst, (lpad(cast(o_orderkey AS string), 10, '0') <> '0000000000') AS valid FROM orders")
def normalize_key(t):
    rows = t["orders"].select("o_orderkey", X.normalize_mst(F.concat(F.lit("MST "), F.col("o_orderkey").cast("string"))).alias("mst"))
    return rows.select("o_orderkey", "mst", X.is_valid_mst(F.col("mst")).alias("valid"))


@query("SELECT o_orderkey, cast(cast(o_orderdate AS date) AS string) AS day FROM orders")
def normalize_date(t):
    day = F.col("o_orderdate")
    shown = (
        F.when(F.col("o_orderkey") % 3 == 0, F.date_format(day, "dd/MM/yyyy"))
        .when(F.col("o_orderkey") % 3 == 1, F.concat(F.lit(" "), F.date_format(day, "yyyy-MM-dd")))
        .otherwise(F.datediff(day, F.lit("1899-12-30").cast("date")).cast("string"))
    )
    return t["orders"].select("o_orderkey", X.normalize_date(shown).alias("day"))


@query("SELECT o_orderkey, cast(trunc(o_totalprice) AS bigint) AS money, cast(year(o_orderdate) * 100 + month(o_orderdate) AS int) AS period, cast(year(o_orderdate) * 12 + month(o_orderdate) AS int) AS month_idx FROM orders")
def scalar_functions(t):
    p = X.to_period(F.date_format("o_orderdate", "yyyy-MM-dd"))
    return t["orders"].select("o_orderkey", X.normalize_money(F.col("o_totalprice").cast("string")).alias("money"), p.alias("period"), X.month_index(p).alias("month_idx"))


@query("SELECT DISTINCT cast(year(o_orderdate) * 100 + month(o_orderdate) AS int) AS period, strftime(date_trunc('month', o_orderdate) - INTERVAL 12 MONTH, '%Y-%m-%d') AS cutoff FROM orders")
def cutoff_date(t):
    rows = t["orders"].select((F.year("o_orderdate") * 100 + F.month("o_orderdate")).alias("period")).distinct()
    return rows.select("period", X.cutoff_date(F.col("period"), 12).alias("cutoff"))


@query(_RISKY, "company")
def risky_members(t):
    return links.risky_companies(t["company"], FROM)


# -- cycles ----------------------------------------------------------------------


def _balance(low: str, high: str) -> str:
    return f"CASE WHEN {high} <> 0 AND {low} / {high} >= 0.8 THEN 30.0 WHEN {high} <> 0 THEN greatest(0.0, 30.0 * ({low} / {high} - 0.3) / 0.5) ELSE 0.0 END"


def _cycle_sql(k: int, bound: float = 50.0) -> str:
    """Raw cycles of k companies as k-way join: members, periods and the parts of each month combination."""
    e = [f"e{i}" for i in range(k)]
    joins = " ".join(f"JOIN w {b} ON {b}.seller_mst = {a}.buyer_mst" for a, b in zip(e, e[1:]))
    nodes = [f"{x}.seller_mst" for x in e]
    apart = " AND ".join([f"{x} > {nodes[0]}" for x in nodes[1:]] + [f"{a} <> {b}" for i, a in enumerate(nodes[1:]) for b in nodes[i + 2 :]])
    amounts = ", ".join(f"{x}.total_amount" for x in e)
    months = ", ".join(f"({x}.period // 100) * 12 + {x}.period % 100" for x in e)
    span = f"(greatest({months}) - least({months}))"
    rows = (
        f"SELECT concat_ws('|', {', '.join(nodes)}) AS cycle_id, [{', '.join(nodes)}] AS members, [{', '.join(f'{x}.period' for x in e)}] AS periods, [{amounts}] AS amounts, "
        f"{_balance(f'least({amounts})', f'greatest({amounts})')} AS balance, CASE WHEN {span} <= 1 THEN 20.0 ELSE greatest(0.0, 20.0 - 5.0 * {span}) END AS time_, "
        f"list_filter([{', '.join(f'CASE WHEN {x}.total_amount <> 0 THEN {x}.total_vat / {x}.total_amount END' for x in e)}], lambda r: r IS NOT NULL) AS rates, {k} AS hop_len "
        f"FROM w e0 {joins} WHERE {e[-1]}.buyer_mst = {nodes[0]} AND {apart}"
    )
    return f"SELECT *, CASE WHEN len(list_filter(list_sort(rates), lambda r: abs(r - list_sort(rates)[len(rates) // 2 + 1]) > 0.03)) > 0 THEN 10.0 ELSE 0.0 END AS vat FROM ({rows}) WHERE balance + time_ >= {bound}"


def _cycles(t: Tables, k: int) -> DataFrame:
    return cycles.enumerate_cycles(_trades(t), FROM, TO, max_hops=k, only=k)


def _flat(rows: DataFrame) -> DataFrame:
    return rows.select(F.array_join("members", "|").alias("cycle_id"), F.array_join(F.transform("edges", lambda e: e["period"].cast("string")), "|").alias("periods"), "hop_len")


def _cycles_of(k: int) -> None:
    def f(t):
        return _flat(_cycles(t, k))

    f.__name__ = f"cycles{k}"
    query(_and_w(f"SELECT cycle_id, array_to_string(periods, '|') AS periods, hop_len FROM ({_cycle_sql(k)})"), "trades")(f)


for _k in (3, 4, 5):
    _cycles_of(_k)


@query(
    _and_w(
        "SELECT e0.seller_mst || '|' || e1.seller_mst || '|' || e2.seller_mst AS cycle_id, cast(e0.period AS string) || '|' || cast(e1.period AS string) || '|' || cast(e2.period AS string) AS periods, 3 AS hop_len "
        "FROM w e0 JOIN w e1 ON e1.seller_mst = e0.buyer_mst JOIN w e2 ON e2.seller_mst = e1.buyer_mst AND e2.buyer_mst = e0.seller_mst WHERE e1.seller_mst <> e2.seller_mst AND e0.seller_mst <> e2.seller_mst"
    ),
    "trades",
)
def cycles_match_fixed_hop(t):
    return _flat(cycles.fixed_hop_cycles(_trades(t), FROM, TO, 3))


_SEEDED = f"""SELECT e0.seller_mst || '|' || e1.seller_mst || '|' || e2.seller_mst AS cycle_id, cast(e0.period AS string) || '|' || cast(e1.period AS string) || '|' || cast(e2.period AS string) AS periods, 3 AS hop_len,
  row_number() OVER (PARTITION BY e0.seller_mst ORDER BY [e0.seller_mst, e1.seller_mst, e2.seller_mst], [e0.period, e1.period, e2.period]) AS n
  FROM w e0 JOIN w e1 ON e1.seller_mst = e0.buyer_mst JOIN w e2 ON e2.seller_mst = e1.buyer_mst AND e2.buyer_mst = e0.seller_mst
  WHERE e1.seller_mst <> e2.seller_mst AND e0.seller_mst <> e2.seller_mst AND e0.seller_mst IN (SELECT mst FROM ({_SEEDS}) ORDER BY mst LIMIT 25)"""


@query(_and_w(f"SELECT cycle_id, periods, hop_len FROM ({_SEEDED}) WHERE n <= 5"), "trades")
def cycles_match_limited(t):
    """At most 25 seeds, and at most 5 cycles of each."""
    return _flat(cycles.fixed_hop_cycles(_trades(t), FROM, TO, 3, most_seeds=25, per_seed=5))


_MAY_BE_RED = f"""SELECT raw.cycle_id, array_to_string(periods, '|') AS periods, raw.hop_len FROM raw WHERE balance + time_ >= 50
  - CASE WHEN EXISTS (SELECT 1 FROM ({_P_ADDR}) q WHERE list_contains(raw.members, q.company_a) AND list_contains(raw.members, q.company_b))
      OR EXISTS (SELECT 1 FROM near_hidden x WHERE x.src = raw.members[3] AND x.depth <= 4 - raw.hop_len AND NOT list_contains(raw.members, x.dst)) THEN 25 ELSE 0 END
  - CASE WHEN EXISTS (SELECT 1 FROM ({_RISKY}) q WHERE list_contains(raw.members, q.mst))
      OR EXISTS (SELECT 1 FROM near_risky x WHERE x.src = raw.members[3] AND x.depth <= 4 - raw.hop_len AND NOT list_contains(raw.members, x.dst)) THEN 15 ELSE 0 END"""
_NEAR = "SELECT DISTINCT seller_mst AS src, buyer_mst AS dst, 1 AS depth FROM w WHERE buyer_mst IN ({})"


@query(
    _and_w(f"SELECT * FROM (WITH raw AS MATERIALIZED ({_cycle_sql(3, 10.0)}), near_hidden AS MATERIALIZED ({_NEAR.format(f'SELECT company_a FROM ({_P_ADDR}) UNION SELECT company_b FROM ({_P_ADDR})')}), near_risky AS MATERIALIZED ({_NEAR.format(_RISKY)}) {_MAY_BE_RED})"),
    "trades",
    "company",
)
def cycles_path_bound(t):
    """Cycles of 3 by the bound of each path, in a search of up to 4 companies: signals one hop away count too."""
    hidden, risky = _signals(t)
    trades = materialise(_trades(t), "trades")  # read by the search and by the bound
    found = cycles.enumerate_cycles(trades, FROM, TO, bound=10.0, only=3).drop("truncated")
    return _flat(cycles.within_path_bound(found, edges.window_of(trades, FROM, TO), hidden, risky, 4))


@query(
    _and_w(
        "SELECT * FROM (WITH h AS (SELECT DISTINCT seller_mst AS src, buyer_mst AS dst FROM w), h2 AS (SELECT DISTINCT a.src, b.dst FROM h a JOIN h b ON a.dst = b.src), h3 AS (SELECT DISTINCT a.src, b.dst FROM h a JOIN h2 b ON a.dst = b.src) "
        "SELECT src, dst, min(depth) AS depth FROM (SELECT *, 1 AS depth FROM h UNION ALL SELECT *, 2 FROM h2 UNION ALL SELECT *, 3 FROM h3) GROUP BY src, dst)"
    ),
    "trades",
)
def reach_layers(t):
    return cycles.reach_layers(_window(t), 3)


_ALL = " UNION ALL ".join(f"SELECT cycle_id, members, periods, amounts, balance, time_, vat, hop_len FROM ({_cycle_sql(k)})" for k in (3, 4))
_BEST = f"SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cycle_id ORDER BY balance + time_ + vat DESC, periods, amounts) AS n FROM ({_ALL})) WHERE n = 1"


@query(_and_w(f"SELECT cycle_id, array_to_string(periods, '|') AS periods, hop_len FROM ({_ALL})"), "trades")
def cycles_return_filter(t):
    """The cycles of 3 and 4 companies, by paths that can still get back to their start."""
    return _flat(cycles.search_cycles(_trades(t), FROM, TO, max_hops=4, return_filter=True)[0])


def _best(t: Tables) -> DataFrame:
    return cycles.best_combinations(cycles.enumerate_cycles(_trades(t), FROM, TO, max_hops=4))


@query(_and_w(f"SELECT cycle_id, array_to_string(periods, '|') AS periods, hop_len FROM ({_BEST})"), "trades")
def cycles_dedup(t):
    return _flat(_best(t))


@query(_and_w(f"SELECT cycle_id, round(balance, 6) AS balance, time_ AS time, vat FROM ({_BEST})"), "trades")
def score_components(t):
    parts = score.components_of(F.col("edges"))
    return _best(t).select(F.array_join("members", "|").alias("cycle_id"), F.round(parts["score_balance"], 6).alias("balance"), parts["score_time"].alias("time"), parts["score_vat"].alias("vat"))


def _scored_sql(bound: float, enough: str) -> str:
    """Common tables of scored cycles of 3 to 5 companies: those with balance + time >= ``bound`` for which ``enough`` holds."""
    raw = " UNION ALL ".join(f"SELECT cycle_id, members, periods, amounts, balance, time_, vat, hop_len FROM ({_cycle_sql(k, bound)})" for k in (3, 4, 5))
    return f"""raw AS MATERIALIZED ({raw}),
  lists AS MATERIALIZED (SELECT DISTINCT cycle_id, members FROM raw),
  member AS MATERIALIZED (SELECT cycle_id, unnest(members) AS x FROM lists),
  h AS MATERIALIZED (SELECT DISTINCT a.cycle_id, 25.0 AS hidden FROM ({_P_ADDR}) q JOIN member a ON a.x = q.company_a JOIN member b ON b.x = q.company_b AND b.cycle_id = a.cycle_id),
  r AS MATERIALIZED (SELECT DISTINCT cycle_id, 15.0 AS risk FROM member WHERE x IN ({_RISKY})),
  near AS MATERIALIZED (SELECT raw.*, coalesce(hidden, 0.0) AS hidden, coalesce(risk, 0.0) AS risk FROM raw LEFT JOIN h USING (cycle_id) LEFT JOIN r USING (cycle_id)
    WHERE {enough}),
  best AS MATERIALIZED (SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY cycle_id ORDER BY balance + time_ + vat DESC, periods, amounts) AS n FROM near) WHERE n = 1),
  scored AS MATERIALIZED (SELECT cycle_id, members, hop_len, periods, amounts, hidden AS score_hidden_link, risk AS score_risky_member, round_even(balance, 1) AS score_balance, time_ AS score_time, vat AS score_vat,
    round_even(balance + time_ + vat, 1) AS score_60, round_even(balance + time_ + hidden + risk + vat, 1) AS score FROM best)"""


# Those that can be red: the bound falls by 25 with a hidden pair among the members and by 15 with one at risk.
_SCORED = _scored_sql(10.0, "balance + time_ >= 50 - coalesce(hidden, 0.0) - coalesce(risk, 0.0)")
_ALL_SCORED = _scored_sql(0.0, "true")  # balance and time are never below 0


def _and_scored(sql: str) -> str:
    return f"SELECT * FROM (WITH {W_SQL}, {_SCORED} {sql})"


def _signals(t: Tables) -> tuple[DataFrame, DataFrame]:
    """Groups of companies with one address, and companies at risk, as tables."""
    hidden, risky = links.hidden_groups(links.normalized_addresses(t["company"])), links.risky_companies(t["company"], FROM)
    return tuple(side_by_side(t["company"].sparkSession, [lambda: materialise(hidden, "hidden"), lambda: materialise(risky, "risky")]))


def _within(rows: DataFrame) -> DataFrame:
    """Rows of the months of the search: all edges of its cycles lie there."""
    return rows.where(F.col("period").between(FROM, TO))


def _scored(t: Tables, trades: DataFrame | None = None) -> DataFrame:
    """All cycles of 3 to 5 companies that can be red, as in plans.circular; ``trades``: those of the window, where they are already written."""
    hidden, risky = _signals(t)
    found, _ = cycles.search_cycles(_trades(t) if trades is None else trades, FROM, TO, bound=score.prune_bound(True, True), hidden=hidden, risky=risky)
    return score.score_cycles(cycles.best_combinations(found, turn=False), hidden, risky)


_SCORES = ["score", "score_60", "score_balance", "score_time", "score_hidden_link", "score_risky_member", "score_vat"]


@query(_and_scored(f"SELECT cycle_id, hop_len, {', '.join(f'cast({c} AS double) AS {c}' for c in _SCORES)} FROM scored"), "trades", "company")
def cycles_scored(t):
    return _scored(t).select("cycle_id", "hop_len", *_SCORES)


@query(
    f"""SELECT * FROM (WITH {W_SQL}, {_ALL_SCORED} SELECT count(*) AS total, count(*) FILTER (score >= 60) AS red, count(*) FILTER (score >= 40 AND score < 60) AS watch, count(*) FILTER (score < 40) AS skipped, cast(max(score) AS double) AS top_score,
    cast(60 + CASE WHEN EXISTS (SELECT 1 FROM ({_P_ADDR})) THEN 25 ELSE 0 END + CASE WHEN EXISTS (SELECT 1 FROM ({_RISKY})) THEN 15 ELSE 0 END AS double) AS max_achievable_score FROM scored)""",
    "trades",
    "company",
)
def cycles_level_summary(t):
    """All cycles of 3 to 5 companies by level, found without a bound, and the most that the signals at hand let a cycle reach."""
    hidden, risky = _signals(t)
    found, _ = cycles.search_cycles(_trades(t), FROM, TO, bound=score.prune_bound(True, True, no_prune=True))
    rows = score.level_summary(score.best_scores(found, hidden, risky), not links.shared_groups(hidden).isEmpty(), not risky.isEmpty())
    return rows.withColumn("top_score", F.when(F.col("total") > 0, F.col("top_score")))


@query(_and_scored("SELECT cycle_id, cast(score AS double) AS score FROM scored ORDER BY score DESC, members LIMIT 20"), "trades", "company")
def top_cycles(t):
    return flags.top_cycles(_scored(t)).select("cycle_id", "score")


@query(_and_scored("SELECT mst, count(*) AS red_count, cast(max(score) AS double) AS best_score FROM (SELECT unnest(members) AS mst, score FROM scored WHERE score >= 60) GROUP BY mst"), "trades", "company")
def hub_companies(t):
    return flags.hubs(_scored(t))


@query(_and_scored("SELECT mst, count(*) AS red_count, cast(max(score) AS double) AS best_score FROM (SELECT unnest(members) AS mst, score FROM scored WHERE score >= 60) GROUP BY mst ORDER BY red_count DESC, best_score DESC, mst LIMIT 10"), "trades", "company")
def top_hubs(t):
    return flags.hubs(_scored(t), 10)


@query(_and_scored("SELECT cycle_id, hop_len, array_to_string(amounts, '|') AS amounts, array_to_string(periods, '|') AS periods FROM scored"), "trades", "company")
def cycle_loops(t):
    rows = flags.loops(_scored(t))
    return rows.select(F.array_join("members", "|").alias("cycle_id"), "hop_len", F.array_join(F.transform("amounts", lambda x: x.cast("decimal(20,1)").cast("string")), "|").alias("amounts"), F.array_join(F.transform("periods", lambda x: x.cast("string")), "|").alias("periods"))


_EDGES = "SELECT DISTINCT s.cycle_id, s.members[i] AS seller_mst, s.members[i % s.hop_len + 1] AS buyer_mst, s.periods[i] AS period, s.score FROM scored s, unnest(range(1, s.hop_len + 1)) AS u(i)"


@query(
    _and_scored(f"SELECT einvoice_row_id, true AS is_circular, array_to_string(list_sort(list_distinct(list(cycle_id))), ',') AS cycle_ids FROM invoices JOIN ({_EDGES}) USING (seller_mst, buyer_mst, period) WHERE score >= 40 GROUP BY einvoice_row_id"),
    "trades",
    "company",
)
def invoice_flags(t):
    """Invoices of the window are joined with their orders once, for the search and for the flags."""
    invoices = materialise(_invoices(t), "invoices")
    return flags.invoice_flags(invoices, _scored(t, edges.trade_edges(invoices))).withColumn("cycle_ids", F.array_join("cycle_ids", ","))


@query(_and_scored(f"SELECT DISTINCT t.seller_mst, t.buyer_mst, t.period, t.total_amount FROM trades t JOIN ({_EDGES}) USING (seller_mst, buyer_mst, period)"), "trades", "company")
def cycle_drilldown(t):
    """Trades of the window are made once, for the search and for the edges of its cycles."""
    trades = materialise(_trades(t), "trades")
    return flags.drill_down(trades, _scored(t, trades)).select("seller_mst", "buyer_mst", "period", "total_amount")


@query(_and_scored("SELECT cycle_id, string_agg(coalesce(nullif(name, ''), '(unknown)'), '|' ORDER BY i) AS names FROM (SELECT cycle_id, members[i] AS mst, i FROM scored, unnest(range(1, hop_len + 1)) AS u(i)) LEFT JOIN company USING (mst) GROUP BY cycle_id"), "trades", "company")
def cycle_names(t):
    return flags.with_names(_scored(t), t["company"]).select("cycle_id", F.array_join("names", "|").alias("names"))


@query(
    _and_w(
        f"""SELECT * FROM (WITH RECURSIVE e AS MATERIALIZED (SELECT DISTINCT seller_mst AS a, buyer_mst AS b FROM w), reach AS (SELECT a, b FROM e UNION SELECT r.a, e.b FROM reach r JOIN e ON e.a = r.b),
    comp AS (SELECT x.a AS mst, least(min(x.b), x.a) AS component, count(DISTINCT x.b) AS n FROM reach x JOIN reach y ON y.a = x.b AND y.b = x.a GROUP BY x.a)
    SELECT mst, component, n AS size FROM comp WHERE n > 1)"""
    ),
    "trades",
)
def strong_components(t):
    return components.strong_components(_window(t))


_BOTH_WAYS = f"SELECT company_a AS src, company_b AS dst FROM ({_P_ADDR}) UNION SELECT company_b, company_a FROM ({_P_ADDR})"


@query(
    _and_w(
        f"""SELECT * FROM (WITH e AS MATERIALIZED (SELECT DISTINCT seller_mst AS a, buyer_mst AS b FROM w), q AS MATERIALIZED ({_BOTH_WAYS}),
    p AS (SELECT src, dst, 1 AS hops, [src, dst] AS path FROM q JOIN e ON a = src AND b = dst
      UNION ALL SELECT src, dst, 2, [src, x.b, dst] FROM q JOIN e x ON x.a = src JOIN e y ON y.a = x.b AND y.b = dst
      UNION ALL SELECT src, dst, 3, [src, x.b, y.b, dst] FROM q JOIN e x ON x.a = src JOIN e y ON y.a = x.b JOIN e z ON z.a = y.b AND z.b = dst
      UNION ALL SELECT src, dst, 4, [src, x.b, y.b, z.b, dst] FROM q JOIN e x ON x.a = src JOIN e y ON y.a = x.b JOIN e z ON z.a = y.b JOIN e u ON u.a = z.b AND u.b = dst),
    best AS (SELECT src, dst, min(hops) AS hops FROM p GROUP BY src, dst)
    SELECT src, dst, cast(hops AS int) AS hops, count(*) AS n_paths, array_to_string(min(path), '|') AS path FROM p JOIN best USING (src, dst, hops) GROUP BY src, dst, hops)"""
    ),
    "trades",
    "company",
)
def shortest_paths(t):
    """How companies with the same address sell to each other, in both directions, by at most 4 sales."""
    groups = links.hidden_groups(links.normalized_addresses(t["company"]))
    return paths.shortest_paths(_window(t), groups, 4).withColumn("path", F.array_join("path", "|"))


@query(
    _and_w(
        f"""SELECT * FROM (WITH e AS MATERIALIZED (SELECT DISTINCT seller_mst AS a, buyer_mst AS b FROM w), r AS MATERIALIZED ({_RISKY}),
    reach AS (SELECT a, b FROM e WHERE a IN (SELECT mst FROM r) UNION SELECT x.a, y.b FROM e x JOIN e y ON y.a = x.b WHERE x.a IN (SELECT mst FROM r))
    SELECT b AS mst, count(DISTINCT a) AS n_sources FROM reach WHERE a <> b GROUP BY b)"""
    ),
    "trades",
    "company",
)
def hub_convergence(t):
    """To how many companies at risk each company can be traced back within two sales."""
    return paths.hub_convergence(_window(t), links.risky_companies(t["company"], FROM))


@query("SELECT seller_mst, buyer_mst, count(*) AS n_months, cast(sum(invoice_count) AS bigint) AS invoice_count, sum(total_amount) AS total_amount FROM trades GROUP BY ALL HAVING count(*) >= 3", "trades")
def repeated_pairs(t):
    return paths.repeated_pairs(t["trades"])


@query(
    """SELECT mst, name || ' "A, B"' || chr(10) || '""' AS name, sector, address || ', "' AS address, revenue, report_date, nullif(status, '') AS status FROM company""",
    "company",
)
def csv_companies(t):
    """The companies after a way through a headerless CSV file, their names with quotes, commas and line breaks."""
    rows = t["company"].select("mst", F.concat("name", F.lit(' "A, B"\n""')).alias("name"), "sector", F.concat("address", F.lit(', "')).alias("address"), F.col("revenue").cast("string").alias("revenue"), "report_date", "status")
    path = scratch_path(rows.sparkSession, "csv")
    rows.write.csv(path, quote='"', escape='"', emptyValue="")
    return raw.companies(raw.read_companies(rows.sparkSession, path))


@query("SELECT seller_mst, buyer_mst, period, invoice_count, total_amount, total_vat, first_date, last_date FROM trades", "trades")
def csv_trades(t):
    """The monthly edges of invoices that were read from a headerless CSV file; texts hold commas and quotes, and each row a column too many."""
    rows = t["invoices"].select(F.col("einvoice_row_id").cast("string"), F.col("day").alias("d"), "seller_mst", "buyer_mst", F.lit('goods "x", y').alias("g"), F.col("amount").cast("string"), F.col("vat").cast("string"), F.lit("more"))
    path = scratch_path(rows.sparkSession, "csv")
    rows.write.csv(path, quote='"', escape='"')
    return edges.trade_edges(raw.invoices(raw.read_invoices(rows.sparkSession, path)))


@query(_and_scored("SELECT cycle_id, array_to_string(periods, '|') AS periods, hop_len FROM near"), "trades", "company")
def cycles_refreshed(t):
    """All cycles that can be red, after the last month of the window was replaced: the stored ones without it, and those through it."""
    hidden, risky = _signals(t)
    trades = materialise(_trades(t), "trades")  # made once, for both searches
    how = {"bound": score.prune_bound(True, True), "hidden": hidden, "risky": risky}
    before, _ = cycles.search_cycles(trades.where(F.col("period") < TO), FROM, TO, **how)
    return _flat(cycles.refreshed(materialise(before, "stored"), trades, FROM, TO, [TO], **how)[0])


# -- network -------------------------------------------------------------------------

_PARTNERS = "SELECT mst, partner, count(*) > 1 AS both_ FROM (SELECT DISTINCT seller_mst AS mst, buyer_mst AS partner FROM w UNION ALL SELECT DISTINCT buyer_mst, seller_mst FROM w) GROUP BY mst, partner"


@query(_and_all(f"SELECT mst, count(*) AS degree, round_even(count(*)::double / (SELECT count(DISTINCT mst) - 1 FROM ({_PARTNERS})), 4) AS degree_centrality FROM ({_PARTNERS}) GROUP BY mst"), "trades")
def degree_centrality(t):
    return metrics.degree_and_reciprocity(_every(t)).select("mst", "degree", "degree_centrality")


@query(_and_all(f"SELECT mst, round_even(count(*) FILTER (both_)::double / count(*), 4) AS reciprocity_ratio FROM ({_PARTNERS}) GROUP BY mst"), "trades")
def reciprocity(t):
    return metrics.degree_and_reciprocity(_every(t)).select("mst", "reciprocity_ratio")


_FIRST = "SELECT seller_mst, buyer_mst, min(cast(first_date AS date)) AS first_seen FROM w GROUP BY ALL"


@query(_and_all(f"SELECT seller_mst, buyer_mst, cast(first_seen AS string) AS first_seen FROM ({_FIRST})"), "trades")
def first_seen(t):
    return metrics.first_seen(_every(t)).withColumn("first_seen", F.col("first_seen").cast("string"))


@query(
    f"""SELECT * FROM (WITH w AS MATERIALIZED (SELECT * FROM trades), f AS ({_FIRST}), c AS (SELECT max(first_seen) - 90 AS cutoff FROM f)
    SELECT p.mst, round_even(count(*) FILTER (coalesce(a.first_seen, b.first_seen) >= (SELECT cutoff FROM c))::double / count(*), 4) AS new_partner_rate_90d FROM ({_PARTNERS}) p
    LEFT JOIN f a ON a.seller_mst = p.mst AND a.buyer_mst = p.partner LEFT JOIN f b ON b.buyer_mst = p.mst AND b.seller_mst = p.partner GROUP BY p.mst)""",
    "trades",
)
def new_partner_rate(t):
    return metrics.new_partner_rate(_every(t))


def _betweenness_sql(levels: int = 5) -> str:
    """All pairs by levels, then the shares of shortest paths through each vertex; for graphs of at most ``levels`` hops across."""
    out = f"adj AS (SELECT mst AS a, partner AS b FROM ({_PARTNERS})), p0 AS (SELECT DISTINCT a AS s, a AS v, 1.0::double AS sigma FROM adj), all0 AS (SELECT s, v, sigma, 0 AS d FROM p0)"
    for k in range(1, levels + 1):
        out += f", p{k} AS (SELECT s, b AS v, sum(sigma) AS sigma FROM p{k - 1} JOIN adj ON a = v WHERE NOT EXISTS (SELECT 1 FROM all{k - 1} x WHERE x.s = p{k - 1}.s AND x.v = adj.b) GROUP BY s, b), all{k} AS (SELECT * FROM all{k - 1} UNION ALL SELECT s, v, sigma, {k} FROM p{k})"
    last = f"all{levels}"
    through = f"SELECT x.v AS mst, sum(x.sigma * y.sigma / z.sigma) / 2 AS c FROM {last} x JOIN {last} y ON y.s = x.v JOIN {last} z ON z.s = x.s AND z.v = y.v AND z.d = x.d + y.d WHERE x.s <> x.v AND y.v <> x.v GROUP BY x.v"
    return f"SELECT * FROM (WITH w AS MATERIALIZED (SELECT * FROM trades), {out} SELECT DISTINCT a AS mst, round_even(coalesce(c, 0.0), 6) AS betweenness_centrality FROM adj LEFT JOIN ({through}) t ON t.mst = adj.a)"


@query(_betweenness_sql(), "trades")
def betweenness(t):
    return metrics.betweenness(_every(t))


# -- contract -----------------------------------------------------------------------


def _tables_of(t: Tables) -> Tables:
    """Addresses are groups, whose pairs are counted and not made."""
    scope = materialise(lake.transacting(t["einvoice"]), "scope")
    groups = links.hidden_groups(links.normalized_addresses(t["company"]))
    return {"company": t["company"], "trades": t["trades"], "groups": groups, "shares_phone": links.phone_pairs(lake.phones(t["header"], scope)), "legal_reps": lake.legal_reps(t["header"], scope)}


_COUNTED = {
    "company": "SELECT count(*) FROM company",
    "trades": "SELECT count(*) FROM trades",
    "trades.rank": "SELECT count(*) FROM trades",
    "trades.period": None,
    "legal_reps": f"SELECT count(*) FROM (SELECT person_id FROM ({_REPS}) GROUP BY person_id HAVING count(*) > 1)",
    "shares_address": f"SELECT count(*) FROM ({_P_ADDR})",
    "shares_phone": f"SELECT count(*) FROM ({_P_PHONE})",
    "company.status": "SELECT count(*) FROM company WHERE coalesce(established_date, status) IS NOT NULL",
}
_CHECKED = " UNION ALL ".join(
    f"SELECT '{k}' AS id, {'true' if contract.CHECKS[k].required else 'false'} AS required, cast({f'({q})' if q else '-1'} AS bigint) AS n, '{contract.CHECKS[k].supports or ''}' AS signal" for k, q in _COUNTED.items()
)
_CHECKED = f"SELECT *, CASE WHEN n <> 0 THEN 'pass' ELSE 'empty' END AS status FROM ({_CHECKED}) UNION ALL SELECT 'owns', false, -1, 'hidden_link', 'missing'"


@query(f"SELECT id, status, required, n FROM ({_CHECKED})", "trades", "company", "header", "einvoice")
def contract_checks(t):
    spark = t["company"].sparkSession
    return contract.checks_frame(spark, contract.validate(_tables_of(t))).select(F.col("check_id").alias("id"), "status", "required", F.coalesce("n", F.lit(-1)).alias("n"))


@query(
    f"""SELECT 60.0 + max(CASE WHEN signal = 'hidden_link' AND status = 'pass' THEN 25.0 ELSE 0.0 END) + max(CASE WHEN signal = 'risky_member' AND status = 'pass' THEN 15.0 ELSE 0.0 END)::double AS ceiling,
    bool_and(status = 'pass' OR NOT required) AS can_run, cast(count(*) FILTER (status = 'pass') AS int) AS n_pass, cast(count(*) FILTER (status = 'empty') AS int) AS n_empty, cast(count(*) FILTER (status = 'missing') AS int) AS n_missing FROM ({_CHECKED})""",
    "trades",
    "company",
    "header",
    "einvoice",
)
def contract_ceiling(t):
    checks = contract.validate(_tables_of(t))
    h = contract.histogram(checks)
    rows = [(contract.ceiling(checks)[0], contract.can_run(checks), h["pass"], h["empty"], h["missing"])]
    return t["company"].sparkSession.createDataFrame(rows, "ceiling double, can_run boolean, n_pass int, n_empty int, n_missing int")


@query("SELECT count(*) AS n, min(period) AS period_from, max(period) AS period_to, count(*) FILTER (period IS NULL) AS n_bad FROM trades", "trades")
def period_range(t):
    c = contract.rank_is_period({"trades": t["trades"]})
    rows = [(c.count, c.more["period_from"], c.more["period_to"], 0 if c.status == contract.PASS else c.count)]
    return t["trades"].sparkSession.createDataFrame(rows, "n bigint, period_from int, period_to int, n_bad bigint")


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    def bind(f):
        return lambda spark, sf_dir: f(testbed.Tables(spark, sf_dir))

    return {name: bind(f) for name, f in QUERIES.items()}


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
