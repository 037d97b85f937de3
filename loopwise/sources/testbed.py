"""Invoice and company tables derived from star-schema tables, to run every operator on.

The statements are plain SQL that Spark and other engines read alike, so that
both sides of a comparison start from the same rows.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession

from ..operators.sieve import sieve, sifted
from ..scratch import materialise

PERIOD_FROM, PERIOD_TO = 199601, 199603
#: Orders from which on lines are sifted before they are joined with them.
SIFTED = 100_000

BASE = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents")

VIEWS = {
    "invoices": """
        SELECT l_orderkey * 10 + l_linenumber AS einvoice_row_id,
               cast(l_suppkey AS string) AS seller_mst,
               cast(o_custkey % (SELECT count(*) FROM supplier) AS string) AS buyer_mst,
               cast(year(o_orderdate) * 100 + month(o_orderdate) AS int) AS period,
               cast(cast(o_orderdate AS date) AS string) AS day,
               cast(floor(l_extendedprice * (1 - l_discount)) AS bigint) AS amount,
               cast(floor(l_extendedprice * (1 - l_discount) * l_tax) AS bigint) AS vat
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
    "trades": """
        SELECT seller_mst, buyer_mst, period, count(*) AS invoice_count, cast(sum(amount) AS double) AS total_amount,
               cast(sum(vat) AS double) AS total_vat, min(day) AS first_date, max(day) AS last_date
        FROM invoices WHERE seller_mst <> buyer_mst GROUP BY seller_mst, buyer_mst, period""",
    "company": """
        SELECT cast(s_suppkey AS string) AS mst, s_name AS name, n_name AS sector,
               'P. ' || n_name || ',  Số ' || cast(cast(floor(s_acctbal / 500) AS int) AS string) AS address,
               s_acctbal AS revenue, '31/12/1995' AS report_date,
               CASE WHEN s_acctbal < 0 THEN 'Đã giải thể' WHEN s_acctbal > 2000 THEN 'Đang hoạt động' END AS status,
               CASE WHEN s_acctbal > 9000 THEN '1995-06-15' WHEN s_acctbal > 1000 THEN '1980-01-01' END AS established_date
        FROM supplier JOIN nation ON s_nationkey = n_nationkey""",
    "header": """
        SELECT cast(c_custkey AS string) AS mst, c_name AS ten_cong_ty,
               CASE WHEN c_acctbal > 0 THEN 'Q. ' || c_mktsegment || ' - Đường ' || cast(c_nationkey AS string) END AS dia_chi,
               CASE WHEN c_acctbal < 500 THEN 'Đã bị thu hồi' ELSE '' END AS trang_thai,
               cast(NULL AS string) AS ngay_hoat_dong,
               CASE WHEN c_acctbal < 100 THEN '  ' ELSE 'Nguyễn Văn ' || cast(c_custkey % 70 AS string) END AS dai_dien_phap_luat,
               '0' || cast(900000000 + c_custkey % 90 AS string) || CASE WHEN c_nationkey > 12 THEN '/08' || cast(10000000 + c_nationkey * 7 AS string) ELSE '-123' END AS dien_thoai_tru_so,
               CASE WHEN c_nationkey = 3 THEN 'closed' ELSE 'active' END AS record_status,
               cast(c_custkey % 11 AS int) AS ictrl_dt
        FROM customer
        UNION ALL
        SELECT cast(s_suppkey AS string), s_name || ' (old)', 'Kp. 3, ' || s_name, 'Đang hoạt động', '1996-01-01', 'NGUYỄN  VĂN ' || cast(s_suppkey % 70 AS string),
               '0912 345 ' || cast(100 + s_suppkey % 50 AS string), 'active', cast(s_suppkey % 13 AS int)
        FROM supplier""",
    "filings": """
        SELECT cast(o_custkey + 50 AS string) AS mst, 'Filer ' || cast(o_custkey AS string) AS ten_nnt, 'TP. ' || o_orderstatus || ' ' || cast(o_orderkey AS string) || ' street' AS dchi_nnt,
               cast(o_orderkey % 3 AS int) AS so_lan, cast(cast(o_orderdate AS date) AS string) AS ngay_lap_tkhai, o_orderkey AS load_ts, cast(cast(o_orderdate AS date) AS string) AS ictrl_dt
        FROM orders""",
    "items": """
        SELECT cast(o_custkey AS string) AS mst, CASE WHEN o_orderkey % 4 = 0 THEN 'Ct11' ELSE 'Ct10' END AS item_code, CASE WHEN o_orderstatus = 'P' THEN 'CDKT' ELSE 'KQKD' END AS statement_code,
               CASE WHEN o_orderkey % 5 = 0 THEN 'nam_truoc' ELSE 'nam_nay' END AS period_scope, o_totalprice AS item_value_num, o_orderkey AS ictrl_dt
        FROM orders""",
    "industry": """
        SELECT cast(l_suppkey AS string) AS mst, CASE WHEN l_linenumber = 7 THEN NULL ELSE 'sector ' || cast(l_partkey % 20 AS string) END AS ten_nganh, l_returnflag = 'R' AS nganh_chinh, l_orderkey AS ictrl_dt
        FROM lineitem""",
    "features": """
        SELECT cast(o_custkey AS string) AS mst, cast(year(o_orderdate) AS int) AS fiscal_year,
               CASE WHEN o_orderkey % 3 = 0 THEN 'TTHN-T2-D08-002' WHEN o_orderkey % 3 = 1 THEN 'TTHN-T2-D07-001' ELSE 'TTHN-T2-D07-002' END AS feature_name, o_totalprice AS feature_value_num
        FROM orders""",
    "einvoice": """
        SELECT l_orderkey * 10 + l_linenumber AS einvoice_row_id, CASE WHEN l_returnflag = 'R' THEN 'mua' ELSE 'ban' END AS chieu,
               cast(l_suppkey AS string) AS mst_ban, cast(l_suppkey AS string) AS mst_ban_goc,
               CASE WHEN l_quantity < 49 THEN cast(o_custkey % (SELECT count(*) FROM supplier) AS string) END AS mst_mua_goc,
               cast(l_linenumber % 3 AS string) AS ky_hieu_mau_so, 'C' || cast(l_partkey % 7 AS string) AS ky_hieu_hd, cast(l_orderkey % 50 AS string) AS so_hd,
               CASE WHEN l_quantity < 3 THEN 'Hóa đơn đã bị thay thế' WHEN l_quantity < 5 THEN NULL ELSE 'Hóa đơn mới' END AS trang_thai_hd,
               CASE WHEN l_discount < 0.1 THEN o_orderdate END AS ngay_lap,
               cast(floor(l_extendedprice * (1 - l_discount)) AS double) AS tien_chua_thue, cast(floor(l_extendedprice * l_tax) AS double) AS tien_thue, l_shipdate AS ictrl_dt
        FROM lineitem JOIN orders ON l_orderkey = o_orderkey""",
}
#: Views that each view reads.
NEEDS = {"trades": ("invoices",)}


class Tables(dict):
    """Base tables and views of one folder by name; each is set up when it is first asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        super().__init__()
        self.spark, self.sf_dir = spark, sf_dir

    def __missing__(self, name: str) -> DataFrame:
        if name in VIEWS:
            for other in (*NEEDS.get(name, ()), *(b for b in BASE if re.search(rf"(FROM|JOIN) {b}\b", VIEWS[name]))):
                self[other]
            df = self.spark.sql(VIEWS[name])
        else:
            df = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        df.createOrReplaceTempView(name)
        self[name] = df
        return df

    def invoices_within(self, period_from: int, period_to: int) -> DataFrame:
        """``invoices`` of a range of months; lines of other months are not shuffled.

        The orders of these months are written. Few of them are sent to the
        lines by Spark itself; of more, lines are sifted by their keys before
        the two are joined.
        """
        month = "year(o_orderdate) * 100 + month(o_orderdate)"
        orders = self["orders"].where(f"{month} BETWEEN {period_from} AND {period_to}").select("o_orderkey", "o_custkey", "o_orderdate")
        orders = materialise(orders, "orders")
        self["supplier"]
        lines, key = self["lineitem"], "cast({} AS bigint)".format
        if orders.count() > SIFTED:
            lines = sifted(lines, [key("l_orderkey")], sieve(orders, [key("o_orderkey")]))
        return self.spark.sql(VIEWS["invoices"].replace("FROM lineitem JOIN orders", "FROM {lines} JOIN {orders}"), lines=lines, orders=orders)


def with_views(sql: str, *names: str) -> str:
    """``sql`` after a WITH clause that defines the named views."""
    order: list[str] = []
    for n in names:
        order += [x for x in (*NEEDS.get(n, ()), n) if x not in order]
    return "WITH " + ",\n".join(f"{n} AS ({VIEWS[n]})" for n in order) + "\n" + sql
