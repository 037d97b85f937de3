"""Company and invoice tables of a lake, reduced to the model's tables."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from ..functions.text import normalize_address, person_id, phone_candidates

# Statuses of void invoices, and names of the risk features.
VOID_STATUSES = ("Hóa đơn đã bị thay thế", "Hóa đơn đã bị xóa bỏ/hủy bỏ")
BOOK_TAX_GAP = "TTHN-T2-D08-002"
ADJUSTMENT_RATE = "TTHN-T2-D07-001"
BENFORD = "TTHN-T2-D07-002"
UNKNOWN_SECTOR = "Chưa rõ"
# Names of the lake's tables.
LAKE_TABLES = {
    "invoices": "einvoice_invoice",
    "header": "company_header",
    "industry": "company_industry",
    "filings": "tax_declaration_bctc_filing_header",
    "items": "tax_declaration_bctc_item_value",
    "tax": "tax_declaration_gtgt_tndn_t2_feature_value",
    "risk": "einvoice_invoice_risk_feature_value",
}


def read_lake(spark: SparkSession, where: str, names: dict[str, str] | None = None, **options: str) -> dict[str, DataFrame]:
    """The lake's tables from a folder of Parquet tables, ``catalog:<schema>``, or a ``jdbc:`` address (``options`` go to its reader).

    names: table names that differ from ``LAKE_TABLES``. Nothing is fetched:
    filters and columns of what follows are pushed down to the source.
    """
    names = LAKE_TABLES | (names or {})
    if where.startswith("catalog:"):
        schema = where.removeprefix("catalog:")
        return {k: spark.table(f"{schema}.{v}" if schema else v) for k, v in names.items()}
    if where.startswith("jdbc:"):
        return {k: spark.read.format("jdbc").options(url=where, dbtable=v, **options).load() for k, v in names.items()}
    return {k: spark.read.parquet(f"{where.rstrip('/')}/{v}") for k, v in names.items()}


def latest(df: DataFrame, keys: list[str], order: list[Column]) -> DataFrame:
    """The first row of each key by ``order``; what ties is settled by the row's content."""
    rest = [F.col(c) for c in df.columns if c not in keys]
    return df.withColumn("_n", F.row_number().over(W.partitionBy(*keys).orderBy(*order, *rest))).where("_n = 1").drop("_n")


def valid_sales(invoices: DataFrame) -> DataFrame:
    """Sales with both parties, of forms 1 and 2, that aren't void. A null status is not known to be valid and drops out."""
    return invoices.where(
        (F.col("chieu") == "ban")
        & F.col("mst_ban_goc").isNotNull()
        & F.col("mst_mua_goc").isNotNull()
        & F.col("ky_hieu_mau_so").isin("1", "2")
        & ~F.col("trang_thai_hd").isin(*VOID_STATUSES)
    )


def period_of(ts: Column) -> Column:
    return F.date_format(ts.cast("timestamp"), "yyyyMM").cast("int")


def deduped_invoices(invoices: DataFrame, period_from: int | None = None, period_to: int | None = None) -> DataFrame:
    """One row, the newest, for each invoice identity; the period filter applies before, so it reaches the scan."""
    rows = valid_sales(invoices).where(F.col("ngay_lap").isNotNull())
    if period_from is not None:
        rows = rows.where(period_of(F.col("ngay_lap")) >= period_from)
    if period_to is not None:
        rows = rows.where(period_of(F.col("ngay_lap")) <= period_to)
    return latest(rows, ["mst_ban", "ky_hieu_mau_so", "ky_hieu_hd", "so_hd"], [F.col("ictrl_dt").desc_nulls_last()])


def trades(invoices: DataFrame, period_from: int | None = None, period_to: int | None = None) -> DataFrame:
    day = lambda c: F.date_format(c.cast("timestamp"), "yyyy-MM-dd")
    rows = deduped_invoices(invoices, period_from, period_to).withColumn("period", period_of(F.col("ngay_lap")))
    return rows.groupBy(F.col("mst_ban_goc").alias("seller_mst"), F.col("mst_mua_goc").alias("buyer_mst"), "period").agg(
        F.count("*").alias("invoice_count"),
        F.sum("tien_chua_thue").alias("total_amount"),
        F.sum("tien_thue").alias("total_vat"),
        day(F.min("ngay_lap")).alias("first_date"),
        day(F.max("ngay_lap")).alias("last_date"),
    )


def invoice_rows(invoices: DataFrame, period_from: int | None = None, period_to: int | None = None) -> DataFrame:
    """(einvoice_row_id, seller_mst, buyer_mst, period) of all valid sales, to trace edges back to invoices; repeated invoices stay."""
    rows = valid_sales(invoices).where(F.col("ngay_lap").isNotNull()).withColumn("period", period_of(F.col("ngay_lap")))
    if period_from is not None:
        rows = rows.where(F.col("period") >= period_from)
    if period_to is not None:
        rows = rows.where(F.col("period") <= period_to)
    return rows.select(F.col("einvoice_row_id").cast("string").alias("einvoice_row_id"), F.col("mst_ban_goc").alias("seller_mst"), F.col("mst_mua_goc").alias("buyer_mst"), "period")


def transacting(invoices: DataFrame) -> DataFrame:
    rows = valid_sales(invoices)
    return rows.select(F.col("mst_ban_goc").alias("mst")).union(rows.select(F.col("mst_mua_goc").alias("mst"))).distinct()


def latest_companies(header: DataFrame) -> DataFrame:
    return latest(header.where((F.col("record_status") == "active") & F.col("mst").isNotNull()), ["mst"], [F.col("ictrl_dt").desc_nulls_last()])


def latest_filings(filings: DataFrame) -> DataFrame:
    return latest(filings, ["mst"], [F.col(c).desc_nulls_last() for c in ("so_lan", "ngay_lap_tkhai", "load_ts")])


def main_sectors(industry: DataFrame) -> DataFrame:
    rows = industry.where(F.col("mst").isNotNull() & F.col("ten_nganh").isNotNull())
    return latest(rows, ["mst"], [F.when(F.col("nganh_chinh"), 0).otherwise(1), F.col("ictrl_dt").desc_nulls_last()]).select("mst", F.col("ten_nganh").alias("sector"))


def latest_revenue(items: DataFrame) -> DataFrame:
    rows = items.where((F.col("item_code") == "Ct10") & (F.col("statement_code") == "KQKD") & (F.col("period_scope") == "nam_nay"))
    return latest(rows, ["mst"], [F.col("ictrl_dt").desc_nulls_last()]).select("mst", F.col("item_value_num").alias("revenue"))


def feature_columns(features: DataFrame, names: dict[str, str]) -> DataFrame:
    """Newest value of each feature as a column of its own: names maps feature names to columns."""
    rows = latest(features.where(F.col("feature_name").isin(*names)), ["mst", "feature_name"], [F.col("fiscal_year").desc_nulls_last()])
    return rows.groupBy("mst").agg(*[F.max(F.when(F.col("feature_name") == k, F.col("feature_value_num"))).alias(v) for k, v in names.items()])


def companies(header: DataFrame, filings: DataFrame, items: DataFrame, industry: DataFrame, tax: DataFrame, risk: DataFrame, scope: DataFrame | None = None) -> DataFrame:
    """Companies by header, else filing; with sector, revenue and risk features; of ``scope`` (mst) where given."""
    c = latest_companies(header).select("mst", "ten_cong_ty", "dia_chi", "trang_thai", "ngay_hoat_dong")
    f = latest_filings(filings).select("mst", "ten_nnt", "dchi_nnt", F.col("ictrl_dt").alias("report_date"))
    both = c.join(f, "mst", "full_outer")  # using a name: the key of either side
    if scope is not None:
        both = both.join(scope, "mst", "left_semi")
    for more in (latest_revenue(items), main_sectors(industry), feature_columns(tax, {BOOK_TAX_GAP: "book_tax_gap"}), feature_columns(risk, {ADJUSTMENT_RATE: "invoice_adjustment_rate", BENFORD: "invoice_benford_chi2"})):
        both = both.join(more, "mst", "left")
    return both.select(
        "mst",
        F.coalesce("ten_cong_ty", "ten_nnt").alias("name"),
        F.coalesce(F.nullif(F.col("sector"), F.lit("")), F.lit(UNKNOWN_SECTOR)).alias("sector"),
        F.coalesce("dia_chi", "dchi_nnt").alias("address"),
        F.coalesce(F.col("revenue"), F.lit(0.0)).alias("revenue"),
        F.col("report_date").cast("string").alias("report_date"),
        F.nullif(F.col("trang_thai"), F.lit("")).alias("status"),
        F.col("ngay_hoat_dong").cast("string").alias("established_date"),
        "book_tax_gap",
        "invoice_adjustment_rate",
        "invoice_benford_chi2",
    )


def addresses(header: DataFrame, filings: DataFrame, scope: DataFrame) -> DataFrame:
    """(mst, address) of at least eleven characters, by header, else filing."""
    c = latest_companies(header).join(scope, "mst", "left_semi").select("mst", "dia_chi")
    f = latest_filings(filings.join(scope, "mst", "left_semi")).select("mst", "dchi_nnt")
    both = c.join(f, "mst", "full_outer").select("mst", F.coalesce("dia_chi", "dchi_nnt").alias("address"))
    return both.where(F.length(F.trim("address")) > 10)


def legal_reps(header: DataFrame, scope: DataFrame) -> DataFrame:
    rows = header.where((F.col("record_status") == "active") & F.col("mst").isNotNull() & (F.length(F.trim("dai_dien_phap_luat")) > 0)).join(scope, "mst", "left_semi")
    rows = latest(rows, ["mst"], [F.col("ictrl_dt").desc_nulls_last()])
    name = F.trim("dai_dien_phap_luat")
    return rows.where(normalize_address(name) != "").select(person_id(name).alias("person_id"), name.alias("person_name"), "mst")


def persons(reps: DataFrame) -> DataFrame:
    """(person_id, person_name), one row for each person: the name of the company with the largest key."""
    return reps.groupBy("person_id").agg(F.max_by("person_name", "mst").alias("person_name"))


def phones(header: DataFrame, scope: DataFrame) -> DataFrame:
    """(mst, phone) of all valid numbers of each company's newest entry."""
    rows = header.where((F.col("record_status") == "active") & F.col("mst").isNotNull() & (F.length(F.trim("dien_thoai_tru_so")) >= 9)).join(scope, "mst", "left_semi")
    rows = latest(rows, ["mst"], [F.col("ictrl_dt").desc_nulls_last()])
    return rows.select("mst", F.explode(phone_candidates(F.col("dien_thoai_tru_so"))).alias("phone")).distinct()
