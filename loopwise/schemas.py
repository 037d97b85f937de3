"""Schemas of the data model: companies, monthly trade edges and links between companies."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


_TYPES = {"string": T.StringType(), "double": T.DoubleType(), "int": T.IntegerType(), "bigint": T.LongType()}


def _fields(spec: str) -> T.StructType:
    """A schema of "name type" pairs; unlike a DDL string it needs no session."""
    return T.StructType([T.StructField(n, _TYPES[t]) for n, t in (f.split() for f in spec.split(", "))])


#: Headerless CSV inputs, by position.
RAW_COMPANY = _fields("mst string, name string, sector string, address string, revenue string, report_date string, status string")
RAW_INVOICE = _fields("so_hoa_don string, ngay_xuat string, mst_nguon string, mst_dich string, mo_ta string, tien_chua_thue string, thue_gtgt string")

COMPANY = _fields(
    "mst string, name string, sector string, address string, revenue double, report_date string, status string, "
    "established_date string, book_tax_gap double, invoice_adjustment_rate double, invoice_benford_chi2 double"
)
TRADES = _fields("seller_mst string, buyer_mst string, period int, invoice_count bigint, total_amount double, total_vat double, first_date string, last_date string")
SHARES_ADDRESS = _fields("company_a string, company_b string, norm_addr string")
SHARES_PHONE = _fields("company_a string, company_b string, norm_phone string")
LEGAL_REPS = _fields("person_id string, person_name string, mst string")
OWNS = _fields("owner string, owned string")
PERSONS = _fields("person_id string, person_name string")
#: Companies by address, phone number or person: those of a group are linked, and no pair needs to be made.
GROUPS = _fields("mst string, grp string")
INVOICES = _fields("einvoice_row_id string, seller_mst string, buyer_mst string, period int")

#: All tables of a dataset directory; those in OPTIONAL may be absent.
TABLES = {"company": COMPANY, "trades": TRADES, "shares_address": SHARES_ADDRESS, "shares_phone": SHARES_PHONE, "legal_reps": LEGAL_REPS, "owns": OWNS, "persons": PERSONS, "groups": GROUPS, "invoices": INVOICES}
OPTIONAL = frozenset(TABLES) - {"company", "trades"}
#: What tells rows of a table apart: of two with equal keys the later one stays. Trades are replaced by month.
KEYS = {"company": ("mst",), "shares_address": ("company_a", "company_b"), "shares_phone": ("company_a", "company_b"), "legal_reps": ("person_id", "mst"), "owns": ("owner", "owned"), "persons": ("person_id",), "groups": ("mst", "grp"), "invoices": ("einvoice_row_id", "seller_mst", "buyer_mst", "period")}


def empty(spark: SparkSession, table: str) -> DataFrame:
    return spark.createDataFrame([], TABLES[table])
