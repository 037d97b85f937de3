"""Headerless CSV inputs, dataset folders, and tables of a run."""

from __future__ import annotations

import re
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.text import strip, to_period
from ..schemas import OPTIONAL, RAW_COMPANY, RAW_INVOICE, TABLES
from ..scratch import complete

_DATASET = re.compile(r"[A-Za-z0-9_-]{1,64}")


def dataset_dir(root: str, name: str) -> str:
    """The folder of a dataset below ``root``; names that could lead elsewhere are refused."""
    if not _DATASET.fullmatch(name):
        raise ValueError(f"bad dataset name: {name!r}")
    if "://" in root:
        return f"{root.rstrip('/')}/{name}"
    top = Path(root).resolve()
    path = (top / name).resolve()
    if path.parent != top:
        raise ValueError(f"{name!r} leads out of {root}")
    return str(path)


def has_line_breaks(spark: SparkSession, path: str) -> bool:
    """Whether a quoted field may go over a line's end: then some line has an odd number of quotes. Without one, Spark can split the file anywhere."""
    quotes = F.length("value") - F.length(F.replace(F.col("value"), F.lit('"'), F.lit("")))
    return not spark.read.text(path).where(quotes % 2 == 1).isEmpty()


_END = "\x01"  # a field put after the last one, to tell empty fields from those that aren't there


def _records(spark: SparkSession, path: str) -> DataFrame:
    """(record): each record of a CSV as it stands, line breaks within quotes included.

    Files with such a break are read each by one task, as a stream; all others
    are split.
    """
    if not has_line_breaks(spark, path):
        return spark.read.text(path).select(F.col("value").alias("record"))
    # records don't fit a schema of one field, and are given whole then
    one = T.StructType([T.StructField("_first", T.StringType()), T.StructField("_record", T.StringType())])
    rows = spark.read.csv(path, schema=one, header=False, encoding="UTF-8", mode="PERMISSIVE", columnNameOfCorruptRecord="_record", quote='"', escape='"', multiLine=True, maxCharsPerColumn=-1)
    return rows.select(F.coalesce("_record", "_first", F.lit("")).alias("record"))


def _rows(spark: SparkSession, path: str, schema, least: int) -> DataFrame:
    """Rows of a headerless CSV with at least ``least`` fields each; a byte order mark is dropped.

    Fields may be quoted; within quotes a comma, a line break or a doubled quote
    is part of the field. A field that isn't there is null, an empty one ''.
    """
    names = schema.fieldNames()
    record = F.regexp_replace("record", "^\ufeff", "")
    fields = T.StructType([T.StructField(f"f{k}", T.StringType()) for k in range(len(names) + 1)])
    options = {"quote": '"', "escape": '"', "multiLine": "true", "nullValue": "\x00", "emptyValue": "", "maxCharsPerColumn": "-1"}
    parsed = F.from_csv(F.concat(record, F.lit(f",{_END}")), F.lit(fields.simpleString().removeprefix("struct<").removesuffix(">").replace(":", " ").replace(",", ", ")), options)
    # exploded, so that a record is parsed once: Spark else parses it anew for each use of a field
    rows = _records(spark, path).where(F.trim(record) != "").select(F.explode(F.array(parsed)).alias("x"), record.alias("record"))
    rows = rows.withColumn("n", F.array_position(F.array(*[f"x.f{k}" for k in range(len(names) + 1)]), _END))  # fields and one; 0: more than are asked for
    there = lambda k: (F.col("n") == 0) | (F.col("n") > k + 1)
    first = F.coalesce(F.col("x.f0"), F.lit(""))
    checked = F.when((strip(first) != "") & ~there(least - 1), F.raise_error(F.concat(F.lit(f"fewer than {least} fields: "), F.col("record")))).otherwise(first)
    rows = rows.select(checked.cast("string").alias(names[0]), *[F.when(there(k), F.coalesce(F.col(f"x.f{k}"), F.lit(""))).alias(n) for k, n in enumerate(names) if k])
    return rows.where(strip(F.col(names[0])) != "")


def read_companies(spark: SparkSession, path: str) -> DataFrame:
    """mst, name, sector, address, revenue, report_date and, where given, status, all as strings; rows without key are dropped."""
    return _rows(spark, path, RAW_COMPANY, 6)


def read_invoices(spark: SparkSession, path: str) -> DataFrame:
    """Seven leading fields of each invoice; more are ignored."""
    return _rows(spark, path, RAW_INVOICE, 7)


def companies(raw: DataFrame) -> DataFrame:
    """Trimmed companies; no revenue is 0, no status stays unknown."""
    blank = lambda c: F.nullif(strip(F.col(c)), F.lit(""))
    return raw.select(
        strip(F.col("mst")).alias("mst"),
        *[F.coalesce(strip(F.col(c)), F.lit("")).alias(c) for c in ("name", "sector", "address")],
        F.coalesce(blank("revenue").try_cast("double"), F.lit(0.0)).alias("revenue"),
        F.coalesce(strip(F.col("report_date")), F.lit("")).alias("report_date"),
        blank("status").alias("status"),
    )


def invoices(raw: DataFrame) -> DataFrame:
    """seller, buyer, day, period and whole amounts of raw invoices."""
    whole = lambda c: F.coalesce(F.nullif(strip(F.col(c)), F.lit("")).cast("double"), F.lit(0.0)).cast("bigint")
    return raw.select(
        F.col("so_hoa_don").alias("invoice_id"),
        strip(F.col("mst_nguon")).alias("seller_mst"),
        strip(F.col("mst_dich")).alias("buyer_mst"),
        strip(F.col("ngay_xuat")).alias("day"),
        to_period(F.col("ngay_xuat")).alias("period"),
        whole("tien_chua_thue").alias("amount"),
        whole("thue_gtgt").alias("vat"),
    )


def read_tables(spark: SparkSession, path: str, partial: bool = False) -> dict[str, DataFrame]:
    """The tables of a dataset folder; optional ones that aren't there are left out (``partial``: any). A change that was broken off while it took effect is completed first."""
    complete(spark, path)
    out = {}
    for name, schema in TABLES.items():
        try:
            out[name] = spark.read.schema(schema).parquet(f"{path}/{name}")
        except Exception as e:
            if not (partial or name in OPTIONAL) or "PATH_NOT_FOUND" not in str(e):
                raise
    return out


def invoice_rows(invoices: DataFrame) -> DataFrame:
    """(einvoice_row_id, seller_mst, buyer_mst, period) of ``invoices``, to trace edges back to them."""
    return invoices.select(F.col("invoice_id").alias("einvoice_row_id"), "seller_mst", "buyer_mst", "period")


def sections(rows: DataFrame, order: str, label: str, markers: dict[str, str], end: str, header: str | None = None, required: str | None = None) -> DataFrame:
    """Rows of a flattened sheet that lie between a marker row and the next end row, with the section they lie in.

    order: column that numbers the rows of a sheet; label: the column that
    holds markers. header: rows whose label is this text, in any case, repeat
    the sheet's header and are dropped; required: rows without a value in this
    column (such as the invoice number) are dropped. Where there is a column
    ``sheet``, each sheet is on its own; without it, all rows are one sheet.
    """
    from pyspark.sql import Window as W

    text = F.lower(F.coalesce(F.col(label), F.lit("")))
    mark = F.coalesce(*[F.when(text.contains(k.lower()), F.lit(v)) for k, v in markers.items()], F.when(text.contains(end.lower()), F.lit("")))
    sheet = F.col("sheet") if "sheet" in rows.columns else F.lit(0)
    section = F.last(mark, ignorenulls=True).over(W.partitionBy(sheet).orderBy(order))
    keep = F.col("_mark").isNull() & (F.col("section") != "")
    if header is not None:
        keep &= F.trim(text) != header.strip().lower()
    if required is not None:
        keep &= F.coalesce(F.trim(F.col(required).cast("string")), F.lit("")) != ""
    return rows.withColumn("_mark", mark).withColumn("section", section).where(keep).drop("_mark")
