"""Workbooks (.xlsx): their sheets as rows of texts, read from any place that Spark reads."""

from __future__ import annotations

import io
import re
import zipfile
from collections.abc import Iterator
from xml.etree import ElementTree

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

_MAIN = "{http://schemas.openxmlformats.org/spreadsheetml/2006/main}"
_REL = "{http://schemas.openxmlformats.org/officeDocument/2006/relationships}"
_LETTERS = re.compile(r"[A-Z]+")
AT_ONCE = 2000  # rows of one Arrow batch


def _texts(element) -> str:
    """The text of a string item: of all its runs, without phonetic hints."""
    return "".join(t.text or "" for r in ([element, *element.findall(f"{_MAIN}r")]) for t in r.findall(f"{_MAIN}t"))


def _place(reference: str | None, after: int) -> int:
    """Column of a cell from 0, by its letters; a cell without reference follows the one before."""
    letters = _LETTERS.match(reference or "")
    if not letters:
        return after
    n = 0
    for c in letters[0]:
        n = n * 26 + ord(c) - 64
    return n - 1


def sheets(content: bytes) -> Iterator[tuple[str, int, list[str | None]]]:
    """(sheet, row from 1, cells) of all rows of a workbook, sheet by sheet, as streams; cells are the stored values as text, null where there is none."""
    with zipfile.ZipFile(io.BytesIO(content)) as book:
        shared: list[str] = []
        if "xl/sharedStrings.xml" in book.namelist():
            with book.open("xl/sharedStrings.xml") as f:
                for _, e in ElementTree.iterparse(f):
                    if e.tag == f"{_MAIN}si":
                        shared.append(_texts(e))
                        e.clear()
        target = {r.get("Id"): r.get("Target", "") for r in ElementTree.fromstring(book.read("xl/_rels/workbook.xml.rels"))}
        for sheet in ElementTree.fromstring(book.read("xl/workbook.xml")).iter(f"{_MAIN}sheet"):
            part = target[sheet.get(f"{_REL}id")]
            last = 0
            with book.open(part.lstrip("/") if part.startswith("/") else f"xl/{part}") as f:
                for _, row in ElementTree.iterparse(f):
                    if row.tag != f"{_MAIN}row":
                        continue
                    last = int(row.get("r") or last + 1)
                    cells: list[str | None] = []
                    for c in row.findall(f"{_MAIN}c"):
                        at = _place(c.get("r"), len(cells))
                        cells += [None] * (at + 1 - len(cells))
                        value, kind = c.find(f"{_MAIN}v"), c.get("t")
                        if kind == "inlineStr":
                            inline = c.find(f"{_MAIN}is")
                            cells[at] = None if inline is None else _texts(inline)
                        elif value is not None and value.text is not None:
                            cells[at] = shared[int(value.text)] if kind == "s" else value.text
                    yield sheet.get("name"), last, cells
                    row.clear()


def read_workbooks(spark: SparkSession, path: str) -> DataFrame:
    """(file, sheet, i, cells) of all rows of all sheets of the workbooks at ``path`` (a file, a folder, or a pattern); one task for each workbook."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def batch(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.string(), pa.string(), pa.int64(), pa.list_(pa.string()))
            return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows, strict=True), kinds, strict=True)], names=["file", "sheet", "i", "cells"])

        for some in batches:
            for name, content in zip(some.column("path").to_pylist(), some.column("content").to_pylist(), strict=True):
                rows: list[tuple] = []
                for row in sheets(content):
                    rows.append((name, *row))
                    if len(rows) == AT_ONCE:
                        yield batch(rows)
                        rows = []
                if rows:
                    yield batch(rows)

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.xlsx").load(path).select("path", "content")
    return files.mapInArrow(run, "file string, sheet string, i long, cells array<string>")


def cell(n: int) -> Column:
    """The n-th cell of a row, from 1; null beyond its end."""
    return F.try_element_at("cells", F.lit(n))


def by_position(rows: DataFrame, sheet: str, names: list[str], skip: int = 1) -> DataFrame:
    """The rows of a sheet after the first ``skip``, with the leading cells under these names."""
    return rows.where((F.col("sheet") == sheet) & (F.col("i") > skip)).select("file", "i", *[cell(k).alias(n) for k, n in enumerate(names, 1)])


def by_header(rows: DataFrame, sheet: str, header: int, names: dict[str, str]) -> DataFrame:
    """The rows of a sheet below its header row (counted from 1), of the columns whose header is a key of ``names``, under the names given for them.

    Workbooks may have their columns in different orders; a header that a
    workbook lacks gives nulls.
    """
    one = rows.where(F.col("sheet") == sheet)
    heads = one.where(F.col("i") == header).select("file", F.transform("cells", lambda c: F.trim(c)).alias("_head"))  # one row for each workbook
    values = lambda h: F.try_element_at("cells", F.nullif(F.array_position("_head", h), F.lit(0)).cast("int"))
    return one.where(F.col("i") > header).join(heads, "file").select("file", "i", *[values(h).alias(n) for h, n in names.items()])
