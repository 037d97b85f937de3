"""Sources and the datasets they fill: quoted CSV, workbooks, changes that take effect as a whole, replayed batches."""

import csv
import io
import json
import random
import zipfile

import pytest
from loopwise import scratch
from loopwise.__main__ import main
from loopwise.operators import contract, links
from loopwise.plans import circular
from loopwise.sources import raw, workbook
from loopwise.streaming.monthly import merge_batch, upsert_stream
from pyspark.sql import functions as F

from .test_operators import graph

COLUMNS = ["mst", "name", "sector", "address", "revenue", "report_date", "status"]


def read(spark, path, least=6):
    rows = raw._rows(spark, str(path), raw.RAW_COMPANY, least)
    return sorted(tuple(r) for r in rows.select(*COLUMNS).collect())


def plain(path):
    with open(path, encoding="utf-8-sig", newline="") as f:
        return sorted((*r[:7], *[None] * (7 - len(r))) for r in csv.reader(f) if r and r[0].strip())


@pytest.mark.parametrize("breaks", [False, True])
def test_quoted_fields_are_read_as_pythons_reader_does(spark, tmp_path, breaks):
    rnd = random.Random(5)
    pieces = ['"', '""', ",", "a", "Công ty", " ", "x,y", "'", "\\", "; "] + ["\n", "\r\n"] * breaks
    rows = [[f"{k:04d}", *("".join(rnd.choice(pieces) for _ in range(rnd.randrange(5))) for _ in range(rnd.choice([5, 6])))] for k in range(300)]
    with open(tmp_path / "c.csv", "w", encoding="utf-8", newline="") as f:
        f.write("﻿")
        csv.writer(f).writerows(rows)
        f.write("\r\n\r\n")
    assert raw.has_line_breaks(spark, str(tmp_path / "c.csv")) == breaks
    assert read(spark, tmp_path / "c.csv") == plain(tmp_path / "c.csv") and len(plain(tmp_path / "c.csv")) == 300


def test_the_row_that_shifted(spark, tmp_path):
    (tmp_path / "c.csv").write_text('﻿"0100","CTY ""A, B"" VN",sec,"addr\nline 2",1,2021,on\n', encoding="utf-8")
    assert read(spark, tmp_path / "c.csv") == [("0100", 'CTY "A, B" VN', "sec", "addr\nline 2", "1", "2021", "on")]


def book(sheets, inline=False):
    """A workbook in bytes: sheets {name: rows}."""
    out, shared = io.BytesIO(), []
    esc = lambda t: str(t).replace("&", "&amp;").replace("<", "&lt;")
    main, rel = "http://schemas.openxmlformats.org/spreadsheetml/2006/main", "http://schemas.openxmlformats.org/officeDocument/2006/relationships"
    with zipfile.ZipFile(out, "w") as z:
        z.writestr("xl/workbook.xml", f'<workbook xmlns="{main}" xmlns:r="{rel}"><sheets>' + "".join(f'<sheet name="{esc(n)}" sheetId="{k}" r:id="rId{k}"/>' for k, n in enumerate(sheets, 1)) + "</sheets></workbook>")
        z.writestr("xl/_rels/workbook.xml.rels", '<Relationships xmlns="http://schemas.openxmlformats.org/package/2006/relationships">' + "".join(f'<Relationship Id="rId{k}" Target="worksheets/sheet{k}.xml"/>' for k in range(1, len(sheets) + 1)) + "</Relationships>")
        for k, rows in enumerate(sheets.values(), 1):
            xml = f'<worksheet xmlns="{main}"><sheetData>'
            for i, row in enumerate(rows, 1):
                xml += f'<row r="{i}">'
                for j, v in enumerate(row):
                    at = f"{chr(65 + j)}{i}"
                    if v is None:
                        continue
                    if isinstance(v, (int, float)):
                        xml += f'<c r="{at}"><v>{v}</v></c>'
                    elif inline:
                        xml += f'<c r="{at}" t="inlineStr"><is><r><t>{esc(v)[:1]}</t></r><r><t>{esc(v)[1:]}</t></r></is></c>' if len(v) > 1 and "&" not in v and "<" not in v else f'<c r="{at}" t="inlineStr"><is><t>{esc(v)}</t></is></c>'
                    else:
                        shared.append(v)
                        xml += f'<c r="{at}" t="s"><v>{len(shared) - 1}</v></c>'
                xml += "</row>"
            z.writestr(f"xl/worksheets/sheet{k}.xml", xml + "</sheetData></worksheet>")
        z.writestr("xl/sharedStrings.xml", f'<sst xmlns="{main}">' + "".join(f"<si><t>{esc(s)}</t></si>" for s in shared) + "</sst>")
    return out.getvalue()


def test_a_workbook_gives_the_tables_of_its_csv(spark, tmp_path):
    companies = [[f"{k}", f"Company <{k}> & co", "x", "9 same street" if k < 2 else f"{k} street", 5, "2021"] for k in range(4)] + [["7", "no address", None, None, None, "2021"]]
    invoices = [[f"n{k}", 44211 + k if k % 2 else f"2021-01-{15 + k}", a, b, "goods, more", 100, 10] for k, (a, b) in enumerate([("0", "1"), ("1", "2"), ("2", "0"), ("2", "3")])]
    (tmp_path / "books").mkdir()
    head = lambda rows: [[f"h{k}" for k in range(len(rows[0]))], *rows]
    (tmp_path / "books/a.xlsx").write_bytes(book({"companies": head(companies), "invoices": head(invoices[:2])}))
    (tmp_path / "books/b.xlsx").write_bytes(book({"other": [["x"]], "invoices": head(invoices[2:])}, inline=True))
    for name, rows in (("c.csv", companies), ("i.csv", [[r[0], f"2021-01-{15 + k}", *r[2:]] for k, r in enumerate(invoices)])):
        with open(tmp_path / name, "w", newline="") as f:
            csv.writer(f).writerows(rows)
    args = ["--root", str(tmp_path), "--ingest-only"]
    assert main([*args, "--dataset", "w", "--workbook", str(tmp_path / "books")]) == 0
    assert main([*args, "--dataset", "v", "--companies", str(tmp_path / "c.csv"), "--invoices", str(tmp_path / "i.csv"), "--datasource", "csv"]) == 0
    for t in ("company", "trades", "shares_address", "invoices"):
        a, b = ({tuple(r) for r in spark.read.parquet(str(tmp_path / d / t)).collect()} for d in ("w", "v"))
        assert a == b and a


def test_columns_of_a_sheet_by_their_headers(spark, tmp_path):
    (tmp_path / "a.xlsx").write_bytes(book({"s": [["title"], ["No", " Day ", "Sum"], [1, "x", 3.5], [2, None, 4]]}))
    (tmp_path / "b.xlsx").write_bytes(book({"s": [[None, "title"], ["Sum", "No"], [9, 3]]}))
    rows = workbook.by_header(workbook.read_workbooks(spark, str(tmp_path)), "s", 2, {"No": "n", "Day": "day", "Sum": "sum"})
    assert sorted((r.n, r.day, r.sum) for r in rows.collect()) == [("1", "x", "3.5"), ("2", None, "4"), ("3", None, "9")]
    flat = workbook.read_workbooks(spark, str(tmp_path)).select("sheet", "i", workbook.cell(1).alias("label"), workbook.cell(2).alias("v")).where("file like '%a.xlsx'")
    assert [r.label for r in raw.sections(flat, "i", "label", {"title": "t"}, "end").orderBy("i").collect()] == ["No", "1", "2"]


def test_sources_of_the_manifest():
    assert contract.source_of({"companies": "a", "invoices": "b"}) == "csv" and contract.source_of({}) == "local_existing" and contract.source_of({"lake": "x"}, "lake") == "lake"
    for given, name in (({"companies": "a"}, None), ({"lake": "x"}, "csv"), ({}, "nowhere"), ({"lake": "x", "workbook": "y"}, None)):
        with pytest.raises(ValueError):
            contract.source_of(given, name)


def company(spark, *keys):
    return spark.createDataFrame([(k, f"name of {k}", None) for k in keys], "mst string, name string, status string")


def trades(spark, *months):
    return graph(spark, [("A", "B", m, x, 1) for m, x in months])


def stored(spark, path):
    t = raw.read_tables(spark, path)
    return {r.mst for r in t["company"].collect()}, {(r.period, r.total_amount) for r in t["trades"].collect()}


def test_a_failed_ingest_changes_nothing(spark, tmp_path, monkeypatch):
    path = str(tmp_path / "d")
    circular.save({"company": company(spark, "A", "B"), "trades": trades(spark, (202101, 1), (202102, 2))}, path)
    assert stored(spark, path) == ({"A", "B"}, {(202101, 1.0), (202102, 2.0)})
    broken = trades(spark, (202102, 7)).withColumn("total_amount", F.raise_error(F.lit("lost")).cast("double"))
    with pytest.raises(Exception, match="lost"):
        circular.save({"company": company(spark, "C"), "trades": broken}, path)
    assert stored(spark, path) == ({"A", "B"}, {(202101, 1.0), (202102, 2.0)}) and not list((tmp_path / "d").glob(".staged-*"))
    # cut off after the journal: the next reader completes the change, from whatever step
    real, count = scratch._files, [0]

    def breaks(*a):
        count[0] += 1
        if count[0] > 9:
            raise KeyboardInterrupt
        return real(*a)

    monkeypatch.setattr(scratch, "_files", breaks)
    with pytest.raises(KeyboardInterrupt):
        circular.save({"company": company(spark, "C"), "trades": trades(spark, (202102, 7))}, path)
    monkeypatch.undo()
    assert (tmp_path / "d/.journal").exists()
    assert stored(spark, path) == ({"C"}, {(202101, 1.0), (202102, 7.0)})
    assert sorted(x.name for x in (tmp_path / "d").iterdir() if not x.name.endswith(".crc")) == ["company", "trades"]


def test_rebuild_and_merge(spark, tmp_path):
    path = str(tmp_path / "d")
    steps = circular.Steps()
    pair = spark.createDataFrame([("A", "B", "x")], "company_a string, company_b string, norm_addr string")
    circular.save({"company": company(spark, "A", "B"), "trades": trades(spark, (202101, 1)), "shares_address": pair}, path, steps)
    assert [(s["step"], s["rows"]) for s in steps.done] == [("write company", 2), ("write trades", 1), ("write shares_address", 1)]
    circular.save({"company": company(spark, "B", "C").withColumn("name", F.lit("new"))}, path, merge=True)
    assert {(r.mst, r.name) for r in raw.read_tables(spark, path)["company"].collect()} == {("A", "name of A"), ("B", "new"), ("C", "new")}
    circular.save({"company": company(spark, "D"), "trades": trades(spark, (202103, 3))}, path, rebuild=True)
    assert stored(spark, path) == ({"D"}, {(202103, 3.0)}) and "shares_address" not in raw.read_tables(spark, path)


def test_an_address_of_very_many_companies(spark, tmp_path, monkeypatch):
    n = 10_000
    (tmp_path / "c.csv").write_text("".join(f"{k},Company {k},x,{'1 hot street' if k < n else f'{k} street'},5,2021\n" for k in range(n + 3)))
    rows = [(0, 5), (5, 77), (77, 0), (n, n + 1), (n + 1, n + 2), (n + 2, n)]
    (tmp_path / "i.csv").write_text("".join(f"n{k},2021-01-15,{a},{b},goods,100,10\n" for k, (a, b) in enumerate(rows)))
    assert main(["--root", str(tmp_path), "--dataset", "d", "--companies", str(tmp_path / "c.csv"), "--invoices", str(tmp_path / "i.csv"), "--no-metrics"]) == 0
    found = [json.loads(x) for p in (tmp_path / "d/runs/run/graph_risk_flags").glob("part-*") for x in p.read_text().splitlines()]
    assert {r["cycle_id"]: r["score_hidden_link"] for r in found} == {"0|5|77": 25.0, f"{n}|{n + 1}|{n + 2}": 0.0}
    checks = {c.id: c for c in contract.validate(raw.read_tables(spark, str(tmp_path / "d")))}
    assert checks["shares_address"].status == "pass" and checks["shares_address"].count == n * (n - 1) // 2


def test_groups_say_what_pairs_say(spark):
    rnd = random.Random(1)
    addresses = spark.createDataFrame([(f"c{rnd.randrange(30)}", f"a{rnd.randrange(12)}") for _ in range(60)], "mst string, norm_addr string")
    phones = spark.createDataFrame([(f"c{rnd.randrange(30)}", f"0{rnd.randrange(8)}") for _ in range(40)], "mst string, phone string")
    reps = spark.createDataFrame([(f"p{rnd.randrange(9)}", f"c{rnd.randrange(30)}") for _ in range(20)], "person_id string, mst string")
    owns = spark.createDataFrame([("c1", "c2"), ("c2", "c1"), ("c3", "c3")], "owner string, owned string")
    groups = links.hidden_groups(addresses, phones, reps, owns)
    pairs = links.hidden_pairs(links._pairs(addresses.distinct(), "norm_addr"), links.phone_pairs(phones), reps, owns)
    joined = groups.alias("a").join(groups.alias("b"), F.expr("a.grp = b.grp and a.mst < b.mst")).select("a.mst", "b.mst").distinct()
    assert {tuple(r) for r in joined.collect()} == {tuple(r) for r in pairs.collect()}
    assert links.hidden_groups() is None


def test_a_batch_that_comes_again_counts_once(spark, tmp_path):
    rows = spark.createDataFrame([("A", "B", 202101, "2021-01-02", 5, 1), ("A", "B", 202102, "2021-02-02", 7, 1)], "seller_mst string, buyer_mst string, period int, day string, amount bigint, vat bigint")
    path = str(tmp_path / "t")
    for n in (0, 0, 1, 1, 0):
        merge_batch(rows if n == 0 else rows.where("period = 202101"), path, n)
    got = lambda: sorted((r.period, r.invoice_count) for r in spark.read.parquet(path).collect())
    assert got() == [(202101, 2), (202102, 1)]
    merge_batch(rows, path)
    assert got() == [(202101, 3), (202102, 2)]
    merge_batch(rows.limit(0), path, 5)
    rows.write.parquet(str(tmp_path / "in"))
    for _ in range(2):
        query = upsert_stream(spark.readStream.schema(rows.schema).parquet(str(tmp_path / "in")), str(tmp_path / "u"), str(tmp_path / "c")).trigger(availableNow=True).start()
        query.awaitTermination(120)
    assert sorted((r.period, r.invoice_count) for r in spark.read.parquet(str(tmp_path / "u")).collect()) == [(202101, 1), (202102, 1)]
