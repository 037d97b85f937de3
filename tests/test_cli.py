"""Whole runs of the command: from CSV files and from a lake to every file, and what is left when a run fails."""

import json
import random

import pytest
from loopwise import scratch
from loopwise.__main__ import main
from loopwise.plans import circular
from loopwise.session import session
from loopwise.sources import lake

FILES = {"scored", "graph_risk_flags", "invoice_loops", "company_metrics", "invoice_flags", "report.md", "top.json", "cycles.sql", "meta.json", "validation.json"}


def names(path):
    return {x.name for x in path.iterdir() if not x.name.startswith((".", "_"))}


def text_of(path):
    return "".join(p.read_text() for p in sorted(path.glob("part-*")))


def test_from_csv(spark, tmp_path):
    (tmp_path / "c.csv").write_text("".join(f"{k},Company {k},x,{k} street,5,2021\n" for k in "ABCD"))
    rows = [("A", "B", 1), ("B", "C", 1), ("C", "A", 2), ("A", "D", 2)]
    (tmp_path / "i.csv").write_text("".join(f"n{k},2021-0{m}-15,{a},{b},goods,100,10\n" for k, (a, b, m) in enumerate(rows)))
    args = ["--root", str(tmp_path), "--dataset", "data", "--threshold", "40", "--row-budget", "1000", "--time-budget", "600"]
    assert main([*args, "--companies", str(tmp_path / "c.csv"), "--invoices", str(tmp_path / "i.csv")]) == 0
    run = tmp_path / "data/runs/run"
    assert names(run) == FILES
    flagged = [json.loads(x) for p in sorted((run / "invoice_flags").glob("part-*")) for x in p.read_text().splitlines()]
    assert sorted(r["einvoice_row_id"] for r in flagged) == ["n0", "n1", "n2"] and {tuple(r["cycle_ids"]) for r in flagged} == {("A|B|C",)}
    meta = json.loads(text_of(run / "meta.json"))
    assert meta["invoice_flags"] is True and meta["truncated"] is False and meta["row_budget"] == 1000
    # a second run takes the place of the first; another one leaves it
    assert main([*args, "--no-metrics"]) == 0 and names(run) == FILES - {"company_metrics"}
    assert main([*args, "--run-id", "other", "--row-budget", "1"]) == 0 and json.loads(text_of(tmp_path / "data/runs/other/meta.json"))["truncated"] is True
    assert main([*args, "--skip-detect"]) == 0 and names(tmp_path / "data/runs") == {"run", "other"}


def test_a_failed_run_leaves_the_last_one(spark, tmp_path, monkeypatch):
    company = spark.createDataFrame([(k, k, None) for k in "ABC"], "mst string, name string, status string")
    trades = spark.createDataFrame([(a, b, 202101, 1, 100.0, 10.0, "2021-01-01", "2021-01-02") for a, b in ("AB", "BC", "CA")], "seller_mst string, buyer_mst string, period int, invoice_count bigint, total_amount double, total_vat double, first_date string, last_date string")
    tables = {"company": company, "trades": trades}
    out = tmp_path / "out"
    circular.run(spark, tables, str(out))
    before = names(out)
    monkeypatch.setattr(circular.report, "report_files", lambda *a: 1 / 0)
    with pytest.raises(ZeroDivisionError):
        circular.run(spark, tables, str(out))
    assert names(out) == before and names(tmp_path) == {"out"}
    # flags are best effort
    monkeypatch.undo()
    bad = spark.createDataFrame([("x",)], "einvoice_row_id string")
    meta = circular.run(spark, tables, str(out), invoices=bad)
    assert meta["invoice_flags"] is False and "report.md" in names(out)


def lake_of(spark, path):
    rnd = random.Random(3)
    pairs = [("1", "2"), ("2", "3"), ("3", "1"), ("3", "4")]
    invoices = [(f"r{k}", "ban", a, a, b, "1", "C", str(k), "new", f"2021-01-{10 + k} 08:00:00", 100.0, 10.0, k) for k, (a, b) in enumerate(pairs)]
    invoices += [("r9", "ban", "1", "1", "2", "1", "C", "0", "new", "2021-01-20 08:00:00", 100.0, 10.0, 99)]  # a newer entry of the first
    t = {
        "einvoice_invoice": (invoices, "einvoice_row_id string, chieu string, mst_ban string, mst_ban_goc string, mst_mua_goc string, ky_hieu_mau_so string, ky_hieu_hd string, so_hd string, trang_thai_hd string, ngay_lap string, tien_chua_thue double, tien_thue double, ictrl_dt int"),
        "company_header": (
            [(str(k), f"Company {k}", f"{k} some long street", "", "2001-01-01", "Nguyễn Văn A" if k < 3 else f"Trần {k}", "0900000001" if k in (2, 3) else f"090000100{k}", "active", 1) for k in range(1, 6)],
            "mst string, ten_cong_ty string, dia_chi string, trang_thai string, ngay_hoat_dong string, dai_dien_phap_luat string, dien_thoai_tru_so string, record_status string, ictrl_dt int",
        ),
        "company_industry": ([("1", "trade", True, 1)], "mst string, ten_nganh string, nganh_chinh boolean, ictrl_dt int"),
        "tax_declaration_bctc_filing_header": ([("4", "Filer", "4 filed address", 1, "2021-03-01", 1, "2021")], "mst string, ten_nnt string, dchi_nnt string, so_lan int, ngay_lap_tkhai string, load_ts int, ictrl_dt string"),
        "tax_declaration_bctc_item_value": ([("1", "Ct10", "KQKD", "nam_nay", 7.0, 1)], "mst string, item_code string, statement_code string, period_scope string, item_value_num double, ictrl_dt int"),
    }
    feature = ([("1", 2021, lake.BENFORD, rnd.random())], "mst string, fiscal_year int, feature_name string, feature_value_num double")
    for name, (rows, schema) in (t | {"tax_declaration_gtgt_tndn_t2_feature_value": feature, "risks": feature}).items():
        spark.createDataFrame(rows, schema).write.parquet(f"{path}/{name}")


def test_from_a_lake(spark, tmp_path):
    lake_of(spark, tmp_path / "lake")
    args = ["--root", str(tmp_path), "--dataset", "data", "--lake", str(tmp_path / "lake"), "--lake-table", "risk=risks"]
    assert main(args) == 0
    data = tmp_path / "data"
    assert names(data) == {"company", "trades", "shares_address", "shares_phone", "legal_reps", "persons", "invoices", "runs"}
    read = lambda t: spark.read.parquet(str(data / t)).collect()
    assert [(r.company_a, r.company_b, r.norm_phone) for r in read("shares_phone")] == [("2", "3", "0900000001")]
    assert {r.mst for r in read("company")} == {"1", "2", "3", "4"} and len(read("persons")) == 3 and len(read("legal_reps")) == 4
    assert sorted((r.seller_mst, r.buyer_mst, r.invoice_count) for r in read("trades")) == [("1", "2", 1), ("2", "3", 1), ("3", "1", 1), ("3", "4", 1)]
    run = data / "runs/run"
    assert names(run) == FILES
    row = json.loads(text_of(run / "graph_risk_flags"))
    assert row["members"] == ["1", "2", "3"] and row["score_hidden_link"] == 25  # phone and representative
    flagged = [json.loads(x)["einvoice_row_id"] for p in (run / "invoice_flags").glob("part-*") for x in p.read_text().splitlines()]
    assert sorted(flagged) == ["r0", "r1", "r2", "r9"]


def test_sources_of_a_lake(spark, tmp_path):
    spark.sql("CREATE DATABASE IF NOT EXISTS some_lake")
    spark.createDataFrame([(1,)], "x int").write.mode("overwrite").saveAsTable("some_lake.t")
    got = lake.read_lake(spark, "catalog:some_lake", dict.fromkeys(lake.LAKE_TABLES, "t"))
    assert set(got) == set(lake.LAKE_TABLES) and got["header"].count() == 1
    spark.sql("DROP TABLE some_lake.t")


def test_counts_are_checked(spark, tmp_path):
    path = str(tmp_path / "t")
    assert scratch.write_counted(spark.range(7), path) == 7
    with pytest.raises(RuntimeError, match="holds 14 rows, 7 were written"):
        scratch.write_counted(spark.range(7), path, mode="append")


def test_bad_calls(spark, tmp_path):
    for args in (["--companies", "x"], ["--companies", "x", "--invoices", "y", "--lake", "z"]):
        with pytest.raises(SystemExit):
            main(["--root", str(tmp_path), "--dataset", "d", *args])
    with pytest.raises(ValueError):
        main(["--root", str(tmp_path), "--dataset", "../d"])
    assert session("again") is not None
