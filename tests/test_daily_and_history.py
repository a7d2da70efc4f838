"""Daily run over drop files (S1–S3, B1, H12), run-date check (Q15),
history ranges (S9/B2) and the audit report store (K8)."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake.plans.daily import parse_run_date, run_daily
from orderlake.plans.history import audit, export_history_csv, run_history
from orderlake.sources.files import read_history_range, read_processed, read_segments

D = "2025-06-01"


def test_parse_run_date():
    assert parse_run_date("2025-06-01") == dt.date(2025, 6, 1)
    for bad in ("06/01/2025", "20250601", "2025-W23-1", "2025-06-01 ", dt.datetime(2025, 6, 1, 2), None):
        with pytest.raises(ValueError):
            parse_run_date(bad)


def _drops(spark, root):
    o = spark.createDataFrame(
        [("ORD-1", "U1", 2450.0, "INR", dt.date(2025, 6, 1), "open"),
         ("ORD-1", "U1", 2450.0, "INR", dt.date(2025, 6, 1), "open"),
         ("ORD-2", "U2", 10.0, "USD", dt.date(2025, 6, 1), "open")],
        "order_id string, user_id string, amount double, currency string, process_date date, "
        "status string")
    o.write.mode("overwrite").parquet(f"{root}/orders/orders_{D}.parquet")
    e = spark.createDataFrame([("e1", "U1", "view", "2025-06-01T10:00:00")],
                              "event_id string, user_id string, action_type string, timestamp string")
    e.write.mode("overwrite").parquet(f"{root}/events/events_{D}.parquet")
    s_old = spark.createDataFrame([("U1", "budget"), ("U2", "new")], "user_id string, segment string")
    s_new = spark.createDataFrame([("U1", "premium"), ("U2", "new")], "user_id string, segment string")
    s_old.coalesce(1).write.mode("overwrite").parquet(f"{root}/segments/a_2025-05-25")
    # the newest drop is a folder of several part files: all of them count
    s_new.repartition(2).write.mode("overwrite").parquet(f"{root}/segments/b_2025-06-01")


def test_run_daily_from_drop_files(spark, tmp_root):
    root, out = f"{tmp_root}/validated", f"{tmp_root}/processed"
    _drops(spark, root)
    seg = read_segments(spark, root)
    assert dict(seg.select("user_id", "user_segment").collect()) == {"U1": "premium", "U2": "new"}
    res = run_daily(spark, root, out, D, tie_breakers=["amount desc"])
    assert (res.rows_in, res.rows_out, res.status) == (2, 2, "SUCCESS")
    rows = {r["order_id"]: r for r in read_processed(spark, out).collect()}
    assert rows["ORD-1"]["user_segment"] == "premium" and rows["ORD-1"]["event_count"] == 1
    assert "status" not in read_processed(spark, out).columns
    run_daily(spark, root, out, D)                       # re-run: same table
    assert read_processed(spark, out).count() == 2


def _history(spark, root):
    rows = spark.createDataFrame(
        [("A", "U", "10.0", "USD", "web", "s", "2025-06-01", "2025-06-01"),
         ("B", "U", "abc", "USD", "web", "s", "2025-06-02", "2025-06-02"),
         ("C", "U", "5.0", "USD", "web", "s", "bad", "2025-06-02"),
         ("D", "U", "7.0", "USD", "web", "s", "2025-06-03", "2025-06-03")],
        "order_id string, user_id string, amount string, currency string, channel string, "
        "product_sku string, process_date string, date string")
    export_history_csv(rows, root)


def test_history_range_reads_only_its_folders(spark, tmp_root):
    csv = f"{tmp_root}/csv"
    _history(spark, csv)
    rng = read_history_range(spark, csv, "2025-06-02", "2025-06-03")
    plan = rng._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters" in plan
    assert sorted(r["order_id"] for r in rng.collect()) == ["B", "C", "D"]
    out, rej = f"{tmp_root}/clean", f"{tmp_root}/rej"
    run_history(spark, csv, out, rej, start="2025-06-02", end="2025-06-03")
    assert [r["order_id"] for r in read_processed(spark, out).collect()] == ["D"]
    assert sorted(r["order_id"] for r in read_processed(spark, rej).collect()) == ["B", "C"]


def test_audit_report_upsert_by_date(spark, tmp_root):
    csv, out, reports = f"{tmp_root}/csv", f"{tmp_root}/clean", f"{tmp_root}/reports"
    _history(spark, csv)
    run_history(spark, csv, out)
    r = audit(spark, csv, out, "2025-06", report_root=reports,
              audited_at="2026-01-01 00:00:00").first()
    assert r["status"] == "SUCCESS" and r["target_row_count"] == 2
    audit(spark, csv, out, "2025-06", report_root=reports, audited_at="2026-01-02 00:00:00")
    stored = spark.read.parquet(reports)
    assert stored.count() == 1 and stored.first()["doc_id"] == "2025-06"
    with pytest.raises(Exception):
        spark.read.parquet(out).where(F.col("order_id") == "D").write.mode("overwrite") \
            .parquet(f"{tmp_root}/partial")
        audit(spark, csv, f"{tmp_root}/partial", "x", raise_on_mismatch=True)


def test_late_rows_default_to_sibling_table(spark, tmp_root):
    from orderlake.plans.daily import run_enrichment
    o = spark.createDataFrame([("A", "U", 1.0, "USD", dt.date(2025, 6, 1)),
                               ("B", "U", 2.0, "USD", dt.date(2025, 5, 30))],
                              "order_id string, user_id string, amount double, currency string, "
                              "process_date date")
    e = spark.createDataFrame([], "event_id string, user_id string, event_type string")
    s = spark.createDataFrame([("U", "gold")], "user_id string, segment string")
    res = run_enrichment(spark, o, e, s, f"{tmp_root}/p", run_dates=[D])
    assert res.late_rows == 1
    assert [r["order_id"] for r in read_processed(spark, f"{tmp_root}/p_late").collect()] == ["B"]
