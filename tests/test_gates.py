"""Gates: Q1 row explosion, data tests, freshness, contract, audit verdicts."""

import datetime as dt

import pytest

from orderlake.operators import gates as G
from orderlake.operators import history as H

D = dt.date(2025, 6, 1)


def test_row_gate_ratio_and_empty_input():
    assert not G.RowGate(100_000, 180_000).passed
    with pytest.raises(G.GateError):
        G.RowGate(100_000, 180_000).enforce()
    assert G.RowGate(0, 0).passed and G.RowGate(0, 0).ratio == 0
    assert G.RowGate(100, 110).passed


def test_row_gate_frame(spark):
    a = spark.range(100)
    b = spark.range(180)
    r = G.row_gate_frame(a, b).first()
    assert (r["input_rows"], r["output_rows"], r["status"]) == (100, 180, "FAIL")


def test_data_tests_counts(spark):
    df = spark.createDataFrame(
        [("A", "U", 1.0, "USD", D, "s", 1), ("A", None, -1.0, "usd", D, "s", -2),
         ("B", "U", None, "JPY", D, "s", 0)],
        "order_id string, user_id string, amount double, currency string, process_date date, "
        "user_segment string, event_count int")
    res = {r["test_name"]: r["failures"] for r in G.data_tests(df).collect()}
    assert res["not_null_user_id"] == 1 and res["not_null_amount"] == 1
    assert res["unique_order_id"] == 1
    assert res["expression_is_true_amount_gt_0"] == 1      # NULL is not a failure
    assert res["expression_is_true_event_count_ge_0"] == 1
    assert res["accepted_values_currency"] == 2            # 'usd' and 'JPY'
    with pytest.raises(G.GateError):
        G.enforce_tests(G.data_tests(df))


def test_freshness_levels(spark):
    df = spark.createDataFrame([(D,)], "process_date date")
    assert G.freshness(df, "2025-06-02 00:00:00").first()["status"] == "pass"
    assert G.freshness(df, "2025-06-02 02:00:00").first()["status"] == "warn"
    assert G.freshness(df, "2025-06-02 07:00:00").first()["status"] == "error"


def test_contract_check_detects_type_change(spark):
    df = spark.createDataFrame([("A", 1)], "order_id string, amount int")
    rows = {r["column_name"]: r for r in G.contract_check(df)}
    assert rows["order_id"]["ok"] and not rows["amount"]["ok"]
    assert rows["updated_at"]["actual_type"] is None


def test_duplicate_dimension_keys(spark):
    df = spark.createDataFrame([("U1", "a"), ("U1", "b"), ("U2", "c")], "user_id string, s string")
    assert [r["user_id"] for r in G.duplicate_keys(df).collect()] == ["U1"]


CSV = "order_id string, user_id string, amount string, currency string, channel string, " \
      "product_sku string, process_date string"


def _audit(spark, src_rows, tgt_rows):
    src = spark.createDataFrame(src_rows, CSV)
    tgt = spark.createDataFrame(tgt_rows, "order_id string, amount double")
    return H.reconciliation_report(src, tgt, "2025-06-01").first()


def test_bad_history_rows_rejected_without_exception(spark):
    src = [("A", "U", "10.5", "USD", "web", "s", "2025-06-01"),
           ("B", "U", "abc", "USD", "web", "s", "2025-06-01"),
           ("C", "U", "3.0", "USD", "web", "s", "bad")]
    norm = H.normalize_history(spark.createDataFrame(src, CSV))
    clean, rejects = H.split_history(norm)
    assert [r["order_id"] for r in clean.collect()] == ["A"]
    reasons = {r["order_id"]: r["reject_reason"] for r in rejects.collect()}
    assert reasons == {"B": "unparseable amount", "C": "unparseable process_date"}
    r = _audit(spark, src, [("A", 10.5)])
    assert r["status"] == "SUCCESS" and r["filtered_row_count"] == 2


def test_audit_row_and_amount_mismatch(spark):
    src = [("A", "U", "10.00", "USD", "web", "s", "2025-06-01"),
           ("B", "U", "5.00", "USD", "web", "s", "2025-06-01")]
    assert _audit(spark, src, [("A", 10.0), ("B", 5.0)])["status"] == "SUCCESS"
    r = _audit(spark, src, [("A", 10.0)])
    assert r["status"] == "MISMATCH" and r["message"].startswith("Row count discrepancy")
    r = _audit(spark, src, [("A", 10.0), ("B", 5.02)])
    assert r["status"] == "MISMATCH" and r["message"].startswith("Sum of amount discrepancy")
    assert _audit(spark, src, [("A", 10.0), ("B", 5.005)])["status"] == "SUCCESS"


def test_report_doc_id():
    assert H.report_doc_id("2025/06/*") == "2025_06_all"
