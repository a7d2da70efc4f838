"""Gold merge (J3/K4/E1), partitioned writes (K1, H8), re-run properties."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake.operators import gold as GD
from orderlake.operators.gates import GateError
from orderlake.operators.marts import (PartitionFilterRequired, guarded_read,
                                       require_partition_filter)
from orderlake.sinks import parquet as sink
from orderlake.sources.files import read_partition, read_processed

D1, D2, D3 = dt.date(2025, 6, 1), dt.date(2025, 6, 2), dt.date(2025, 6, 3)
SCHEMA = ("order_id string, user_id string, amount double, currency string, process_date date, "
          "user_segment string, event_count int, event_types array<string>")


def _frame(spark, rows, extra=""):
    return spark.createDataFrame(rows, SCHEMA + extra)


def _rows(spark, path, cols=("order_id", "process_date", "amount")):
    return sorted(tuple(r) for r in read_processed(spark, path).select(*cols).collect())


def test_merge_update_insert_untouched_and_rerun(spark, tmp_root):
    t = f"{tmp_root}/gold"
    first = _frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, ["view"]),
                           ("B", "U", 2.0, "USD", D2, "s", 0, None)])
    GD.merge_upsert(spark, t, GD.gold_model(first, "2025-06-01 00:00:00"), run_ts="x")
    second = _frame(spark, [("B", "U", 20.0, "USD", D2, "s", 0, None),
                            ("C", "U", 3.0, "USD", D2, "s", 0, None)])
    res = GD.merge_upsert(spark, t, GD.gold_model(second, "2025-06-02 00:00:00"))
    assert res.touched_partitions == 1
    want = [("A", D1, 1.0), ("B", D2, 20.0), ("C", D2, 3.0)]
    assert _rows(spark, t) == want
    GD.merge_upsert(spark, t, GD.gold_model(second, "2025-06-02 00:00:00"))
    assert _rows(spark, t) == want                                    # twice = once


def test_merge_adds_new_column(spark, tmp_root):
    t = f"{tmp_root}/gold"
    GD.merge_upsert(spark, t, GD.gold_model(_frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None)]),
                                            "2025-06-01 00:00:00"))
    new = _frame(spark, [("B", "U", 2.0, "USD", D2, "s", 1, None, "SUMMER")], ", promo_code string")
    GD.merge_upsert(spark, t, GD.gold_model(new, "2025-06-02 00:00:00"))
    got = dict(read_processed(spark, t).select("order_id", "promo_code").collect())
    assert got == {"A": None, "B": "SUMMER"}


def test_merge_rejects_null_keys_and_duplicates(spark, tmp_root):
    t = f"{tmp_root}/gold"
    src = GD.script_projection(_frame(spark, [(None, "U", 1.0, "USD", D1, "s", 1, None),
                                              ("A", "U", 1.0, "USD", D1, "s", 1, ["b", "a"])]))
    res = GD.merge_upsert(spark, t, src, preset=GD.SCRIPT, run_ts="2025-06-01 00:00:00")
    assert res.rejected_null_keys == 1 and res.source_rows == 1
    assert read_processed(spark, t).first()["event_types"] == "a,b"
    dup = _frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None)] * 2)
    with pytest.raises(GateError):
        GD.merge_upsert(spark, t, GD.gold_model(dup, "2025-06-01 00:00:00"))


def test_script_preset_keeps_user_and_inserted_at(spark, tmp_root):
    t = f"{tmp_root}/gold"
    a = GD.script_projection(_frame(spark, [("A", "U1", 1.0, "USD", D1, "s", 1, None)]))
    GD.merge_upsert(spark, t, a, preset=GD.SCRIPT, run_ts="2025-06-01 00:00:00")
    b = GD.script_projection(_frame(spark, [("A", "U2", 5.0, "USD", D1, "s", 1, None)]))
    GD.merge_upsert(spark, t, b, preset=GD.SCRIPT, run_ts="2025-06-02 00:00:00")
    r = read_processed(spark, t).first()
    assert r["user_id"] == "U1" and r["amount"] == 5.0
    assert str(r["inserted_at"]).startswith("2025-06-01") and str(r["updated_at"]).startswith("2025-06-02")


def test_gold_quality_filter_and_currency_order(spark):
    df = _frame(spark, [("A", "U", 1.234, "usd", D1, None, None, None),
                        ("B", "U", 1.0, "JPY", D1, "s", 1, None),
                        ("C", "U", 2.345, "INR", D1, None, None, None)])
    rows = GD.gold_model(df, "2025-06-01 00:00:00").collect()
    assert [(r["order_id"], r["amount"], r["user_segment"], r["event_count"]) for r in rows] == \
        [("C", 2.35, "unclassified", 0)]


def test_rerun_one_date_leaves_others(spark, tmp_root):
    root = f"{tmp_root}/processed"
    df = _frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None), ("B", "U", 1.0, "USD", D2, "s", 1, None),
                        ("C", "U", 1.0, "USD", D3, "s", 1, None)])
    sink.write_partitioned(df, root)
    sink.write_partitioned(_frame(spark, [("B2", "U", 9.0, "USD", D2, "s", 1, None)]), root)
    assert _rows(spark, root) == [("A", D1, 1.0), ("B2", D2, 9.0), ("C", D3, 1.0)]
    one = read_partition(spark, root, "process_date", D2)
    assert "process_date" in one.columns and one.count() == 1


def test_empty_rerun_deletes_partition(spark, tmp_root):
    root = f"{tmp_root}/processed"
    sink.write_partitioned(_frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None)]), root)
    sink.publish_partitions(spark, _frame(spark, []), root, run_values=[D1])
    assert not sink.path_exists(spark, f"{root}/process_date={D1}")


def test_guarded_read_requires_partition_filter(spark, tmp_root):
    root = f"{tmp_root}/gold"
    sink.write_partitioned(_frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None),
                                          ("B", "U", 1.0, "USD", D2, "s", 1, None)]), root)
    g = guarded_read(spark, root, D2, D2)
    assert [r["order_id"] for r in require_partition_filter(g).collect()] == ["B"]
    with pytest.raises(PartitionFilterRequired):
        require_partition_filter(read_processed(spark, root).where(F.col("user_id") == "U"))
    with pytest.raises(PartitionFilterRequired):
        guarded_read(spark, root, None, D2)


def test_enrichment_run_is_idempotent_and_diverts_late_rows(spark, tmp_root):
    from orderlake.plans.daily import run_enrichment
    o = spark.createDataFrame([("A", "U", 1.0, "USD", D1), ("B", "U", 2.0, "USD", D2),
                               ("C", "U", 3.0, "USD", D1)],
                              "order_id string, user_id string, amount double, currency string, "
                              "process_date date")
    e = spark.createDataFrame([("e", "U", "view")], "event_id string, user_id string, event_type string")
    s = spark.createDataFrame([("U", "gold")], "user_id string, segment string")
    root, late = f"{tmp_root}/p", f"{tmp_root}/late"
    for _ in range(2):
        res = run_enrichment(spark, o, e, s, root, run_dates=["2025-06-01"], late_root=late)
    assert (res.rows_in, res.rows_out, res.late_rows) == (3, 3, 1)
    assert _rows(spark, root) == [("A", D1, 1.0), ("C", D1, 3.0)]
    assert _rows(spark, late) == [("B", D2, 2.0)]


def test_warehouse_run_tests_before_publish(spark, tmp_root):
    from orderlake.plans.warehouse import run_warehouse
    proc, stg, gold = f"{tmp_root}/p", f"{tmp_root}/s", f"{tmp_root}/g"
    sink.write_partitioned(_frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, ["view"]),
                                          ("B", "U", 2.0, "usd", D1, "s", 1, None)]), proc)
    run = run_warehouse(spark, proc, stg, gold, D1, "2025-06-02 00:00:00")
    assert run.status == "MERGED" and run.staged_rows == 2
    assert _rows(spark, gold) == [("A", D1, 1.0)]          # 'usd' rejected by the model
    assert run_warehouse(spark, proc, stg, gold, D2, "x").status == "SKIPPED"
    # a staged batch that breaks a data test never reaches gold
    sink.write_partitioned(_frame(spark, [("C", "U", 3.0, "USD", D2, "s", -1, None)]), proc)
    with pytest.raises(GateError):
        run_warehouse(spark, proc, stg, gold, D2, "2025-06-03 00:00:00")
    assert not sink.path_exists(spark, f"{gold}/process_date={D2}")


def test_partition_guard_refuses_isnotnull_only(spark, tmp_root):
    root = f"{tmp_root}/gold"
    sink.write_partitioned(_frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None)]), root)
    df = read_processed(spark, root).where(F.col("process_date").isNotNull())
    with pytest.raises(PartitionFilterRequired):
        require_partition_filter(df)
