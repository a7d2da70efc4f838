"""Bad amounts, partition guard, schema conflicts, whole-table unique test."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake.functions.columns import amount_fault, exact_sum
from orderlake.operators import enrichment as E
from orderlake.operators import gates as G
from orderlake.operators import gold as GD
from orderlake.operators import history as H
from orderlake.operators import marts as M
from orderlake.plans.warehouse import run_warehouse
from orderlake.sinks import parquet as sink
from orderlake.sinks.table_schema import SchemaConflict, read_table_schema
from orderlake.sources.files import read_processed

D1, D2 = dt.date(2025, 6, 1), dt.date(2025, 6, 2)
SCHEMA = ("order_id string, user_id string, amount double, currency string, process_date date, "
          "user_segment string, event_count int, event_types array<string>")
CSV = "order_id string, user_id string, amount string, currency string, channel string, product_sku string, process_date string"


def test_amount_faults_have_reasons_and_never_raise(spark):
    df = spark.createDataFrame([(x,) for x in ("1.5", "NaN", "Infinity", "-Infinity", "1e17", "1e300", "0", "-2", "abc", None)],
                               "amount string")
    got = {r["amount"]: r["f"] for r in df.withColumn("f", amount_fault("amount")).collect()}
    assert got == {"1.5": None, "NaN": "unparseable amount", "Infinity": "unparseable amount",
                   "-Infinity": "unparseable amount", "1e17": "amount out of range", "1e300": "amount out of range",
                   "0": "non-positive amount", "-2": "non-positive amount", "abc": "unparseable amount",
                   None: "unparseable amount"}
    kept = E.apply_business_rules(df.withColumns({"event_count": F.lit(1), "user_segment": F.lit("s")}))
    assert [r["amount"] for r in kept.collect()] == ["1.5"]
    total = df.select(exact_sum(F.col("amount").try_cast("double"))).first()[0]
    assert float(total) == 1e17 - 0.5


def test_reports_and_audit_survive_huge_and_nan_amounts(spark):
    gold = spark.createDataFrame([(D1, "s", "A", 1e17), (D1, "s", "B", 0.25), (D1, "s", "C", float("nan"))],
                                 "process_date date, user_segment string, order_id string, amount double")
    assert M.revenue_by_segment(gold).first()["total_revenue"] == pytest.approx(1e17)
    src = spark.createDataFrame([("A", "U", a, "USD", "w", "s", "2025-06-01") for a in ("1e17", "NaN", "10.005", "0.004")], CSV)
    clean, rejects = H.split_history(H.normalize_history(src))
    assert sorted(r["amount"] for r in clean.collect()) == [0.004, 10.005] and rejects.count() == 2
    r = H.reconciliation_report(src, clean, "x").first()
    assert r["status"] == "SUCCESS" and r["filtered_row_count"] == 2 and r["discrepancy_amount"] == 0
    short = H.reconciliation_report(src, clean.where("amount > 1"), "x").first()
    assert short["status"] == "MISMATCH"


def _frame(spark, rows):
    return spark.createDataFrame(rows, SCHEMA)


def test_guard_wants_a_filter_on_every_scan(spark, tmp_root):
    root = f"{tmp_root}/gold"
    sink.write_partitioned(_frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None), ("B", "U", 1.0, "USD", D2, "s", 1, None)]),
                           root)
    good, open_ = M.guarded_read(spark, root, D1, D1), read_processed(spark, root)
    M.require_partition_filter(good.join(M.guarded_read(spark, root, D2, D2), "user_id"))
    with pytest.raises(M.PartitionFilterRequired):
        M.require_partition_filter(good.join(open_.select("user_id", "amount"), "user_id"))
    with pytest.raises(M.PartitionFilterRequired):
        M.guarded_read(spark, root, "1900-01-01", "2999-12-31")
    assert M.table_days(spark, root) == ("2025-06-01", "2025-06-02")
    assert M.guarded_read(spark, root, *M.table_days(spark, root)).count() == 2


def test_type_conflicts_are_refused_before_publishing(spark, tmp_root):
    t = f"{tmp_root}/gold"
    rows = _frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, ["v"])])
    GD.merge_upsert(spark, t, GD.gold_model(rows, "2025-06-01 00:00:00"))
    for day in (D1, D2):                                              # a known and a new day
        script = GD.script_projection(rows.withColumn("process_date", F.lit(day)))
        with pytest.raises(SchemaConflict):
            GD.merge_upsert(spark, t, script, preset=GD.SCRIPT, run_ts="2025-06-02 00:00:00")
    assert read_processed(spark, t).count() == 1
    with pytest.raises(SchemaConflict):
        sink.write_partitioned(rows.withColumn("event_count", F.lit("1")), t)
    assert "event_types" in read_table_schema(spark, t).fieldNames()


def test_unique_test_covers_the_whole_table(spark, tmp_root):
    proc, stg, gold, rej = (f"{tmp_root}/{x}" for x in "psgr")
    sink.write_partitioned(_frame(spark, [("A", "U", 1.0, "USD", D1, "s", 1, None), ("B", "U", 1.0, "JPY", D1, "s", 1, None),
                                          (None, "U", 1.0, "USD", D1, "s", 1, None), ("A", "U", 2.0, "USD", D2, "s", 1, None)]), proc)
    ts = "2025-06-02 00:00:00"
    assert run_warehouse(spark, proc, stg, gold, D1, ts, step="load").status == "LOADED"
    first = run_warehouse(spark, proc, stg, gold, D1, ts, step="merge", rejects_root=rej)
    assert (first.status, first.rejected, first.merge.inserted, first.merge.updated) == ("MERGED", 2, 1, 0)
    assert sorted(r["reject_reason"] for r in spark.read.parquet(rej).collect()) == ["currency not accepted", "null order_id"]
    again = run_warehouse(spark, proc, stg, gold, D1, ts)
    assert (again.merge.inserted, again.merge.updated) == (0, 1)
    with pytest.raises(G.GateError, match="unique_order_id"):
        run_warehouse(spark, proc, stg, gold, D2, ts)
    assert run_warehouse(spark, proc, stg, gold, D2, ts, unique_scope="touched").merge.inserted == 1


def test_null_merge_keys_go_to_the_rejects(spark, tmp_root):
    src = _frame(spark, [(None, "U", 1.0, "USD", D1, "s", 1, None), ("A", "U", 1.0, "USD", D1, "s", 1, None)])
    res = GD.merge_upsert(spark, f"{tmp_root}/g", GD.script_projection(src), preset=GD.SCRIPT,
                          run_ts="2025-06-01 00:00:00", rejects=f"{tmp_root}/r")
    assert res.rejected_null_keys == 1 and spark.read.parquet(f"{tmp_root}/r").first()["reject_reason"] == "null merge key"
