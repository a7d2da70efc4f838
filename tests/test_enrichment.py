"""Hand-made edge rows for the daily enrichment."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from orderlake.operators import enrichment as E
from orderlake.operators.gates import GateError

D = dt.date(2025, 6, 1)
O_SCHEMA = "order_id string, user_id string, amount double, currency string, process_date date"
EV_SCHEMA = "event_id string, user_id string, event_type string"
SEG_SCHEMA = "user_id string, segment string"


def _run(spark, orders, events, segments):
    o = spark.createDataFrame(orders, O_SCHEMA)
    e = spark.createDataFrame(events, EV_SCHEMA)
    s = spark.createDataFrame(segments, SEG_SCHEMA)
    _, out = E.enrich_daily(o, e, s)
    return {r["order_id"]: r for r in out.collect()}


def test_traced_order_one_row_23_events(spark):
    events = [(f"e{i}", "USR-1", ["page_view", "cart_add", "purchase"][i % 3]) for i in range(23)]
    rows = _run(spark, [("ORD-1", "USR-1", 2450.0, "INR", D)], events,
                [("USR-1", "premium_buyer")])
    r = rows["ORD-1"]
    assert len(rows) == 1 and r["event_count"] == 23
    assert r["user_segment"] == "premium_buyer"
    assert r["event_types"] == ["cart_add", "page_view", "purchase"]


def test_naive_join_fans_out(spark):
    o = spark.createDataFrame([("ORD-1", "USR-1", 10.0, "USD", D)], O_SCHEMA)
    e = spark.createDataFrame([(f"e{i}", "USR-1", "view") for i in range(23)], EV_SCHEMA)
    s = spark.createDataFrame([("USR-1", "premium")], SEG_SCHEMA)
    assert E.naive_enrich(o, e, s).count() == 23
    _, out = E.enrich_daily(o, e, s)
    assert out.count() == 1


def test_null_user_is_unclassified_with_zero_events(spark):
    rows = _run(spark, [("ORD-1", None, 10.0, "USD", D)], [("e1", None, "view")], [])
    r = rows["ORD-1"]
    assert r["user_segment"] == "unclassified" and r["event_count"] == 0
    assert r["event_types"] is None


def test_user_without_events_keeps_null_types(spark):
    r = _run(spark, [("ORD-1", "U9", 10.0, "USD", D)], [("e1", "U1", "view")], [])["ORD-1"]
    assert r["event_count"] == 0 and r["event_types"] is None


def test_all_null_event_types_give_empty_array(spark):
    r = _run(spark, [("ORD-1", "U1", 10.0, "USD", D)],
             [("e1", "U1", None), ("e2", "U1", None)], [])["ORD-1"]
    assert r["event_count"] == 0 and r["event_types"] == []


def test_non_positive_and_null_amounts_dropped(spark):
    rows = _run(spark, [("A", "U", 0.0, "USD", D), ("B", "U", -5.0, "USD", D),
                        ("C", "U", None, "USD", D), ("D", "U", 1.0, "USD", D)], [], [])
    assert set(rows) == {"D"}


def test_dedup_keeps_latest_date_and_tie_breaker(spark):
    o = spark.createDataFrame([("A", "U", 1.0, "USD", D), ("A", "U", 2.0, "USD", D + dt.timedelta(1)),
                               ("B", "U", 5.0, "USD", D), ("B", "U", 7.0, "USD", D)], O_SCHEMA)
    out = {r["order_id"]: r["amount"] for r in
           E.latest_per_key(o, ["order_id"], ["process_date desc"], ["amount desc"]).collect()}
    assert out == {"A": 2.0, "B": 7.0}


def test_null_order_ids_collapse_to_one_row(spark):
    o = spark.createDataFrame([(None, "U", 1.0, "USD", D), (None, "V", 2.0, "USD", D)], O_SCHEMA)
    assert E.latest_per_key(o).count() == 1


def test_firewall_drops_extras_and_strict_mode(spark):
    df = spark.createDataFrame([("A", "U", 1.0, "USD", D, "x")], O_SCHEMA + ", channel_code string")
    out = E.cast_and_select(df)
    assert out.columns == ["order_id", "user_id", "amount", "currency", "process_date"]
    with pytest.raises(ValueError):
        E.cast_and_select(df, strict=True)
    approved = [*E.APPROVED_OUTPUT_COLUMNS, "channel_code"]
    assert "channel_code" in E.cast_and_select(df, approved).columns


def test_rename_transition_accepts_either_name(spark):
    old = spark.createDataFrame([("e1", "U1", "view")], EV_SCHEMA)
    new = old.withColumnRenamed("event_type", "action_type")
    both = old.withColumn("action_type", F.lit("click")).withColumn(
        "event_type", F.lit(None).cast("string"))
    for df, expect in [(old, ["view"]), (new, ["view"]), (both, ["click"])]:
        r = E.aggregate_events(df).first()
        assert r["event_types"] == expect


def test_dimension_profile_and_duplicate_gate(spark, tmp_root):
    from orderlake.plans.daily import run_enrichment
    seg = spark.createDataFrame([("U1", "a"), ("U1", "b"), ("U2", "c")], SEG_SCHEMA)
    prof = E.dimension_profile(E.canonical_alias(seg, "user_segment"))
    assert prof.rows == 3 and prof.duplicate_keys == 1 and prof.broadcastable()
    o = spark.createDataFrame([("A", "U1", 1.0, "USD", D)], O_SCHEMA)
    e = spark.createDataFrame([], EV_SCHEMA)
    with pytest.raises(GateError):
        run_enrichment(spark, o, e, seg, tmp_root)
    res = run_enrichment(spark, o, e, seg, tmp_root, on_duplicate_segments="keep_latest")
    assert res.rows_out == 1


def test_enrich_daily_refuses_duplicate_dimension_keys(spark):
    o = spark.createDataFrame([("A", "U1", 1.0, "USD", D)], O_SCHEMA)
    e = spark.createDataFrame([], EV_SCHEMA)
    s = spark.createDataFrame([("U1", "a"), ("U1", "b")], SEG_SCHEMA)
    with pytest.raises(GateError):
        E.enrich_daily(o, e, s)


def test_repeated_event_ids_counted_unless_deduplicated(spark):
    ev = spark.createDataFrame([("e1", "U1", "view"), ("e1", "U1", "view"), ("e2", "U1", "click")],
                               EV_SCHEMA)
    assert E.aggregate_events(ev).first()["event_count"] == 3            # H3: kept
    assert E.aggregate_events(ev, dedup_events=True).first()["event_count"] == 2
