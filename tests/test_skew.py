"""Hot keys: a third of all rows on one key must not land in one task."""

import datetime as dt
import os

from pyspark.sql import functions as F

from orderlake.operators import enrichment as E
from orderlake.operators.joins import hot_keys, left_lookup_join
from orderlake.sinks import parquet as sink

D = dt.date(2025, 6, 1)


def _orders(spark, n=3000):
    # user U0 holds a third of all orders, the rest spread over 1000 users
    return spark.range(n).select(
        F.col("id").cast("string").alias("order_id"),
        F.when(F.col("id") % 3 == 0, F.lit("U0"))
         .when(F.col("id") % 97 == 5, F.lit(None))
         .otherwise(F.concat(F.lit("U"), (F.col("id") % 1000 + 1).cast("string"))).alias("user_id"),
        (F.col("id") + 1).cast("double").alias("amount"),
        F.lit("USD").alias("currency"),
        F.date_add(F.lit(D), (F.col("id") % 3).cast("int")).alias("process_date"))


def _lookup(spark):
    return spark.range(0, 1001).select(
        F.concat(F.lit("U"), F.col("id").cast("string")).alias("user_id"),
        (F.col("id") * 2).alias("event_count"))


def test_hot_key_detection_is_bounded(spark):
    hot = [r["user_id"] for r in hot_keys(_orders(spark), "user_id", fraction=0.5, partitions=8).collect()]
    assert hot == ["U0"]
    assert hot_keys(_orders(spark), "user_id", fraction=1.0, partitions=500).count() < 500


def _rows(df):
    return sorted(tuple("" if v is None else str(v) for v in r) for r in df.collect())


def test_skew_split_join_equals_plain_join(spark):
    o, lk = _orders(spark), _lookup(spark)
    cols = [*o.columns, "event_count"]
    plain = o.join(lk, "user_id", "left").select(*cols)
    hot = hot_keys(o, "user_id", fraction=0.5, partitions=8)
    split = left_lookup_join(o, lk, "user_id", broadcast_lookup=False, hot=hot).select(*cols)
    assert _rows(split) == _rows(plain) and len(_rows(split)) == o.count()


def test_hot_rows_take_the_broadcast_path(spark):
    o, lk = _orders(spark), _lookup(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.autoBroadcastJoinThreshold", "-1")
    try:
        hot = hot_keys(o, "user_id", fraction=0.5, partitions=8)
        split = left_lookup_join(E.latest_per_key(o), lk, "user_id", broadcast_lookup=False, hot=hot)
        split.collect()
        import contextlib
        import io
        buf = io.StringIO()
        with contextlib.redirect_stdout(buf):
            split.explain()
        plan = buf.getvalue()
        assert "BroadcastHashJoin" in plan and "SortMergeJoin" in plan
        # W1 runs once, and no sample is drawn under the join
        logical = split._jdf.queryExecution().optimizedPlan().toString()
        assert logical.count("Window [") == 1 and "Sample" not in logical
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.autoBroadcastJoinThreshold")


def test_enrichment_with_skew_split_matches_broadcast(spark):
    o = _orders(spark)
    ev = spark.range(6000).select(
        F.col("id").cast("string").alias("event_id"),
        F.when(F.col("id") % 2 == 0, F.lit("U0"))
         .otherwise(F.concat(F.lit("U"), (F.col("id") % 50).cast("string"))).alias("user_id"),
        F.when(F.col("id") % 3 == 0, F.lit("view")).otherwise(F.lit("click")).alias("event_type"))
    seg = spark.range(0, 1001).select(F.concat(F.lit("U"), F.col("id").cast("string")).alias("user_id"),
                                      F.lit("gold").alias("segment"))
    _, a = E.enrich_daily(o, ev, seg, broadcast_segments=True, broadcast_events=True)
    _, b = E.enrich_daily(o, ev, seg, broadcast_segments=False, broadcast_events=False,
                          fraction=0.5, partitions=8)
    assert _rows(a) == _rows(b) and len(_rows(b)) == o.count()


def test_hot_day_is_written_by_several_tasks(spark, tmp_root):
    df = spark.range(20000).select(
        F.lit(D).alias("process_date"), F.col("id").cast("string").alias("order_id"),
        F.lit("s").alias("user_segment"), F.lit("U0").alias("user_id")).repartition(4)
    # AQE would rightly merge this tiny output into one task; a real hot day
    # is far above the advisory partition size.
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sink.write_partitioned(df, tmp_root)
    finally:
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    local = tmp_root.split(":", 1)[-1]
    files = [f for f in os.listdir(f"{local}/process_date={D}") if f.endswith(".parquet")]
    assert len(files) > 1


def test_row_gate_counts_are_exact_on_the_split_path(spark, tmp_root):
    from orderlake.plans.daily import run_enrichment
    o = _orders(spark)
    ev = spark.range(600).select(F.col("id").cast("string").alias("event_id"),
                                 F.lit("U0").alias("user_id"), F.lit("view").alias("event_type"))
    seg = spark.range(0, 1001).select(F.concat(F.lit("U"), F.col("id").cast("string")).alias("user_id"),
                                      F.lit("gold").alias("segment"))
    res = run_enrichment(spark, o, ev, seg, tmp_root, broadcast_limit=0,
                         hot_opts={"fraction": 0.5, "partitions": 8})
    assert not res.broadcast_segments and not res.broadcast_events
    assert res.rows_in == o.count() and res.rows_out == o.count()


def test_hot_lookup_rows_beyond_the_limit_are_replicated(spark):
    """No lookup row may be broadcast: the join is the plain one, and no task
    holds over twice the median of the hot key's rows."""
    from orderlake.operators.joins import dealt, left_lookup_joins
    o, lk = _orders(spark, 12000), _lookup(spark)
    cols = [*o.columns, "event_count"]
    hot = hot_keys(o, "user_id", fraction=0.5, partitions=8)
    split = left_lookup_joins(o, [(lk, False)], "user_id", hot, hot_rows=0).select(*cols)
    assert _rows(split) == _rows(o.join(lk, "user_id", "left").select(*cols))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "8")
    try:
        salts = dealt(o, "user_id", hot).where("user_id = 'U0'").groupBy("_deal").count().collect()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    counts = sorted(r["count"] for r in salts)
    assert len(counts) == 8 and counts[-1] <= 2 * counts[4]


def test_as_of_join_equals_a_plain_search(spark):
    import random

    from orderlake.operators.asof import as_of_join, segment_intervals
    rng = random.Random(3)
    days = [D + dt.timedelta(days=n) for n in (0, 1, 2, 2 + 1)]
    told = [(str(d), {f"U{u}": rng.choice("ab") for u in range(0, 1001) if rng.random() < 0.7}) for d in days[:3]]
    drops = [(d, spark.createDataFrame([*t.items(), (None, "x")], "user_id string, user_segment string")) for d, t in told]
    intervals = segment_intervals(drops)
    o = _orders(spark).withColumn("process_date", F.date_sub("process_date", 1))
    hot = hot_keys(o, "user_id", fraction=0.5, partitions=8)
    got = {r["order_id"]: r["user_segment"] for r in as_of_join(o, intervals, "process_date", hot=hot).collect()}
    want = {}
    for r in o.collect():
        held = [t for d, t in told if d <= str(r["process_date"])]
        want[r["order_id"]] = held[-1].get(r["user_id"]) if held else None
    assert got == want and len(set(got.values())) == 3
    assert intervals.count() < sum(len(t) for _, t in told)          # equal drops are one interval
