"""Late rows of several runs (B3/H7), range runs equal to daily runs (B1/B2)."""

import datetime as dt

from orderlake.operators import gold as GD
from orderlake.plans.daily import run_daily, run_enrichment, run_range
from orderlake.plans.late import merge_late
from orderlake.sinks import parquet as sink
from orderlake.sources.files import read_processed, read_segments

ORDER = "order_id string, user_id string, amount double, currency string, process_date date"
MAY30, JUN1, JUN2, JUN3 = (dt.date(2025, 5, 30), *(dt.date(2025, 6, d) for d in (1, 2, 3)))


def _feeds(spark, orders):
    return (spark.createDataFrame(orders, ORDER),
            spark.createDataFrame([("e", "U", "view")], "event_id string, user_id string, event_type string"),
            spark.createDataFrame([("U", "gold")], "user_id string, segment string"))


def _rows(spark, path, *cols):
    return sorted(tuple(r) for r in read_processed(spark, path).select(*cols).collect())


def test_late_rows_of_two_runs_are_kept_and_merged(spark, tmp_root):
    p, late, gold = f"{tmp_root}/p", f"{tmp_root}/late", f"{tmp_root}/gold"
    runs = {JUN2: [("A", "U", 1.0, "USD", JUN2), ("L1", "U", 5.0, "USD", MAY30), ("X", "U", 6.0, "USD", MAY30)],
            JUN3: [("B", "U", 1.0, "USD", JUN3), ("L2", "U", 7.0, "USD", MAY30), ("X", "U", 8.0, "USD", MAY30),
                   ("F", "U", 9.0, "USD", dt.date(2025, 6, 9))]}
    run_enrichment(spark, *_feeds(spark, [("O", "U", 2.0, "USD", MAY30)]), p, run_dates=[MAY30], late_root=late)
    for day, rows in runs.items():
        run_enrichment(spark, *_feeds(spark, rows), p, run_dates=[day], late_root=late)
    run_enrichment(spark, *_feeds(spark, runs[JUN2]), p, run_dates=[JUN2], late_root=late)      # a repeated run
    assert _rows(spark, late, "order_id", "late_run") == [
        ("F", JUN3), ("L1", JUN2), ("L2", JUN3), ("X", JUN2), ("X", JUN3)]
    GD.merge_upsert(spark, gold, GD.gold_model(read_processed(spark, p), "2025-06-03 00:00:00"))
    want = [("A", 1.0), ("B", 1.0), ("L1", 5.0), ("L2", 7.0), ("O", 2.0), ("X", 8.0)]
    for inserted in (3, 0):                                           # merging twice changes nothing
        done = merge_late(spark, late, p, gold, "2025-06-04 00:00:00")
        assert (done.processed.inserted, done.gold.inserted) == (inserted, inserted)
        assert _rows(spark, p, "order_id", "amount") == _rows(spark, gold, "order_id", "amount") == want
    # a later run of the day keeps the late rows
    run_enrichment(spark, *_feeds(spark, [("O", "U", 2.5, "USD", MAY30)]), p, run_dates=[MAY30], late_root=late)
    assert _rows(spark, p, "order_id", "amount") == [(o, 2.5 if o == "O" else a) for o, a in want]
    # a row dated after its run is taken in when its date runs
    run_enrichment(spark, *_feeds(spark, []), p, run_dates=["2025-06-09"], late_root=late)
    assert ("F", 9.0) in _rows(spark, p, "order_id", "amount")
    # a repeated run without late rows leaves none
    run_enrichment(spark, *_feeds(spark, runs[JUN2][:1]), p, run_dates=[JUN2], late_root=late)
    assert JUN2 not in [r[0] for r in _rows(spark, late, "late_run")]


def _drops(spark, root):
    """X is sent on both days; a user's events count on their own day; the
    second day's events use the renamed column."""
    for day, orders, events, name in (
            (JUN1, [("X", "U", 1.0, "USD", JUN1), ("Y", "V", 2.0, "USD", JUN1), ("Z", "U", 4.0, "USD", MAY30)],
             [("e1", "U", "view")], "event_type"),
            (JUN2, [("X", "U", 3.0, "USD", JUN2), ("W", "U", 3.5, "USD", JUN1)],
             [("e2", "U", "view"), ("e3", "U", "cart")], "action_type")):
        spark.createDataFrame(orders, ORDER).coalesce(1).write.parquet(f"{root}/orders/orders_{day}.parquet")
        spark.createDataFrame(events, f"event_id string, user_id string, {name} string").coalesce(1).write.parquet(
            f"{root}/events/events_{day}.parquet")
    spark.createDataFrame([("U", "gold")], "user_id string, user_segment string").write.parquet(f"{root}/segments/w2")
    spark.createDataFrame([("U", "old"), ("V", "old")], "user_id string, segment string").write.parquet(
        f"{root}/segments/w1")


def test_range_equals_its_days_in_order(spark, tmp_root):
    root = f"{tmp_root}/validated"
    _drops(spark, root)
    cols = ("order_id", "process_date", "amount", "event_count", "user_segment")
    for d in (JUN1, JUN2, JUN3):
        run_daily(spark, root, f"{tmp_root}/days", d)                 # JUN3 has no drop: skipped
    res = run_range(spark, root, f"{tmp_root}/range", [JUN1, JUN2, JUN3])
    assert _rows(spark, f"{tmp_root}/days_late", *cols) == _rows(spark, f"{tmp_root}/range_late", *cols)
    merge_late(spark, f"{tmp_root}/days_late", f"{tmp_root}/days")
    merge_late(spark, f"{tmp_root}/range_late", f"{tmp_root}/range")
    days = _rows(spark, f"{tmp_root}/days", *cols)
    assert days == _rows(spark, f"{tmp_root}/range", *cols) and res.late_rows == 2
    assert ("X", JUN1, 1.0, 1, "gold") in days and ("X", JUN2, 3.0, 2, "gold") in days
    assert ("W", JUN1, 3.5, 2, "gold") in days and ("Y", JUN1, 2.0, 0, "unclassified") in days and len(days) == 5


def test_a_replay_takes_the_segments_of_its_day(spark, tmp_root):
    """Each day has the drop of its time; a new drop leaves old days as they were."""
    root, seg = f"{tmp_root}/validated", "user_id string, user_segment string"
    for n, day in enumerate((JUN1, JUN2, JUN3)):
        spark.createDataFrame([(f"{u}{n}", u, 1.0, "USD", day) for u in "UVW"], ORDER).coalesce(1).write.parquet(
            f"{root}/orders/orders_{day}.parquet")
    spark.createDataFrame([("U", "a"), ("V", "a"), ("W", "a")], seg).write.parquet(f"{root}/segments/2025-06-01")
    spark.createDataFrame([("U", "b"), ("W", "a")], seg).write.parquet(f"{root}/segments/2025-06-03")
    want = [(f"{u}{n}", "b" if (u, n) == ("U", 2) else "unclassified" if (u, n) == ("V", 2) else "a")
            for u in "UVW" for n in range(3)]
    for step in range(2):
        for d in (JUN1, JUN2, JUN3):
            run_daily(spark, root, f"{tmp_root}/days{step}", d)
        run_range(spark, root, f"{tmp_root}/range{step}", [JUN1, JUN2, JUN3])
        for kind in ("days", "range"):
            assert _rows(spark, f"{tmp_root}/{kind}{step}", "order_id", "user_segment") == want
        spark.createDataFrame([("U", "new")], seg).write.mode("overwrite").parquet(f"{root}/segments/2025-06-09")


def test_segment_drops_with_different_columns(spark, tmp_root):
    _drops(spark, tmp_root)
    assert [tuple(r) for r in read_segments(spark, tmp_root).select("user_id", "user_segment").collect()] == [("U", "gold")]
    assert read_segments(spark, tmp_root, latest_only=False).where("user_segment IS NULL").count() == 0


def test_no_scratch_folder_stays(spark, tmp_root):
    from orderlake.session import checkpoint_root
    base = f"{checkpoint_root(spark)}/orderlake"
    kinds = ("enrich-", "events-summary", "hot-keys", "merge-src", "merge-out", "history-stage", "registry-stage")
    before = [n for n in sink.child_names(spark, base) if n.startswith(kinds)]
    run_enrichment(spark, *_feeds(spark, [("A", "U", 1.0, "USD", JUN1)]), f"{tmp_root}/p", run_dates=[JUN1])
    GD.merge_upsert(spark, f"{tmp_root}/g", GD.gold_model(read_processed(spark, f"{tmp_root}/p"), "2025-06-03 00:00:00"))
    assert [n for n in sink.child_names(spark, base) if n.startswith(kinds)] == before
