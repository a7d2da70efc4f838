"""Mergeable rollups, day bitmaps and located differences on small tables."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderlake.operators import bitmaps, checksums, rollups
from orderlake.operators import gold as GD
from orderlake.operators.marts import date_segment_summary
from orderlake.sources.files import read_processed

GOLD = "process_date date, order_id string, user_id string, amount double, user_segment string, event_count int"
D = [dt.date(2025, 5, 30), dt.date(2025, 5, 31), dt.date(2025, 6, 1)]


def _rows(df):
    return sorted(map(str, (tuple(r) for r in df.collect())))


def _full(spark, gold):
    return _rows(date_segment_summary(read_processed(spark, gold)))


def test_rollup_equals_the_full_aggregate_after_every_merge(spark, tmp_root):
    gold, table = f"{tmp_root}/gold", rollups.Rollup(f"{tmp_root}/rollup")
    rng = random.Random(1)
    first = [(d, f"{d}{i}", f"U{i % 5}", i / 4 + 1, rng.choice("ab"), i % 3) for d in D for i in range(12)]
    merges = [first, [(d, o, u, a + 1, "c", e) for d, o, u, a, s, e in first[::5]],                 # amounts and segments
              [(D[1], f"late{i}", "U9", 2.25, "a", 1) for i in range(4)],
              [(d, o, u, a, "z", e) for d, o, u, a, s, e in first if s == "b" and d == D[0]]]      # a group disappears
    for rows in [*merges, merges[-1]]:
        GD.merge_upsert(spark, gold, spark.createDataFrame(rows, GOLD), rollup=table)
        assert _rows(rollups.date_segment_summary(table.read(spark))) == _full(spark, gold)
    may = read_processed(spark, gold).where(F.month("process_date") == 5).agg(F.sum("amount")).first()[0]
    assert rollups.month_totals(table.read(spark)).where("month = '2025-05-01'").first()["total_revenue"] == pytest.approx(may)


def test_a_merge_that_died_is_repaired_by_the_next(spark, tmp_root, monkeypatch):
    gold, table = f"{tmp_root}/gold", rollups.Rollup(f"{tmp_root}/rollup")
    GD.merge_upsert(spark, gold, spark.createDataFrame([(D[0], "A", "U", 1.0, "a", 1), (D[2], "B", "U", 2.0, "b", 1)], GOLD), rollup=table)

    def dies(*args, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(rollups.Rollup, "apply", dies)
        with pytest.raises(RuntimeError):
            GD.merge_upsert(spark, gold, spark.createDataFrame([(D[0], "A", "U", 5.0, "x", 1)], GOLD), rollup=table)
    assert _rows(rollups.date_segment_summary(table.read(spark))) != _full(spark, gold)
    GD.merge_upsert(spark, gold, spark.createDataFrame([(D[1], "C", "U", 3.0, "c", 1)], GOLD), rollup=table)
    assert _rows(rollups.date_segment_summary(table.read(spark))) == _full(spark, gold)


def test_bitmaps_count_distinct_users_of_any_range(spark, tmp_root):
    rng = random.Random(2)
    days = [dt.date(2025, 5, 25) + dt.timedelta(days=n) for n in range(12)]
    rows = [(d, rng.choice([None, "hot", *(f"U{i}" for i in range(60))])) for d in days for _ in range(50)]
    table = spark.createDataFrame(rows, "process_date date, user_id string")
    for part in (days[:8], days[8:], days[3:5]):
        mine = table.where(F.col("process_date").isin(part))
        users = bitmaps.update_dictionary(spark, f"{tmp_root}/users", mine)
        bitmaps.refresh_days(spark, f"{tmp_root}/days", mine, users, part)
    numbers = users.collect()
    assert len({r["id"] for r in numbers}) == len(numbers) == len({u for _, u in rows if u})
    ranges = [(a, b) for a in days[::3] for b in days[2::4] if a <= b]
    got = bitmaps.distinct_in_ranges(spark.read.parquet(f"{tmp_root}/days"), spark.createDataFrame(
        ranges, "range_start date, range_end date"))
    assert {tuple(r) for r in got.collect()} == {(a, b, len({u for d, u in rows if a <= d <= b and u})) for a, b in ranges}
    plan = got._jdf.queryExecution().optimizedPlan().toString()
    assert "user_id" not in plan                     # rows are not read again
    # a day whose rows went away is empty after its refresh
    bitmaps.refresh_days(spark, f"{tmp_root}/days", table.where(F.lit(False)), users, [days[0]])
    assert spark.read.parquet(f"{tmp_root}/days").where(F.col("process_date") == F.lit(days[0])).count() == 0


COLUMNS = ["order_id", "amount", "process_date"]
SIDE = "order_id string, amount double, process_date date"


def test_differences_are_located(spark):
    rng = random.Random(3)
    rows = [(f"O{i}", float(i), rng.choice(D)) for i in range(500)] + [(None, 1.0, D[0]), ("nodate", 1.0, None), ("null", None, D[1])]
    copy = [r for r in rows if r[0] not in ("O3", "O77")]                            # lost
    copy = [(o, a + 1 if o in ("O5", "O6") else a, d) for o, a, d in copy]           # changed
    copy = [(o, 0.0 if o == "null" else a, d) for o, a, d in copy] + [("O9", 9.0, dict((r[0], r[2]) for r in rows)["O9"])]
    copy += [("new", 1.0, D[2]), ("nodate2", 1.0, None)]
    moved = next(i for i, r in enumerate(copy) if r[0] == "O20")
    old = copy[moved][2]
    copy[moved] = ("O20", 20.0, D[(D.index(old) + 1) % 3])                           # on another day
    a, b = (spark.createDataFrame(x, SIDE).repartition(3) for x in (rows, copy))
    got = {(r["order_id"], r["process_date"]): (r["difference"], r["source_rows"], r["target_rows"])
           for r in checksums.differences(a, b, "order_id", "process_date", COLUMNS).collect()}
    day = {o: d for o, _, d in rows}
    assert got == {("O3", day["O3"]): ("lost", 1, 0), ("O77", day["O77"]): ("lost", 1, 0), ("O5", day["O5"]): ("changed", 1, 1),
                   ("O6", day["O6"]): ("changed", 1, 1), ("null", D[1]): ("changed", 1, 1), ("O9", day["O9"]): ("copies", 1, 2),
                   ("new", D[2]): ("extra", 0, 1), ("nodate2", None): ("extra", 0, 1), ("O20", old): ("lost", 1, 0),
                   ("O20", copy[moved][2]): ("extra", 0, 1)}
    # kept checksums give the same; equal sides give nothing and name no cell
    sums = checksums.checksums(a, "order_id", "process_date", COLUMNS)
    again = checksums.differences(a, b, "order_id", "process_date", COLUMNS, source_sums=sums)
    assert again.count() == len(got)
    assert checksums.differing_cells(sums, checksums.checksums(a, "order_id", "process_date", COLUMNS)).count() == 0
    assert checksums.differences(a, a, "order_id", "process_date", COLUMNS).count() == 0


def test_deltas_read_the_stage_once(spark, tmp_root):
    row = "order_id string, user_id string, amount double, process_date date, user_segment string, event_count int"
    day = dt.date(2025, 1, 1)
    tgt = spark.createDataFrame([("1", "u", 1.5, day, "a", 2), ("2", "u", 2.0, day, "b", 1)], row)
    src = spark.createDataFrame([("2", "u", 3.25, day, "c", 4), ("3", "u", 9.0, day, "a", None)], row)
    GD._merged(src, tgt, ["process_date", "order_id"], GD.MODEL, True).write.parquet(f"{tmp_root}/stage")
    sums = rollups.deltas(spark.read.parquet(f"{tmp_root}/stage"))
    assert sums._jdf.queryExecution().optimizedPlan().toString().count("Relation") == 1
    assert {(r["user_segment"], r["order_count"], float(r["total_revenue"]), r["total_events"]) for r in sums.collect()} == {
        ("b", -1, -2.0, -1), ("c", 1, 3.25, 4), ("a", 1, 9.0, None)}
