"""Bloom filters per day: no held key is missed, few days are opened."""

import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from orderlake.operators import gold as GD
from orderlake.operators import key_index
from orderlake.operators.gates import GateError, cross_day_duplicates
from orderlake.operators.key_index import KeyIndex, of_table
from orderlake.plans.warehouse import run_warehouse
from orderlake.sinks import parquet as sink
from orderlake.sources.files import read_processed

GOLD = "process_date date, order_id string, user_id string, amount double, user_segment string, event_count int"
DAYS = [dt.date(2025, 5, 1) + dt.timedelta(days=n) for n in range(45)]


def _gold(days, per_day, tag=""):
    return [(d, f"{tag}{d}/{i}", "U", 1.0, "a", 1) for d in days for i in range(per_day)]


def _keys(spark, keys):
    return spark.createDataFrame([(k,) for k in keys], "order_id string")


def test_repeats_are_found_and_few_days_opened(spark, tmp_root):
    gold, index = f"{tmp_root}/gold", KeyIndex(f"{tmp_root}/index")
    GD.merge_upsert(spark, gold, spark.createDataFrame(_gold(DAYS, 40), GOLD), index=index)
    assert index.read(spark).select("process_date").distinct().count() == len(DAYS)
    held = {(DAYS[3], f"{DAYS[3]}/7"), (DAYS[30], f"{DAYS[30]}/0")}
    batch = _keys(spark, [k for _, k in held] + [f"new{i}" for i in range(20)] + [None])
    opened = index.days_to_open(gold, batch)
    assert {str(d) for d, _ in held} <= set(opened) and len(opened) <= 4
    assert {tuple(r) for r in index.held_elsewhere(gold, batch).collect()} == held
    assert {tuple(r) for r in index.held_elsewhere(gold, batch, but=[DAYS[3]]).collect()} == {x for x in held if x[0] != DAYS[3]}
    assert index.days_to_open(gold, _keys(spark, [])) == []
    # a merge of a new and an old day: the others stay, the new keys are found
    GD.merge_upsert(spark, gold, spark.createDataFrame(_gold([DAYS[5], dt.date(2025, 7, 1)], 3, "x"), GOLD), index=index)
    every = read_processed(spark, gold).select("process_date", "order_id")
    assert {tuple(r) for r in index.held_elsewhere(gold, every.select("order_id")).collect()} == {tuple(r) for r in every.collect()}


def test_days_of_different_sizes_and_many_candidates(spark, tmp_root, monkeypatch):
    """Filters of several depths, candidates in many chunks over several salts."""
    monkeypatch.setattr(key_index, "CHUNK_KEYS", 64)
    monkeypatch.setattr(key_index, "CHUNKS_PER_KEY", 4)
    rng = random.Random(4)
    rows = [r for d, n in zip(DAYS[:4], (1, 30, 3000, 9000), strict=True) for r in _gold([d], n)] + [(DAYS[4], None, "U", 1.0, "a", 1)]
    gold, index = f"{tmp_root}/gold", KeyIndex(f"{tmp_root}/index")
    sink.write_partitioned(spark.createDataFrame(rows, GOLD), gold)
    index.rebuild(spark, gold, DAYS[:5])
    assert len({r[0] for r in index.read(spark).select("depth").distinct().collect()}) >= 3
    sent = rng.sample([r[1] for r in rows[:-1]], 2500)
    batch = _keys(spark, sent + [f"new{i}" for i in range(2500)])
    possible = index.may_hold(batch)
    day = {r[1]: r[0] for r in rows}
    got = {tuple(r) for r in possible.collect()}
    assert {(day[k], k) for k in sent} <= got and len(got) < 2500 + 30      # false ones are rare
    assert {tuple(r) for r in index.held_elsewhere(gold, batch).collect()} == {(day[k], k) for k in sent}
    assert str(DAYS[4]) in index.days_to_open(gold, batch)                  # a day without keys is not in the index


def test_a_merge_that_died_hides_nothing(spark, tmp_root, monkeypatch):
    gold, index = f"{tmp_root}/gold", KeyIndex(f"{tmp_root}/index")
    GD.merge_upsert(spark, gold, spark.createDataFrame(_gold(DAYS, 5), GOLD), index=index)

    def dies(*args, **kw):
        raise RuntimeError("lost")
    with monkeypatch.context() as m:
        m.setattr(KeyIndex, "finish", dies)
        with pytest.raises(RuntimeError):
            GD.merge_upsert(spark, gold, spark.createDataFrame(_gold([DAYS[2]], 2, "x"), GOLD), index=index)
    new = _keys(spark, [f"x{DAYS[2]}/1"])
    assert {tuple(r) for r in index.held_elsewhere(gold, new).collect()} == {(DAYS[2], f"x{DAYS[2]}/1")}
    GD.merge_upsert(spark, gold, spark.createDataFrame(_gold([DAYS[0]], 2, "y"), GOLD), index=index)
    assert index.days_to_open(gold, new) == [str(DAYS[2])]
    rows = read_processed(spark, gold)
    assert cross_day_duplicates(rows, rows.where(F.lit(False))) == 0


def test_warehouse_run_stops_on_an_order_of_another_day(spark, tmp_root):
    index = KeyIndex(f"{tmp_root}/index")
    schema = "process_date date, order_id string, user_id string, amount double, currency string, user_segment string, event_count int, event_types array<string>"

    def processed(rows):
        sink.write_partitioned(spark.createDataFrame([(d, o, "U1", 5.0, "INR", "a", 1, ["x"]) for d, o in rows], schema), f"{tmp_root}/p")
    processed([(DAYS[0], "A"), (DAYS[1], "B"), (DAYS[2], "C")])

    def run(day):
        return run_warehouse(spark, f"{tmp_root}/p", f"{tmp_root}/s", f"{tmp_root}/g", str(day), "2025-08-01 00:00:00", index=index)
    assert [run(d).status for d in DAYS[:3]] == ["MERGED"] * 3
    processed([(DAYS[3], "D"), (DAYS[4], "B")])
    assert run(DAYS[3]).status == "MERGED" and run(DAYS[0]).status == "MERGED"
    with pytest.raises(GateError, match="unique_order_id=1"):
        run(DAYS[4])
    assert run(DAYS[1]).status == "MERGED"


def test_an_index_kept_with_the_table_is_kept_by_every_merge(spark, tmp_root):
    gold = f"{tmp_root}/gold"
    assert of_table(spark, gold) is None
    GD.merge_upsert(spark, gold, spark.createDataFrame(_gold(DAYS[:2], 3), GOLD), index=of_table(spark, gold, create=True))
    GD.merge_upsert(spark, gold, spark.createDataFrame(_gold(DAYS[1:3], 1, "x"), GOLD))       # names no index
    index, new = of_table(spark, gold), _keys(spark, [f"x{DAYS[2]}/0"])
    assert index.days_to_open(gold, new) == [str(DAYS[2])]
    assert read_processed(spark, gold).count() == 8                                            # readers skip its folder
