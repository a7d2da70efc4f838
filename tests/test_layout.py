"""Interleaved layout and Bloom filters: what the lookups read, from the scans' own row counts."""

import datetime as dt
import random

from pyspark.sql import functions as F

from orderlake.operators import gold as GD
from orderlake.operators import marts as M
from orderlake.sinks import parquet as sink
from orderlake.sinks.layout import Layout, interleaved, range_bounds, range_number
from orderlake.sources.files import read_processed

DAY = dt.date(2025, 6, 1)
SMALL = 60_000       # bytes a row group, so that a small table has many


def _scanned(df):
    """Rows that the Parquet scans of a query gave after their row groups were skipped."""
    df.collect()
    todo, rows = [df._jdf.queryExecution().executedPlan()], 0
    while todo:
        node = todo.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            todo.append(node.executedPlan())
        elif name == "FileSourceScanExec":
            rows += node.metrics().get("numOutputRows").get().value()
        todo += [node.children().apply(i) for i in range(node.children().size())]
    return rows


def test_lookups_read_few_rows(spark, tmp_root):
    rng = random.Random(5)
    n = 40_000
    rows = [(DAY, f"O{rng.randrange(10**12):012}", f"U{rng.randrange(400):04}", 1.0, f"S{rng.randrange(60):02}", 1) for _ in range(n)]
    rows += [(DAY, "null", None, 1.0, None, 1)]
    table = spark.createDataFrame(rows, "process_date date, order_id string, user_id string, amount double, user_segment string, event_count int")
    sink.write_stage(table, f"{tmp_root}/stage")
    staged = spark.read.parquet(f"{tmp_root}/stage")
    sink.write_partitioned(staged, f"{tmp_root}/curve", layout=Layout(distinct=2_000, row_group_bytes=SMALL))
    plain = Layout(bloom=(), row_group_bytes=SMALL)
    spark.conf.set("parquet.block.size", str(SMALL))
    try:
        sink.write_partitioned(staged, f"{tmp_root}/sorted")
    finally:
        spark.conf.unset("parquet.block.size")
    sink.write_partitioned(staged, f"{tmp_root}/nobloom", layout=plain)
    curve, line, nobloom = (read_processed(spark, f"{tmp_root}/{x}") for x in ("curve", "sorted", "nobloom"))
    assert curve.count() == n + 1 and curve.exceptAll(staged.select(curve.columns)).count() == 0
    user, segment, order = rows[7][2], rows[7][4], rows[7][1]
    def by_user(t):
        return M.segment_user_lookup(t, user_id=user)
    def by_segment(t):
        return M.segment_user_lookup(t, segment=segment)
    def by_order(t):
        return M.order_lookup(t, [order])
    read = {k: [_scanned(f(t)) for t in (curve, line, nobloom)] for k, f in (("user", by_user), ("segment", by_segment), ("order", by_order))}
    print(read)
    assert read["user"][0] < 0.5 * n and read["user"][0] < 0.7 * read["user"][1]      # a plain sort serves segments only
    assert read["segment"][0] < 0.5 * n
    assert read["order"][0] < 0.2 * n and read["order"][0] < 0.3 * read["order"][2]   # only the Bloom filter knows
    for f in (by_user, by_segment, by_order):
        assert sorted(map(str, f(curve).collect())) == sorted(map(str, f(staged.select(curve.columns)).collect()))


def test_ranges_and_curve(spark):
    df = spark.createDataFrame([(i % 97, None if i % 10 == 0 else f"k{i:04}") for i in range(1000)], "a int, b string")
    for column in ("a", "b"):
        bounds = range_bounds(df, column, 3, 1000)
        got = df.select(column, range_number(F.col(column), bounds).alias("r")).collect()
        assert all(r["r"] == (0 if r[0] is None else sum(b <= r[0] for b in bounds)) for r in got)
        assert len({r["r"] for r in got}) >= 6
    one = spark.range(1).select(interleaved([F.lit(0b101), F.lit(0b011)], 3).alias("z"), interleaved([], 3).alias("none")).first()
    assert tuple(one) == (0b100111, 0)
    assert range_bounds(df.where("a > 1000"), "a", 3, 0) == []
    assert spark.range(1).select(range_number(F.lit("x"), [])).first()[0] == 0


def test_merge_with_a_layout(spark, tmp_root):
    schema = "process_date date, order_id string, user_id string, amount double, user_segment string, event_count int"
    def merge(rows):
        return GD.merge_upsert(spark, f"{tmp_root}/g", spark.createDataFrame(rows, schema), layout=Layout())
    assert merge([(DAY, "A", "U", 1.0, "a", 1), (DAY, "B", "V", 1.0, None, 1)]).inserted == 2
    assert merge([(DAY, "A", "U", 2.0, "b", 1)]).updated == 1
    got = {(r["order_id"], r["amount"]) for r in read_processed(spark, f"{tmp_root}/g").collect()}
    assert got == {("A", 2.0), ("B", 1.0)}
