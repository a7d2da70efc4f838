"""Extendible hashing: every shard under its limit, only oversized ones split."""

import hashlib

import pytest
from pyspark.sql import functions as F

from orderlake.llm import sharding


def plain(rows, limit):
    """Splits one bit at a time, bucket by bucket."""
    todo, out = [(0, [(int(hashlib.md5(str(k if k is not None else "").encode()).hexdigest()[:15], 16), k, s)
                      for k, s in rows])], {}
    while todo:
        depth, bucket = todo.pop()
        if sum(s or 0 for _, _, s in bucket) <= limit or depth == 60:
            out.update({k: (depth, bucket[0][0] >> (60 - depth)) for _, k, _ in bucket})
            continue
        for bit in (0, 1):
            half = [x for x in bucket if x[0] >> (59 - depth) & 1 == bit]
            if half:
                todo.append((depth + 1, half))
    return out


@pytest.mark.parametrize("limit, step", [(500, 12), (60, 2), (49, 12), (10**9, 12)])
def test_equals_bit_by_bit_splits(spark, limit, step):
    rows = [(i, (i * 37) % 50 if i % 11 else None) for i in range(300)] + [(None, 5)]
    table = spark.createDataFrame([(*r, "x") for r in rows], "id long, size long, shard0 string")
    got = sharding.assign(table, F.col("id"), F.col("size"), limit, step=step)
    assert got.columns == [*table.columns, "shard", "depth"]
    found = {r["id"]: (r["depth"], int(r["shard"].split(":")[1])) for r in got.collect()}
    assert found == plain(rows, limit)


def test_one_key_over_the_limit_splits_by_row(spark):
    """A third and more of the rows have the same key."""
    table = spark.range(900).select(F.when(F.col("id") < 400, 7).otherwise(F.col("id")).alias("key"), F.lit(10).alias("n"))
    got = sharding.assign(table, F.col("key"), F.col("n"), 200)
    sums = [r["s"] for r in got.groupBy("shard").agg(F.sum("n").alias("s")).collect()]
    assert max(sums) <= 200 and sum(sums) == 9000 and got.count() == 900


def test_larger_row_and_empty_table(spark):
    table = spark.createDataFrame([(1, 5000), (2, 10), (2, 10)], "id long, n long")
    got = sharding.assign(table, F.col("id"), F.col("n"), 100)
    assert got.count() == 3 and got.where("id = 1").first()["shard"] not in {
        r["shard"] for r in got.where("id = 2").collect()}
    assert sharding.assign(table.where("id > 5"), F.col("id"), F.col("n"), 100).count() == 0
    with pytest.raises(ValueError):
        sharding.assign(table, F.col("id"), F.col("n"), 0)


@pytest.mark.parametrize("bits", [2, 3, 5])
def test_pages_of_any_size_give_the_same(spark, monkeypatch, bits):
    """Buckets that stay beside buckets that split deep, over several pages."""
    rows = [(i, 40 if i < 30 else 1) for i in range(400)]
    table = spark.createDataFrame(rows, "id long, size long")
    monkeypatch.setattr(sharding, "PAGE_BITS", bits)
    got = sharding.assign(table, F.col("id"), F.col("size"), 45, step=3)
    assert {r["id"]: (r["depth"], int(r["shard"].split(":")[1])) for r in got.collect()} == plain(rows, 45)


def test_null_sizes_and_repeated_rows(spark):
    table = spark.createDataFrame([(None, None)] * 5 + [(1, None), (1, 3), (1, 3)], "id long, n long")
    got = sharding.assign(table, F.col("id"), F.col("n"), 3)
    assert got.count() == 8
    assert max(r["s"] for r in got.groupBy("shard").agg(F.coalesce(F.sum("n"), F.lit(0)).alias("s")).collect()) <= 3
