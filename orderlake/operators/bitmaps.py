"""Exact distinct counts that merge, from bitmaps per day over a key dictionary.

Every key has a dense number in a dictionary. A day's keys are bitmaps of 32,768
positions; the distinct keys of any range of days are the set bits of the days'
bitmaps OR-ed by bucket. Rows are read once, when their day is built; a range
moves bitmaps only, of at most 4 KB a bucket and day.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sinks import parquet as sink

MONTH = "bitmap_month"


def numbered(keys: DataFrame, column: str, base: int) -> DataFrame:
    """Distinct ``keys`` with ``id`` from ``base`` on: ranked within sorted
    ranges, the ranges offset by their counts (a number per range)."""
    spark = keys.sparkSession
    path = scratch_dir(spark, "key-ranges")
    (keys.select(column).where(F.col(column).isNotNull()).distinct().repartitionByRange(column)
         .withColumn("_range", F.spark_partition_id()).write.parquet(path))
    rows = spark.read.parquet(path)
    counts = rows.groupBy("_range").count()
    before = counts.withColumn("_before", F.coalesce(F.sum("count").over(
        Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("count")
    own = F.row_number().over(Window.partitionBy("_range").orderBy(column))
    return rows.join(F.broadcast(before), "_range").select(column, (F.lit(base - 1) + own + F.col("_before")).alias("id"))


def read_dictionary(spark: SparkSession, root: str, column: str = "user_id") -> DataFrame | None:
    return spark.read.parquet(root) if sink.path_exists(spark, root) else None


def update_dictionary(spark: SparkSession, root: str, keys: DataFrame, column: str = "user_id") -> DataFrame:
    """Appends the keys that the dictionary lacks; numbers never change."""
    known = read_dictionary(spark, root, column)
    fresh = keys.select(column).distinct()
    if known is not None:
        fresh = fresh.join(known, column, "left_anti")
    base = 0 if known is None else (known.agg(F.max("id")).first()[0] or 0)
    numbered(fresh, column, base + 1).write.mode("append").parquet(root)
    return read_dictionary(spark, root, column)


def day_bitmaps(rows: DataFrame, dictionary: DataFrame, day: str = "process_date", column: str = "user_id") -> DataFrame:
    """day, bucket, bitmap. A hot key is one row a day before it meets the
    dictionary, thanks to the map-side part of the distinct."""
    ids = rows.select(day, column).distinct().join(dictionary, column)
    return ids.groupBy(day, F.bitmap_bucket_number("id").alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position("id")).alias("bitmap"))


def refresh_days(spark: SparkSession, root: str, rows: DataFrame, dictionary: DataFrame, days: Sequence,
                 day: str = "process_date", column: str = "user_id") -> None:
    """The bitmaps of ``days`` anew from ``rows`` (those days' rows); the
    months they lie in are replaced, so a repeat changes nothing."""
    month = F.date_format(day, "yyyy-MM")
    new = day_bitmaps(rows, dictionary, day, column).withColumn(MONTH, month)
    months = sorted({str(d)[:7] for d in days})
    names = {f"{MONTH}={m}" for m in months} & set(sink.child_names(spark, root))
    stage = scratch_dir(spark, "bitmaps")
    if names:
        old = spark.read.option("basePath", root).parquet(*[f"{root}/{n}" for n in sorted(names)])
        new = new.unionByName(old.withColumn(MONTH, month).where(~F.col(day).cast("string").isin([str(d) for d in days])))
    new.write.parquet(stage)
    sink.publish_partitions(spark, spark.read.schema(new.schema).parquet(stage), root, MONTH, (day, "bucket"), run_values=months)
    sink.delete_path(spark, stage)


def distinct_in_ranges(bitmaps: DataFrame, ranges: DataFrame, day: str = "process_date") -> DataFrame:
    """range_start, range_end (of ``ranges``, a short list) and the exact
    number of distinct keys in each: bitmaps OR-ed by bucket, bits counted."""
    held = bitmaps.join(F.broadcast(ranges), F.col(day).between(F.col("range_start"), F.col("range_end")))
    merged = held.groupBy("range_start", "range_end", "bucket").agg(F.bitmap_or_agg("bitmap").alias("bitmap"))
    return merged.groupBy("range_start", "range_end").agg(F.sum(F.bitmap_count("bitmap")).alias("distinct_keys"))
