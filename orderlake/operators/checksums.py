"""Locating differences between two copies of a table.

Each side is summed up in order-free checksums of its rows by (day, key-hash
prefix): a count and the sum of row hashes, a few bytes for each of 256 cells
a day, which may be kept with a table. Days are compared first, cells of
differing days next, and only rows of differing cells are read again and
compared key by key. What agrees is never joined.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import scratch_dir

CELL_BITS = 8


def _hashed(df: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """The key, the day, the cell and a hash that tells nulls from values."""
    told = [F.coalesce(F.concat(F.lit("="), F.col(c).cast("string")), F.lit("-")) for c in columns]
    text_key = F.coalesce(F.col(key).cast("string"), F.lit(""))
    return df.select(F.col(key).alias("key"), F.col(day).alias("day"), F.xxhash64(*told).alias("hash"),
                     F.shiftrightunsigned(F.xxhash64(text_key, F.lit(11)), 64 - CELL_BITS).alias("cell"))


def _sum():
    return F.sum(F.col("hash").cast("decimal(20,0)")).cast("decimal(38,0)")


def checksums(df: DataFrame, key: str, day: str, columns: Sequence[str]) -> DataFrame:
    """day, cell, n, total: one pass, partial sums map-side."""
    return _hashed(df, key, day, columns).groupBy("day", "cell").agg(F.count("*").alias("n"), _sum().alias("total"))


def _unequal(a: DataFrame, b: DataFrame, on: Sequence[str]) -> DataFrame:
    """The ``on`` of rows whose counts or sums differ, or that one side lacks."""
    same = [F.col(f"a.{c}").eqNullSafe(F.col(f"b.{c}")) for c in on]
    cond = same[0]
    for s in same[1:]:
        cond = cond & s
    j = a.alias("a").join(b.alias("b"), cond, "full_outer")
    differs = ~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.total").eqNullSafe(F.col("b.total")))
    return j.where(differs).select(*(F.when(F.col("a.n").isNotNull(), F.col(f"a.{c}")).otherwise(F.col(f"b.{c}")).alias(c) for c in on))


def differing_cells(a: DataFrame, b: DataFrame) -> DataFrame:
    """day and cell where two checksum tables differ: days first, then the
    cells of the days that do."""
    spark = a.sparkSession

    def kept(df: DataFrame, name: str) -> DataFrame:
        path = scratch_dir(spark, name)
        df.write.parquet(path)
        return spark.read.schema(df.schema).parquet(path)
    a, b = kept(a, "checksums"), kept(b, "checksums")
    by_day = [x.groupBy("day").agg(F.sum("n").alias("n"), F.sum("total").cast("decimal(38,0)").alias("total")) for x in (a, b)]
    days = kept(_unequal(*by_day, ["day"]), "differing-days")

    def within(x: DataFrame) -> DataFrame:
        return x.alias("x").join(days.alias("d"), F.col("x.day").eqNullSafe(F.col("d.day")), "left_semi")
    return kept(_unequal(within(a), within(b), ["day", "cell"]), "differing-cells")


def differences(source: DataFrame, target: DataFrame, key: str, day: str, columns: Sequence[str],
                source_sums: DataFrame | None = None, target_sums: DataFrame | None = None) -> DataFrame:
    """Per key and day that differ: key, day, difference (``lost``: not in the
    target, ``extra``: not in the source, ``copies``: there in other numbers,
    ``changed``: other values), source_rows, target_rows. Kept checksums of a
    side save its first pass. Null keys are compared as one key a day."""
    cells = differing_cells(source_sums if source_sums is not None else checksums(source, key, day, columns),
                            target_sums if target_sums is not None else checksums(target, key, day, columns))
    spread = cells.agg(F.min("day").alias("a"), F.max("day").alias("b"), F.count_if(F.col("day").isNull()).alias("nulls")).first()
    at = [source, target]
    if spread["a"] is not None and not spread["nulls"]:     # the reader skips days outside
        at = [x.where(F.col(day).between(F.lit(spread["a"]), F.lit(spread["b"]))) for x in (source, target)]

    def suspects(df: DataFrame, side: str) -> DataFrame:
        h = _hashed(df, key, day, columns).alias("h")
        rows = h.join(cells.alias("c"), F.col("h.day").eqNullSafe(F.col("c.day")) & (F.col("h.cell") == F.col("c.cell")), "left_semi")
        return rows.groupBy("key", "day").agg(F.count("*").alias("n"), _sum().alias("total")).withColumn("side", F.lit(side))
    both = suspects(at[0], "s").unionByName(suspects(at[1], "t"))

    def of(side: str, column: str):
        return F.max(F.when(F.col("side") == side, F.col(column)))
    k = both.groupBy("key", "day").agg(of("s", "n").alias("sn"), of("t", "n").alias("tn"), of("s", "total").alias("sh"),
                                       of("t", "total").alias("th"))
    kind = (F.when(F.col("tn").isNull(), "lost").when(F.col("sn").isNull(), "extra")
             .when(F.col("sn") != F.col("tn"), "copies").otherwise("changed"))
    return k.where(~(F.col("sn").eqNullSafe(F.col("tn")) & F.col("sh").eqNullSafe(F.col("th")))).select(
        F.col("key").alias(key), F.col("day").alias(day), kind.alias("difference"),
        F.coalesce("sn", F.lit(0)).alias("source_rows"), F.coalesce("tn", F.lit(0)).alias("target_rows"))
