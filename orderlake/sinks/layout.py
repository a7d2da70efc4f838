"""Rows laid out along an interleaved curve, Bloom filters in the files.

A sort on (segment, user) lets readers skip row groups for a segment, hardly for
a user alone. Here each column is cut into ranges of about equal rows and the
bits of the range numbers are interleaved, so the values of every column lie
close together and the row groups' minima and maxima serve them all. A key that
is spread over all rows, such as the order id, gets a Parquet Bloom filter.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: Rows that the range bounds are taken from. They only place rows, results don't depend on them.
BOUNDS_SAMPLE = 200_000


def range_bounds(df: DataFrame, column: str, bits: int, rows: int) -> list:
    """At most ``2**bits - 1`` values that cut the column into ranges of about
    equal rows; ``rows`` is the row count of ``df``."""
    some = df.select(F.col(column).alias("v")).where("v IS NOT NULL")
    if rows > BOUNDS_SAMPLE:
        some = some.sample(BOUNDS_SAMPLE / rows, seed=1)
    cut = some.repartitionByRange(1 << bits, "v").withColumn("_range", F.spark_partition_id())
    return sorted({r["low"] for r in cut.groupBy("_range").agg(F.min("v").alias("low")).collect()})[1:]


def range_number(value: Column, bounds: Sequence) -> Column:
    """How many bounds are at most ``value``, by halving; a null counts as least."""
    def between(low: int, high: int) -> Column:
        if low == high:
            return F.lit(low)
        mid = (low + high) // 2
        return F.when(value < F.lit(bounds[mid]), between(low, mid)).otherwise(between(mid + 1, high))
    return F.when(value.isNull(), F.lit(0)).otherwise(between(0, len(bounds)))


def interleaved(numbers: Sequence[Column], bits: int) -> Column:
    """One long from the bits of all numbers, highest bits first."""
    out = F.lit(0).cast("long")
    for i, number in enumerate(numbers):
        for bit in range(bits):
            place = bit * len(numbers) + len(numbers) - 1 - i
            out = out + F.shiftleft(F.shiftright(number, bit).bitwiseAND(F.lit(1)).cast("long"), place)
    return out


@dataclass(frozen=True)
class Layout:
    """``columns`` are interleaved with ``bits`` bits each (at most 62 in all);
    ``bloom`` columns get a Bloom filter for ``distinct`` values a row group;
    ``row_group_bytes`` overrides Parquet's default."""
    columns: tuple[str, ...] = ("user_segment", "user_id")
    bloom: tuple[str, ...] = ("order_id",)
    bits: int = 6
    distinct: int = 1_000_000
    row_group_bytes: int | None = None

    def place(self, df: DataFrame) -> Column:
        """The curve position of each row of a written frame."""
        rows = df.count()
        present = [c for c in self.columns if c in df.columns]
        return interleaved([range_number(F.col(c), range_bounds(df, c, self.bits, rows)) for c in present], self.bits)

    def options(self, columns: Sequence[str]) -> dict[str, str]:
        out = {}
        for c in self.bloom:
            if c in columns:
                out[f"parquet.bloom.filter.enabled#{c}"] = "true"
                out[f"parquet.bloom.filter.expected.ndv#{c}"] = str(self.distinct)
        if self.row_group_bytes:
            out["parquet.block.size"] = str(self.row_group_bytes)
        return out
