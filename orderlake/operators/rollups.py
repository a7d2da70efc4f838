"""A8/A10/A11 with K4: rollups kept by the merge through signed deltas.

A merge that is given a ``Rollup`` emits, for every order it changes, the old
row with sign -1 and the new row with sign +1. Their sums by (day, segment) are
added to the rollup table, so a merge reads and writes only the groups it
changed, whatever the size of the gold table.

The days of a merge are noted as pending before the gold table is published
and cleared after the rollup is. A merge that died in between leaves its note;
the next one rebuilds those days from the gold table first.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..session import scratch_dir
from ..sinks import parquet as sink
from ..sources.files import read_partitions

MONTH = "rollup_month"
GROUP = ("process_date", "user_segment")
MEASURES = ("order_count", "total_revenue", "total_events")
#: The columns of a gold row that the rollup needs.
USED = ("user_segment", "amount", "event_count")


def _sums(rows: DataFrame, sign: Column) -> DataFrame:
    """Signed sums by group; money exact to the cent."""
    money = F.col("amount").try_cast("decimal(28,2)")
    return rows.groupBy(*GROUP).agg(
        F.sum(sign).cast("long").alias("order_count"), F.sum(money * sign).cast("decimal(38,2)").alias("total_revenue"),
        F.sum(F.col("event_count").cast("long") * sign).cast("long").alias("total_events"))


def deltas(merged: DataFrame) -> DataFrame:
    """Signed sums of a merge's rows: ``_in_src`` (the row is the source's) and
    ``_old`` (the target's values of the row it replaced, or null)."""
    changed = merged.where("_in_src")
    kinds = {c: merged.schema[c].dataType for c in USED}

    def row(prefix: str, sign: int) -> Column:
        return F.struct(*(F.col(prefix + c).cast(kinds[c]).alias(c) for c in USED), F.lit(sign).alias("_sign"))
    rows = F.when(F.col("_old").isNotNull(), F.array(row("", 1), row("_old.", -1))).otherwise(F.array(row("", 1)))
    return _sums(changed.select("process_date", F.inline(rows)), F.col("_sign"))


@dataclass(frozen=True)
class Rollup:
    """The rollup table of a gold table."""
    root: str

    @property
    def pending(self) -> str:
        return self.root.rstrip("/") + "_pending"

    def read(self, spark: SparkSession) -> DataFrame:
        """process_date, user_segment, order_count, total_revenue, total_events."""
        return spark.read.parquet(self.root).select(*GROUP, *MEASURES)

    def begin(self, spark: SparkSession, gold: str, days: list) -> None:
        """Repairs what a merge that died left, then notes the days of this one."""
        if sink.path_exists(spark, self.pending):
            left = [r[0] for r in spark.read.parquet(self.pending).distinct().collect()]
            self.rebuild(spark, gold, left)
            sink.delete_path(spark, self.pending)
        spark.createDataFrame([(d,) for d in days], "process_date date").coalesce(1).write.parquet(self.pending)

    def apply(self, spark: SparkSession, change: DataFrame, days: list) -> None:
        """Adds signed sums; groups without orders go."""
        self._publish(spark, change, days, drop_days=False)
        sink.delete_path(spark, self.pending)

    def rebuild(self, spark: SparkSession, gold: str, days: list) -> None:
        """The groups of ``days`` anew from the gold table; a repeat changes nothing."""
        rows = read_partitions(spark, gold, "process_date", days)
        self._publish(spark, _sums(rows, F.lit(1)), days, drop_days=True)

    def _publish(self, spark: SparkSession, change: DataFrame, days: list, drop_days: bool) -> None:
        months = sorted({str(d)[:7] for d in days})
        names = sorted({f"{MONTH}={m}" for m in months} & set(sink.child_names(spark, self.root)))
        both = change
        if names:
            old = spark.read.option("basePath", self.root).parquet(*[f"{self.root}/{n}" for n in names]).select(*GROUP, *MEASURES)
            both = both.unionByName(old.where(~F.col("process_date").isin(days)) if drop_days else old)
        total = both.groupBy(*GROUP).agg(*(F.sum(c).alias(c) for c in MEASURES)).where("order_count <> 0").withColumns({
            "total_revenue": F.col("total_revenue").cast("decimal(38,2)"), MONTH: F.date_format("process_date", "yyyy-MM")})
        stage = scratch_dir(spark, "rollup")
        sink.write_stage(total, stage)
        sink.publish_partitions(spark, spark.read.schema(total.schema).parquet(stage), self.root, MONTH, GROUP, run_values=months)
        sink.delete_path(spark, stage)


def date_segment_summary(rollup: DataFrame) -> DataFrame:
    """A11/O2 from the rollup."""
    return rollup.select(*GROUP, "order_count", F.col("total_revenue").cast("double").alias("total_revenue"), "total_events")


def month_totals(rollup: DataFrame) -> DataFrame:
    """A10 from the rollup."""
    return rollup.groupBy(F.trunc("process_date", "month").alias("month")).agg(
        F.sum("total_revenue").cast("double").alias("total_revenue"))
