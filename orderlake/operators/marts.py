"""Served queries on the gold table.

Reads go through ``guarded_read``: a date range is mandatory. The day folders in
it are named to the reader, so no other folder is listed or read; a range over
more than half of the table is a partition filter on its scan.
``require_partition_filter`` checks a free-form plan for either.
"""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import money_sum
from ..sinks.parquet import partition_values
from ..sources.files import read_partitions, read_processed

# A range of so many days that goes beyond both ends of the table is a sentinel,
# no filter. A range within the table may be of any length.
MAX_RANGE_DAYS = 3_660


class PartitionFilterRequired(ValueError):
    """A query over the gold table has no usable partition filter."""


def table_days(spark: SparkSession, root: str, partition_col: str = "process_date") -> tuple[str, str]:
    """First and last day of a table, from its folder names (no file is opened)."""
    days = partition_values(spark, root, partition_col)
    if not days:
        raise PartitionFilterRequired(f"no {partition_col} partition in {root}")
    return min(days), max(days)


def guarded_read(spark: SparkSession, root: str, start: str | date | Column,
                 end: str | date | Column, partition_col: str = "process_date",
                 max_days: int = MAX_RANGE_DAYS) -> DataFrame:
    """Read the gold table for ``start <= partition_col <= end`` only."""
    if start is None or end is None:
        raise PartitionFilterRequired(f"a {partition_col} range is required")
    if isinstance(start, Column) or isinstance(end, Column):
        lo, hi = (x if isinstance(x, Column) else F.lit(str(x)).cast("date") for x in (start, end))
        return read_processed(spark, root).where(F.col(partition_col).between(lo, hi))
    a, b = date.fromisoformat(str(start)), date.fromisoformat(str(end))
    days = partition_values(spark, root, partition_col)
    if (b - a).days >= max_days and (not days or (str(a) < min(days) and max(days) < str(b))):
        raise PartitionFilterRequired(f"a range of {(b - a).days + 1} days is no filter (limit {max_days})")
    inside = [d for d in days if str(a) <= d <= str(b)]
    if 2 * len(inside) <= len(days):
        return read_partitions(spark, root, partition_col, inside, listed=True)
    return read_processed(spark, root).where(F.col(partition_col).between(F.lit(str(a)).cast("date"), F.lit(str(b)).cast("date")))


def _scans(plan):
    """The file scans of a physical plan, those of its subqueries too."""
    found, todo = [], [plan]
    while todo:
        node = todo.pop()
        if node.getClass().getSimpleName() == "FileSourceScanExec":
            found.append(node)
        for seq in (node.children(), node.subqueries()):
            todo += [seq.apply(i) for i in range(seq.size())]
    return found


def require_partition_filter(df: DataFrame, partition_col: str = "process_date") -> DataFrame:
    """P22 for free-form queries: every scan of a table partitioned by
    ``partition_col`` must filter on it beyond ``isnotnull``, or read named
    folders of it only, and there must be such a scan."""
    guarded = 0
    for scan in _scans(df._jdf.queryExecution().sparkPlan()):
        if partition_col not in list(scan.relation().partitionSchema().fieldNames()):
            continue
        filters = scan.partitionFilters()
        terms = [filters.apply(i).toString() for i in range(filters.size())]
        roots = scan.relation().location().rootPaths()
        named = all(f"{partition_col}=" in roots.apply(i).getName() for i in range(roots.size()))
        if not named and not any(partition_col in t and not t.startswith("isnotnull(") for t in terms):
            raise PartitionFilterRequired(f"queries over the gold table require a filter on {partition_col}")
        guarded += 1
    if not guarded:
        raise PartitionFilterRequired(f"no partitioned scan filtered on {partition_col}")
    return df


def revenue_by_segment(gold: DataFrame) -> DataFrame:
    """Per day and segment: revenue and exact distinct orders, by
    revenue descending."""
    return (gold.groupBy("process_date", "user_segment")
                .agg(money_sum("amount").alias("total_revenue"),
                     F.count_distinct("order_id").alias("order_count"))
                .orderBy(F.col("process_date"), F.col("total_revenue").desc()))


def segment_revenue(gold: DataFrame) -> DataFrame:
    """Revenue per segment over the frame (one day when guarded)."""
    return (gold.groupBy("user_segment").agg(money_sum("amount").alias("total_revenue"))
                .orderBy(F.col("total_revenue").desc()))


def revenue_trend(gold: DataFrame) -> DataFrame:
    """Revenue per day."""
    return (gold.groupBy("process_date").agg(money_sum("amount").alias("total_revenue"))
                .orderBy("process_date"))


def month_totals(gold: DataFrame) -> DataFrame:
    """A10: revenue per calendar month."""
    return (gold.groupBy(F.trunc("process_date", "month").alias("month"))
                .agg(money_sum("amount").alias("total_revenue")).orderBy("month"))


def date_segment_summary(gold: DataFrame) -> DataFrame:
    """Orders, revenue and events per (day, segment), ORDER BY 1, 3 DESC."""
    return (gold.groupBy("process_date", "user_segment")
                .agg(F.count(F.lit(1)).alias("order_count"),
                     money_sum("amount").alias("total_revenue"),
                     F.sum("event_count").cast("long").alias("total_events"))
                .orderBy(F.col("process_date"), F.col("order_count").desc()))


def user_order_count(gold: DataFrame, user_id: str | None = None) -> DataFrame:
    """COUNT(*) for one user, or per user when ``user_id`` is None."""
    if user_id is not None:
        return gold.where(F.col("user_id") == user_id).agg(F.count(F.lit(1)).alias("order_count"))
    return gold.groupBy("user_id").agg(F.count(F.lit(1)).alias("order_count"))


def distinct_users(gold: DataFrame) -> DataFrame:
    """Distinct users in the frame (bounded from below by the guard)."""
    return gold.select("user_id").distinct()


def order_lookup(df: DataFrame, order_ids: DataFrame | list[str]) -> DataFrame:
    """P20: rows for given order ids. A key frame is a semi-join (no
    driver-side list); a short list becomes an IN filter."""
    if isinstance(order_ids, DataFrame):
        return df.join(order_ids.select("order_id").distinct(), "order_id", "left_semi")
    return df.where(F.col("order_id").isin(order_ids))


def segment_user_lookup(gold: DataFrame, segment: str | None = None,
                        user_id: str | None = None) -> DataFrame:
    """Point / combined lookups within the guarded date range; the
    clustered layout lets Parquet statistics skip row groups."""
    cond = F.lit(True)
    if segment is not None:
        cond = cond & (F.col("user_segment") == segment)
    if user_id is not None:
        cond = cond & (F.col("user_id") == user_id)
    return gold.where(cond)
