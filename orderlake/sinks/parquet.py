"""Parquet sinks: K1/K2 date-partitioned dynamic overwrite, K3 full replace,
K9 clustering, partition delete (H8) and the staged publish used by the
gate-before-publish pattern."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .layout import Layout
from .table_schema import update_table_schema


def write_partitioned(df: DataFrame, path: str, partition_col: str = "process_date",
                      cluster_by: Sequence[str] | None = ("user_segment", "user_id"),
                      max_records_per_file: int | None = None, layout: Layout | None = None) -> None:
    """K1/K2/K9: Snappy Parquet, one folder per ``partition_col`` value; only
    the partitions present in ``df`` are replaced (dynamic overwrite).

    Rows are range-partitioned on (partition column, cluster columns) and
    sorted inside each task, so a huge day is spread over several tasks
    instead of one, every day is written by few tasks (few files), and
    Parquet min/max statistics on the cluster columns let readers skip row
    groups. Range boundaries come from a sample of ``df``: pass a staged
    (already materialised) frame so the sample does not recompute joins.
    A ``layout`` replaces the sort on the cluster columns by its curve.
    """
    if layout is None:
        out = spread_by_range(df, partition_col, cluster_by)
    else:
        out = spread_by_range(df.withColumn("_curve", layout.place(df)), partition_col, ("_curve",)).drop("_curve")
    w = (out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .option("compression", "snappy"))
    if layout is not None:
        w = w.options(**layout.options(df.columns))
    if max_records_per_file:
        w = w.option("maxRecordsPerFile", int(max_records_per_file))
    update_table_schema(df.sparkSession, path, df.schema)  # first: a reader never misses a column
    w.partitionBy(partition_col).parquet(path)


def spread_by_range(df: DataFrame, partition_col: str,
                    cluster_by: Sequence[str] | None = None) -> DataFrame:
    """Range-partition on (partition column, cluster columns, row hash) and
    sort inside tasks on (partition column, cluster columns). The row hash is
    the last range key, so even a single hot day (or a hot user inside a
    day) is cut into several tasks by the range boundaries."""
    keys = [partition_col, *[c for c in (cluster_by or []) if c in df.columns]]
    spread = F.xxhash64(*[F.col(c) for c in df.columns])
    return (df.withColumn("_spread", spread).repartitionByRange(*keys, "_spread")
              .sortWithinPartitions(*keys).drop("_spread"))


def write_replace(df: DataFrame, path: str) -> None:
    """K3: replace the whole table (staging is ephemeral)."""
    (df.write.mode("overwrite").option("partitionOverwriteMode", "static")
       .option("compression", "snappy").parquet(path))


def write_stage(df: DataFrame, path: str) -> None:
    """Materialise a run's result once (no partition folders, one file per
    task). This cuts the lineage: gates and publish read the files."""
    df.write.mode("overwrite").option("compression", "snappy").parquet(path)


def _fs(spark: SparkSession, path: str):
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()), p


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = _fs(spark, path)
    return bool(fs.exists(p))


def delete_path(spark: SparkSession, path: str) -> None:
    fs, p = _fs(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def delete_partitions(spark: SparkSession, root: str, partition_col: str,
                      values: Iterable) -> list[str]:
    """H8: remove partitions that a re-run leaves empty (dynamic overwrite
    with zero rows would keep the old data)."""
    removed = []
    for v in values:
        target = f"{root.rstrip('/')}/{partition_col}={v}"
        if path_exists(spark, target):
            delete_path(spark, target)
            removed.append(target)
    return removed


def publish_partitions(spark: SparkSession, staged_path: str | DataFrame, target: str,
                       partition_col: str = "process_date",
                       cluster_by: Sequence[str] | None = ("user_segment", "user_id"),
                       run_values: Iterable | None = None, layout: Layout | None = None) -> None:
    """Copy a staged result into ``target`` with dynamic overwrite; run
    partitions that ended up empty are deleted (H8)."""
    staged = (staged_path if isinstance(staged_path, DataFrame)
              else spark.read.parquet(staged_path))
    if run_values is not None:
        present = {r[0] for r in staged.select(partition_col).distinct().collect()}
        delete_partitions(spark, target, partition_col,
                          [v for v in run_values if v not in present])
        if not present:
            return
    write_partitioned(staged, target, partition_col, cluster_by, layout=layout)


def child_names(spark: SparkSession, root: str) -> list[str]:
    """Names directly below a folder, hidden ones left out; one listing."""
    fs, p = _fs(spark, root)
    if not fs.exists(p):
        return []
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    return sorted(n for n in names if not n.startswith(("_", ".")))


def partition_values(spark: SparkSession, root: str, partition_col: str = "process_date") -> list[str]:
    """Values of the partition folders, from their names: no file is opened."""
    prefix = f"{partition_col}="
    return [n[len(prefix):] for n in child_names(spark, root)
            if n.startswith(prefix) and "__HIVE_DEFAULT" not in n]
