"""File sources: daily Parquet drops, the segment dimension, processed and
gold tables, and the legacy CSV history.

All readers are lazy; none runs an action. Row counts for logs are taken
with ``Observation`` during the single write job (see ``plans.daily``).
"""

from __future__ import annotations

import re
from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import canonical_alias
from ..schemas import HISTORY_CSV_SCHEMA
from ..sinks.parquet import child_names
from ..sinks.table_schema import read_table_schema


# The date of segment drops that tell none.
UNDATED = "0001-01-01"


def read_orders(spark: SparkSession, root: str, run_date: str | date) -> DataFrame:
    """One day's orders file ``orders/orders_{date}.parquet``."""
    return spark.read.parquet(f"{root.rstrip('/')}/orders/orders_{run_date}.parquet")


def read_events(spark: SparkSession, root: str, run_date: str | date) -> DataFrame:
    """One day's events file; accepts the old/new event-type names."""
    df = spark.read.parquet(f"{root.rstrip('/')}/events/events_{run_date}.parquet")
    return canonical_alias(df, "event_type")


def dated_drops(spark: SparkSession, root: str, kind: str, dates) -> dict[str, list[str]]:
    """date -> path of the drop ``{kind}/{kind}_{date}.parquet`` where it
    exists, from one listing of names."""
    base = f"{root.rstrip('/')}/{kind}"
    there = set(child_names(spark, base))
    return {str(d): [f"{base}/{kind}_{d}.parquet"] for d in dates if f"{kind}_{d}.parquet" in there}


def read_dated(spark: SparkSession, drops: dict[str, list[str]], dates, column: str,
               empty: str | None = None) -> DataFrame:
    """The drops of several dates in one frame, each row with the date in its
    drop's name. Without any drop: an empty frame of the DDL ``empty``."""
    paths = [p for d in dates for p in drops.get(str(d), [])]
    if not paths:
        return spark.createDataFrame([], f"{empty}, {column} date")
    # one scan; a renamed column shows under both names and is settled per row
    df = (spark.read.option("mergeSchema", "true").option("recursiveFileLookup", "true").parquet(*paths))
    day = F.regexp_extract(F.col("_metadata.file_path"), r"_(\d{4}-\d{2}-\d{2})\.parquet", 1).cast("date")
    return canonical_alias(df.withColumn(column, day), "event_type")


def read_segments(spark: SparkSession, root: str, latest_only: bool = True,
                  paths: list[str] | None = None) -> DataFrame:
    """S3: the segment dimension, ``segment`` renamed to ``user_segment``.

    ``latest_only`` (H12 fix) reads only the newest weekly drop: the entry
    directly below ``segments/`` (a file or a folder of part files) whose name
    sorts last. One listing of names picks it; older drops are not opened, and
    the drop is read with its own schema. Otherwise every drop is read with its
    own schema and the drops are united by name. ``paths`` names the files of
    the drop instead (the landing manifest).
    """
    if paths is not None:
        return canonical_alias(spark.read.parquet(*paths), "user_segment")
    base = f"{root.rstrip('/')}/segments"
    names = child_names(spark, base)
    if not names:
        raise FileNotFoundError(f"no segment drop below {base}")

    def drop(name: str) -> DataFrame:
        df = spark.read.option("recursiveFileLookup", "true").parquet(f"{base}/{name}")
        return canonical_alias(df, "user_segment")

    if any(n.startswith("part-") for n in names):  # one folder of part files is one drop
        return canonical_alias(spark.read.option("recursiveFileLookup", "true").parquet(base), "user_segment")
    out = drop(names[-1])
    for name in [] if latest_only else names[:-1]:
        out = out.unionByName(drop(name), allowMissingColumns=True)
    return out


def segment_drops(spark: SparkSession, root: str, paths: list[str] | None = None, first: str | date | None = None,
                  last: str | date | None = None) -> list[tuple[str, DataFrame]]:
    """S3 over time: (date, user_id and user_segment) of the drops that held on
    any day from ``first`` to ``last``, in order; a drop holds until the next.

    A drop is an entry directly below ``segments/`` (or of ``paths``, the
    landing manifest). Its date is the one in its name, or else the greatest
    ``segment_date`` of its rows; drops with neither hold before all dated
    ones, and of them the last by name counts. Each is read with its own
    schema, a renamed column under its new name; drops that held before or
    after the days asked for are not opened, where their names tell."""
    base = f"{root.rstrip('/')}/segments"
    by: dict[str, list[str]] = {}
    if paths is None:
        names = child_names(spark, base)
        by = {"": [base]} if any(n.startswith("part-") for n in names) else {n: [f"{base}/{n}"] for n in names}
    else:
        for p in sorted(paths):
            name = p.rsplit("/segments/", 1)[-1].split("/", 1)[0]
            by.setdefault("" if name.startswith("part-") else name, []).append(p)
    if not by:
        raise FileNotFoundError(f"no segment drop below {base}")

    def read(files: list[str]) -> DataFrame:
        return canonical_alias(spark.read.option("recursiveFileLookup", "true").parquet(*files), "user_segment")
    dated: dict[str, DataFrame] = {}
    named = {n: m.group() for n in sorted(by) if (m := re.search(r"\d{4}-\d{2}-\d{2}", n))}
    held = sorted(d for d in named.values() if first is None or d <= str(first))
    for name in sorted(by):
        day = named.get(name)
        if day and ((held and day < held[-1]) or (last is not None and day > str(last))):
            continue
        df = read(by[name])
        if day is None and "segment_date" in df.columns:
            day = df.agg(F.max(F.col("segment_date").cast("date")).cast("string")).first()[0]
        dated[day or UNDATED] = df
    if first is not None:
        before = [d for d in dated if d <= str(first)]
        dated = {d: df for d, df in dated.items() if d not in before or d == max(before)}
    return [(d, dated[d].select("user_id", "user_segment")) for d in sorted(dated) if last is None or d <= str(last)]


def read_processed(spark: SparkSession, root: str) -> DataFrame:
    """processed/gold tables. The schema kept with the table is passed to
    the reader (no footer scan); columns that only some partitions have read
    as NULL elsewhere. Tables written by others fall back to ``mergeSchema``
    (history vs daily layout, H10)."""
    schema = read_table_schema(spark, root)
    if schema is not None:
        return spark.read.schema(schema).parquet(root)
    return spark.read.option("mergeSchema", "true").parquet(root)


def read_partitions(spark: SparkSession, root: str, partition_col: str,
                    values, merge_schema: bool = True, none_if_missing: bool = False, listed: bool = False):
    """Read only the named partition folders (``basePath`` keeps the column).

    The folders' names come from one listing of the table root; only the
    named folders are listed further, and only their files opened, so the
    cost follows the days asked for. Days without a folder are simply absent.
    ``listed``: the values come from such a listing. When no folder matches: ``None`` if ``none_if_missing``, else an empty
    frame with the table's schema (one footer read, no merge)."""
    root = root.rstrip("/")
    there = None if listed else set(child_names(spark, root))
    vals = [v for v in sorted({str(v) for v in values}) if listed or f"{partition_col}={v}" in there]
    schema = read_table_schema(spark, root)
    r = spark.read.option("basePath", root)
    r = r.schema(schema) if schema is not None else r.option("mergeSchema", str(merge_schema).lower())
    if vals:
        return r.parquet(*[f"{root}/{partition_col}={v}" for v in vals])
    if none_if_missing:
        return None
    if schema is not None:
        return spark.createDataFrame([], schema)
    return spark.read.parquet(root).where(F.lit(False))


def read_partition(spark: SparkSession, root: str, partition_col: str,
                   value: str | date) -> DataFrame:
    """One partition folder, keeping the partition column via basePath."""
    return read_partitions(spark, root, partition_col, [value])


def read_history_csv(spark: SparkSession, path: str) -> DataFrame:
    """Legacy CSV, header row, comma separated, every field a string.

    A ``date=YYYY-MM-DD`` folder layout is discovered as a partition column.
    """
    return (spark.read.option("header", "true").option("sep", ",")
            .option("mode", "PERMISSIVE")
            .schema(HISTORY_CSV_SCHEMA).csv(path))


def read_history_range(spark: SparkSession, root: str, start: str, end: str,
                       partition_col: str = "date") -> DataFrame:
    """A bounded range of the ``date=`` folders; the filter reaches the
    file listing as a partition filter, so other folders are never opened."""
    df = read_history_csv(spark, root)
    return df.where(F.col(partition_col).between(F.lit(start).cast("date"),
                                                 F.lit(end).cast("date")))
