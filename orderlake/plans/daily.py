"""Enrichment runs for one date or a date range, safe to repeat.

The enriched result is written once to a run-scoped stage folder. The row
gate (Q1) compares counts taken from written files and from one key column,
never from counters of tasks that may run twice. Only then is the stage
published into the processed table with dynamic partition overwrite. Run dates
that end up with no rows are deleted (H8).

Late rows (H7): rows whose process_date the run does not own go to the late
table, one folder per run (``late_run``), so runs never replace each other's
late rows and a repeated run replaces its own. ``late.merge_late`` upserts
them into the processed and gold days they belong to; a later run of such a
day takes them in again, so no run of any day loses them.

A range run (``batch``) gives what its days would give one after the other:
orders are deduplicated per batch date, events counted per batch date and user.
"""

from __future__ import annotations

import re
from collections.abc import Sequence
from dataclasses import dataclass, field
from datetime import date, datetime, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import enrichment as E
from ..operators import asof
from ..operators.gates import GateError, RowGate
from ..operators.joins import hot_keys
from ..schemas import APPROVED_OUTPUT_COLUMNS, ROW_EXPLOSION_THRESHOLD
from ..session import scratch_dir
from ..sinks import parquet as sink
from ..sources.files import read_processed

RUN_DATE = re.compile(r"\d{4}-\d{2}-\d{2}")


def parse_run_date(value: str | date) -> date:
    """Q15: the run date must be ``YYYY-MM-DD``; no other ISO form, no time."""
    if isinstance(value, datetime):
        raise ValueError(f"invalid run date {value!r}, expected YYYY-MM-DD")
    if isinstance(value, date):
        return value
    try:
        if not RUN_DATE.fullmatch(value):
            raise ValueError(value)
        return date.fromisoformat(value)
    except (TypeError, ValueError) as exc:
        raise ValueError(f"invalid run date {value!r}, expected YYYY-MM-DD") from exc


def date_range(start: str | date, end: str | date) -> list[date]:
    a, b = parse_run_date(start), parse_run_date(end)
    return [a + timedelta(days=i) for i in range((b - a).days + 1)]


@dataclass
class RunResult:
    status: str                      # SUCCESS | SKIPPED
    rows_in: int = 0
    rows_out: int = 0
    late_rows: int = 0
    broadcast_segments: bool = False
    broadcast_events: bool = False
    gate: RowGate | None = None
    notes: list[str] = field(default_factory=list)


BATCH = "_batch"


def run_enrichment(spark: SparkSession, orders: DataFrame, events: DataFrame,
                   segments: DataFrame, processed_root: str,
                   run_dates: Sequence[str | date] | None = None,
                   late_root: str | None = None,
                   tie_breakers: Sequence[str] = E.DEFAULT_TIE_BREAKERS,
                   dedup_events: bool = False,
                   approved: Sequence[str] = APPROVED_OUTPUT_COLUMNS,
                   threshold: float = ROW_EXPLOSION_THRESHOLD,
                   broadcast_limit: int = E.DEFAULT_BROADCAST_LIMIT,
                   on_duplicate_segments: str = "fail",
                   batch: bool = False,
                   hot_opts: dict | None = None,
                   segment_intervals: DataFrame | None = None) -> RunResult:
    """Enrich ``orders`` and publish into ``processed_root``.

    ``run_dates`` (None = every date in the batch) scopes the partitions the
    run owns; rows dated outside them go to ``late_root`` (default: the
    processed root's ``_late`` sibling), never silently away. With ``batch``
    both feeds carry a date column ``_batch`` (the drop a row came in): a batch
    owns the rows of its own date only. ``on_duplicate_segments``: ``fail``
    (Q16 before the join) or ``keep_latest`` (W1 on user_id by
    ``segment_date`` when present). ``segment_intervals`` (``operators.asof``)
    instead of ``segments``: an order's segment is the one as of its batch date
    (its process date without ``batch``).
    """
    dates = sorted({parse_run_date(d) for d in run_dates}) if run_dates else None
    by_batch = [BATCH] if batch else []

    # Q16 + broadcast licence: one small job over the pruned dimension.
    prof = None
    if segment_intervals is None:
        segments = E.canonical_alias(segments, "user_segment")
        prof = E.dimension_profile(segments)
    if prof is not None and prof.duplicate_keys:
        if on_duplicate_segments == "fail":
            raise GateError(f"segment dimension has {prof.duplicate_keys} duplicated user_id keys")
        order = ["segment_date desc"] if "segment_date" in segments.columns else []
        segments = E.latest_per_key(segments, ["user_id"], order, ["user_segment asc"])

    # A1/A2 once, written (lineage cut): its size decides the J1 strategy.
    work = scratch_dir(spark, "enrich")
    try:
        return _run(spark, orders, events, segments, prof, processed_root, dates, late_root, tie_breakers, dedup_events,
                    approved, threshold, broadcast_limit, by_batch, hot_opts or {}, work, segment_intervals)
    finally:
        sink.delete_path(spark, work)


def _run(spark: SparkSession, orders: DataFrame, events: DataFrame, segments: DataFrame, prof: E.DimensionProfile | None,
         processed_root: str, dates: list[date] | None, late_root: str | None, tie_breakers: Sequence[str],
         dedup_events: bool, approved: Sequence[str], threshold: float, broadcast_limit: int, by_batch: list[str],
         hot_opts: dict, work: str, intervals: DataFrame | None) -> RunResult:
    """The run below its work folder, which the caller deletes."""
    agg = E.staged_summary(events, [*by_batch, "user_id"], dedup_events, path=f"{work}/events")
    events_prof = E.dimension_profile(agg, cols=[*by_batch, *E.EVENTS_AGG_COLS], check_unique=False)
    do_broadcast, events_broadcast = (E.broadcast_licence([prof, events_prof], broadcast_limit) if prof is not None
                                      else (False, *E.broadcast_licence([events_prof], broadcast_limit)))
    hot = None if do_broadcast and events_broadcast else hot_keys(
        orders, "user_id", path=f"{work}/hot-keys", **hot_opts)

    # Q1 baseline: distinct keys of the input, one pruned pass.
    rows_in = orders.select(*by_batch, "order_id").distinct().count()
    deduped = E.latest_per_key(orders, [*by_batch, "order_id"], ["process_date desc"], tie_breakers)
    if intervals is not None:
        deduped = asof.as_of_join(deduped, intervals, BATCH if by_batch else "process_date", hot=hot)
    enriched = E.enrich_orders(deduped, agg, None if intervals is not None else segments, broadcast_segments=do_broadcast,
                               broadcast_events=events_broadcast, hot=hot,
                               events_on=[*by_batch, "user_id"])
    final = E.cast_and_select(E.apply_business_rules(enriched), [*approved, *by_batch])

    sink.write_stage(final, f"{work}/enriched")
    staged = spark.read.schema(final.schema).parquet(f"{work}/enriched")
    gate = RowGate(rows_in, staged.count(), threshold)
    result = RunResult("SUCCESS", gate.rows_in, gate.rows_out, gate=gate,
                       broadcast_segments=do_broadcast, broadcast_events=events_broadcast)
    gate.enforce()  # raises before anything is published
    if dates is None:
        sink.publish_partitions(spark, staged.drop(BATCH), processed_root, "process_date")
    else:
        late_root = late_root or processed_root.rstrip("/") + "_late"
        result.late_rows = _publish_run(spark, staged, processed_root, late_root, dates, bool(by_batch), work)
    return result


def _publish_run(spark: SparkSession, staged: DataFrame, processed_root: str, late_root: str,
                 dates: list[date], batch: bool, work: str) -> int:
    """Late rows into their runs' folders, then the owned days, each with the
    late rows other runs have for it; the newest run of an order wins."""
    run = F.col(BATCH) if batch else F.lit(max(dates))
    staged = staged.withColumn("late_run", run).drop(BATCH)
    owned = F.col("process_date") == F.col("late_run") if batch else F.col("process_date").isin(dates)
    owned = F.coalesce(owned & F.col("process_date").isin(dates), F.lit(False))
    late = staged.where(~owned)
    count = late.count()
    runs = dates if batch else [max(dates)]
    if count:
        sink.publish_partitions(spark, late, late_root, "late_run", ("process_date", "user_id"), run_values=runs)
    else:  # a repeated run without late rows leaves none of its former ones
        sink.delete_partitions(spark, late_root, "late_run", runs)
    mine = staged.where(owned)
    if sink.partition_values(spark, late_root, "late_run"):
        others = read_processed(spark, late_root).where(F.col("process_date").isin(dates))
        both = mine.unionByName(others, allowMissingColumns=True)
        mine = E.latest_per_key(both, ["process_date", "order_id"], ["late_run desc"], E.DEFAULT_TIE_BREAKERS)
    mine = mine.drop("late_run")
    sink.write_stage(mine, f"{work}/days")
    sink.publish_partitions(spark, spark.read.schema(mine.schema).parquet(f"{work}/days"),
                            processed_root, "process_date", run_values=dates)
    return count


def run_daily(spark: SparkSession, validated_root: str, processed_root: str,
              run_date: str | date, registry: str | None = None, **kw) -> RunResult:
    """One logical date; repeatable. With ``registry`` only the paths
    the landing gate has validated are read (K7); without, the drop files below
    ``validated_root`` by name. A date without orders is SKIPPED (Q14)."""
    return run_range(spark, validated_root, processed_root, [parse_run_date(run_date)], registry, **kw)


def run_range(spark: SparkSession, validated_root: str, processed_root: str,
              run_dates: Sequence[str | date], registry: str | None = None, **kw) -> RunResult:
    """B2: several dates in one job, equal to their daily runs in order. Users
    have the segments as of the run date, from the drops up to then, so a
    replay gives what the day gave."""
    from ..sources.files import dated_drops, read_dated, segment_drops
    dates = sorted({parse_run_date(d) for d in run_dates})
    paths = None
    if registry is None:
        orders, events = (dated_drops(spark, validated_root, kind, dates) for kind in ("orders", "events"))
    else:
        from ..operators.landing import manifest_paths
        orders, events = (manifest_paths(spark, registry, kind, dates) for kind in ("orders", "events"))
        segments = manifest_paths(spark, registry, "user_segments", None)
        paths = sorted({p for drop in segments.values() for p in drop})
    dates = [d for d in dates if str(d) in orders]
    if not dates or (registry is not None and not paths):
        return RunResult("SKIPPED", notes=["no validated input"])
    drops = segment_drops(spark, validated_root, paths, dates[0], dates[-1])
    segments, intervals = drops[0][1] if drops else None, None
    if not drops:                               # no drop held yet
        segments = spark.createDataFrame([], "user_id string, user_segment string")
    elif len(drops) > 1 or drops[0][0] > str(dates[0]):
        asof.check_unique(drops)
        segments, intervals = None, asof.segment_intervals(drops)
    return run_enrichment(
        spark, read_dated(spark, orders, dates, BATCH),
        E.canonical_alias(read_dated(spark, events, dates, BATCH, "event_id string, user_id string, event_type string"),
                          "event_type"),
        segments, processed_root, run_dates=dates, batch=True, segment_intervals=intervals, **kw)
