"""Daily enrichment operators: W1, A1/A2, J1/J2, P3–P7.

Every function is DataFrame -> DataFrame and runs no action, except
``dimension_profile`` which is the explicit size/uniqueness check that
decides whether the dimension may be broadcast.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.columns import amount_ok, canonical_alias, finite_amount, safe_cast
from ..schemas import APPROVED_OUTPUT_COLUMNS, PROCESSED_TYPES, UNCLASSIFIED_SEGMENT
from ..session import scratch_dir
from .joins import hot_keys, left_lookup_joins

# Deterministic order among rows of one order on the same date (H1): the
# reference leaves the survivor arbitrary; a total order also makes a
# recomputed task (after executor loss) pick the same row.
DEFAULT_TIE_BREAKERS = ("amount desc", "user_id asc", "currency asc")

# Largest dimension (bytes of the pruned join columns) that is broadcast.
DEFAULT_BROADCAST_LIMIT = 256 * 1024 * 1024


def _order_col(spec: str | Column) -> Column:
    if isinstance(spec, Column):
        return spec
    parts = spec.split()
    c = F.col(parts[0])
    if len(parts) > 1 and parts[1].lower() == "desc":
        return c.desc_nulls_last()
    return c.asc_nulls_last()


def latest_per_key(df: DataFrame, keys: Sequence[str] = ("order_id",),
                   order_by: Sequence[str | Column] = ("process_date desc",),
                   tie_breakers: Sequence[str | Column] = ()) -> DataFrame:
    """Keep the first row per key under ``order_by`` (+ tie breakers).

    ``row_number() = 1`` lets Catalyst add a partial WindowGroupLimit before
    the shuffle, so each map task forwards at most one row per key: a hot key
    does not move all of its rows. All NULL keys form one group (H2).
    """
    w = Window.partitionBy(*keys).orderBy(*[_order_col(s) for s in (*order_by, *tie_breakers)])
    return (df.withColumn("_rn", F.row_number().over(w))
              .where(F.col("_rn") == 1).drop("_rn"))


def aggregate_events(events: DataFrame, key: str | Sequence[str] = "user_id",
                     dedup_events: bool = False) -> DataFrame:
    """A1/A2: one row per user: non-NULL event count and the sorted set of
    distinct event types (all-NULL types → empty array).

    Partial aggregation runs map-side: a user holding a third of all events
    sends one partial row per map task, never its raw events. ``dedup_events``
    (H3, default off as in the reference) drops repeated event ids first. A
    range run passes (batch date, user) as ``key``.
    """
    keys = [key] if isinstance(key, str) else list(key)
    events = canonical_alias(events, "event_type")
    if dedup_events:
        events = events.dropDuplicates(["event_id"])
    return events.groupBy(*keys).agg(
        F.count("event_type").alias("event_count"),
        F.sort_array(F.collect_set("event_type")).alias("event_types"),
    )


@dataclass(frozen=True)
class DimensionProfile:
    rows: int
    bytes: int
    duplicate_keys: int

    def broadcastable(self, limit: int = DEFAULT_BROADCAST_LIMIT) -> bool:
        return self.bytes <= limit


def dimension_profile(dim: DataFrame, key: str = "user_id",
                      cols: Sequence[str] = ("user_id", "user_segment"),
                      check_unique: bool = True) -> DimensionProfile:
    """One job over the pruned dimension: rows, bytes, duplicated keys.

    The byte figure is an upper bound of the broadcast hash relation: for each
    row its header and fixed fields, the strings padded to words, the key row
    kept beside it, and two slots of the pointer array at half load. It is what
    licenses the broadcast in ``enrich_orders``. A lookup that is unique by
    construction (a group-by output) skips the key shuffle.
    """
    text = sum(F.coalesce(F.octet_length(F.col(c).cast("string")), F.lit(0)) + F.lit(8) for c in cols)
    per_row = 2 * text + F.lit(2 * (16 + 16 * len(cols)) + 64)
    if not check_unique:
        r = dim.agg(F.count(F.lit(1)).alias("rows"), F.sum(per_row).alias("bytes")).first()
        return DimensionProfile(int(r["rows"] or 0), int(r["bytes"] or 0), 0)
    r = (dim.groupBy(key)
            .agg(F.count(F.lit(1)).alias("n"), F.sum(per_row).alias("b"))
            .agg(F.sum("n").alias("rows"), F.sum("b").alias("bytes"),
                 F.count_if(F.col("n") > 1).alias("dups"))
            .first())
    return DimensionProfile(int(r["rows"] or 0), int(r["bytes"] or 0), int(r["dups"] or 0))


def broadcast_licence(profiles: Sequence[DimensionProfile], limit: int = DEFAULT_BROADCAST_LIMIT) -> list[bool]:
    """Which lookups of one join chain may be broadcast: in the given order,
    as long as their bytes add up to at most ``limit``."""
    used, out = 0, []
    for p in profiles:
        fits = used + p.bytes <= limit
        used += p.bytes if fits else 0
        out.append(fits)
    return out


EVENTS_AGG_COLS = ("user_id", "event_count", "event_types")


def enrich_orders(orders: DataFrame, events_agg: DataFrame, segments: DataFrame | None,
                  key: str = "user_id", broadcast_segments: bool = False,
                  broadcast_events: bool = False, hot: DataFrame | None = None,
                  events_on: Sequence[str] = ("user_id",)) -> DataFrame:
    """J1 + J2: orders ⟕ events summary ⟕ segment dimension.

    Each lookup is broadcast only when the caller has checked its size
    (``dimension_profile``); otherwise it is a shuffle join in which the rows
    of the ``hot`` keys (``joins.hot_keys``) are dealt over all partitions.
    ``events_on`` is (batch date, user) in a range run. NULL user ids never
    match. ``segments`` None: the orders have their segment already.
    """
    lookups = [(events_agg, broadcast_events, list(events_on))]
    if segments is not None:
        lookups.append((canonical_alias(segments, "user_segment").select(key, "user_segment"), broadcast_segments))
    return left_lookup_joins(orders, lookups, key, hot)


def naive_enrich(orders: DataFrame, events: DataFrame, segments: DataFrame,
                 key: str = "user_id") -> DataFrame:
    """The rejected alternative: join raw events, one row per event.

    Kept only so the row-explosion gate can be exercised on real data."""
    segments = canonical_alias(segments, "user_segment").select(key, "user_segment")
    return (orders.join(events.select(key, "event_id", "event_type"), on=key, how="left")
                  .join(segments, on=key, how="left"))


def apply_business_rules(df: DataFrame, segment_default: str = UNCLASSIFIED_SEGMENT) -> DataFrame:
    """Drop amounts that are not a finite number above 0 within the money
    type (text, NaN and infinity included, none raises: H18); default event
    count and segment."""
    return (df.where(amount_ok("amount"))
              .withColumn("event_count", F.coalesce(F.col("event_count"), F.lit(0)))
              .withColumn("user_segment", F.coalesce(F.col("user_segment"), F.lit(segment_default))))


def cast_and_select(df: DataFrame, approved: Sequence[str] = APPROVED_OUTPUT_COLUMNS,
                    types: dict[str, T.DataType] | None = None, strict: bool = False) -> DataFrame:
    """Canonical types and the approved-column firewall.

    Extra columns are dropped; an approved column that is absent is skipped
    (reference behaviour) or, with ``strict=True``, raises (H5).
    """
    types = {**PROCESSED_TYPES, **(types or {})}
    missing = [c for c in approved if c not in df.columns]
    if strict and missing:
        raise ValueError(f"approved columns missing from output: {missing}")
    out = []
    for c in approved:
        if c not in df.columns:
            continue
        t = types.get(c)
        if c == "amount":
            out.append(finite_amount(c).alias(c))
            continue
        out.append(safe_cast(c, t).alias(c) if t is not None and not isinstance(t, T.ArrayType)
                   else F.col(c))
    return df.select(*out)


def staged_summary(events: DataFrame, key: str | Sequence[str] = "user_id",
                   dedup_events: bool = False, path: str | None = None) -> DataFrame:
    """The events summary, written once: its profile and its join read the
    same rows, and the events are scanned once."""
    agg = aggregate_events(events, key, dedup_events)
    path = path or scratch_dir(events.sparkSession, "events-summary")
    agg.write.parquet(path)
    return events.sparkSession.read.schema(agg.schema).parquet(path)


def enrich_daily(orders: DataFrame, events: DataFrame, segments: DataFrame,
                 tie_breakers: Sequence[str] = DEFAULT_TIE_BREAKERS, dedup_events: bool = False,
                 broadcast_segments: bool | None = None, broadcast_events: bool | None = None,
                 broadcast_limit: int = DEFAULT_BROADCAST_LIMIT,
                 approved: Sequence[str] = APPROVED_OUTPUT_COLUMNS,
                 skew_split: bool = True, **hot_opts) -> tuple[DataFrame, DataFrame]:
    """Slice 1 of the build plan: W1 → A1/A2 → J1/J2 → P3–P7.

    A broadcast decision left as None is made here from a profile job of
    that lookup (both together must be under ``broadcast_limit``). Returns
    ``(deduped_orders, enriched)``; the first is the row gate's baseline.
    """
    deduped = latest_per_key(orders, ["order_id"], ["process_date desc"], tie_breakers)
    agg = staged_summary(events, dedup_events=dedup_events)
    prof = dimension_profile(canonical_alias(segments, "user_segment"))
    if prof.duplicate_keys:
        # Q16: a lookup must be unique per key (no fan-out, bounded broadcasts)
        from .gates import GateError
        raise GateError(f"segment dimension has {prof.duplicate_keys} duplicated user_id keys")
    may = broadcast_licence([prof, dimension_profile(agg, cols=EVENTS_AGG_COLS, check_unique=False)],
                            broadcast_limit)
    broadcast_segments = may[0] if broadcast_segments is None else broadcast_segments
    broadcast_events = may[1] if broadcast_events is None else broadcast_events
    hot = None
    if skew_split and not (broadcast_segments and broadcast_events):
        hot = hot_keys(orders, "user_id", **hot_opts)
    enriched = enrich_orders(deduped, agg, segments, broadcast_segments=broadcast_segments,
                             broadcast_events=broadcast_events, hot=hot)
    return deduped, cast_and_select(apply_business_rules(enriched), approved)
