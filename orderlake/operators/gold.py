"""Gold projections (P12–P19) and the key-based merge."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.columns import amount_fault, amount_ok, event_list
from ..schemas import ACCEPTED_CURRENCIES, UNCLASSIFIED_SEGMENT
from ..session import scratch_dir
from ..sinks import parquet as sink
from ..sinks.layout import Layout
from ..sinks.table_schema import check_schema
from ..sources.files import read_partitions
from .gates import GateError
from .key_index import KeyIndex, of_table
from .rollups import USED, Rollup, deltas


def quality_filter(df: DataFrame, accepted: Sequence[str] = ACCEPTED_CURRENCIES) -> DataFrame:
    """Keys present, a good amount above 0, currency accepted (checked
    before the upper-casing, so lower-case codes are rejected: H15)."""
    return df.where(_passes(accepted))


def _passes(accepted: Sequence[str]):
    return (F.col("order_id").isNotNull() & F.col("user_id").isNotNull() & amount_ok("amount")
            & F.coalesce(F.col("currency").isin(list(accepted)), F.lit(False)))


def quality_rejects(df: DataFrame, accepted: Sequence[str] = ACCEPTED_CURRENCIES) -> DataFrame:
    """The exact complement of ``quality_filter``, with the first reason."""
    reason = (F.when(F.col("order_id").isNull(), F.lit("null order_id"))
               .when(F.col("user_id").isNull(), F.lit("null user_id"))
               .otherwise(F.coalesce(amount_fault("amount"), F.lit("currency not accepted"))))
    return df.where(~_passes(accepted)).withColumn("reject_reason", reason)


def gold_model(staged: DataFrame, run_ts: datetime | str, run_date: date | str | None = None,
               accepted: Sequence[str] = ACCEPTED_CURRENCIES) -> DataFrame:
    """Model preset: P12 filter → P13 round → P14 upper → P15 defaults →
    P17 ``updated_at``. ``run_date`` (P16) overrides process_date when given.
    Extra (approved) staging columns pass through after the fixed ones."""
    fixed = ["order_id", "user_id", "amount", "currency", "process_date",
             "user_segment", "event_count", "event_types"]
    q = quality_filter(staged, accepted)
    pd_col = F.lit(str(run_date)).cast("date") if run_date is not None else F.col("process_date")
    extra = [c for c in staged.columns if c not in fixed]
    return q.select(
        "order_id", "user_id",
        F.round("amount", 2).alias("amount"),
        F.upper("currency").alias("currency"),
        pd_col.alias("process_date"),
        F.coalesce("user_segment", F.lit(UNCLASSIFIED_SEGMENT)).alias("user_segment"),
        F.coalesce("event_count", F.lit(0)).cast("int").alias("event_count"),
        "event_types",
        *extra,
        F.lit(str(run_ts)).cast("timestamp").alias("updated_at"),
    )


def script_projection(staged: DataFrame, run_date: date | str | None = None) -> DataFrame:
    """Script preset source: P16 date literal, P18 event types as a comma
    string, no quality filter."""
    pd_col = F.lit(str(run_date)).cast("date") if run_date is not None else F.col("process_date")
    return staged.select("order_id", "user_id", "amount", "currency", pd_col.alias("process_date"),
                         "user_segment", "event_count",
                         event_list("event_types").alias("event_types"))


@dataclass(frozen=True)
class MergePreset:
    """Which columns a matched row takes from the source, and the audit columns."""
    name: str
    keep_on_update: tuple[str, ...] = ()   # target keeps these on match
    inserted_at: bool = False              # maintain inserted_at (kept from target)
    stamp_updated_at: bool = False         # set updated_at = run_ts on every touched row


MODEL = MergePreset("model")
SCRIPT = MergePreset("script", keep_on_update=("user_id",), inserted_at=True, stamp_updated_at=True)


@dataclass(frozen=True)
class MergeResult:
    touched_partitions: int
    source_rows: int
    rejected_null_keys: int
    inserted: int = 0
    updated: int = 0


def merge_upsert(spark: SparkSession, target: str, source: DataFrame,
                 keys: Sequence[str] = ("process_date", "order_id"),
                 partition_col: str = "process_date",
                 preset: MergePreset = MODEL, run_ts: datetime | str | None = None,
                 cluster_by: Sequence[str] | None = ("user_segment", "user_id"),
                 check=None, rejects: str | None = None, rollup: Rollup | None = None,
                 index: KeyIndex | None = None, layout: Layout | None = None) -> MergeResult:
    """Upsert ``source`` into the partitioned Parquet ``target``.

    1. The source is written once. Rows with a NULL key are not merged (H24):
       they are appended to the ``rejects`` table when one is named, and
       counted always. Duplicate source keys fail the merge.
    2. A column whose type differs from the target's fails the merge before
       anything is published.
    3. Only target partitions that the source touches are read (partition
       filter on the scan), never the whole table.
    4. Full outer join on the keys; a presence flag picks source values for
       matched and new rows, target values for untouched rows.
    5. Columns are aligned by name: a column new in the source is added and
       is NULL in older rows (append_new_columns).
    6. The merged partitions are staged (lineage cut: the target is read and
       rewritten); ``check(staged_frame)`` runs on them (data tests, contract)
       and may raise, so nothing failing is published; then they are
       published with dynamic overwrite, and the stages are deleted.
    7. ``rollup`` takes the signed sums of the old and new rows that changed,
       ``index`` (or the one kept with the table) the keys of the touched days. ``layout`` places the rows
       along its curve instead of by ``cluster_by``.
    """
    keys = list(keys)
    index = index or of_table(spark, target)
    run_ts = str(run_ts) if run_ts is not None else None
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    stage_src, stage_out = scratch_dir(spark, "merge-src"), scratch_dir(spark, "merge-out")
    try:
        sink.write_stage(source, stage_src)
        staged = spark.read.schema(source.schema).parquet(stage_src)
        stats = (staged.groupBy(*keys).count().withColumn("_null", null_key)
                 .agg(F.sum(F.when(~F.col("_null"), F.col("count"))).alias("rows"),
                      F.sum(F.when(F.col("_null"), F.col("count"))).alias("rejected"),
                      F.count_if(~F.col("_null") & (F.col("count") > 1)).alias("dups"),
                      F.collect_set(F.when(~F.col("_null"), F.col(partition_col))).alias("touched")).first())
        rows, rejected = int(stats["rows"] or 0), int(stats["rejected"] or 0)
        touched = sorted(stats["touched"])
        if rejected and rejects is not None:
            (staged.where(null_key).withColumn("reject_reason", F.lit("null merge key"))
                .write.mode("append").parquet(rejects))
        if stats["dups"]:
            raise GateError(f"merge source has {stats['dups']} duplicated keys {keys}")
        if rows == 0:
            return MergeResult(0, 0, rejected)
        src = staged.where(~null_key)
        if preset.stamp_updated_at and run_ts is not None:
            src = src.withColumn("updated_at", F.lit(run_ts).cast("timestamp"))
        if preset.inserted_at and run_ts is not None:
            src = src.withColumn("inserted_at", F.lit(run_ts).cast("timestamp"))
        check_schema(spark, target, src.schema)
        # only the touched day folders are listed and read
        tgt = (read_partitions(spark, target, partition_col, touched, none_if_missing=True)
               if sink.path_exists(spark, target) else None)
        if tgt is None:
            # nothing to match: the staged source is published as it is
            if check is not None:
                check(src)
            if rollup is not None:
                rollup.begin(spark, target, touched)
            kept = index.begin(spark, touched) if index is not None else None
            sink.publish_partitions(spark, src, target, partition_col, cluster_by, layout=layout)
            if index is not None:
                index.finish(spark, target, touched, kept)
            if rollup is not None:
                rollup.apply(spark, deltas(src.withColumns({"_in_src": F.lit(True), "_old": F.lit(None).cast(
                    "struct<user_segment:string,amount:double,event_count:int>")})), touched)
            return MergeResult(len(touched), rows, rejected, inserted=rows)
        merged = _merged(src, tgt, keys, preset, rollup is not None)
        sink.write_stage(merged, stage_out)
        staged = spark.read.schema(merged.schema).parquet(stage_out)
        out = staged.drop("_matched", "_in_src", "_old")
        if check is not None:
            check(out)
        updated = staged.where("_matched").count()
        if rollup is not None:
            rollup.begin(spark, target, touched)
        kept = index.begin(spark, touched) if index is not None else None
        sink.publish_partitions(spark, out, target, partition_col, cluster_by, layout=layout)
        if index is not None:
            index.finish(spark, target, touched, kept)
        if rollup is not None:
            rollup.apply(spark, deltas(staged), touched)
        return MergeResult(len(touched), rows, rejected, inserted=rows - updated, updated=updated)
    finally:
        for path in (stage_src, stage_out):
            sink.delete_path(spark, path)


def _merged(src: DataFrame, tgt: DataFrame, keys: list[str], preset: MergePreset, with_old: bool = False) -> DataFrame:
    """The outer join of step 4 and 5, with a ``_matched`` flag; ``with_old``
    adds what a rollup needs of a replaced row."""
    j = src.withColumn("_in_src", F.lit(True)).alias("s").join(
        tgt.withColumn("_in_tgt", F.lit(True)).alias("t"), on=keys, how="full_outer")
    from_src = F.col("_in_src").isNotNull()
    matched = from_src & F.col("_in_tgt").isNotNull()
    cols = []
    for c in dict.fromkeys([*tgt.columns, *src.columns]):
        sc, tc = F.col(f"s.{c}"), F.col(f"t.{c}")
        if c in keys:
            cols.append(F.col(c))
        elif c not in src.columns:
            cols.append(tc.alias(c))
        elif c not in tgt.columns:
            cols.append(F.when(from_src, sc).alias(c))
        elif c in preset.keep_on_update or (c == "inserted_at" and preset.inserted_at):
            cols.append(F.when(matched, tc).when(from_src, sc).otherwise(tc).alias(c))
        else:
            cols.append(F.when(from_src, sc).otherwise(tc).alias(c))
    if with_old:
        cols += [F.coalesce(from_src, F.lit(False)).alias("_in_src"),
                 F.when(matched, F.struct(*(F.col(f"t.{c}").alias(c) for c in USED))).alias("_old")]
    return j.select(*cols, matched.alias("_matched"))
