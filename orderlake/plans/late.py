"""Late rows of all runs into the processed and gold days they belong to."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from datetime import date, datetime

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from ..operators import enrichment as E
from ..operators.gold import MergeResult, gold_model, merge_upsert
from ..sinks import parquet as sink
from ..sources.files import read_processed


@dataclass
class LateMerge:
    processed: MergeResult
    gold: MergeResult | None


def merge_late(spark: SparkSession, late_root: str, processed_root: str, gold_root: str | None = None,
               run_ts: datetime | str | None = None, runs: Sequence[str | date] | None = None,
               rejects: str | None = None) -> LateMerge | None:
    """Upserts late rows by (process_date, order_id); of several runs' rows for
    one key the newest run's wins. Rows dated after their run wait in the late
    table until their own date runs and takes them in. Rows without a date go
    to ``rejects`` and are counted. Merging again changes nothing. ``runs``
    limits the merge to these runs' folders; None if there are none."""
    if not sink.partition_values(spark, late_root, "late_run"):
        return None
    late = read_processed(spark, late_root)
    if runs is not None:
        late = late.where(F.col("late_run").isin([str(r) for r in runs]))
    due = late.where(F.col("process_date").isNull() | (F.col("process_date") < F.col("late_run")))
    newest = E.latest_per_key(due, ["process_date", "order_id"], ["late_run desc"],
                              E.DEFAULT_TIE_BREAKERS).drop("late_run")
    done = merge_upsert(spark, processed_root, newest, run_ts=run_ts, rejects=rejects)
    gold = None
    if gold_root is not None:
        gold = merge_upsert(spark, gold_root, gold_model(newest, run_ts), run_ts=run_ts)
    return LateMerge(done, gold)
