"""History migration (S4, P8–P11, K2, S9/B2 ranges) and the audit (Q2, K8)."""

from __future__ import annotations

import logging
from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import history as H
from ..operators.gates import GateError
from ..session import scratch_dir
from ..sinks import parquet as sink
from ..sources.files import read_history_csv, read_history_range, read_processed

LOG = logging.getLogger(__name__)


def export_history_csv(rows: DataFrame, root: str) -> None:
    """Write legacy all-string rows as header CSV in ``date=`` folders."""
    (sink.spread_by_range(rows, "date").write.mode("overwrite").option("header", "true")
         .partitionBy("date").csv(root))


@dataclass
class HistoryResult:
    clean_path: str
    rejects_path: str | None


def run_history(spark: SparkSession, csv_root: str, out_root: str,
                rejects_root: str | None = None, start: str | None = None,
                end: str | None = None, reject_bad_dates: bool = True) -> HistoryResult:
    """Convert legacy CSV to date-partitioned Parquet; a ``start``/``end``
    range (B2) reads only those ``date=`` folders and replaces only the
    partitions it produces. Rejects go to their own table (H9)."""
    raw = (read_history_range(spark, csv_root, start, end) if start and end
           else read_history_csv(spark, csv_root))
    # Parse and cast the CSV once (lineage cut); both outputs and their
    # range samples read the staged Parquet instead of re-parsing text.
    stage = scratch_dir(spark, "history-stage")
    norm = H.normalize_history(raw)
    sink.write_stage(norm, stage)
    norm = spark.read.schema(norm.schema).parquet(stage)
    clean, rejects = H.split_history(norm, reject_bad_dates)
    if rejects_root is not None:
        # rejects are few: one folder per month of the export, not per day
        sink.write_partitioned(rejects.withColumn("reject_month", F.date_format("date", "yyyy-MM")),
                               rejects_root, "reject_month", cluster_by=["date"])
    # the export folder's date stays with each row: a range audit compares by it
    sink.write_partitioned(clean.withColumnRenamed("date", "export_date"), out_root, "process_date", cluster_by=None)
    sink.delete_path(spark, stage)
    return HistoryResult(out_root, rejects_root)


def audit(spark: SparkSession, csv_source: str, target_root: str, execution_date: str,
          report_root: str | None = None, audited_at: datetime | str | None = None,
          deduplicated: int = 0, start: str | None = None, end: str | None = None,
          raise_on_mismatch: bool = False) -> DataFrame:
    """Q2/K8: reconcile a CSV source with its processed target. The report
    is one row, upserted by ``execution_date`` (dynamic overwrite of that
    partition); a report write failure is tolerated, a mismatch raises only
    when asked (the caller decides the exit code)."""
    src = (read_history_range(spark, csv_source, start, end) if start and end
           else read_history_csv(spark, csv_source))
    tgt = read_processed(spark, target_root)
    if start and end:
        # both sides by the export date: a row's own date may differ from it
        day = "export_date" if "export_date" in tgt.columns else "process_date"
        tgt = tgt.where(F.col(day).between(F.lit(start).cast("date"), F.lit(end).cast("date")))
    report = H.reconciliation_report(src, tgt, execution_date, audited_at, deduplicated)
    row = report.first()
    if report_root is not None:
        try:
            doc = spark.createDataFrame([row.asDict()], report.schema).withColumn(
                "doc_id", F.lit(H.report_doc_id(execution_date)))
            (doc.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
                .partitionBy("doc_id").parquet(report_root))
        except Exception:  # noqa: BLE001 - report store failures are tolerated (K8)
            LOG.warning("audit report for %s was not stored", execution_date, exc_info=True)
    if raise_on_mismatch and row["status"] == "MISMATCH":
        raise GateError(row["message"])
    return spark.createDataFrame([row.asDict()], report.schema)
