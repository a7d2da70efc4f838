"""Landing runs (T1 batch form) and a landing zone built from the driver
tables: daily drops of the three feeds plus the faulty drops the gate must
catch (missing column, byte copy, unknown folder, unreadable footer)."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators import landing as LG
from ..session import scratch_dir
from ..sources import feeds


@dataclass
class LandingRun:
    decisions: DataFrame
    inputs: dict[str, int]
    status: str          # READY | SKIPPED


def run_landing(spark: SparkSession, raw_root: str, registry_path: str,
                run_ts: datetime | str | None = None, check_types: bool = False,
                listing: DataFrame | None = None, needed=("orders", "events", "user_segments"),
                run_date=None) -> LandingRun:
    """List → drop known files → inspect → decide → append to the registry
    (single writer) → Q14 over its manifest. Repeating a run reads no known
    bytes and changes neither the registry nor the answer."""
    listing = listing if listing is not None else LG.list_files(spark, raw_root)
    versions = LG.read_versions(spark, registry_path)
    decisions = LG.landing_decisions(spark, listing, raw_root, versions, run_ts, check_types=check_types,
                                     known=None if versions is None else LG.known_files(versions))
    # Decisions are written once (lineage cut: hashing is not repeated).
    out = scratch_dir(spark, "landing-decisions")
    decisions.write.mode("overwrite").parquet(out)
    staged = spark.read.schema(decisions.schema).parquet(out)
    LG.update_registry(spark, registry_path, staged)
    counts = LG.inputs_present(LG.read_versions(spark, registry_path), needed, run_date)
    status = "READY" if all(counts.values()) else "SKIPPED"
    return LandingRun(staged, counts, status)


def _jvm_write_bytes(spark: SparkSession, path: str, data: bytes) -> None:
    jvm = spark.sparkContext._jvm
    p = jvm.org.apache.hadoop.fs.Path(path)
    fs = p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    out = fs.create(p, True)
    out.write(bytearray(data))
    out.close()


def _jvm_copy_first(spark: SparkSession, src_dir: str, dst_dir: str) -> None:
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    src = jvm.org.apache.hadoop.fs.Path(src_dir)
    fs = src.getFileSystem(conf)
    parts = sorted(str(s.getPath().toString()) for s in fs.listStatus(src)
                   if s.getPath().getName().endswith(".parquet"))
    jvm.org.apache.hadoop.fs.FileUtil.copy(fs, jvm.org.apache.hadoop.fs.Path(parts[0]), fs,
                                           jvm.org.apache.hadoop.fs.Path(dst_dir + "/copy.parquet"),
                                           False, conf)


def build_landing_zone(spark: SparkSession, sf_dir: str, raw_root: str) -> str:
    """Write the feeds in their contract layout below ``raw_root``: one file
    per folder, one folder per feed and month or segment, and the faulty drops."""
    raw_root = raw_root.rstrip("/")

    def drop(df: DataFrame, sub: str, by: str) -> None:
        # one task and so one file per folder; folders grow with the data
        df.repartition(by).sortWithinPartitions(*df.columns).write.mode("overwrite").partitionBy(by).parquet(
            f"{raw_root}/{sub}")

    orders = feeds.orders_feed(spark, sf_dir).withColumns({
        "channel": F.lit("web"), "status": F.lit("placed"),              # optional + extra columns
        "month": F.date_format("process_date", "yyyy-MM")})
    drop(orders, "orders/daily", "month")
    drop(orders.drop("amount"), "orders/no_amount", "month")              # quarantined
    ev = feeds.events_feed(spark, sf_dir)
    ev = ev.select("event_id", "user_id", F.col("event_type").alias("action_type"),  # renamed column: accepted
                   F.date_format("event_ts", "yyyy-MM-dd'T'HH:mm:ss").alias("timestamp"),
                   F.pmod(F.col("user_id").cast("long"), F.lit(7)).alias("part"))
    drop(ev, "events/daily", "part")
    seg = feeds.segments_feed(spark, sf_dir)
    drop(seg.select("user_id", "segment", F.lit("2025-06-01").cast("date").alias("segment_date"),
                    F.col("segment").alias("part")), "segments/weekly", "part")
    drop(feeds.table(spark, sf_dir, "nation").withColumn("part", F.lit(0)), "misc/reference", "part")  # unknown type
    first = orders.agg(F.min("month")).first()[0]
    first = f"{raw_root}/orders/daily/month={first}"
    _jvm_copy_first(spark, first, f"{raw_root}/orders/resent")            # same bytes: duplicate
    _jvm_copy_first(spark, first, f"{raw_root}/events/a_misplaced")       # same bytes, wrong contract
    _jvm_write_bytes(spark, f"{raw_root}/events/corrupt/corrupt.parquet", b"not a parquet file")
    _jvm_write_bytes(spark, f"{raw_root}/orders/notes/readme.txt", b"ignored: not parquet")
    return raw_root


def redrop_in_place(spark: SparkSession, staged: str, folder: str) -> int:
    """Moves each file of ``staged`` (one in a folder) onto the file of the same
    folder below ``folder``: new bytes under an old path. Renames only."""
    jvm, conf = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
    path = jvm.org.apache.hadoop.fs.Path

    def files(root: str) -> dict:
        fs = path(root).getFileSystem(conf)
        found = {}
        for d in fs.listStatus(path(root)):
            if d.isDirectory():
                found[d.getPath().getName()] = [f.getPath() for f in fs.listStatus(d.getPath())
                                                if f.getPath().getName().endswith(".parquet")]
        return found
    old = files(folder)
    for name, new in files(staged).items():
        fs = new[0].getFileSystem(conf)
        fs.delete(old[name][0], False)
        fs.rename(new[0], old[name][0])
    return len(old)
