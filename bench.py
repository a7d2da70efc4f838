"""Headline timings at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

Queries (each timed on its own, in pipeline order):
  enrich_publish      B2 range run: read feeds, dedup, event summary, joins,
                      rules, one staged write with Q1 observations, gate,
                      clustered publish into day partitions
  gold_build          gold model, first merge of every day into the gold table,
                      data tests and contract on the staged rows
  daily_revenue_day   A7/O1 on gold for one day (partition-pruned read)
  gold_merge_one_day  merge of one day's corrections: only that partition is
                      read and rewritten
  data_tests          Q8–Q11 on the gold table
  history_convert     legacy CSV (written beforehand, untimed) → clean/rejects
  reconciliation      Q2 audit of CSV source vs converted target
  landing_gate        listing + chunked MD5 + footer contract check
  enriched_query      the enrichment result to a noop sink (every column computed)
"""

from __future__ import annotations

import json
import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))

from pyspark.sql import functions as F  # noqa: E402

from orderlake.operators import gates as G  # noqa: E402
from orderlake.operators import gold as GD  # noqa: E402
from orderlake.operators import history as H  # noqa: E402
from orderlake.operators import marts as M  # noqa: E402
from orderlake.plans import catalog as C  # noqa: E402
from orderlake.plans.daily import run_enrichment  # noqa: E402
from orderlake.plans.history import export_history_csv, run_history  # noqa: E402
from orderlake.plans.landing import build_landing_zone, run_landing  # noqa: E402
from orderlake.plans.warehouse import gold_checks  # noqa: E402
from orderlake.session import build_session, scratch_dir  # noqa: E402
from orderlake.sources import feeds  # noqa: E402
from orderlake.sources.files import read_history_csv, read_processed  # noqa: E402

RUN_TS = "2026-01-01 00:00:00"


def main() -> None:
    sf_dir = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1").rstrip("/")
    cpus = int(os.environ.get("BENCH_CPUS", "8"))
    sf = sf_dir.rsplit("sf", 1)[-1]
    # BENCH_EVENT_LOG=<dir>: write Spark's event log there (stage/task times)
    spark = build_session(master=f"local[{cpus}]", shuffle_partitions=max(cpus, 8),
                          app_name="orderlake-bench",
                          event_log_dir=os.environ.get("BENCH_EVENT_LOG") or None)
    root = scratch_dir(spark, "bench")
    times: dict[str, float] = {}

    def timed(name, fn):
        t0 = time.perf_counter()
        out = fn()
        times[name] = round(time.perf_counter() - t0, 3)
        return out

    # warm-up: JVM, codegen and file listing caches (untimed)
    feeds.orders_feed(spark, sf_dir).agg(F.count(F.lit(1))).collect()

    processed, gold = f"{root}/processed", f"{root}/gold"
    timed("enrich_publish", lambda: run_enrichment(
        spark, feeds.orders_feed(spark, sf_dir), feeds.events_feed(spark, sf_dir),
        feeds.segments_feed(spark, sf_dir), processed))
    timed("gold_build", lambda: GD.merge_upsert(
        spark, gold, GD.gold_model(read_processed(spark, processed), RUN_TS), run_ts=RUN_TS,
        check=gold_checks))

    busiest = (read_processed(spark, gold).groupBy("process_date").count()
               .orderBy(F.desc("count"), "process_date").first()["process_date"])
    timed("daily_revenue_day", lambda: M.revenue_by_segment(
        M.guarded_read(spark, gold, busiest, busiest)).collect())

    def merge_day():
        day = M.guarded_read(spark, processed, busiest, busiest)
        corrected = day.withColumn("amount", F.col("amount") + F.lit(1.0))
        return GD.merge_upsert(spark, gold, GD.gold_model(corrected, RUN_TS), run_ts=RUN_TS)
    timed("gold_merge_one_day", merge_day)

    timed("data_tests", lambda: G.data_tests(
        M.guarded_read(spark, gold, *M.table_days(spark, gold))).collect())

    csv, clean, rejects = f"{root}/csv", f"{root}/clean", f"{root}/rejects"
    export_history_csv(feeds.history_rows(spark, sf_dir), csv)
    timed("history_convert", lambda: run_history(spark, csv, clean, rejects))
    timed("reconciliation", lambda: H.reconciliation_report(
        read_history_csv(spark, csv), read_processed(spark, clean), "all").collect())

    raw = build_landing_zone(spark, sf_dir, f"{root}/raw")
    timed("landing_gate", lambda: run_landing(spark, raw, f"{root}/registry", RUN_TS))

    timed("enriched_query", lambda: C.enriched_frame(spark, sf_dir).write.format("noop").mode("overwrite").save())

    total = round(sum(times.values()), 3)
    print(json.dumps({"metric": "headline_total", "value": total, "unit": "sec",
                      "queries": times, "sf": float(sf) if sf.replace(".", "").isdigit() else sf,
                      "cpus": cpus}))
    spark.stop()


if __name__ == "__main__":
    main()
