"""Command-line jobs, one per pipeline step.

    python -m orderlake landing   --raw R --registry G [--date D] [--run-ts T]
    python -m orderlake daily     --date D [--end E] --validated V --processed P [--registry G] [--late L]
    python -m orderlake late      --late L --processed P [--gold G]
    python -m orderlake warehouse --date D --processed P --staging S --gold G [--preset script]
                                  [--step load|merge|all] [--unique-scope touched] [--key-index]
    python -m orderlake history   --csv C --out O [--rejects R] [--start A --end B]
    python -m orderlake audit     --csv C --target O --date D [--reports R]

The run date is checked before Spark starts (Q15). A failing gate, a
mismatching audit or an invalid date exits with status 1; a run with no
input exits 0 with status SKIPPED (Q14).
"""

from __future__ import annotations

import argparse
import json
import sys
from datetime import datetime, timezone


def _ts(value: str | None) -> str:
    return value or datetime.now(timezone.utc).strftime("%Y-%m-%d %H:%M:%S")


def main(argv: list[str] | None = None) -> int:
    ap = argparse.ArgumentParser(prog="orderlake")
    sub = ap.add_subparsers(dest="cmd", required=True)
    p = sub.add_parser("landing")
    p.add_argument("--raw", required=True)
    p.add_argument("--registry", required=True)
    p.add_argument("--run-ts")
    p.add_argument("--date")
    p.add_argument("--check-types", action="store_true")
    p = sub.add_parser("daily")
    p.add_argument("--date", required=True)
    p.add_argument("--validated", required=True)
    p.add_argument("--processed", required=True)
    p.add_argument("--end")
    p.add_argument("--registry")
    p.add_argument("--late")
    p = sub.add_parser("late")
    p.add_argument("--late", required=True)
    p.add_argument("--processed", required=True)
    p.add_argument("--gold")
    p.add_argument("--rejects")
    p.add_argument("--run-ts")
    p = sub.add_parser("warehouse")
    p.add_argument("--date", required=True)
    p.add_argument("--processed", required=True)
    p.add_argument("--staging", required=True)
    p.add_argument("--gold", required=True)
    p.add_argument("--preset", choices=["model", "script"], default="model")
    p.add_argument("--step", choices=["load", "merge", "all"], default="all")
    p.add_argument("--unique-scope", choices=["table", "touched"], default="table")
    p.add_argument("--key-index", action="store_true", help="keep Bloom filters of the days' orders with the gold table")
    p.add_argument("--rejects")
    p.add_argument("--run-ts")
    p = sub.add_parser("history")
    p.add_argument("--csv", required=True)
    p.add_argument("--out", required=True)
    p.add_argument("--rejects")
    p.add_argument("--start")
    p.add_argument("--end")
    p = sub.add_parser("audit")
    p.add_argument("--csv", required=True)
    p.add_argument("--target", required=True)
    p.add_argument("--date", required=True, help="audited date or month label")
    p.add_argument("--reports")
    args = ap.parse_args(argv)

    from .plans.daily import parse_run_date
    if args.cmd in ("daily", "warehouse") or (args.cmd == "landing" and args.date):
        try:
            parse_run_date(args.date)
            if getattr(args, "end", None):
                parse_run_date(args.end)
        except ValueError as exc:
            print(str(exc), file=sys.stderr)
            return 1

    from pyspark.sql import SparkSession

    from .operators.gates import GateError
    from .sinks.table_schema import SchemaConflict
    spark = SparkSession.builder.appName(f"orderlake-{args.cmd}").getOrCreate()
    try:
        if args.cmd == "landing":
            from .plans.landing import run_landing
            run = run_landing(spark, args.raw, args.registry, _ts(args.run_ts),
                              check_types=args.check_types, run_date=args.date)
            out = {"status": run.status, "inputs": run.inputs}
        elif args.cmd == "daily":
            from .plans.daily import date_range, run_range
            r = run_range(spark, args.validated, args.processed, date_range(args.date, args.end or args.date),
                          registry=args.registry, late_root=args.late)
            out = {"status": r.status, "rows_in": r.rows_in, "rows_out": r.rows_out,
                   "late_rows": r.late_rows, "broadcast_segments": r.broadcast_segments,
                   "broadcast_events": r.broadcast_events}
        elif args.cmd == "late":
            from .plans.late import merge_late
            m = merge_late(spark, args.late, args.processed, args.gold, _ts(args.run_ts), rejects=args.rejects)
            out = {"status": "MERGED" if m else "SKIPPED",
                   **{f"{k}_{f}": getattr(x, f) for k, x in (("processed", m and m.processed), ("gold", m and m.gold))
                      if x for f in ("inserted", "updated", "rejected_null_keys")}}
        elif args.cmd == "warehouse":
            from .operators.gold import MODEL, SCRIPT
            from .operators.key_index import of_table
            from .plans.warehouse import run_warehouse
            w = run_warehouse(spark, args.processed, args.staging, args.gold, args.date,
                              _ts(args.run_ts), SCRIPT if args.preset == "script" else MODEL,
                              step=args.step, unique_scope=args.unique_scope, rejects_root=args.rejects,
                              index=of_table(spark, args.gold, create=args.key_index))
            out = {"status": w.status, "staged_rows": w.staged_rows, "rejected_rows": w.rejected,
                   **({f: getattr(w.merge, f) for f in ("touched_partitions", "inserted", "updated",
                                                        "rejected_null_keys")} if w.merge else {})}
        elif args.cmd == "history":
            from .plans.history import run_history
            run_history(spark, args.csv, args.out, args.rejects, args.start, args.end)
            out = {"status": "SUCCESS"}
        else:
            from .plans.history import audit
            row = audit(spark, args.csv, args.target, args.date, report_root=args.reports,
                        audited_at=_ts(None)).first().asDict()
            out = {k: (str(v) if not isinstance(v, (int, float, str, type(None))) else v)
                   for k, v in row.items()}
            if row["status"] == "MISMATCH":
                print(json.dumps(out))
                return 1
        print(json.dumps(out))
        return 0
    except (GateError, SchemaConflict) as exc:
        print(json.dumps({"status": "FAILED", "reason": str(exc)}))
        return 1
    finally:
        spark.stop()


if __name__ == "__main__":
    sys.exit(main())
