"""Command-line jobs: exit codes of the date check and the audit."""

import json
import os
import subprocess
import sys
import tempfile

ROOT = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))


def _run(*args):
    env = dict(os.environ, PYTHONPATH=ROOT)
    return subprocess.run([sys.executable, "-m", "orderlake", *args], capture_output=True,
                          text=True, env=env, cwd=ROOT, timeout=300)


def test_invalid_date_exits_1_before_spark():
    r = _run("daily", "--date", "06/01/2025", "--validated", "x", "--processed", "y")
    assert r.returncode == 1 and "expected YYYY-MM-DD" in r.stderr


def test_history_then_audit_exit_codes():
    d = tempfile.mkdtemp(prefix="orderlake-cli-")
    csv = os.path.join(d, "csv")
    for day, rows in {"2025-06-01": ["A,U,10.0,USD,web,s,2025-06-01", "B,,5.0,USD,web,s,2025-06-01"],
                      "2025-06-02": ["C,U,abc,USD,web,s,2025-06-02", "D,U,7.5,USD,web,s,2025-06-02"]
                      }.items():
        os.makedirs(os.path.join(csv, f"date={day}"))
        with open(os.path.join(csv, f"date={day}", "part-0.csv"), "w") as f:
            f.write("order_id,user_id,amount,currency,channel,product_sku,process_date\n")
            f.write("\n".join(rows) + "\n")
    out = os.path.join(d, "out")
    assert _run("history", "--csv", csv, "--out", out).returncode == 0
    r = _run("audit", "--csv", csv, "--target", out, "--date", "2025-06")
    assert r.returncode == 0, r.stdout + r.stderr
    report = json.loads(r.stdout.strip().splitlines()[-1])
    assert report["status"] == "SUCCESS" and report["target_row_count"] == 2
    # the target misses a day: row mismatch, exit 1
    r = _run("audit", "--csv", csv, "--target", os.path.join(out, "process_date=2025-06-01"),
             "--date", "2025-06")
    assert r.returncode == 1


def test_daily_then_warehouse_jobs(spark):
    import datetime as dt
    d = tempfile.mkdtemp(prefix="orderlake-cli-")
    val, proc, stg, gold = (os.path.join(d, x) for x in ("validated", "processed", "staging", "gold"))
    spark.createDataFrame(
        [("A", "U1", 10.0, "USD", dt.date(2025, 6, 1)), ("B", "U2", 5.0, "JPY", dt.date(2025, 6, 1))],
        "order_id string, user_id string, amount double, currency string, process_date date"
    ).write.parquet(f"{val}/orders/orders_2025-06-01.parquet")
    spark.createDataFrame([("e1", "U1", "view", "2025-06-01T10:00:00")],
                          "event_id string, user_id string, event_type string, timestamp string"
                          ).write.parquet(f"{val}/events/events_2025-06-01.parquet")
    spark.createDataFrame([("U1", "gold")], "user_id string, segment string"
                          ).write.parquet(f"{val}/segments/w1")
    r = _run("daily", "--date", "2025-06-01", "--validated", val, "--processed", proc)
    assert r.returncode == 0, r.stdout + r.stderr
    assert json.loads(r.stdout.strip().splitlines()[-1])["rows_out"] == 2
    r = _run("warehouse", "--date", "2025-06-01", "--processed", proc, "--staging", stg,
             "--gold", gold, "--run-ts", "2025-06-02 00:00:00")
    assert r.returncode == 0, r.stdout + r.stderr
    out = json.loads(r.stdout.strip().splitlines()[-1])
    assert out["status"] == "MERGED" and out["staged_rows"] == 2
    assert _run("warehouse", "--date", "2025-06-02", "--processed", proc, "--staging", stg,
                "--gold", gold).returncode == 0                      # no input: SKIPPED, exit 0
