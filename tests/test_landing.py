"""Landing gate (S8, J4, J5, Q3–Q7) and the streaming wrapper."""

import pandas as pd
from pyspark.sql import functions as F

from orderlake.operators import landing as LG
from orderlake.plans.landing import _jvm_write_bytes, run_landing
from orderlake.schemas import REGISTRY_SCHEMA


def _write(spark, df: pd.DataFrame, path):
    spark.createDataFrame(df).coalesce(1).write.mode("overwrite").parquet(path)


ORDERS = pd.DataFrame({"order_id": ["A"], "user_id": ["U"], "amount": [1.0], "currency": ["USD"],
                       "process_date": pd.to_datetime(["2025-06-01"]).date, "channel_code": ["x"]})


def test_missing_extra_duplicate_and_new_bytes(spark, tmp_root):
    raw, reg = f"{tmp_root}/raw", f"{tmp_root}/registry"
    _write(spark, ORDERS, f"{raw}/orders/d1")
    _write(spark, ORDERS.drop(columns=["amount"]), f"{raw}/orders/d2")
    _write(spark, ORDERS, f"{raw}/backorders_misc/x")
    _jvm_write_bytes(spark, f"{raw}/orders/notes.txt", b"hello")
    run = run_landing(spark, raw, reg, "2025-06-01 00:00:00", needed=("orders",))
    d = {r["filename"].split("/")[1]: r for r in run.decisions.collect()}
    assert d["d1"]["status"] == "validated"                      # extra column passes
    assert d["d2"]["failure_reason"] == "Required column 'amount' missing from orders file"
    assert d["x"]["status"] == "quarantined"                     # path segment, not substring
    assert "notes.txt" not in d and run.status == "READY"
    # same bytes again under a new name: duplicate; new bytes under an old name: new
    _write(spark, ORDERS, f"{raw}/orders/d3")
    _write(spark, ORDERS.assign(amount=[2.0]), f"{raw}/orders/d1")
    run2 = run_landing(spark, raw, reg, "2025-06-02 00:00:00")
    d2 = {r["filename"].split("/")[1]: r["status"] for r in run2.decisions.collect()}
    assert d2["d3"] == "duplicate" and d2["d1"] == "validated" and d2["d2"] == "quarantined"
    assert run2.status == "SKIPPED"                              # events and segments missing
    # one registry row per content, first seen in the first run; a repeat reads no good file
    reg2 = LG.read_table(spark, reg, REGISTRY_SCHEMA)
    assert reg2.count() == reg2.select("md5").distinct().count() == 3
    first = reg2.orderBy("first_seen_at").first()
    run3 = run_landing(spark, raw, reg, "2025-06-03 00:00:00", needed=("orders",))
    assert run3.status == "READY" and run3.inputs["orders"] == 2
    read = {r["filename"].split("/")[1]: r["was_read"] for r in run3.decisions.collect()}
    assert read == {"d1": False, "d2": True, "d3": False, "x": True}
    reg3 = LG.read_table(spark, reg, REGISTRY_SCHEMA)
    assert reg3.count() == 3 and reg3.orderBy("first_seen_at").first()["first_seen_at"] == first["first_seen_at"]


def test_wrong_copy_never_claims_the_bytes(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    _write(spark, ORDERS, f"{raw}/events/a")
    _write(spark, ORDERS, f"{raw}/orders/b")
    _write(spark, ORDERS.rename(columns={"amount": "amount"}), f"{raw}/orders/c")
    got = {r["filename"].split("/")[1]: r["status"]
           for r in LG.landing_decisions(spark, LG.list_files(spark, raw), raw).collect()}
    assert got == {"a": "quarantined", "b": "validated", "c": "duplicate"}


def test_aliases_pass_and_missing_bytes_are_retried(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    _write(spark, pd.DataFrame({"event_id": ["e"], "user_id": ["U"], "action_type": ["v"], "event_time": ["t"]}),
           f"{raw}/events/renamed")
    listing = LG.list_files(spark, raw)
    gone = listing.withColumn("path", F.regexp_replace("path", "events/renamed", "events/gone"))
    s3 = listing.withColumn("path", F.lit("s3a://no-such-bucket.invalid/events/x.parquet"))
    got = {r["filename"].split("events/")[-1].split("/")[0]: r
           for r in LG.landing_decisions(spark, listing.unionByName(gone), raw).collect()}
    assert got["renamed"]["status"] == "validated" and got["gone"]["status"] == "retry"
    assert LG.registry_rows(LG.landing_decisions(spark, gone, raw)).count() == 0
    assert s3.count() == 1


def test_stream_survives_a_batch_without_parquet(spark, tmp_root):
    from orderlake.streaming.landing_stream import start_landing_stream
    raw = f"{tmp_root}/raw"
    _jvm_write_bytes(spark, f"{raw}/orders/notes.txt", b"hello")
    for step in range(2):
        q = start_landing_stream(spark, raw, f"{tmp_root}/decisions", f"{tmp_root}/registry", f"{tmp_root}/ckpt")
        q.awaitTermination(120)
        assert q.exception() is None
        _write(spark, ORDERS, f"{raw}/orders/d1")
    assert [r["status"] for r in spark.read.parquet(f"{tmp_root}/decisions").collect()] == ["validated"]


def test_daily_run_reads_the_manifest_only(spark, tmp_root):
    from orderlake.plans.daily import run_daily
    from orderlake.sources.files import read_processed
    raw, reg, out = f"{tmp_root}/raw", f"{tmp_root}/registry", f"{tmp_root}/p"
    _write(spark, ORDERS, f"{raw}/orders/orders_2025-06-01.parquet")
    _write(spark, ORDERS.drop(columns=["currency"]), f"{raw}/orders/orders_2025-06-02.parquet")   # quarantined
    _write(spark, pd.DataFrame({"user_id": ["U"], "segment": ["gold"], "segment_date": pd.to_datetime(["2025-06-01"]).date}),
           f"{raw}/segments/2025-06-01")
    run = run_landing(spark, raw, reg, "2025-06-01 00:00:00", run_date="2025-06-02", needed=("orders",))
    assert run.status == "SKIPPED"
    assert run_daily(spark, raw, out, "2025-06-01", registry=reg).status == "SUCCESS"
    assert read_processed(spark, out).first()["user_segment"] == "gold"
    assert run_daily(spark, raw, out, "2025-06-02", registry=reg).status == "SKIPPED"
    assert run_daily(spark, raw, out, "2025-06-09").status == "SKIPPED"


def test_type_check_option(spark, tmp_root):
    raw = f"{tmp_root}/raw"
    _write(spark, ORDERS.assign(amount=["1.0"]), f"{raw}/orders/d1")
    listing = LG.list_files(spark, raw)
    loose = LG.landing_decisions(spark, listing, raw).first()
    strict = LG.landing_decisions(spark, listing, raw, check_types=True).first()
    assert loose["status"] == "validated" and strict["status"] == "quarantined"
    assert "'amount'" in strict["failure_reason"]


def test_streaming_gate_available_now(spark, tmp_root):
    from orderlake.streaming.landing_stream import start_landing_stream
    raw = f"{tmp_root}/raw"
    _write(spark, ORDERS, f"{raw}/orders/d1")
    _write(spark, ORDERS, f"{raw}/orders/d1copy")
    q = start_landing_stream(spark, raw, f"{tmp_root}/decisions", f"{tmp_root}/registry",
                             f"{tmp_root}/ckpt")
    q.awaitTermination(120)
    out = spark.read.parquet(f"{tmp_root}/decisions")
    assert sorted(r["status"] for r in out.collect()) == ["duplicate", "validated"]
    _write(spark, ORDERS.assign(amount=[3.0]), f"{raw}/orders/d2")
    q = start_landing_stream(spark, raw, f"{tmp_root}/decisions", f"{tmp_root}/registry",
                             f"{tmp_root}/ckpt")
    q.awaitTermination(120)
    assert spark.read.parquet(f"{tmp_root}/decisions").count() == 3


def _segments(spark, raw):
    _write(spark, pd.DataFrame({"user_id": ["U"], "segment": ["gold"], "segment_date": pd.to_datetime(["2025-06-01"]).date}),
           f"{raw}/segments/2025-06-01")


def _put(spark, df: pd.DataFrame, path):
    """The drop's bytes under one name, as a re-dropped file has it."""
    import io
    out = io.BytesIO()
    df.to_parquet(out, index=False)
    _jvm_write_bytes(spark, path, out.getvalue())


def test_a_redrop_under_the_same_path(spark, tmp_root):
    """Corrected, faulty, good again, and former bytes back: the newest version counts."""
    from orderlake.plans.daily import run_daily
    from orderlake.sources.files import read_processed
    raw, reg, out = f"{tmp_root}/raw", f"{tmp_root}/registry", f"{tmp_root}/p"
    path = f"{raw}/orders/orders_2025-06-01.parquet"
    _segments(spark, raw)
    drops = [(ORDERS, "validated", [1.0]), (ORDERS.assign(amount=[2.5]), "validated", [2.5]),
             (ORDERS.drop(columns=["currency"]), "quarantined", None), (ORDERS.assign(amount=[4.5]), "validated", [4.5]),
             (ORDERS, "validated", [1.0])]
    for n, (df, status, amounts) in enumerate(drops):
        _put(spark, df, path)
        run = run_landing(spark, raw, reg, f"2025-06-0{n + 1} 00:00:00", needed=("orders",), run_date="2025-06-01")
        got = {r["filename"].split("/")[0]: r["status"] for r in run.decisions.collect()}
        assert got["orders"] == status and run.status == ("READY" if amounts else "SKIPPED")
        listed = LG.manifest_paths(spark, reg, "orders", ["2025-06-01"])
        assert [len(p) for p in listed.values()] == ([1] if amounts else [])
        done = run_daily(spark, raw, out, "2025-06-01", registry=reg)
        assert done.status == ("SUCCESS" if amounts else "SKIPPED")
        if amounts:
            assert [r["amount"] for r in read_processed(spark, out).collect()] == amounts


def test_a_segment_redrop_keeps_one_dimension(spark, tmp_root):
    from orderlake.plans.daily import run_daily
    raw, reg = f"{tmp_root}/raw", f"{tmp_root}/registry"
    _put(spark, ORDERS, f"{raw}/orders/orders_2025-06-01.parquet")
    for n, segment in enumerate(["gold", "silver"]):
        _put(spark, pd.DataFrame({"user_id": ["U"], "segment": [segment], "segment_date": pd.to_datetime(["2025-06-01"]).date}),
             f"{raw}/segments/2025-06-01.parquet")
        run_landing(spark, raw, reg, f"2025-06-0{n + 1} 00:00:00")
        assert run_daily(spark, raw, f"{tmp_root}/p{n}", "2025-06-01", registry=reg).status == "SUCCESS"
        assert spark.read.parquet(f"{tmp_root}/p{n}").first()["user_segment"] == segment


def test_another_path_hands_out_a_withdrawn_content(spark, tmp_root):
    raw, reg = f"{tmp_root}/raw", f"{tmp_root}/registry"
    for name in "ab":
        _put(spark, ORDERS, f"{raw}/orders/{name}.parquet")
    run_landing(spark, raw, reg, "2025-06-01 00:00:00")
    paths = lambda: [r["path"][-9:] for r in LG.manifest(LG.read_versions(spark, reg)).collect()]
    assert paths() == ["a.parquet"]
    _put(spark, ORDERS.drop(columns=["amount"]), f"{raw}/orders/a.parquet")
    run_landing(spark, raw, reg, "2025-06-02 00:00:00")
    assert paths() == ["b.parquet"]


def test_stream_and_batch_share_the_registry(spark, tmp_root):
    """What the stream validated the daily run reads; over many micro-batches
    and a restart a content is validated once, in whichever gate comes first."""
    from orderlake.plans.daily import run_daily
    from orderlake.streaming.landing_stream import start_landing_stream
    raw, reg = f"{tmp_root}/raw", f"{tmp_root}/registry"
    _segments(spark, raw)
    for name in ("orders_2025-06-01", "copy", "copy2"):
        _put(spark, ORDERS, f"{raw}/orders/{name}.parquet")
    _put(spark, ORDERS.drop(columns=["amount"]), f"{raw}/orders/orders_2025-06-02.parquet")
    for step in range(2):
        q = start_landing_stream(spark, raw, f"{tmp_root}/decisions", reg, f"{tmp_root}/ckpt", max_files_per_trigger=1)
        q.awaitTermination(180)
        assert q.exception() is None
        if step == 0:
            assert run_daily(spark, raw, f"{tmp_root}/p", "2025-06-01", registry=reg).status == "SUCCESS"
            assert run_daily(spark, raw, f"{tmp_root}/p", "2025-06-02", registry=reg).status == "SKIPPED"
            _put(spark, ORDERS, f"{raw}/orders/copy3.parquet")
    got = spark.read.parquet(f"{tmp_root}/decisions").where("file_type = 'orders'").groupBy("status").count().collect()
    assert {r["status"]: r["count"] for r in got} == {"validated": 1, "duplicate": 3, "quarantined": 1}
    again = run_landing(spark, raw, reg, "2030-06-01 00:00:00").decisions
    assert {r["status"] for r in again.where("file_type = 'orders' AND NOT was_read").collect()} == {"duplicate"}
    assert again.where("was_read").count() == 1                       # the quarantined file is looked at again
    assert len(LG.manifest_paths(spark, reg, "orders", ["2025-06-01"])["2025-06-01"]) == 1
