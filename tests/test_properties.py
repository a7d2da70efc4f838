"""Properties: keep/reject rules are exact complements on any raw strings
(P10/P11); merging a batch twice equals merging it once (K4)."""

import datetime as dt

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from orderlake.operators import gold as GD
from orderlake.operators import history as H
from orderlake.session import scratch_dir
from orderlake.sources.files import read_processed

CSV = ("order_id string, user_id string, amount string, currency string, channel string, "
       "product_sku string, process_date string")
texts = st.one_of(st.none(), st.sampled_from(["", "0", "-1", "1.5", "abc", "1e3", " 2 ", "NaN"]))
dates = st.one_of(st.none(), st.sampled_from(["2025-06-01", "2025-13-01", "bad", "2025-6-1"]))
row = st.tuples(st.one_of(st.none(), st.sampled_from(["A", "B", "C"])),
                st.one_of(st.none(), st.just("U")), texts, st.just("USD"), st.just("web"),
                st.just("s"), dates)


@settings(max_examples=15, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(row, min_size=0, max_size=12))
def test_keep_and_reject_partition_the_rows(spark, rows):
    raw = spark.createDataFrame(rows, CSV)
    clean, rejects = H.split_history(H.normalize_history(raw))
    assert clean.count() + rejects.count() == len(rows)
    r = H.reconciliation_report(raw, clean, "p").first()
    assert r["status"] == "SUCCESS"
    assert r["source_row_count"] == len(rows)


SCHEMA = ("order_id string, user_id string, amount double, currency string, process_date date, "
          "user_segment string, event_count int, event_types array<string>")
D = dt.date(2025, 6, 1)
gold_row = st.tuples(st.sampled_from(["A", "B", "C", "D"]), st.just("U"),
                     st.floats(min_value=0.5, max_value=100, allow_nan=False),
                     st.sampled_from(["USD", "INR"]), st.integers(0, 2).map(lambda i: D + dt.timedelta(i)),
                     st.just("s"), st.integers(0, 5), st.just(None))


@settings(max_examples=6, deadline=None, suppress_health_check=list(HealthCheck))
@given(st.lists(gold_row, min_size=1, max_size=6, unique_by=lambda r: (r[0], r[4])),
       st.lists(gold_row, min_size=1, max_size=6, unique_by=lambda r: (r[0], r[4])))
def test_merge_twice_equals_once(spark, first, second):
    t = scratch_dir(spark, "prop-merge")
    GD.merge_upsert(spark, t, GD.gold_model(spark.createDataFrame(first, SCHEMA), "2025-06-01 00:00:00"))
    src = GD.gold_model(spark.createDataFrame(second, SCHEMA), "2025-06-02 00:00:00")
    GD.merge_upsert(spark, t, src)
    once = sorted(tuple(r) for r in read_processed(spark, t).drop("updated_at").collect())
    GD.merge_upsert(spark, t, src)
    twice = sorted(tuple(r) for r in read_processed(spark, t).drop("updated_at").collect())
    assert once == twice
    keys = {(r[0], r[4]) for r in first} | {(r[0], r[4]) for r in second}
    assert len(once) == len(keys)
