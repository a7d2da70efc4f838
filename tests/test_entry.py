"""Driver contract: entry(), queries(), oracle_sql()."""

import __spark_entry__ as ent


def test_registry_contract():
    qs, sqls = ent.queries(), ent.oracle_sql()
    assert len(qs) >= 40 and set(sqls) <= set(qs)
    assert all(callable(f) for f in qs.values())
    for name, sql in sqls.items():
        assert sql.lstrip().upper().startswith("WITH"), name


def test_entry_schema(spark):
    df = ent.entry(spark)
    assert df.columns == ["process_date", "user_segment", "total_revenue", "order_count"]
    assert df.count() > 0
