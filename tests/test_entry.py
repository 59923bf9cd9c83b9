"""Driver contract: entry() runs on sf0.001; every oracle key is a registered query."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 4
    assert {"queue_id", "total_calls", "handled_calls", "lost", "effective_answer_rate"} <= set(df.columns)


def test_catalog_consistency():
    qs, sqls = E.queries(), E.oracle_sql()
    assert set(sqls) <= set(qs)
    assert len(qs) >= 50


def test_conservation_on_driver_tables(spark):
    from pyspark.sql import functions as F
    qs = E.queries()
    d = "/root/testdata/sf0.001"
    total = qs["headline"](spark, d).agg(F.sum("total_calls")).first()[0]
    for name in ("daily_volume", "hourly_volume", "dow_volume", "weekly_volume"):
        assert qs[name](spark, d).agg(F.sum("calls")).first()[0] == total, name
    v = qs["queue_validation"](spark, d).collect()
    assert all(r.answered_no_agent_reconciled for r in v)
