"""Driver contract: entry runs, every query has a name, oracle keys are queries."""

import __spark_entry__ as E

from conftest import SF_SMALL


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) > 0
    assert df.columns == ["n_name", "avg_quantity", "n"]


def test_oracle_keys_are_queries():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)


def test_cheap_queries_run_on_smallest_tables(spark):
    q = E.queries()
    rows = {"avg_by_nation": 3, "kpi_report": 6, "json_fields": 4, "baskets_user": 2, "dense_ids": 3, "minhash_signatures": 2}
    for name, columns in rows.items():
        df = q[name](spark, SF_SMALL)
        assert len(df.columns) == columns and df.count() > 0, name
