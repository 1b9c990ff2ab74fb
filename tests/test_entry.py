"""Driver contract: entry() runs on the smallest tables with a stable schema; registry is consistent."""

import __spark_entry__ as E


def test_entry_schema(spark):
    df = E.entry(spark)
    assert df.schema.simpleString() == "struct<auc:double,auc_hard:double,n_train:bigint,n_test:bigint>"
    row = df.first()
    assert 0.5 < row["auc"] <= 1.0 and row["n_train"] > row["n_test"] > 0


def test_registry_consistent():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert all(callable(f) for f in q.values())
    assert "describe" in q and "auc" in o
