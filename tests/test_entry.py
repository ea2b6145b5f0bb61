"""The driver contract."""

import __spark_entry__ as E


def test_entry_runs(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert set(df.columns) == {"stage", "n"} and sum(r["n"] for r in rows) == 200


def test_every_oracle_has_a_query():
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 80
