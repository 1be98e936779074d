"""The driver contract of __spark_entry__.py."""

import __spark_entry__ as E


def test_contract(spark):
    q, o = E.queries(), E.oracle_sql()
    assert set(o) <= set(q) and len(q) >= 80
    assert all(isinstance(v, str) and "SELECT" in v.upper() for v in o.values())
    assert all(callable(f) for f in q.values())
    df = E.entry(spark)
    assert df.columns == ["site_id", "n", "rmse", "mae", "r2", "mape"]
    assert df.count() == 5
