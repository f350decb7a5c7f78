import __spark_entry__ as entry


def test_entry_and_registry(spark):
    df = entry.entry(spark)
    assert df.count() > 0 and "rate" in df.columns
    q, o = entry.queries(), entry.oracle_sql()
    assert set(o) <= set(q)
    assert len(q) >= 60
