import __spark_entry__ as E


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["key", "event_type", "rows", "first_iso", "last_ts"]
    assert df.count() > 0


def test_every_oracle_has_a_query():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    # the training-data operators without a SQL form are held against brute force in their own tests
    missing = sorted(q for q in set(qs) - set(sql) if q != "pipeline" and not q.startswith("op"))
    assert missing == []
