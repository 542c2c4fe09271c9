import __spark_entry__ as entry


def test_entry_has_rows(spark):
    assert entry.entry(spark).columns and entry.entry(spark).count() >= 0


def test_each_oracle_has_its_query():
    assert set(entry.oracle_sql()) <= set(entry.queries())
