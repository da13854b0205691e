import __spark_entry__ as E
from tidemark.plans.queries import QUERIES


def test_every_library_query_has_an_oracle():
    assert set(QUERIES) <= set(E.queries())
    assert set(QUERIES) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


def test_entry_runs_on_smoke_data(spark):
    df = E.entry(spark)
    rows = df.collect()
    assert len(rows) == 6
    assert df.columns == ["table_name", "column_name", "expectation", "action", "success",
                          "missing_count", "unexpected_count", "batch_id"]
