"""Every registered query against its DuckDB SQL on the smoke tables
(sf0.001): same columns, same row count, same values in any order."""

import math

import duckdb
import pytest

import __spark_entry__ as E
from tidemark.plans.queries import QUERIES

SF = "/root/testdata/sf0.001"
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    yield c
    c.close()


def _norm(rows, cols):
    order = sorted(range(len(cols)), key=lambda i: cols[i])

    def v(x):
        if x is None or (isinstance(x, float) and math.isnan(x)):
            return "NULL"
        return repr(round(x, 6)) if isinstance(x, float) else str(x)

    return sorted("|".join(v(r[i]) for i in order) for r in rows)


@pytest.mark.parametrize("name", sorted(k for k in E.queries() if k in QUERIES))
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF)
    got = [tuple(r) for r in df.collect()]
    cur = con.execute(E.oracle_sql()[name])
    cols = [d[0] for d in cur.description]
    want = cur.fetchall()
    assert sorted(df.columns) == sorted(cols)
    assert _norm(got, df.columns) == _norm(want, cols)
