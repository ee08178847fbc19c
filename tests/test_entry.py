import os

import duckdb
import pytest

import __spark_entry__ as entry
from foliant.plans import choices, reference, structure, whole

DATA = "/root/testdata/sf0.001"
QUERIES = reference.QUERIES | structure.QUERIES | choices.QUERIES | whole.QUERIES
ORACLE_SQL = reference.ORACLE_SQL | structure.ORACLE_SQL | choices.ORACLE_SQL | whole.ORACLE_SQL


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_against_sql(spark, name):
    con = duckdb.connect()
    for t in os.listdir(DATA):
        con.execute(f"CREATE VIEW {t.split('.')[0]} AS SELECT * FROM '{DATA}/{t}'")
    got, want = QUERIES[name](spark, DATA), con.execute(ORACLE_SQL[name]).df()
    columns = sorted(got.columns)
    rows = lambda df: sorted(map(repr, df[columns].astype(object).itertuples(index=False, name=None)))
    assert columns == sorted(want.columns)
    assert rows(got.toPandas()) == rows(want)


@pytest.mark.skipif(not os.path.isdir(DATA), reason="no test data")
def test_entry(spark):
    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries())
