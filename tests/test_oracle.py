"""Every query with oracle SQL equals DuckDB on the sf0.001 tables."""

import pytest

import __spark_entry__ as entry
from sillage.plans import catalog
from tests.conftest import SMALL
from tests.oracle_compare import frame_key

SQL = catalog.oracle_sql()  # the training-data queries have tests of their own
QUERIES = catalog.queries()


def test_every_query_has_oracle_or_is_known_rows_only():
    rows_only = set(QUERIES) - set(SQL)
    assert rows_only <= {"ml_compare", "stream_scoring"}
    assert set(QUERIES) <= set(entry.queries())
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_matches_duckdb(spark, duck, name):
    got = QUERIES[name](spark, SMALL).toPandas()
    want = duck.execute(SQL[name]).df()
    assert sorted(got.columns) == sorted(want.columns)
    assert len(got) == len(want)
    assert frame_key(got) == frame_key(want)


def test_entry_runs(spark):
    df = entry.entry(spark)
    assert df.count() == 1000
    assert "prix_moy_categorie" in df.columns
