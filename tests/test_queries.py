"""Every query against its SQL, as the driver does."""

import duckdb
import pytest

from dialoom.plans import catalog as Q

SF = "/root/testdata/sf0.001"
TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations")


@pytest.fixture(scope="module")
def duck():
    c = duckdb.connect()
    for t in TABLES:
        c.sql(f"create view {t} as select * from '{SF}/{t}.parquet'")
    return c


def rows(df, columns):
    return sorted(map(str, df[columns].astype(object).where(df[columns].notna(), None).itertuples(index=False, name=None)))


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n in Q.SQL])
def test_same_rows(spark, duck, name):
    got, want = Q.QUERIES[name](spark, SF).toPandas(), duck.sql(Q.SQL[name]).df()
    columns = sorted(want.columns)
    assert sorted(got.columns) == columns
    assert rows(got, columns) == rows(want, columns)


@pytest.mark.parametrize("name", [n for n in Q.QUERIES if n not in Q.SQL])
def test_runs(spark, name):
    assert Q.QUERIES[name](spark, SF).count() > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).columns == ["rule", "n"]
    assert set(e.oracle_sql()) <= set(e.queries())
