"""Every registered query against its SQL on the smallest data set."""

import __spark_entry__ as driver
import duckdb
import pytest

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings"
          " pages benchmark labels conversations").split()


@pytest.fixture(scope="module")
def database():
    connection = duckdb.connect()
    for name in TABLES:
        path = f"{driver.SMOKE_DATA}/{name}.parquet"
        connection.sql(f"create view {name} as select * from '{path}'")
    return connection


def ordered(data):
    return sorted(data, key=lambda r: tuple((v is not None, str(v)) for v in r))


@pytest.mark.parametrize("name", sorted(driver.oracle_sql()))
def test_query_matches_sql(spark, database, name):
    df = driver.queries()[name](spark, driver.SMOKE_DATA)
    relation = database.sql(driver.oracle_sql()[name])
    assert sorted(df.columns) == sorted(relation.columns)
    columns = ", ".join(df.columns)
    expected = database.sql(f"select {columns} from relation").fetchall()
    assert ordered(map(tuple, df.collect())) == ordered(expected)


def test_entry(spark):
    assert driver.entry(spark).count() == 446
