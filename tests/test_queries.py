import duckdb
import pytest

import __spark_entry__ as entry
from sentilake.plans import oracle

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES.split():
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def test_every_query_has_sql():
    own = {name for name in entry.queries() if name.startswith("q_")}
    assert own == set(oracle.queries())


@pytest.mark.parametrize("name", sorted(oracle.queries()))
def test_query_agrees_with_sql(spark, sf_dir, duck, name):
    df = entry.queries()[name](spark, sf_dir)
    columns = sorted(df.columns)
    got = [tuple(r) for r in df.select(*columns).collect()]
    sql = duck.sql(entry.oracle_sql()[name])
    assert sorted(sql.columns) == columns
    want = sql.select(*map(duckdb.ColumnExpression, columns)).fetchall()
    key = lambda row: tuple((v is None, str(v)) for v in row)
    assert sorted(got, key=key) == sorted(want, key=key)


def test_entry(spark):
    assert entry.entry(spark).count() == 18
