"""Every query with SQL gives the same rows as DuckDB; the others give rows."""

import duckdb
import pytest

import __spark_entry__ as entry

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()
SLOW = {"experiment_sweep", "model_gradient_boosting", "model_lightgbm"}


@pytest.fixture(scope="module")
def duck(tiny_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{tiny_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_equal_to_sql(spark, duck, tiny_dir, name):
    df = entry.queries()[name](spark, tiny_dir)
    columns = sorted(df.columns)
    result = duck.execute(entry.oracle_sql()[name])
    names = [c[0] for c in result.description]
    assert sorted(names) == columns
    want = sorted(repr(tuple(row[names.index(c)] for c in columns)) for row in result.fetchall())
    got = sorted(repr(tuple(r[c] for c in columns)) for r in df.collect())
    assert got == want


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql()) - SLOW))
def test_gives_rows(spark, tiny_dir, name):
    assert entry.queries()[name](spark, tiny_dir).count() > 0


def test_entry(spark):
    assert entry.entry(spark).count() == 150
