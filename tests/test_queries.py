"""Every registered query that has SQL gives the SQL's rows."""

from pathlib import Path

import duckdb
import pytest

from tessela.plans import catalogue

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents".split()


def _plain(value):
    return f"{value:.6f}" if isinstance(value, float) else str(value)


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.skipif(not Path(SF).exists(), reason="no test tables")
@pytest.mark.parametrize("name", sorted(catalogue.QUERIES))
def test_query(spark, duck, name):
    if name not in catalogue.ORACLE_SQL:
        pytest.skip("tested in test_tiers.py")
    df = catalogue.QUERIES[name](spark, SF)
    columns = sorted(df.columns)
    got = sorted(tuple(_plain(r[c]) for c in columns) for r in df.collect())
    want = duck.sql(catalogue.ORACLE_SQL[name])
    assert sorted(want.columns) == columns
    place = [want.columns.index(c) for c in columns]
    assert got == sorted(tuple(_plain(r[i]) for i in place) for r in want.fetchall())
