"""Every registered query with SQL against DuckDB over the same tables."""

import duckdb
import pytest

from spanweave.plans import bank

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def db():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(rows):  # at full precision, as the driver compares
    return sorted((tuple(r) for r in rows), key=repr)


@pytest.mark.parametrize("name", sorted(bank.QUERIES))
def test_matches_sql(spark, db, name):
    df = bank.QUERIES[name](spark, SF)
    cols = sorted(df.columns)
    want = db.execute(f"SELECT {', '.join(cols)} FROM ({bank.ORACLE[name]})").fetchall()
    assert plain(map(tuple, df.select(*cols).collect())) == plain(want)
    assert want
