"""Every query of the catalogue that has SQL, against DuckDB on the smallest tables."""

import datetime
import decimal
import math

import duckdb
import pytest

from saltmarsh.plans import catalogue, flows  # noqa: F401  (registers its queries)

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents pages conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(x):
    if isinstance(x, bool) or x is None:
        return str(x)
    if isinstance(x, (int, float, decimal.Decimal)):
        return "None" if isinstance(x, float) and math.isnan(x) else f"{float(x):.9g}"
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x)


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(plain(r[i]) for i in order) for r in values)


@pytest.mark.parametrize("name", sorted(catalogue.ORACLE_SQL))
def test_query(spark, duck, name):
    df = catalogue.QUERIES[name](spark, SF)
    want = duck.execute(catalogue.ORACLE_SQL[name])
    names = [d[0] for d in want.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(names, want.fetchall())


def test_entry(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
