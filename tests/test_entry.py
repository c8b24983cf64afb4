"""The driver's contract."""

import math

import duckdb
import pytest

import __spark_entry__ as entry
from loomcat.plans import driver_queries

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


@pytest.fixture(scope="session")
def duck(data):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from '{data}/{name}.parquet'")
    return con


def plain(v):
    if v is None or isinstance(v, float) and math.isnan(v):
        return "-"
    if isinstance(v, bool | str):
        return str(v)
    try:
        return f"{float(v):.6g}"
    except (TypeError, ValueError):
        return str(v)


def table(names, rows):
    order = sorted(names)
    return order, sorted(tuple(plain(r[names.index(n)]) for n in order) for r in rows)


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(driver_queries.QUERIES))
def test_query_equals_its_sql(spark, duck, data, name):
    found = entry.queries()[name](spark, data)
    wanted = duck.sql(entry.oracle_sql()[name])
    assert table(found.columns, [tuple(r) for r in found.collect()]) == table(wanted.columns, wanted.fetchall())
