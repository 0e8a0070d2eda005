"""Every query of the budget engine against its SQL, on the smallest tables."""

from __future__ import annotations

import math
from decimal import Decimal

import duckdb
import pytest

from tallywright.plans import budget_queries  # noqa: F401
from tallywright.plans.queries import ORACLE_SQL, QUERIES

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(value):
    if isinstance(value, Decimal):
        return int(value) if value == int(value) else float(value)
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


@pytest.fixture(scope="module")
def duck(sf_dir):
    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, duck, name):
    got = QUERIES[name](spark, sf_dir)
    want = duck.sql(ORACLE_SQL[name])
    columns = sorted(got.columns)
    assert columns == sorted(want.columns)
    a = sorted((tuple(plain(r[c]) for c in columns) for r in got.collect()), key=repr)
    at = [want.columns.index(c) for c in columns]
    b = sorted((tuple(plain(r[i]) for i in at) for r in want.fetchall()), key=repr)
    assert a == b


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(QUERIES) <= set(entry.queries()) and set(entry.oracle_sql()) <= set(entry.queries())
