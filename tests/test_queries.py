"""Every registered query against its SQL, and the driver's contract."""

import datetime
import math
from decimal import Decimal

import duckdb
import pytest

import __spark_entry__
from ledgerline import catalog

SF = "/root/testdata/sf0.01"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(v):
    if isinstance(v, Decimal):
        v = float(v)
    if isinstance(v, float):
        return "nan" if math.isnan(v) else float(f"{v:.9g}")
    if isinstance(v, datetime.datetime):
        return v.replace(tzinfo=None).isoformat()
    return tuple(map(plain, v)) if isinstance(v, list | tuple) else v


@pytest.fixture(scope="module")
def db():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return c


@pytest.mark.parametrize("name", list(catalog.oracle_sql()))
def test_against_sql(spark, db, name):
    got = catalog.queries()[name](spark, SF)
    want = db.execute(catalog.oracle_sql()[name])
    columns = [d[0] for d in want.description]
    assert sorted(columns) == sorted(got.columns)
    rows = [tuple(map(plain, r)) for r in got.select(*[f"`{c}`" for c in columns]).collect()]
    assert sorted(rows, key=str) == sorted((tuple(map(plain, r)) for r in want.fetchall()), key=str)
    assert rows


@pytest.mark.parametrize("name", [n for n in catalog.queries() if n not in catalog.oracle_sql()])
def test_rows_only(spark, name):
    assert catalog.queries()[name](spark, SF).head(1)


def test_entry(spark):
    rows = __spark_entry__.entry(spark).collect()
    assert rows and {r.state for r in rows} <= {"matched", "ambiguous", "unmatched"}
    assert set(catalog.queries()) <= set(__spark_entry__.queries())
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
