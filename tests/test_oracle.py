"""Every registered query against its DuckDB oracle on the smallest driver tables."""

import datetime as dt
import decimal
import os

import pytest

import __spark_entry__ as E
from ledgermart.plans.driver_models import RECIPES as MODEL_RECIPES
from ledgermart.plans.driver_sources import RECIPES as SOURCE_RECIPES
from ledgermart.plans.driver_tables import RECIPES as TABLE_RECIPES
from ledgermart.plans.driver_tables import TABLES

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")


def _norm(v):
    if v is None:
        return "NULL"
    if isinstance(v, float):
        return f"{v:.12g}"
    if isinstance(v, decimal.Decimal):
        return f"{float(v):.12g}"
    if isinstance(v, (dt.date, dt.datetime)):
        return v.isoformat()
    return str(v)


def _rows(cols, rows):
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    return sorted("|".join(_norm(r[i]) for i in order) for r in rows)


@pytest.fixture(scope="module")
def duck():
    duckdb = pytest.importorskip("duckdb")
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


CORE = sorted({**TABLE_RECIPES, **MODEL_RECIPES, **SOURCE_RECIPES})


def test_every_core_query_has_oracle_sql():
    assert set(CORE) <= set(E.oracle_sql())
    assert set(E.oracle_sql()) <= set(E.queries())


@pytest.mark.parametrize("name", CORE)
def test_matches_oracle(spark, duck, name):
    df = E.queries()[name](spark, SF)
    cur = duck.execute(E.oracle_sql()[name])
    dcols = [c[0] for c in cur.description]
    assert sorted(df.columns) == sorted(dcols)
    assert _rows(df.columns, [tuple(r) for r in df.collect()]) == _rows(dcols, cur.fetchall())


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.count() >= 0
    assert "total_assets" in df.columns
