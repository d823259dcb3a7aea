"""The driver contract: entry, queries and their DuckDB oracles agree."""

import os

import duckdb
import pytest

import __spark_entry__ as E
from conftest import TESTDATA

SF = f"{TESTDATA}/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not present")

TABLES = ["region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
          "documents", "embeddings", "pages", "benchmark", "labels", "conversations"]


def _canon(pdf):
    cols = sorted(pdf.columns)
    def norm(v):
        if v is None or v != v:
            return None
        return round(v, 6) if isinstance(v, float) else v
    return cols, sorted((tuple(norm(x) for x in rec) for rec in pdf[cols].astype(object).itertuples(index=False, name=None)), key=repr)


def test_entry_runs(spark):
    df = E.entry(spark)
    assert df.columns == ["accesses", "person_id", "name", "nationality"]
    assert len(df.collect()) == 10


def test_every_query_has_an_oracle():
    assert set(E.reports()) == set(E.report_sql())
    assert set(E.reports()) <= set(E.queries()) and set(E.oracle_sql()) <= set(E.queries())


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return con


@pytest.mark.parametrize("name", sorted(E.reports()))
def test_query_matches_oracle(spark, duck, name):
    got = _canon(E.reports()[name](spark, SF).toPandas())
    want = _canon(duck.execute(E.report_sql()[name]).df())
    assert got == want


def test_driver_views_register_once_and_refresh(spark):
    from socialpages.sources import driver_tables as dv

    dv.pages(spark, SF)
    names = {t.name for t in spark.catalog.listTables() if t.name.startswith("socialpages_")}
    assert any(n.startswith("socialpages_pages_") for n in names)
    assert any(n.startswith("socialpages_customer_") for n in names)
    dv.refresh(spark, SF)
    left = {t.name for t in spark.catalog.listTables() if t.name.startswith("socialpages_")}
    assert not {n for n in left if n in names}
    assert dv.pages(spark, SF).count() == 150
