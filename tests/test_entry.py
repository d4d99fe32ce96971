import glob
import os

import duckdb
import pytest

import __spark_entry__ as entry
from tools.check_oracle import compare

FAST = ["stg_sales", "stg_parcels", "jn03_market_context", "mart_segments_warehouse", "ag18_box_stats", "ag07_kpi_row", "fe12_target_encode",
        "ts08_momentum", "rk06_portfolio_risk", "ds05_classifier_metrics", "gr09_co_investment", "gr11_investment_flow"]


@pytest.fixture(scope="module")
def db(sf):
    con = duckdb.connect()
    for path in glob.glob(f"{sf}/*.parquet"):
        con.sql(f"CREATE VIEW {os.path.basename(path)[:-8]} AS SELECT * FROM '{path}'")
    return con


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_oracle_has_a_query(db):
    assert set(entry.oracle_sql()) <= set(entry.queries())
    for sql in entry.oracle_sql().values():
        db.sql(f"EXPLAIN {sql}")


@pytest.mark.parametrize("name", FAST)
def test_query_equals_sql(spark, sf, db, name):
    assert compare(entry.queries()[name](spark, sf).toPandas(), db.sql(entry.oracle_sql()[name]).df()) == ""
