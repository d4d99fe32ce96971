"""Cases that used to be cut, dropped or wrong on raw text."""

import json
import math

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickyard.operators import ownership, risk, valuation
from brickyard.sources import extracts, tables


def test_extracts_order_text_dates(spark):
    sales = spark.createDataFrame([("a", "$500,000", "12/01/1995"), ("b", "$500,000", "01/15/2001"), ("c", "$500,000", "06/01/1999"), ("d", "$500,000", "")],
                                  "bbl string, sale_price string, sale_date string")
    assert [r["bbl"] for r in extracts.extract_sales(sales, limit=1).collect()] == ["b"]
    permits = spark.createDataFrame([("a", "NB", "2099-01-02"), ("b", "NB", ""), ("c", "NB", "2099-03-04")], "id string, job_type string, filing_date string")
    assert [r["id"] for r in extracts.extract_permits(permits).collect()] == ["c", "a"]
    visits = spark.createDataFrame([("a", "2099-01-02"), ("b", ""), ("c", None)], "id string, inspectiondate string")
    assert [r["id"] for r in extracts.extract_violations(visits).collect()] == ["a"]


def test_json_goes_to_the_store_of_its_path(spark, tmp_path):
    tables.save_results_json({"a": [1, spark.range(2)]}, f"file://{tmp_path}/deep/x.json")
    assert json.loads((tmp_path / "deep" / "x.json").read_text()) == {"a": [1, [{"id": 0}, {"id": 1}]]}


def test_places_anywhere_on_the_globe(spark):
    random = np.random.default_rng(1)
    spots = [(47.0, 8.0), (47.001, 8.0), (10.0, 179.9999), (10.0, -179.9999), (89.9999, 0.0), (89.9999, 180.0), (-33.0, 151.0)]
    spots += [(float(60 + a), float(-179.95 + b)) for a, b in random.uniform(0, 0.08, (150, 2))]
    spots += [(47.0, 8.0)]
    got = {(r["latitude"], r["longitude"]): r["n_near"] for r in ownership.nearby_locations(spark.createDataFrame(spots, "latitude double, longitude double"), 1.5).collect()}

    def km(a, b):
        h = math.sin(math.radians(b[0] - a[0]) / 2) ** 2 + math.cos(math.radians(a[0])) * math.cos(math.radians(b[0])) * math.sin(math.radians(b[1] - a[1]) / 2) ** 2
        return 2 * 6371 * math.asin(math.sqrt(h))

    assert got == {p: sum(km(p, q) <= 1.5 for q in spots) - 1 for p in spots}


def test_every_row_is_scored(spark):
    random = np.random.default_rng(0)
    rows = [(float(x), float(y) if y > 0.2 else None, float(np.exp(12 + x))) for x, y in random.uniform(0, 1, (400, 2))]
    df = spark.createDataFrame(rows, "gross_square_feet double, numfloors double, sale_price double")
    model = valuation.LinearModel(["gross_square_feet", "numfloors"], [12.0, 1.0, 0.0])
    out = valuation.predict_value(df, linear=model)
    assert out.count() == 400 and out.where("predicted_value IS NULL").count() == 0 and out.columns == [*df.columns, "predicted_value"]


def test_covariance_series_is_long_enough(spark):
    holdings = spark.range(1000).select(F.lit("p").alias("portfolio_id"), F.lit(1000.0).alias("value"), F.lit(0.03).alias("drift"), F.lit(1.0).alias("vol"))
    got = risk.portfolio_risk(holdings, years=30.0, rho=0.4).first()["std_value"]
    a = 1000 * math.exp(0.03 * 30)
    want = math.sqrt(1000 * a * a * math.expm1(30.0) + 1000 * 999 * a * a * math.expm1(12.0))
    assert got == pytest.approx(want, rel=1e-9)
