import datetime as dt

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickyard.operators import encoding, enrichment, features


def test_age_and_renovation_edges(spark):
    df = spark.createDataFrame([(0, 1986), (2050, None), (1701, 1985), (1700, 2001)], "yearbuilt int, yearalter1 int")
    out = features.add_property_features(df, dt.date(2001, 12, 31)).collect()
    ages = [r["building_age"] for r in out]
    assert ages[0] is None and ages[1] is None and ages[2] == 300.0 and ages[3] is None
    assert [r["is_recently_renovated"] for r in out] == [1, 0, 0, 1]


def test_one_hot_keeps_source_and_guards_width(spark):
    df = spark.createDataFrame([("b",), ("a",), (None,), ("c",)], "k string")
    out = encoding.one_hot(df, "k")
    assert out.columns == ["k", "k_b", "k_c"]
    assert [tuple(r) for r in out.collect()] == [("b", 1, 0), ("a", 0, 0), (None, 0, 0), ("c", 0, 1)]
    with pytest.raises(ValueError):
        encoding.one_hot(df, "k", max_width=2)


def test_label_codes_in_string_order(spark):
    words = ["b", "aa", "ab", "abc", "Z", "é", "b1"]
    df = spark.createDataFrame([(w,) for w in words] * 2 + [(None,)], "w string")
    got = {r["w"]: r["w_encoded"] for r in encoding.label_encode(df, "w").distinct().collect()}
    assert got == {**{w: float(i) for i, w in enumerate(sorted(words, key=lambda s: s.encode()))}, None: None}


def test_target_encoding_never_sees_its_own_fold(spark):
    data = [("x", 0, 10.0), ("x", 5, 30.0), ("x", 1, 50.0), ("solo", 2, 99.0), (None, 3, 1.0)]
    df = spark.createDataFrame(data, "k string, i int, sale_price double")
    mean = np.mean([v for *_, v in data])
    out = {(r["k"], r["i"]): r for r in encoding.target_encode(df, "k", "sale_price", "i").collect()}
    assert out["x", 0]["k_target_encoded"] == pytest.approx((50 + 10 * mean) / 11)
    assert out["x", 1]["k_target_encoded"] == pytest.approx((40 + 10 * mean) / 12)
    assert out["solo", 2]["k_target_encoded"] == pytest.approx(mean)
    assert out["solo", 2]["k_target_encoded_global"] == pytest.approx((99 + 10 * mean) / 11)
    assert out[None, 3]["k_target_encoded_global"] == pytest.approx(mean)


def test_sparseness_thresholds_and_fills(spark):
    n = 100
    df = spark.range(n).select(
        F.when(F.col("id") >= 70, 1.0).alias("seventy"), F.when(F.col("id") >= 71, 1.0).alias("more"),
        F.when(F.col("id") >= 10, F.col("id").cast("double")).alias("num"),
        F.when(F.col("id") % 4 == 0, None).when(F.col("id") % 4 == 1, "b").otherwise(F.when(F.col("id") % 4 == 2, "a").otherwise("c")).alias("text"))
    out = encoding.handle_sparseness(df)
    assert out.columns == ["seventy", "num", "text"]
    row = out.where("num is null or text is null").count()
    assert row == 0
    assert out.select("num").first()[0] == 54.5  # median of 10..99
    assert out.where("text = 'a'").count() == 50  # ties go to the smallest


def test_principal_components(spark):
    rng = np.random.default_rng(3)
    base = rng.normal(size=(300, 1))
    x = np.column_stack([base, base * 2 + 0.01 * rng.normal(size=(300, 1)), rng.normal(size=(300, 1))])
    df = spark.createDataFrame([tuple(map(float, r)) for r in x], "a double, b double, c double")
    out, shares = encoding.principal_components(df, ["a", "b", "c", "absent"], n=10, variance=0.95)
    assert len(shares) == 2 and sum(shares) > 0.95
    z = (x - x.mean(0)) / x.std(0)
    values, vectors = np.linalg.eigh(np.cov(z.T))
    want = z @ vectors[:, ::-1][:, 0]
    got = np.array([r[0] for r in out.select("pca_1").collect()])
    assert np.allclose(np.abs(got), np.abs(want), atol=1e-6)


def _feeds(spark):
    parcels = spark.createDataFrame(
        [("1", 1, "here", 40.75, -73.97, 1950.0, 1990.0, 200.0, 100.0, 50.0, 1e6, 12.0), ("2", 2, "there", 40.8, -73.9, None, None, 0.0, 0.0, None, None, None)],
        "bbl string, borocode int, address string, latitude double, longitude double, yearbuilt double, yearalter1 double, bldgarea double, lotarea double, comarea double, assesstot double, numfloors double")
    sales = spark.createDataFrame(
        [("1", 1, "a", "00001", "x", 5e5, 100.0), ("1", 1, "a", "00002", "y", 7e5, 0.0), ("2", 2, None, "00001", None, 9e5, None), ("9", 2, "b", None, "z", 3e5, 50.0), (None, None, "b", "00009", "z", 4e5, 80.0)],
        "bbl string, borough int, neighborhood string, zip_code string, address string, sale_price double, gross_square_feet double")
    permits = spark.createDataFrame([("00001",), ("00001",), (None,)], "zip_code string")
    violations = spark.createDataFrame([("1",), ("2",), ("2",), (None,)], "boroid string")
    return parcels, sales, permits, violations


def test_parcel_features_ahead_of_the_join_change_nothing(spark):
    parcels, sales, *_ = _feeds(spark)
    plain = features.add_property_features(features.add_geography(enrichment.merge_parcels(sales, parcels)))
    early = features.with_parcels(parcels, sales)
    assert early.columns == plain.columns and early.schema == plain.schema
    assert sorted(map(str, early.collect())) == sorted(map(str, plain.collect()))
    named = sales.withColumn("latitude", F.lit(40.0)).withColumn("building_age", F.lit(1.0))  # the sales' own columns count
    plain = features.add_property_features(features.add_geography(enrichment.merge_parcels(named, parcels)))
    early = features.with_parcels(parcels, named)
    assert early.columns == plain.columns and sorted(map(str, early.collect())) == sorted(map(str, plain.collect()))


def test_small_statistics_shuffle_no_sales(spark):
    """The joins know how small the statistics are, so the wide sales stay where they are."""
    parcels, sales, permits, violations = _feeds(spark)
    context = features.add_market_context(sales, permits, violations)
    encoded = encoding.target_encode(encoding.label_encode(sales, "address"), "neighborhood")
    for made in (context, encoded):
        plan = made._jdf.queryExecution().sparkPlan().toString()
        assert "SortMergeJoin" not in plan and "BroadcastHashJoin" in plan
    got = {(r["bbl"], r["sale_price"]): (r["neighborhood_sales_volume"], r["neighborhood_permit_activity"], r["borough_violation_count"]) for r in context.collect()}
    assert got == {("1", 5e5): (2, 2, 1), ("1", 7e5): (2, 0, 1), ("2", 9e5): (None, 2, 2), ("9", 3e5): (2, 0, 2), (None, 4e5): (2, 0, 0)}


def test_missing_fractions_count(spark):
    df = spark.createDataFrame([(1.0, "a"), (None, "b"), (None, None), (4.0, None)], "x double, t string")
    plan = encoding.missing_fractions(df)
    assert plan.first().asDict() == {"x": 0.5, "t": 0.5} and encoding.missing_fractions(df.limit(0)).first().asDict() == {"x": None, "t": None}
    assert "avg(" not in plan._jdf.queryExecution().optimizedPlan().toString()  # two numbers a column pass the fields of one compiled method
