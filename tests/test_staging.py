import datetime as dt

from pyspark.sql import functions as F

from brickyard.operators import enrichment, marts, staging
from brickyard.plans.layers import build_layers


def rows(df, *cols):
    return [tuple(r) for r in df.select(*cols).collect()]


def test_sales_money_dates_and_price_rules(spark):
    feed = spark.createDataFrame([
        ("a", "$1,250,000", "01/31/2001", "1,000", "1"), ("b", "", "01/31/2001", "10", "1"), ("c", "N/A", "x", "10", "2"),
        ("d", "99,999.99", "02/01/2001", "10", "2"), ("e", "100000", "2001-02-03", "0", "6"), ("f", "100000", "bad", "2000", "3"),
        ("g", "100000", "02/03/2001", "2", None), ("h", "100000", "02/03/2001", "1.9", "5"), ("i", "100000", "02/03/2001", None, "5"),
    ], "BBL string, ` Sale_Price` string, sale_date string, gross_square_feet string, borough string")
    out = staging.stage_sales(feed).orderBy("bbl")
    # 50 and 50000 per square foot are both in range; an unknown range is kept
    assert rows(out, "bbl", "price_per_sqft") == [("a", 1250.0), ("e", None), ("f", 50.0), ("g", 50000.0), ("i", None)]
    assert rows(out, "sale_date", "borough_name") == [
        (dt.date(2001, 1, 31), "Manhattan"), (dt.date(2001, 2, 3), None), (None, "Brooklyn"), (dt.date(2001, 2, 3), None), (dt.date(2001, 2, 3), "Staten Island")]
    strict = staging.stage_sales(feed, keep_unknown_ppsf=False)
    assert sorted(r[0] for r in rows(strict, "bbl")) == ["a", "f", "g"]


def test_parcels_box_value_and_duplicates(spark):
    feed = spark.createDataFrame([
        ("1", "1", "10", "40.4", "-74.3", "x"), ("1", "1", "20", "40.4", "-74.3", "y"), ("2", "0", "5", "41.0", "-73.6", "z"),
        ("3", "6", "5", "41.0001", "-74", "z"), ("4", None, "0", "40.5", "-74", "z"), ("5", "5", "bad", "40.5", "-74", "z"),
        ("6", "2", "7", "40.5", "-74", "b"), ("6", "2", "7", "40.5", "-74", "a"),
    ], "bbl string, borocode string, assesstot string, latitude string, longitude string, ownername string")
    out = staging.stage_parcels(feed).orderBy("bbl")
    assert rows(out, "bbl", "assesstot", "ownername", "borough_name") == [
        ("1", 20.0, "y", "Manhattan"), ("2", 5.0, "z", None), ("6", 7.0, "a", "Bronx")]


def test_permits_lookback_and_descriptions(spark):
    feed = spark.createDataFrame([
        (1, " NB ", "1996-12-31T00:00:00.000", "1,000"), (2, "A3", "1996-12-30T23:59:59.999", "5"), (3, "XX", "2001-01-01T10:00:00.5", "x"), (4, "DM", "", "5"),
    ], "job_doc_number int, job_type string, filing_date string, estimated_job_cost string")
    out = staging.stage_permits_warehouse(feed).orderBy("permit_id")
    assert rows(out, "permit_id", "job_type_description", "filing_year", "estimated_job_cost") == [(1, "New Building", 1996, 1000.0), (3, "Other", 2001, None)]
    assert staging.stage_permits(feed).where("filing_date is null").count() == 1


def test_merge_suffix_and_missing_tables(spark):
    sales = spark.createDataFrame([(" 1", 200000.0, "S"), ("9", 300000.0, "T")], "bbl string, sale_price double, address string")
    parcels = spark.createDataFrame([("1 ", 5.0, "P")], "bbl string, assesstot double, address string")
    out = enrichment.merge_parcels(sales, parcels).orderBy("bbl")
    assert rows(out, "bbl", "address", "address_pluto", "assesstot") == [("1", "S", "P", 5.0), ("9", "T", None, None)]
    assert enrichment.merge_parcels(sales, parcels.drop("bbl")).columns == sales.columns
    only_sales = build_layers({"rolling_sales": sales.withColumn("neighborhood", F.lit("h"))})
    assert "market_segments" in only_sales and "staging_pluto" not in only_sales
    assert set(build_layers({"pluto": parcels})) == {"staging_pluto"}


def test_context_nulls(spark):
    sales = spark.createDataFrame([("h", 10.0, " 1 ", 1), ("h", 30.0, "2", 2), (None, 5.0, "1", 9)], "neighborhood string, sale_price double, zip_code string, borough int")
    permits = spark.createDataFrame([("1",), ("1 ",), (None,)], "zip_code string")
    violations = spark.createDataFrame([("1",), ("1",)], "boroughid string")
    out = enrichment.with_violation_context(enrichment.with_permit_context(enrichment.with_neighborhood_context(sales), permits), violations).orderBy("sale_price")
    assert rows(out, "price_vs_neighborhood", "neighborhood_permit_activity", "borough_violation_count") == [(None, 2, 0), (0.5, 2, 2), (1.5, 0, 0)]


def test_segment_threshold_and_null_group(spark):
    def hood(name, n):
        return [(name, "Bronx", 100000.0 + i, 100.0, 2001 - i % 2, 1000.0, None, "low_rise") for i in range(n)]

    df = spark.createDataFrame(hood("nine", 9) + hood("ten", 10) + hood(None, 10),
                               "neighborhood string, borough_name string, sale_price double, price_per_sqft double, sale_year int, gross_sqft double, x double, height_category string")
    for c in ("building_age", "num_floors", "floor_area_ratio", "commercial_ratio", "dist_to_cbd_km", "latitude", "longitude", "zip_permit_count", "zip_new_building_permits"):
        df = df.withColumn(c, F.col("x"))
    out = marts.market_segments_warehouse(df)
    assert {r[0] for r in rows(out, "neighborhood")} == {"ten", None}
    assert {r[0] for r in rows(out, "median_sale_price")} == {100004.5}


def test_height_classes(spark):
    from brickyard.operators.features import add_property_features

    df = spark.createDataFrame([(0.0,), (5.0,), (5.5,), (60.0,), (200.0,), (201.0,), (None,)], "numfloors double")
    cut = [r[0] for r in rows(add_property_features(df), "height_category")]
    assert cut == [None, "low_rise", "mid_rise", "tower", "supertall", None, None]
    case = [r[0] for r in df.select(enrichment.height_class_open(F.col("numfloors"))).collect()]
    assert case == ["low_rise", "low_rise", "mid_rise", "tower", "supertall", "supertall", "supertall"]
