"""Queries for scans, extracts, staging, joins and marts."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickyard import settings
from brickyard.operators import enrichment, marts, staging
from brickyard.plans import layers
from brickyard.plans.oracle_views import (
    BOROUGH, MACRO, MACRO_NAMES, PERMITS, PLUTO, SALES, STAGED_PLUTO, STAGED_SALES, VIOLATIONS, haversine,
)
from brickyard.plans.registry import ctes, query
from brickyard.session import written
from brickyard.sources import adapters, extracts
from brickyard.sources.tables import load_tables, table

INT, DBL = "CAST({0} AS BIGINT)", "CAST({0} AS DOUBLE)"


# --- scans and extracts ---------------------------------------------------
@query("src01_table_rows", """
SELECT 'orders' AS table_name, count(*) AS n_rows FROM orders UNION ALL SELECT 'lineitem', count(*) FROM lineitem
UNION ALL SELECT 'part', count(*) FROM part UNION ALL SELECT 'supplier', count(*) FROM supplier
UNION ALL SELECT 'customer', count(*) FROM customer UNION ALL SELECT 'nation', count(*) FROM nation
UNION ALL SELECT 'region', count(*) FROM region UNION ALL SELECT 'events', count(*) FROM events
UNION ALL SELECT 'documents', count(*) FROM documents UNION ALL SELECT 'embeddings', count(*) FROM embeddings
UNION ALL SELECT 'pages', count(*) FROM pages UNION ALL SELECT 'benchmark', count(*) FROM benchmark
UNION ALL SELECT 'labels', count(*) FROM labels UNION ALL SELECT 'conversations', count(*) FROM conversations""")
def table_rows(spark, sf_dir):
    """Scan a folder into named tables and count each."""
    parts = [df.agg(F.count(F.lit(1)).alias("n_rows")).select(F.lit(n).alias("table_name"), "n_rows")
             for n, df in load_tables(spark, sf_dir).items()]
    out = parts[0]
    for part in parts[1:]:
        out = out.unionByName(part)
    return out


CAP = 500


@query("src04_extract_parcels", ctes(PLUTO) + f"""
SELECT bbl, borocode, landuse, assesstot, ownername FROM pluto
WHERE landuse IN ('02','03','04','05','06','07','08','09','10','11') AND borocode = 2
ORDER BY assesstot DESC, bbl LIMIT {CAP}""", floats="assesstot")
def extract_parcels(spark, sf_dir):
    # `address` follows the id, so id order is the tie-break here too
    feed = adapters.pluto(spark, sf_dir).select("bbl", "borocode", "landuse", "assesstot", "ownername")
    return extracts.extract_parcels(feed, borough=2, limit=CAP)


@query("src05_extract_sales", ctes(SALES) + f"""
SELECT sale_id, bbl, neighborhood, sale_price, sale_date FROM sales WHERE sale_price > 100000
ORDER BY sale_date DESC, bbl, neighborhood, sale_id, sale_price LIMIT {CAP}""", floats="sale_price")
def extract_sales(spark, sf_dir):
    feed = adapters.sales(spark, sf_dir, with_class=False)
    return extracts.extract_sales(feed.select("sale_id", "bbl", "neighborhood", "sale_price", "sale_date"), limit=CAP)


@query("src06_extract_permits", ctes(PERMITS) + f"""
SELECT job_doc_number, job_type, estimated_job_cost, CAST(filing_date AS DATE) AS filing_day FROM permits
WHERE filing_date > TIMESTAMP '1997-01-01' AND job_type IN ('NB','A1','DM')
ORDER BY filing_date DESC, estimated_job_cost, job_doc_number LIMIT {CAP}""", floats="estimated_job_cost")
def extract_permits(spark, sf_dir):
    feed = adapters.permits(spark, sf_dir).select("job_doc_number", "job_type", "estimated_job_cost", "filing_date")
    out = extracts.extract_permits(feed, since="1997-01-01", limit=CAP)
    return out.select("job_doc_number", "job_type", "estimated_job_cost", F.col("filing_date").cast("date").alias("filing_day"))


@query("src07_extract_violations", ctes(VIOLATIONS) + f"""
SELECT violation_id, bbl, class FROM violations WHERE inspectiondate > TIMESTAMP '2020-01-01'
ORDER BY inspectiondate DESC, bbl, class, violation_id LIMIT {CAP}""")
def extract_violations(spark, sf_dir):
    feed = adapters.violations(spark, sf_dir).select("violation_id", "bbl", "class", "inspectiondate")
    return extracts.extract_violations(feed, limit=CAP).drop("inspectiondate")


@query("src08_generic_extract", """
SELECT o_orderkey, o_totalprice FROM orders WHERE o_orderstatus = 'F'
ORDER BY o_totalprice DESC, o_orderkey LIMIT 200 OFFSET 100""", floats="o_totalprice")
def generic_extract(spark, sf_dir):
    order = [F.desc("o_totalprice"), F.asc("o_orderkey")]
    return extracts.extract(table(spark, sf_dir, "orders"), "o_orderstatus = 'F'", ["o_orderkey", "o_totalprice"],
                            order, offset=100, limit=200)


@query("src10_macro_table", ctes(MACRO, f"""
daily AS (SELECT date, {', '.join(f"max(CASE WHEN series = '{m}' THEN value END) AS {m}" for m in MACRO_NAMES)} FROM observations GROUP BY date),
filled AS (SELECT date, {', '.join(f"last_value({m} IGNORE NULLS) OVER w AS {m}" for m in MACRO_NAMES)} FROM daily
           WINDOW w AS (ORDER BY date ROWS UNBOUNDED PRECEDING))""") + f"""
SELECT CAST(date_trunc('month', date) AS DATE) AS month, {', '.join(f"arg_max({m}, date) AS {m}" for m in MACRO_NAMES)}
FROM filled GROUP BY 1""", floats=" ".join(MACRO_NAMES))
def macro_table(spark, sf_dir):
    return extracts.macro_table(adapters.macro_observations(spark, sf_dir), MACRO_NAMES)


@query("src11_series_slice", ctes(MACRO) + """
SELECT date, series, value FROM observations
WHERE series = 'fed_funds_rate' AND date BETWEEN DATE '1997-01-01' AND DATE '1999-12-31'""", floats="value")
def series_slice(spark, sf_dir):
    return extracts.series_slice(adapters.macro_observations(spark, sf_dir), "fed_funds_rate", "1997-01-01", "1999-12-31")


# --- staging, table rules -------------------------------------------------
PARCEL_COLUMNS = ["bbl", "borocode", "borough_name", "landuse", "lotarea", "bldgarea", "comarea", "numfloors",
                  "yearbuilt", "yearalter1", "assesstot", "latitude", "longitude", "ownername"]


@query("stg_parcels", ctes(PLUTO, STAGED_PLUTO) + f"""
SELECT {', '.join(PARCEL_COLUMNS).replace('landuse', "' ' || landuse AS landuse")} FROM parcels""",
       floats="lotarea bldgarea comarea numfloors assesstot latitude longitude")
def stg_parcels(spark, sf_dir):
    """Names, coercion, coordinate box, positive value, borough name, one row per parcel (STG1,2,4,5,7,8,9)."""
    return staging.stage_parcels(adapters.pluto_feed(spark, sf_dir)).select(*PARCEL_COLUMNS)


def landed_sales(spark, sf_dir):
    """The text feed as a landed table; building the text and parsing it in one plan would repeat the formatting."""
    return written(adapters.sales_feed(spark, sf_dir))


FEED_SALES = """feed AS (
  SELECT *, CASE WHEN l_tax <> 0.08 THEN CAST(CAST(sale_price AS DECIMAL(18,2)) AS DOUBLE) END AS price FROM sales)"""


@query("stg_sales", ctes(SALES, FEED_SALES) + f"""
SELECT sale_id, bbl, borough, {BOROUGH.format('borough')} AS borough_name, price AS sale_price, sale_date,
       year(sale_date) AS sale_year, month(sale_date) AS sale_month, quarter(sale_date) AS sale_quarter,
       gross_square_feet, land_square_feet, price / nullif(gross_square_feet, 0) AS price_per_sqft
FROM feed WHERE price >= 100000 AND (gross_square_feet IS NULL OR price / gross_square_feet BETWEEN 50 AND 50000)""",
       floats="sale_price gross_square_feet land_square_feet price_per_sqft")
def stg_sales(spark, sf_dir):
    """Money and date text parsed, arm's-length and price-range rules, unknown range kept (STG3,9-13a)."""
    return staging.stage_sales(landed_sales(spark, sf_dir)).select(
        "sale_id", "bbl", "borough", "borough_name", "sale_price", "sale_date", "sale_year", "sale_month",
        "sale_quarter", "gross_square_feet", "land_square_feet", "price_per_sqft")


FEED_PERMITS = """feed AS (
  SELECT job_doc_number, zip_code, CASE WHEN job_type = 'DM' THEN 'ZZ' ELSE job_type END AS job_type,
         CAST(CAST(estimated_job_cost AS DECIMAL(18,2)) AS DOUBLE) AS estimated_job_cost,
         CASE WHEN work_type <> '2-HIGH' THEN filing_date END AS filing_date FROM permits)"""


@query("stg_permits", ctes(PERMITS, FEED_PERMITS) + """
SELECT job_doc_number, CAST(filing_date AS DATE) AS filing_day, year(filing_date) AS filing_year, estimated_job_cost
FROM feed""", floats="estimated_job_cost")
def stg_permits(spark, sf_dir):
    """Permit dates, filing year and cost (STG16); an unreadable date stays as NULL."""
    return staging.stage_permits(adapters.permits_feed(spark, sf_dir)).select(
        "job_doc_number", F.col("filing_date").cast("date").alias("filing_day"), "filing_year", "estimated_job_cost")


@query("stg_violations", ctes(VIOLATIONS) + """
SELECT bbl, class, boroid, CAST(inspectiondate AS DATE) AS inspection_day, count(*) AS n FROM violations
GROUP BY ALL""")
def stg_violations(spark, sf_dir):
    feed = adapters.violations(spark, sf_dir).withColumn("inspectiondate", F.col("inspectiondate").cast("string"))
    return staging.stage_violations(feed).groupBy(
        "bbl", "class", "boroid", F.col("inspectiondate").cast("date").alias("inspection_day")).agg(
        F.count(F.lit(1)).alias("n"))


# --- staging, warehouse rules ---------------------------------------------
W_PARCELS = f"""w_parcels AS (
  SELECT borocode || '-' || lpad(block, 5, '0') || '-' || lpad(lot, 4, '0') AS parcel_id, bbl, borocode AS borough_code,
         {BOROUGH.format('borocode')} AS borough_name, landuse AS land_use_code, ownername AS owner_name,
         bldgclass AS building_class, zonedist1 AS zoning_district,
         lotarea AS lot_area_sqft, bldgarea AS building_area_sqft, comarea AS commercial_area_sqft,
         officearea AS office_area_sqft, retailarea AS retail_area_sqft, numfloors AS num_floors,
         yearbuilt AS year_built, assesstot AS assessed_total, assessland AS assessed_land, latitude, longitude,
         bldgarea / nullif(lotarea, 0) AS floor_area_ratio, 2001 - yearbuilt AS building_age
  FROM pluto
  WHERE latitude BETWEEN CAST(40.4 AS DOUBLE) AND CAST(41.0 AS DOUBLE)
    AND longitude BETWEEN CAST(-74.3 AS DOUBLE) AND CAST(-73.6 AS DOUBLE) AND assesstot > 0
    AND landuse IN ('02','03','04','05','06','07','08','09','10','11'))"""


@query("stg_parcels_warehouse", ctes(PLUTO, W_PARCELS) + """
SELECT parcel_id, bbl, borough_code, borough_name, land_use_code, owner_name, lot_area_sqft, num_floors, year_built,
       assessed_total, assessed_land, floor_area_ratio, building_age FROM w_parcels""",
       floats="lot_area_sqft num_floors assessed_total assessed_land floor_area_ratio")
def stg_parcels_warehouse(spark, sf_dir):
    """Commercial land use, FAR, age, best assessment per parcel, trimmed text (STG4-6,8,9,14,19,20, WN1)."""
    return staging.stage_parcels_warehouse(adapters.pluto_feed(spark, sf_dir)).select(
        "parcel_id", "bbl", "borough_code", "borough_name", "land_use_code", "owner_name", "lot_area_sqft",
        "num_floors", "year_built", "assessed_total", "assessed_land", "floor_area_ratio", "building_age")


@query("stg_sales_warehouse", ctes(SALES, FEED_SALES) + f"""
SELECT sale_id, borough || '-' || lpad(block, 5, '0') || '-' || lpad(lot, 4, '0') AS parcel_id,
       {BOROUGH.format('borough')} AS borough_name, neighborhood, address, zip_code, building_class_category,
       price AS sale_price, sale_date, gross_square_feet AS gross_sqft,
       CAST(total_units - total_units % 3 AS BIGINT) AS residential_units, CAST(commercial_units AS BIGINT) AS commercial_units,
       price / nullif(gross_square_feet, 0) AS price_per_sqft
FROM feed WHERE price >= 100000 AND price / nullif(gross_square_feet, 0) BETWEEN 50 AND 50000""",
       floats="sale_price gross_sqft price_per_sqft")
def stg_sales_warehouse(spark, sf_dir):
    """Warehouse sales: composed parcel id, trimmed text, unknown price per square foot dropped (STG13b,14,19)."""
    return staging.stage_sales_warehouse(landed_sales(spark, sf_dir)).select(
        "sale_id", "parcel_id", "borough_name", "neighborhood", "address", "zip_code", "building_class_category",
        "sale_price", "sale_date", "gross_sqft", "residential_units", "commercial_units", "price_per_sqft")


@query("stg_permits_warehouse", ctes(PERMITS, FEED_PERMITS) + """
SELECT job_doc_number AS permit_id, zip_code, job_type, CASE job_type WHEN 'NB' THEN 'New Building'
         WHEN 'A1' THEN 'Major Alteration' WHEN 'A2' THEN 'Minor Alteration'
         WHEN 'A3' THEN 'Minor Alteration (no plans)' WHEN 'DM' THEN 'Demolition' ELSE 'Other' END AS job_type_description,
       CAST(filing_date AS DATE) AS filing_day, year(filing_date) AS filing_year, estimated_job_cost
FROM feed WHERE filing_date >= TIMESTAMP '1996-12-31'""", floats="estimated_job_cost")
def stg_permits_warehouse(spark, sf_dir):
    """Job type names and the five-year lookback from the as-of date (STG15-17)."""
    return staging.stage_permits_warehouse(adapters.permits_feed(spark, sf_dir)).select(
        "permit_id", "zip_code", "job_type", "job_type_description",
        F.col("filing_date").cast("date").alias("filing_day"), "filing_year", "estimated_job_cost")


# --- joins and aggregates -------------------------------------------------
def staged_sales(spark, sf_dir, with_class=True):
    return staging.stage_sales(adapters.sales(spark, sf_dir, with_class))


def staged_parcels(spark, sf_dir):
    return staging.stage_parcels(adapters.pluto(spark, sf_dir))


@query("jn01_sales_with_parcels", ctes(SALES, STAGED_SALES, PLUTO, STAGED_PLUTO) + """
SELECT s.sale_id, s.bbl, s.sale_price, s.borough_name, p.borough_name AS borough_name_pluto, p.ownername, p.assesstot,
       p.numfloors, p.address AS address_pluto FROM staged s LEFT JOIN parcels p ON trim(s.bbl) = trim(p.bbl)""",
       floats="sale_price assesstot numfloors")
def sales_with_parcels(spark, sf_dir):
    return enrichment.merge_parcels(staged_sales(spark, sf_dir, False), staged_parcels(spark, sf_dir)).select(
        "sale_id", "bbl", "sale_price", "borough_name", "borough_name_pluto", "ownername", "assesstot", "numfloors",
        "address_pluto")


W_SALES = f"""w_sales AS (
  SELECT sale_id, bbl, borough || '-' || lpad(block, 5, '0') || '-' || lpad(lot, 4, '0') AS parcel_id,
         {BOROUGH.format('borough')} AS borough_name, neighborhood, address, zip_code, building_class_category,
         building_class_at_sale, sale_price, sale_date, year(sale_date) AS sale_year, quarter(sale_date) AS sale_quarter,
         gross_square_feet AS gross_sqft, land_square_feet AS land_sqft, total_units, commercial_units, year_built,
         sale_price / nullif(gross_square_feet, 0) AS price_per_sqft
  FROM sales WHERE sale_price >= 100000 AND sale_price / nullif(gross_square_feet, 0) BETWEEN 50 AND 50000)"""
W_PERMITS = """w_permits AS (SELECT * FROM permits WHERE filing_date >= TIMESTAMP '1996-12-31')"""
LAT, LON = settings.LANDMARKS["grand_central"]
W_FEATURES = f"""hoods AS (
  SELECT neighborhood, avg(sale_price) AS neighborhood_avg_price, median(sale_price) AS neighborhood_median_price,
         count(*) AS neighborhood_sales_volume, stddev(sale_price) AS neighborhood_price_std,
         avg(price_per_sqft) AS neighborhood_avg_ppsf FROM w_sales GROUP BY neighborhood),
zips AS (
  SELECT zip_code, count(*) AS permit_count, sum(estimated_job_cost) AS total_permit_value,
         count(*) FILTER (WHERE job_type = 'NB') AS new_building_permits,
         count(*) FILTER (WHERE job_type = 'DM') AS demolition_permits FROM w_permits GROUP BY zip_code),
features AS (
  SELECT s.*, p.lot_area_sqft, p.building_area_sqft, p.commercial_area_sqft, p.office_area_sqft, p.retail_area_sqft,
         p.num_floors, p.assessed_total, p.assessed_land, p.floor_area_ratio, p.building_age, p.zoning_district,
         p.building_class, p.owner_name, p.latitude, p.longitude,
         {haversine('p.latitude', 'p.longitude', LAT, LON)} AS dist_to_cbd_km,
         h.* EXCLUDE (neighborhood), s.sale_price / h.neighborhood_avg_price AS price_vs_neighborhood,
         coalesce(z.permit_count, 0) AS zip_permit_count, coalesce(z.total_permit_value, 0) AS zip_total_permit_value,
         coalesce(z.new_building_permits, 0) AS zip_new_building_permits,
         CASE WHEN num_floors <= 5 THEN 'low_rise' WHEN num_floors <= 15 THEN 'mid_rise'
              WHEN num_floors <= 30 THEN 'high_rise' WHEN num_floors <= 60 THEN 'tower' ELSE 'supertall' END AS height_category,
         commercial_area_sqft / nullif(building_area_sqft, 0) AS commercial_ratio
  FROM w_sales s LEFT JOIN w_parcels p USING (parcel_id) LEFT JOIN hoods h USING (neighborhood) LEFT JOIN zips z USING (zip_code))"""
WAREHOUSE = (SALES, PLUTO, PERMITS, W_SALES, W_PARCELS, W_PERMITS, W_FEATURES)


def warehouse_sales(spark, sf_dir, with_class=True):
    sales = adapters.sales(spark, sf_dir, with_class)
    if not with_class:
        sales = sales.withColumn("building_class_category", F.lit(None).cast("string"))
    return staging.stage_sales_warehouse(sales)


def warehouse_features(spark, sf_dir, with_class=True, with_neighborhood=True):
    sales = warehouse_sales(spark, sf_dir, with_class)
    parcels = staging.stage_parcels_warehouse(adapters.pluto(spark, sf_dir)).drop("bbl")
    permits = staging.stage_permits_warehouse(adapters.permits(spark, sf_dir))
    return enrichment.property_features_warehouse(sales, parcels, permits, with_neighborhood=with_neighborhood)


@query("jn02_property_features", ctes(*WAREHOUSE) + """
SELECT sale_id, parcel_id, sale_price, price_per_sqft, num_floors, assessed_total, floor_area_ratio, building_age,
       owner_name, dist_to_cbd_km, neighborhood_avg_price, neighborhood_median_price, neighborhood_sales_volume,
       neighborhood_price_std, neighborhood_avg_ppsf, price_vs_neighborhood, zip_permit_count, zip_total_permit_value,
       zip_new_building_permits, height_category, commercial_ratio FROM features""",
       floats="sale_price price_per_sqft num_floors assessed_total floor_area_ratio dist_to_cbd_km neighborhood_avg_price "
              "neighborhood_median_price neighborhood_price_std neighborhood_avg_ppsf price_vs_neighborhood "
              "zip_total_permit_value commercial_ratio", digits={"zip_total_permit_value": 2})
def property_features(spark, sf_dir):
    """Four-way enrichment with height class, distance, ratios (JN2, AG1, AG2, FE3, FE8b, FE9)."""
    return warehouse_features(spark, sf_dir, False).select(
        "sale_id", "parcel_id", "sale_price", "price_per_sqft", "num_floors", "assessed_total", "floor_area_ratio",
        "building_age", "owner_name", "dist_to_cbd_km", "neighborhood_avg_price", "neighborhood_median_price",
        "neighborhood_sales_volume", "neighborhood_price_std", "neighborhood_avg_ppsf", "price_vs_neighborhood",
        "zip_permit_count", "zip_total_permit_value", "zip_new_building_permits", "height_category", "commercial_ratio")


CONTEXT = """context AS (
  SELECT s.*, h.avg_price AS neighborhood_avg_price, h.median_price AS neighborhood_median_price,
         h.n AS neighborhood_sales_volume, h.sd AS neighborhood_price_std,
         s.sale_price / nullif(h.avg_price, 0) AS price_vs_neighborhood,
         coalesce(p.n, 0) AS neighborhood_permit_activity, coalesce(v.n, 0) AS borough_violation_count
  FROM staged s
  LEFT JOIN (SELECT neighborhood, avg(sale_price) AS avg_price, median(sale_price) AS median_price,
                    count(sale_price) AS n, stddev(sale_price) AS sd FROM staged GROUP BY 1) h USING (neighborhood)
  LEFT JOIN (SELECT zip_code, count(*) AS n FROM permits GROUP BY 1) p USING (zip_code)
  LEFT JOIN (SELECT boroid, count(*) AS n FROM violations GROUP BY 1) v ON CAST(s.borough AS VARCHAR) = v.boroid)"""


@query("jn03_market_context", ctes(SALES, STAGED_SALES, PERMITS, VIOLATIONS, CONTEXT) + """
SELECT sale_id, bbl, neighborhood, sale_price, neighborhood_avg_price, neighborhood_median_price,
       neighborhood_sales_volume, neighborhood_price_std, price_vs_neighborhood, neighborhood_permit_activity,
       borough_violation_count FROM context""",
       floats="sale_price neighborhood_avg_price neighborhood_median_price neighborhood_price_std price_vs_neighborhood")
def market_context(spark, sf_dir):
    """Neighbourhood, permit and violation context joined back to sales (JN3-5, AG1, AG3, AG4, FE9)."""
    out = enrichment.with_neighborhood_context(staged_sales(spark, sf_dir, False))
    out = enrichment.with_permit_context(out, adapters.permits(spark, sf_dir))
    return enrichment.with_violation_context(out, adapters.violations(spark, sf_dir)).select(
        "sale_id", "bbl", "neighborhood", "sale_price", "neighborhood_avg_price", "neighborhood_median_price",
        "neighborhood_sales_volume", "neighborhood_price_std", "price_vs_neighborhood",
        "neighborhood_permit_activity", "borough_violation_count")


@query("ag02_zip_permit_activity", ctes(PERMITS, W_PERMITS) + """
SELECT zip_code, count(*) AS permit_count, sum(estimated_job_cost) AS total_permit_value,
       count(*) FILTER (WHERE job_type = 'NB') AS new_building_permits,
       count(*) FILTER (WHERE job_type = 'DM') AS demolition_permits FROM w_permits GROUP BY zip_code""",
       floats="total_permit_value", digits=2)
def zip_permits(spark, sf_dir):
    return enrichment.zip_permit_activity(staging.stage_permits_warehouse(adapters.permits(spark, sf_dir)))


@query("jn06_violation_counts", ctes(PLUTO, STAGED_PLUTO, VIOLATIONS) + """
SELECT p.bbl, coalesce(v.n, 0) AS violation_count, coalesce(v.severe, 0) AS severe_violation_count FROM parcels p
LEFT JOIN (SELECT bbl, count(*) AS n, count(*) FILTER (WHERE class IN ('C', 'I')) AS severe FROM violations GROUP BY 1) v
USING (bbl)""")
def violation_counts(spark, sf_dir):
    out = enrichment.with_violation_counts(staged_parcels(spark, sf_dir), adapters.violations(spark, sf_dir))
    return out.select("bbl", "violation_count", "severe_violation_count")


# --- marts ----------------------------------------------------------------
@query("mart_valuations", ctes(SALES, STAGED_SALES, PLUTO, STAGED_PLUTO) + """
SELECT s.bbl, s.borough_name, s.neighborhood, s.building_class_category, s.sale_price, s.sale_date, s.sale_year,
       s.gross_square_feet, s.land_square_feet, p.yearbuilt, p.numfloors, p.unitstotal, p.assesstot, p.assessland,
       p.lotarea, p.bldgarea, p.comarea, p.resarea, p.officearea, p.retailarea, p.latitude, p.longitude,
       s.price_per_sqft, s.zip_code FROM staged s LEFT JOIN parcels p USING (bbl)""",
       floats="sale_price gross_square_feet land_square_feet numfloors assesstot assessland lotarea bldgarea comarea "
              "resarea officearea retailarea latitude longitude price_per_sqft")
def mart_valuations(spark, sf_dir):
    """Valuation mart through the layer composition (STG21, PL1)."""
    return layers.build_layers({"pluto": adapters.pluto(spark, sf_dir),
                                "rolling_sales": adapters.sales(spark, sf_dir)})["property_valuations"]


@query("mart_segments", ctes(SALES, STAGED_SALES, PLUTO, STAGED_PLUTO) + """
SELECT s.neighborhood, avg(sale_price) AS sale_price_mean, median(sale_price) AS sale_price_median,
       count(sale_price) AS sale_price_count, stddev(sale_price) AS sale_price_std,
       avg(price_per_sqft) AS price_per_sqft_mean, median(price_per_sqft) AS price_per_sqft_median,
       median(yearbuilt) AS yearbuilt_median, avg(numfloors) AS numfloors_mean
FROM staged s LEFT JOIN parcels p USING (bbl) GROUP BY s.neighborhood""",
       floats="sale_price_mean sale_price_median sale_price_std price_per_sqft_mean price_per_sqft_median "
              "yearbuilt_median numfloors_mean")
def mart_segments(spark, sf_dir):
    """Market segments by neighbourhood, table rules (AG5, PL1)."""
    return layers.build_layers({"pluto": adapters.pluto(spark, sf_dir),
                                "rolling_sales": adapters.sales(spark, sf_dir, False)})["market_segments"]


@query("mart_valuations_warehouse", ctes(*WAREHOUSE) + """
SELECT bbl, borough_name, neighborhood, address, zip_code, sale_price, price_per_sqft, sale_date, sale_year,
       sale_quarter, building_class_category, building_class_at_sale, gross_sqft, land_sqft, lot_area_sqft,
       building_area_sqft, commercial_area_sqft, office_area_sqft, retail_area_sqft, num_floors,
       CAST(total_units AS BIGINT) AS total_units, CAST(commercial_units AS BIGINT) AS commercial_units, year_built,
       building_age, floor_area_ratio, commercial_ratio, height_category, zoning_district, assessed_total,
       assessed_land, sale_price / nullif(assessed_total, 0) AS sale_to_assessed_ratio, latitude, longitude, dist_to_cbd_km,
       neighborhood_avg_price, neighborhood_median_price, neighborhood_sales_volume, neighborhood_avg_ppsf,
       price_vs_neighborhood, zip_permit_count, zip_total_permit_value, zip_new_building_permits,
       ln(sale_price + 1) AS log_sale_price,
       CASE WHEN gross_sqft IS NOT NULL THEN ln(greatest(gross_sqft, 1)) END AS log_gross_sqft,
       CASE WHEN assessed_total IS NOT NULL THEN ln(greatest(assessed_total, 1)) END AS log_assessed_total, owner_name
FROM features WHERE sale_price >= 100000 AND gross_sqft > 0 AND latitude IS NOT NULL AND longitude IS NOT NULL""",
       floats="sale_price price_per_sqft gross_sqft land_sqft lot_area_sqft building_area_sqft commercial_area_sqft "
              "office_area_sqft retail_area_sqft num_floors floor_area_ratio commercial_ratio assessed_total assessed_land "
              "sale_to_assessed_ratio latitude longitude dist_to_cbd_km neighborhood_avg_price neighborhood_median_price "
              "neighborhood_avg_ppsf price_vs_neighborhood zip_total_permit_value log_sale_price log_gross_sqft "
              "log_assessed_total", digits={"zip_total_permit_value": 2})
def mart_valuations_warehouse(spark, sf_dir):
    """Valuation mart, warehouse rules (STG22)."""
    return marts.property_valuations_warehouse(warehouse_features(spark, sf_dir))


@query("mart_segments_warehouse", ctes(*WAREHOUSE, """metrics AS (
  SELECT neighborhood, borough_name, avg(sale_price) AS avg_sale_price, median(sale_price) AS median_sale_price,
         stddev(sale_price) AS std_sale_price, avg(price_per_sqft) AS avg_ppsf, median(price_per_sqft) AS median_ppsf,
         count(*) AS total_transactions, count(DISTINCT sale_year) AS years_with_sales, avg(gross_sqft) AS avg_gross_sqft,
         avg(building_age) AS avg_building_age, avg(num_floors) AS avg_num_floors, avg(floor_area_ratio) AS avg_far,
         avg(commercial_ratio) AS avg_commercial_ratio,
         count(*) FILTER (WHERE height_category = 'low_rise') AS low_rise_count,
         count(*) FILTER (WHERE height_category = 'mid_rise') AS mid_rise_count,
         count(*) FILTER (WHERE height_category = 'high_rise') AS high_rise_count,
         count(*) FILTER (WHERE height_category IN ('tower', 'supertall')) AS tower_count,
         avg(dist_to_cbd_km) AS avg_dist_to_cbd_km, avg(latitude) AS centroid_lat, avg(longitude) AS centroid_lon,
         avg(zip_permit_count) AS avg_permit_activity, avg(zip_new_building_permits) AS avg_new_building_permits,
         avg(CASE WHEN sale_year = 2001 THEN price_per_sqft END) AS current_year_ppsf,
         avg(CASE WHEN sale_year = 2000 THEN price_per_sqft END) AS prior_year_ppsf
  FROM features GROUP BY neighborhood, borough_name HAVING count(*) >= 10)""") + """
SELECT *, (current_year_ppsf - prior_year_ppsf) / nullif(prior_year_ppsf, 0) AS yoy_ppsf_change,
       std_sale_price / nullif(avg_sale_price, 0) AS price_cv,
       avg_gross_sqft * total_transactions / 1000000 AS transaction_volume_score
FROM metrics ORDER BY avg_sale_price DESC""",
       floats="avg_sale_price median_sale_price std_sale_price avg_ppsf median_ppsf avg_gross_sqft avg_building_age "
              "avg_num_floors avg_far avg_commercial_ratio avg_dist_to_cbd_km centroid_lat centroid_lon "
              "avg_permit_activity avg_new_building_permits current_year_ppsf prior_year_ppsf yoy_ppsf_change price_cv "
              "transaction_volume_score")
def mart_segments_warehouse(spark, sf_dir):
    """23 metrics per neighbourhood and borough, at least ten sales (AG6, TK3)."""
    return marts.market_segments_warehouse(
        warehouse_features(spark, sf_dir, False, with_neighborhood=False), sales=warehouse_sales(spark, sf_dir, False))
