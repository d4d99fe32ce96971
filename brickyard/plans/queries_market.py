"""Queries for the market pages, features and encodings."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickyard import settings
from brickyard.functions.quantiles import exact_quantiles
from brickyard.operators import dashboards as pages
from brickyard.operators import encoding, features
from brickyard.operators.enrichment import merge_parcels
from brickyard.plans.oracle_views import PERMITS, PLUTO, SALES, STAGED_PLUTO, STAGED_SALES, VIOLATIONS, haversine
from brickyard.plans.queries_layers import staged_parcels, staged_sales
from brickyard.plans.registry import ctes, query
from brickyard.session import written
from brickyard.sources import adapters

C = F.col
_LOGS = ", ".join(f"CASE WHEN p.{c} IS NOT NULL THEN ln(1 + greatest(p.{c}, 0)) END AS log_{c}" for c in features.LOG_COLUMNS)
_DISTS = ", ".join(f"{haversine('p.latitude', 'p.longitude', a, b)} AS dist_to_{n}_km" for n, (a, b) in settings.LANDMARKS.items())
FEATURED = f"""featured AS (
  SELECT s.*, p.* EXCLUDE (bbl, block, lot, address, borough_name),
         CASE WHEN 2001 - p.yearbuilt BETWEEN 0 AND 300 THEN 2001 - p.yearbuilt END AS building_age,
         p.bldgarea / nullif(p.lotarea, 0) AS floor_area_ratio, p.comarea / nullif(p.bldgarea, 0) AS commercial_ratio,
         CASE WHEN 2001 - p.yearalter1 <= 15 THEN 1 ELSE 0 END AS is_recently_renovated, {_LOGS}, {_DISTS},
         CASE WHEN p.borocode = 1 THEN 1 ELSE 0 END AS is_manhattan,
         CASE WHEN p.numfloors <= 0 THEN NULL WHEN p.numfloors <= 5 THEN 'low_rise' WHEN p.numfloors <= 15 THEN 'mid_rise'
              WHEN p.numfloors <= 30 THEN 'high_rise' WHEN p.numfloors <= 60 THEN 'tower'
              WHEN p.numfloors <= 200 THEN 'supertall' END AS height_category,
         h.avg_price AS neighborhood_avg_price, h.median_price AS neighborhood_median_price,
         h.n AS neighborhood_sales_volume, h.sd AS neighborhood_price_std,
         s.sale_price / nullif(h.avg_price, 0) AS price_vs_neighborhood,
         coalesce(a.n, 0) AS neighborhood_permit_activity, coalesce(v.n, 0) AS borough_violation_count
  FROM staged s LEFT JOIN parcels p USING (bbl)
  LEFT JOIN (SELECT neighborhood, avg(sale_price) AS avg_price, median(sale_price) AS median_price,
                    count(sale_price) AS n, stddev(sale_price) AS sd FROM staged GROUP BY 1) h USING (neighborhood)
  LEFT JOIN (SELECT zip_code, count(*) AS n FROM permits GROUP BY 1) a USING (zip_code)
  LEFT JOIN (SELECT boroid, count(*) AS n FROM violations GROUP BY 1) v ON CAST(s.borough AS VARCHAR) = v.boroid)"""
FEATURES = (SALES, STAGED_SALES, PLUTO, STAGED_PLUTO, PERMITS, VIOLATIONS, FEATURED)
# a stand-in probability and cluster, so that pages which need model output can be checked in SQL
SCORED = """scored AS (
  SELECT *, p AS distress_probability, CASE WHEN p <= 0 THEN NULL WHEN p <= CAST(0.15 AS DOUBLE) THEN 'Low Risk'
            WHEN p <= CAST(0.35 AS DOUBLE) THEN 'Moderate Risk' WHEN p <= CAST(0.6 AS DOUBLE) THEN 'Elevated Risk'
            WHEN p <= 1 THEN 'High Risk' END AS risk_tier
  FROM (SELECT *, 1 / (1 + price_vs_neighborhood * price_vs_neighborhood) AS p, sale_quarter - 2 AS cluster FROM featured))"""
SCORED_ALL = (*FEATURES, SCORED)


def featured(spark, sf_dir, with_class=True):
    return features.base_features(staged_parcels(spark, sf_dir), staged_sales(spark, sf_dir, with_class),
                                  adapters.permits(spark, sf_dir), adapters.violations(spark, sf_dir))


def stored(spark, sf_dir, *columns):
    """The named feature columns as a written table, for readers that pass over them more than once."""
    return written(featured(spark, sf_dir, False), list(columns))


def scored(spark, sf_dir, features_table=None):
    pvn = C("price_vs_neighborhood")
    out = featured(spark, sf_dir, False) if features_table is None else features_table
    out = out.withColumns({"distress_probability": 1 / (1 + pvn * pvn), "cluster": C("sale_quarter") - 2})
    return out.withColumn("risk_tier", pages.risk_tier(C("distress_probability")))


def priced(spark, sf_dir):
    """Sales with building age, without the wide context."""
    return features.add_property_features(
        staged_sales(spark, sf_dir, False).withColumn("yearbuilt", C("year_built")))


PRICED = """priced AS (SELECT *, 2001 - year_built AS building_age FROM staged)"""
SALES_ONLY = (SALES, STAGED_SALES, PRICED)


# --- features -------------------------------------------------------------
@query("fe02_geography", ctes(*FEATURES) + f"""
SELECT sale_id, bbl, {', '.join(f'dist_to_{n}_km' for n in settings.LANDMARKS)}, dist_to_grand_central_km AS dist_to_cbd_km,
       least({', '.join(f'dist_to_{n}_km' for n in settings.LANDMARKS)}) AS min_landmark_dist_km, is_manhattan FROM featured""",
       floats=" ".join(f"dist_to_{n}_km" for n in settings.LANDMARKS) + " dist_to_cbd_km min_landmark_dist_km")
def geography(spark, sf_dir):
    """Haversine distances to the landmarks (FE1, FE2)."""
    merged = merge_parcels(staged_sales(spark, sf_dir, False), staged_parcels(spark, sf_dir))
    return features.add_geography(merged).select(
        "sale_id", "bbl", *[f"dist_to_{n}_km" for n in settings.LANDMARKS], "dist_to_cbd_km", "min_landmark_dist_km", "is_manhattan")


@query("fe04_property_features", ctes(*FEATURES) + """
SELECT sale_id, bbl, building_age, price_per_sqft, floor_area_ratio, commercial_ratio, is_recently_renovated,
       log_assesstot, log_assessland, log_bldgarea, log_lotarea, height_category FROM featured""",
       floats="building_age price_per_sqft floor_area_ratio commercial_ratio log_assesstot log_assessland log_bldgarea log_lotarea")
def property_columns(spark, sf_dir):
    """Age, ratios, renovation flag, logs, height class (FE4-FE8a)."""
    merged = merge_parcels(staged_sales(spark, sf_dir, False), staged_parcels(spark, sf_dir))
    return features.add_property_features(merged).select(
        "sale_id", "bbl", "building_age", "price_per_sqft", "floor_area_ratio", "commercial_ratio", "is_recently_renovated",
        "log_assesstot", "log_assessland", "log_bldgarea", "log_lotarea", "height_category")


@query("fe10_one_hot", ctes(SALES, STAGED_SALES) + """
SELECT sale_id, bbl, borough_name, CAST(borough_name = 'Brooklyn' AS INT) AS borough_name_Brooklyn,
       CAST(borough_name = 'Manhattan' AS INT) AS borough_name_Manhattan, CAST(borough_name = 'Queens' AS INT) AS borough_name_Queens,
       CAST(borough_name = 'Staten Island' AS INT) AS borough_name_Staten_Island FROM staged""")
def one_hot(spark, sf_dir):
    out = encoding.one_hot(staged_sales(spark, sf_dir, False), "borough_name")
    return out.select("sale_id", "bbl", "borough_name", "borough_name_Brooklyn", "borough_name_Manhattan", "borough_name_Queens",
                      C("`borough_name_Staten Island`").alias("borough_name_Staten_Island"))


@query("fe11_label_encode", ctes(SALES, STAGED_SALES) + """
SELECT sale_id, bbl, building_class_category,
       CAST(dense_rank() OVER (ORDER BY building_class_category) - 1 AS DOUBLE) AS building_class_category_encoded FROM staged""",
       floats="building_class_category_encoded")
def label_encode(spark, sf_dir):
    return encoding.label_encode(staged_sales(spark, sf_dir), "building_class_category").select(
        "sale_id", "bbl", "building_class_category", "building_class_category_encoded")


@query("fe12_target_encode", ctes(SALES, STAGED_SALES, """
cells AS (SELECT neighborhood, sale_id % 5 AS fold, sum(sale_price) AS s, count(sale_price) AS n FROM staged GROUP BY ALL),
totals AS (SELECT neighborhood, sum(s) AS s, sum(n) AS n FROM cells GROUP BY 1),
overall AS (SELECT avg(sale_price) AS mean FROM staged)""") + """
SELECT sale_id, bbl, r.neighborhood,
       CASE WHEN t.n = c.n THEN mean ELSE (t.s - c.s + 10 * mean) / (t.n - c.n + 10) END AS neighborhood_target_encoded,
       (t.s + 10 * mean) / (t.n + 10) AS neighborhood_target_encoded_global
FROM staged r JOIN cells c ON c.neighborhood = r.neighborhood AND c.fold = r.sale_id % 5
JOIN totals t ON t.neighborhood = r.neighborhood, overall""",
       floats="neighborhood_target_encoded neighborhood_target_encoded_global")
def target_encode(spark, sf_dir):
    """Out-of-fold and global smoothed means (FE12, FE13, JN13)."""
    return encoding.target_encode(staged_sales(spark, sf_dir, False), "neighborhood", "sale_price", "sale_id").select(
        "sale_id", "bbl", "neighborhood", "neighborhood_target_encoded", "neighborhood_target_encoded_global")


# sales beside their parcels, with every column that the merge gives
MERGED = """merged AS (
  SELECT s.* EXCLUDE (building_class_category, building_class_at_sale, tax_class_at_sale, l_tax), building_class_at_sale AS building_class_at_time_of_sale,
         tax_class_at_sale AS tax_class_at_time_of_sale, p.* EXCLUDE (bbl, block, lot, address, borough_name), p.block AS block_pluto, p.lot AS lot_pluto,
         p.address AS address_pluto, p.borough_name AS borough_name_pluto, CAST(NULL AS VARCHAR) AS overlay1, CAST(NULL AS INTEGER) AS yearalter2
  FROM staged s LEFT JOIN parcels p USING (bbl))"""
MERGE = (SALES, STAGED_SALES, PLUTO, STAGED_PLUTO, MERGED)
_WHOLE = "sale_id borough total_units commercial_units year_built sale_year sale_month sale_quarter"
_PRICES = "sale_price land_square_feet"
_GAPS = ("gross_square_feet price_per_sqft borocode lotarea bldgarea comarea resarea officearea retailarea numfloors unitstotal unitsres yearbuilt yearalter1 "
         "assesstot assessland latitude longitude")
_NAMES = "bbl block lot neighborhood address zip_code building_class_at_time_of_sale tax_class_at_time_of_sale borough_name"
_GAP_NAMES = "zipcode landuse bldgclass zonedist1 ownername block_pluto lot_pluto address_pluto borough_name_pluto"
_EVERY = " ".join([_WHOLE, _PRICES, _GAPS, _NAMES, _GAP_NAMES, "sale_date overlay1 yearalter2"])


def merged_sales(spark, sf_dir):
    return merge_parcels(staged_sales(spark, sf_dir, False), staged_parcels(spark, sf_dir))


def _mode(column: str) -> str:
    return f"(SELECT {column} FROM merged WHERE {column} IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1)"


@query("ag21_missing_fractions", ctes(*MERGE) + f"""
SELECT {', '.join(f'avg(CAST({c} IS NULL AS INT)) AS {c}' for c in _EVERY.split())} FROM merged""", floats=_EVERY)
def missing(spark, sf_dir):
    """Share of gaps of every column of the merged table (AG21)."""
    return encoding.missing_fractions(merged_sales(spark, sf_dir))


@query("fe14_sparseness", ctes(*MERGE, f"""
middle AS (SELECT {', '.join(f'median({c}) AS m_{c}' for c in _GAPS.split())}, {', '.join(f'{_mode(c)} AS m_{c}' for c in _GAP_NAMES.split())} FROM merged)""") + f"""
SELECT {', '.join([_WHOLE, _PRICES, _NAMES, 'sale_date'][i].replace(' ', ', ') for i in range(4))},
       {', '.join(f'coalesce(CAST({c} AS DOUBLE), m_{c}) AS {c}' for c in _GAPS.split())},
       {', '.join(f'coalesce({c}, m_{c}) AS {c}' for c in _GAP_NAMES.split())} FROM merged, middle""", floats=f"{_PRICES} {_GAPS}")
def sparseness(spark, sf_dir):
    """The merged table without its empty columns, medians and modes filled in (FE14-16, AG22)."""
    return encoding.handle_sparseness(merged_sales(spark, sf_dir))


@query("ag22_column_modes", ctes(*MERGE) + " UNION ALL ".join(
    f"""SELECT '{c}' AS "column", {_mode(c)} AS mode""" for c in f"{_NAMES} {_GAP_NAMES}".split()))
def modes(spark, sf_dir):
    """Commonest value of every text column with values (AG22)."""
    return encoding.column_modes(merged_sales(spark, sf_dir), f"{_NAMES} {_GAP_NAMES}".split())


_SCALED = f"{_WHOLE} {_PRICES} {_GAPS}".split()[1:]


@query("fe17_standardise", ctes(*MERGE, f"""
size AS (SELECT {', '.join(f'avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}' for c in _SCALED)} FROM merged)""") + f"""
SELECT sale_id, bbl, {', '.join(f'({c} - a_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS z_{c}' for c in _SCALED)} FROM merged, size""",
       floats=" ".join(f"z_{c}" for c in _SCALED))
def standardise(spark, sf_dir):
    """Every numeric column but the row's number, standardised (FE17)."""
    return encoding.standardise(merged_sales(spark, sf_dir), _SCALED).select("sale_id", "bbl", *[f"z_{c}" for c in _SCALED])


@query("fe18_principal_components", ctes(SALES, STAGED_SALES, """
z AS (SELECT sale_id, bbl, (sale_price - avg(sale_price) OVER ()) / stddev_pop(sale_price) OVER () AS a,
             (land_square_feet - avg(land_square_feet) OVER ()) / stddev_pop(land_square_feet) OVER () AS b FROM staged)""") + """
SELECT sale_id, bbl, (a + b) / sqrt(CAST(2 AS DOUBLE)) AS pca_1, abs((a - b) / sqrt(CAST(2 AS DOUBLE))) AS abs_pca_2 FROM z""",
       floats="pca_1 abs_pca_2")
def principal_components(spark, sf_dir):
    """Two positively related standardised features: the components are their sum and difference over root two."""
    sales = staged_sales(spark, sf_dir, False).select("sale_id", "bbl", "sale_price", "land_square_feet")
    out, _ = encoding.principal_components(sales, ["sale_price", "land_square_feet"], n=2, variance=None)
    return out.select("sale_id", "bbl", "pca_1", F.abs("pca_2").alias("abs_pca_2"))


@query("fe19_engineered_features", ctes(*FEATURES, """
cells AS (SELECT neighborhood, sale_id % 5 AS fold, sum(sale_price) AS s, count(sale_price) AS n FROM staged GROUP BY ALL),
totals AS (SELECT neighborhood, sum(s) AS s, sum(n) AS n FROM cells GROUP BY 1),
overall AS (SELECT avg(sale_price) AS mean, (SELECT median(numfloors) FROM featured) AS floors,
            (SELECT median(building_age) FROM featured) AS age, (SELECT median(commercial_ratio) FROM featured) AS ratio,
            (SELECT median(dist_to_grand_central_km) FROM featured) AS dist,
            (SELECT height_category FROM featured WHERE height_category IS NOT NULL GROUP BY 1 ORDER BY count(*) DESC, 1 LIMIT 1) AS height
            FROM staged)""") + """
SELECT f.sale_id, f.bbl, f.sale_price, coalesce(f.numfloors, floors) AS numfloors, coalesce(f.building_age, age) AS building_age,
       coalesce(f.commercial_ratio, ratio) AS commercial_ratio, coalesce(f.dist_to_grand_central_km, dist) AS dist_to_cbd_km,
       coalesce(f.height_category, height) AS height_category, f.price_vs_neighborhood,
       CAST(f.borough_name = 'Queens' AS INT) AS borough_name_Queens,
       CASE WHEN t.n = c.n THEN mean ELSE (t.s - c.s + 10 * mean) / (t.n - c.n + 10) END AS neighborhood_target_encoded
FROM featured f JOIN cells c ON c.neighborhood = f.neighborhood AND c.fold = f.sale_id % 5
JOIN totals t ON t.neighborhood = f.neighborhood, overall""",
       floats="sale_price numfloors building_age commercial_ratio dist_to_cbd_km price_vs_neighborhood neighborhood_target_encoded")
def engineered(spark, sf_dir):
    """The whole feature table: merge, geography, property, market, encoding, imputation (FE19)."""
    out = features.engineer_features(staged_parcels(spark, sf_dir), staged_sales(spark, sf_dir), adapters.permits(spark, sf_dir),
                                     adapters.violations(spark, sf_dir), fold_key="sale_id")
    return out.select("sale_id", "bbl", "sale_price", "numfloors", "building_age", "commercial_ratio", "dist_to_cbd_km",
                      "height_category", "price_vs_neighborhood", "borough_name_Queens", "neighborhood_target_encoded")


# --- market pages ---------------------------------------------------------
@query("ag07_kpi_row", ctes(*SALES_ONLY, """
yearly AS (SELECT sale_year, median(price_per_sqft) AS m FROM priced GROUP BY 1),
last_change AS (SELECT (m / lag(m) OVER (ORDER BY sale_year) - 1) * 100 AS change, sale_year FROM yearly)""") + """
SELECT sum(sale_price) / 1e9 AS total_billion, count(*) AS n_transactions, avg(building_age) AS avg_building_age,
       median(price_per_sqft) AS median_ppsf, (SELECT arg_max(change, sale_year) FROM last_change) AS yoy_pct FROM priced""",
       floats="total_billion avg_building_age median_ppsf yoy_pct")
def kpi_row(spark, sf_dir):
    return pages.kpi_row(priced(spark, sf_dir))


@query("ag08_yearly_volume", ctes(*SALES_ONLY) + """
SELECT sale_year, count(sale_price) AS n_sales, sum(sale_price) AS total_value FROM priced GROUP BY 1""", floats="total_value", digits=1)
def yearly_volume(spark, sf_dir):
    return pages.yearly_volume(priced(spark, sf_dir))


@query("ag09_borough_summary", ctes(*SALES_ONLY) + """
SELECT borough_name, count(sale_price) AS n_sales, round_even(avg(sale_price), 0) AS avg_price,
       round_even(avg(price_per_sqft), 0) AS avg_ppsf, round_even(avg(building_age), 0) AS avg_age,
       round_even(median(sale_price), 0) AS median_price, round_even(median(price_per_sqft), 0) AS median_ppsf
FROM priced GROUP BY 1 ORDER BY median_price DESC""", floats="avg_price avg_ppsf avg_age median_price median_ppsf")
def borough_summary(spark, sf_dir):
    return pages.borough_summary(priced(spark, sf_dir))


@query("ag10_quarterly_ppsf", ctes(*SALES_ONLY) + """
SELECT CAST(date_trunc('quarter', sale_date) AS DATE) AS quarter, borough_name, count(*) AS n_sales,
       median(price_per_sqft) AS median_ppsf FROM priced GROUP BY 1, 2""", floats="median_ppsf")
def quarterly_ppsf(spark, sf_dir):
    return pages.quarterly_ppsf(priced(spark, sf_dir))


@query("ag11_annual_metrics", ctes(*SALES_ONLY, """
yearly AS (SELECT sale_year, avg(building_age) AS avg_building_age, median(sale_price) AS median_price,
           median(price_per_sqft) AS median_ppsf FROM priced GROUP BY 1)""") + """
SELECT *, (median_ppsf / lag(median_ppsf) OVER (ORDER BY sale_year) - 1) * 100 AS price_yoy_pct FROM yearly""",
       floats="avg_building_age median_price median_ppsf price_yoy_pct")
def annual_metrics(spark, sf_dir):
    return pages.annual_metrics(priced(spark, sf_dir))


@query("ag12_cluster_medians", ctes(*SCORED_ALL) + """
SELECT cluster, count(sale_price) AS n_sales, median(price_per_sqft) AS median_price_per_sqft,
       median(gross_square_feet) AS median_gross_square_feet, median(building_age) AS median_building_age,
       median(dist_to_grand_central_km) AS median_dist_to_cbd_km FROM scored GROUP BY 1""",
       floats="median_price_per_sqft median_gross_square_feet median_building_age median_dist_to_cbd_km")
def cluster_medians(spark, sf_dir):
    table = stored(spark, sf_dir, "sale_quarter", "sale_price", "price_per_sqft", "gross_square_feet", "building_age",
                   "dist_to_cbd_km", "price_vs_neighborhood")
    return pages.cluster_medians(scored(spark, sf_dir, table))


@query("ag12_cluster_sizes", ctes(*SCORED_ALL) + "SELECT cluster, count(*) AS n_properties FROM scored GROUP BY 1")
def cluster_sizes(spark, sf_dir):
    return pages.cluster_sizes(scored(spark, sf_dir))


@query("ag14_risk_tiers", ctes(*SCORED_ALL) + """
SELECT count(*) FILTER (WHERE risk_tier = 'Low Risk') AS low_risk, count(*) FILTER (WHERE risk_tier = 'Moderate Risk') AS moderate_risk,
       count(*) FILTER (WHERE risk_tier = 'Elevated Risk') AS elevated_risk, count(*) FILTER (WHERE risk_tier = 'High Risk') AS high_risk
FROM scored""")
def risk_tiers(spark, sf_dir):
    return pages.risk_tier_counts(scored(spark, sf_dir))


@query("ag14_risk_by_borough", ctes(*SCORED_ALL) + """
SELECT borough_name, avg(distress_probability) AS avg_distress FROM scored GROUP BY 1 ORDER BY 2 DESC""", floats="avg_distress", digits=6)
def risk_by_borough(spark, sf_dir):
    return pages.risk_by_borough(scored(spark, sf_dir))


@query("ag15_risk_by_neighborhood", ctes(*SCORED_ALL) + """
SELECT neighborhood, avg(distress_probability) AS avg_distress, count(sale_price) AS n_properties FROM scored
GROUP BY 1 HAVING count(sale_price) >= 10 ORDER BY 2 DESC, 1 LIMIT 20""", floats="avg_distress", digits=6)
def risk_by_neighborhood(spark, sf_dir):
    return pages.risk_by_neighborhood(scored(spark, sf_dir))


@query("ag16_market_activity", ctes(*SALES_ONLY) + """
SELECT borough_name, neighborhood, count(*) AS transactions FROM priced GROUP BY ROLLUP (borough_name, neighborhood)""")
def market_activity(spark, sf_dir):
    return pages.market_activity(priced(spark, sf_dir))


@query("ag17_histogram", ctes(*SALES_ONLY) + """
SELECT borough_name, CAST(least(floor((price_per_sqft - lo) / (hi - lo) * 50), 49) AS INT) AS bin, count(*) AS n
FROM priced, (SELECT min(price_per_sqft) AS lo, max(price_per_sqft) AS hi FROM priced)
WHERE price_per_sqft IS NOT NULL GROUP BY 1, 2""")
def histogram(spark, sf_dir):
    return pages.histogram(priced(spark, sf_dir), "price_per_sqft", 50, ["borough_name"])


@query("ag18_box_stats", ctes(*SALES_ONLY) + """
SELECT borough_name, min(price_per_sqft) AS low, quantile_cont(price_per_sqft, 0.25) AS q1, median(price_per_sqft) AS median,
       quantile_cont(price_per_sqft, 0.75) AS q3, max(price_per_sqft) AS high, count(*) AS n
FROM priced WHERE price_per_sqft > 0 GROUP BY 1""", floats="low q1 median q3 high")
def box_stats(spark, sf_dir):
    return pages.box_stats(priced(spark, sf_dir), "price_per_sqft", "borough_name")


@query("ag19_quantile_thresholds", ctes(*SALES_ONLY) + """
SELECT quantile_cont(price_per_sqft, 0.10) AS p10, quantile_cont(price_per_sqft, 0.50) AS p50,
       quantile_cont(price_per_sqft, 0.75) AS p75, quantile_cont(sale_price, 0.75) AS price_p75 FROM priced""",
       floats="p10 p50 p75 price_p75")
def quantile_thresholds(spark, sf_dir):
    return exact_quantiles(priced(spark, sf_dir), [], {
        "p10": ("price_per_sqft", 0.1), "p50": ("price_per_sqft", 0.5), "p75": ("price_per_sqft", 0.75), "price_p75": ("sale_price", 0.75)})


@query("ag20_category_frequency", ctes(SALES, STAGED_SALES) + """
SELECT building_class_category, count(*) AS n FROM staged GROUP BY 1""")
def category_frequency(spark, sf_dir):
    return staged_sales(spark, sf_dir).groupBy("building_class_category").agg(F.count(F.lit(1)).alias("n"))


@query("ag23_neighborhood_rollup", ctes(*FEATURES) + """
SELECT neighborhood, avg(sale_price) AS avg_price, count(sale_price) AS n_transactions, avg(price_per_sqft) AS avg_ppsf,
       avg(building_age) AS avg_building_age, avg(dist_to_grand_central_km) AS avg_dist_cbd, avg(latitude) AS centroid_lat,
       avg(longitude) AS centroid_lon, median(sale_price) AS median_price, median(price_per_sqft) AS median_ppsf
FROM featured GROUP BY 1""",
       floats="avg_price avg_ppsf avg_building_age avg_dist_cbd centroid_lat centroid_lon median_price median_ppsf")
def neighborhood_rollup(spark, sf_dir):
    return pages.neighborhood_rollup(stored(spark, sf_dir, "neighborhood", "sale_price", "price_per_sqft", "building_age",
                                            "dist_to_cbd_km", "latitude", "longitude"))


@query("tk02_highest_risk", ctes(*SCORED_ALL) + """
SELECT bbl, neighborhood, borough_name, sale_price, price_per_sqft, distress_probability, risk_tier FROM scored
ORDER BY distress_probability DESC, bbl, sale_price, price_per_sqft LIMIT 20""",
       floats="sale_price price_per_sqft distress_probability", digits=6)
def highest_risk(spark, sf_dir):
    rows = scored(spark, sf_dir).select("bbl", "neighborhood", "borough_name", "sale_price", "price_per_sqft", "distress_probability", "risk_tier")
    return pages.top_rows(rows, "distress_probability", 20, ["bbl", "sale_price", "price_per_sqft"])


@query("tk06_marker_colors", ctes(*SALES_ONLY) + """
SELECT CASE WHEN price_per_sqft IS NULL THEN 'gray' WHEN price_per_sqft > q75 THEN 'red' WHEN price_per_sqft > q50 THEN 'orange'
            ELSE 'green' END AS marker_color, count(*) AS n, sum(sale_price) AS total
FROM priced, (SELECT median(price_per_sqft) AS q50, quantile_cont(price_per_sqft, 0.75) AS q75 FROM priced) GROUP BY 1""",
       floats="total", digits=1)
def marker_colors(spark, sf_dir):
    return pages.marker_colors(priced(spark, sf_dir), "price_per_sqft").groupBy("marker_color").agg(
        F.count(F.lit(1)).alias("n"), F.sum("sale_price").alias("total"))


@query("stg23_filtered_sales", ctes(*SALES_ONLY) + """
SELECT sale_id, bbl, borough_name, sale_price FROM priced WHERE borough_name IN ('Bronx', 'Queens') AND sale_price BETWEEN 500000 AND 1500000""",
       floats="sale_price")
def filtered_sales(spark, sf_dir):
    return pages.apply_filters(priced(spark, sf_dir), ["Bronx", "Queens"], (0.5, 1.5)).select("sale_id", "bbl", "borough_name", "sale_price")


@query("stg24_harmonised", ctes(SALES) + """
SELECT bbl, borough, CASE borough WHEN 1 THEN 'Manhattan' WHEN 2 THEN 'Bronx' WHEN 3 THEN 'Brooklyn' WHEN 4 THEN 'Queens'
         WHEN 5 THEN 'Staten Island' END AS borough_name, year(sale_date) AS sale_year, count(*) AS n,
       avg(sale_price / nullif(gross_square_feet, 0)) AS avg_ppsf FROM sales GROUP BY ALL""", floats="avg_ppsf")
def harmonised(spark, sf_dir):
    return pages.harmonise(adapters.sales(spark, sf_dir, False)).groupBy("bbl", "borough", "borough_name", "sale_year").agg(
        F.count(F.lit(1)).alias("n"), F.avg("price_per_sqft").alias("avg_ppsf"))


@query("rp02_distance_price_points")
def distance_price_points(spark, sf_dir):
    """Repeatable sample of at most 4000 points for a scatter plot (RP2, TK5)."""
    return pages.distance_price_points(featured(spark, sf_dir, False))


@query("rp03_parallel_coordinates")
def parallel_coordinates(spark, sf_dir):
    return pages.parallel_coordinates(scored(spark, sf_dir))


@query("rp04_size_price_points")
def size_price_points(spark, sf_dir):
    return pages.size_price_points(pages.harmonise(featured(spark, sf_dir, False)))
