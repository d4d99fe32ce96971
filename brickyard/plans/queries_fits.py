"""Queries that fit models on the whole feature table."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import functions as F

from brickyard.operators import density, distress, distress_model, features, reports, segments, valuation
from brickyard.plans.oracle_views import SALES, STAGED_SALES
from brickyard.plans.queries_layers import staged_parcels, staged_sales
from brickyard.plans.queries_market import SCORED_ALL, scored, stored
from brickyard.plans.registry import ctes, query
from brickyard.sources import adapters

C = F.col


def model_table(spark, sf_dir):
    """The whole feature table, encoded and imputed."""
    return features.engineer_features(staged_parcels(spark, sf_dir), staged_sales(spark, sf_dir), adapters.permits(spark, sf_dir),
                                      adapters.violations(spark, sf_dir))


@query("hr02_ols_two_features", ctes(SALES, STAGED_SALES, """
d AS (SELECT ln(1 + sale_price) AS y, land_square_feet AS x FROM staged),
b AS (SELECT regr_slope(y, x) AS slope, regr_intercept(y, x) AS icept, avg(x) AS mx, regr_sxx(y, x) AS sxx, count(*) AS n, regr_r2(y, x) AS r2 FROM d),
e AS (SELECT x, y - icept - slope * x AS r, 1 / CAST(n AS DOUBLE) + (x - mx) * (x - mx) / sxx AS h FROM d, b),
v AS (SELECT sum((x - mx) * (x - mx) * r * r / ((1 - h) * (1 - h))) / any_value(sxx * sxx) AS var_slope,
             sum(pow(1 / CAST(n AS DOUBLE) - mx * (x - mx) / sxx, 2) * r * r / ((1 - h) * (1 - h))) AS var_icept FROM e, b)""") + """
SELECT 'const' AS feature, icept AS coefficient, sqrt(var_icept) AS std_error, r2 AS r_squared FROM b, v
UNION ALL SELECT 'land_square_feet', slope, sqrt(var_slope), r2 FROM b, v""",
       floats="coefficient std_error r_squared", digits=8)
def ols_one_feature(spark, sf_dir):
    """Least squares with HC3 errors on one feature, where SQL has the closed form (HR2, HR3)."""
    fit, table = valuation.fit_ols(staged_sales(spark, sf_dir, False).select("sale_price", "land_square_feet"), ["land_square_feet"])
    rows = [(r["feature"], r["coefficient"], r["std_error"], fit["r_squared"]) for r in table]
    return spark.createDataFrame(rows, "feature string, coefficient double, std_error double, r_squared double")


@query("hr03_ols_coefficients")
def ols_coefficients(spark, sf_dir):
    """Coefficient table of the full hedonic regression (HR1-HR3)."""
    _, table = valuation.fit_ols(model_table(spark, sf_dir))
    return spark.createDataFrame(table, "feature string, coefficient double, std_error double, t_statistic double, p_value double, "
                                        "ci_lower double, ci_upper double, pct_impact double")


@query("hr04_penalised_models")
def penalised(spark, sf_dir):
    """Ridge, lasso and elastic net with their cross-validated penalties (HR4, HR7)."""
    rows = [m.results for m in valuation.fit_penalised(model_table(spark, sf_dir), ["ridge", "lasso", "elasticnet"]).values()]
    return spark.createDataFrame([(r["model"], r["best_alpha"], r["cv_r2_mean"], r["train_r2"], r["test_r2"], r["test_rmse"], r["test_mae"],
                                   r["test_mape"], r["n_train"], r["n_test"]) for r in rows],
                                 "model string, best_alpha double, cv_r2_mean double, train_r2 double, test_r2 double, test_rmse double, "
                                 "test_mae double, test_mape double, n_train long, n_test long")


@query("hr07_prediction_metrics", ctes(SALES, STAGED_SALES, """
p AS (SELECT borough_name, ln(1 + sale_price) AS y, ln(1 + land_square_feet * 1000) AS yhat FROM staged)""") + """
SELECT borough_name, 1 - sum((y - yhat) * (y - yhat)) / (var_pop(y) * count(*)) AS r2, sqrt(avg((y - yhat) * (y - yhat))) AS rmse,
       avg(abs(y - yhat)) AS mae, avg(abs(exp(y) - exp(yhat)) / abs(exp(y) - 1)) AS mape, count(*) AS n_rows FROM p GROUP BY 1""",
       floats="r2 rmse mae mape", digits=6)
def prediction_metrics(spark, sf_dir):
    rows = staged_sales(spark, sf_dir, False).select(
        "borough_name", F.log1p("sale_price").alias("y"), F.log1p(C("land_square_feet") * 1000).alias("prediction"))
    return valuation.prediction_metrics(rows, keys=["borough_name"])


@query("hr05_boosted_scores")
def boosted_scores(spark, sf_dir):
    """Boosted trees and the prices they predict for every complete sale (HR5, HR8)."""
    table = model_table(spark, sf_dir)
    model = valuation.fit_gradient_boosting(table)
    return valuation.predict_value(table, boosted=model).select("sale_id", "bbl", "sale_price", "predicted_value")


@query("hr06_stacked_ensemble")
def stacked(spark, sf_dir):
    """Stack of ridge, boosted trees and a forest over five folds (HR6)."""
    model = valuation.StackedModel.fit(model_table(spark, sf_dir))
    return reports.leaderboard(spark, {"stacked_ensemble": model.results})


@query("rp01_leaderboard")
def leaderboard(spark, sf_dir):
    """Leaderboard of the linear models (RP1)."""
    table = model_table(spark, sf_dir)
    fits = {kind: m.results for kind, m in valuation.fit_penalised(table, ["ridge", "lasso"]).items()}
    fits["ols"] = valuation.fit_ols(table)[0]
    return reports.leaderboard(spark, fits)


# --- segments -------------------------------------------------------------
def segment_table(spark, sf_dir):
    return stored(spark, sf_dir, "sale_id", "bbl", "price_per_sqft", "gross_square_feet", "building_age", "numfloors", "floor_area_ratio",
                  "commercial_ratio", "dist_to_cbd_km", "assesstot")


SEGMENT = ["price_per_sqft", "gross_square_feet", "building_age", "numfloors", "floor_area_ratio", "commercial_ratio", "dist_to_cbd_km", "assesstot"]
SCALED = f"""c AS (SELECT sale_id, bbl, {', '.join(SEGMENT)} FROM (SELECT *, dist_to_grand_central_km AS dist_to_cbd_km FROM scored)
     WHERE {' AND '.join(f'{c} IS NOT NULL' for c in SEGMENT)}),
size AS (SELECT {', '.join(f'avg({c}) AS a_{c}, stddev_pop({c}) AS s_{c}' for c in SEGMENT)} FROM c),
z AS (SELECT sale_id, bbl, {', '.join(f'({c} - a_{c}) / CASE WHEN s_{c} = 0 THEN 1 ELSE s_{c} END AS z_{c}' for c in SEGMENT)} FROM c, size)"""


@query("cl01_scaled_features", ctes(*SCORED_ALL, SCALED) + "SELECT * FROM z", floats=" ".join(f"z_{c}" for c in SEGMENT))
def scaled_features(spark, sf_dir):
    """Complete rows on the segments' standardised features (CL1)."""
    rows, _, _ = segments.prepare(segment_table(spark, sf_dir))
    return rows.select("sale_id", "bbl", *[f"z_{c}" for c in SEGMENT])


@query("cl02_cluster_search")
def cluster_search(spark, sf_dir):
    """Cost, silhouette and Calinski-Harabasz for k = 2..12 (CL2)."""
    rows = segments.search_k(segment_table(spark, sf_dir))
    return spark.createDataFrame([(r["k"], r["inertia"], r["silhouette"], r["calinski_harabasz"], r["is_best"]) for r in rows],
                                 "k int, inertia double, silhouette double, calinski_harabasz double, is_best int")


@query("cl03_kmeans_clusters")
def kmeans_clusters(spark, sf_dir):
    """Cluster of every complete sale (CL3)."""
    return segments.fit_kmeans(segment_table(spark, sf_dir))[0].select("sale_id", "bbl", "cluster")


@query("cl05_silhouette", """
WITH pairs AS (SELECT a.vec_id, a.label AS mine, b.label AS other,
    sum(pow(list_distance(CAST(a.embedding AS DOUBLE[]), CAST(b.embedding AS DOUBLE[])), 2)) AS total, count(*) AS n
  FROM embeddings a, embeddings b WHERE a.vec_id <> b.vec_id GROUP BY 1, 2, 3),
s AS (SELECT vec_id, mine, max(CASE WHEN other = mine THEN total / n END) AS a, min(CASE WHEN other <> mine THEN total / n END) AS b FROM pairs GROUP BY 1, 2)
SELECT avg(CASE WHEN a IS NULL THEN 0 ELSE (b - a) / greatest(a, b) END) AS silhouette FROM s""", floats="silhouette", digits=6)
def silhouette(spark, sf_dir):
    """Silhouette from cluster sums; the SQL twin averages all pairwise squared distances (CL5)."""
    vectors = adapters.labelled_vectors(spark, sf_dir).withColumn("features", array_to_vector("vector"))
    return spark.createDataFrame([(float(segments.silhouette(vectors)),)], "silhouette double")


@query("cl06_calinski_harabasz", """
WITH x AS (SELECT label, i, CAST(embedding[i] AS DOUBLE) AS v FROM embeddings, range(1, 65) AS t(i)),
m AS (SELECT label, i, avg(v) AS mean, count(*) AS n, var_pop(v) * count(*) AS w FROM x GROUP BY 1, 2),
g AS (SELECT i, avg(v) AS mean FROM x GROUP BY 1)
SELECT (sum(m.n * pow(m.mean - g.mean, 2)) / (count(DISTINCT label) - 1)) / (sum(w) / ((SELECT count(*) FROM embeddings) - count(DISTINCT label))) AS score
FROM m JOIN g USING (i)""", floats="score", digits=6)
def calinski_harabasz(spark, sf_dir):
    vectors = adapters.labelled_vectors(spark, sf_dir).withColumn("features", array_to_vector("vector"))
    return spark.createDataFrame([(segments.calinski_harabasz(vectors),)], "score double")


@query("ag13_cluster_profiles", ctes(*SCORED_ALL) + """
SELECT cluster, count(*) AS count, avg(price_per_sqft) AS price_per_sqft_mean, median(price_per_sqft) AS price_per_sqft_median,
       avg(building_age) AS building_age_mean, median(building_age) AS building_age_median, avg(assesstot) AS assesstot_mean,
       median(assesstot) AS assesstot_median, avg(latitude) AS centroid_lat, avg(longitude) AS centroid_lon, mode(borough_name ORDER BY borough_name) AS dominant_borough
FROM scored WHERE cluster <> -1 GROUP BY 1""",
       floats="price_per_sqft_mean price_per_sqft_median building_age_mean building_age_median assesstot_mean assesstot_median centroid_lat centroid_lon")
def cluster_profiles(spark, sf_dir):
    table = stored(spark, sf_dir, "sale_quarter", "price_vs_neighborhood", "price_per_sqft", "building_age", "assesstot", "latitude", "longitude", "borough_name")
    return segments.cluster_profiles(scored(spark, sf_dir, table))


DENSITY = (0.08, 80)  # radius and least weight of the registered density query


@query("cl07_density_clusters", ctes(*SCORED_ALL, """
c AS (SELECT sale_id, bbl, gross_square_feet AS g, building_age AS a FROM scored WHERE gross_square_feet IS NOT NULL AND building_age IS NOT NULL),
z AS (SELECT sale_id, bbl, (g - avg(g) OVER ()) / stddev_pop(g) OVER () AS g, (a - avg(a) OVER ()) / stddev_pop(a) OVER () AS a FROM c),
p AS (SELECT g, a, count(*) AS w FROM z GROUP BY 1, 2)""", f"""
near AS (SELECT x.g, x.a, y.g AS yg, y.a AS ya, y.w FROM p x JOIN p y
         ON (x.g - y.g) * (x.g - y.g) + (x.a - y.a) * (x.a - y.a) <= CAST({DENSITY[0] ** 2} AS DOUBLE)),
core AS (SELECT g, a, sum(w) >= {DENSITY[1]} AS is_core FROM near GROUP BY 1, 2),
state AS (SELECT n.g, n.a, bool_or(c.is_core) AS touched FROM near n JOIN core c ON c.g = n.yg AND c.a = n.ya GROUP BY 1, 2)""") + """
SELECT sale_id, bbl, CAST(is_core AS INT) AS is_core, CAST(NOT touched AS INT) AS is_noise
FROM z JOIN core USING (g, a) JOIN state USING (g, a)""")
def density_clusters(spark, sf_dir):
    """Density clusters over size and age (CL7); the SQL twin compares all pairs for the core and noise flags."""
    table = stored(spark, sf_dir, "sale_id", "bbl", "gross_square_feet", "building_age")
    out, _ = density.fit_dbscan(table, *DENSITY)
    return out.select("sale_id", "bbl", "is_core", (C("cluster") == -1).cast("int").alias("is_noise"))


@query("cl08_projection")
def projection(spark, sf_dir):
    return segments.projection(segment_table(spark, sf_dir)).select("sale_id", "bbl", "pca_1", "pca_2")


# --- distress model -------------------------------------------------------
@query("ds03_distress_scores")
def distress_scores(spark, sf_dir):
    """Calibrated probabilities and risk tiers of all sales from boosted trees (DS3, DS4, DS6, DS7)."""
    table = distress.distress_labels(model_table(spark, sf_dir), adapters.violations(spark, sf_dir))
    model = distress_model.fit_distress(table)
    return model.score(table).select("sale_id", "bbl", "is_distressed", "distress_probability", "risk_tier")


@query("ds07_risk_tiers", """
SELECT doc_id, CASE WHEN s <= 0 THEN NULL WHEN s <= CAST(0.15 AS DOUBLE) THEN 'Low Risk' WHEN s <= CAST(0.35 AS DOUBLE) THEN 'Moderate Risk'
       WHEN s <= CAST(0.6 AS DOUBLE) THEN 'Elevated Risk' WHEN s <= 1 THEN 'High Risk' END AS risk_tier
FROM (SELECT doc_id, (n_chars % 1000) / CAST(1000 AS DOUBLE) AS s FROM labels JOIN documents USING (doc_id))""")
def risk_tiers(spark, sf_dir):
    return distress.risk_tiers(adapters.scored_labels(spark, sf_dir), "score").select("doc_id", "risk_tier")
