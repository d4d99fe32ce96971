"""Queries for series, risk, distress, and the models."""

from __future__ import annotations

from pyspark.sql import functions as F

from brickyard.operators import distress, forecast, risk, series
from brickyard.plans.oracle_views import HOLDINGS, MACRO, MACRO_NAMES, SALES, STAGED_SALES
from brickyard.plans.queries_layers import staged_sales
from brickyard.plans.queries_market import FEATURES, stored
from brickyard.plans.registry import ctes, query
from brickyard.sources import adapters, extracts

C = F.col
MONTHLY = """ends AS (SELECT borough_name, min(date_trunc('month', sale_date)) AS lo, max(date_trunc('month', sale_date)) AS hi
         FROM staged GROUP BY 1),
calendar AS (SELECT borough_name, CAST(unnest(generate_series(lo, hi, INTERVAL 1 MONTH)) AS DATE) AS period FROM ends),
monthly AS (SELECT c.borough_name, c.period, count(s.sale_price) AS transaction_volume, median(s.sale_price) AS sale_price,
                   median(s.price_per_sqft) AS price_per_sqft
            FROM calendar c LEFT JOIN staged s ON s.borough_name = c.borough_name AND date_trunc('month', s.sale_date) = c.period
            GROUP BY 1, 2)"""
SERIES = (SALES, STAGED_SALES, MONTHLY)
KEY = ["borough_name"]


def monthly(spark, sf_dir):
    return series.price_series(staged_sales(spark, sf_dir, False), group_by="borough_name")


def macro(spark, sf_dir):
    return extracts.macro_table(adapters.macro_observations(spark, sf_dir), MACRO_NAMES)


# --- series ---------------------------------------------------------------
@query("ts01_price_series", ctes(*SERIES) + "SELECT * FROM monthly", floats="sale_price price_per_sqft")
def price_series(spark, sf_dir):
    """Monthly median series per borough with empty months (TS1, AG24)."""
    return monthly(spark, sf_dir)


@query("ts01_quarterly_mean_series", ctes(SALES, STAGED_SALES) + """
SELECT CAST(date_trunc('quarter', sale_date) AS DATE) AS period, count(sale_price) AS transaction_volume,
       avg(sale_price) AS sale_price, avg(price_per_sqft) AS price_per_sqft FROM staged GROUP BY 1""",
       floats="sale_price price_per_sqft")
def quarterly_series(spark, sf_dir):
    return series.price_series(staged_sales(spark, sf_dir, False), freq="quarter", metric="mean")


@query("ts03_decomposition", ctes(*SERIES, """
known AS (SELECT *, row_number() OVER w - 1 AS i, count(*) OVER (PARTITION BY borough_name) AS n FROM monthly
          WHERE sale_price IS NOT NULL WINDOW w AS (PARTITION BY borough_name ORDER BY period)),
smooth AS (SELECT *, CASE WHEN i >= 6 AND i < n - 6 THEN
             (sum(sale_price) OVER (PARTITION BY borough_name ORDER BY i ROWS BETWEEN 6 PRECEDING AND 5 FOLLOWING)
            + sum(sale_price) OVER (PARTITION BY borough_name ORDER BY i ROWS BETWEEN 5 PRECEDING AND 6 FOLLOWING)) / 24 END AS trend FROM known),
phases AS (SELECT borough_name, i % 12 AS phase, avg(sale_price - trend) AS m FROM smooth GROUP BY 1, 2),
centred AS (SELECT borough_name, phase, m - avg(m) OVER (PARTITION BY borough_name) AS seasonal FROM phases)""") + """
SELECT s.borough_name, period, sale_price AS observed, trend, seasonal, sale_price - trend - seasonal AS residual
FROM smooth s JOIN centred c ON c.borough_name = s.borough_name AND c.phase = s.i % 12 WHERE n >= 24""",
       floats="observed trend seasonal residual", digits=3)
def decomposition(spark, sf_dir):
    """Centred moving average, seasonal means, residual (TS3, WN7)."""
    return series.decompose(monthly(spark, sf_dir), "sale_price", KEY)


@query("ts08_momentum", ctes(*SERIES, """
m AS (SELECT *, last_value(price_per_sqft IGNORE NULLS) OVER (PARTITION BY borough_name ORDER BY period ROWS UNBOUNDED PRECEDING) AS known,
  CASE WHEN count(price_per_sqft) OVER w6 >= 3 THEN avg(price_per_sqft) OVER w6 END AS ma_6m,
  CASE WHEN count(price_per_sqft) OVER w12 >= 6 THEN avg(price_per_sqft) OVER w12 END AS ma_12m,
  CASE WHEN count(price_per_sqft) OVER w12 >= 6 THEN stddev(price_per_sqft) OVER w12 END AS volatility_12m FROM monthly
  WINDOW w6 AS (PARTITION BY borough_name ORDER BY period ROWS BETWEEN 5 PRECEDING AND CURRENT ROW),
         w12 AS (PARTITION BY borough_name ORDER BY period ROWS BETWEEN 11 PRECEDING AND CURRENT ROW))""") + """
SELECT borough_name, period, transaction_volume, sale_price, price_per_sqft, ma_6m, ma_12m,
       known / lag(known, 12) OVER w - 1 AS yoy_change, known / lag(known, 6) OVER w - 1 AS momentum_6m, volatility_12m,
       (price_per_sqft - ma_12m) / nullif(volatility_12m, 0) AS z_score,
       CASE WHEN ma_6m > ma_12m THEN 'bullish' ELSE 'bearish' END AS trend_signal FROM m
WINDOW w AS (PARTITION BY borough_name ORDER BY period)""",
       floats="sale_price price_per_sqft ma_6m ma_12m yoy_change momentum_6m volatility_12m z_score")
def momentum(spark, sf_dir):
    """Moving averages, changes, volatility, z-score, trend signal (TS8, WN2-WN6)."""
    return series.momentum(monthly(spark, sf_dir), "price_per_sqft", KEY)


@query("jn12_macro_alignment", ctes(*SERIES, MACRO, f"""
months AS (SELECT CAST(date_trunc('month', date) AS DATE) AS month, series, arg_max(value, date) AS value FROM observations GROUP BY 1, 2),
wide AS (SELECT month, {', '.join(f"max(CASE WHEN series = '{m}' THEN value END) AS {m}" for m in MACRO_NAMES)} FROM months GROUP BY 1),
filled AS (SELECT month, {', '.join(f"last_value({m} IGNORE NULLS) OVER w AS {m}" for m in MACRO_NAMES)} FROM wide
           WINDOW w AS (ORDER BY month ROWS UNBOUNDED PRECEDING))""") + f"""
SELECT borough_name, period, transaction_volume,
  {', '.join(f"coalesce(last_value({m} IGNORE NULLS) OVER past, first_value({m} IGNORE NULLS) OVER next) AS {m}" for m in MACRO_NAMES)}
FROM monthly LEFT JOIN filled ON month = period
WINDOW past AS (PARTITION BY borough_name ORDER BY period ROWS UNBOUNDED PRECEDING),
       next AS (PARTITION BY borough_name ORDER BY period ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING)""",
       floats=" ".join(MACRO_NAMES))
def macro_alignment(spark, sf_dir):
    """Macro as of each month: previous known value, else the next one (JN12, WN6)."""
    base = monthly(spark, sf_dir).select("borough_name", "period", "transaction_volume")
    return series.align_macro(base, macro(spark, sf_dir), MACRO_NAMES, KEY)


@query("wn08_differences", ctes(*SERIES, """
d AS (SELECT borough_name, period, sale_price, sale_price - lag(sale_price) OVER w AS diff_1, sale_price - lag(sale_price, 12) OVER w AS diff_12
      FROM monthly WINDOW w AS (PARTITION BY borough_name ORDER BY period))""") + """
SELECT *, diff_1 - lag(diff_1, 12) OVER (PARTITION BY borough_name ORDER BY period) AS diff_both FROM d""",
       floats="sale_price diff_1 diff_12 diff_both")
def differences(spark, sf_dir):
    return series.difference(monthly(spark, sf_dir).select("borough_name", "period", "sale_price"), "sale_price", KEY)


@query("wn10_chronological_split", ctes(*SERIES) + """
SELECT borough_name, period, CAST(row_number() OVER (PARTITION BY borough_name ORDER BY period)
       <= floor(count(*) OVER (PARTITION BY borough_name) * CAST(0.8 AS DOUBLE)) AS INT) AS is_train FROM monthly""")
def chronological_split(spark, sf_dir):
    return series.chronological_split(monthly(spark, sf_dir), KEY).select("borough_name", "period", "is_train")


@query("ts09_forecast_errors", ctes(*SERIES, """
naive AS (SELECT *, lag(sale_price, 12) OVER (PARTITION BY borough_name ORDER BY period) AS guess FROM monthly)""") + """
SELECT borough_name, avg(abs(sale_price - guess)) AS mae, sqrt(avg((sale_price - guess) * (sale_price - guess))) AS rmse,
       avg(abs((sale_price - guess) / nullif(sale_price, 0))) * 100 AS mape, count(*) AS n_test FROM naive
WHERE guess IS NOT NULL GROUP BY 1""", floats="mae rmse mape")
def forecast_errors(spark, sf_dir):
    """Error metrics of the same-month-last-year forecast (TS9)."""
    lagged = series.difference(monthly(spark, sf_dir), "sale_price", KEY).withColumn("guess", C("sale_price") - C("diff_12"))
    return series.forecast_errors(lagged.where(C("guess").isNotNull()), "sale_price", "guess", KEY)


@query("ts02_stationarity")
def stationarity(spark, sf_dir):
    """Augmented Dickey-Fuller test per borough; checked against closed forms in the tests."""
    return forecast.stationarity(monthly(spark, sf_dir), "borough_name", "sale_price")


def with_macro(spark, sf_dir):
    return series.align_macro(monthly(spark, sf_dir), macro(spark, sf_dir), MACRO_NAMES, KEY)


@query("ts04_seasonal_arma")
def seasonal_arma(spark, sf_dir):
    """Hold-out and 24-month forecasts per borough with macro regressors (TS4, TS5)."""
    return forecast.seasonal_arma(with_macro(spark, sf_dir), "borough_name", "sale_price", MACRO_NAMES)


@query("ts06_trend_model")
def trend_model(spark, sf_dir):
    """Piecewise trend with yearly seasonality and macro regressors (TS6, TS7)."""
    return forecast.trend_model(with_macro(spark, sf_dir), "borough_name", "sale_price", MACRO_NAMES)


# --- risk -----------------------------------------------------------------
def cdf(x: str) -> str:
    """Normal distribution function as SQL text, by the same published polynomial."""
    d = "CAST({} AS DOUBLE)".format
    z = f"(abs({x}) / sqrt({d(2)}))"
    t = f"({d(1)} / ({d(1)} + {d('0.3275911')} * {z}))"
    poly = f"{t} * ({d('0.254829592')} + {t} * ({d('-0.284496736')} + {t} * ({d('1.421413741')} + {t} * ({d('-1.453152027')} + {t} * {d('1.061405429')}))))"
    return f"({d('0.5')} * (1 + sign({x}) * (1 - {poly} * exp(-{z} * {z}))))"


def law_sql(m: str, s: str) -> str:
    """Columns of the lognormal law with log mean m and log deviation s of `value`."""
    d = "CAST({} AS DOUBLE)".format
    mean = f"value * exp({m} + {s} * {s} / 2)"
    out = [f"{mean} AS expected_value", f"{mean} * sqrt(exp({s} * {s}) - 1) AS std_value", f"{mean} / value - 1 AS expected_return"]
    for p, z in risk.Z.items():
        if p != 1:
            out.append(f"value * exp({m} + {s} * {d(z)}) AS p{p}")
    out += [f"value - value * exp({m} + {s} * {d(risk.Z[5])}) AS var_95", f"value - value * exp({m} + {s} * {d(risk.Z[1])}) AS var_99",
            f"value - {mean} * CASE WHEN {s} > 0 THEN {cdf(f'({d(risk.Z[5])} - {s})')} / {d('0.05')} ELSE 1 END AS cvar_95",
            f"CASE WHEN {s} > 0 THEN {cdf(f'(-({m}) / {s})')} ELSE CAST({m} < 0 AS INT) END AS prob_loss",
            f"CASE WHEN {s} > 0 THEN 1 - {cdf(f'((ln({d(1.2)}) - ({m})) / {s})')} ELSE CAST({m} > ln({d(1.2)}) AS INT) END AS prob_gain_20pct",
            f"CASE WHEN {s} > 0 THEN ({mean} - value) / ({mean} * sqrt(exp({s} * {s}) - 1)) ELSE 0 END AS sharpe_ratio"]
    return ", ".join(out)


MONEY = dict.fromkeys("value expected_value std_value p5 p25 p50 p75 p95 var_95 var_99 cvar_95".split(), 1)
LAW = "value drift vol expected_value std_value expected_return p5 p25 p50 p75 p95 var_95 var_99 cvar_95 prob_loss prob_gain_20pct sharpe_ratio"


@query("rk01_outcome_risk", ctes(SALES, STAGED_SALES, """
q AS (SELECT neighborhood, quantile_cont(sale_price, 0.05) AS p5, quantile_cont(sale_price, 0.01) AS p1 FROM staged GROUP BY 1)""") + """
SELECT s.neighborhood, avg(sale_price) AS mean_value, median(sale_price) AS median_value, stddev_pop(sale_price) AS std_value,
       min(sale_price) AS min_value, max(sale_price) AS max_value, avg(CAST(sale_price < 1000000 AS INT)) AS prob_loss,
       avg(CAST((sale_price - 1000000) / 1000000 > CAST(0.2 AS DOUBLE) AS INT)) AS prob_gain_20pct,
       (avg(sale_price) - 1000000) / 1000000 AS mean_return, (median(sale_price) - 1000000) / 1000000 AS median_return,
       1000000 - any_value(p5) AS var_95, 1000000 - any_value(p1) AS var_99,
       1000000 - avg(sale_price) FILTER (WHERE sale_price <= p5) AS cvar_95,
       (avg(sale_price) - 1000000) / stddev_pop(sale_price) AS sharpe_ratio
FROM staged s JOIN q ON q.neighborhood = s.neighborhood GROUP BY 1""",
       floats="mean_value median_value std_value min_value max_value prob_loss prob_gain_20pct mean_return median_return "
              "var_95 var_99 cvar_95 sharpe_ratio")
def outcome_risk(spark, sf_dir):
    """Risk of realised sale values against a one-million purchase, per neighbourhood (RK1)."""
    return risk.outcome_risk(staged_sales(spark, sf_dir, False), ["neighborhood"], "sale_price", 1000000.0)


@query("rk02_percentile_fan", ctes(SALES, STAGED_SALES) + f"""
SELECT sale_year, {', '.join(f'quantile_cont(sale_price, {p}) AS {n}' for n, p in risk.FAN.items())} FROM staged GROUP BY 1""",
       floats="p5 p25 p50 p75 p95")
def percentile_fan(spark, sf_dir):
    return risk.percentile_fan(staged_sales(spark, sf_dir, False), "sale_year", "sale_price")


_T = "(CAST(month AS DOUBLE) / 12)"


@query("rk03_value_projection", ctes(HOLDINGS, "steps AS (SELECT unnest(generate_series(0, 60)) AS month)") + f"""
SELECT *, {law_sql(f'((drift - vol * vol / 2) * {_T})', f'(vol * sqrt({_T}))')} FROM holdings, steps""",
       floats=LAW, digits=MONEY)
def value_projection(spark, sf_dir):
    """Monthly value law of every holding over five years (RK3)."""
    return risk.project_values(adapters.holdings(spark, sf_dir))


MACRO_PATH = {"rate_hike": True, "rate_impact": [-0.01, -0.02], "recession": True, "recession_impact": [-0.05, -0.03, 0.01], "vol_multiplier": 1.5}


@query("rk04_macro_projection", ctes(HOLDINGS, """years AS (SELECT * FROM (VALUES
  (0, CAST(-0.06 AS DOUBLE), CAST(2.25 AS DOUBLE)), (1, CAST(-0.05 AS DOUBLE), CAST(2.25 AS DOUBLE)), (2, CAST(0.01 AS DOUBLE), CAST(2.25 AS DOUBLE)),
  (3, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE)), (4, CAST(0 AS DOUBLE), CAST(1 AS DOUBLE))) AS t(y, d, v)),
path AS (SELECT CAST(m AS INT) AS month, sum(d / 12) OVER (ORDER BY m) AS shift, sum(v / 12) OVER (ORDER BY m) AS time
         FROM (SELECT unnest(generate_series(1, 60)) AS m) AS s JOIN years ON y = (m - 1) // 12
         UNION ALL SELECT 0, CAST(0 AS DOUBLE), CAST(0 AS DOUBLE)),
rows_ AS (SELECT * FROM holdings, path)""") + f"""
SELECT portfolio_id, holding_id, value, drift, vol, month,
       {law_sql('(drift * CAST(month AS DOUBLE) / 12 + shift - vol * vol / 2 * time)', '(vol * sqrt(time))')} FROM rows_""", floats=LAW, digits=MONEY)
def macro_projection(spark, sf_dir):
    """The same under a rate rise and a recession (RK4)."""
    return risk.project_values(adapters.holdings(spark, sf_dir), macro=MACRO_PATH)


@query("rk05_scenario_grid", ctes(HOLDINGS, """scenarios AS (SELECT * FROM (VALUES
  ('Base Case', CAST(0 AS DOUBLE), NULL, CAST(1 AS DOUBLE)), ('Bull Case', CAST(0.02 AS DOUBLE), NULL, CAST(0.8 AS DOUBLE)),
  ('Bear Case', CAST(-0.03 AS DOUBLE), NULL, CAST(1.3 AS DOUBLE)),
  ('Stress Test (GFC-like)', CAST(0 AS DOUBLE), CAST(-0.08 AS DOUBLE), CAST(2 AS DOUBLE)),
  ('Recovery', CAST(0.04 AS DOUBLE), NULL, CAST(1.1 AS DOUBLE))) AS t(scenario, shift, fixed, factor)),
grid AS (SELECT portfolio_id, holding_id, value, coalesce(fixed, drift + shift) AS drift, vol * factor AS vol, scenario FROM holdings, scenarios)""") + f"""
SELECT *, {law_sql('((drift - vol * vol / 2) * 5)', '(vol * sqrt(CAST(5 AS DOUBLE)))')} FROM grid""", floats=LAW, digits=MONEY)
def scenario_grid(spark, sf_dir):
    return risk.scenario_grid(adapters.holdings(spark, sf_dir))


@query("rk06_portfolio_risk", ctes(HOLDINGS, """
h AS (SELECT *, value * exp(drift * 5) AS a FROM holdings),
pairs AS (SELECT x.portfolio_id, sum(x.a * y.a * (exp(CASE WHEN x.holding_id = y.holding_id THEN 1 ELSE CAST(0.4 AS DOUBLE) END
                                                     * x.vol * y.vol * 5) - 1)) AS var
          FROM h x JOIN h y ON x.portfolio_id = y.portfolio_id GROUP BY 1),
sums AS (SELECT portfolio_id, count(*) AS n_holdings, sum(value) AS initial_value, sum(a) AS mean_value,
                sum(a * sqrt(exp(vol * vol * 5) - 1)) AS sum_sd FROM h GROUP BY 1),
law AS (SELECT *, sqrt(var) AS std_value, sqrt(ln(1 + var / (mean_value * mean_value))) AS s,
               ln(mean_value / initial_value) - ln(1 + var / (mean_value * mean_value)) / 2 AS m FROM sums JOIN pairs USING (portfolio_id))""") + f"""
SELECT portfolio_id, n_holdings, initial_value, mean_value, std_value, mean_value / initial_value - 1 AS mean_return,
       initial_value * (1 - exp(m + s * CAST({risk.Z[5]} AS DOUBLE))) AS var_95, {cdf('(-m / s)')} AS prob_loss,
       (sum_sd - std_value) / sum_sd AS diversification_benefit FROM law""",
       floats="initial_value mean_value std_value mean_return var_95 prob_loss diversification_benefit", digits={"mean_value": 2, "std_value": 2, "var_95": 2})
def portfolio_risk(spark, sf_dir):
    """Correlated portfolios from moments; the SQL twin sums over all holding pairs (RK6)."""
    return risk.portfolio_risk(adapters.holdings(spark, sf_dir))


# --- distress -------------------------------------------------------------
DISTRESS = (*FEATURES, """
labelled AS (SELECT f.*, coalesce(v.n, 0) AS violation_count, coalesce(v.severe, 0) AS severe_violation_count FROM featured f
  LEFT JOIN (SELECT bbl, count(*) AS n, count(*) FILTER (WHERE class IN ('C', 'I')) AS severe FROM violations GROUP BY 1) v USING (bbl)),
cuts AS (SELECT quantile_cont(violation_count, 0.75) AS v75, quantile_cont(price_per_sqft, 0.10) AS p10 FROM labelled),
distress AS (SELECT l.*, CAST(coalesce(price_vs_neighborhood < CAST(0.7 AS DOUBLE), false) AS INT)
    + CAST(v75 > 0 AND violation_count >= v75 AS INT)
    + CAST(coalesce(building_age > 60 AND is_recently_renovated = 0, false) AS INT)
    + CAST(coalesce(p10 > 0 AND price_per_sqft <= p10, false) AS INT) AS distress_score FROM labelled l, cuts)""")


def labelled(spark, sf_dir):
    table = stored(spark, sf_dir, "sale_id", "bbl", "price_vs_neighborhood", "building_age", "is_recently_renovated", "price_per_sqft")
    return distress.distress_labels(table, adapters.violations(spark, sf_dir))


@query("ds01_distress_labels", ctes(*DISTRESS) + """
SELECT sale_id, bbl, violation_count, severe_violation_count, distress_score, CAST(distress_score >= 2 AS INT) AS is_distressed FROM distress""")
def distress_labels(spark, sf_dir):
    """Four-signal score and label (DS1, DS2, JN6, AG19)."""
    return labelled(spark, sf_dir).select("sale_id", "bbl", "violation_count", "severe_violation_count", "distress_score", "is_distressed")


CURVE = """scored AS (SELECT toxic AS y, (n_chars % 1000) / CAST(1000 AS DOUBLE) AS score FROM labels JOIN documents USING (doc_id)),
tied AS (SELECT score AS threshold, CAST(sum(y) AS BIGINT) AS pos, CAST(sum(1 - y) AS BIGINT) AS neg FROM scored GROUP BY 1),
curve AS (SELECT *, CAST(sum(pos) OVER w AS BIGINT) AS tp, CAST(sum(neg) OVER w AS BIGINT) AS fp FROM tied
          WINDOW w AS (ORDER BY threshold DESC ROWS UNBOUNDED PRECEDING))"""


@query("ds05_score_curve", ctes(CURVE) + """
SELECT *, tp / (SELECT sum(pos) FROM tied) AS tpr, fp / (SELECT sum(neg) FROM tied) AS fpr, tp / (tp + fp) AS precision FROM curve""",
       floats="threshold tpr fpr precision")
def score_curve(spark, sf_dir):
    """ROC and precision-recall points by running totals without a global window (DS5)."""
    return distress.score_curve(adapters.scored_labels(spark, sf_dir))


@query("ds05_classifier_metrics", ctes(CURVE, """
totals AS (SELECT sum(pos) AS p, sum(neg) AS n FROM tied),
at_half AS (SELECT sum(pos) FILTER (WHERE threshold >= 0.5) AS tp, sum(neg) FILTER (WHERE threshold >= 0.5) AS fp FROM tied),
r AS (SELECT CAST(p AS BIGINT) AS n_pos, CAST(n AS BIGINT) AS n_neg,
  (SELECT avg(CASE WHEN a.score > b.score THEN 1.0 WHEN a.score = b.score THEN 0.5 ELSE 0 END) FROM scored a, scored b WHERE a.y = 1 AND b.y = 0) AS roc_auc,
  (SELECT sum(pos * tp / (tp + fp)) FROM curve) / p AS avg_precision,
  tp / (tp + fp) AS precision_1, tp / p AS recall_1, (n - fp) / ((n - fp) + (p - tp)) AS precision_0, (n - fp) / n AS recall_0,
  (tp + n - fp) / (p + n) AS accuracy FROM totals, at_half)""") + """
SELECT *, 2 * precision_1 * recall_1 / (precision_1 + recall_1) AS f1_score, 2 * precision_0 * recall_0 / (precision_0 + recall_0) AS f1_0 FROM r""",
       floats="roc_auc avg_precision precision_1 recall_1 precision_0 recall_0 accuracy f1_score f1_0", digits=6)
def classifier_metrics(spark, sf_dir):
    return distress.classifier_metrics(adapters.scored_labels(spark, sf_dir))


@query("ds08_propensity_to_sell", ctes(*FEATURES, """
single AS (SELECT ownername FROM featured WHERE ownername IS NOT NULL GROUP BY 1 HAVING count(*) = 1),
turnover AS (SELECT neighborhood, count(*) AS n FROM featured WHERE sale_date >= DATE '2001-12-31' - 730 GROUP BY 1),
busy AS (SELECT neighborhood FROM turnover WHERE n > (SELECT quantile_cont(n, 0.75) FROM turnover)),
s AS (SELECT sale_id, bbl, CAST(0.3 AS DOUBLE) * CAST(coalesce(ownername IN (SELECT * FROM single), false) AS INT)
   + CAST(0.2 AS DOUBLE) * CAST(neighborhood IN (SELECT * FROM busy) AS INT)
   + CAST(0.25 AS DOUBLE) * CAST(price_vs_neighborhood < CAST(0.8 AS DOUBLE) AS INT)
   + CAST(0.25 AS DOUBLE) * CAST(coalesce(building_age > 50 AND is_recently_renovated = 0, false) AS INT) AS score FROM featured)""") + """
SELECT sale_id, bbl, score AS propensity_to_sell_score, CASE WHEN score <= 0 THEN NULL WHEN score <= CAST(0.2 AS DOUBLE) THEN 'Low'
       WHEN score <= CAST(0.4 AS DOUBLE) THEN 'Moderate' WHEN score <= CAST(0.6 AS DOUBLE) THEN 'Elevated' ELSE 'High' END AS sell_likelihood
FROM s""", floats="propensity_to_sell_score")
def propensity_to_sell(spark, sf_dir):
    """Owner, turnover, price and age signals (DS8, JN7, AG20)."""
    table = stored(spark, sf_dir, "sale_id", "bbl", "ownername", "neighborhood", "sale_date", "price_vs_neighborhood", "building_age",
                   "is_recently_renovated")
    return distress.propensity_to_sell(table).select("sale_id", "bbl", "propensity_to_sell_score", "sell_likelihood")
