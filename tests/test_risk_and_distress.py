import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickyard.functions.scalars import round_doubles
from brickyard.operators import distress, risk


def test_projection_against_draws(spark):
    holdings = spark.createDataFrame([(1, 1, 10e6, 0.03, 0.12), (1, 2, 5e6, 0.0, 0.0)], "portfolio_id long, holding_id long, value double, drift double, vol double")
    rows = {(r["holding_id"], r["month"]): r for r in risk.project_values(holdings).collect()}
    assert len(rows) == 2 * 61
    z = np.random.default_rng(0).standard_normal(400000)
    v = 10e6 * np.exp((0.03 - 0.0072) * 5 + 0.12 * np.sqrt(5) * z)
    r = rows[1, 60]
    assert r["expected_value"] == pytest.approx(v.mean(), rel=2e-3)
    assert r["std_value"] == pytest.approx(v.std(), rel=1e-2)
    p5 = np.percentile(v, 5)
    assert r["p5"] == pytest.approx(p5, rel=5e-3) and r["var_95"] == pytest.approx(10e6 - p5, rel=1e-2)
    assert r["cvar_95"] == pytest.approx(10e6 - v[v <= p5].mean(), rel=1e-2)
    assert r["prob_loss"] == pytest.approx((v < 10e6).mean(), abs=3e-3)
    assert r["prob_gain_20pct"] == pytest.approx((v > 12e6).mean(), abs=3e-3)
    flat = rows[2, 60]
    assert flat["expected_value"] == flat["p5"] == 5e6 and flat["prob_loss"] == 0 and flat["sharpe_ratio"] == 0
    assert rows[1, 0]["std_value"] == 0


def test_macro_impacts_need_their_key():
    plain = risk.macro_path(24, {"rate_impact": [-0.1]})
    assert plain[-1] == (24, 0.0, pytest.approx(2.0))
    both = risk.macro_path(24, {"rate_hike": 1, "rate_impact": [-0.1], "recession": 1, "recession_impact": [0.0, -0.2], "vol_multiplier": 2.0})
    assert both[-1][1:] == (pytest.approx(-0.3), pytest.approx(8.0))
    assert risk.macro_path(12, {"recession": 1, "recession_impact": [0.0]})[-1][2] == pytest.approx(2.25)


def test_portfolio_against_draws(spark):
    v, mu, sd = np.array([10e6, 15e6, 8e6, 20e6]), np.array([.03, .04, .02, .035]), np.array([.12, .15, .10, .13])
    df = spark.createDataFrame([(1, i, *map(float, t)) for i, t in enumerate(zip(v, mu, sd))], "portfolio_id long, holding_id long, value double, drift double, vol double")
    r = risk.portfolio_risk(df).first()
    corr = np.full((4, 4), 0.4) + 0.6 * np.eye(4)
    z = np.random.default_rng(1).standard_normal((400000, 4)) @ np.linalg.cholesky(corr).T
    paths = v * np.exp((mu - sd ** 2 / 2) * 5 + sd * np.sqrt(5) * z)
    total = paths.sum(1)
    assert r["mean_value"] == pytest.approx(total.mean(), rel=2e-3) and r["std_value"] == pytest.approx(total.std(), rel=1e-2)
    assert r["var_95"] == pytest.approx(53e6 - np.percentile(total, 5), rel=3e-2)
    assert r["prob_loss"] == pytest.approx((total < 53e6).mean(), abs=5e-3)
    benefit = (paths.std(0).sum() - total.std()) / paths.std(0).sum()
    assert r["diversification_benefit"] == pytest.approx(benefit, abs=3e-3)
    wild = df.withColumn("vol", F.lit(1.0))  # the series still settles at a volatility of one
    exact = sum(a * b * (np.exp((1 if i == j else .4) * 5) - 1) for i, a in enumerate(v * np.exp(mu * 5)) for j, b in enumerate(v * np.exp(mu * 5)))
    assert risk.portfolio_risk(wild).first()["std_value"] == pytest.approx(np.sqrt(exact), rel=1e-9)


def test_outcome_risk(spark):
    values = np.random.default_rng(2).normal(100, 30, 501).round(2)
    df = spark.createDataFrame([("k", float(x)) for x in values] + [("one", 90.0)], "k string, v double")
    out = {r["k"]: r for r in risk.outcome_risk(df, ["k"], "v", 100.0).collect()}
    r, p5 = out["k"], np.percentile(values, 5)
    assert r["var_95"] == pytest.approx(100 - p5) and r["cvar_95"] == pytest.approx(100 - values[values <= p5].mean())
    assert r["std_value"] == pytest.approx(values.std()) and r["prob_loss"] == pytest.approx((values < 100).mean())
    assert out["one"]["sharpe_ratio"] == 0.0


def test_no_violations_give_no_signal(spark):
    df = spark.createDataFrame([("1", 0.5, 61.0, 0), ("2", 0.7, 60.0, 0), ("3", None, None, 1)], "bbl string, price_vs_neighborhood double, building_age double, is_recently_renovated int")
    none = spark.createDataFrame([], "bbl string, class string")
    out = distress.distress_labels(df, none).orderBy("bbl").collect()
    assert [r["distress_score"] for r in out] == [2, 0, 0] and [r["is_distressed"] for r in out] == [1, 0, 0]
    one = spark.createDataFrame([("1", "C"), ("1", "B"), ("2", "I"), ("3", "A")], "bbl string, class string")
    out = distress.distress_labels(df, one).orderBy("bbl").collect()
    assert [(r["violation_count"], r["severe_violation_count"], r["distress_score"]) for r in out] == [(2, 1, 3), (1, 1, 0), (1, 0, 0)]
    assert distress.distress_labels(df).first()["violation_count"] == 0


def test_tier_edges(spark):
    ps = [0.0, 0.15, 0.1500001, 0.35, 0.6, 1.0, None]
    df = spark.createDataFrame([(p,) for p in ps], "distress_probability double")
    got = [r["risk_tier"] for r in distress.risk_tiers(df).collect()]
    assert got == [None, "Low Risk", "Moderate Risk", "Moderate Risk", "Elevated Risk", "High Risk", None]


def test_classifier_metrics_with_ties(spark):
    data = [(1, 0.9), (0, 0.9), (1, 0.5), (0, 0.2), (1, 0.2), (0, 0.1)]
    r = distress.classifier_metrics(spark.createDataFrame(data, "y int, score double")).first()
    pos, neg = [s for y, s in data if y], [s for y, s in data if not y]
    auc = np.mean([(p > n) + 0.5 * (p == n) for p in pos for n in neg])
    assert r["roc_auc"] == pytest.approx(auc)
    assert r["avg_precision"] == pytest.approx(1 / 3 * 1 / 2 + 1 / 3 * 2 / 3 + 1 / 3 * 3 / 5)
    assert r["f1_score"] == pytest.approx(2 / 3) and r["accuracy"] == pytest.approx(4 / 6)


def test_projection_compiles_and_spreads(spark):
    """A generated method above 8,000 bytes is interpreted, and a small file is read by one task."""
    holdings = spark.range(40).select((F.col("id") % 3).alias("portfolio_id"), F.col("id").alias("holding_id"), F.lit(1e6).alias("value"), F.lit(0.02).alias("drift"), F.lit(0.1).alias("vol")).coalesce(1)
    macro = {"rate_hike": True, "rate_impact": [-0.01], "recession": True, "recession_impact": [-0.05]}
    adaptive = spark.conf.get("spark.sql.adaptive.enabled")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        for made in (risk.project_values(holdings), risk.project_values(holdings, macro=macro)):
            text = spark._jvm.PythonSQLUtils.explainString(round_doubles(made)._jdf.queryExecution(), "codegen")
            sizes = [int(n) for n in re.findall(r"maxMethodCodeSize:(\d+)", text)]
            assert sizes and max(sizes) < 8000, sizes
            assert made.rdd.getNumPartitions() >= spark.sparkContext.defaultParallelism
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", adaptive)
