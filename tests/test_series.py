import datetime as dt
import math

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from brickyard.operators import forecast, series
from brickyard.sources import extracts


def months(n, start="1995-01-01"):
    return [d.date() for d in pd.date_range(start, periods=n, freq="MS")]


def frame(spark, values, key="k"):
    return spark.createDataFrame([(key, m, None if v is None else float(v)) for m, v in zip(months(len(values)), values)], "k string, period date, v double")


def test_empty_months_stay(spark):
    df = spark.createDataFrame([(dt.date(2000, 1, 15), 10.0, "a"), (dt.date(2000, 3, 1), 30.0, "a"), (dt.date(2000, 3, 9), 50.0, "a"), (dt.date(2000, 2, 9), 1.0, "b"), (None, 1.0, "b")],
                               "sale_date date, sale_price double, g string")
    out = [tuple(r) for r in series.price_series(df, group_by="g").orderBy("g", "period").collect()]
    assert out == [("a", dt.date(2000, 1, 1), 1, 10.0), ("a", dt.date(2000, 2, 1), 0, None), ("a", dt.date(2000, 3, 1), 2, 40.0), ("b", dt.date(2000, 2, 1), 1, 1.0)]
    quarter = series.price_series(df, freq="quarter", metric="mean").collect()
    assert [(r["period"], r["transaction_volume"]) for r in quarter] == [(dt.date(2000, 1, 1), 4)]


def test_momentum_matches_pandas(spark):
    rng = np.random.default_rng(0)
    values = [None if rng.random() < 0.15 else float(v) for v in 100 + rng.normal(size=40).cumsum()]
    out = series.momentum(frame(spark, values), "v", ["k"]).orderBy("period").toPandas()
    s = pd.Series(values, dtype=float)
    filled = s.ffill()
    want = {"ma_6m": s.rolling(6, min_periods=3).mean(), "ma_12m": s.rolling(12, min_periods=6).mean(), "volatility_12m": s.rolling(12, min_periods=6).std(),
            "yoy_change": filled / filled.shift(12) - 1, "momentum_6m": filled / filled.shift(6) - 1}
    for name, expected in want.items():
        assert np.allclose(out[name].astype(float), expected, equal_nan=True), name
    ma6, ma12 = want["ma_6m"], want["ma_12m"]
    assert (out["trend_signal"] == np.where(ma6 > ma12, "bullish", "bearish")).all()


@pytest.mark.parametrize("model", ["additive", "multiplicative"])
def test_decomposition_recovers_the_season(spark, model):
    season = np.tile([1.2, 0.8, 1, 1.1, 0.9, 1, 1, 1, 1, 1.3, 0.7, 1.0], 4)
    trend = 100 + np.arange(48)
    y = trend + 10 * (season - 1) if model == "additive" else trend * season
    out = series.decompose(frame(spark, y), "v", ["k"], model=model).orderBy("period").toPandas()
    assert out["trend"].isna().sum() == 12
    if model == "additive":
        assert np.allclose(out["seasonal"], 10 * (season - 1)) and np.allclose(out["residual"].dropna(), 0)
    else:
        assert np.allclose(out["seasonal"], season, atol=0.02)
    assert series.decompose(frame(spark, y[:23]), "v", ["k"]).count() == 0


def test_macro_alignment_fills_back_and_forth(spark):
    base = frame(spark, [1, 2, 3, 4])
    macro = spark.createDataFrame([(dt.date(1995, 2, 1), 7.0), (dt.date(1995, 3, 1), None)], "month date, m double")
    assert [r["m"] for r in series.align_macro(base, macro, ["m"], ["k"]).orderBy("period").collect()] == [7.0] * 4


def test_macro_table_fills_quarters(spark):
    obs = spark.createDataFrame([(dt.date(2000, 1, 5), "a", 1.0), (dt.date(2000, 1, 20), "a", 2.0), (dt.date(2000, 4, 2), "a", 3.0), (dt.date(2000, 1, 1), "b", 9.0), (dt.date(2000, 2, 1), "a", None)],
                                "date date, series string, value double")
    out = [tuple(r) for r in extracts.macro_table(obs, ["a", "b"]).orderBy("month").collect()]
    assert [r[1] for r in out] == [2.0, 2.0, 2.0, 3.0] and [r[2] for r in out] == [9.0] * 4


def test_unit_root(spark):
    rng = np.random.default_rng(4)
    noise, walk = rng.normal(size=120), rng.normal(size=120).cumsum()
    df = frame(spark, noise, "noise").union(frame(spark, walk, "walk")).union(frame(spark, noise[:19], "short"))
    out = {r["k"]: r for r in forecast.stationarity(df, "k", "v").collect()}
    assert set(out) == {"noise", "walk"} and out["noise"]["is_stationary"] == 1
    assert out["walk"]["adf_statistic"] == pytest.approx(forecast.unit_root_test(walk)["adf_statistic"])
    # a test at five percent rejects about that share of random walks
    rejected = [forecast.unit_root_test(np.random.default_rng(s).normal(size=120).cumsum())["p_value"] < 0.05 for s in range(300)]
    assert 0.02 < np.mean(rejected) < 0.09
    # published 5 percent point of the asymptotic distribution
    assert forecast.unit_root_p_value(-2.86154) == pytest.approx(0.05, abs=0.001)
    assert forecast.unit_root_p_value(3) == 1.0 and forecast.unit_root_p_value(-20) == 0.0
    y = noise[:60]
    t = forecast.unit_root_test(y)
    x, dy = forecast._lag_design(y, t["n_lags"], t["n_lags"])
    beta = np.linalg.solve(x.T @ x, x.T @ dy)
    e = dy - x @ beta
    se = math.sqrt(e @ e / (len(dy) - x.shape[1]) * np.linalg.inv(x.T @ x)[0, 0])
    assert t["adf_statistic"] == pytest.approx(beta[0] / se)


def test_forecasts_follow_trend_and_season(spark):
    n = 96
    t = np.arange(n)
    y = 1000 + 5 * t + 80 * np.sin(2 * np.pi * t / 12) + np.random.default_rng(0).normal(0, 3, n)
    df = frame(spark, y).withColumn("m", F.month("period").cast("double")).union(frame(spark, y[:20], "short").withColumn("m", F.lit(0.0)))
    for table in (forecast.seasonal_arma(df, "k", "v", ["m"]), forecast.trend_model(df, "k", "v", ["m"])):
        out = table.orderBy("kind", "period").toPandas()
        out = out[out["kind"] != "none"]
        assert set(out["k"]) == {"k"}
        future, held = out[out["kind"] == "future"], out[out["kind"] == "holdout"]
        assert len(future) == 24 and len(held) == n - int(n * 0.8)
        mape = (abs(held["forecast"] - held["actual"].astype(float)) / held["actual"].astype(float)).mean()
        assert mape < 0.08
        assert (future["ci_lower"] < future["forecast"]).all() and (future["forecast"] < future["ci_upper"]).all()
        truth = 1000 + 5 * np.arange(n, n + 24) + 80 * np.sin(2 * np.pi * np.arange(n, n + 24) / 12)
        assert np.mean(abs(future["forecast"].to_numpy() - truth) / truth) < 0.1


def test_split_and_difference(spark):
    df = frame(spark, range(14))
    assert series.chronological_split(df, ["k"]).agg(F.sum("is_train")).first()[0] == 11
    last = series.difference(df, "v", ["k"]).orderBy(F.desc("period")).first()
    assert (last["diff_1"], last["diff_12"], last["diff_both"]) == (1.0, 12.0, 0.0)


def _covariance(ar, ma, n, far=4000):
    """Covariances of an ARMA process from its responses to single shocks."""
    psi = np.zeros(far)
    for h in range(far):
        psi[h] = (ma[h] if h < len(ma) else 0.0) - sum(ar[k] * psi[h - k] for k in range(1, min(h, len(ar) - 1) + 1) if ar[k])
    lags = [psi[:far - k] @ psi[k:] for k in range(n)]
    return np.array([[lags[abs(i - j)] for j in range(n)] for i in range(n)])


@pytest.mark.parametrize("coefficients, season", [((0.7, 0.0, 0.0, 0.0), 4), ((0.0, 0.0, -0.6, 0.3), 4), ((0.5, 0.3, -0.4, -0.7), 6)])
def test_likelihood_is_exact(coefficients, season):
    rng = np.random.default_rng(1)
    n, w, x = 30, rng.normal(size=30) * 2, rng.normal(size=(30, 2))
    ar, ma = forecast._polynomials(*coefficients, season)
    got, beta, sigma2, _, _ = forecast.gaussian_fit(forecast.StateSpace(ar, ma), w, x)
    cov = _covariance(ar, ma, n)
    inv = np.linalg.inv(cov)
    best = np.linalg.solve(x.T @ inv @ x, x.T @ inv @ w)
    e = w - x @ best
    s2 = e @ inv @ e / n
    assert beta == pytest.approx(best, rel=1e-6) and sigma2 == pytest.approx(s2, rel=1e-6)
    assert got == pytest.approx(-0.5 * (n * math.log(2 * math.pi * s2) + np.linalg.slogdet(cov)[1] + n), rel=1e-8)


def test_autoregressive_likelihood_in_closed_form():
    rng = np.random.default_rng(2)
    phi, w = 0.8, rng.normal(size=50).cumsum() * 0.3
    got, _, s2, _, _ = forecast.gaussian_fit(forecast.StateSpace(np.array([1.0, -phi]), np.array([1.0])), w, None)
    square = (1 - phi**2) * w[0] ** 2 + ((w[1:] - phi * w[:-1]) ** 2).sum()
    assert s2 == pytest.approx(square / 50)
    assert got == pytest.approx(-25 * math.log(2 * math.pi * s2) + 0.5 * math.log(1 - phi**2) - square / (2 * s2))


def test_bands_cover_simulated_futures():
    rng = np.random.default_rng(3)
    s, n, steps, inside = 6, 90, 8, []
    ar, ma = forecast._polynomials(0.4, 0.2, -0.5, -0.4, s)
    full = np.convolve(np.convolve(ar, [1.0, -1.0]), np.concatenate([[1.0], np.zeros(s - 1), [-1.0]]))
    for _ in range(25):
        shocks, x = rng.normal(size=n + steps + 50) * 3, rng.normal(size=(n + steps + 50, 1)).cumsum(axis=0)
        y = np.zeros(len(shocks))
        for t in range(len(y)):
            y[t] = sum(ma[k] * shocks[t - k] for k in range(len(ma)) if t >= k) - sum(full[k] * y[t - k] for k in range(1, len(full)) if t >= k)
        y = (y + 2 * x[:, 0])[50:]
        model = forecast.SeasonalArma(y[:n], x[50:50 + n], s)
        point, se = model.forecast(steps, x[50 + n:])
        inside += (np.abs(y[n:] - point) <= 1.96 * se).tolist()
        assert model.bic > model.aic and model.aic == pytest.approx(2 * 6 - 2 * model.loglik)
    assert 0.85 < np.mean(inside) <= 1


def test_one_planted_break_is_found_alone():
    rng = np.random.default_rng(4)
    months = np.arange(120.0)
    empty = np.empty((120, 0))
    knots = forecast.TrendModel(np.arange(120.0), months, empty).knots
    t = months / 119
    trend = 100 + 40 * t - 120 * np.maximum(t - knots[11], 0)
    model = forecast.TrendModel(trend * (1 + 0.2 * np.sin(2 * np.pi * months / 12)) + rng.normal(0, 0.01, 120), months, empty)
    found = np.abs(model.slopes[2:])
    assert found.argmax() == 11 and found.sum() - found[11] < 0.1 * found[11], found
    assert np.abs(model.predict(months, empty) - trend * (1 + 0.2 * np.sin(2 * np.pi * months / 12))).mean() < 0.1
    straight = forecast.TrendModel(100 + 40 * t + rng.normal(0, 0.3, 120), months, empty)
    assert np.abs(straight.slopes[2:]).max() < 0.1


def test_slopes_are_the_most_likely_ones():
    """No step from the result makes it likelier."""
    rng = np.random.default_rng(9)
    a, y = rng.normal(size=(60, 12)).cumsum(axis=0), rng.normal(size=60)

    def loss(b):
        return ((y - a @ b) ** 2).sum() / (2 * 0.5**2) + (b[:2] ** 2).sum() / (2 * 25) + np.abs(b[2:]).sum() / 0.05

    best = forecast.sparse_trend(a, y, 0.5, 5.0, 0.05)
    assert 0 < (best[2:] == 0).sum() < 10
    for _ in range(2000):
        step = rng.normal(size=12) * 10.0 ** rng.uniform(-6, 0) * (rng.random(12) < 0.4)
        assert loss(best + step) >= loss(best) - 1e-6


def test_every_segment_answers(spark):
    n = 60
    y = 500 + 3 * np.arange(n) + 40 * np.cos(2 * np.pi * np.arange(n) / 12)
    zero = y.copy()
    zero[7] = 0.0
    df = frame(spark, y, "whole").withColumn("m", F.lit(None).cast("double")).union(frame(spark, zero, "zero").withColumn("m", F.when(F.month("period") > 3, 1.0)))
    df = df.union(frame(spark, y[:10], "short").withColumn("m", F.lit(1.0))).union(frame(spark, 0 * y, "nothing").withColumn("m", F.lit(1.0)))
    out = forecast.trend_model(df, "k", "v", ["m"]).toPandas()
    reasons = {k: set(part["reason"].dropna()) for k, part in out.groupby("k")}
    assert reasons == {"whole": set(), "zero": set(), "short": {"fewer than 24 observations"}, "nothing": {"no value but zero"}}
    assert (out[out["k"] == "zero"]["forecast"] > 0).all() and len(out[out["k"] == "whole"]) == 24 + n - int(n * 0.8)
