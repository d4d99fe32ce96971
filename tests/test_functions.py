import math

import numpy as np
import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from brickyard.functions.gram import Moments, gram
from brickyard.functions.quantiles import exact_quantiles, running_totals
from brickyard.functions.scalars import haversine_km, normal_cdf


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.tuples(st.sampled_from(["a", "b", None]), st.one_of(st.none(), st.floats(-1e9, 1e9, allow_nan=False).map(lambda v: round(v, 3)))), min_size=1, max_size=60))
def test_quantiles_match_numpy(spark, data):
    df = spark.createDataFrame(data, "k string, v double")
    out = {r["k"]: r for r in exact_quantiles(df, ["k"], {"m": ("v", 0.5), "q": ("v", 0.1), "t": ("v", 0.75)}).collect()}
    for key in {k for k, _ in data}:
        values = [v for k, v in data if k == key and v is not None]
        if not values:
            assert key not in out
            continue
        for name, p in (("m", 0.5), ("q", 0.1), ("t", 0.75)):
            assert out[key][name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_quantiles_of_a_hot_group(spark):
    """Nine tenths of the rows in one group, many equal values, zeros and negatives."""
    df = spark.range(100000).select(
        F.when(F.col("id") % 10 == 0, "cold").otherwise("hot").alias("k"),
        F.when(F.col("id") % 3 == 0, 0.0).otherwise((F.col("id") * 7919 % 100003).cast("double") - 30000).alias("v"))
    got = {r["k"]: (r["m"], r["q"]) for r in exact_quantiles(df, ["k"], {"m": ("v", 0.5), "q": ("v", 0.05)}).collect()}
    want = {r["k"]: tuple(r["p"]) for r in df.groupBy("k").agg(F.percentile("v", F.array(F.lit(0.5), F.lit(0.05))).alias("p")).collect()}
    assert got == {k: pytest.approx(v) for k, v in want.items()}


def test_running_totals(spark):
    pdf = pd.DataFrame({"x": np.random.default_rng(0).permutation(np.linspace(-5, 5, 400)), "n": 1})
    out = running_totals(spark.createDataFrame(pdf), "x", {"c": "n"}).toPandas().sort_values("x")
    assert (out["c"].to_numpy() == np.arange(1, 401)).all()


def test_normal_cdf_and_distance(spark):
    xs = [-6.0, -1.0, 0.0, 0.3, 2.5]
    got = [r[0] for r in spark.createDataFrame([(x,) for x in xs], "x double").select(normal_cdf(F.col("x"))).collect()]
    assert got == pytest.approx([0.5 * math.erfc(-x / math.sqrt(2)) for x in xs], abs=2e-7)
    quarter = spark.range(1).select(haversine_km(F.lit(0.0), F.lit(0.0), F.lit(0.0), F.lit(90.0))).first()[0]
    assert quarter == pytest.approx(6371 * math.pi / 2)
    assert spark.range(1).select(haversine_km(F.lit(None).cast("double"), F.lit(0.0), F.lit(0.0), F.lit(90.0))).first()[0] is None


def test_gram_and_penalised_fits(spark):
    rng = np.random.default_rng(1)
    x = rng.normal(size=(500, 3))
    y = x @ [1.0, -2.0, 0.0] + 3 + 0.1 * rng.normal(size=500)
    pdf = pd.DataFrame(np.column_stack([np.ones(500), x, y]), columns=["one", "a", "b", "c", "y"])
    df = spark.createDataFrame(pdf).repartition(5)
    m = gram(df, list(pdf.columns))[0]
    assert np.allclose(m, pdf.to_numpy().T @ pdf.to_numpy())
    moments = Moments(m)
    z = (x - x.mean(0)) / x.std(0)
    ridge = np.linalg.solve(z.T @ z + 10 * np.eye(3), z.T @ (y - y.mean()))
    assert np.allclose(moments.fit(10.0, None)[1:], ridge / x.std(0))
    lasso = moments.fit(0.5, 1.0)
    assert abs(lasso[3]) < 1e-12 and abs(lasso[2]) < 2
    assert moments.r2(moments.fit(0.0, None)) > 0.99
