"""Quantiles of crowded buckets and ranks by ranges."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from brickyard.functions import quantiles
from brickyard.operators.encoding import label_codes


def test_a_million_values_in_one_bucket(spark):
    """Steps of 1e-9 above one: all in the same 256th of an octave."""
    n = 1_000_000
    df = spark.range(n).select((1 + F.col("id") * 1e-9).alias("v"))
    assert df.select(quantiles.value_bucket(F.col("v")).alias("b")).distinct().count() == 1
    got = quantiles.quantile_row(df, {"low": ("v", 0.1), "mid": ("v", 0.5), "high": ("v", 0.999)})
    x = 1 + np.arange(n) * 1e-9
    assert [got["low"], got["mid"], got["high"]] == pytest.approx(np.quantile(x, [0.1, 0.5, 0.999]).tolist(), abs=1e-15)


@pytest.fixture
def small_windows(monkeypatch):
    monkeypatch.setattr(quantiles, "FIXED", 50)
    monkeypatch.setattr(quantiles, "STEPS", 8)


@pytest.mark.parametrize("small", [200_000, 0])
def test_refined_buckets_of_groups(spark, small_windows, monkeypatch, small):
    monkeypatch.setattr(quantiles, "SMALL", small)
    rng = np.random.default_rng(2)
    rows = [("hot", float(v)) for v in np.concatenate([1 + rng.random(3000) * 1e-3, np.full(1500, 1.0002), rng.normal(0, 100, 300), -1 - rng.random(2000) * 1e-6])]
    rows += [("near", 1 + float(k) * 2.0**-52) for k in range(400)] + [("wide", float(v)) for v in np.exp(rng.uniform(-300, 300, 500))] + [(None, 5.0)] * 200 + [("hot", None)]
    df = spark.createDataFrame(rows, "g string, v double").repartition(4)
    wanted = {f"q{i}": ("v", p) for i, p in enumerate((0.0, 0.01, 0.25, 0.5, 0.75, 0.93, 1.0))}
    got = {r["g"]: r for r in quantiles.exact_quantiles(df, ["g"], wanted).collect()}
    for g in ("hot", "near", "wide", None):
        x = np.array([v for k, v in rows if k == g and v is not None])
        for name, (_, p) in wanted.items():
            assert got[g][name] == pytest.approx(np.quantile(x, p), rel=1e-13), (g, name)


def test_windows_stay_small(spark, small_windows):
    df = spark.range(5000).select((1 + F.col("id") * 1e-9).alias("__value"), F.lit(1).cast("long").alias("__n"), F.lit("0").alias("__bucket"), F.lit(0).alias("__metric"),
                                  F.lit(0).cast("long").alias("__before"), F.expr("array(struct(0.5D AS p, 0 AS side, 2499L AS rank, 0.5D AS frac))").alias("__hits"))
    left = quantiles._refined(df, ["__metric"], lambda low, size: lambda r: (r["rank"] >= low) & (r["rank"] < low + size))
    found = left.agg(F.count("*").alias("n"), F.min("__before").alias("b"), F.min("__value").alias("v"), F.countDistinct("__bucket").alias("k")).first()
    assert found["n"] <= 50 and found["k"] == 1 and found["v"] == pytest.approx(1 + found["b"] * 1e-9, abs=1e-15)


@pytest.fixture
def uncoalesced(spark):
    """Ranges as they are dealt: Spark joins small ones otherwise."""
    name = "spark.sql.adaptive.coalescePartitions.enabled"
    before = spark.conf.get(name)
    spark.conf.set(name, "false")
    yield
    spark.conf.set(name, before)


def test_labels_with_one_prefix_spread_over_ranges(spark, uncoalesced):
    n = 100_000
    labels = spark.range(n).select(F.format_string("the same beginning %06d", F.col("id")).alias("label"))
    doubled = labels.union(labels).union(spark.createDataFrame([(None,)], "label string"))
    got = label_codes(doubled, "label")
    assert got.count() == n
    assert got.where(F.col("code") != F.substring("value", -6, 6).cast("double")).count() == 0
    parts = [r["count"] for r in quantiles.in_ranges(labels, ["label"]).groupBy("__part").count().collect()]
    assert len(parts) == int(spark.conf.get("spark.sql.shuffle.partitions")) and max(parts) < 2 * n / len(parts)


def test_running_totals_of_a_large_key(spark, uncoalesced):
    rng = np.random.default_rng(5)
    rows = [(k, float(v), int(n)) for k, size in (("big", 4000), ("small", 7), (None, 50)) for v, n in zip(rng.permutation(size) / 7, rng.integers(0, 9, size))]
    df = spark.createDataFrame(rows, "k string, v double, n long").repartition(5)
    got = {(r["k"], r["v"]): r["t"] for r in quantiles.running_totals(df, "v", {"t": "n"}, ["k"]).collect()}
    for key in ("big", "small", None):
        total = 0
        for _, v, n in sorted((r for r in rows if r[0] == key), key=lambda r: r[1]):
            total += n
            assert got[key, v] == total
    assert quantiles.running_totals(df.limit(0), "v", {"t": "n"}).count() == 0
