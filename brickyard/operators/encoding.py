"""Categorical encodings, imputation, scaling and principal components."""

from __future__ import annotations

import numpy as np
from pyspark.ml.feature import PCA, VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from brickyard import settings
from brickyard.functions.quantiles import null_safe_join, quantile_row, running_totals
from brickyard.functions.scalars import has
from brickyard.session import written

C = F.col


def one_hot(df: DataFrame, column: str, categories: list | None = None, keep_source: bool = True, max_width: int = 500) -> DataFrame:
    """Indicator columns `<column>_<value>` for all but the first category in sorted order.

    A table gets one column per category, so more than `max_width` of them is an error, never a silent cut.
    """
    if categories is None:
        rows = df.where(C(column).isNotNull()).select(column).distinct().limit(max_width + 1).collect()
        if len(rows) > max_width:
            raise ValueError(f"{column} has more than {max_width} categories; use label or target encoding")
        categories = sorted(r[0] for r in rows)
    added = {f"{column}_{v}": F.when(C(column) == v, 1).otherwise(0) for v in categories[1:]}
    out = df.withColumns(added) if added else df
    return out if keep_source else out.drop(column)


def label_codes(df: DataFrame, column: str) -> DataFrame:
    """Distinct non-NULL values with codes 0..k-1 in string order, ranked range by range."""
    values = df.where(C(column).isNotNull()).select(C(column).cast("string").alias("value")).distinct().withColumn("one", F.lit(1))
    return running_totals(values, "value", {"upto": "one"}).select("value", (C("upto") - 1).cast("double").alias("code"))


def label_encode(df: DataFrame, column: str) -> DataFrame:
    codes = written(label_codes(df, column)).select(C("value").alias("__value"), C("code").alias(f"{column}_encoded"))
    return df.join(codes, C(column).cast("string") == C("__value"), "left").drop("__value")


def target_encode(
    df: DataFrame, column: str, target: str = "sale_price", fold_key: str | None = None,
    folds: int = settings.FOLDS, smoothing: float = settings.TARGET_SMOOTHING,
) -> DataFrame:
    """Smoothed target means: out of fold (`_target_encoded`) and over all rows (`_target_encoded_global`).

    One aggregation per (value, fold), stored, so Spark knows its size and needn't shuffle the rows to join it. The out-of-fold sums are the value's totals minus its own fold, so there is
    no loop over folds. The fold is a fixed function of `fold_key` (or of the whole row).
    """
    key = F.xxhash64(*[C(c) for c in df.columns]) if fold_key is None else C(fold_key)
    rows = df.withColumn("__fold", F.pmod(key, F.lit(folds)).cast("int"))
    cells = rows.groupBy(column, "__fold").agg(F.sum(target).alias("__s"), F.count(target).alias("__c"))
    whole = Window.partitionBy(column)  # at most `folds` rows per value
    mean = df.agg(F.avg(target)).scalar()
    prior = smoothing * C("__mean")
    cells = cells.withColumns({
        "__mean": mean,
        "__rest_s": F.coalesce(F.sum("__s").over(whole), F.lit(0.0)) - F.coalesce(C("__s"), F.lit(0.0)),
        "__rest_c": F.sum("__c").over(whole) - C("__c"),
        "__all_s": F.coalesce(F.sum("__s").over(whole), F.lit(0.0)),
        "__all_c": F.sum("__c").over(whole),
    })
    unseen = C(column).isNull()
    encoded = cells.select(
        column, "__fold",
        F.when(unseen | (C("__rest_c") == 0), C("__mean")).otherwise((C("__rest_s") + prior) / (C("__rest_c") + smoothing))
        .alias(f"{column}_target_encoded"),
        F.when(unseen | (C("__all_c") == 0), C("__mean")).otherwise((C("__all_s") + prior) / (C("__all_c") + smoothing))
        .alias(f"{column}_target_encoded_global"),
    )
    return null_safe_join(rows, written(encoded), [column, "__fold"]).drop("__fold")


def missing_fractions(df: DataFrame) -> DataFrame:
    """Share of NULLs of every column, one row, one pass, with one number a column to add up."""
    counts = df.agg(F.count(F.lit(1)).alias("__rows"), *[F.count(C(c)).alias(c) for c in df.columns])
    return counts.select(*[F.try_divide(C("__rows") - C(c), C("__rows")).alias(c) for c in df.columns])


def column_modes(df: DataFrame, columns: list[str]) -> DataFrame:
    """Most frequent value per column, ties to the smallest: (column, mode)."""
    pairs = F.array(*[F.struct(F.lit(c).alias("column"), C(c).cast("string").alias("value")) for c in columns])
    counts = df.select(F.explode(pairs).alias("p")).select("p.*").where(C("value").isNotNull()).groupBy("column", "value").count()
    return counts.groupBy("column").agg(F.min_by("value", F.struct(-C("count"), C("value"))).alias("mode"))


def handle_sparseness(df: DataFrame, threshold: float = settings.SPARSE_THRESHOLD) -> DataFrame:
    """Drop columns with more than `threshold` missing; fill numbers with the exact median, text with the mode.

    Only columns that do have gaps are ranked or counted.
    """
    missing = missing_fractions(df).first().asDict()
    df = df.drop(*[c for c, share in missing.items() if share is not None and share > threshold])
    gaps = [f for f in df.schema.fields if missing[f.name]]
    numeric = [f.name for f in gaps if isinstance(f.dataType, T.NumericType)]
    text = [f.name for f in gaps if isinstance(f.dataType, T.StringType)]
    fills = {}
    if numeric:
        medians = quantile_row(df, {c: (c, 0.5) for c in numeric})
        fills.update({c: F.coalesce(C(c).cast("double"), F.lit(medians[c])) for c in numeric if medians[c] is not None})
    if text:
        modes = {r["column"]: r["mode"] for r in column_modes(df, text).collect()}
        fills.update({c: F.coalesce(C(c), F.lit(modes.get(c, "Unknown"))) for c in text})
    return df.withColumns(fills) if fills else df


def median_impute(df: DataFrame, columns: list[str]) -> DataFrame:
    """Fill the gaps of numeric columns with their exact medians."""
    with_gaps = df.agg(*[F.count_if(C(c).isNull()).alias(c) for c in columns]).first().asDict()
    gaps = [c for c in columns if with_gaps[c]]
    if not gaps:
        return df
    medians = quantile_row(df, {c: (c, 0.5) for c in gaps})
    return df.withColumns({c: F.coalesce(C(c).cast("double"), F.lit(medians[c])) for c in gaps if medians[c] is not None})


def scaling(df: DataFrame, columns: list[str]) -> dict[str, tuple[float, float]]:
    """Mean and population deviation per column (a constant column keeps scale one)."""
    row = df.agg(*[F.struct(F.avg(c).alias("m"), F.stddev_pop(c).alias("s")).alias(c) for c in columns]).first()
    return {c: (row[c]["m"], row[c]["s"] or 1.0) for c in columns}


def standardise(df: DataFrame, columns: list[str], scale: dict[str, tuple[float, float]] | None = None, prefix: str = "z_") -> DataFrame:
    scale = scale or scaling(df, columns)
    return df.withColumns({f"{prefix}{c}": (C(c).cast("double") - scale[c][0]) / scale[c][1] for c in columns})


def principal_components(df: DataFrame, columns: list[str], n: int = 10, variance: float | None = 0.95) -> tuple[DataFrame, list[float]]:
    """Scores `pca_1..` of the standardised columns and the explained shares.

    Takes the fewest components that reach `variance`, at most n. Each component's largest loading is positive.
    """
    columns = [c for c in columns if has(df, c)]
    scaled = standardise(median_impute(df, columns), columns)
    vectors = VectorAssembler(inputCols=[f"z_{c}" for c in columns], outputCol="__x").transform(scaled)
    model = PCA(k=len(columns), inputCol="__x", outputCol="__pc").fit(vectors)
    shares = model.explainedVariance.toArray()
    take = min(n, len(columns))
    if variance is not None:
        take = min(take, int(np.argmax(np.cumsum(shares) >= variance - 1e-12)) + 1)
    loadings = model.pc.toArray()
    signs = [1.0 if loadings[np.argmax(np.abs(loadings[:, i])), i] >= 0 else -1.0 for i in range(take)]
    scores = model.transform(vectors).withColumn("__a", vector_to_array("__pc"))
    out = scores.withColumns({f"pca_{i + 1}": C("__a")[i] * signs[i] for i in range(take)})
    return out.drop("__x", "__pc", "__a", *[f"z_{c}" for c in columns]), [float(s) for s in shares[:take]]
