"""Monthly market series: resampling, momentum, decomposition, macro alignment.

Sales are aggregated to one row per (segment, month) first; every window below runs over that small table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brickyard import settings
from brickyard.functions.quantiles import aggregate_with_quantiles
from brickyard.functions.scalars import has, ratio

C = F.col


def price_series(sales: DataFrame, freq: str = "month", metric: str = "median", group_by: str | None = None) -> DataFrame:
    """Price, price per square foot and volume per period; empty periods are kept with volume 0.

    Every segment has its own first and last period. `freq` is 'month' or 'quarter'.
    """
    keys = [group_by] if group_by else []
    df = sales.where(C("sale_date").isNotNull() & C("sale_price").isNotNull())
    if group_by:
        df = df.where(C(group_by).isNotNull())
    df = df.withColumn("period", F.trunc("sale_date", freq))
    values = [c for c in ("sale_price", "price_per_sqft") if has(df, c)]
    volume = F.count("sale_price").alias("transaction_volume")
    if metric == "median":
        tall = df.withColumns({f"__{c}": C(c) for c in values})
        agg = aggregate_with_quantiles(tall, [*keys, "period"], [volume], {c: (f"__{c}", 0.5) for c in values})
    else:
        agg = df.groupBy(*keys, "period").agg(volume, *[F.avg(c).alias(c) for c in values])
    # the first and last period come from the raw dates, so the calendar needs no second look at the result
    ends = df.groupBy(*keys).agg(F.min("period").alias("lo"), F.max("period").alias("hi"))
    step = F.expr("interval 1 month" if freq == "month" else "interval 3 months")
    calendar = ends.select(*keys, F.explode(F.sequence("lo", "hi", step)).alias("period"))
    out = calendar.join(agg, [*keys, "period"], "left").fillna(0, ["transaction_volume"])
    return out.select(*keys, "period", "transaction_volume", *values)


def _over(keys: list[str], order: str = "period"):
    return Window.partitionBy(*(keys or [F.lit(1)])).orderBy(order)


def _rolling(fn, value: str, months: int, least: int, w) -> Column:
    span = w.rowsBetween(-(months - 1), 0)
    return F.when(F.count(value).over(span) >= least, fn(value).over(span))


def momentum(series: DataFrame, value: str, keys: list[str] | None = None) -> DataFrame:
    """Moving averages, changes, volatility, z-score and trend signal of one series per segment."""
    w = _over(keys or [])
    known = F.last(value, ignorenulls=True).over(w.rowsBetween(Window.unboundedPreceding, 0))
    out = series.withColumn("__known", known)

    def change(n: int) -> Column:
        return ratio(C("__known"), F.lag("__known", n).over(w)) - 1

    out = out.withColumns({
        "ma_6m": _rolling(F.avg, value, 6, 3, w), "ma_12m": _rolling(F.avg, value, 12, 6, w),
        "yoy_change": change(12), "momentum_6m": change(6),
        "volatility_12m": _rolling(F.stddev_samp, value, 12, 6, w),
    })
    return out.withColumns({
        "z_score": ratio(C(value) - C("ma_12m"), C("volatility_12m")),
        "trend_signal": F.when(C("ma_6m") > C("ma_12m"), "bullish").otherwise("bearish"),
    }).drop("__known")


def decompose(series: DataFrame, value: str, keys: list[str] | None = None, season: int = settings.SEASON, model: str = "additive") -> DataFrame:
    """Classical decomposition: centred moving average, seasonal means, residual. Segments shorter than two
    seasons are left out. NULL observations are dropped first, as positions, not dates, define the season."""
    keys = keys or []
    part = keys or [F.lit(1)]
    w, whole = _over(keys), Window.partitionBy(*part)
    df = series.where(C(value).isNotNull()).withColumns({
        "__i": F.row_number().over(w) - 1, "__n": F.count(F.lit(1)).over(whole)}).where(C("__n") >= 2 * season)
    half = season // 2
    if season % 2 == 0:
        left, right = w.rowsBetween(-half, half - 1), w.rowsBetween(-half + 1, half)
        average = (F.sum(value).over(left) + F.sum(value).over(right)) / (2 * season)
    else:
        average = F.avg(value).over(w.rowsBetween(-half, half))
    inside = (C("__i") >= half) & (C("__i") < C("__n") - half)
    df = df.withColumn("trend", F.when(inside, average))
    detrended = C(value) - C("trend") if model == "additive" else ratio(C(value), C("trend"))
    df = df.withColumns({"__d": detrended, "__phase": C("__i") % season})
    by_phase = Window.partitionBy(*part, "__phase")
    df = df.withColumns({"__mean": F.avg("__d").over(by_phase), "__rows": F.count(F.lit(1)).over(by_phase)})
    level = F.sum(C("__mean") / C("__rows")).over(whole) / season
    df = df.withColumn("seasonal", C("__mean") - level if model == "additive" else C("__mean") / level)
    residual = C("__d") - C("seasonal") if model == "additive" else C("__d") / C("seasonal")
    return df.select(*keys, "period", C(value).alias("observed"), "trend", "seasonal", residual.alias("residual"))


def align_macro(series: DataFrame, macro: DataFrame, columns: list[str], keys: list[str] | None = None) -> DataFrame:
    """Macro values for each period: the exact month, else the last known one before, else the next known one."""
    w = _over(keys or [])
    past, future = w.rowsBetween(Window.unboundedPreceding, 0), w.rowsBetween(0, Window.unboundedFollowing)
    joined = series.join(macro.select(C("month").alias("period"), *columns), "period", "left")
    return joined.withColumns({c: F.coalesce(F.last(c, ignorenulls=True).over(past), F.first(c, ignorenulls=True).over(future)) for c in columns})


def difference(series: DataFrame, value: str, keys: list[str] | None = None, season: int = settings.SEASON) -> DataFrame:
    """First and seasonal differences of a series: d1, d12 and both."""
    w = _over(keys or [])
    out = series.withColumn("diff_1", C(value) - F.lag(value, 1).over(w))
    out = out.withColumn(f"diff_{season}", C(value) - F.lag(value, season).over(w))
    return out.withColumn("diff_both", C("diff_1") - F.lag("diff_1", season).over(w))


def chronological_split(series: DataFrame, keys: list[str] | None = None, share: float = 0.8) -> DataFrame:
    """`is_train` marks the first floor(share * n) periods of each segment."""
    keys = keys or []
    n = F.count(F.lit(1)).over(Window.partitionBy(*(keys or [F.lit(1)])))
    return series.withColumn("is_train", (F.row_number().over(_over(keys)) <= F.floor(n * share)).cast("int"))


def forecast_errors(df: DataFrame, actual: str, predicted: str, keys: list[str] | None = None) -> DataFrame:
    """MAE, RMSE and MAPE (in percent) of predictions."""
    error = C(actual) - C(predicted)
    return df.groupBy(*(keys or [])).agg(
        F.avg(F.abs(error)).alias("mae"), F.sqrt(F.avg(error * error)).alias("rmse"),
        (F.avg(F.abs(ratio(error, C(actual)))) * 100).alias("mape"), F.count(F.lit(1)).alias("n_test"))
