"""Market pages as aggregate queries over the valuation mart."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brickyard import settings
from brickyard.functions.quantiles import aggregate_with_quantiles, exact_quantiles
from brickyard.functions.scalars import borough_name, has, money, ratio, right_closed_bins

C = F.col


def harmonise(df: DataFrame) -> DataFrame:
    """Warehouse names beside the table names, and the derived columns a page expects, where absent."""
    for src, dst in (("yearbuilt", "year_built"), ("numfloors", "num_floors"), ("assesstot", "assessed_total")):
        if has(df, src) and not has(df, dst):
            df = df.withColumn(dst, C(src))
    if has(df, "sale_date") and not has(df, "sale_year"):
        df = df.withColumn("sale_year", F.year(C("sale_date").try_cast("date")))
    if has(df, "sale_price", "gross_square_feet") and not has(df, "price_per_sqft"):
        df = df.withColumn("price_per_sqft", ratio(money(df, "sale_price"), money(df, "gross_square_feet")))
    if has(df, "borough") and not has(df, "borough_name"):
        df = df.withColumn("borough_name", borough_name(C("borough")))
    return df


def apply_filters(df: DataFrame, boroughs: list[str] | None = None, price_millions: tuple[float, float] | None = None) -> DataFrame:
    """Boroughs (none = all) and an inclusive price range in millions."""
    if boroughs and has(df, "borough_name"):
        df = df.where(C("borough_name").isin(boroughs))
    if price_millions and has(df, "sale_price"):
        low, high = (p * 1e6 for p in price_millions)
        df = df.where(C("sale_price").between(low, high))
    return df


def yearly_medians(df: DataFrame, value: str = "price_per_sqft") -> DataFrame:
    known = df.where(C("sale_year").isNotNull())
    return aggregate_with_quantiles(known, ["sale_year"], [F.count(F.lit(1)).alias("n_rows")], {"median": (value, 0.5)})


def kpi_row(df: DataFrame, as_of: dt.date = settings.AS_OF) -> DataFrame:
    """Volume in billions, median price per square foot, count, distress or age, change of the last two years."""
    aggs = [(F.sum("sale_price") / 1e9).alias("total_billion"), F.count(F.lit(1)).alias("n_transactions")]
    if has(df, "distress_probability"):
        aggs.append((F.avg("distress_probability") * 100).alias("avg_distress_pct"))
    elif has(df, "building_age"):
        aggs.append(F.avg("building_age").alias("avg_building_age"))
    elif has(df, "year_built"):
        aggs.append(F.avg(as_of.year - C("year_built")).alias("avg_building_age"))
    out = aggregate_with_quantiles(df, [], aggs, {"median_ppsf": ("price_per_sqft", 0.5)})
    if has(df, "sale_year"):
        by_year = Window.partitionBy(F.lit(1)).orderBy("sale_year")
        change = yearly_medians(df).withColumn("change", (C("median") / F.lag("median").over(by_year) - 1) * 100)
        out = out.withColumn("yoy_pct", change.agg(F.max_by("change", "sale_year")).scalar())
    return out


def yearly_volume(df: DataFrame) -> DataFrame:
    return df.where(C("sale_year").isNotNull()).groupBy("sale_year").agg(
        F.count("sale_price").alias("n_sales"), F.sum("sale_price").alias("total_value"))


def borough_summary(df: DataFrame) -> DataFrame:
    """Counts, means and medians by borough, rounded half to even, dearest median first."""
    aggs = [F.count("sale_price").alias("n_sales"), F.avg("sale_price").alias("avg_price"),
            F.avg("price_per_sqft").alias("avg_ppsf")]
    if has(df, "building_age"):
        aggs.append(F.avg("building_age").alias("avg_age"))
    medians = {"median_price": ("sale_price", 0.5), "median_ppsf": ("price_per_sqft", 0.5)}
    out = aggregate_with_quantiles(df.where(C("borough_name").isNotNull()), ["borough_name"], aggs, medians)
    rounded = {c: F.rint(c) for c in out.columns if c not in ("borough_name", "n_sales")}
    return out.withColumns(rounded).orderBy(C("median_price").desc_nulls_last(), "borough_name")


def quarterly_ppsf(df: DataFrame) -> DataFrame:
    dated = df.where(C("sale_date").isNotNull() & C("borough_name").isNotNull()).withColumn("quarter", F.trunc("sale_date", "quarter"))
    return aggregate_with_quantiles(dated, ["quarter", "borough_name"], [F.count(F.lit(1)).alias("n_sales")],
                                    {"median_ppsf": ("price_per_sqft", 0.5)})


def annual_metrics(df: DataFrame) -> DataFrame:
    """Yearly medians and the percent change of the price per square foot (gaps are filled forward first)."""
    aggs = [F.avg("building_age").alias("avg_building_age")] if has(df, "building_age") else [F.count(F.lit(1)).alias("n_sales")]
    medians = {"median_price": ("sale_price", 0.5), "median_ppsf": ("price_per_sqft", 0.5)}
    out = aggregate_with_quantiles(df.where(C("sale_year").isNotNull()), ["sale_year"], aggs, medians)
    years = Window.partitionBy(F.lit(1)).orderBy("sale_year")
    filled = out.withColumn("filled", F.last("median_ppsf", ignorenulls=True).over(years.rowsBetween(Window.unboundedPreceding, 0)))
    return filled.withColumn("price_yoy_pct", (ratio(C("filled"), F.lag("filled").over(years)) - 1) * 100).drop("filled")


def cluster_sizes(df: DataFrame) -> DataFrame:
    return df.groupBy("cluster").agg(F.count(F.lit(1)).alias("n_properties"))


def cluster_medians(df: DataFrame) -> DataFrame:
    medians = {f"median_{c}": (c, 0.5) for c in ("price_per_sqft", "gross_square_feet", "building_age", "dist_to_cbd_km") if has(df, c)}
    return aggregate_with_quantiles(df, ["cluster"], [F.count("sale_price").alias("n_sales")], medians)


def risk_tier_counts(df: DataFrame) -> DataFrame:
    tiers = [name for name, _ in settings.RISK_TIERS]
    return df.agg(*[F.count_if(C("risk_tier") == t).alias(t.lower().replace(" ", "_")) for t in tiers])


def risk_by_borough(df: DataFrame) -> DataFrame:
    return (df.where(C("borough_name").isNotNull()).groupBy("borough_name")
            .agg(F.avg("distress_probability").alias("avg_distress"))
            .orderBy(C("avg_distress").desc(), "borough_name"))


def risk_by_neighborhood(df: DataFrame, min_sales: int = 10, top: int = 20) -> DataFrame:
    return (df.where(C("neighborhood").isNotNull()).groupBy("neighborhood")
            .agg(F.avg("distress_probability").alias("avg_distress"), F.count("sale_price").alias("n_properties"))
            .where(C("n_properties") >= min_sales).orderBy(C("avg_distress").desc(), "neighborhood").limit(top))


def market_activity(df: DataFrame) -> DataFrame:
    """Sales per neighbourhood with borough and city totals (NULL = total)."""
    known = df.where(C("borough_name").isNotNull() & C("neighborhood").isNotNull())
    return known.rollup("borough_name", "neighborhood").agg(F.count(F.lit(1)).alias("transactions"))


def histogram(df: DataFrame, value: str, bins: int, by: list[str] | None = None) -> DataFrame:
    """Equal-width bins between the column's minimum and maximum; empty bins are absent."""
    ends = df.agg(F.struct(F.min(value).alias("low"), F.max(value).alias("high"))).scalar()
    low, high = ends["low"], ends["high"]
    position = F.floor(ratio(C(value) - low, high - low) * bins)
    number = F.least(F.coalesce(position, F.lit(0)), F.lit(bins - 1)).cast("int")
    return (df.where(C(value).isNotNull()).withColumn("bin", number)
            .groupBy(*(by or []), "bin").agg(F.count(F.lit(1)).alias("n")))


def box_stats(df: DataFrame, value: str, key: str) -> DataFrame:
    """Five-number summary of the positive values per group."""
    wanted = {"q1": (value, 0.25), "median": (value, 0.5), "q3": (value, 0.75)}
    positive = df.where(C(value).isNotNull() & (C(value) > 0) & C(key).isNotNull())
    return aggregate_with_quantiles(positive, [key], [
        F.min(value).alias("low"), F.max(value).alias("high"), F.count(F.lit(1)).alias("n")], wanted)


def marker_colors(df: DataFrame, value: str) -> DataFrame:
    """Map marker colour by the global 50 and 75 percent quantiles."""
    cuts = exact_quantiles(df, [], {"q50": (value, 0.5), "q75": (value, 0.75)}).select(F.struct("q50", "q75")).scalar()
    color = (F.when(C(value).isNull(), "gray").when(C(value) > cuts["q75"], "red").when(C(value) > cuts["q50"], "orange")
             .otherwise("green"))
    return df.withColumn("marker_color", color)


def neighborhood_rollup(df: DataFrame) -> DataFrame:
    aggs = [F.avg("sale_price").alias("avg_price"), F.count("sale_price").alias("n_transactions"),
            F.avg("price_per_sqft").alias("avg_ppsf"), F.avg("building_age").alias("avg_building_age"),
            F.avg("dist_to_cbd_km").alias("avg_dist_cbd"), F.avg("latitude").alias("centroid_lat"),
            F.avg("longitude").alias("centroid_lon")]
    medians = {"median_price": ("sale_price", 0.5), "median_ppsf": ("price_per_sqft", 0.5)}
    return aggregate_with_quantiles(df.where(C("neighborhood").isNotNull()), ["neighborhood"], aggs, medians)


def top_rows(df: DataFrame, value: str, n: int = 20, ties: list[str] | None = None) -> DataFrame:
    """The n largest values; ties fall to the remaining columns in name order."""
    rest = ties or [c for c in sorted(df.columns) if c != value]
    return df.orderBy(C(value).desc_nulls_last(), *rest).limit(n)


def repeatable_sample(df: DataFrame, n: int, keys: list[str], seed: int = 42) -> DataFrame:
    """At most n rows, the same ones on every run: the smallest seeded hashes of the keys."""
    order = F.xxhash64(*keys, F.lit(seed))
    return df.orderBy(order, *keys).limit(n)


def distance_price_points(df: DataFrame, n: int = 4000) -> DataFrame:
    points = df.where(C("dist_to_cbd_km").isNotNull() & C("sale_price").isNotNull()).select("bbl", "borough_name", "dist_to_cbd_km", "sale_price")
    return repeatable_sample(points, n, points.columns)


def parallel_coordinates(df: DataFrame, n: int = 2000) -> DataFrame:
    wanted = ["price_per_sqft", "gross_square_feet", "building_age", "dist_to_cbd_km", "floor_area_ratio"]
    cols = [c for c in wanted if has(df, c)]
    return repeatable_sample(df.select(*cols, "cluster").dropna(), n, [*cols, "cluster"])


def size_price_points(df: DataFrame, n: int = 3000) -> DataFrame:
    wanted = ["gross_square_feet", "sale_price", "neighborhood", "price_per_sqft", "borough_name", "num_floors"]
    cols = [c for c in wanted if has(df, c)]
    return repeatable_sample(df.select(*cols), n, cols)


def risk_tier(probability: Column) -> Column:
    return right_closed_bins(probability, settings.RISK_TIERS)
