"""Joins of the staged feeds into the property feature table."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard import settings
from brickyard.functions.quantiles import aggregate_with_quantiles
from brickyard.functions.scalars import haversine_km, has, ratio


def _as_is(df: DataFrame) -> DataFrame:
    return df


def merge_parcels(sales: DataFrame, parcels: DataFrame) -> DataFrame:
    """Sales with their parcel, left join on the trimmed id; clashing parcel columns get the suffix `_pluto`."""
    if not (has(sales, "bbl") and has(parcels, "bbl")):
        return sales
    left = sales.withColumn("bbl", F.trim(F.col("bbl").cast("string")))
    clash = {c: f"{c}_pluto" for c in parcels.columns if c in sales.columns and c != "bbl"}
    right = parcels.withColumn("bbl", F.trim(F.col("bbl").cast("string"))).withColumnsRenamed(clash)
    return left.join(right, "bbl", "left")


def neighborhood_stats(sales: DataFrame, with_ppsf: bool = False, count_rows: bool = False, exact: bool = True) -> DataFrame:
    """Price level, spread and volume per neighbourhood (NULL neighbourhoods are left out)."""
    aggs = [
        F.avg("sale_price").alias("neighborhood_avg_price"),
        F.count(F.lit(1) if count_rows else F.col("sale_price")).alias("neighborhood_sales_volume"),
        F.stddev_samp("sale_price").alias("neighborhood_price_std"),
    ]
    if with_ppsf:
        aggs.append(F.avg("price_per_sqft").alias("neighborhood_avg_ppsf"))
    known = sales.where(F.col("neighborhood").isNotNull())
    return aggregate_with_quantiles(
        known, ["neighborhood"], aggs, {"neighborhood_median_price": ("sale_price", 0.5)}, exact)


def zip_permit_activity(permits: DataFrame) -> DataFrame:
    return permits.groupBy("zip_code").agg(
        F.count(F.lit(1)).alias("permit_count"),
        F.sum("estimated_job_cost").alias("total_permit_value"),
        F.count_if(F.col("job_type") == "NB").alias("new_building_permits"),
        F.count_if(F.col("job_type") == "DM").alias("demolition_permits"),
    )


def with_neighborhood_context(sales: DataFrame, exact: bool = True, settle: Callable[[DataFrame], DataFrame] = _as_is) -> DataFrame:
    """Sales with their neighbourhood's level. `settle` may store tables that are read again: prices by neighbourhood, and the statistics."""
    if not has(sales, "neighborhood", "sale_price"):
        return sales
    prices = settle(sales.select("neighborhood", "sale_price"))
    out = sales.join(settle(neighborhood_stats(prices, exact=exact)), "neighborhood", "left")
    return out.withColumn("price_vs_neighborhood", ratio(F.col("sale_price"), F.col("neighborhood_avg_price")))


def with_permit_context(sales: DataFrame, permits: DataFrame | None, settle: Callable[[DataFrame], DataFrame] = _as_is) -> DataFrame:
    if permits is None or not (has(sales, "zip_code") and has(permits, "zip_code")):
        return sales
    counts = (permits.where(F.col("zip_code").isNotNull())
              .groupBy(F.trim(F.col("zip_code").cast("string")).alias("zip_code"))
              .agg(F.count(F.lit(1)).alias("neighborhood_permit_activity")))
    out = sales.withColumn("zip_code", F.trim(F.col("zip_code").cast("string"))).join(settle(counts), "zip_code", "left")
    return out.fillna(0, ["neighborhood_permit_activity"])


def with_violation_context(sales: DataFrame, violations: DataFrame | None, settle: Callable[[DataFrame], DataFrame] = _as_is) -> DataFrame:
    """Violations per borough; the feed's key is `boroid` or, failing that, `boroughid`."""
    if violations is None or not has(sales, "borough"):
        return sales
    key = next((c for c in ("boroid", "boroughid") if has(violations, c)), None)
    if key is None:
        return sales
    counts = (violations.where(F.col(key).isNotNull()).groupBy(F.col(key).cast("string").alias("__boro"))
              .agg(F.count(F.lit(1)).alias("borough_violation_count")))
    joined = sales.join(settle(counts), F.col("borough").cast("string") == F.col("__boro"), "left").drop("__boro")
    return joined.fillna(0, ["borough_violation_count"])


def violation_counts(violations: DataFrame) -> DataFrame:
    """All and severe violations per parcel, in one aggregation."""
    aggs = [F.count(F.lit(1)).alias("violation_count")]
    if has(violations, "class"):
        aggs.append(F.count_if(F.col("class").isin(settings.SEVERE_CLASSES)).alias("severe_violation_count"))
    else:
        aggs.append(F.lit(0).cast("long").alias("severe_violation_count"))
    return violations.where(F.col("bbl").isNotNull()).groupBy("bbl").agg(*aggs)


def with_violation_counts(properties: DataFrame, violations: DataFrame) -> DataFrame:
    out = properties.join(violation_counts(violations), "bbl", "left")
    return out.fillna(0, ["violation_count", "severe_violation_count"])


def height_class_open(floors) -> F.Column:
    """Warehouse rule: everything above 60 floors, and an unknown height, counts as supertall."""
    out = F.lit("supertall")
    for label, edge in reversed(settings.HEIGHT_CLASSES[:-1]):
        out = F.when(floors <= edge, F.lit(label)).otherwise(out)
    return out


def property_features_warehouse(
    sales: DataFrame, parcels: DataFrame, permits: DataFrame, exact: bool = True, with_neighborhood: bool = True
) -> DataFrame:
    """Warehouse sales with parcel, neighbourhood and zip columns; every sale is kept.

    The neighbourhood columns cost two more passes over the sales; a reader that needs none leaves them out.
    """
    c = F.col
    parcel = parcels.select(
        "parcel_id", "lot_area_sqft", "building_area_sqft", "commercial_area_sqft", "office_area_sqft",
        "retail_area_sqft", "num_floors", "assessed_total", "assessed_land", "floor_area_ratio", "building_age",
        "zoning_district", "building_class", "owner_name", "latitude", "longitude")
    zips = zip_permit_activity(permits).select(
        "zip_code", c("permit_count").alias("zip_permit_count"), c("total_permit_value").alias("zip_total_permit_value"),
        c("new_building_permits").alias("zip_new_building_permits"))
    lat, lon = settings.LANDMARKS[settings.CBD]
    out = (
        sales.join(parcel, "parcel_id", "left").join(zips, "zip_code", "left")
        .fillna(0, ["zip_permit_count", "zip_total_permit_value", "zip_new_building_permits"])
        .withColumns({
            "dist_to_cbd_km": haversine_km(c("latitude"), c("longitude"), F.lit(lat), F.lit(lon)),
            "height_category": height_class_open(c("num_floors")),
            "commercial_ratio": ratio(c("commercial_area_sqft"), c("building_area_sqft")),
        })
    )
    if not with_neighborhood:
        return out
    hoods = neighborhood_stats(sales, with_ppsf=True, count_rows=True, exact=exact)
    return out.join(hoods, "neighborhood", "left").withColumn(
        "price_vs_neighborhood", ratio(c("sale_price"), c("neighborhood_avg_price")))
