"""Valuation and market-segment marts, in both rule sets."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard import settings
from brickyard.functions.quantiles import aggregate_with_quantiles
from brickyard.functions.scalars import has, ratio

# columns of the valuation mart, kept where present
VALUATION_COLUMNS = [
    "bbl", "borough_name", "neighborhood", "building_class_category", "sale_price", "sale_date", "sale_year",
    "gross_square_feet", "land_square_feet", "yearbuilt", "numfloors", "unitstotal", "assesstot", "assessland",
    "lotarea", "bldgarea", "comarea", "resarea", "officearea", "retailarea", "latitude", "longitude",
    "price_per_sqft", "zip_code",
]


def property_valuations(features: DataFrame) -> DataFrame:
    return features.select(*[c for c in VALUATION_COLUMNS if has(features, c)])


def market_segments(features: DataFrame, exact: bool = True) -> DataFrame | None:
    """Price, size and age summary by neighbourhood (by borough where there is none)."""
    key = next((c for c in ("neighborhood", "borough_name") if has(features, c)), None)
    if key is None:
        return None
    aggs, medians = [], {}
    if has(features, "sale_price"):
        aggs += [F.avg("sale_price").alias("sale_price_mean"), F.count("sale_price").alias("sale_price_count"),
                 F.stddev_samp("sale_price").alias("sale_price_std")]
        medians["sale_price_median"] = ("sale_price", 0.5)
    if has(features, "price_per_sqft"):
        aggs.append(F.avg("price_per_sqft").alias("price_per_sqft_mean"))
        medians["price_per_sqft_median"] = ("price_per_sqft", 0.5)
    if has(features, "yearbuilt"):
        medians["yearbuilt_median"] = ("yearbuilt", 0.5)
    if has(features, "numfloors"):
        aggs.append(F.avg("numfloors").alias("numfloors_mean"))
    if not aggs and not medians:
        return None
    known = features.where(F.col(key).isNotNull())
    return aggregate_with_quantiles(known, [key], aggs or [F.count(F.lit(1)).alias("n_rows")], medians, exact)


def property_valuations_warehouse(features: DataFrame) -> DataFrame:
    c = F.col

    def log_floor_one(name: str):
        return F.when(c(name).isNotNull(), F.log(F.greatest(c(name), F.lit(1.0))))

    return features.where(
        (c("sale_price") >= settings.MIN_SALE_PRICE) & (c("gross_sqft") > 0)
        & c("latitude").isNotNull() & c("longitude").isNotNull()
    ).select(
        "bbl", "borough_name", "neighborhood", "address", "zip_code",
        "sale_price", "price_per_sqft", "sale_date", "sale_year", "sale_quarter",
        "building_class_category", "building_class_at_sale", "gross_sqft", "land_sqft", "lot_area_sqft",
        "building_area_sqft", "commercial_area_sqft", "office_area_sqft", "retail_area_sqft", "num_floors",
        "total_units", "commercial_units", "year_built", "building_age", "floor_area_ratio", "commercial_ratio",
        "height_category", "zoning_district", "assessed_total", "assessed_land",
        ratio(c("sale_price"), c("assessed_total")).alias("sale_to_assessed_ratio"),
        "latitude", "longitude", "dist_to_cbd_km",
        "neighborhood_avg_price", "neighborhood_median_price", "neighborhood_sales_volume", "neighborhood_avg_ppsf",
        "price_vs_neighborhood", "zip_permit_count", "zip_total_permit_value", "zip_new_building_permits",
        F.log(c("sale_price") + 1).alias("log_sale_price"),
        log_floor_one("gross_sqft").alias("log_gross_sqft"), log_floor_one("assessed_total").alias("log_assessed_total"),
        "owner_name",
    )


def market_segments_warehouse(
    features: DataFrame, as_of: dt.date = settings.AS_OF, min_sales: int = 10, exact: bool = True,
    sales: DataFrame | None = None,
) -> DataFrame:
    """Market metrics by neighbourhood and borough with at least `min_sales` sales, dearest first.

    With the staged `sales` behind the features at hand, the price medians come from them and skip the joins.
    """
    c = F.col
    height = c("height_category")

    def year_ppsf(year: int):
        return F.avg(F.when(c("sale_year") == year, c("price_per_sqft")))

    means = {
        "avg_sale_price": "sale_price", "avg_ppsf": "price_per_sqft", "avg_gross_sqft": "gross_sqft",
        "avg_building_age": "building_age", "avg_num_floors": "num_floors", "avg_far": "floor_area_ratio",
        "avg_commercial_ratio": "commercial_ratio", "avg_dist_to_cbd_km": "dist_to_cbd_km",
        "centroid_lat": "latitude", "centroid_lon": "longitude", "avg_permit_activity": "zip_permit_count",
        "avg_new_building_permits": "zip_new_building_permits",
    }
    # years are few: a bounded set of distinct years per group replaces the row expansion of count(distinct)
    aggs = [F.avg(src).alias(out) for out, src in means.items()] + [
        F.stddev_samp("sale_price").alias("std_sale_price"),
        F.count(F.lit(1)).alias("total_transactions"),
        F.size(F.collect_set("sale_year")).cast("long").alias("years_with_sales"),
        F.count_if(height == "low_rise").alias("low_rise_count"),
        F.count_if(height == "mid_rise").alias("mid_rise_count"),
        F.count_if(height == "high_rise").alias("high_rise_count"),
        F.count_if(height.isin("tower", "supertall")).alias("tower_count"),
        year_ppsf(as_of.year).alias("current_year_ppsf"),
        year_ppsf(as_of.year - 1).alias("prior_year_ppsf"),
    ]
    medians = {"median_sale_price": ("sale_price", 0.5), "median_ppsf": ("price_per_sqft", 0.5)}
    out = aggregate_with_quantiles(features, ["neighborhood", "borough_name"], aggs, medians, exact, values=sales)
    return out.where(c("total_transactions") >= min_sales).withColumns({
        "yoy_ppsf_change": ratio(c("current_year_ppsf") - c("prior_year_ppsf"), c("prior_year_ppsf")),
        "price_cv": ratio(c("std_sale_price"), c("avg_sale_price")),
        "transaction_volume_score": c("avg_gross_sqft") * c("total_transactions") / 1000000,
    }).orderBy(c("avg_sale_price").desc())
