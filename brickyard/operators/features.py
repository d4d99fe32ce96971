"""Property features: distances, ratios, ages, logs, bins."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from brickyard import settings
from brickyard.functions.scalars import flag, haversine_km, has, number, ratio, right_closed_bins
from brickyard.operators import encoding, enrichment
from brickyard.session import written

C = F.col
#: Features that are 0, not null, for a sale without a parcel.
FLAGS = ("is_manhattan", "is_recently_renovated")
LOG_COLUMNS = ["assesstot", "assessland", "bldgarea", "lotarea"]


def add_geography(df: DataFrame) -> DataFrame:
    """Distance to each landmark, to the business district, and to the nearest landmark."""
    if not has(df, "latitude", "longitude"):
        return df
    lat, lon = C("latitude").cast("double"), C("longitude").cast("double")
    names = {f"dist_to_{n}_km": haversine_km(lat, lon, F.lit(a), F.lit(b)) for n, (a, b) in settings.LANDMARKS.items()}
    df = df.withColumns(names)
    df = df.withColumns({"dist_to_cbd_km": C(f"dist_to_{settings.CBD}_km"), "min_landmark_dist_km": F.least(*names)})
    if has(df, "borocode"):
        df = df.withColumn("is_manhattan", flag(C("borocode").try_cast("int") == 1))
    return df


def add_property_features(df: DataFrame, as_of: dt.date = settings.AS_OF) -> DataFrame:
    year = as_of.year
    if has(df, "yearbuilt"):
        age = year - number(df, "yearbuilt")
        df = df.withColumn("building_age", F.when(age.between(0, 300), age))
    if has(df, "sale_price", "gross_square_feet"):
        df = df.withColumn("price_per_sqft", ratio(number(df, "sale_price"), number(df, "gross_square_feet")))
    if has(df, "bldgarea", "lotarea"):
        df = df.withColumn("floor_area_ratio", ratio(number(df, "bldgarea"), number(df, "lotarea")))
    if has(df, "comarea", "bldgarea"):
        df = df.withColumn("commercial_ratio", ratio(number(df, "comarea"), number(df, "bldgarea")))
    if has(df, "yearalter1"):
        df = df.withColumn("is_recently_renovated", flag(year - number(df, "yearalter1") <= 15))
    logs = {}
    for c in LOG_COLUMNS:
        if has(df, c):
            value = number(df, c)
            logs[f"log_{c}"] = F.when(value.isNotNull(), F.log1p(F.greatest(value, F.lit(0.0))))
    df = df.withColumns(logs) if logs else df
    if has(df, "numfloors"):
        df = df.withColumn("height_category", right_closed_bins(number(df, "numfloors"), settings.HEIGHT_CLASSES))
    return df


def add_market_context(sales: DataFrame, permits: DataFrame | None, violations: DataFrame | None) -> DataFrame:
    """Neighbourhood, permit and violation context. The statistics are stored ahead of their joins, so Spark knows how small they are and doesn't shuffle the wide sales."""
    out = enrichment.with_neighborhood_context(sales, settle=written)
    out = enrichment.with_permit_context(out, permits, settle=written)
    return enrichment.with_violation_context(out, violations, settle=written)


def with_parcels(parcels: DataFrame, sales: DataFrame, as_of: dt.date = settings.AS_OF) -> DataFrame:
    """Sales with their parcel, geography and property features.

    What comes from a parcel's own columns and is null without a parcel is worked out once a parcel, ahead of the join.
    """

    def described(df: DataFrame) -> DataFrame:
        return add_property_features(add_geography(df), as_of)

    wanted = described(enrichment.merge_parcels(sales, parcels)).columns
    early = []
    if has(sales, "bbl") and has(parcels, "bbl"):
        clash = {c: f"__own_{c}" for c in parcels.columns if c in sales.columns and c != "bbl"}  # the sales' column of this name counts
        made = described(parcels.withColumnsRenamed(clash))
        early = [c for c in made.columns if c not in parcels.columns and c not in sales.columns and c not in FLAGS and c not in clash.values()]
        parcels = made.select(*[C(clash[c]).alias(c) if c in clash else C(c) for c in parcels.columns], *early)
    merged = enrichment.merge_parcels(sales, parcels).withColumnsRenamed({c: f"__early_{c}" for c in early})
    return described(merged).select(*[C(f"__early_{c}").alias(c) if c in early else C(c) for c in wanted])


def base_features(
    parcels: DataFrame, sales: DataFrame, permits: DataFrame | None = None, violations: DataFrame | None = None,
    as_of: dt.date = settings.AS_OF,
) -> DataFrame:
    """Merge, geography, property and market features, before encoding."""
    return add_market_context(with_parcels(parcels, sales, as_of), permits, violations)


def engineer_features(
    parcels: DataFrame, sales: DataFrame, permits: DataFrame | None = None, violations: DataFrame | None = None,
    as_of: dt.date = settings.AS_OF, fold_key: str | None = None,
) -> DataFrame:
    """The whole feature table: merged, encoded and imputed.

    Context and encoding need small statistics of the merged table, imputation the gaps and medians of the encoded one. Both tables are written once, so
    that these small aggregates read single columns instead of repeating the joins.
    """
    out = add_market_context(written(with_parcels(parcels, sales, as_of)), permits, violations)
    if has(out, "borough_name"):
        out = encoding.one_hot(out, "borough_name")
    if has(out, "building_class_category"):
        out = encoding.label_encode(out, "building_class_category")
    if has(out, "neighborhood", "sale_price"):
        out = encoding.target_encode(out, "neighborhood", "sale_price", fold_key)
    return encoding.handle_sparseness(written(out))
