"""Cleaning of the raw feeds.

Each feed has two rule sets. The *table* rules keep the feed's column names and accept absent columns; the
*warehouse* rules rename to the warehouse schema and are stricter (unknown price per square foot is dropped).
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brickyard import settings
from brickyard.functions.scalars import borough_name, has, is_text, money, number, ratio

PARCEL_NUMBERS = [
    "assesstot", "assessland", "lotarea", "bldgarea", "comarea", "resarea", "officearea", "retailarea",
    "numfloors", "unitstotal", "unitsres", "yearbuilt", "latitude", "longitude",
]


def normalise_names(df: DataFrame) -> DataFrame:
    return df.toDF(*[c.strip().lower() for c in df.columns])


def coerce_numbers(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.withColumns({c: number(df, c) for c in columns if c in df.columns})


def trim_text(df: DataFrame) -> DataFrame:
    return df.withColumns({c: F.trim(c) for c in df.columns if is_text(df, c)})


def in_city(lat: Column, lon: Column) -> Column:
    return lat.between(*settings.LAT_RANGE) & lon.between(*settings.LON_RANGE)


def keep_top(df: DataFrame, key: str, value: str) -> DataFrame:
    """One row per key, the one with the largest value; remaining columns break ties.

    `row_number() = 1` becomes a group limit on the map side, so a hot key sends one row per task.
    """
    ties = [F.col(c) for c in sorted(df.columns) if c not in (key, value)]
    order = Window.partitionBy(key).orderBy(F.col(value).desc_nulls_last(), *ties)
    return df.withColumn("__rank", F.row_number().over(order)).where("__rank = 1").drop("__rank")


def parcel_id(borough: Column, block: Column, lot: Column) -> Column:
    return F.concat_ws("-", borough.cast("string"), F.lpad(block.cast("string"), 5, "0"), F.lpad(lot.cast("string"), 4, "0"))


def parse_day(df: DataFrame, name: str, fmt: str = "MM/dd/yyyy") -> Column:
    """Date of a text column in `fmt` or ISO form; unreadable text becomes NULL."""
    if not is_text(df, name):
        return F.col(name).cast("date")
    return F.coalesce(F.try_to_timestamp(F.col(name), F.lit(fmt)).cast("date"), F.col(name).try_cast("date"))


def parse_stamp(df: DataFrame, name: str) -> Column:
    return F.col(name).try_cast("timestamp") if is_text(df, name) else F.col(name).cast("timestamp")


def arms_length(price: Column) -> Column:
    return price >= settings.MIN_SALE_PRICE


def ppsf_in_range(ppsf: Column, keep_unknown: bool) -> Column:
    inside = F.call_function("between", ppsf, F.lit(settings.PPSF_RANGE[0]), F.lit(settings.PPSF_RANGE[1]))
    return (ppsf.isNull() | inside) if keep_unknown else inside


# --- table rules ----------------------------------------------------------
def stage_parcels(feed: DataFrame) -> DataFrame:
    df = coerce_numbers(normalise_names(feed), PARCEL_NUMBERS)
    if has(df, "latitude", "longitude"):
        df = df.where(in_city(F.col("latitude"), F.col("longitude")))
    if has(df, "borocode"):
        df = df.withColumn("borocode", number(df, "borocode", "int"))
        df = df.withColumn("borough_name", borough_name(F.col("borocode")))
    if has(df, "assesstot"):
        df = df.where(F.col("assesstot") > 0)
    if has(df, "bbl"):
        df = keep_top(df, "bbl", "assesstot") if has(df, "assesstot") else df.dropDuplicates(["bbl"])
    return df


def stage_sales(feed: DataFrame, keep_unknown_ppsf: bool = True) -> DataFrame:
    df = normalise_names(feed)
    df = df.withColumns({c: money(df, c) for c in ("sale_price", "gross_square_feet", "land_square_feet") if has(df, c)})
    if has(df, "sale_date"):
        df = df.withColumn("sale_date", parse_day(df, "sale_date"))
        df = df.withColumns({"sale_year": F.year("sale_date"), "sale_month": F.month("sale_date"),
                             "sale_quarter": F.quarter("sale_date")})
    if has(df, "sale_price"):
        df = df.where(arms_length(F.col("sale_price")))
    if has(df, "sale_price", "gross_square_feet"):
        df = df.withColumn("price_per_sqft", ratio(F.col("sale_price"), F.col("gross_square_feet")))
        df = df.where(ppsf_in_range(F.col("price_per_sqft"), keep_unknown_ppsf))
    if has(df, "borough"):
        df = df.withColumn("borough", number(df, "borough", "int"))
        df = df.withColumn("borough_name", borough_name(F.col("borough")))
    return df


def stage_permits(feed: DataFrame) -> DataFrame:
    df = normalise_names(feed)
    if has(df, "filing_date"):
        df = df.withColumn("filing_date", parse_stamp(df, "filing_date"))
        df = df.withColumn("filing_year", F.year("filing_date"))
    if has(df, "estimated_job_cost"):
        df = df.withColumn("estimated_job_cost", money(df, "estimated_job_cost"))
    return df


def stage_violations(feed: DataFrame) -> DataFrame:
    df = normalise_names(feed)
    if has(df, "inspectiondate"):
        df = df.withColumn("inspectiondate", parse_stamp(df, "inspectiondate"))
    return df


# --- warehouse rules ------------------------------------------------------
def stage_parcels_warehouse(feed: DataFrame, as_of: dt.date = settings.AS_OF) -> DataFrame:
    df = trim_text(normalise_names(feed))
    c = F.col
    clean = df.select(
        parcel_id(c("borocode"), c("block"), c("lot")).alias("parcel_id"),
        c("bbl").cast("string").alias("bbl"),
        number(df, "borocode", "int").alias("borough_code"),
        borough_name(c("borocode")).alias("borough_name"),
        "block", "lot", "address",
        c("zipcode").alias("zip_code"), c("landuse").alias("land_use_code"), c("bldgclass").alias("building_class"),
        c("zonedist1").alias("zoning_district"), c("overlay1").alias("zoning_overlay"), c("ownername").alias("owner_name"),
        number(df, "lotarea").alias("lot_area_sqft"), number(df, "bldgarea").alias("building_area_sqft"),
        number(df, "comarea").alias("commercial_area_sqft"), number(df, "resarea").alias("residential_area_sqft"),
        number(df, "officearea").alias("office_area_sqft"), number(df, "retailarea").alias("retail_area_sqft"),
        number(df, "numfloors").alias("num_floors"),
        number(df, "unitstotal", "long").alias("units_total"), number(df, "unitsres", "long").alias("units_residential"),
        number(df, "yearbuilt", "int").alias("year_built"), number(df, "yearalter1", "int").alias("year_altered_1"),
        number(df, "yearalter2", "int").alias("year_altered_2"),
        number(df, "assesstot").alias("assessed_total"), number(df, "assessland").alias("assessed_land"),
        number(df, "latitude").alias("latitude"), number(df, "longitude").alias("longitude"),
    )
    clean = clean.withColumns({
        "floor_area_ratio": ratio(c("building_area_sqft"), c("lot_area_sqft")),
        "building_age": as_of.year - c("year_built"),
    }).where(
        in_city(c("latitude"), c("longitude")) & (c("assessed_total") > 0)
        & c("land_use_code").isin(settings.COMMERCIAL_LAND_USE)
    )
    return keep_top(clean, "bbl", "assessed_total")


def stage_sales_warehouse(feed: DataFrame) -> DataFrame:
    df = trim_text(normalise_names(feed))
    c = F.col
    present = "building_class_at_present" if has(df, "building_class_at_present") else "building_class_at_time_of_sale"
    out = df.select(
        c("sale_id"),
        c("bbl").cast("string").alias("bbl"),
        parcel_id(c("borough"), c("block"), c("lot")).alias("parcel_id"),
        number(df, "borough", "int").alias("borough_code"), borough_name(c("borough")).alias("borough_name"),
        "neighborhood", "address", "zip_code",
        c("building_class_at_time_of_sale").alias("building_class_at_sale"),
        c(present).alias("building_class_current"), "building_class_category",
        c("tax_class_at_time_of_sale").alias("tax_class_at_sale"),
        money(df, "sale_price").alias("sale_price"), parse_day(df, "sale_date").alias("sale_date"),
        money(df, "gross_square_feet").alias("gross_sqft"), money(df, "land_square_feet").alias("land_sqft"),
        *([number(df, "residential_units", "long").alias("residential_units")] if has(df, "residential_units") else []),
        number(df, "commercial_units", "long").alias("commercial_units"),
        number(df, "total_units", "long").alias("total_units"), number(df, "year_built", "int").alias("year_built"),
    )
    out = out.withColumns({
        "sale_year": F.year("sale_date"), "sale_quarter": F.quarter("sale_date"), "sale_month": F.month("sale_date"),
        "price_per_sqft": ratio(c("sale_price"), c("gross_sqft")),
    })
    return out.where(arms_length(c("sale_price")) & ppsf_in_range(c("price_per_sqft"), keep_unknown=False))


def stage_permits_warehouse(
    feed: DataFrame, as_of: dt.date = settings.AS_OF, years: int = settings.LOOKBACK_YEARS
) -> DataFrame:
    df = trim_text(normalise_names(feed))
    kind = F.lit("Other")
    for code, text in settings.PERMIT_TYPES.items():
        kind = F.when(F.col("job_type") == code, F.lit(text)).otherwise(kind)
    kept = [c for c in ("job_doc_number", "borough", "block", "lot", "zip_code", "job_type", "work_type", "permit_status",
                        "initial_cost", "owner_s_first_name", "owner_s_last_name", "owner_s_business_name") if has(df, c)]
    renames = {"job_doc_number": "permit_id", "owner_s_first_name": "owner_first_name",
               "owner_s_last_name": "owner_last_name", "owner_s_business_name": "owner_business_name"}
    out = df.select(
        *[money(df, c).alias(c) if c == "initial_cost" else F.col(c).alias(renames.get(c, c)) for c in kept],
        kind.alias("job_type_description"),
        parse_stamp(df, "filing_date").alias("filing_date"),
        *([parse_stamp(df, "issuance_date").alias("issuance_date")] if has(df, "issuance_date") else []),
        money(df, "estimated_job_cost").alias("estimated_job_cost"),
    )
    since = F.add_months(F.lit(as_of), -12 * years).cast("timestamp")
    return out.withColumn("filing_year", F.year("filing_date")).where(F.col("filing_date") >= since)
