"""Filtered, ordered and limited extracts of the five raw feeds."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from brickyard import settings
from brickyard.functions.scalars import money, number
from brickyard.operators.staging import parse_day, parse_stamp

def extract(
    df: DataFrame,
    where: Column | str | None = None,
    select: list[str] | None = None,
    order: list[Column] | None = None,
    offset: int = 0,
    limit: int | None = None,
) -> DataFrame:
    """Generic extract; filter and projection reach the scan, order+limit becomes a distributed top-k."""
    if where is not None:
        df = df.where(where)
    if order:
        df = df.orderBy(*order)
    if offset:
        df = df.offset(offset)
    if limit is not None:
        df = df.limit(limit)
    return df.select(*select) if select else df

def _ties(df: DataFrame, *first: str) -> list[Column]:
    """Remaining columns as tie-breaks, so that a cut is repeatable."""
    return [F.col(c) for c in sorted(df.columns) if c not in first]

def extract_parcels(df: DataFrame, borough: int | None = None, limit: int | None = None) -> DataFrame:
    """Commercial parcels, highest assessed value first."""
    where = F.trim("landuse").isin(settings.COMMERCIAL_LAND_USE)
    if borough is not None:
        where = where & (number(df, "borocode", "int") == borough)
    order = [number(df, "assesstot").desc_nulls_last(), *_ties(df, "assesstot")]
    return extract(df, where, order=order, limit=limit)

def extract_sales(df: DataFrame, limit: int | None = None) -> DataFrame:
    """Sales above the minimum price (compared as a number), newest first."""
    order = [parse_day(df, "sale_date").desc_nulls_last(), *_ties(df, "sale_date")]
    return extract(df, money(df, "sale_price") > settings.MIN_SALE_PRICE, order=order, limit=limit)

def extract_permits(df: DataFrame, since: str = settings.EXTRACT_SINCE, limit: int | None = None) -> DataFrame:
    where = (parse_stamp(df, "filing_date") > F.lit(since).cast("timestamp")) & F.col("job_type").isin(settings.EXTRACT_PERMIT_TYPES)
    order = [parse_stamp(df, "filing_date").desc_nulls_last(), *_ties(df, "filing_date")]
    return extract(df, where, order=order, limit=limit)

def extract_violations(df: DataFrame, since: str = settings.EXTRACT_SINCE, limit: int | None = None) -> DataFrame:
    order = [parse_stamp(df, "inspectiondate").desc_nulls_last(), *_ties(df, "inspectiondate")]
    return extract(df, parse_stamp(df, "inspectiondate") > F.lit(since).cast("timestamp"), order=order, limit=limit)

def resolve_caps(profile: str = settings.DEFAULT_PROFILE, **overrides: int | None) -> dict[str, int]:
    """Row caps of a profile; only positive overrides count."""
    caps = dict(settings.EXTRACT_CAPS.get(profile, settings.EXTRACT_CAPS[settings.DEFAULT_PROFILE]))
    caps.update({k: v for k, v in overrides.items() if v is not None and v > 0 and k in caps})
    return caps

def extract_all(raw: dict[str, DataFrame], caps: dict[str, int] | None = None) -> dict[str, DataFrame]:
    """All four feeds with their caps; a feed without a cap is taken whole."""
    caps = caps or {}
    steps = {
        "pluto": extract_parcels, "rolling_sales": extract_sales,
        "dob_permits": extract_permits, "hpd_violations": extract_violations,
    }
    return {n: step(raw[n], limit=caps.get(n)) for n, step in steps.items() if n in raw}

def series_slice(observations: DataFrame, series: str, start: str, end: str | None = None) -> DataFrame:
    """One macro series between two dates, both inclusive."""
    out = observations.where((F.col("series") == series) & (F.col("date") >= F.lit(start).cast("date")))
    return out.where(F.col("date") <= F.lit(end).cast("date")) if end else out

def macro_table(observations: DataFrame, series: list[str]) -> DataFrame:
    """Long (date, series, value) to a monthly wide table: align, forward-fill, last value of each month.

    Only the last known value of a month can survive, so months are reduced before anything is ordered and the
    fill window sees one row per month.
    """
    latest = [F.max_by(F.when(F.col("series") == s, F.col("value")), F.when(
        (F.col("series") == s) & F.col("value").isNotNull(), F.col("date"))).alias(s) for s in series]
    monthly = observations.groupBy(F.trunc("date", "month").alias("month")).agg(*latest)
    months = monthly.agg(F.min("month").alias("lo"), F.max("month").alias("hi")).select(
        F.explode(F.sequence("lo", "hi", F.expr("interval 1 month"))).alias("month"))
    past = Window.partitionBy(F.lit(1)).orderBy("month").rowsBetween(Window.unboundedPreceding, 0)
    return months.join(monthly, "month", "left").select(
        "month", *[F.last(s, ignorenulls=True).over(past).alias(s) for s in series])
