"""Column expressions: safe coercions, distances, bins."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from brickyard.settings import BOROUGHS, EARTH_RADIUS_KM


def has(df: DataFrame, *names: str) -> bool:
    return set(names) <= set(df.columns)


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def number(df: DataFrame, name: str, kind: str = "double") -> Column:
    """Numeric view of a column; text that is no number becomes NULL, and so does NaN."""
    if not is_text(df, name):
        value = F.col(name).cast(kind)
        return F.nanvl(value, F.lit(None).cast(kind)) if kind == "double" else value
    return F.col(name).try_cast(kind)


def money(df: DataFrame, name: str) -> Column:
    """Like `number`, for text with thousands separators and a currency sign."""
    if not is_text(df, name):
        return number(df, name)
    return F.translate(F.col(name), "$,", "").try_cast("double")


def ratio(top: Column, bottom: Column) -> Column:
    """Division that yields NULL on a zero or NULL denominator (`try_divide` does both)."""
    return F.try_divide(top, bottom)


def borough_name(code: Column) -> Column:
    code = code.try_cast("int")
    out = F.lit(None).cast("string")
    for key, name in BOROUGHS.items():
        out = F.when(code == key, F.lit(name)).otherwise(out)
    return out


def haversine_km(lat: Column, lon: Column, lat2: Column, lon2: Column) -> Column:
    dlat, dlon = F.radians(lat2 - lat) / 2, F.radians(lon2 - lon) / 2
    chord = F.pow(F.sin(dlat), 2) + F.cos(F.radians(lat)) * F.cos(F.radians(lat2)) * F.pow(F.sin(dlon), 2)
    return 2 * EARTH_RADIUS_KM * F.asin(F.sqrt(chord))


def right_closed_bins(value: Column, bins: list[tuple[str, float]], low: float = 0.0) -> Column:
    """(low, e1] -> first label, (e1, e2] -> second ...; anything outside -> NULL."""
    out = F.lit(None).cast("string")
    for label, edge in reversed(bins):
        out = F.when(value <= edge, F.lit(label)).otherwise(out)
    return F.when(value > low, out)


def flag(condition: Column) -> Column:
    """1 where the condition holds, 0 where it is false or unknown."""
    return F.when(condition, F.lit(1)).otherwise(F.lit(0))


def normal_cdf_step(x: Column) -> Column:
    """The argument of the polynomial in `normal_cdf`; as a column of its own it is computed once."""
    return 1 / (1 + 0.3275911 * (F.abs(x) / F.sqrt(F.lit(2.0))))


def normal_cdf(x: Column, t: Column | None = None) -> Column:
    """Standard normal distribution function, Abramowitz-Stegun 7.1.26 (error below 1.5e-7)."""
    z = F.abs(x) / F.sqrt(F.lit(2.0))
    t = normal_cdf_step(x) if t is None else t
    poly = t * (0.254829592 + t * (-0.284496736 + t * (1.421413741 + t * (-1.453152027 + t * 1.061405429))))
    erf = 1 - poly * F.exp(-z * z)
    return 0.5 * (1 + F.signum(x) * erf)


def round_doubles(df: DataFrame, digits: dict[str, int] | int = 4) -> DataFrame:
    """Round the double columns for a comparison with another engine.

    Values are moved by a thousandth of the last digit first: exact halves, common in prices, would otherwise
    go either way with the noise of a sum's order.
    """
    out = []
    for field in df.schema.fields:
        scale = 10.0 ** (digits if isinstance(digits, int) else digits.get(field.name, 4))
        if isinstance(field.dataType, T.DoubleType):
            out.append((F.rint(F.col(field.name) * scale + 0.001) / scale + F.lit(0.0)).alias(field.name))
        else:
            out.append(F.col(field.name))
    return df.select(*out)
