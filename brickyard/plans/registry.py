"""Named queries: a Spark callable and, where SQL can say it, the same result as SQL text."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brickyard.functions.scalars import round_doubles

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None, floats: str = "", digits: dict[str, int] | int = 4):
    """Register a query. `floats` lists the double columns, rounded alike on both sides."""
    names = floats.split()

    def rounded_sql(column: str) -> str:
        scale = 10 ** (digits if isinstance(digits, int) else digits.get(column, 4))
        value = f"CAST({column} AS DOUBLE) * CAST({scale} AS DOUBLE) + CAST(0.001 AS DOUBLE)"
        return f"round({value}) / CAST({scale} AS DOUBLE) + CAST(0 AS DOUBLE) AS {column}"

    def wrap(fn):
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return round_doubles(fn(spark, sf_dir), digits)

        run.__name__, run.__doc__ = fn.__name__, fn.__doc__
        if name in QUERIES:
            raise ValueError(f"query {name} registered twice")
        QUERIES[name] = run
        if sql is not None:
            text = sql
            if names:
                rounded = ", ".join(rounded_sql(c) for c in names)
                text = f"SELECT * REPLACE ({rounded}) FROM ({sql}) AS result"
            ORACLES[name] = text
        return fn

    return wrap


def ctes(*parts: str) -> str:
    return "WITH " + ",\n".join(parts) + "\n"
