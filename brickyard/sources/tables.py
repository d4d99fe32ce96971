"""Table scans and writes."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{folder}/{name}.parquet")


def _children(spark: SparkSession, folder: str) -> list[str]:
    """File names of a folder through the Hadoop file system, so any store works."""
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(folder)
    fs = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not fs.exists(path):
        return []
    return sorted(s.getPath().getName() for s in fs.listStatus(path))


def load_tables(spark: SparkSession, folder: str, views: bool = False) -> dict[str, DataFrame]:
    """Every parquet table of a folder by name, optionally registered as temp views."""
    out = {}
    for entry in _children(spark, folder):
        if entry.endswith(".parquet"):
            name = entry[: -len(".parquet")]
            out[name] = table(spark, folder, name)
            if views:
                out[name].createOrReplaceTempView(name)
    return out


def save_tables(tables: dict[str, DataFrame], folder: str, partition_by: dict[str, list[str]] | None = None) -> None:
    """One parquet folder per table; `partition_by` names the partition columns of a table."""
    for name, df in tables.items():
        writer = df.write.mode("overwrite")
        columns = (partition_by or {}).get(name)
        if columns:
            # gathers each value's rows into few files; AQE splits a value that is too large for one writer
            writer = df.hint("rebalance", *columns).write.mode("overwrite").partitionBy(*columns)
        writer.parquet(f"{folder}/{name}.parquet")


def load_first(spark: SparkSession, folders: list[str], names: list[str]) -> dict[str, DataFrame]:
    """The named tables from the first folder that holds any of them; else all tables of the last folder."""
    for folder in folders:
        present = set(_children(spark, folder))
        found = {n: table(spark, folder, n) for n in names if f"{n}.parquet" in present}
        if found:
            return found
    return load_tables(spark, folders[-1]) if folders else {}


def materialise(tables: dict[str, DataFrame], layers: dict[str, str], folder: str) -> dict[str, DataFrame]:
    """Lay tables out by layer: 'view' registers a temp view, 'table' writes parquet and reads it back."""
    out = {}
    for name, df in tables.items():
        if layers.get(name, "view") == "view":
            df.createOrReplaceTempView(name)
            out[name] = df
        else:
            save_tables({name: df}, folder)
            out[name] = table(df.sparkSession, folder, name)
    return out


def save_metrics(metrics: DataFrame, folder: str) -> None:
    metrics.write.mode("overwrite").option("header", True).csv(f"{folder}/model_metrics")


def save_results_json(results: dict, path: str, max_rows: int = 200) -> None:
    """Nested results as JSON; DataFrames are previewed with at most `max_rows` rows, as a report does."""

    def safe(value):
        if isinstance(value, DataFrame):
            return [row.asDict(recursive=True) for row in value.limit(max_rows).collect()]
        if isinstance(value, dict):
            return {str(k): safe(v) for k, v in value.items()}
        if isinstance(value, (list, tuple, set)):
            return [safe(v) for v in value]
        if value is None or isinstance(value, (bool, int, float, str)):
            return value
        return str(value)

    text = json.dumps(safe(results), indent=1, default=str)
    spark = SparkSession.active()
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    out = target.getFileSystem(spark._jsc.hadoopConfiguration()).create(target, True)
    out.write(bytearray(text, "utf-8"))
    out.close()
