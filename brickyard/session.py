"""Session defaults and intermediate tables."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

#: Settings while an intermediate table is written: its shuffle files go when the write has ended, and Python workers get texts in batches of a few megabytes.
WRITING = {"spark.sql.classic.shuffleDependency.fileCleanup.enabled": "true", "spark.sql.execution.arrow.maxRecordsPerBatch": "2000"}


def build_session(name: str = "brickyard", cores: str | int = "*", **conf) -> SparkSession:
    """A local session for tests and the bench; a cluster brings its own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(name)
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "12g")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
    )
    for key, value in conf.items():
        builder = builder.config(key.replace("__", "."), value)
    return builder.getOrCreate()


def checkpoint_folder(spark: SparkSession) -> str:
    """The folder for intermediate tables that must outlive an executor.

    The cluster names it in `spark.checkpoint.dir`. Only a local master may fall back to a
    temporary folder, because there the driver and the tasks share one disk.
    """
    named = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir")
    if named:
        return named
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("set spark.checkpoint.dir to a folder that all executors share")
    folder = tempfile.mkdtemp(prefix="brickyard-")
    spark.conf.set("spark.checkpoint.dir", folder)
    return folder


def written(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Write a table (or some of its columns) to the checkpoint folder and read it back.

    Used where a result is read several times or an iteration would grow its plan: the lineage is cut, a lost
    executor costs nothing, and later reads take only the columns they need. The shuffles of the write are removed
    when it ends, as nothing reads them again.
    """
    spark = df.sparkSession
    path = f"{checkpoint_folder(spark)}/brickyard/{uuid.uuid4().hex}"
    before = {name: spark.conf.get(name) for name in WRITING}
    for name, value in WRITING.items():
        spark.conf.set(name, value)
    try:
        (df.select(*columns) if columns else df).write.parquet(path)
    finally:
        for name, value in before.items():
            spark.conf.set(name, value)
    return spark.read.parquet(path)
