"""Proportional stratified interleaving into shards (DataFrame functions only).

Rows are shuffled by a seeded hash and ranked within their source; the fractional rank (rank + 1/2) / rows puts every source evenly on the unit
interval. Sorting all rows by it and cutting the order into equal runs gives shards that each match the mixture.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from brickyard.llm.common import before, bits_for, bucket_of, ranked
from brickyard.session import written


def interleave(docs: DataFrame, shards: int = 8, seed: int = 17) -> DataFrame:
    """doc_id, size, text_crc32, law, shard, slot, grown_shard, source, source_rank: one row per row of `docs`.

    Law `rows`: shards differ by one row at most, and slots of a shard run from 0 without gaps in the interleaved order. A null text has no bytes (size 1,
    crc 0); rows without a source are a source of their own; rows equal in id and text are interchangeable, so their order doesn't show. An empty table gives an
    empty result; other columns are ignored. Texts are read once: what follows works on a stored table of a few numbers per row. Both orders are ranked
    bucket by bucket (buckets grow as the square root of the rows), never in one task.
    """
    text = F.coalesce("text", F.lit(""))
    rows = written(docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32"),
        F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"), F.col("source").cast("string").alias("source"),
        F.concat(F.when(F.col("source").isNull(), "n").otherwise("s"), F.coalesce(F.col("source").cast("string"), F.lit(""))).alias("stratum"),
    ))
    total = rows.count()
    bits = bits_for(total)
    tie = ["h", "doc_id", "size", "text_crc32"]
    first = ranked(rows.withColumn("bucket", bucket_of(F.col("h"), bits)), ["stratum"], "bucket", tie, "source_rank")
    sizes = rows.groupBy("stratum").agg(F.count("*").alias("n"))
    placed = first.join(sizes, "stratum").withColumn("fraction", (F.col("source_rank") + F.lit(0.5)) / F.col("n"))
    placed = written(placed.withColumn("bucket", F.floor(F.col("fraction") * (1 << bits)).cast("int")).drop("n", "h"))
    ahead = before(placed.groupBy("bucket").agg(F.count("*").alias("n")).withColumn("all", F.lit(0)), ["all"], "bucket", "n", "ahead")
    inner = Window.partitionBy("bucket").orderBy("fraction", "stratum")
    at = placed.join(ahead.select("bucket", "ahead"), "bucket").withColumn("at", F.row_number().over(inner) - 1 + F.col("ahead"))
    shard = F.expr(f"CAST(at * {shards} DIV {max(total, 1)} AS INT)")
    start = F.expr(f"(shard * CAST({total} AS BIGINT) + {shards - 1}) DIV {shards}")
    return at.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", (F.col("at") - start).cast("long").alias("slot"),
        F.lit(None).cast("int").alias("grown_shard"), "source", F.col("source_rank").cast("long").alias("source_rank"),
    )
