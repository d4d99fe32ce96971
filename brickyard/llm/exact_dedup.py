"""Exact dedup by a tree-merge of sorted digest runs.

Every input partition is a run of (digest, smallest id, count). In binomial rounds the runs are dealt anew: a round joins `FAN` neighbouring runs
and splits them by the next digit of the digest, so after the last round one lane holds all copies of a digest, and no lane ever holds more than its
share of the digests. Each round merges its sorted runs and keeps, per digest, the smallest id and the counts: a text with a third of all rows is one
row per run after the first step and one row per lane afterwards.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from brickyard.llm.common import SPACES
from brickyard.session import written

#: Runs that one round merges.
FAN = 16


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), f"[{SPACES}]+", " ")


def first_runs(docs: DataFrame) -> DataFrame:
    """One row per (run, digest, doc_id): the run is the partition that read the rows. `check` verifies equal digests."""
    clean = normalised(F.col("text"))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.sha2(clean, 256).alias("text_sha256"),
                       F.struct(F.octet_length(clean).alias("bytes"), F.xxhash64(clean).alias("hash")).alias("check"))
    return rows.groupBy(F.spark_partition_id().alias("run"), "text_sha256", "check", "doc_id").agg(F.count("*").alias("rows"))


def merge(runs: DataFrame, rounds: int) -> DataFrame:
    """Binomial rounds over runs numbered from 0; at the end all copies of a digest are one row."""
    for r in range(rounds):
        runs = (
            runs.withColumn("run", F.floor(F.col("run") / FAN).cast("int")).withColumn("lane", F.substring("text_sha256", 1, r + 1))
            .repartition("run", "lane").sortWithinPartitions("run", "lane", "text_sha256")
            .groupBy("run", "lane", "text_sha256")
            .agg(F.min("first").alias("first"), F.sum("rows").alias("rows"), F.min("low").alias("low"), F.max("high").alias("high"))
        )
    return runs


def decisions(docs: DataFrame, rounds: int | None = None) -> DataFrame:
    """doc_id, keep_id, group_size, kept, text_sha256, repeats: one row per row of `docs`; `repeats` counts the rows of its id and text.

    Texts are equal when they agree after each run of white space became one space; null counts as empty. The smallest doc_id stays. Rows without an
    id come last: they stay only when no copy has an id (keep_id is then null). Of repeated rows with the same id and text exactly one is `kept`. An
    empty table gives an empty result; other columns of `docs` are ignored. The digests are stored once in the checkpoint folder. Equal
    digests with different lengths or second hashes stop the job.
    """
    stored = written(first_runs(docs))
    top = stored.agg(F.max("run")).first()[0]
    if rounds is None:
        rounds = 1
        while top is not None and FAN ** rounds <= top:
            rounds += 1
    order = F.struct(F.col("doc_id").isNull().alias("none"), F.col("doc_id").alias("id"))
    runs = stored.groupBy("run", "text_sha256").agg(
        F.min(order).alias("first"), F.sum("rows").alias("rows"), F.min("check").alias("low"), F.max("check").alias("high"))
    groups = merge(runs, rounds)
    sure = F.when(F.col("low") == F.col("high"), F.col("rows")).otherwise(F.raise_error(F.lit("two texts share a digest")).cast("long"))
    groups = groups.select("text_sha256", F.col("first.id").alias("keep_id"), sure.alias("group_size"))
    same = stored.groupBy("doc_id", "text_sha256").agg(F.sum("rows").alias("rows"))
    return (
        same.join(groups, "text_sha256")
        .withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("rows"))))
        .select("doc_id", "keep_id", "group_size", (F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("copy") == 1)).alias("kept"), "text_sha256",
                F.col("rows").alias("repeats"))
    )


def keep(docs: DataFrame) -> DataFrame:
    """The rows of `docs`, with all their columns, that stay."""
    found = written(decisions(docs).where("kept").select(F.col("doc_id").alias("__id"), F.col("text_sha256").alias("__digest"), F.col("repeats").alias("__repeats")))
    keyed = docs.withColumn("__own", F.sha2(normalised(F.col("text")), 256))
    joined = keyed.join(found, F.col("doc_id").cast("long").eqNullSafe(F.col("__id")) & (F.col("__own") == F.col("__digest")))
    if not found.where("__repeats > 1").limit(1).count():
        return joined.select(*docs.columns)
    once = written(joined.where("__repeats > 1").dropDuplicates(["__id", "__digest"]))
    return joined.where("__repeats = 1").unionByName(once).select(*docs.columns)


ORACLE = f"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[{SPACES}]+', ' ', 'g') AS clean FROM documents),
g AS (SELECT clean, min(doc_id) AS keep_id, count(*) AS group_size FROM t GROUP BY clean),
r AS (SELECT *, row_number() OVER (PARTITION BY doc_id, clean) AS copy FROM t)
SELECT r.doc_id, g.keep_id, g.group_size, r.doc_id IS NOT DISTINCT FROM g.keep_id AND r.copy = 1 AS kept, sha256(r.clean) AS text_sha256,
    count(*) OVER (PARTITION BY r.doc_id, r.clean) AS repeats
FROM r JOIN g ON r.clean = g.clean
"""
