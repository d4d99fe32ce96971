"""A training corpus from `documents`: language, exact copies, near copies, mixture, tokens.

Every stage takes (spark, docs, sf_dir) and works on all that its predecessor kept; between two stages the rows are a Parquet table in the checkpoint folder.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from brickyard.llm import bpe, exact_dedup, language_id, mixing, ngram_join
from brickyard.llm.common import table
from brickyard.llm.queries import tokenizer_path
from brickyard.session import written


#: Rows of a batch that a Python worker gets: a few megabytes of text.
BATCH_ROWS = 2000


def small_batches(spark: SparkSession) -> None:
    """Whoever writes a stage's result plans it anew by the session's settings, so the limit is set there, unless a smaller one is."""
    name = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(name)) <= BATCH_ROWS:
        spark.conf.set(name, str(BATCH_ROWS))


def languages(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language is recognised; those that the calibrated threshold rejects go. Columns named as the model's results keep their own values."""
    small_batches(spark)
    own = {c: f"__own_{c}" for c in docs.columns}
    found = language_id.predict(docs.withColumnsRenamed(own).withColumn("text", F.col("__own_text")), language_id.fit(docs))
    return found.where("accepted").select(*[F.col(name).alias(c) for c, name in own.items()])


def copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group with equal text up to white space: the smallest doc_id."""
    return exact_dedup.keep(docs)


def near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each component of near copies: five-word shingles, Jaccard similarity 0.8."""
    return ngram_join.keep(docs, k=5, percent=80)


def mixture(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mixture takes them: a document may come twice."""
    return mixing.take(docs)


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The final table: doc_id, n_tokens and digests of the ids and the decoded text."""
    small_batches(spark)
    return bpe.encode_digests(docs, tokenizer_path())


STAGES = [("language_id", languages), ("exact_dedup", copies), ("ngram_join", near_copies), ("mixing", mixture), ("bpe", tokens)]

#: SQL can express neither the first stage nor the last two; the tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES[:-1]:
        docs = written(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
