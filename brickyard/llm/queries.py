"""The operators' queries over the given tables, and their SQL twins."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from brickyard.llm import bpe, cap_filters, exact_dedup, fingerprints, fixity, language_id, mixing, ngram_join, periodic_runs, pii, sharding, suffix_tree, whitening
from brickyard.llm.common import table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None):
    def register(run: Callable[[SparkSession, str], DataFrame]):
        QUERIES[name] = run
        if sql:
            ORACLES[name] = sql
        return run

    return register


def tokenizer_path() -> str:
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


@query("op1_merkle_fixity", fixity.ORACLE)
def audit_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fixity.audit_pages(table(spark, sf_dir, "pages"))


@query("op2_bpe_chunk_reuse")
def encode_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return bpe.encode_digests(table(spark, sf_dir, "documents"), tokenizer_path())


@query("op3_stratified_shards")
def shard_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return sharding.interleave(table(spark, sf_dir, "documents"))


@query("op4_language_id")
def identify_languages(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = language_id.predict(docs.select("doc_id", "text"), language_id.fit(docs))
    return found.select("doc_id", language_id.held_out().alias("held_out"), "lang_pred", "score", "accepted")


@query("op5_budget_mix")
def mix_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_sources(table(spark, sf_dir, "documents")).select("doc_id", "size", "source_size", "target", "taken", "copies")


@query("op6_ngram_join", ngram_join.ORACLE)
def join_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.join_components(table(spark, sf_dir, "documents")).select("doc_id", "n_shingles", "component_id")


@query("op7_cap_filters", cap_filters.ORACLE)
def link_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return cap_filters.near_duplicates(table(spark, sf_dir, "embeddings"))


@query("op8_exact_dedup", exact_dedup.ORACLE)
def dedup_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.decisions(table(spark, sf_dir, "documents"))


@query("op9_suffix_tree")
def score_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_tree.score(table(spark, sf_dir, "documents"))


@query("op10_personal_data")
def find_personal_data(spark: SparkSession, sf_dir: str) -> DataFrame:
    return pii.find_digests(table(spark, sf_dir, "documents"))


@query("op11_repair_runs")
def find_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return periodic_runs.run_digests(table(spark, sf_dir, "documents"))


@query("op12_polarisation_whitening")
def whiten_vectors(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whiten(table(spark, sf_dir, "embeddings"))


@query("op13_closed_syncmers")
def fingerprint_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints.fingerprints(table(spark, sf_dir, "documents"), sketch=None)
