"""The operators' registered queries, with production parameters over their whole tables."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from lakemart.llm import bitplane_store, byte_convnet, conversation_repair, license_join, oracles, periodic_runs, projection_search, quality_forest, runlength_dedup, secret_forest, simhash_dedup, source_mixing, token_automaton, toxicity_subword

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = dict(oracles.ORACLES)


def query(run: Query) -> Query:
    QUERIES[run.__name__] = run
    return run


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


@query
def op1_projection_search(spark: SparkSession, sf: str) -> DataFrame:
    """The ten nearest found of every hundredth vector."""
    return projection_search.nearest(table(spark, sf, "embeddings"), F.col("vec_id") % 100 == 0)


@query
def op2_source_mixing(spark: SparkSession, sf: str) -> DataFrame:
    """Place of every document in a mix in which no source has more than a quarter until the others have run out."""
    return source_mixing.mix(table(spark, sf, "documents"), cap=0.25).select("doc_id", "source", "block", "slot", "release", "deadline", "in_mix")


@query
def op3_secret_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Every candidate of every document and whether it is a secret."""
    return secret_forest.secrets(table(spark, sf, "documents"))


@query
def op4_token_automaton(spark: SparkSession, sf: str) -> DataFrame:
    """Digests of the ids of every document and of what they decode to."""
    return token_automaton.digests(table(spark, sf, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op5_quality_forest(spark: SparkSession, sf: str) -> DataFrame:
    """Rule statistics and verdict of every document."""
    found = quality_forest.verdicts(table(spark, sf, "documents"), table(spark, sf, "labels"))
    return found.select("doc_id", *quality_forest.NAMES[:5], "base_failed", "kept", "anomaly")


@query
def op6_simhash_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    found = simhash_dedup.near_duplicates(table(spark, sf, "documents"), shingle=4, threshold=4)
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


@query
def op7_toxicity_subword(spark: SparkSession, sf: str) -> DataFrame:
    """Toxicity of every document."""
    return toxicity_subword.toxicity(table(spark, sf, "documents"), table(spark, sf, "labels"))


@query
def op8_runlength_dedup(spark: SparkSession, sf: str) -> DataFrame:
    """Repeated bytes of every document and a digest of the others."""
    found = runlength_dedup.remove_repeats(table(spark, sf, "documents"), length=400).drop("kept")
    return found.withColumns({"n_kept": F.col("n_bytes") - F.col("n_removed"), "changed": F.col("n_removed") > 0})


@query
def op9_license_join(spark: SparkSession, sf: str) -> DataFrame:
    """License labels of every document."""
    return license_join.license_scan(table(spark, sf, "documents"))


@query
def op10_bitplane_store(spark: SparkSession, sf: str) -> DataFrame:
    """Ids of every document as read back from its files."""
    return bitplane_store.store_and_check(table(spark, sf, "documents"), public_tokenizers.path("byte_bpe_50k.json"))


@query
def op11_periodic_runs(spark: SparkSession, sf: str) -> DataFrame:
    """Runs of words of every document, a tenth of which are made to repeat."""
    return periodic_runs.digests(periodic_runs.planted(table(spark, sf, "documents")))


@query
def op12_conversation_repair(spark: SparkSession, sf: str) -> DataFrame:
    """Faults and cheapest repair of every conversation after damage."""
    return conversation_repair.repair_damaged(table(spark, sf, "conversations"))


@query
def op13_byte_convnet(spark: SparkSession, sf: str) -> DataFrame:
    """Language of every document."""
    return byte_convnet.languages(table(spark, sf, "documents"))


QUERIES["pipeline"] = corpus_pipeline.run
