"""From raw documents to token ids: quality rules, near-duplicates, secrets, mixing, encoding.

Each stage gets what its predecessor kept, written as Parquet and read again, and works on all of it.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakemart.llm import quality_forest, secret_forest, simhash_dedup, source_mixing, token_automaton
from lakemart.llm.texts import stored

WORD_VOCABULARY = public_tokenizers.path("word_bpe_49k.json")


def good_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules and the isolation forest keep."""
    return quality_forest.keep_good(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))


def one_of_each(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near-duplicates."""
    return simhash_dedup.first_of_each(docs, shingle=4, threshold=4)


def without_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, secrets masked."""
    return secret_forest.mask_secrets(docs)


def in_target_shares(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents in the order of a mix in which no source has more than a quarter until the others have run out."""
    return source_mixing.mixed(docs, cap=0.25)


def encoded(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token ids of every document (little-endian unsigned 32-bit integers), with digests of them and of their decoding, and
    their place in the stream of the mix: ``place`` (documents before it) and ``start`` (their ids).

    ``docs`` is read from files, whose order is that of the mix.
    """
    keep = ["doc_id", "lang", "source", "_part", "_row"]
    found = token_automaton.encode_decode(source_mixing.in_file_order(docs).select(*keep, "text"), WORD_VOCABULARY, "text", keep)
    found = found.select(*keep, "n_tokens", "ids", F.sha2("ids", 256).alias("ids_sha256"), F.sha2("decoded", 256).alias("decoded_sha256"))
    return source_mixing.streamed(stored(found, "encoded"), "n_tokens")


STAGES = [
    ("quality_rules", good_documents),
    ("simhash_dedup", one_of_each),
    ("secret_scan", without_secrets),
    ("source_mixing", in_target_shares),
    ("bpe_encoding", encoded),
]

#: Forests, hashes and tokenizers are beyond SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over the documents table."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = stored(stage(spark, docs, sf_dir), name)
    return docs
