"""The operators as queries over the driver's tables: ``name -> (spark, sf_dir)``.

``ORACLE`` holds DuckDB SQL where SQL can express a query's whole result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from . import (hpylm, langid, line_rules, mixing, oracles, ordinal, packing, prefix_trie, simhash, sketches, suffixes,
               token_counts, toxicity, vector_codes)
from .common import crc_mod_column, documents, labels

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {"op3_suffix_dedup": oracles.SUFFIX_DEDUP, "op7_line_rules": oracles.LINE_RULES,
                          "op12_conversation_trie": oracles.CONVERSATION_TRIE, "op13_vector_codes": oracles.VECTOR_CODES}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_hpy_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Held-out and training scores of all documents under the Pitman-Yor model."""
    return hpylm.score_documents(documents(spark, sf_dir))


@query
def op3_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What 50-byte suffix deduplication leaves of every document."""
    return suffixes.removal_digest(suffixes.remove_repeats(documents(spark, sf_dir)))


@query
def op9_simhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprint and near-duplicate component of every document."""
    return simhash.fingerprint_digest(simhash.near_duplicates(documents(spark, sf_dir)))


@query
def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents, packed into sequences of 2048 tokens."""
    return packing.pack_documents(documents(spark, sf_dir))


@query
def op4_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bottom-k fingerprints of every text and of its edited form."""
    return sketches.edit_report(documents(spark, sf_dir))


@query
def op10_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How many words of each document the mix of sources takes."""
    return mixing.mixing_digest(mixing.mix_sources(documents(spark, sf_dir)))


@query
def op7_line_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line-frequency quality rules over every document, by source."""
    return line_rules.apply_line_rules(documents(spark, sf_dir))


@query
def op8_langid(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Language of every document by error-correcting output codes."""
    docs = documents(spark, sf_dir)
    return langid.identify(docs, langid.train(docs, crc_mod_column(docs["doc_id"], 4) != 2))


@query
def op5_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Toxicity of every document by the string-kernel machine."""
    docs, marks = documents(spark, sf_dir), labels(spark, sf_dir)
    return toxicity.score_toxicity(docs, toxicity.train(docs, marks, crc_mod_column(marks["doc_id"], 4) != 2))


@query
def op6_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Expected grade of every document and the chance that it is good enough."""
    docs, ratings = documents(spark, sf_dir), ordinal.grades_of(labels(spark, sf_dir))
    return ordinal.grade_documents(docs, ordinal.train(docs, ratings, crc_mod_column(ratings["doc_id"], 4) != 2))


@query
def op11_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Tokens of every text by rank-synchronous merging."""
    return token_counts.count_digest(token_counts.count_tokens(documents(spark, sf_dir)))


@query
def op12_conversation_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All nodes of the prefix trie of the rebuilt conversations."""
    return prefix_trie.conversation_trie(spark.read.parquet(f"{sf_dir}/conversations.parquet"))


@query
def op13_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Product codes of all embeddings, with their errors."""
    return vector_codes.compression_digest(vector_codes.compress(spark.read.parquet(f"{sf_dir}/embeddings.parquet")))
