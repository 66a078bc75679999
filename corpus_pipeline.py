"""From raw documents to packed training sequences: five stages over the whole table.

Each stage is a function of (spark, docs, sf_dir); its result is written as
Parquet in the shared checkpoint folder and read again as the next one's
documents, so a lost executor costs a stage at most. All stages but the last
return the columns of ``documents``.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from stridelake.llm import langid, mixing, packing, simhash, suffixes
from stridelake.llm.common import crc_mod_column, documents
from stridelake.session import checkpoint_root


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents with a known, unambiguous language."""
    model = langid.train(docs, crc_mod_column(docs["doc_id"], 4) != 2)
    return langid.with_known_language(docs, model)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each SimHash component (3-word shingles, 3 bits)."""
    return simhash.one_of_each(docs, words=3, limit=3)


def drop_repeats(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Texts without the 50-byte strings that an earlier document has."""
    cleaned = suffixes.without_repeats(docs, length=50)
    return cleaned.withColumn("n_chars", F.char_length(F.coalesce("text", F.lit(""))).cast(docs.schema["n_chars"].dataType))


def mix_to_targets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the mix of sources takes them."""
    return mixing.repeat_documents(docs)


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Token pieces placed in sequences of 2048."""
    return packing.pack_documents(docs, capacity=2048)


STAGES = [
    ("language_id", identify_language),
    ("simhash_near_dedup", drop_near_copies),
    ("suffix_array_dedup", drop_repeats),
    ("source_mixing", mix_to_targets),
    ("best_fit_packing", pack_sequences),
]

#: Tokenisation, sampling and component search have no SQL form; the tests hold
#: the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``."""
    folder = f"{checkpoint_root(spark)}/pipeline-{uuid.uuid4().hex}"
    docs = documents(spark, sf_dir)
    for number, (name, stage) in enumerate(STAGES):
        path = f"{folder}/{number}-{name}"
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return docs
