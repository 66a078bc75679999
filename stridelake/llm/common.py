"""Shared helpers of the operators: reading documents, words, block exchange.

Block exchange. Several operators send compact numpy blocks between *chunks*
(runs of documents) and *shards* (hash ranges of keys). A block is one row
``(key, src, blob)``: ``key >= 0`` addresses a shard, ``key = -1 - chunk``
addresses a chunk, ``src`` names the sender. Spark shuffles, groups, retries
and spills the rows; a group holds the blocks of one shard or one chunk, whose
sizes are set by the number of shards and by the chunk size, never by one hot
key: a sender merges equal keys before it sends them.
"""

from __future__ import annotations

import pickle
import zlib

import numpy as np
import pyarrow as pa
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

BLOCK = "key long, src long, blob binary"
BLOCK_ARROW = pa.schema([("key", pa.int64()), ("src", pa.int64()), ("blob", pa.binary())])
#: ASCII white space; words are the runs between it (bytes.split() agrees).
WHITE = " \t\n\x0b\x0c\r"
WORD_PATTERN = r"[^\x20\x09-\x0D]+"
#: Rows in an Arrow batch: documents may hold a hundred thousand characters.
BATCH_ROWS = "512"


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/documents.parquet")


def labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/labels.parquet")


def shard_count(spark: SparkSession) -> int:
    """Shards of a block exchange: the cluster's own shuffle width."""
    return max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))


def small_batches(spark: SparkSession) -> None:
    """Bound Arrow batches, which hold whole texts."""
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)


def pack(**arrays) -> bytes:
    return zstandard.ZstdCompressor(level=1).compress(pickle.dumps(arrays, protocol=5))


def unpack(blob) -> dict:
    return pickle.loads(zstandard.ZstdDecompressor().decompress(bytes(blob)))


def block_batch(rows: list[tuple[int, int, bytes]]) -> pa.RecordBatch:
    keys, srcs, blobs = zip(*rows) if rows else ((), (), ())
    return pa.RecordBatch.from_arrays(
        [pa.array(keys, pa.int64()), pa.array(srcs, pa.int64()), pa.array(blobs, pa.binary())],
        schema=BLOCK_ARROW)


def block_table(rows: list[tuple[int, int, bytes]]) -> pa.Table:
    return pa.Table.from_batches([block_batch(rows)], schema=BLOCK_ARROW)


def blocks(table: pa.Table) -> list[tuple[int, bytes]]:
    """(src, blob) of a group, by src: the same order in every attempt."""
    found = list(zip(table.column("src").to_pylist(), table.column("blob").to_pylist()))
    return sorted(found, key=lambda x: x[0])


def group_key(*tables: pa.Table) -> int:
    return next(t.column("key")[0].as_py() for t in tables if t.num_rows)


class Vocabulary(dict):
    """Numbers words in order of first sight; ``words`` lists them."""

    def __missing__(self, word):
        n = self[word] = len(self)
        return n


def word_ids(vocabulary: Vocabulary, words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(vocabulary.__getitem__, words), np.int64, len(words))


def crc_mod(doc_id, mod: int) -> int:
    """crc32 of the id's decimal text, modulo; a null id counts as empty text."""
    return zlib.crc32(b"" if doc_id is None else str(doc_id).encode()) % mod


def crc_mod_column(column, mod: int):
    return F.pmod(F.crc32(F.coalesce(column.cast("string"), F.lit("")).cast("binary")), F.lit(mod))


def text_bytes(text: str | None) -> bytes:
    return b"" if text is None else text.encode("utf-8")


def segment_sums(values: np.ndarray, starts: np.ndarray, total: int) -> np.ndarray:
    """Sums of the segments that begin at ``starts`` (some may be empty)."""
    sums = np.concatenate([[0.0], np.cumsum(values, dtype=np.float64)])
    return sums[np.append(starts[1:], total)] - sums[starts]


def mix64(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit mixer (multiply and xor-shift rounds)."""
    x = x.astype(np.uint64, copy=True)
    x ^= x >> np.uint64(31)
    x *= np.uint64(0x9E3779B97F4A7C15)
    x ^= x >> np.uint64(29)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def popcount(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def word_chunks(batches, text_column: int, max_words: int, normal=lambda text: text.lower()):
    """Runs of documents with their words numbered: (rows without the text as
    lists, texts empty or not and with letters or not, words, sequences)."""
    keep = None
    rows, letters, vocabulary, sequences, size = [], [], Vocabulary(), [], 0
    for batch in batches:
        keep = [i for i in range(batch.num_columns) if i != text_column]
        others = zip(*(batch.column(i).to_pylist() for i in keep)) if keep else iter([()] * batch.num_rows)
        for row, text in zip(others, batch.column(text_column)):
            text = text.as_py() or ""
            words = word_ids(vocabulary, normal(text).encode("utf-8").split())
            rows.append(row)
            letters.append(any(map(str.isalpha, text)))
            sequences.append(words.astype(np.int32))
            size += len(words) + 8
            if size >= max_words:
                yield rows, letters, list(vocabulary), sequences
                rows, letters, vocabulary, sequences, size = [], [], Vocabulary(), [], 0
    if rows:
        yield rows, letters, list(vocabulary), sequences


def sample_rows(rows: DataFrame, by: str, per_class: int, max_classes: int, seed: int) -> DataFrame:
    """About ``per_class`` rows of each class, by a hash of the row: a bounded
    training sample that reruns repeat. Classes with fewer rows are whole."""
    counts = rows.groupBy(by).count().orderBy(F.desc("count"), by).limit(max_classes)
    share = F.pmod(F.xxhash64(*[c for c in rows.columns if c != by], F.lit(seed)), F.col("count")) < per_class
    return rows.join(F.broadcast(counts), by).where(share).select(*rows.columns)


def sampled_texts(docs: DataFrame, picked: DataFrame) -> DataFrame:
    """The text of each picked doc_id, with picked's columns: a row for each id,
    also where a doc_id repeats (the least text), so that the sample's bound on
    ids bounds the rows too."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").alias("text")) \
        .join(F.broadcast(picked), "doc_id")
    return rows.groupBy(*picked.columns).agg(F.min(F.coalesce("text", F.lit(""))).alias("text"))
