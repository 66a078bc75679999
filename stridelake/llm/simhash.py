"""SimHash near-duplicates by a Gray-ordered hierarchical index.

Fingerprints. Words are lower-cased (A-Z) and taken in overlapping shingles of
three, repeats included; a bit is set where more than half of the shingles'
XXH64 values (seed 42) have it. Fewer words are one shingle; none give zero.

Links. Equal fingerprints are one node. Of 5 bit blocks, two fingerprints that
differ in at most 3 bits share 2 blocks at least, so each node goes to the 10
buckets of its block pairs and every link falls inside a bucket. A shard of
buckets is indexed: fingerprints are sorted by bucket and Gray rank, runs of
them form leaves and runs of leaves upper nodes. The bits on which all below a
node agree are factored into it, less those that its parent has, and a search
adds up differences on its way down, dropping whole groups above the limit.
Groups that are already in the searcher's component are dropped as well, so a
cluster of near copies costs far less than its pairs, and a shard returns one
edge for a fingerprint at most: a forest, never the pairs. The forests meet in
a distributed component search.

Scale. A hot text is one node however many copies it has; a bucket holds
fingerprints that agree on 25 or 26 bits, of which a tight cluster has a
bounded number.

Defined cases: null and empty texts have fingerprint zero and link like any
other; a repeated row is a document of its own; a null id is later than all
(its component may have no id); an empty table gives no rows.
"""

from __future__ import annotations

from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .common import shard_count, small_batches, text_bytes
from .components import components

BLOCKS = ((0, 13), (13, 13), (26, 13), (39, 13), (52, 12))
SEED = 42
LEAF, FAN = 16, 8


# --- fingerprints ------------------------------------------------------------

def shingle_hashes(text: str | None, words: int) -> list[int]:
    parts = text_bytes(text).lower().split()
    joined, digest = b" ".join(parts), xxhash.xxh64_intdigest
    if len(parts) <= words:
        return [digest(joined, SEED)] if parts else []
    sizes = np.fromiter(map(len, parts), np.int64, len(parts))
    stops = np.cumsum(sizes + 1) - 1
    starts = (stops - sizes)[:len(parts) - words + 1]
    return [digest(joined[a:b], SEED) for a, b in zip(starts.tolist(), stops[words - 1:].tolist())]


def majority(hashes: list[int], step: int = 1 << 16) -> int:
    """The bits that over half of the hashes have; a long list in steps."""
    if not hashes:
        return 0
    h = np.array(hashes, np.uint64)
    counts = np.zeros(64, np.int64)
    for a in range(0, len(h), step):
        bits = np.unpackbits(h[a:a + step].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * counts > len(h), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprinter(words: int):
    def run(batches):
        for batch in batches:
            prints = [majority(shingle_hashes(t, words)) for t in batch.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(prints, pa.int64())], ["doc_id", "text_hash", "fp"])
    return run


def text_hash() -> Column:
    """With doc_id, tells rows apart when results meet the documents again."""
    return F.xxhash64(F.col("text"), F.col("text").isNull())


def fingerprints(docs: DataFrame, *, words: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp``: one row for each document."""
    small_batches(docs.sparkSession)
    return docs.select(docs["doc_id"].cast("long").alias("doc_id"), text_hash().alias("text_hash"), docs["text"]) \
        .select("doc_id", "text_hash", "text") \
        .mapInArrow(fingerprinter(words), "doc_id long, text_hash long, fp long")


# --- index -------------------------------------------------------------------

def gray_rank(x: np.ndarray) -> np.ndarray:
    """Position of a code word in the reflected Gray sequence."""
    x = x.copy()
    for shift in (1, 2, 4, 8, 16, 32):
        x ^= x >> np.uint64(shift)
    return x


class Forest:
    """Labels of linked items; a label is the least index of its component."""

    def __init__(self, n: int):
        self.label = np.arange(n)

    def join(self, a: np.ndarray, b: np.ndarray) -> None:
        while len(a):
            x, y = self.label[a], self.label[b]
            apart = x != y
            a, b, x, y = a[apart], b[apart], x[apart], y[apart]
            if not len(a):
                return
            np.minimum.at(self.label, np.maximum(x, y), np.minimum(x, y))
            while True:
                up = self.label[self.label]
                if (up == self.label).all():
                    break
                self.label = up


class GrayIndex:
    """Levels of nodes over fingerprints sorted by bucket and Gray rank."""

    def __init__(self, bucket: np.ndarray, fp: np.ndarray):
        order = np.lexsort((gray_rank(fp), bucket))
        self.bucket, self.fp = bucket[order].astype(np.uint64), fp[order]
        n = len(fp)
        starts = np.arange(0, n, LEAF)
        levels = []
        parts = [(np.bitwise_and, np.bitwise_or, x) for x in (self.bucket, self.fp)]
        bounds = [(f.reduceat(x, starts), g.reduceat(x, starts)) for f, g, x in parts]
        while True:
            levels.append((starts, [(a & ~(a ^ o), ~(a ^ o)) for a, o in bounds]))
            if len(starts) <= FAN:
                break
            cut = np.arange(0, len(starts), FAN)
            bounds = [(np.bitwise_and.reduceat(a, cut), np.bitwise_or.reduceat(o, cut)) for a, o in bounds]
            starts = starts[cut]
        self.levels = levels[::-1]
        self.stops = [np.append(s[1:], n) for s, _ in self.levels]
        #: of each level and word: pattern and the mask bits that the parent lacks
        self.own = []
        for k, (starts, words) in enumerate(self.levels):
            above = [(np.uint64(0), np.uint64(0))] * 2 if not k else \
                [(p[np.arange(len(starts)) // FAN], m[np.arange(len(starts)) // FAN]) for p, m in self.levels[k - 1][1]]
            self.own.append([(p, m & ~up) for (p, m), (_, up) in zip(words, above)])

    def link(self, limit: int, batch: int = 1024) -> Forest:
        """Links items of one bucket that differ in at most ``limit`` bits."""
        n, forest = len(self.fp), Forest(len(self.fp))
        near = np.flatnonzero((self.bucket[1:] == self.bucket[:-1])
                              & (np.bitwise_count(self.fp[1:] ^ self.fp[:-1]) <= limit))
        forest.join(near, near + 1)
        paired = np.zeros(n, bool)  # alone in its bucket: nothing to find
        same = np.flatnonzero(self.bucket[1:] == self.bucket[:-1])
        paired[same] = True
        asking = np.flatnonzero(paired)
        for a in range(0, len(asking), batch):
            self.search(asking[a:a + batch], limit, forest)
        return forest

    def search(self, asking: np.ndarray, limit: int, forest: Forest) -> None:
        top = len(self.levels[0][0])
        q, node = np.repeat(asking, top), np.tile(np.arange(top), len(asking))
        far = np.zeros(len(q), np.int64)
        for k, (starts, _) in enumerate(self.levels):
            low = np.minimum.reduceat(forest.label, starts)
            high = np.maximum.reduceat(forest.label, starts)
            (bp, bm), (fp, fm) = self.own[k]
            ok = (self.stops[k][node] > q + 1) & (((self.bucket[q] ^ bp[node]) & bm[node]) == 0)
            ok &= ~((low[node] == high[node]) & (low[node] == forest.label[q]))
            q, node, far = q[ok], node[ok], far[ok]
            far = far + np.bitwise_count((self.fp[q] ^ fp[node]) & fm[node])
            ok = far <= limit
            q, node, far = q[ok], node[ok], far[ok]
            size, width = (FAN, len(self.levels[k + 1][0])) if k + 1 < len(self.levels) else (LEAF, len(self.fp))
            below = (node[:, None] * size + np.arange(size)).ravel()
            q, far = np.repeat(q, size), np.repeat(far, size)
            ok = below < width
            q, node, far = q[ok], below[ok], far[ok]
        ok = (node > q) & (self.bucket[node] == self.bucket[q]) \
            & (np.bitwise_count(self.fp[node] ^ self.fp[q]) <= limit)
        forest.join(q[ok], node[ok])


def shard_links(limit: int):
    def run(table: pa.Table) -> pa.Table:
        bucket = table.column("bucket").to_numpy().astype(np.int64)
        index = GrayIndex(bucket.view(np.uint64), table.column("fp").to_numpy().view(np.uint64))
        label = index.link(limit).label
        moved = np.flatnonzero(label != np.arange(len(label)))
        return pa.table({"u": index.fp[moved].view(np.int64), "v": index.fp[label[moved]].view(np.int64)})
    return run


def block_bits(fp: Column, block: tuple[int, int]) -> Column:
    return F.shiftrightunsigned(fp, block[0]).bitwiseAND(F.lit((1 << block[1]) - 1))


def buckets(nodes: DataFrame, shards: int) -> DataFrame:
    """Each fingerprint under the 10 pairs of its blocks, dealt to shards."""
    fp = F.col("fp")
    keys = [F.struct(F.lit(t).alias("t"), (block_bits(fp, a) * F.lit(1 << 13) + block_bits(fp, b)).alias("bucket"))
            for t, (a, b) in enumerate(combinations(BLOCKS, 2))]
    return nodes.select("fp", F.explode(F.array(*keys)).alias("k")) \
        .select("fp", "k.bucket", (F.col("k.t") * shards + F.pmod(F.xxhash64("k.bucket", "k.t"), F.lit(shards))).alias("shard"))


def link_components(prints: DataFrame, *, limit: int = 3) -> DataFrame:
    """``fp, root, component_id`` of each distinct fingerprint."""
    if limit > 3:
        raise ValueError("five blocks find links of at most 3 bits")
    nodes = prints.groupBy("fp").agg(F.min("doc_id").alias("least"))
    edges = buckets(nodes.select("fp"), shard_count(prints.sparkSession)) \
        .groupBy("shard").applyInArrow(shard_links(limit), "u long, v long")
    roots = components(edges)
    rooted = nodes.join(roots.withColumnRenamed("node", "fp"), "fp", "left") \
        .select("fp", "least", F.coalesce("root", "fp").alias("root"))
    least = rooted.groupBy("root").agg(F.min("least").alias("component_id"))
    return rooted.select("fp", "root").join(least, "root")


def near_duplicates(docs: DataFrame, *, words: int = 3, limit: int = 3) -> DataFrame:
    """``doc_id, text_hash, fp, component_id, root``: every document with its
    fingerprint and the smallest doc_id that links reach from it."""
    checkpoint_root(docs.sparkSession)
    prints = fingerprints(docs, words=words).checkpoint()
    return prints.join(link_components(prints, limit=limit), "fp")


def fingerprint_digest(found: DataFrame) -> DataFrame:
    return found.select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"), "component_id")


def one_of_each(docs: DataFrame, *, words: int = 3, limit: int = 3) -> DataFrame:
    """``docs`` with one document left of each component: the one with the
    smallest id (of rows with one id, the least text hash)."""
    found = near_duplicates(docs, words=words, limit=limit)
    best = found.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("last"), "doc_id", "text_hash")).alias("best"))
    best = best.select(F.col("best.doc_id").alias("__best_id"), F.col("best.text_hash").alias("__best_hash"))
    marked = docs.select(*[F.col(c) for c in docs.columns], text_hash().alias("__hash"))
    kept = marked.join(best, marked["doc_id"].cast("long").eqNullSafe(best["__best_id"])
                       & (marked["__hash"] == best["__best_hash"]))
    copies = Window.partitionBy("__best_id", "__hash").orderBy(*[c for c in docs.columns if c not in ("doc_id", "text")], F.lit(0))
    return kept.withColumn("__row", F.row_number().over(copies)).where("__row = 1").select(*docs.columns)
