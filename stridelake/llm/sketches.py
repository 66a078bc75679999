"""Bottom-k sketches of shingle hashes, in DataFrame functions only.

A text's sketch is the ``k`` smallest distinct 64-bit hashes of its overlapping
shingles of five lower-cased words (fewer words are one shingle). Sketches
merge: the sketch of a union is the bottom k of the sketches' union. Of two
sketches, the share of the union's bottom k that both have estimates
resemblance; the k-th hash estimates the number of distinct shingles, and both
together containment.

Defined cases: null text is empty; texts without words have an empty sketch,
which resembles only itself; equal texts have equal sketches; texts with fewer
than k shingles are compared exactly.
"""

from __future__ import annotations

import json
from math import isqrt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

K = 128
SHINGLE_WORDS = 5
#: Ranges of ids for the neighbour search hold about this many documents, and
#: there are never more ranges than MAX_RANGES (their heads are broadcast).
RANGE_ROWS = 1500
MAX_RANGES = 100_000
#: Ids sampled for each range to find its bounds.
RANGE_SAMPLE = 32


def column(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


def bottom(hashes: Column, k: int) -> Column:
    return F.slice(F.sort_array(hashes), 1, k)


def sketch(text, k: int = K, words: int = SHINGLE_WORDS) -> Column:
    """The sketch of a text column. Lambdas bind the words, so that they are
    split once for each text and not once for each shingle."""
    flat = F.trim(F.translate(F.lower(F.coalesce(column(text), F.lit(""))), "\t\n\x0b\x0c\r", "     "))

    def shingles(w: Column) -> Column:
        starts = F.sequence(F.lit(1), F.greatest(F.size(w) - (words - 1), F.lit(1)))
        return F.transform(starts, lambda i: F.xxhash64(F.slice(w, i, words)))

    split = F.when(flat == "", F.array().cast("array<string>")).otherwise(F.split(flat, " +"))
    return F.transform(F.array(split), lambda w: F.when(F.size(w) == 0, F.array().cast("array<bigint>")).otherwise(
        bottom(F.array_distinct(shingles(w)), k)))[0]


def merge(a, b, k: int = K) -> Column:
    """The sketch of the union of two sketched sets."""
    return bottom(F.array_union(column(a), column(b)), k)


def resemblance(a, b, k: int = K) -> Column:
    """Estimated Jaccard similarity, 1.0 for two empty sketches."""
    a, b = column(a), column(b)
    union = merge(a, b, k)
    both = F.size(F.array_intersect(F.array_intersect(a, b), union))
    return F.when(F.size(union) == 0, F.lit(1.0)).otherwise(both / F.size(union))


def distinct_count(a, k: int = K) -> Column:
    """Estimated number of distinct shingles; exact below k."""
    a = column(a)
    kth = (F.element_at(a, -1).cast("double") + F.lit(2.0**63)) / F.lit(2.0**64)
    return F.when(F.size(a) < k, F.size(a).cast("double")).otherwise((k - 1) / kth)


def containment(a, b, k: int = K) -> Column:
    """Estimated share of a's shingles that b has too; 1.0 for an empty a."""
    j = resemblance(a, b, k)
    shared = j / (j + 1) * (distinct_count(a, k) + distinct_count(b, k))
    return F.when(F.size(column(a)) == 0, F.lit(1.0)) \
        .otherwise(F.least(F.lit(1.0), shared / distinct_count(a, k)))


def encode(a) -> Column:
    """A sketch as text: base64 of its hashes, 8 bytes each, ascending."""
    return F.base64(F.unhex(F.array_join(F.transform(column(a), lambda h: F.lpad(F.hex(h), 16, "0")), "")))


def merge_parts(parts: DataFrame, by: list[str], sketches: str, k: int = K, fan_in: int = 64) -> DataFrame:
    """One sketch for each key from any number of parts. Rounds of at most
    about ``fan_in`` sketches a group, so no group holds all parts of a key."""
    most = parts.groupBy(*by).count().agg(F.max("count")).first()[0] or 0
    kept = parts.select(*by, F.col(sketches).alias("__sketch"))
    while most > 0:
        most = -(-most // fan_in)
        salt = F.pmod(F.xxhash64("__sketch"), F.lit(most))
        kept = kept.groupBy(*by, salt.alias("__salt")).agg(F.flatten(F.collect_set("__sketch")).alias("__all")) \
            .select(*by, bottom(F.array_distinct("__all"), k).alias("__sketch"))
        if most == 1:
            break
    return kept.withColumnRenamed("__sketch", sketches)


def id_bounds(docs: DataFrame, range_rows: int) -> list[int]:
    """Ids that cut ``docs`` into ranges of about ``range_rows`` rows, however
    the ids lie: quantiles of about RANGE_SAMPLE ids a range, picked by hash (all
    ids of a small table). The sample places bounds only; every row gets a range."""
    rows = docs.count()
    ranges = max(1, min(MAX_RANGES, -(-rows // range_rows)))
    if ranges == 1:
        return []
    step = max(1, rows // (ranges * RANGE_SAMPLE))
    shares = F.split(F.lit(",".join(str(i / ranges) for i in range(1, ranges))), ",").cast("array<double>")
    picked = docs.where(F.pmod(F.xxhash64("doc_id"), F.lit(step)) == 0).select("doc_id").distinct()
    found = picked.agg(F.percentile_approx("doc_id", shares, 4 * ranges).alias("bounds")).first()["bounds"]
    return sorted(set(found or []))


def range_of(number: Column, bounds: list[int]) -> Column:
    """How many of the ascending ``bounds`` are not above ``number``: a group of
    them is found first, then the place in the group."""
    if not bounds:
        return F.lit(0).cast("long")
    width = 1 + isqrt(len(bounds))
    groups = [bounds[i:i + width] for i in range(0, len(bounds), width)]
    firsts = F.from_json(F.lit(json.dumps([g[0] for g in groups])), "array<bigint>")
    nested = F.from_json(F.lit(json.dumps(groups)), "array<array<bigint>>")
    below = lambda array: F.size(F.filter(array, lambda b: b <= number))
    return F.transform(F.array(below(firsts)), lambda g: F.when(g == 0, F.lit(0)).otherwise(
        (g - 1) * width + below(F.element_at(nested, F.greatest(g, F.lit(1))))))[0].cast("long")


def with_next(docs: DataFrame, columns: list[str], *, range_rows: int = RANGE_ROWS) -> DataFrame:
    """Each document with ``next_<column>`` of the next by descending doc_id,
    the first after the last. Documents go to ranges of ids, bounded by quantiles,
    so that outlying ids crowd no range; each range gets a copy of the head of the
    range below it as its last row, so neighbours are found inside ranges and no
    task sorts all. Null ids come last; equal ids are ordered by text."""
    bounds = id_bounds(docs, range_rows)
    bucket = F.when(F.col("doc_id").isNull(), F.lit(-1).cast("long")).otherwise(range_of(F.col("doc_id"), bounds))
    heads = docs.groupBy(bucket.alias("own")).agg(F.max("doc_id").alias("head"))
    above = Window.orderBy("own")  # at most MAX_RANGES rows
    heads = heads.select("head", F.lead("own").over(above).alias("above"), F.min("own").over(
        above.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)).alias("lowest")) \
        .select("head", F.coalesce("above", "lowest").alias("to"))
    rows = docs.join(F.broadcast(heads), docs["doc_id"].eqNullSafe(heads["head"]), "left")
    dealt = rows.select(*docs.columns, F.explode(F.when(F.col("to").isNull(), F.array(F.struct(
        bucket.alias("bucket"), F.lit(False).alias("guest")))).otherwise(F.array(
            F.struct(bucket.alias("bucket"), F.lit(False).alias("guest")),
            F.struct(F.col("to").alias("bucket"), F.lit(True).alias("guest"))))).alias("__at"))
    order = Window.partitionBy("__at.bucket").orderBy(
        F.col("__at.guest"), F.col("doc_id").desc_nulls_last(), F.col("text"))
    return dealt.select("*", *[F.lead(c).over(order).alias(f"next_{c}") for c in columns]) \
        .where("not __at.guest").drop("__at")


def edit_report(docs: DataFrame, k: int = K) -> DataFrame:
    """Fingerprints of every text and of its edited form (its second half
    replaced by the start of the next document), and their likeness."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    rows = with_next(rows.withColumn("own", sketch("text", k)), ["text", "own"])
    half = F.floor(F.char_length("text") / 2).cast("int")
    edited = rows.select(
        "doc_id", F.char_length("text").cast("long").alias("n_chars"), "own", "next_own",
        F.concat(F.substring(F.col("text"), F.lit(1), F.char_length("text") - half),
                 F.substring(F.col("next_text"), F.lit(1), half)).alias("edited"))
    both = edited.select("*", sketch("edited", k).alias("other"))
    return both.select(
        "doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"),
        encode("own").alias("fingerprint"), encode("other").alias("edited_fingerprint"),
        resemblance("own", "other", k).alias("near_edited"), resemblance("own", "next_own", k).alias("near_next"),
        distinct_count("own", k).alias("distinct_shingles"))
