"""Mixing sources to target weights with cube-method balanced sampling.

Targets. Sources in code point order (null last) weigh 1, 2, 3, repeating, and
share all sizes; a target stops at ``max_repeat`` times its source's size, and
the excess is shared out by weight until no target is above. A source's rate is
its target over its size: every document is taken as often as the rate's whole
part says, and once more with the rate's fraction as inclusion probability.

Cube. Which documents are taken once more is a balanced sample. In blocks of a
source, three undecided documents at a time move their probabilities along the
null space of two constraints (the sum of sizes and the number of documents),
up or down at random with the chances that keep each probability's mean, until
one of them is 0 or 1. So a block keeps both totals exactly and ends with two
documents undecided at most. These are gathered in new blocks, level after
level, until one block holds a source's rest. Only there, with two documents
left, constraints are given up: first sizes, then the number; small documents
kept for the end make up for what that misses.

Scale. A block holds about ``block_rows`` documents whatever the source, and a
level leaves two of each block, so the number of levels grows with the
logarithm of the input. A source of one block is only landed, whatever the
number of levels that others need. Source totals are collected (``max_sources``
at most, else an error). Random numbers depend on seed, source, level and block
alone; a source's landing counts as level 0, so other sources do not change it.

Defined cases: null text has size 0; a source of size 0 has target 0 and takes
nothing; a null source is a source; a repeated row is one more document; an
empty table gives no rows.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import checkpoint_root
from .common import WORD_PATTERN
from .simhash import text_hash

UNITS = "doc_id long, text_hash long, source_id long, size long, p double"
UNITS_ARROW = pa.schema([("doc_id", pa.int64()), ("text_hash", pa.int64()), ("source_id", pa.int64()),
                         ("size", pa.int64()), ("p", pa.float64())])


def word_count(text="text") -> Column:
    return F.coalesce(F.regexp_count(F.col(text), F.lit(WORD_PATTERN)), F.lit(0)).cast("long")


def share_targets(sizes: list[int], weights: list[float], max_repeat: float) -> list[float]:
    """Shares of the total by weight, none above ``max_repeat`` of its size."""
    targets = [0.0] * len(sizes)
    free, rest = set(range(len(sizes))), float(sum(sizes))
    while free:
        weight = sum(weights[i] for i in free)
        above = {i for i in free if rest * weights[i] / weight > max_repeat * sizes[i]}
        if not above:
            for i in free:
                targets[i] = rest * weights[i] / weight
            break
        for i in above:
            targets[i] = float(max_repeat * sizes[i])
        rest -= sum(targets[i] for i in above)
        free -= above
    return targets


def null_direction(a: float, b: float, c: float) -> tuple[float, float, float]:
    """Changes of three probabilities that keep their sum and that of sizes."""
    return (1.0, -1.0, 0.0) if a == b == c else (b - c, c - a, a - b)


def stride(p: list[float], u: tuple[float, ...], rng) -> list[float]:
    """Moves p along u, up or down at random, to where one value is 0 or 1."""
    ups = [(1 - x) / d if d > 0 else -x / d for x, d in zip(p, u) if d]
    downs = [x / d if d > 0 else (x - 1) / d for x, d in zip(p, u) if d]
    up, down = min(ups), min(downs)
    step = up if rng.random() * (up + down) < down else -down
    out = [x + step * d for x, d in zip(p, u)]
    return [0.0 if x < 1e-9 else 1.0 if x > 1 - 1e-9 else x for x in out]


def fly(size: np.ndarray, p: np.ndarray, rng) -> tuple[np.ndarray, list[int]]:
    """Flight phase over one block, in order; at most two stay undecided."""
    p = p.copy()
    held: list[int] = []

    def settle(u: tuple[float, ...]) -> None:
        moved = stride([p[i] for i in held], u, rng)
        for i, x in zip(held, moved):
            p[i] = x
        held[:] = [i for i in held if 0 < p[i] < 1]

    for i in np.flatnonzero((p > 0) & (p < 1)).tolist():
        held.append(i)
        if len(held) == 3:
            settle(null_direction(*(float(size[k]) for k in held)))
    if len(held) == 2 and size[held[0]] == size[held[1]]:
        settle((1.0, -1.0))
    return p, held


def bisect(low: float, high: float, below, steps: int = 40) -> float:
    for _ in range(steps):
        middle = (low + high) / 2
        low, high = (middle, high) if below(middle) else (low, middle)
    return high


def shifted(size: np.ndarray, p: np.ndarray, total: float, number: float) -> np.ndarray:
    """Probabilities raised or lowered until they expect ``total`` words:
    tilted by size so that they expect ``number`` documents as well, or alike
    where no tilt can."""
    spread = size - size.mean()
    spread = spread / max(1.0, np.abs(spread).max())

    def tilted(slope: float) -> np.ndarray:
        tilt = p + slope * spread
        return np.clip(tilt + bisect(-6, 6, lambda x: np.clip(tilt + x, 0, 1).sum() < number), 0, 1)

    out = tilted(bisect(-4, 4, lambda x: (size * tilted(x)).sum() < total))
    if abs((size * out).sum() - total) > 0.5 + 0.001 * abs(total):
        out = np.clip(p + bisect(-1, 1, lambda x: (size * np.clip(p + x, 0, 1)).sum() < total), 0, 1)
    return out


def land(size: np.ndarray, p: np.ndarray, rng) -> np.ndarray:
    """Decides a source's last block, largest documents first. The smallest
    ones, enough to outweigh the largest, wait in reserve: two documents that
    the flight of the others leaves are drawn without the size constraint, the
    reserve's probabilities shift by what that missed (on average nothing), and
    the reserve is landed in the same way."""
    order = np.argsort(-size, kind="stable")
    slack = np.cumsum((size * np.minimum(p, 1 - p))[order][::-1])[::-1]
    outweigh = np.flatnonzero(slack >= 4 * size.max(initial=0))
    cut = max(min(3, len(p)), outweigh[-1] if len(outweigh) else 0)
    first, reserve = order[:cut], order[cut:]
    out = p.copy()
    flown, held = fly(size[first], p[first], rng)
    if len(held) == 2:
        flown[held] = stride(flown[held].tolist(), (1.0, -1.0), rng)
    rest = (flown > 0) & (flown < 1)
    flown[rest] = rng.random(rest.sum()) < flown[rest]
    out[first] = flown
    if len(reserve):
        total = (size * p).sum() - (size[first] * flown).sum()
        tilted = shifted(size[reserve], p[reserve], total, p.sum() - flown.sum())
        out[reserve] = land(size[reserve], tilted, rng)
    return out


def flight(seed: int, level: int, last: bool):
    def run(key, table):
        source, block = (k.as_py() for k in key)
        size = table.column("size").to_numpy()
        order = np.lexsort((table.column("text_hash").fill_null(0).to_numpy(),
                            table.column("doc_id").fill_null(-1).to_numpy(), -size))
        rng = np.random.default_rng([seed, level, source, block])
        p = table.column("p").to_numpy()[order]
        p = land(size[order], p, rng) if last else fly(size[order], p, rng)[0]
        out = table.take(pa.array(order)).select(["doc_id", "text_hash", "source_id", "size"])
        return out.append_column("p", pa.array(p)).cast(UNITS_ARROW)
    return run


def balanced_sample(units: DataFrame, *, seed: int, block_rows: int) -> DataFrame:
    """``units`` with p moved to 0 or 1, balanced in each source. Sources of
    one block wait whole for the last level; in larger ones about a quarter
    block of documents waits, where it makes up for what the landing misses."""
    checkpoint_root(units.sparkSession)
    undecided = (F.col("p") > 0) & (F.col("p") < 1)
    done, level = [units.where(~undecided)], 0
    open_units = units.where(undecided)
    # tables of one row for each source are bounded by max_sources
    counts = open_units.groupBy("source_id").agg(F.count("*").alias("rows"))
    waits = (F.col("rows") <= block_rows) | (F.pmod(F.xxhash64("doc_id", "text_hash", F.lit(seed)), F.col("rows"))
                                             < block_rows // 4)
    open_units = open_units.join(F.broadcast(counts), "source_id").withColumn("waits", waits)
    waiting = open_units.where("waits").select(*units.columns)
    left = open_units.where("not waits").select(*units.columns)
    while True:
        sizes = left.groupBy("source_id").count()
        most = sizes.agg(F.max("count")).first()[0] or 0
        last = most <= block_rows
        if last:
            left = left.unionByName(waiting)
            sizes = left.groupBy("source_id").count()
        blocks = F.ceil(F.col("count") / F.lit(block_rows))
        block = F.pmod(F.xxhash64("doc_id", "text_hash", "size", F.lit(level)), blocks).cast("long")
        flown = left.join(F.broadcast(sizes), "source_id").withColumn("block", F.lit(0).cast("long") if last else block) \
            .groupBy("source_id", "block").applyInArrow(flight(seed, 0 if last else level + 1, last), UNITS).checkpoint()
        done.append(flown.where(~undecided))
        if last:
            break
        left, level = flown.where(undecided), level + 1
    out = done[0]
    for part in done[1:]:
        out = out.unionByName(part)
    return out


def mix_sources(docs: DataFrame, *, max_repeat: int = 3, seed: int = 11, block_rows: int = 2000,
                max_sources: int = 100_000) -> DataFrame:
    """``doc_id, text_hash, size, source_size, target, copies`` of every document."""
    spark = docs.sparkSession
    checkpoint_root(spark)
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_hash().alias("text_hash"),
                       F.col("source").cast("string").alias("source"), word_count().alias("size")).checkpoint()
    found = rows.groupBy("source").agg(F.sum("size").alias("size")).limit(max_sources + 1).collect()
    if len(found) > max_sources:
        raise ValueError(f"more than {max_sources} sources")
    found.sort(key=lambda r: (r["source"] is None, r["source"] or ""))
    sizes = [r["size"] for r in found]
    targets = share_targets(sizes, [1 + i % 3 for i in range(len(found))], max_repeat)
    plan = spark.createDataFrame(
        [(r["source"], i, s, t, t / s if s else 0.0) for i, (r, s, t) in enumerate(zip(found, sizes, targets))],
        "source string, source_id long, source_size long, target double, rate double")
    plan = F.broadcast(plan)  # at most max_sources rows
    units = rows.join(plan, rows["source"].eqNullSafe(plan["source"])).select(
        "doc_id", "text_hash", "source_id", "size", (F.col("rate") - F.floor("rate")).alias("p"))
    chosen = balanced_sample(units, seed=seed, block_rows=block_rows)
    return chosen.join(plan.drop("source"), "source_id").select(
        "doc_id", "text_hash", "size", "source_size", "target",
        (F.floor("rate") + F.col("p")).cast("long").alias("copies"))


def mixing_digest(mixed: DataFrame) -> DataFrame:
    return mixed.select("doc_id", "size", "source_size", "target", (F.col("size") * F.col("copies")).alias("taken"))


def repeat_documents(docs: DataFrame, **options) -> DataFrame:
    """``docs`` with every document as often as the mix takes it."""
    mixed = mix_sources(docs, **options).groupBy("doc_id", "text_hash") \
        .agg(F.sort_array(F.collect_list("copies")).alias("__copies")) \
        .select(F.col("doc_id").alias("__id"), F.col("text_hash").alias("__mixed"), "__copies")
    marked = docs.select(*[F.col(c) for c in docs.columns], text_hash().alias("__hash"))
    joined = marked.join(mixed, marked["doc_id"].cast("long").eqNullSafe(mixed["__id"])
                         & (marked["__hash"] == mixed["__mixed"]))
    same = Window.partitionBy("__id", "__mixed").orderBy(F.lit(0))
    times = F.element_at("__copies", F.row_number().over(same))
    return joined.withColumn("__times", times).where("__times > 0") \
        .withColumn("__copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("__times")))).select(*docs.columns)
