"""Reference versions in force at a change (JN-1, SNK-7, ST-3).

Reference snapshots are dated: a change is enriched by the version that was in
force at its time, not by the newest one. ``history`` turns dated snapshots into
attribute intervals, one for each run of equal attributes of a key;
``in_force`` joins changes to them.

A hot key is split: the join goes by (key, bucket of time) with the range as a
condition, so a key's changes meet its intervals bucket by bucket and AQE can
split a bucket's changes further; the intervals, a handful for each key and
bucket, are what is copied. There is no window over the changes.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def history(snapshots: DataFrame, key: str, stamp: str = "stamp") -> DataFrame:
    """``(key, attributes..., valid_from, valid_to)`` from rows of whole dated
    snapshots. A key that a snapshot lacks has no interval from then on;
    ``valid_to`` is null for what the newest snapshot holds. A key repeated
    within a snapshot keeps its greatest row. A snapshot without any row cannot
    be seen in its rows, so it must not be the way to say that all keys left.

    One window over a key's snapshots (at most one row for each snapshot)."""
    attributes = [c for c in snapshots.columns if c not in (key, stamp)]
    # Bounded: one row for each snapshot.
    stamps = snapshots.select(stamp).distinct()
    following = stamps.select(stamp, F.lead(stamp).over(Window.orderBy(stamp)).alias("_next"))
    one = snapshots.groupBy(key, stamp).agg(F.max(F.struct(*attributes)).alias("_a"))
    dated = one.join(following, stamp)
    by_key = Window.partitionBy(key).orderBy(stamp)
    same = (F.lag("_next").over(by_key) == F.col(stamp)) & F.lag("_a").over(by_key).eqNullSafe(F.col("_a"))
    runs = dated.withColumn("_new", F.when(F.coalesce(same, F.lit(False)), 0).otherwise(1)) \
        .withColumn("_run", F.sum("_new").over(by_key))
    # The end is unknown (in force still) only where the last of the run is the newest snapshot.
    return (runs.groupBy(key, "_run")
            .agg(F.min(stamp).alias("valid_from"), F.max_by(F.struct("_next"), stamp).getField("_next").alias("valid_to"),
                 F.first("_a").alias("_a"))
            .select(key, *[F.col(f"_a.{c}").alias(c) for c in attributes], "valid_from", "valid_to"))


def _bucket(time: Column, days: int) -> Column:
    return F.floor(F.unix_seconds(time) / F.lit(days * 86400)).cast("long")


def in_force(changes: DataFrame, versions: DataFrame, key: str, at: str, bucket_days: int = 31) -> DataFrame:
    """``changes`` with the attributes of ``versions`` (``history``) in force at
    column ``at``; nulls where none was. A null key or time has none.

    Each interval is copied to the buckets it reaches, up to the newest bucket
    of the changes, so ``bucket_days`` bounds the copies: history in years over
    ``bucket_days``."""
    span = changes.agg(F.min(_bucket(F.col(at), bucket_days)).alias("low"), F.max(_bucket(F.col(at), bucket_days)).alias("high"))
    low, high = span.select("low").scalar(), span.select("high").scalar()
    first = F.greatest(_bucket(F.col("valid_from"), bucket_days), low)
    last = F.least(F.coalesce(_bucket(F.col("valid_to"), bucket_days), high), high)
    attributes = [c for c in versions.columns if c not in (key, "valid_from", "valid_to")]
    spread = (versions.select(F.col(key).alias("_key"), "valid_from", "valid_to", *attributes, first.alias("_first"), last.alias("_last"))
              .where(F.col("_first") <= F.col("_last"))
              .withColumn("_bucket", F.explode(F.sequence("_first", "_last"))).drop("_first", "_last"))
    timed = changes.withColumn("_at_bucket", _bucket(F.col(at), bucket_days))
    inside = ((F.col(key) == F.col("_key")) & (F.col("_at_bucket") == F.col("_bucket"))
              & (F.col(at) >= F.col("valid_from")) & (F.col("valid_to").isNull() | (F.col(at) < F.col("valid_to"))))
    return timed.join(spread, inside, "left").select(
        *changes.columns, *attributes, F.col("valid_from").alias("reference_from"))
