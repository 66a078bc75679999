"""Net changes of a keyed table: what a batch of versions does to each key.

The old and the new image side by side are what every incremental operator
needs: the keyed upsert (which partitions to rewrite), the rolling activity
(what to take back and what to add), the findings (which rows to judge again).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .cdc import ORDER_COLUMNS, latest_by_key


def net_changes(stored: DataFrame, batch: DataFrame, key: str = "activity_id",
                order: list[str] | None = None) -> DataFrame:
    """``(key, old, new)``: keys whose newest version in ``batch`` is newer than
    the stored one; ``old`` is null for a key not stored. Versions that are
    older than the stored one, and rows without a key, change nothing.

    ``stored`` holds one row per key, deleted ones included (so that a late
    older version cannot bring them back). It is cut to the batch's keys by a
    semi join first: its rows are filtered, not shuffled, while the key set is
    small enough to be broadcast.
    """
    order = order or ORDER_COLUMNS
    columns = [c for c in batch.columns if c != key]
    newest = latest_by_key(batch.where(F.col(key).isNotNull()), key, order)
    new = newest.select(key, F.struct(*columns).alias("new"))
    old = (stored.join(new.select(key), key, "left_semi")
           .select(key, F.struct(*columns).alias("old")))

    def rank(side: str) -> Column:
        return F.struct(*[F.col(f"{side}.{c}") for c in order])

    return (new.join(old, key, "left").where(F.col("old").isNull() | (rank("new") > rank("old")))
            .select(key, "old", "new"))


def is_live(image: str, op: str = "__op") -> Column:
    """The image exists and is not a deletion."""
    return F.col(image).isNotNull() & F.coalesce(F.col(f"{image}.{op}") != F.lit("d"), F.lit(True))
