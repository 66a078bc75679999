"""Changes between two versions of a table, and what follows from them
(JN-12, ST-7, SNK-7).

Versions are compared by key and a 64-bit hash of the row: keys and hashes are
what is shuffled, the rows themselves are read for the changed keys only (a semi
join that filters the tables while those keys are few). Two different rows of
one key pass as equal if their hashes collide: once in 2^64 changed rows.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .keys import one_per_key


def _hashed(table: DataFrame, key: str, columns: list[str], name: str) -> DataFrame:
    # Nulls are marked: a hash skips them, so (null, 1) would equal (1, null).
    marks = F.concat(*[F.when(F.col(c).isNull(), "0").otherwise("1") for c in columns])
    return table.select(key, F.xxhash64(marks, *columns).alias(name))


def diff_snapshots(old: DataFrame, new: DataFrame, key: str) -> DataFrame:
    """Change records that turn ``old`` into ``new``: ``__op`` c, u or d, the
    key, and the new row (for d: the old one). Of a key that a version repeats,
    the greatest row is given; a null key is no key."""
    columns = [c for c in old.columns if c != key]
    old, new = (t.select(key, *columns).where(F.col(key).isNotNull()) for t in (old, new))

    def side(table: DataFrame, name: str) -> DataFrame:
        # The set of a key's rows (one, unless the version repeats the key).
        return _hashed(table, key, columns, "_h").groupBy(key).agg(F.xxhash64(F.sort_array(F.collect_set("_h"))).alias(name))

    joined = side(old, "_before").join(side(new, "_after"), key, "full_outer")
    changed = joined.where(~F.col("_before").eqNullSafe(F.col("_after"))).select(
        F.col(key).alias("_key"),
        F.when(F.col("_before").isNull(), "c").when(F.col("_after").isNull(), "d").otherwise("u").alias("__op"))

    def rows(table: DataFrame, ops: list[str]) -> DataFrame:
        own = changed.where(F.col("__op").isin(*ops))
        found = table.join(own.select(F.col("_key").alias(key)), key, "left_semi")
        return one_per_key(found, key).join(own, F.col(key) == F.col("_key")).select("__op", key, *columns)

    return rows(new, ["c", "u"]).unionByName(rows(old, ["d"]))


def apply_changes(old: DataFrame, changes: DataFrame, key: str) -> DataFrame:
    """``old`` with change records applied (one for each key)."""
    kept = old.join(changes.select(key), key, "left_anti")
    return kept.select(*old.columns).unionByName(changes.where(F.col("__op") != "d").select(*old.columns))


def cascade_deletes(changes: DataFrame, child: DataFrame, parent_key: str) -> DataFrame:
    """Change records ``d`` for the rows of ``child`` whose parent is deleted
    (the change-record form of ``ON DELETE CASCADE``): the child is filtered by
    a semi join with the deleted keys, not shuffled while these are few."""
    gone = changes.where(F.col("__op") == "d").select(parent_key)
    return child.join(gone, parent_key, "left_semi").select(F.lit("d").alias("__op"), *child.columns)
