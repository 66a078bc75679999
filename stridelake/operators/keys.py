"""Key-based helpers that keep the large side of a lookup from being
shuffled in full.

* Existence checks (``unknown_keys``, ``rows_with_unknown_key``,
  ``flag_unknown_key``): take the distinct keys of the (large) fact side - a
  partial aggregate, so a hot key costs one row per map task - anti-join
  them with the reference keys, and join the fact rows to the resulting set
  of unknown keys with a null-safe condition. That set is usually tiny, so
  AQE broadcasts it once its size is measured; when it is not, the plan
  falls back to a shuffle join with skew splitting. NULL keys count as
  unknown.
* ``rows_for_keys``: cut a large reference table to the keys of a small
  batch before a lookup join.
* ``one_per_key``: deterministic one-row-per-key dedupe of a reference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def unknown_keys(facts: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Distinct values of ``facts.key`` absent from ``reference.key``
    (including NULL), as column ``_unknown_key``."""
    ids = facts.select(key).distinct()
    return (ids.join(reference.select(key), key, "left_anti")
            .select(F.col(key).alias("_unknown_key")))


def rows_with_unknown_key(facts: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Fact rows whose key does not exist in the reference."""
    u = unknown_keys(facts, reference, key)
    return facts.join(u, F.col(key).eqNullSafe(F.col("_unknown_key")), "left_semi")


def flag_unknown_key(facts: DataFrame, reference: DataFrame, key: str,
                     flag: str = "_unknown") -> DataFrame:
    """All fact rows, plus boolean ``flag`` = key does not exist."""
    u = unknown_keys(facts, reference, key).withColumn(flag, F.lit(True))
    return (facts.join(u, F.col(key).eqNullSafe(F.col("_unknown_key")), "left")
            .drop("_unknown_key")
            .withColumn(flag, F.coalesce(F.col(flag), F.lit(False))))


def one_per_key(df: DataFrame, key: str) -> DataFrame:
    """Deterministic dedupe of a reference table: the greatest attribute row
    per key. A partial aggregate on the key the following join uses, so it
    adds no shuffle of its own."""
    attrs = [c for c in df.columns if c != key]
    return (df.groupBy(key).agg(F.max(F.struct(*attrs)).alias("_r"))
            .select(key, *[F.col(f"_r.{c}").alias(c) for c in attrs]))


def rows_for_keys(reference: DataFrame, ref_key: str, facts: DataFrame, fact_key: str) -> DataFrame:
    """The reference rows whose key occurs in ``facts``: a semi join against
    the distinct fact keys. When the facts are a micro-batch, that key set is
    small and broadcast, so a large reference table is scanned and filtered
    instead of shuffled before the lookup join."""
    keys = facts.select(F.col(fact_key).alias("_fk")).distinct()
    return reference.join(keys, F.col(ref_key) == F.col("_fk"), "left_semi")
