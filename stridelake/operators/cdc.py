"""Change-data-capture operators (PR-1..PR-5, ST-5..ST-8).

* ``decode_cdc``: broker record -> flat Bronze row. Accepts the enveloped
  ``{"payload": {...}}`` form and the bare inner object; malformed text or a
  null payload give an all-NULL business row (Bronze keeps everything).
* ``only_valid`` / ``malformed``: split rows with / without a key.
* ``latest_by_key``: the upsert meaning of the serving table - the newest
  version of each key by ``(__source_ts_ms, kafka_partition, kafka_offset)``.
  It is a grouped ``max_by`` (partial aggregation on the map side), so a key
  updated millions of times costs one row per map task in the shuffle, unlike
  a ``row_number`` window that must sort every version of a key in one task.
* ``current_state``: latest version per key, then keys whose latest change is
  a delete are dropped (dropping deletes first would resurrect the row).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S
from .drift import UNKNOWN, unknown_fields

ORDER_COLUMNS = ["__source_ts_ms", "kafka_partition", "kafka_offset"]


def decode_cdc(raw: DataFrame, ingested_at=None, keep_unknown: bool = False) -> DataFrame:
    """PR-1..PR-3, PR-5: parse ``value`` (text or bytes), flatten the
    payload, keep the broker metadata, stamp the ingestion time.

    ``keep_unknown``: one more column, ``unknown_fields``, with the fields that
    the declared schema does not know as JSON text (``operators.drift``)."""
    # One parse per message, with a schema holding both shapes: the
    # envelope's ``payload`` when present, else the top-level (bare) fields.
    # The parse is the input of a one-row generator: Catalyst cannot push a
    # later filter (e.g. ``source = 'live'``) below a generator, so the JSON
    # is parsed exactly once per message instead of being copied into every
    # pushed-down predicate and projection.
    stamp = F.current_timestamp() if ingested_at is None else (
        ingested_at if isinstance(ingested_at, Column) else F.lit(str(ingested_at)).cast("timestamp"))
    parsed = raw.select(F.inline_outer(F.array(F.from_json(F.col("value").cast("string"), S.CDC_ANY))),
                        F.col("timestamp").alias("kafka_timestamp"),
                        F.col("partition").cast("int").alias("kafka_partition"),
                        F.col("offset").cast("long").alias("kafka_offset"),
                        *([unknown_fields(F.col("value").cast("string")).alias(UNKNOWN)] if keep_unknown else []))
    more = [UNKNOWN] * keep_unknown
    bare = F.struct(*[F.col(f.name) for f in S.CDC_PAYLOAD.fields])
    return (parsed.select(F.coalesce(F.col("payload"), bare).alias("_p"),
                          "kafka_timestamp", "kafka_partition", "kafka_offset", *more)
            .select("_p.*", "kafka_timestamp", "kafka_partition", "kafka_offset",
                    stamp.alias("bronze_ingested_at"), *more))


def only_valid(decoded: DataFrame, key: str = "activity_id") -> DataFrame:
    """PR-4: rows that carry a key."""
    return decoded.where(F.col(key).isNotNull())


def malformed(decoded: DataFrame, key: str = "activity_id") -> DataFrame:
    """PR-4 side output: empty or unparsable messages."""
    return decoded.where(F.col(key).isNull())


def latest_by_key(df: DataFrame, key: str | list[str], order: list[str] | None = None) -> DataFrame:
    """ST-5: newest row per key by the ``order`` columns (descending)."""
    keys = [key] if isinstance(key, str) else list(key)
    order = order or ORDER_COLUMNS
    rest = [c for c in df.columns if c not in keys]
    latest = (df.groupBy(*keys)
              .agg(F.max_by(F.struct(*rest), F.struct(*order)).alias("_latest")))
    return latest.select(*keys, *[F.col(f"_latest.{c}").alias(c) for c in rest])


def current_state(df: DataFrame, key: str = "activity_id", order: list[str] | None = None,
                  op_col: str = "__op") -> DataFrame:
    """ST-5 + ST-7 + ST-8: latest version per key, deleted keys removed.
    Snapshot reads (``r``) count as inserts."""
    latest = latest_by_key(df.where(F.col(key).isNotNull()), key, order)
    return latest.where(F.col(op_col).isNull() | (F.col(op_col) != F.lit("d")))
