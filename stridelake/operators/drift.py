"""Payload fields that the declared schema does not know (PR-1, PR-3, ST-6).

A producer may add fields at any time. ``with_unknown_fields`` keeps what the
typed columns leave over as JSON text beside them, so nothing is lost in Bronze,
and ``drift_report`` says which paths and types have appeared, how often and
since when. Messages are parsed to VARIANT, once, in the JVM.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .. import schemas as S

UNKNOWN = "unknown_fields"
_MAP = "map<string,variant>"


def _payload(value: Column) -> Column:
    """The payload of an envelope, else the bare message, as VARIANT."""
    whole = F.try_parse_json(value)
    return F.coalesce(F.try_variant_get(whole, "$.payload", "variant"), whole)


def unknown_fields(value: Column, known: list[str] | None = None) -> Column:
    """JSON text of the message's fields outside the declared schema (keys in
    order); null if there are none or the text is no object. JSON cannot tell
    an unknown field that is null from its type, so it stays as null."""
    known = [*(known or [f.name for f in S.CDC_PAYLOAD.fields]), "payload"]
    rest = F.map_filter(F.try_variant_get(_payload(value), "$", _MAP), lambda k, _: ~k.isin(*known))
    return F.when(F.size(rest) > 0, F.to_json(rest))


def _kind(value: Column) -> Column:
    """Name of a VARIANT's type without its parameters or members."""
    return F.regexp_extract(F.schema_of_variant(value), r"^\w+", 0)


def drift_report(bronze: DataFrame, depth: int = 3) -> DataFrame:
    """``(path, type, messages, first_offset, last_offset)`` of the unknown
    fields kept in ``bronze``, members of objects included down to ``depth``
    names. One scan; the groups are paths, partially aggregated."""
    def members(value: Column, prefix: Column | None) -> Column:
        return F.transform(F.map_entries(F.try_variant_get(value, "$", _MAP)), lambda e: F.struct(
            (e["key"] if prefix is None else F.concat(prefix, F.lit("."), e["key"])).alias("path"), e["value"].alias("value")))

    level = members(F.parse_json(F.col(UNKNOWN)), None)
    found = [level]
    for _ in range(depth - 1):
        objects = F.filter(level, lambda e: _kind(e["value"]) == "OBJECT")
        level = F.flatten(F.transform(objects, lambda e: members(e["value"], e["path"])))
        found.append(level)
    return (bronze.where(F.col(UNKNOWN).isNotNull())
            .select("kafka_offset", F.inline(F.concat(*found)))
            .groupBy("path", _kind(F.col("value")).alias("type"))
            .agg(F.count(F.lit(1)).alias("messages"), F.min("kafka_offset").alias("first_offset"),
                 F.max("kafka_offset").alias("last_offset")))
