"""JDBC sinks (SNK-3, SNK-4, SNK-5).

Connection settings are always arguments (never hard-coded credentials).
The keyed upsert loads the batch into a staging table through Spark's JDBC
writer (parallel, one connection per task), then runs one set-based MERGE in
the database, issued as the ``sessionInitStatement`` of a one-row JDBC read.
The batch is deduplicated by key first (newest version wins), so a create
and an update of one key in the same micro-batch never hit the same target
row twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from .. import schemas as S
from ..operators.cdc import latest_by_key


#: Column of the staging table that holds a row's change operation.
OP_COLUMN = "change_op"
#: Connections a write opens at once, however many tasks the plan has.
MAX_CONNECTIONS = 32


#: The order columns under names that any database takes, for serving tables
#: that hold the version of each row.
VERSION_COLUMNS = {"__source_ts_ms": "source_ts_ms", "kafka_partition": "kafka_partition", "kafka_offset": "kafka_offset"}


def upsert_serving(silver: DataFrame, url: str, target: str, staging: str, versions: bool = False,
                   props: dict[str, str] | None = None, probe_query: str = "SELECT 1 AS ok") -> int:
    """SNK-4 for the serving projection of Silver rows. ``versions``: target and
    staging hold the order columns (``VERSION_COLUMNS``) after the published
    ones, so that an older change that comes in a later batch changes nothing. (A
    deleted row leaves the target with its version: a still older change of it
    would insert it again; ``sinks.keyed`` keeps deleted keys.)"""
    order = list(VERSION_COLUMNS.values())
    return upsert(silver.withColumnsRenamed(VERSION_COLUMNS), url, target, staging, ["activity_id"], order=order,
                  columns=[*S.SERVING_COLUMNS, *order * versions], props=props, op="__op", probe_query=probe_query)


def _writer(df: DataFrame, url: str, table: str, props: dict[str, str] | None, connections: int = MAX_CONNECTIONS):
    # A shuffle, not a coalesce: the stage that computes the rows keeps its
    # tasks, only the writing is bounded.
    w = df.repartition(connections).write.format("jdbc").option("url", url).option("dbtable", table)
    for k, v in (props or {}).items():
        w = w.option(k, v)
    return w


def write_staging(df: DataFrame, url: str, table: str, props: dict[str, str] | None = None,
                  connections: int = MAX_CONNECTIONS) -> None:
    """SNK-3: overwrite the staging table (truncate, keep its definition)."""
    _writer(df, url, table, props, connections).option("truncate", "true").mode("overwrite").save()


def backfill(df: DataFrame, url: str, table: str, props: dict[str, str] | None = None,
             connections: int = MAX_CONNECTIONS) -> None:
    """SNK-5: bulk append. Re-running it against a keyed target would
    collide with the key: use ``upsert`` for anything that may repeat."""
    _writer(df, url, table, props, connections).mode("append").save()


def merge_statement(target: str, staging: str, key: list[str], columns: list[str],
                    op: str | None = None, order: list[str] | None = None) -> str:
    """Standard SQL MERGE from staging into target on ``key``. ``op``: staging
    column whose value 'd' deletes the row (and inserts none). ``order``:
    columns of both tables that rank the versions of a key; a staged row that
    ranks below the stored one changes nothing (a stored row without a rank, or
    one of equal rank, gives way)."""
    newer = ""
    if order:
        ranks = [f"(s.{c} > t.{c} OR t.{c} IS NULL" for c in order]
        # Lexicographic, innermost last: equal in all columns counts as newer.
        newer = "1 = 1"
        for c, rank in zip(reversed(order), reversed(ranks)):
            newer = f"{rank} OR (s.{c} = t.{c} AND {newer}))"
        newer = f"AND {newer} "
    on = " AND ".join(f"t.{k} = s.{k}" for k in key)
    updates = ", ".join(f"{c} = s.{c}" for c in columns if c not in key)
    cols = ", ".join(columns)
    vals = ", ".join(f"s.{c}" for c in columns)
    delete = f"WHEN MATCHED AND s.{op} = 'd' {newer}THEN DELETE " if op else ""
    alive = f"AND (s.{op} IS NULL OR s.{op} <> 'd') " if op else ""
    return (f"MERGE INTO {target} t USING {staging} s ON {on} {delete}"
            f"WHEN MATCHED {newer}THEN UPDATE SET {updates} "
            f"WHEN NOT MATCHED {alive}THEN INSERT ({cols}) VALUES ({vals})")


def execute(spark, url: str, statement: str, props: dict[str, str] | None = None,
            probe_query: str = "SELECT 1 AS ok") -> None:
    """Run one SQL statement in the database, using the JDBC source's
    ``sessionInitStatement`` on a one-row, one-partition read: the statement
    runs on the connection before the probe query is read. The statement
    should be idempotent (a MERGE from staging is)."""
    reader = (spark.read.format("jdbc").option("url", url).option("query", probe_query)
              .option("sessionInitStatement", statement))
    for k, v in (props or {}).items():
        reader = reader.option(k, v)
    reader.load().collect()


def upsert(df: DataFrame, url: str, target: str, staging: str, key: list[str],
           order: list[str] | None = None, columns: list[str] | None = None,
           props: dict[str, str] | None = None, probe_query: str = "SELECT 1 AS ok",
           op: str | None = None) -> int:
    """SNK-4: keyed upsert of a batch into a JDBC table. ``order``: columns
    that rank versions of a key in the batch (newest wins); ``columns``: the
    target's columns (default: all of ``df``); ``op``: change operation, so that
    a key whose newest version is a delete leaves the target (the staging
    table then has a column ``change_op`` more). If the target holds the
    ``order`` columns (they are in ``columns``), an older change of a later batch
    does not win over a stored row. Returns the number of rows staged (SNK-14: counted during the staging write, no extra job)."""
    batch = latest_by_key(df, key, order) if order else df
    columns = [c for c in (columns or df.columns) if c != op]
    batch = batch.select(*columns, *([F.col(op).alias(OP_COLUMN)] if op else []))
    obs = Observation("staged_rows")
    write_staging(batch.observe(obs, F.count(F.lit(1)).alias("rows")), url, staging, props)
    execute(df.sparkSession, url, merge_statement(target, staging, key, columns, OP_COLUMN if op else None,
                                                     order if order and set(order) <= set(columns) else None), props,
            probe_query)
    return int(obs.get["rows"])
