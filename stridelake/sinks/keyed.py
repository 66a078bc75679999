"""Keyed lake table: an upsert that costs the partitions it touches (SNK-4, SNK-8).

The table lies in date partitions under ``<root>/data/version=<n>/<date>``. A
version is a manifest, ``<root>/manifest/v<n>``: one row for each partition with
the directory that holds it, so unchanged partitions are shared between versions
(copy on write). A manifest counts once its write has finished; readers take the
newest finished one by name and then read a fixed set of directories, so they
see one version throughout, whatever is written meanwhile.

An upsert finds the batch's keys in the table by a semi join on the key, order
and date columns alone (column pruning makes them a narrow locator; partitions
are sorted by key, so row groups outside the batch's key range are skipped). Only
partitions that gain or lose a row are read in full and written again. A key
that changes its date leaves the old one. Deleted keys stay as rows whose
operation is ``d``, so that an older change that comes late cannot bring them
back; readers do not see them.

One writer at a time, as a stream has. A write that dies before its manifest
leaves nothing that a reader sees, and the next attempt overwrites it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import DateType, StructType

from ..functions.literal import literal_table
from ..operators.cdc import ORDER_COLUMNS, latest_by_key
from ..operators.changes import net_changes
from ..sources.files import committed, names, newest, numbered, remove

NULL_PARTITION = "__HIVE_DEFAULT_PARTITION__"
_MANIFEST = [("partition", "string"), ("path", "string")]


class KeyedTable:
    """A keyed, date-partitioned table under ``root``."""

    def __init__(self, spark: SparkSession, root: str, schema: StructType, key: str = "activity_id",
                 partition: str = "activity_date", order: list[str] | None = None, op: str = "__op",
                 fmt: str = "parquet"):
        if not isinstance(schema[partition].dataType, DateType):
            raise ValueError(f"{partition} must be a date")
        self.spark, self.root, self.schema = spark, root.rstrip("/"), schema
        self.key, self.partition, self.op, self.fmt = key, partition, op, fmt
        self.order = order or ORDER_COLUMNS

    # --- versions ---

    def versions(self) -> list[int]:
        return committed(self.spark, f"{self.root}/manifest")

    def manifest(self, version: int | None = None) -> dict[str, str]:
        """Partition directory name -> path below ``data`` (a row for each date)."""
        at = f"{self.root}/manifest"
        name = newest(self.spark, at) if version is None else numbered(version)
        if name is None:
            return {}
        return {r["partition"]: r["path"] for r in self.spark.read.parquet(f"{at}/{name}").collect()}

    def _load(self, paths: list[str], *more: str) -> DataFrame:
        columns = [c.name for c in self.schema]
        if not paths:
            types = [(f.name, f.dataType.simpleString()) for f in self.schema] + [(c, "int") for c in more]
            return literal_table(self.spark, [], types)
        return (self.spark.read.format(self.fmt).schema(self.schema).option("basePath", f"{self.root}/data")
                .load([f"{self.root}/data/{p}" for p in paths]).select(*columns, *more))

    def read(self, version: int | None = None, deleted: bool = False, written: bool = False) -> DataFrame:
        """The rows of a version (the newest by default). ``deleted``: deleted
        keys too; ``written``: with the version that wrote the row's partition,
        as ``version``."""
        rows = self._load(sorted(self.manifest(version).values()), *["version"] * written)
        return rows if deleted else rows.where(F.col(self.op).isNull() | (F.col(self.op) != "d"))

    # --- upsert ---

    def changes(self, batch: DataFrame) -> DataFrame:
        """``(key, old, new)`` of the keys that ``batch`` changes; ``old`` and
        ``new`` are whole images."""
        return net_changes(self.read(deleted=True), batch.select(*[c.name for c in self.schema]), self.key, self.order)

    def _name(self, date) -> str:
        return f"{self.partition}={NULL_PARTITION if date is None else date.isoformat()}"

    def upsert(self, batch: DataFrame) -> dict:
        """Merge a batch of versions. Returns the version now current, the
        partitions rewritten and the number of keys changed."""
        before = self.manifest()
        last = newest(self.spark, f"{self.root}/manifest")
        number = int(last[1:]) + 1 if last else 0
        columns = [c.name for c in self.schema]
        latest = latest_by_key(batch.select(*columns).where(F.col(self.key).isNotNull()), self.key, self.order)
        locator = (self.read(deleted=True).select(self.key, F.col(self.partition).alias("_was"),
                                                  F.struct(*self.order).alias("_rank"))
                   .join(latest.select(self.key), self.key, "left_semi"))
        changed = (latest.join(locator, self.key, "left")
                   .where(F.col("_rank").isNull() | (F.struct(*self.order) > F.col("_rank"))))
        staged_at = f"{self.root}/staging/{numbered(number)}"
        (changed.select(*columns, F.col("_rank").isNotNull().alias("_stored"), "_was")
         .write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "static").save(staged_at))
        staged = self.spark.read.format(self.fmt).load(staged_at)
        # Bounded by the number of dates.
        touched = staged.select(F.explode(F.array(
            F.struct(F.col(self.partition).alias("date"), F.lit(True).alias("real")),
            F.struct(F.col("_was").alias("date"), F.col("_stored").alias("real")))).alias("t")).where("t.real").select("t.date")
        touched = sorted(self._name(r["date"]) for r in touched.distinct().collect())
        if not touched:
            return {"version": number - 1 if last else None, "partitions": [], "changed": 0}
        kept = (self._load([before[t] for t in touched if t in before])
                .join(staged.select(self.key), self.key, "left_anti").select(*columns))
        (kept.unionByName(staged.select(*columns))
         .repartitionByRange(self.partition, self.key).sortWithinPartitions(self.partition, self.key)
         .write.format(self.fmt).mode("overwrite").option("partitionOverwriteMode", "static")
         .partitionBy(self.partition).save(f"{self.root}/data/version={number}"))
        written = {n: f"version={number}/{n}" for n in names(self.spark, f"{self.root}/data/version={number}")
                   if n.startswith(f"{self.partition}=")}
        after = {**{n: p for n, p in before.items() if n not in touched}, **written}
        literal_table(self.spark, sorted(after.items()), _MANIFEST).coalesce(1).write.mode("overwrite") \
            .option("partitionOverwriteMode", "static").parquet(f"{self.root}/manifest/{numbered(number)}")
        return {"version": number, "partitions": touched, "changed": staged.count()}

    def expire(self, keep: int = 20) -> list[str]:
        """Forget all but the newest ``keep`` versions and the directories that
        none of them uses. Returns the directories removed."""
        versions = self.versions()
        for old in versions[:-keep]:
            remove(self.spark, f"{self.root}/manifest/{numbered(old)}")
            remove(self.spark, f"{self.root}/staging/{numbered(old)}")
        used = {p for v in versions[-keep:] for p in self.manifest(v).values()}
        gone = []
        for version in names(self.spark, f"{self.root}/data"):
            for name in names(self.spark, f"{self.root}/data/{version}"):
                if name.startswith(f"{self.partition}=") and f"{version}/{name}" not in used:
                    remove(self.spark, f"{self.root}/data/{version}/{name}")
                    gone.append(f"{version}/{name}")
        return gone
