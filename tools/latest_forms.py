"""Times three forms of "newest row of each key" on wide rows.

Usage: python tools/latest_forms.py <sf_dir> [payload_bytes]

The rows are ``events`` with one to four versions each and an incompressible
payload, written once to a scratch folder; a second table gives a third of all
versions to one key. Forms: grouped ``max_by`` of the whole row, the greatest
order of each key joined back, ``row_number``. Best of three runs, noop sink,
with broadcasts off, as for tables of full size.
"""

from __future__ import annotations

import os
import sys
import tempfile
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import DataFrame, Window  # noqa: E402
from pyspark.sql import functions as F  # noqa: E402

from stridelake.operators.cdc import latest_by_key  # noqa: E402
from stridelake.session import build_session  # noqa: E402

ORDER = ["ts_ms", "part", "off"]


def by_max(df: DataFrame) -> DataFrame:
    return latest_by_key(df, "k", ORDER)


def by_join(df: DataFrame) -> DataFrame:
    newest = df.groupBy("k").agg(F.max(F.struct(*ORDER)).alias("_o")).select("k", *[F.col(f"_o.{c}").alias(c) for c in ORDER])
    return df.join(newest, ["k", *ORDER], "left_semi")


def by_number(df: DataFrame) -> DataFrame:
    order = Window.partitionBy("k").orderBy(*[F.desc(c) for c in ORDER])
    return df.withColumn("_n", F.row_number().over(order)).where("_n = 1").drop("_n")


def main() -> None:
    sf, size = sys.argv[1], int(sys.argv[2]) if len(sys.argv) > 2 else 1024
    spark = build_session("local[8]", shuffle_partitions=16, extra={"spark.sql.autoBroadcastJoinThreshold": "-1"})
    spark.sparkContext.setLogLevel("ERROR")
    folder = tempfile.mkdtemp(prefix="run-latest-")
    events = spark.read.parquet(f"{sf}/events.parquet")
    salt = F.xxhash64(*events.columns)
    rows = events.select(salt.alias("k"), F.explode(F.sequence(F.lit(1), 1 + F.pmod(salt, F.lit(4)))).alias("off")) \
        .select("k", F.pmod(F.xxhash64("k", "off"), F.lit(1000)).alias("ts_ms"), F.lit(0).alias("part"), "off",
                F.concat(*[F.sha2(F.concat_ws(":", "k", "off", F.lit(i)), 256) for i in range(-(-size // 64))]).alias("payload"))
    rows.repartition(16).write.parquet(f"{folder}/even")
    spark.read.parquet(f"{folder}/even") \
        .withColumn("k", F.when(F.pmod(F.xxhash64("payload"), F.lit(3)) == 0, F.lit(7)).otherwise(F.col("k"))) \
        .withColumn("off", F.xxhash64("payload")).write.parquet(f"{folder}/hot")
    for name in ("even", "hot"):
        table = spark.read.parquet(f"{folder}/{name}")
        keys = table.select("k").distinct().count()
        for form in (by_max, by_join, by_number):
            seconds = []
            for _ in range(4):
                t0 = time.perf_counter()
                form(table).write.format("noop").mode("overwrite").save()
                seconds.append(time.perf_counter() - t0)
            assert form(table).count() == keys
            print(f"{name:5s} {form.__name__:10s} {min(seconds[1:]):6.2f} s  ({table.count()} rows, {keys} keys)", flush=True)
    spark.stop()


if __name__ == "__main__":
    main()
