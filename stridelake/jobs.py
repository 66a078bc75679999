"""Runnable jobs: ``python -m stridelake.jobs <job> [options]`` (or
spark-submit this module). Each job is a thin argument layer over the
library; connection secrets come from environment variables named on the
command line, never from code.

Streams: bronze, silver, notify, snapshots.
Batch:   export-bi, backfill, quality, benefits, commute, intake, profile,
         load-master, compact-current.
"""

from __future__ import annotations

import argparse
import os
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .operators import benefits as B
from .operators import commute as C
from .operators import intake as I
from .operators import profile as P
from .operators import quality as Q
from .operators.master import upsert_table
from .session import build_session, checkpoint_root
from .sinks import jdbc as J
from .sinks import lake as L
from .sources.cdc import read_cdc_stream
from .sources.reference import (PinnedReferences, load_employees, load_sports, read_employees_ref, read_jdbc_ranges,
                                read_sports_ref)
from .sources.tables import read_table, table_exists
from .streaming.bronze import start_bronze
from .streaming.notifications import start_notifications
from .streaming.reference_snapshots import start_reference_snapshots
from .streaming.silver import compact_current, publish_current, start_silver


def _jdbc_props(args) -> dict[str, str]:
    props = {}
    if getattr(args, "jdbc_user", None):
        props["user"] = args.jdbc_user
    if getattr(args, "jdbc_password_env", None):
        props["password"] = os.environ[args.jdbc_password_env]
    if getattr(args, "jdbc_driver", None):
        props["driver"] = args.jdbc_driver
    return props


def _trigger(args) -> dict | None:
    return {"availableNow": True} if getattr(args, "available_now", False) else None


def _records(spark: SparkSession, args, topics, starting: str) -> DataFrame:
    return read_cdc_stream(spark, topics, source=args.source, bootstrap=args.bootstrap,
                           starting=starting, landing_path=args.landing)


def _read(spark: SparkSession, path: str, fmt: str) -> DataFrame:
    if fmt == "csv":
        return spark.read.option("header", "true").csv(path)
    return read_table(spark, path, fmt)


def _not_yet(rows: DataFrame, path: str, fmt: str, key: str = "activity_id") -> DataFrame:
    """The rows whose key the table at ``path`` does not hold, so that a job
    run again over the same input adds nothing."""
    spark = rows.sparkSession
    if not table_exists(spark, path, fmt):
        return rows
    return rows.join(read_table(spark, path, fmt).select(key), key, "left_anti").select(*rows.columns)


def run(argv: list[str] | None = None, stop: bool = True) -> None:
    ap = argparse.ArgumentParser(prog="stridelake.jobs")
    ap.add_argument("--format", default="parquet", help="lake table format (parquet, delta, ...)")
    sub = ap.add_subparsers(dest="job", required=True)

    def stream_args(p):
        p.add_argument("--source", default="kafka", choices=["kafka", "landing"])
        p.add_argument("--bootstrap")
        p.add_argument("--landing")
        p.add_argument("--checkpoint")
        p.add_argument("--available-now", action="store_true")

    def jdbc_args(p, required=False):
        p.add_argument("--jdbc-url", required=required)
        p.add_argument("--jdbc-user")
        p.add_argument("--jdbc-password-env")
        p.add_argument("--jdbc-driver")

    p = sub.add_parser("bronze"); stream_args(p)
    p.add_argument("--topic", default="raw.activities"); p.add_argument("--bronze", required=True)
    p.add_argument("--once-within", help="drop records delivered again within this span, e.g. '1 hour'")
    p.add_argument("--keep-unknown", action="store_true", help="keep payload fields outside the schema")

    p = sub.add_parser("silver")
    p.add_argument("--bronze", required=True); p.add_argument("--silver", required=True)
    p.add_argument("--employees-csv", required=True); p.add_argument("--sports-csv", required=True)
    p.add_argument("--checkpoint"); p.add_argument("--available-now", action="store_true")
    p.add_argument("--malformed", help="where records without a usable payload go (default: <silver>_malformed)")
    p.add_argument("--version-log", help="pin the reference versions of each batch here")
    p.add_argument("--current", help="keyed table of the current state, merged batch by batch")
    jdbc_args(p); p.add_argument("--serving-table"); p.add_argument("--staging-table")
    p.add_argument("--serving-versions", action="store_true", help="the serving table holds the order columns")

    p = sub.add_parser("notify"); stream_args(p)
    p.add_argument("--topic", default="raw.activities")
    p.add_argument("--out", required=True); p.add_argument("--malformed", required=True)
    p.add_argument("--employees", required=True); p.add_argument("--employees-format", default="parquet")

    p = sub.add_parser("snapshots"); stream_args(p)
    p.add_argument("--employees-topic", default="raw.employees")
    p.add_argument("--sports-topic", default="raw.employee_sports")
    p.add_argument("--employees-table", required=True); p.add_argument("--sports-table", required=True)
    p.add_argument("--archive-root", required=True); p.add_argument("--current-root", required=True)
    p.add_argument("--debounce-seconds", type=float, default=2.0)
    p.add_argument("--read-ranges", type=int, default=32, help="tasks that read a database table")
    jdbc_args(p)

    p = sub.add_parser("export-bi"); p.add_argument("--silver", required=True); p.add_argument("--out", required=True)
    p = sub.add_parser("backfill"); p.add_argument("--silver", required=True)
    jdbc_args(p, True); p.add_argument("--table", required=True); p.add_argument("--staging-table", required=True)
    p.add_argument("--serving-versions", action="store_true", help="the table holds the order columns")
    p = sub.add_parser("compact-current"); p.add_argument("--silver", required=True); p.add_argument("--out", required=True)
    p.add_argument("--version", type=int, help="publish as <out>/v<version> and register it in <out>/_versions")

    p = sub.add_parser("quality")
    p.add_argument("--activities", required=True); p.add_argument("--employees", required=True)
    p.add_argument("--out", required=True); p.add_argument("--summary-out")
    p = sub.add_parser("commute")
    p.add_argument("--employees", required=True); p.add_argument("--distances", required=True)
    p.add_argument("--out", required=True); p.add_argument("--company-address", default="Head office")
    p.add_argument("--scope", default="all", choices=["all", "requested"])
    p.add_argument("--previous", help="earlier results to update by employee; written to --out, a new directory")
    p = sub.add_parser("benefits")
    p.add_argument("--employees", required=True); p.add_argument("--activities", required=True)
    p.add_argument("--commute", required=True); p.add_argument("--parameters")
    p.add_argument("--as-of", help="default: now"); p.add_argument("--params-as-of"); p.add_argument("--out", required=True)
    p = sub.add_parser("intake")
    p.add_argument("--submitted", required=True); p.add_argument("--employees", required=True)
    p.add_argument("--activities", required=True, help="accepted rows are appended here")
    p.add_argument("--rejected", required=True, help="rejected rows with their reason (appended)")
    p = sub.add_parser("profile")
    p.add_argument("--employees-csv", required=True); p.add_argument("--sports-csv", required=True)
    p.add_argument("--as-of", help="default: now"); p.add_argument("--out", required=True)
    p = sub.add_parser("load-master")
    p.add_argument("--employees-csv", required=True); p.add_argument("--sports-csv", required=True)
    p.add_argument("--employees-table", required=True); p.add_argument("--sports-table", required=True)
    p.add_argument("--out-suffix", required=True, help="new version directory suffix")

    args = ap.parse_args(argv)
    spark = build_session(app_name=f"stridelake-{args.job}")
    fmt = args.format

    if args.job == "bronze":
        start_bronze(_records(spark, args, args.topic, "earliest"), args.bronze, args.checkpoint, fmt,
                     _trigger(args), once_within=args.once_within, keep_unknown=args.keep_unknown).awaitTermination()
    elif args.job == "silver":
        serving = None
        if args.jdbc_url:
            serving = {"url": args.jdbc_url, "table": args.serving_table, "staging": args.staging_table,
                       "props": _jdbc_props(args), "versions": args.serving_versions}
        pinned = PinnedReferences(args.version_log, {"employees": args.employees_csv, "sports": args.sports_csv}) \
            if args.version_log else None
        start_silver(spark, args.bronze, args.silver, args.checkpoint,
                     lambda s, files=args.employees_csv: read_employees_ref(s, files),
                     lambda s, files=args.sports_csv: read_sports_ref(s, files), fmt, _trigger(args), serving,
                     malformed_path=args.malformed or f"{args.silver.rstrip('/')}_malformed", pinned=pinned,
                     current_root=args.current).awaitTermination()
    elif args.job == "notify":
        start_notifications(_records(spark, args, args.topic, "latest"), args.out, args.malformed,
                            args.checkpoint, lambda s: _read(s, args.employees, args.employees_format),
                            fmt, _trigger(args)).awaitTermination()
    elif args.job == "snapshots":
        props = _jdbc_props(args)

        def read_ref(s, cfg):
            if args.jdbc_url:
                return read_jdbc_ranges(s, args.jdbc_url, cfg["table"], cfg["order_by"], args.read_ranges, props)
            return read_table(s, cfg["table"], fmt)

        tables = {
            args.employees_topic: {"table": args.employees_table, "order_by": "employee_id",
                                   "archive_prefix": f"{args.archive_root}/company/employees",
                                   "current_path": f"{args.current_root}/company/employees.csv"},
            args.sports_topic: {"table": args.sports_table, "order_by": "employee_id",
                                "archive_prefix": f"{args.archive_root}/sports/employee_sports",
                                "current_path": f"{args.current_root}/sports/employee_sports.csv"},
        }
        start_reference_snapshots(_records(spark, args, list(tables), "earliest"), tables, args.checkpoint,
                                  args.debounce_seconds, read_ref, _trigger(args),
                                  trailing=not args.available_now).awaitTermination()
    elif args.job == "export-bi":
        L.export_bi_csv(read_table(spark, args.silver, fmt), args.out)
    elif args.job == "backfill":
        n = J.upsert_serving(read_table(spark, args.silver, fmt), args.jdbc_url, args.table, args.staging_table,
                             args.serving_versions, _jdbc_props(args))
        print(f"{n} Silver rows upserted into {args.table}")
    elif args.job == "compact-current":
        if args.version is not None:
            publish_current(spark, args.silver, args.out, args.version, fmt)
        else:
            compact_current(spark, args.silver, args.out, fmt)
    elif args.job == "quality":
        res = Q.dq_results(read_table(spark, args.activities, fmt), read_table(spark, args.employees, fmt))
        L.overwrite_table(res, args.out, fmt)
        if args.summary_out:
            L.overwrite_table(Q.dq_summary(read_table(spark, args.out, fmt)), args.summary_out, fmt)
    elif args.job == "commute":
        cv = C.validate_commutes(read_table(spark, args.employees, fmt), read_table(spark, args.distances, fmt),
                                 company_address=args.company_address,
                                 scope=args.scope)
        if args.previous:   # earlier results stay for employees not validated now
            cv = upsert_table(read_table(spark, args.previous, fmt), cv, "employee_id")
        L.overwrite_table(cv, args.out, fmt)
    elif args.job == "benefits":
        params = (read_table(spark, args.parameters, fmt) if args.parameters
                  else B.default_parameters(spark, args.as_of))
        out = B.benefit_eligibility(read_table(spark, args.employees, fmt), read_table(spark, args.activities, fmt),
                                    read_table(spark, args.commute, fmt), params, args.as_of, args.params_as_of)
        L.overwrite_table(out, args.out, fmt)
    elif args.job == "intake":
        validated = I.validate_intake(read_table(spark, args.submitted, fmt), read_table(spark, args.employees, fmt))
        # Written once to the shared checkpoint folder, then split: the
        # validation plan is evaluated a single time and its lineage is cut.
        work = f"{checkpoint_root(spark).rstrip('/')}/intake/{uuid.uuid4().hex}"
        validated.write.format(fmt).mode("errorifexists").save(work)
        checked = read_table(spark, work, fmt)
        n_ok = L.observed_write(_not_yet(I.accepted(checked), args.activities, fmt), args.activities, fmt, mode="append")
        n_ko = L.observed_write(_not_yet(I.rejected(checked), args.rejected, fmt), args.rejected, fmt, mode="append")
        print(f"{n_ok} activities accepted, {n_ko} rejected")
    elif args.job == "profile":
        emp, spo = load_employees(spark, args.employees_csv), load_sports(spark, args.sports_csv)
        L.overwrite_table(P.profile_summary(emp, spo, args.as_of), f"{args.out}/summary", fmt)
        L.overwrite_table(P.profile_distribution(emp, spo), f"{args.out}/distribution", fmt)
        L.overwrite_table(P.profile_anomalies(read_table(spark, f"{args.out}/summary", fmt)),
                          f"{args.out}/anomalies", fmt)
    elif args.job == "load-master":
        for csv_path, table, loader in ((args.employees_csv, args.employees_table, load_employees),
                                        (args.sports_csv, args.sports_table, load_sports)):
            target = read_table(spark, table, fmt)
            # A repeated id: the line furthest down the file wins. Lines
            # without an id are kept aside, they can never match a row.
            lines = loader(spark, csv_path).withColumn("_line", F.monotonically_increasing_id())
            for c in target.columns:
                if c not in lines.columns:
                    lines = lines.withColumn(c, F.current_timestamp().cast(target.schema[c].dataType)
                                             if c == "ingested_at" else F.lit(None).cast(target.schema[c].dataType))
            lines.where("employee_id is null").drop("_line") \
                .write.format(fmt).mode("errorifexists").save(f"{table}_{args.out_suffix}_rejected")
            merged = upsert_table(target, lines.where("employee_id is not null"), "employee_id", order=["_line"],
                                  preserve=tuple(c for c in ("ingested_at",) if c in target.columns))
            merged.write.format(fmt).mode("errorifexists").save(f"{table}_{args.out_suffix}")
    if stop:
        spark.stop()


if __name__ == "__main__":
    run()
