"""Named queries over the driver tables: ``name -> (spark, sf_dir) -> DataFrame``.

Each query derives the domain tables with ``sources.adapter`` and runs the
engine's operators on them, over the whole tables. Timestamp outputs are
returned as ``TIMESTAMP_NTZ`` (UTC wall clock), the type DuckDB's
``TIMESTAMP`` has, so results compare column for column.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql.types import TimestampType

from .. import schemas as S
from ..functions.csv import read_csv_text
from ..functions.literal import literal_table
from ..operators import benefits as B
from ..operators import cdc as CDC
from ..operators import commute as C
from ..operators import intake as I
from ..operators import master as M
from ..operators import notify as N
from ..operators import profile as P
from ..operators import asof as AO
from ..operators import drift as D
from ..operators import quality as Q
from ..operators import series as SE
from ..operators import silver as SV
from ..operators import snapshots as SN
from ..operators.rolling import RollingActivity
from ..session import checkpoint_root
from ..sinks import lake as L
from ..sinks.keyed import KeyedTable
from ..sources import adapter as A
from ..sources.cdc import read_cdc_stream, write_landing
from ..sources.reference import read_employees_ref
from ..streaming.bronze import start_bronze
from ..streaming.notifications import start_notifications
from ..streaming.silver import start_silver

Query = Callable[[SparkSession, str], DataFrame]
REGISTRY: dict[str, Query] = {}


def query(name: str):
    def wrap(fn: Query) -> Query:
        REGISTRY[name] = fn
        return fn
    return wrap


def as_ntz(df: DataFrame) -> DataFrame:
    """Instants -> UTC wall-clock timestamps (session time zone is UTC)."""
    return df.select(*[
        F.col(f.name).cast("timestamp_ntz").alias(f.name) if isinstance(f.dataType, TimestampType)
        else F.col(f.name)
        for f in df.schema.fields
    ])


# --- shared inputs -----------------------------------------------------------

def _commute(spark: SparkSession, sf: str, scope: str = "all") -> DataFrame:
    return C.validate_commutes(A.employees(spark, sf), A.commute_distances(spark, sf),
                               as_of=A.AS_OF, company_address=A.COMPANY_ADDRESS, scope=scope)


def _params(spark: SparkSession) -> DataFrame:
    """Stored versions (closed ones, one name open twice, one closed only),
    completed with the defaults of names without an open version."""
    stored = literal_table(
        spark, [("bonus_rate", "0.04", "2020-01-01", "2023-12-31"), ("bonus_rate", "0.05", "2024-01-01", None),
                ("wellness_days", "4", "2022-01-01", None), ("wellness_days", "5", "2024-01-01", None),
                ("min_annual_activities", "20", "2021-01-01", "2023-12-31")],
        [("parameter_name", "string"), ("parameter_value", "string"), ("valid_from", "string"), ("valid_to", "string")])
    stored = stored.select("parameter_name", F.col("parameter_value").cast(S.PARAM).alias("parameter_value"),
                           F.col("valid_from").cast("date").alias("valid_from"), F.col("valid_to").cast("date").alias("valid_to"))
    return B.seed_parameters(stored, B.default_parameters(spark, A.AS_OF))


# --- benefits ---------------------------------------------------------------

@query("benefit_eligibility")
def benefit_eligibility(spark: SparkSession, sf: str) -> DataFrame:
    """Flagship. The stored validation has the employees with a routing answer;
    the bonus of the others is undecided (NULL)."""
    return B.benefit_eligibility(A.employees(spark, sf), A.activities(spark, sf),
                                 _commute(spark, sf, "requested"), _params(spark), as_of=A.AS_OF)


@query("employee_activity_12m")
def employee_activity_12m(spark: SparkSession, sf: str) -> DataFrame:
    return B.employee_activity_12m(A.employees(spark, sf), A.activities(spark, sf), A.AS_OF)


# --- commute ----------------------------------------------------------------

@query("commute_validation")
def commute_validation(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(_commute(spark, sf))


@query("commute_anomalies")
def commute_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(C.commute_anomalies(_commute(spark, sf), A.employees(spark, sf)))


@query("commute_status_counts")
def commute_status_counts(spark: SparkSession, sf: str) -> DataFrame:
    return C.commute_status_counts(_commute(spark, sf))


@query("orphan_pruned_commute")
def orphan_pruned_commute(spark: SparkSession, sf: str) -> DataFrame:
    """JN-12: of a validation of current and former staff, the rows of those
    who are still in the employee table."""
    staff = ["employee_id", "home_address", "commute_mode"]
    everyone = A.employees(spark, sf).select(*staff).unionByName(A.former_employees(spark, sf).select(*staff))
    cv = C.validate_commutes(everyone, A.commute_distances(spark, sf), as_of=A.AS_OF,
                             company_address=A.COMPANY_ADDRESS, scope="all")
    return as_ntz(C.prune_orphans(cv, A.employees(spark, sf)))


@query("commute_validation_requested")
def commute_validation_requested(spark: SparkSession, sf: str) -> DataFrame:
    """CM-2 for the employees that have a routing answer only."""
    return as_ntz(_commute(spark, sf, "requested"))


# --- data quality -----------------------------------------------------------

def _dq(spark: SparkSession, sf: str) -> DataFrame:
    return Q.dq_results(A.activities(spark, sf), A.employees(spark, sf), as_of=A.DQ_AS_OF)


@query("dq_results")
def dq_results(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(_dq(spark, sf))


@query("dq_summary")
def dq_summary(spark: SparkSession, sf: str) -> DataFrame:
    return Q.dq_summary(_dq(spark, sf))


# --- change capture, Bronze, Silver -----------------------------------------

def _bronze(spark: SparkSession, sf: str) -> DataFrame:
    return CDC.decode_cdc(A.cdc_messages(spark, sf), ingested_at=A.AS_OF)


def _silver(spark: SparkSession, sf: str) -> DataFrame:
    return SV.enrich(CDC.only_valid(_bronze(spark, sf)), A.employees(spark, sf),
                     A.employee_sports(spark, sf), ingested_at=A.AS_OF)


@query("cdc_decode")
def cdc_decode(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(_bronze(spark, sf))


@query("cdc_malformed")
def cdc_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """PR-4 side output: change records with no usable payload, with their
    broker coordinates (what the Silver and notification streams divert)."""
    return as_ntz(CDC.malformed(_bronze(spark, sf))
                  .select("kafka_partition", "kafka_offset", "kafka_timestamp", "bronze_ingested_at"))


@query("silver_enriched")
def silver_enriched(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(_silver(spark, sf))


@query("serving_projection")
def serving_projection(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(SV.serving_projection(_silver(spark, sf)))


@query("bi_projection")
def bi_projection(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(SV.bi_projection(_silver(spark, sf)))


@query("silver_current")
def silver_current(spark: SparkSession, sf: str) -> DataFrame:
    """Current serving rows. With one reference version for the whole run,
    picking the newest change per key first and enriching only the
    survivors equals enriching every version then picking; it keeps the
    per-key aggregation on the narrow Bronze rows and the joins on the
    smaller current set."""
    latest = CDC.current_state(CDC.only_valid(_bronze(spark, sf)))
    return as_ntz(SV.serving_projection(
        SV.enrich(latest, A.employees(spark, sf), A.employee_sports(spark, sf), ingested_at=A.AS_OF)))


# --- intake -------------------------------------------------------------------

def _intake(spark: SparkSession, sf: str) -> DataFrame:
    return I.validate_intake(A.activities(spark, sf), A.employees(spark, sf))


@query("intake_accepted")
def intake_accepted(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(I.accepted(_intake(spark, sf), created_at=A.AS_OF))


@query("intake_rejected")
def intake_rejected(spark: SparkSession, sf: str) -> DataFrame:
    return I.rejected(_intake(spark, sf))


@query("recent_activities")
def recent_activities(spark: SparkSession, sf: str) -> DataFrame:
    return as_ntz(I.recent_activities(A.activities(spark, sf), limit=10))


# --- notifications ----------------------------------------------------------

@query("live_notifications")
def live_notifications(spark: SparkSession, sf: str) -> DataFrame:
    return N.notifications(_bronze(spark, sf), A.employees(spark, sf))


# --- master data --------------------------------------------------------------

@query("effective_sport")
def effective_sport(spark: SparkSession, sf: str) -> DataFrame:
    return M.effective_sport(A.employees(spark, sf), A.employee_sports(spark, sf))


@query("master_clean")
def master_clean(spark: SparkSession, sf: str) -> DataFrame:
    return M.clean_employees(A.master_csv_rows(spark, sf))


@query("master_clean_sports")
def master_clean_sports(spark: SparkSession, sf: str) -> DataFrame:
    return M.clean_sports(A.sports_csv_rows(spark, sf))


@query("master_upsert")
def master_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-8/9: untouched, updated, inserted and repeated keys; the first load's
    stamp stays."""
    return M.upsert_table(A.master_target(spark, sf), A.master_changes(spark, sf), "employee_id",
                          order=["line"], preserve=("ingested_at",))


# --- profiling ----------------------------------------------------------------

def _profile(spark: SparkSession, sf: str) -> DataFrame:
    return P.profile_summary(A.employees(spark, sf), A.employee_sports(spark, sf), A.AS_OF)


@query("profile_summary")
def profile_summary(spark: SparkSession, sf: str) -> DataFrame:
    return _profile(spark, sf)


@query("profile_distribution")
def profile_distribution(spark: SparkSession, sf: str) -> DataFrame:
    return P.profile_distribution(A.employees(spark, sf), A.employee_sports(spark, sf))


@query("profile_anomalies")
def profile_anomalies(spark: SparkSession, sf: str) -> DataFrame:
    return P.profile_anomalies(_profile(spark, sf))


# --- step by step ---------------------------------------------------------------
# Queries that apply the change log in three batches to tables in the shared
# checkpoint folder, as the streams do, and give the state after the last one.

#: Clocks of the three steps: the start of a day for the rolling window, and the
#: instant the findings are judged at.
STEP_DAYS = ("2025-01-10", "2025-01-20", "2025-01-24")
STEP_CLOCKS = ("2024-01-25 00:00:00", "2024-01-27 12:00:00", A.DQ_AS_OF)


def _work(spark: SparkSession) -> str:
    return f"{checkpoint_root(spark).rstrip('/')}/queries/{uuid.uuid4().hex}"


def _batches(spark: SparkSession, sf: str, root: str):
    """The keyed table that takes the batches, and the batches."""
    log = A.change_batches(spark, sf)
    batches = [log.where(F.col("batch") == number).drop("batch") for number in range(len(STEP_DAYS))]
    return KeyedTable(spark, f"{root}/current", batches[0].schema), batches


@query("lake_upsert")
def lake_upsert(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4: current rows after three partition-wise upserts, with the version
    that wrote their date's partition."""
    table, batches = _batches(spark, sf, _work(spark))
    for batch in batches:
        table.upsert(batch)
    return as_ntz(table.read(written=True).select(
        "activity_id", "employee_id", "activity_date", "start_at", "sport_type", "distance_m", "kafka_offset", "version"))


@query("activity_12m_incremental")
def activity_12m_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """AG-1 kept by retractions over three batches and three days."""
    root = _work(spark)
    rolling = RollingActivity(spark, f"{root}/rolling")
    table, batches = _batches(spark, sf, root)
    for number, batch in enumerate(batches):
        rolling.apply(table.changes(batch), number, STEP_DAYS[number])
        table.upsert(batch)
    return rolling.view(A.employees(spark, sf))


@query("dq_incremental")
def dq_incremental(spark: SparkSession, sf: str) -> DataFrame:
    """DQ-1..8 kept by two-sided deltas while activities, employees and the
    clock move on."""
    root = _work(spark)
    findings = None
    table, batches = _batches(spark, sf, root)
    for number, batch in enumerate(batches):
        changed = table.changes(batch).select("activity_id")    # against the version before
        table.upsert(batch)
        now, clock = A.employee_versions(spark, sf, number), STEP_CLOCKS[number]
        if findings is None:
            found = Q.dq_results(table.read(), now, as_of=clock)
        else:
            moved = Q.came_or_went(A.employee_versions(spark, sf, number - 1), now)
            found = Q.refresh_findings(findings, table.read(), now, changed, moved, STEP_CLOCKS[number - 1], clock)
        found.write.parquet(f"{root}/findings/{number}")
        findings = spark.read.parquet(f"{root}/findings/{number}")
    return findings.drop("detected_at")


# --- versions, dates, snapshots, drift --------------------------------------------

#: 24 month-ends.
SERIES = tuple(str(d) for d in (
    "2023-02-28 2023-03-31 2023-04-30 2023-05-31 2023-06-30 2023-07-31 2023-08-31 2023-09-30 2023-10-31 2023-11-30 "
    "2023-12-31 2024-01-31 2024-02-29 2024-03-31 2024-04-30 2024-05-31 2024-06-30 2024-07-31 2024-08-31 2024-09-30 "
    "2024-10-31 2024-11-30 2024-12-31 2025-01-20").split())


@query("silver_as_of")
def silver_as_of(spark: SparkSession, sf: str) -> DataFrame:
    """JN-1 with the reference version in force when the change happened."""
    changes = A.cdc_log(spark, sf).select("activity_id", "employee_id", "__op", "kafka_offset",
                                          F.timestamp_millis("__source_ts_ms").alias("changed_at"))
    versions = AO.history(A.employee_snapshots(spark, sf), "employee_id")
    return as_ntz(AO.in_force(changes, versions, "employee_id", "changed_at").drop("reference_from"))


@query("eligibility_series")
def eligibility_series(spark: SparkSession, sf: str) -> DataFrame:
    """AG-4 at 24 dates, with the parameters valid at each, in one pass."""
    return SE.eligibility_series(A.employees(spark, sf), A.activities(spark, sf), _commute(spark, sf, "requested"),
                                 _params(spark), list(SERIES))


@query("snapshot_changes")
def snapshot_changes(spark: SparkSession, sf: str) -> DataFrame:
    """Change records between two staff tables, and the deletions that follow
    from them in commute results and activities."""
    before = A.staff_before(spark, sf)
    changes = SN.diff_snapshots(before, A.employees(spark, sf).select(*before.columns), "employee_id")
    commute = C.validate_commutes(before, A.commute_distances(spark, sf), as_of=A.AS_OF,
                                  company_address=A.COMPANY_ADDRESS, scope="all")

    def shaped(df: DataFrame, entity: str, key: str, detail: str) -> DataFrame:
        return df.select(F.lit(entity).alias("entity"), "__op", F.col(key).alias("id"), "employee_id", F.col(detail).alias("detail"))

    return (shaped(changes, "employee", "employee_id", "commute_mode")
            .unionByName(shaped(SN.cascade_deletes(changes, commute, "employee_id"), "commute", "employee_id", "validation_status"))
            .unionByName(shaped(SN.cascade_deletes(changes, A.activities(spark, sf), "employee_id"), "activity", "activity_id", "sport_type")))


def _extended(spark: SparkSession, sf: str) -> DataFrame:
    return CDC.decode_cdc(A.cdc_messages_extended(spark, sf), ingested_at=A.AS_OF, keep_unknown=True)


@query("cdc_unknown_fields")
def cdc_unknown_fields(spark: SparkSession, sf: str) -> DataFrame:
    """Bronze rows of a producer that has added fields: typed columns as
    before, the rest beside them."""
    return _extended(spark, sf).select("kafka_partition", "kafka_offset", "activity_id", "distance_m", "unknown_fields")


@query("cdc_drift")
def cdc_drift(spark: SparkSession, sf: str) -> DataFrame:
    """Paths and types that the declared schema does not know."""
    return D.drift_report(_extended(spark, sf))


# --- as streams and files -----------------------------------------------------------
# The same records through the streams (broker records landed as files, bounded
# runs) and through the file sinks, in a folder of the shared checkpoint folder.

def _landed(spark: SparkSession, sf: str, root: str) -> DataFrame:
    write_landing(A.cdc_messages(spark, sf), f"{root}/landing")
    return read_cdc_stream(spark, "raw.activities", source="landing", landing_path=f"{root}/landing")


def _streamed(spark: SparkSession, sf: str) -> str:
    """Bronze, then Silver with malformed records aside and a keyed current table."""
    root = _work(spark)
    until_done = {"availableNow": True}
    start_bronze(_landed(spark, sf, root), f"{root}/bronze", f"{root}/checkpoints/bronze", trigger=until_done).awaitTermination()
    start_silver(spark, f"{root}/bronze", f"{root}/silver", f"{root}/checkpoints/silver",
                 lambda s: A.employees(s, sf), lambda s: A.employee_sports(s, sf), trigger=until_done,
                 malformed_path=f"{root}/malformed", current_root=f"{root}/current").awaitTermination()
    return root


@query("streamed_silver")
def streamed_silver(spark: SparkSession, sf: str) -> DataFrame:
    """ST-1..ST-3, SNK-1, SNK-2: the Silver log that the streams write."""
    rows = spark.read.parquet(f"{_streamed(spark, sf)}/silver")
    return as_ntz(rows.drop("batch_id", "bronze_ingested_at", "silver_ingested_at"))


@query("streamed_malformed")
def streamed_malformed(spark: SparkSession, sf: str) -> DataFrame:
    """PR-4: the records without a payload that the Silver stream puts aside."""
    rows = spark.read.parquet(f"{_streamed(spark, sf)}/malformed")
    return as_ntz(rows.select("kafka_partition", "kafka_offset", "kafka_timestamp"))


@query("streamed_current")
def streamed_current(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-4, ST-5: the keyed table that the Silver stream keeps current."""
    root = _streamed(spark, sf)
    schema = spark.read.parquet(f"{root}/silver").drop("batch_id").schema
    rows = KeyedTable(spark, f"{root}/current", schema).read()
    return as_ntz(SV.serving_projection(rows).drop("silver_ingested_at"))


@query("streamed_notifications")
def streamed_notifications(spark: SparkSession, sf: str) -> DataFrame:
    """ST-9, SNK-12: the notifications that the stream writes."""
    root = _work(spark)
    start_notifications(_landed(spark, sf, root), f"{root}/out", f"{root}/malformed", f"{root}/checkpoint",
                        lambda s: A.employees(s, sf), trigger={"availableNow": True}).awaitTermination()
    return spark.read.parquet(f"{root}/out").drop("batch_id")


@query("silver_log_counts")
def silver_log_counts(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-2, AG-6: rows that each of three batches wrote into its partition of
    the log, the second one written twice."""
    root, log = _work(spark), A.change_batches(spark, sf)
    counted = [(n, L.write_log_partition(log.where(F.col("batch") == n).drop("batch"), f"{root}/log", n)) for n in (0, 1, 1, 2)]
    stored = spark.read.parquet(f"{root}/log").groupBy("batch_id").agg(F.count(F.lit(1)).alias("stored"))
    reported = literal_table(spark, sorted(set(counted)), [("batch_id", "bigint"), ("reported", "bigint")])
    return stored.select(F.col("batch_id").cast("long").alias("batch_id"), "stored").join(reported, "batch_id")


@query("bi_export")
def bi_export(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-6, SO-1: the sorted CSV export read again, text cell by text cell.
    ``in_order``: the rows' order in the files is that of the keys."""
    root = _work(spark)
    L.export_bi_csv(_silver(spark, sf), f"{root}/bi")
    cells = read_csv_text(spark, f"{root}/bi")
    cells = cells.select("*", F.col("_metadata.file_name").alias("file"), F.col("activity_id").cast("long").alias("id"))
    # Parts are in key order: one row for each file.
    spans = cells.groupBy("file").agg(F.min("id").alias("low"), F.max("id").alias("high"))
    before = F.lag("high").over(Window.orderBy("file"))
    broken = spans.select((F.col("low") < before).alias("back")).agg(F.count_if("back").alias("n")).select("n").scalar()
    return cells.select("id", "activity_id", "employee_id", "last_name", "sport_type", "declared_sport", "activity_date",
                        "distance_km", "source", (broken == 0).alias("in_order"))


@query("published_reference")
def published_reference(spark: SparkSession, sf: str) -> DataFrame:
    """SNK-7, SC-24, SO-2, SRC-4: the employee reference published twice; the
    Silver stream's reader sees the second version."""
    root = _work(spark)
    for day, rows in ((1, A.staff_before(spark, sf)), (2, A.employees(spark, sf))):
        stamp = L.snapshot_stamp(dt.datetime(2024, 1, day, tzinfo=dt.timezone.utc))
        L.publish_reference(rows, f"{root}/archive/employees", f"{root}/employees", stamp, order_by="employee_id")
    return read_employees_ref(spark, f"{root}/employees")
