"""stridelake: a Spark-native engine for workplace sport-activity analytics.

Change events -> Bronze -> Silver -> current state, benefits, commute
validation, data quality, notifications, intake and profiling, all expressed
with DataFrame/SQL and Structured Streaming.

The most used entry points are re-exported here::

    from stridelake import build_session, decode_cdc, enrich, benefit_eligibility
"""

from .operators.asof import history, in_force
from .operators.benefits import (active_parameters, benefit_eligibility, default_parameters,
                                 employee_activity_12m, seed_parameters)
from .operators.cdc import current_state, decode_cdc, latest_by_key, malformed, only_valid
from .operators.changes import net_changes
from .operators.commute import commute_anomalies, commute_status_counts, prune_orphans, validate_commutes
from .operators.drift import drift_report, unknown_fields
from .operators.intake import accepted, recent_activities, rejected, validate_intake
from .operators.master import clean_employees, clean_sports, effective_sport, upsert_table
from .operators.notify import notifications
from .operators.profile import profile_anomalies, profile_distribution, profile_summary
from .operators.quality import came_or_went, dq_results, dq_summary, refresh_findings
from .operators.rolling import RollingActivity
from .operators.series import eligibility_series
from .operators.silver import as_activities, bi_projection, enrich, serving_projection
from .operators.snapshots import apply_changes, cascade_deletes, diff_snapshots
from .session import build_session, checkpoint_root, cluster_conf
from .sinks.keyed import KeyedTable
from .sinks.lake import export_bi_csv, publish_reference, write_log_partition
from .sources.cdc import read_cdc_stream
from .sources.reference import (PinnedReferences, load_employees, load_sports, read_employees_ref, read_jdbc_ranges,
                                read_sports_ref)
from .sources.tables import ensure_table, read_table, read_table_stream
from .streaming.bronze import start_bronze
from .streaming.notifications import start_notifications
from .streaming.reference_snapshots import start_reference_snapshots
from .streaming.silver import compact_current, publish_current, read_current, start_silver

__version__ = "0.1.0"

__all__ = [
    "accepted", "active_parameters", "apply_changes", "as_activities", "benefit_eligibility",
    "bi_projection", "build_session", "came_or_went", "cascade_deletes", "checkpoint_root",
    "clean_employees", "clean_sports", "cluster_conf", "commute_anomalies", "commute_status_counts",
    "compact_current", "current_state", "decode_cdc", "default_parameters", "diff_snapshots",
    "dq_results", "dq_summary", "drift_report", "effective_sport", "eligibility_series",
    "employee_activity_12m", "enrich", "ensure_table", "export_bi_csv", "history", "in_force",
    "KeyedTable", "latest_by_key", "load_employees", "load_sports", "malformed", "net_changes",
    "notifications", "only_valid", "PinnedReferences", "profile_anomalies", "profile_distribution",
    "profile_summary", "prune_orphans", "publish_current", "publish_reference", "read_cdc_stream",
    "read_current", "read_employees_ref", "read_jdbc_ranges", "read_sports_ref", "read_table",
    "read_table_stream", "recent_activities", "refresh_findings", "rejected", "RollingActivity",
    "seed_parameters", "serving_projection", "start_bronze", "start_notifications",
    "start_reference_snapshots", "start_silver", "unknown_fields", "upsert_table",
    "validate_commutes", "validate_intake", "write_log_partition",
]
