"""End-to-end batch jobs: the 6-hourly reconciliation and the analytics report.

Each job is one Spark application step.  What several outputs share is computed
once and checkpointed to the cluster's shared checkpoint directory (reliable,
survives executor loss, cuts lineage): the totals of the reconciliation, the
look-back slice of the report, and every table that is only written when it has
rows.  Outputs are header CSV directories named with the run time.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.config import RECONCILIATION_LOOKBACK_HOURS, REPORT_LOOKBACK_HOURS
from tripwire.functions.formatting import format_report
from tripwire.operators import analytics as A
from tripwire.operators import reconcile as R
from tripwire.session import shared_dir
from tripwire.sinks.files import append_reconciliation_row, write_csv_report
from tripwire.sources.scans import as_of_column, as_of_text, fraud_lookback


def _stamp(now: datetime | str) -> str:
    return datetime.fromisoformat(as_of_text(now)).strftime("%Y%m%d_%H%M%S")


def reconciliation_job(spark: SparkSession, validated: DataFrame | None, fraud: DataFrame, reports_dir: str,
                       now: datetime | str, table_path: str | None = None,
                       hours: int = RECONCILIATION_LOOKBACK_HOURS, summed: DataFrame | None = None) -> dict[str, str | None]:
    """Reconciliation CSV, reconciliation table row (one per run, also when the run
    is repeated), fraud-pattern CSV (only when there are patterns).  ``summed``:
    validated totals from increments (``operators.increments``) instead of a scan."""
    stamp = F.lit(as_of_text(now)).cast("timestamp")
    shared_dir(spark)
    totals = R.totals(validated, fraud, as_of=now, hours=hours, summed=summed).checkpoint(eager=True)     # one row
    report = R.report_row(totals, stamp)
    out = {"reconciliation": write_csv_report(report, reports_dir, "reconciliation", _stamp(now))}
    if table_path:
        append_reconciliation_row(R.table_row(totals, stamp), path=table_path, run=_stamp(now))
    patterns = R.fraud_patterns(fraud, hours=hours, as_of=now)
    out["fraud_analysis"] = write_csv_report(patterns, reports_dir, "fraud_analysis", _stamp(now),
                                             skip_empty=True)
    return out


# --- fixed values: report file stems ----------------------------------------
REPORT_TABLES = {
    "fraud_by_category": (A.by_category, "merchant_category"),
    "fraud_by_reason": (A.by_reason, "fraud_reason"),
    "fraud_by_location": (A.by_location, "location"),
    "fraud_by_hour": (A.by_hour, "hour"),
}

CHART_TABLES = {
    "top_categories": A.top_categories,
    "reason_share": A.reason_share,
    "timeline_hourly": A.timeline_hourly,
    "amount_histogram": A.amount_histogram,
    "amount_density": A.amount_density,
}
# --- end of fixed values ----------------------------------------------------


def report_job(spark: SparkSession, fraud: DataFrame, reports_dir: str, now: datetime | str | None = None,
               hours: int = REPORT_LOOKBACK_HOURS) -> dict[str, str | None]:
    """The analytics report: look-back slice checkpointed once, then every
    table written (grouped tables, formatted tables, chart data, summary)."""
    shared_dir(spark)   # the reliable checkpoint directory must be set
    as_of = as_of_column(now, fraud)
    sliced = fraud_lookback(fraud, hours, as_of=as_of, newest_first=False).checkpoint(eager=True)
    stamp = _stamp(now or datetime.now(timezone.utc))
    out: dict[str, str | None] = {}
    for name, (fn, key) in REPORT_TABLES.items():
        table = fn(sliced)
        out[name] = write_csv_report(table, reports_dir, name, stamp, skip_empty=True)
        out[name + "_formatted"] = write_csv_report(format_report(table, key), reports_dir,
                                                    name + "_formatted", stamp, skip_empty=True)
    for name, fn in CHART_TABLES.items():
        out[name] = write_csv_report(fn(sliced), reports_dir, name, stamp, skip_empty=True)
    out["summary"] = write_csv_report(A.summary(sliced), reports_dir, "fraud_summary", stamp, skip_empty=True)
    return out
