"""Batch query registry: ``name -> (spark, sf_dir) -> DataFrame``.

Every plan reads the whole ``events`` table through the transaction view, so
its work grows with the data.  ``as_of`` (the report's "now") is the latest
event time, evaluated on the cluster as a scalar subquery.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.config import REASON_HIGH_VALUE, REASON_TRAVEL, RECONCILIATION_LOOKBACK_HOURS, WINDOW_MINUTES
from tripwire.functions.formatting import format_report
from tripwire.operators import analytics as A
from tripwire.operators import detect as D
from tripwire.operators import quality as Q
from tripwire.operators import reconcile as R
from tripwire.operators import sketches as S
from tripwire.schema import TX_COLUMNS
from tripwire.sources import event_time_parse, fraud_lookback, json_decode, json_encode, load_transactions
from tripwire.sources.scans import as_of_column, lookback_input

REPORT_HOURS = 168          # look-back of the report keys (6 h / 24 h hold too few rows)

Query = Callable[[SparkSession, str], DataFrame]


def _tx(spark: SparkSession, d: str) -> DataFrame:
    return load_transactions(spark, d)


def _fraud(tx: DataFrame) -> DataFrame:
    """The fraud table: both detectors, one row per (event, reason, flagged
    window) — computed in one pass (``detect_all``)."""
    return D.detect_all(tx)


def _as_of(tx: DataFrame):
    return as_of_column(None, tx)


def _recent_fraud(tx: DataFrame, hours: int, now) -> DataFrame:
    """Fraud rows that a look-back can hold: detection on the transactions that
    decide about them (events of the look-back, and a window before)."""
    return _fraud(lookback_input(tx, hours, now, WINDOW_MINUTES - 1))


def _report_input(spark: SparkSession, d: str, newest_first: bool = False) -> DataFrame:
    tx = _tx(spark, d)
    now = _as_of(tx)
    return fraud_lookback(_recent_fraud(tx, REPORT_HOURS, now), REPORT_HOURS, as_of=now, newest_first=newest_first)


def flagship(spark: SparkSession, d: str) -> DataFrame:
    """Detect both fraud kinds, then the by-category report table."""
    return A.by_category(_fraud(_tx(spark, d)))


def _report(fn) -> Query:
    return lambda spark, d: fn(_report_input(spark, d))


def _fraud_q(fn) -> Query:
    return lambda spark, d: fn(_fraud(_tx(spark, d)))


def _recon(fn) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        tx = _tx(spark, d)
        now = _as_of(tx)
        return fn(tx, _recent_fraud(tx, RECONCILIATION_LOOKBACK_HOURS, now), as_of=now, report_time=now)
    return run


def _rounded(df: DataFrame, places: int, *names: str) -> DataFrame:
    """Unrounded sums and averages cut to what any order of addition agrees on."""
    return df.select(*[F.round(c, places).alias(c) if c in names else F.col(c) for c in df.columns])


def _digits(df: DataFrame, *names: str) -> DataFrame:
    """Nine significant digits."""
    return df.select(*[F.format_string("%.8e", c).cast("double").alias(c) if c in names else F.col(c) for c in df.columns])


def _payload_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return json_decode(json_encode(_tx(spark, d), as_binary=True))


def _parsed_roundtrip(spark: SparkSession, d: str) -> DataFrame:
    return event_time_parse(_payload_roundtrip(spark, d))


def _recent(reason: str | None, order: str, cols: list[str]) -> Query:
    def run(spark: SparkSession, d: str) -> DataFrame:
        f = _fraud(_tx(spark, d))
        if reason is not None:
            f = f.filter(F.col("fraud_reason") == reason)
        rest = [F.col(c) for c in f.columns if c != order]
        return f.orderBy(F.col(order).desc(), *rest).limit(10).select(*cols)
    return run


def _validated_tree(spark: SparkSession, d: str) -> DataFrame:
    """Validated records stored as a plain nested directory tree (one
    sub-directory per event date), read back recursively."""
    from tripwire.session import fresh_path
    from tripwire.sources import validated_scan

    root = fresh_path(spark, "validated-tree")
    tx = _tx(spark, d)
    # rows of a date together: few files per directory, large dates split
    (tx.withColumn("event_date", F.to_date("timestamp")).hint("rebalance", "event_date")
     .write.partitionBy("event_date").parquet(root))
    return validated_scan(spark, root, written_by_stream=False)


def _fraud_totals(spark: SparkSession, d: str) -> DataFrame:
    tx = _tx(spark, d)
    now = _as_of(tx)
    return _rounded(R.fraud_totals(_recent_fraud(tx, RECONCILIATION_LOOKBACK_HOURS, now), as_of=now), 4, "fraud_amount")


def _fraud_patterns(spark: SparkSession, d: str) -> DataFrame:
    tx = _tx(spark, d)
    now = _as_of(tx)
    return _rounded(R.fraud_patterns(_recent_fraud(tx, RECONCILIATION_LOOKBACK_HOURS, now), as_of=now), 4,
                    "total_fraud_amount", "avg_fraud_amount")


def _constraints(spark: SparkSession, d: str) -> DataFrame:
    checked = Q.constraint_violations(_fraud(_tx(spark, d)))
    return checked.select("*", F.array_join("violations", ";").alias("violation_list")).drop("violations")


def _merged_summary(spark: SparkSession, d: str) -> DataFrame:
    """Headline numbers from the stored sketches of every date, beside whether the
    sketched ones keep their bounds against the exact ones."""
    from tripwire.session import fresh_path

    root = fresh_path(spark, "sketches")
    fraud = S.dated(_fraud(_tx(spark, d))).persist()
    try:
        S.store_sketches(fraud, root)
        users = fraud.agg(F.countDistinct("user_id")).first()[0]
    finally:
        fraud.unpersist()
    merged = S.merged_summary(spark, root)
    near = F.abs(F.col("unique_users_affected") - users) <= F.lit(users * 3 * S.USERS_ERROR + 1)
    return _rounded(merged, 2, "total_fraud_amount", "average_fraud_amount").select(
        "total_fraud_transactions", "total_fraud_amount", "average_fraud_amount", "max_fraud_amount",
        "most_common_category", "most_common_reason", near.alias("users_within_bound"))


def batch_queries() -> dict[str, Query]:
    all_cols = TX_COLUMNS + ["fraud_reason"]
    return {
        # sources / payload
        "json_encode": lambda s, d: json_encode(_tx(s, d)).select("value"),
        "json_decode": _payload_roundtrip,
        "event_time_parse": _parsed_roundtrip,
        "validated_scan": _validated_tree,
        # detectors
        "high_value": lambda s, d: D.high_value(_tx(s, d)),
        "window_location_count": lambda s, d: D.window_location_count(_tx(s, d)),
        "impossible_windows": lambda s, d: D.impossible_windows(_tx(s, d)),
        "impossible_travel": lambda s, d: D.impossible_travel(_tx(s, d)),
        "impossible_travel_exact": lambda s, d: D.impossible_travel_exact(_tx(s, d)),
        "fraud_union": lambda s, d: D.fraud_union(D.high_value(_tx(s, d)), D.impossible_travel(_tx(s, d))),
        "detect_all": lambda s, d: _fraud(_tx(s, d)),
        "fraud_distinct": _fraud_q(D.fraud_distinct),
        "validated_anti": lambda s, d: D.validated_events(_tx(s, d)),
        "constraint_violations": _constraints,
        # batch layer
        "validated_totals": lambda s, d: _rounded(R.validated_totals(_tx(s, d)), 4, "total_amount"),
        "fraud_totals": _fraud_totals,
        "fraud_patterns": _fraud_patterns,
        "reconciliation": _recon(R.reconciliation),
        "recon_table_row": lambda s, d: _rounded(_recon(R.recon_table_row)(s, d), 4, "total_amount", "fraud_amount"),
        "reconciliation_consistent": _recon(R.reconciliation_consistent),
        # report layer
        "fraud_lookback": lambda s, d: _report_input(s, d, newest_first=True),
        "by_category": _report(A.by_category),
        "by_reason": _report(A.by_reason),
        "by_location": _report(A.by_location),
        "by_hour": _report(A.by_hour),
        "summary": _report(A.summary),
        "top_categories": _report(A.top_categories),
        "reason_share": _report(A.reason_share),
        "timeline_hourly": _report(A.timeline_hourly),
        "amount_histogram": _report(A.amount_histogram),
        "amount_density": _report(lambda f: _digits(A.amount_density(f), "amount", "density", "expected_count")),
        "amount_density_binned": _report(
            lambda f: _digits(A.amount_density_binned(f), "amount", "density", "expected_count")),
        "summary_merged": _merged_summary,
        "format_report": _report(lambda f: format_report(A.by_category(f), "merchant_category")),
        # ad-hoc queries on the fraud table
        "adhoc_fraud_count": _fraud_q(lambda f: f.agg(F.count(F.lit(1)).alias("fraud_count"))),
        "adhoc_count_by_reason": _fraud_q(
            lambda f: f.groupBy("fraud_reason").agg(F.count(F.lit(1)).alias("fraud_count"))),
        "adhoc_recent": _recent(None, "timestamp",
                                ["user_id", "timestamp", "amount", "location", "fraud_reason"]),
        "adhoc_high_value_top": _recent(REASON_HIGH_VALUE, "amount", all_cols),
        "adhoc_travel_recent": _recent(REASON_TRAVEL, "timestamp", all_cols),
    }
