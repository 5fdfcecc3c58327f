"""Batch layer: validated totals, fraud totals, reconciliation, pattern table.

All results are one lazy plan; scalars are one-row DataFrames combined with
``crossJoin`` (a one-row side is a proven-small broadcast), never pulled to the
driver.  The look-back reference time ``as_of`` is a parameter (a Column, a
datetime, or None = latest event time of the input, as a scalar subquery).
"""

from __future__ import annotations

from datetime import datetime

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.config import RECONCILIATION_LOOKBACK_HOURS
from tripwire.functions.money import money_avg, money_sum, money_sum0, pct, round2
from tripwire.schema import TX_COLUMNS
from tripwire.sources.scans import as_of_column, lookback

AsOf = Column | datetime | str | None


def validated_totals(validated: DataFrame) -> DataFrame:
    """``transaction_count`` (rows) and ``total_amount`` (0.0 when empty)."""
    return validated.agg(F.count(F.lit(1)).alias("transaction_count"),
                         money_sum0("amount").alias("total_amount"))


def fraud_totals(fraud: DataFrame, hours: int = RECONCILIATION_LOOKBACK_HOURS,
                 as_of: AsOf = None) -> DataFrame:
    now = as_of_column(as_of, fraud)
    return (lookback(fraud, hours, now)
            .agg(F.count(F.lit(1)).alias("fraud_count"),
                 money_sum0("amount").alias("fraud_amount")))


def _combine(v: DataFrame, f: DataFrame) -> DataFrame:
    both = v.crossJoin(F.broadcast(f))
    total_n = F.col("transaction_count") + F.col("fraud_count")
    total_amt = F.col("total_amount") + F.col("fraud_amount")
    return both.select("*", total_n.alias("_total_n"), total_amt.alias("_total_amt"))


def totals(validated: DataFrame | None, fraud: DataFrame, as_of: AsOf = None,
           hours: int = RECONCILIATION_LOOKBACK_HOURS, summed: DataFrame | None = None) -> DataFrame:
    """One row with the totals that both reconciliation outputs are made of.
    ``summed``: the validated totals where they are known already (then the
    validated rows are not read; ``as_of`` must be given)."""
    now = as_of_column(as_of, validated)
    return _combine(summed if summed is not None else validated_totals(validated), fraud_totals(fraud, hours, now))


def report_row(c: DataFrame, stamp: Column) -> DataFrame:
    """The reconciliation report row (CSV layout, values rounded to 2).  Column
    names and formulas are fixed."""
    return c.select(
        stamp.alias("report_timestamp"),
        F.col("_total_n").alias("total_transactions"),
        F.col("transaction_count").alias("validated_transactions"),
        F.col("fraud_count").alias("fraud_transactions"),
        round2(pct(F.col("fraud_count"), F.col("_total_n"))).alias("fraud_percentage"),
        round2(F.col("total_amount")).alias("total_amount"),
        round2(F.col("fraud_amount")).alias("fraud_amount"),
        round2(pct(F.col("fraud_amount"), F.col("_total_amt"))).alias("fraud_amount_percentage"),
    )


def table_row(c: DataFrame, stamp: Column) -> DataFrame:
    """The row of the reconciliation table (unrounded; ``total_amount`` =
    validated + fraud amount)."""
    return c.select(
        stamp.alias("report_date"),
        F.col("_total_n").alias("total_transactions"),
        F.col("_total_amt").alias("total_amount"),
        F.col("fraud_count"),
        F.col("fraud_amount"),
    )


def _stamp(report_time: Column | None) -> Column:
    return report_time if report_time is not None else F.current_timestamp()


def reconciliation(validated: DataFrame, fraud: DataFrame, as_of: AsOf = None,
                   hours: int = RECONCILIATION_LOOKBACK_HOURS,
                   report_time: Column | None = None) -> DataFrame:
    """Faithful to the original formulas: validated rows cover all time, fraud
    rows the look-back; ``total_amount`` is the validated amount only."""
    return report_row(totals(validated, fraud, as_of, hours), _stamp(report_time))


def recon_table_row(validated: DataFrame, fraud: DataFrame, as_of: AsOf = None,
                    hours: int = RECONCILIATION_LOOKBACK_HOURS,
                    report_time: Column | None = None) -> DataFrame:
    return table_row(totals(validated, fraud, as_of, hours), _stamp(report_time))


def reconciliation_consistent(tx: DataFrame, fraud: DataFrame, as_of: AsOf = None,
                              hours: int = RECONCILIATION_LOOKBACK_HOURS,
                              report_time: Column | None = None) -> DataFrame:
    """Reconciliation without double counting: one look-back for both sides,
    fraud counted once per flagged event, validated = transactions no detector
    flagged.  Then ``total_transactions`` equals the transactions in range."""
    from tripwire.operators.detect import validated_anti

    now = as_of_column(as_of, tx)
    tx_in = lookback(tx.select(*TX_COLUMNS), hours, now)
    fraud_events = lookback(fraud.select(*TX_COLUMNS), hours, now).distinct()
    clean = validated_anti(tx_in, fraud_events)
    v = validated_totals(clean)
    f = fraud_events.agg(F.count(F.lit(1)).alias("fraud_count"),
                         money_sum0("amount").alias("fraud_amount"))
    return report_row(_combine(v, f), _stamp(report_time))


def fraud_patterns(fraud: DataFrame, hours: int = RECONCILIATION_LOOKBACK_HOURS,
                   as_of: AsOf = None) -> DataFrame:
    """Fraud by (merchant_category, fraud_reason) in the look-back, most
    frequent first (SQL GROUP BY: a NULL key would form its own group)."""
    now = as_of_column(as_of, fraud)
    return (lookback(fraud, hours, now)
            .groupBy("merchant_category", "fraud_reason")
            .agg(F.count(F.lit(1)).alias("fraud_count"),
                 money_sum("amount").alias("total_fraud_amount"),
                 money_avg("amount").alias("avg_fraud_amount"))
            .select("merchant_category", "fraud_count", "total_fraud_amount",
                    "avg_fraud_amount", "fraud_reason")
            .orderBy(F.col("fraud_count").desc(), "merchant_category", "fraud_reason"))
