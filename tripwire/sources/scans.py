"""Batch scans of the two sink outputs."""

from __future__ import annotations

from datetime import datetime, timedelta, timezone

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.schema import FRAUD_COLUMNS, TRANSACTION


def validated_scan(spark: SparkSession, path: str, written_by_stream: bool = True) -> DataFrame:
    """All validated records below ``path``.

    A directory written by a streaming file sink is read through its commit
    log (only committed files count).  A plain directory tree is read
    recursively.  The explicit schema makes an empty or missing tree a
    zero-row frame instead of an error.
    """
    reader = spark.read.schema(TRANSACTION)
    if not written_by_stream:
        reader = reader.option("recursiveFileLookup", "true")
    try:
        return reader.parquet(path)
    except Exception as exc:  # noqa: BLE001 - only a missing path is tolerated
        if "PATH_NOT_FOUND" not in str(exc) and "Path does not exist" not in str(exc):
            raise
        return spark.createDataFrame([], TRANSACTION)


def as_of_column(as_of: Column | datetime | str | None, reference: DataFrame,
                 ts_col: str = "timestamp") -> Column:
    """The report's "now".  A fixed value when given; else the latest event time
    of ``reference`` as a scalar subquery (evaluated once on the cluster)."""
    if isinstance(as_of, Column):
        return as_of
    if as_of is None:
        return reference.select(F.max(ts_col)).scalar()
    return F.lit(as_of_text(as_of)).cast("timestamp")


def as_of_text(as_of: datetime | str) -> str:
    """ISO text in UTC, the session's zone.  A ``datetime`` literal without a
    zone would be read in the zone of the Python process."""
    if isinstance(as_of, str):
        return as_of
    if as_of.tzinfo is not None:
        as_of = as_of.astimezone(timezone.utc).replace(tzinfo=None)
    return as_of.isoformat(sep=" ")


def lookback(df: DataFrame, hours: int, as_of: Column, ts_col: str = "timestamp") -> DataFrame:
    """``ts >= as_of - hours``: inclusive lower bound, no upper bound.  A stored
    fraud table is also cut by its partition column, so older date directories
    are not opened."""
    since = as_of - F.make_interval(hours=F.lit(hours))
    if "event_date" in df.columns:
        df = df.filter(F.col("event_date") >= F.to_date(since))
    return df.filter(F.col(ts_col) >= since)


def lookback_input(tx: DataFrame, hours: int, as_of: Column, margin_minutes: int) -> DataFrame:
    """The transactions that can decide about events of the look-back: the flags
    of a minute depend on at most ``margin_minutes`` before it."""
    since = as_of - F.make_interval(hours=F.lit(hours))
    return tx.filter(F.col("timestamp") >= F.date_trunc("minute", since) - F.make_interval(mins=F.lit(margin_minutes)))


def fraud_lookback(fraud: DataFrame, hours: int = 24, as_of: Column | datetime | None = None,
                   reference: DataFrame | None = None, newest_first: bool = True) -> DataFrame:
    """Fraud rows of the last ``hours`` hours before ``as_of``; newest first
    unless the rows only feed aggregates."""
    now = as_of_column(as_of, reference if reference is not None else fraud)
    cols = [c for c in [*FRAUD_COLUMNS, "detected_at"] if c in fraud.columns]
    kept = lookback(fraud, hours, now).select(*cols)
    if not newest_first:
        return kept
    return kept.orderBy(F.col("timestamp").desc(), *[F.col(c) for c in cols if c != "timestamp"])


def jdbc_options(url: str, table: str = "fraud_transactions", hours: int | None = None,
                 as_of: datetime | str | None = None, partitions: int = 8, properties: dict | None = None) -> dict[str, str]:
    """Options of a partitioned read of the fraud table in a database.  The
    look-back is part of the query the database runs; partitions split the
    time range of the look-back evenly."""
    options = {"url": url, "dbtable": table, **(properties or {})}
    if hours is not None and as_of is not None:
        now = datetime.fromisoformat(as_of_text(as_of))
        since = now - timedelta(hours=hours)
        options["dbtable"] = f"(SELECT * FROM {table} WHERE timestamp >= TIMESTAMP '{since.isoformat(sep=' ')}') AS fraud"
        options |= {"partitionColumn": "timestamp", "lowerBound": since.isoformat(sep=" "), "upperBound": now.isoformat(sep=" "),
                    "numPartitions": str(partitions)}
    return options


def fraud_jdbc_scan(spark: SparkSession, url: str, **given) -> DataFrame:
    """Fraud rows in a database table (needs the database's driver)."""
    return spark.read.format("jdbc").options(**jdbc_options(url, **given)).load()
