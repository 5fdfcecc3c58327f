"""Fraud table writer for ``foreachBatch``.

Layout: ``<table>/event_date=<d>/query_id=<q>/batch_id=<n>/``.  The query id is
the one Spark keeps in the checkpoint, so a directory belongs to one batch of
one query: a batch replayed after a failure replaces the directories of its
earlier attempt (dynamic partition overwrite), and no other query, nor the same
one with a fresh checkpoint, can overwrite them.

Rows are de-duplicated within the batch and against what any other batch wrote
(the sliding-window detector re-emits an event for every window that closes
later).  That lookup is bounded by the batch's own time range: only its event
dates are listed, and only rows between its first and last event time are read.
Rows without an event time are kept under the NULL date and looked up there.
With ``filter_path`` Bloom filters per date and batch (``key_filter``) come
first: stored rows are read only for the range of the rows that hit one.
A batch writes one file per date until a date's rows are large.  Errors
propagate: the batch is not committed and is retried on restart.

Optionally the new rows are also appended to a database table, each batch once
(``ledger.LedgerAppend``), and rows that
break the table's constraints (NOT NULL, maximum lengths) are written to a
quarantine directory with their violations instead of failing the batch.
"""

from __future__ import annotations

from dataclasses import dataclass, field
from datetime import date, timedelta

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.operators.sizing import fits_broadcast
from tripwire.schema import FRAUD_COLUMNS, FRAUD_TABLE
from tripwire.sinks.compaction import compact, live_rows
from tripwire.sinks.key_filter import FILTERS, may_be_stored, rebuild_filters, write_filters
from tripwire.sinks.ledger import LedgerAppend

# Stored layout: the fraud table columns plus the partition columns.
STORED = T.StructType(FRAUD_TABLE.fields + [
    T.StructField("event_date", T.DateType(), True),
    T.StructField("query_id", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])
_NO_DATE = "event_date=__HIVE_DEFAULT_PARTITION__"
# A batch over more dates than this (a backfill) looks up the whole table, pruned by date.
_NAMED_DATES = 62
OUTSIDE_A_QUERY = "none"


def _missing(exc: Exception) -> bool:
    text = str(exc)
    return "PATH_NOT_FOUND" in text or "Path does not exist" in text


def read_fraud_table(spark: SparkSession, path: str) -> DataFrame:
    """The stored fraud rows (zero rows when nothing was written yet)."""
    live = live_rows(spark, path, STORED)
    if live is not None:
        return live
    try:
        return spark.read.schema(STORED).parquet(path)
    except Exception as exc:  # noqa: BLE001 - only a missing table is tolerated
        if not _missing(exc):
            raise
        return spark.createDataFrame([], STORED)


def _date_names(first, last, undated: bool) -> list[str]:
    """Directories of the dates from ``first`` to ``last`` (microseconds) and, if
    asked, of no date; none when they are too many to name."""
    names = []
    if first is not None:
        a, b = (timedelta(microseconds=t).days for t in (first, last))
        if b - a < _NAMED_DATES:
            names = [f"event_date={(date(1970, 1, 1) + timedelta(days=d)).isoformat()}" for d in range(a, b + 1)]
    if undated and (names or first is None):
        names.append(_NO_DATE)
    return names


def _read_dates(spark: SparkSession, root: str, schema: T.StructType, names: list[str]) -> DataFrame | None:
    """The rows below the named date directories (all without names); ``None``
    when nothing of the kind is stored."""
    if names:
        reader = spark.read.schema(schema).option("basePath", root)
        # literal paths; when some date has no directory yet, a glob over them
        tries = [[f"{root}/{n}" for n in names], [f"{root}/{{{','.join(names)}}}"]]
    else:
        reader, tries = spark.read.schema(schema), [[root]]
    for paths in tries:
        try:
            return reader.parquet(*paths)
        except Exception as exc:  # noqa: BLE001 - a date not written yet is not an error
            if not _missing(exc):
                raise
    return None


def _stored_between(spark: SparkSession, root: str, first, last, undated: bool) -> DataFrame | None:
    """Stored rows with event times from ``first`` to ``last`` (and, if asked,
    without one).  ``None`` when nothing of the kind is stored."""
    wanted = F.lit(False)
    if first is not None:
        wanted = F.col("timestamp").between(F.timestamp_micros(F.lit(first)), F.timestamp_micros(F.lit(last)))
    if undated:
        wanted = wanted | F.col("timestamp").isNull()
    names = _date_names(first, last, undated)
    live = live_rows(spark, root, STORED, names or None)
    if live is None:
        live = _read_dates(spark, root, STORED, names)
    return None if live is None else live.filter(wanted)


def _extent(rows: DataFrame):
    """(first, last, rows without a time, rows): one row about a batch."""
    return rows.agg(F.min(F.unix_micros("timestamp")), F.max(F.unix_micros("timestamp")),
                    F.count_if(F.col("timestamp").isNull()), F.count(F.lit(1))).first()


@dataclass
class FraudTableWriter:
    path: str
    jdbc_url: str | None = None
    jdbc_table: str = "fraud_transactions"
    jdbc_properties: dict = field(default_factory=dict)
    database: LedgerAppend | None = None      # default: made of the JDBC settings
    quarantine_path: str | None = None
    filter_path: str | None = None      # Bloom filters of the stored rows; of a table written without: ``add_filters``
    query_id: str | None = None         # default: the running streaming query's

    def _query_id(self, spark: SparkSession) -> str:
        return (self.query_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or OUTSIDE_A_QUERY)

    def _suspected(self, rows: DataFrame, query_id: str, batch_id: int, first, last, undated: bool):
        """The extent of the rows that a filter of another batch says may be stored."""
        filters = _read_dates(rows.sparkSession, self.filter_path.rstrip("/"), FILTERS, _date_names(first, last, undated))
        if filters is None:
            return None, None, 0, 0
        others = (F.col("query_id") != query_id) | (F.col("batch_id") < F.lit(batch_id))
        return _extent(may_be_stored(rows, filters.filter(others), FRAUD_COLUMNS))

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query_id = self._query_id(spark)
        rows = (batch.select(*FRAUD_COLUMNS)
                .dropDuplicates(FRAUD_COLUMNS)
                .withColumn("event_date", F.to_date("timestamp"))
                .persist())
        cached = [rows]
        try:
            new = rows
            root = self.path.rstrip("/")
            first, last, undated, size = _extent(rows)
            if self.filter_path and size:
                first, last, undated, size = self._suspected(rows, query_id, batch_id, first, last, undated > 0)
            stored = _stored_between(spark, root, first, last, undated > 0) if size else None
            if stored is not None:
                others = (F.col("query_id") != query_id) | (F.col("batch_id") < F.lit(batch_id))
                seen = stored.filter(others).select(*[F.col(c).alias(f"_s_{c}") for c in FRAUD_COLUMNS])
                cond = F.lit(True)
                for c in FRAUD_COLUMNS:
                    cond = cond & F.col(c).eqNullSafe(F.col(f"_s_{c}"))
                if fits_broadcast(rows):
                    # small batch: find the already-stored rows with the batch broadcast
                    # (stored rows are scanned, not shuffled), then drop them
                    dups = seen.join(F.broadcast(rows), cond, "left_semi")
                    new = rows.join(F.broadcast(dups), cond, "left_anti")
                else:
                    new = rows.join(seen, cond, "left_anti")
            out = (new.withColumn("detected_at", F.current_timestamp())
                   .withColumn("query_id", F.lit(query_id))
                   .withColumn("batch_id", F.lit(batch_id).cast("long")))
            if self.quarantine_path:
                from tripwire.operators.quality import constraint_violations

                checked = constraint_violations(out).persist()
                cached.append(checked)
                (checked.filter(F.size("violations") > 0).write.mode("overwrite")
                 .parquet(f"{self.quarantine_path.rstrip('/')}/query_id={query_id}/batch_id={batch_id}"))
                out = checked.filter(F.size("violations") == 0).drop("violations")
            if self.jdbc_url or self.filter_path:
                out = out.persist()
                cached.append(out)
            if self.filter_path:
                write_filters(out, FRAUD_COLUMNS, self.filter_path.rstrip("/"), query_id, batch_id)
            # rows of a date together (large dates are split again at run time)
            (out.select(*STORED.names).hint("rebalance", "event_date")
             .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
             .partitionBy("event_date", "query_id", "batch_id").parquet(self.path))
            if self.jdbc_url:
                append = self.database or LedgerAppend(self.jdbc_url, self.jdbc_table, self.jdbc_properties)
                append(out.drop("event_date", "query_id", "batch_id"), query_id, batch_id)
        finally:
            for df in cached:
                df.unpersist()


def compact_fraud_table(spark: SparkSession, path: str, before: date) -> list[str]:
    """One file per date before ``before`` (``compaction.compact``)."""
    return compact(spark, path, before, STORED)


def add_filters(spark: SparkSession, path: str, filter_path: str) -> None:
    """Filters for what the table at ``path`` holds, before a writer uses them."""
    rebuild_filters(read_fraud_table(spark, path), FRAUD_COLUMNS, filter_path.rstrip("/"))
