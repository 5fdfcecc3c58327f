"""Starting the streaming queries.

``start_*`` return running queries (production: continuous triggers);
``run_available_now`` drains what is available and stops (tests, backfills):
it also runs the no-data batch that closes windows once the watermark moved.
Checkpoints and outputs live below the shared scratch area unless given.
"""

from __future__ import annotations

from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tripwire.config import HIGH_VALUE_THRESHOLD, WATERMARK_DELAY
from tripwire.session import fresh_path, parallelism
from tripwire.sinks.fraud_table import FraudTableWriter

PROVIDER = "spark.sql.streaming.stateStore.providerClass"
ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"
# where the session does not say otherwise: commits write changes only, and a write
# does not read first (only the total-rows metric is lost)
ROCKSDB_DEFAULTS = {
    "spark.sql.streaming.stateStore.rocksdb.changelogCheckpointing.enabled": "true",
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
}


def _trigger(writer, available_now: bool, processing_time: str | None):
    if available_now:
        return writer.trigger(availableNow=True)
    if processing_time:
        return writer.trigger(processingTime=processing_time)
    return writer


def start_fraud_sink(fraud: DataFrame, table_path: str, checkpoint: str, available_now: bool = False,
                     writer: FraudTableWriter | None = None, name: str | None = None) -> StreamingQuery:
    w = (fraud.writeStream.foreachBatch(writer or FraudTableWriter(table_path))
         .option("checkpointLocation", checkpoint).outputMode("append"))
    if name:
        w = w.queryName(name)
    with processor_state(fraud.sparkSession):
        return _trigger(w, available_now, None).start()


def start_validated_sink(tx: DataFrame, path: str, checkpoint: str, available_now: bool = False,
                         processing_time: str = "30 seconds") -> StreamingQuery:
    w = (tx.writeStream.format("parquet").option("path", path)
         .option("checkpointLocation", checkpoint).outputMode("append"))
    return _trigger(w, available_now, processing_time).start()


@contextmanager
def state_partitions(spark: SparkSession, n: int | None = None):
    """Runs a *new* stateful query with ``n`` state partitions (default: the
    cluster's parallelism).  The count is fixed into the query's checkpoint at
    its first batch, so this only matters for fresh checkpoints; the session's
    own setting is restored afterwards."""
    key = "spark.sql.shuffle.partitions"
    before = spark.conf.get(key)
    spark.conf.set(key, str(n or parallelism(spark)))
    try:
        yield
    finally:
        spark.conf.set(key, before)


@contextmanager
def processor_state(spark: SparkSession):
    """Starts a query whose state is kept by RocksDB, on local disk and in the
    checkpoint's change files.  The session's default store is a map on the heap
    that holds every key (ten windows an event): it fills the executors long before
    the disk.  State processors need RocksDB anyway.  The store is fixed into the
    query's checkpoint; a query that was begun with another one goes on with that."""
    before = {key: spark.conf.get(key, None) for key in (PROVIDER, *ROCKSDB_DEFAULTS)}
    spark.conf.set(PROVIDER, ROCKSDB)
    for key, value in ROCKSDB_DEFAULTS.items():
        if before[key] is None:
            spark.conf.set(key, value)
    try:
        yield
    finally:
        for key, value in before.items():
            if value is None:
                spark.conf.unset(key)
            else:
                spark.conf.set(key, value)


def late_rows_dropped(query: StreamingQuery) -> int:
    """Rows the stateful operators dropped as later than the watermark, over
    the query's retained progress reports."""
    return sum(op.get("numRowsDroppedByWatermark", 0)
               for p in query.recentProgress for op in p.get("stateOperators", []))


def rows_processed(query: StreamingQuery) -> int:
    """Input rows over the retained progress reports (the batch count without
    re-running the batch)."""
    return sum(p.get("numInputRows", 0) for p in query.recentProgress)


def run_available_now(df: DataFrame, spark: SparkSession, name: str, processor: bool = False) -> str:
    """Drain ``df`` into a fresh Parquet directory (fresh checkpoint, state
    partitions sized to the cluster, state in RocksDB); returns its path.
    ``processor``: ``df`` holds a state processor (any query gets the store it needs)."""
    out, ckpt = fresh_path(spark, name), fresh_path(spark, f"{name}-checkpoint")
    with state_partitions(spark), processor_state(spark):
        q = (df.writeStream.format("parquet").option("path", out)
             .option("checkpointLocation", ckpt).outputMode("append")
             .trigger(availableNow=True).start())
        q.awaitTermination()
    return out


def run_pipeline(spark: SparkSession, tx: DataFrame, base: str, available_now: bool = False,
                 threshold: float = HIGH_VALUE_THRESHOLD, watermark: str = WATERMARK_DELAY,
                 jdbc_url: str | None = None, jdbc_properties: dict | None = None, jdbc_table: str = "fraud_transactions",
                 filters: bool = False):
    """The full speed layer: fraud stream -> fraud table, all transactions ->
    validated files (rows breaking the fraud table's constraints go to
    ``fraud_quarantine/``); both streams are also registered as ``fraud_view`` and
    ``transactions_view``.  ``filters``: Bloom filters below ``fraud_filters/`` save
    reading stored rows (a table written without: ``add_filters`` first).  Returns both queries
    (``spark.streams.awaitAnyTermination()`` waits for them)."""
    from tripwire.sources.views import register_views
    from tripwire.streaming.detect import stream_fraud

    base = base.rstrip("/")
    fraud = stream_fraud(tx, watermark, threshold)
    register_views(fraud, tx)
    writer = FraudTableWriter(f"{base}/fraud", quarantine_path=f"{base}/fraud_quarantine",
                              filter_path=f"{base}/fraud_filters" if filters else None,
                              jdbc_url=jdbc_url, jdbc_table=jdbc_table, jdbc_properties=jdbc_properties or {})
    fraud_q = start_fraud_sink(fraud, f"{base}/fraud", f"{base}/checkpoints/fraud",
                               available_now=available_now, writer=writer)
    valid_q = start_validated_sink(tx, f"{base}/validated", f"{base}/checkpoints/validated",
                                   available_now=available_now)
    return fraud_q, valid_q
