"""Streaming query registry.

Each key runs the streaming plan with ``availableNow`` over the whole input
(the Parquet event table as a file stream, or JSON payload files derived from
it), writes to a fresh directory below the shared scratch area and returns a
batch read of what the sink committed.  Only windows closed by the watermark
are emitted, so the SQL twins are the batch results restricted to windows that
end at least the watermark delay before the latest event.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.schema import FRAUD_COLUMNS, TX_COLUMNS
from tripwire.session import fresh_path
from tripwire.sources import json_encode, load_transactions, validated_scan
from tripwire.operators.increments import advance, merged_totals, partial_sums
from tripwire.sinks.fraud_table import FraudTableWriter, read_fraud_table
from tripwire.streaming import detect as SD
from tripwire.streaming import stateful as ST
from tripwire.streaming.ingest import event_transactions, payload_transactions
from tripwire.streaming.speed_layer import SpeedLayer, read_rows, start_speed_layer
from tripwire.streaming.run import run_available_now, start_fraud_sink, start_validated_sink, state_partitions


def _events_path(d: str) -> str:
    return f"{d.rstrip('/')}/events.parquet"


def write_payload_files(spark: SparkSession, d: str) -> str:
    """JSON payload text files (the topic's wire format) derived from the events."""
    out = fresh_path(spark, "payloads")
    json_encode(load_transactions(spark, d)).select("value").write.text(out)
    return out


def _drain(build, processor: bool = False) -> callable:
    def run(spark: SparkSession, d: str) -> DataFrame:
        stream = build(event_transactions(spark, _events_path(d)))
        return spark.read.parquet(run_available_now(stream, spark, "stream", processor))
    return run


def _ingest(spark: SparkSession, d: str) -> DataFrame:
    stream = payload_transactions(spark, write_payload_files(spark, d))
    return spark.read.parquet(run_available_now(stream, spark, "ingest"))


def _validated(spark: SparkSession, d: str) -> DataFrame:
    stream = payload_transactions(spark, write_payload_files(spark, d))
    out, ckpt = fresh_path(spark, "validated"), fresh_path(spark, "validated-checkpoint")
    with state_partitions(spark):
        start_validated_sink(stream, out, ckpt, available_now=True).awaitTermination()
    return validated_scan(spark, out)


def _fraud_sink(spark: SparkSession, d: str) -> DataFrame:
    stream = SD.stream_fraud(event_transactions(spark, _events_path(d)))
    table, ckpt = fresh_path(spark, "fraud-table"), fresh_path(spark, "fraud-checkpoint")
    with state_partitions(spark):
        start_fraud_sink(stream, table, ckpt, available_now=True).awaitTermination()
    return read_fraud_table(spark, table).select(*FRAUD_COLUMNS)


def _speed_layer(table: str) -> callable:
    """One query feeding all sinks; ``table``: the one that is read back."""
    def run(spark: SparkSession, d: str) -> DataFrame:
        base = fresh_path(spark, "speed-layer")
        start_speed_layer(event_transactions(spark, _events_path(d)), base, available_now=True).awaitTermination()
        if table == "fraud":
            return read_fraud_table(spark, f"{base}/fraud").select(*FRAUD_COLUMNS)
        return read_rows(spark, base, table).select(*TX_COLUMNS)
    return run


def _incremental_totals(spark: SparkSession, d: str) -> DataFrame:
    """Two runs of the speed layer's batches, summed in two increments."""
    base = fresh_path(spark, "increments")
    tx = load_transactions(spark, d)
    half = F.when(F.pmod(F.unix_date(F.to_date("timestamp")), F.lit(2)) == 0, 0).otherwise(1)
    for n in range(2):
        SpeedLayer(base, query_id="q", writer=FraudTableWriter(f"{base}/fraud", query_id="q"))(tx.filter(half == n), n)
        advance(spark, base, f"{base}/sums")
    totals = merged_totals(partial_sums(spark, f"{base}/sums"))
    return totals.withColumn("total_amount", F.round("total_amount", 4))


def stream_queries():
    return {
        "stream_ingest": _ingest,
        "stream_validated_sink": _validated,
        "stream_high_value": _drain(SD.stream_high_value),
        "stream_window_location_count": _drain(SD.stream_window_location_count),
        "stream_impossible_travel": _drain(SD.stream_impossible_travel),
        "stream_travel_stateful": _drain(ST.stream_travel_stateful, processor=True),
        "stream_travel_exact": _drain(ST.stream_travel_exact, processor=True),
        "stream_fraud_union": _drain(SD.stream_fraud),
        "stream_fraud_sink": _fraud_sink,
        "stream_speed_layer_fraud": _speed_layer("fraud"),
        "validated_totals_incremental": _incremental_totals,
        "stream_speed_layer_validated": _speed_layer("validated"),
    }


def stream_oracles():
    from tripwire.plans.oracle import closed_window_sql, oracle_queries

    q = oracle_queries()
    closed = closed_window_sql()
    return {
        "stream_ingest": q["event_time_parse"],
        "stream_validated_sink": q["event_time_parse"],
        "stream_high_value": q["high_value"],
        "stream_window_location_count": closed["window_location_count"],
        "stream_impossible_travel": closed["impossible_travel"],
        "stream_travel_stateful": closed["impossible_travel"],
        "stream_travel_exact": q["impossible_travel_exact"],
        "stream_fraud_union": closed["fraud_union"],
        "stream_fraud_sink": closed["fraud_distinct"],
        "stream_speed_layer_fraud": closed["fraud_distinct"],
        "validated_totals_incremental": q["validated_totals"],
        "stream_speed_layer_validated": q["event_time_parse"],
    }
