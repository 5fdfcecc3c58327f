"""Streaming sources.

Production reads the transaction topic (``format="kafka"``, the connector jar
on the cluster's classpath); offline runs read a directory of JSON payload
files or the Parquet event table.  All paths end in the same decoded
transaction stream, so the detectors never know the difference.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tripwire.schema import EVENTS
from tripwire.sources.fixture import transactions_from_events
from tripwire.sources.payload import decode_transactions
from tripwire.session import pin_session


def file_glob(path: str) -> str:
    """A streaming file source wants a directory or a glob; a single file is
    turned into a glob matching exactly that file."""
    if path.endswith("/") or "*" in path or "[" in path:
        return path
    return path[:-1] + "[" + path[-1] + "]"


def kafka_transactions(spark: SparkSession, servers: str, topic: str,
                       starting_offsets: str = "earliest", **options: str) -> DataFrame:
    """Decoded transactions from a topic (binary ``value`` holding JSON)."""
    pin_session(spark)
    reader = (spark.readStream.format("kafka")
              .option("kafka.bootstrap.servers", servers)
              .option("subscribe", topic)
              .option("startingOffsets", starting_offsets)
              .option("failOnDataLoss", "false"))
    for k, v in options.items():
        reader = reader.option(k, v)
    return decode_transactions(reader.load())


def payload_transactions(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Decoded transactions from text files holding one JSON payload per line."""
    pin_session(spark)
    reader = spark.readStream.format("text")
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return decode_transactions(reader.load(file_glob(path)))


def event_transactions(spark: SparkSession, path: str, max_files_per_trigger: int | None = None) -> DataFrame:
    """Transactions from the Parquet event table, as a stream."""
    pin_session(spark)
    reader = spark.readStream.schema(EVENTS)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", str(max_files_per_trigger))
    return transactions_from_events(reader.parquet(file_glob(path)))
