"""Publishing transactions to a topic in the JSON wire format.

The record key is the user id, so a topic partitioned by key keeps each user's
events in order within one partition.  Needs the Kafka connector on the
cluster's classpath.
"""

from __future__ import annotations

from pyspark.sql import DataFrame

from tripwire.sources.payload import json_encode


def publish(tx: DataFrame, servers: str, topic: str, **options: str) -> None:
    """Batch publish (one message per transaction)."""
    w = (json_encode(tx, as_binary=True).write.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic))
    for k, v in options.items():
        w = w.option(k, v)
    w.save()


def publish_stream(tx: DataFrame, servers: str, topic: str, checkpoint: str, **options: str):
    """Continuous publish of a transaction stream; returns the running query."""
    w = (json_encode(tx, as_binary=True).writeStream.format("kafka")
         .option("kafka.bootstrap.servers", servers).option("topic", topic)
         .option("checkpointLocation", checkpoint))
    for k, v in options.items():
        w = w.option(k, v)
    return w.start()
