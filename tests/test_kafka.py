"""The topic paths need the Kafka connector on the classpath, which this
environment does not have: the plans must be built and fail only on the
missing data source (no broker is contacted)."""

import pytest

from tripwire.sinks.topic import publish
from tripwire.streaming.ingest import kafka_transactions


def _missing_kafka(exc: BaseException) -> bool:
    text = str(exc).lower()
    return "kafka" in text and ("data source" in text or "data_source_not_found" in text)


def test_kafka_source_needs_only_the_connector(spark):
    with pytest.raises(Exception) as info:
        kafka_transactions(spark, "localhost:1", "transactions")
    assert _missing_kafka(info.value)


def test_publish_needs_only_the_connector(spark, make_tx):
    tx = make_tx([("U", "00:00:10", "X", 1.0, "US")])
    with pytest.raises(Exception) as info:
        publish(tx, "localhost:1", "transactions")
    assert _missing_kafka(info.value)
