"""One query for all sinks: equality with two queries, late rows, crashes and repeats."""

from __future__ import annotations

import tempfile
from collections import Counter

import pytest
from pyspark.errors import StreamingQueryException

from tests.test_stateful import _batch, _counted, _random_files
from tests.test_streaming import _payload, _stream, _write_files
from tripwire.operators.detect import impossible_travel
from tripwire.schema import FRAUD_COLUMNS, TRANSACTION, TX_COLUMNS
from tripwire.sinks.fraud_table import FraudTableWriter, read_fraud_table
from tripwire.streaming import detect as SD
from tripwire.streaming.run import start_fraud_sink
from tripwire.streaming.speed_layer import SpeedLayer, read_rows, start_speed_layer


def _dirs(files):
    root, base = tempfile.mkdtemp(prefix="one-", dir="/tmp"), tempfile.mkdtemp(prefix="one-out-", dir="/tmp")
    _write_files(root, files)
    return root, base


def _ordered(seed, n=90, files=3):
    """In time order, so that no row is late; a last file closes all windows."""
    lines = sorted(sum(_random_files(seed, n=n), []), key=lambda line: line.split('"timestamp": ')[1])
    size = n // files
    return [*[lines[i:i + size] for i in range(0, n, size)], [_payload("W", "00:00:00", "US").replace("01-01", "01-09")]]


def _fraud(spark, base):
    return _counted(read_fraud_table(spark, base + "/fraud").select(*FRAUD_COLUMNS))


def test_equals_two_queries(spark):
    files = _ordered(7)
    root, base = _dirs(files)
    query = start_speed_layer(_stream(spark, root), base, available_now=True)
    query.awaitTermination()
    assert all(len(p["sources"]) == 1 and not p["stateOperators"] for p in query.recentProgress)
    start_fraud_sink(SD.stream_fraud(_stream(spark, root)), base + "/two", base + "/two-c", available_now=True).awaitTermination()
    assert _fraud(spark, base) == _counted(read_fraud_table(spark, base + "/two").select(*FRAUD_COLUMNS))
    rows = _batch(spark, files)
    assert _counted(read_rows(spark, base).select(*TX_COLUMNS)) == _counted(rows)
    assert set(_counted(impossible_travel(rows))) == {r for r in _fraud(spark, base) if r[5] == "IMPOSSIBLE_TRAVEL"} != set()
    assert read_rows(spark, base, "late").count() == 0


def test_late_rows_are_kept(spark):
    files = [[_payload("W", "02:00:00", "US")], [_payload("W", "02:00:10", "US")],
             [_payload("L", "00:06:00", "US", amount=9000.0), _payload("L", "00:06:30", "UK"), _payload("N", "01:50:00", "US"),
              _payload("N", "01:51:00", "UK"), '{"user_id": "X"}'],
             [_payload("W", "04:00:00", "US")]]
    root, base = _dirs(files)
    start_speed_layer(_stream(spark, root), base, available_now=True).awaitTermination()
    late = read_rows(spark, base, "late").collect()
    assert sorted(r.user_id for r in late) == ["L", "L"] and {r.batch_id for r in late} == {2}
    # kept rows and rows that took part are the input
    assert read_rows(spark, base).count() == 8
    assert Counter((r[0], r[5]) for r in _fraud(spark, base)) == {("L", "HIGH_VALUE_TRANSACTION"): 1, ("N", "IMPOSSIBLE_TRAVEL"): 2}


class Falls(FraudTableWriter):
    def __call__(self, batch, batch_id):
        super().__call__(batch, batch_id)
        if batch_id == 1:
            raise RuntimeError("after the write")


def test_crash_and_repeat(spark):
    files = _ordered(9)
    root, base = _dirs(files)
    with pytest.raises(StreamingQueryException):
        start_speed_layer(_stream(spark, root), base, available_now=True, writer=Falls(base + "/fraud")).awaitTermination()
    start_speed_layer(_stream(spark, root), base, available_now=True).awaitTermination()
    _, other = _dirs([])
    start_speed_layer(_stream(spark, root), other, available_now=True).awaitTermination()
    assert _fraud(spark, base) == _fraud(spark, other)
    assert _counted(read_rows(spark, base).select(*TX_COLUMNS)) == _counted(read_rows(spark, other).select(*TX_COLUMNS))
    # the last batch again, by hand
    layer = SpeedLayer(base, query_id=read_rows(spark, base).first().query_id, writer=FraudTableWriter(
        base + "/fraud", query_id=read_rows(spark, base).first().query_id))
    before = _fraud(spark, base)
    last = read_rows(spark, base).filter("batch_id = 3").select(*TX_COLUMNS).collect()
    layer(spark.createDataFrame(last, TRANSACTION), 3)
    assert _fraud(spark, base) == before
