"""Streaming: late data, windows closing over several batches, sink
idempotency, restart from a checkpoint, batch parity."""

from __future__ import annotations

import json
import os
import tempfile
from collections import Counter
from datetime import timedelta

from pyspark.sql import functions as F

from tripwire.sinks.fraud_table import FraudTableWriter, read_fraud_table
from tripwire.streaming import detect as SD
from tripwire.streaming.ingest import payload_transactions
from tripwire.streaming.run import late_rows_dropped, run_available_now, start_fraud_sink
from tests.conftest import ts


def _payload(user, t, loc, amount=10.0, cat="TRAVEL"):
    return json.dumps({"user_id": user, "timestamp": f"2024-01-01T{t}", "merchant_category": cat,
                       "amount": amount, "location": loc})


def _write_files(root, batches):
    os.makedirs(root, exist_ok=True)
    for i, lines in enumerate(batches):
        with open(os.path.join(root, f"part-{i:03d}.json"), "w") as fh:
            fh.write("\n".join(lines) + "\n")
        # distinct modification times keep the file order
        os.utime(os.path.join(root, f"part-{i:03d}.json"), (1_700_000_000 + i, 1_700_000_000 + i))


def _stream(spark, root):
    return payload_transactions(spark, root, max_files_per_trigger=1)


def test_late_data_dropped_by_travel_branch_only(spark):
    root = tempfile.mkdtemp(prefix="late-", dir="/tmp")
    _write_files(root, [
        [_payload("W", "02:00:00", "US")],
        [_payload("W", "02:00:10", "US")],
        [_payload("L", "00:06:00", "US", amount=9000.0), _payload("L", "00:06:30", "UK")],
    ])
    out = spark.read.parquet(run_available_now(SD.stream_fraud(_stream(spark, root)), spark, "late"))
    got = Counter((r["user_id"], r["fraud_reason"]) for r in out.collect())
    assert got == {("L", "HIGH_VALUE_TRANSACTION"): 1}
    # the drop is visible in the query metrics
    target = tempfile.mkdtemp(prefix="late-out-", dir="/tmp")
    q = (SD.stream_fraud(_stream(spark, root)).writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", target + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert late_rows_dropped(q) > 0


def test_windows_close_over_several_batches(spark):
    root = tempfile.mkdtemp(prefix="closing-", dir="/tmp")
    _write_files(root, [
        [_payload("U1", "00:00:10", "US"), _payload("U1", "00:05:00", "UK")],
        [_payload("W", "00:17:30", "US")],
        [_payload("W", "00:23:30", "US")],
        [_payload("W", "00:28:30", "US")],
        [_payload("W", "02:00:00", "US")],
    ])
    travel = spark.read.parquet(run_available_now(SD.stream_impossible_travel(_stream(spark, root)),
                                                  spark, "closing"))
    assert Counter(r["timestamp"] for r in travel.collect()) == {ts("00:00:10"): 5, ts("00:05:00"): 5}

    table = tempfile.mkdtemp(prefix="fraud-table-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="fraud-ckpt-", dir="/tmp")
    start_fraud_sink(SD.stream_fraud(_stream(spark, root)), table, ckpt, available_now=True).awaitTermination()
    stored = read_fraud_table(spark, table)
    assert Counter(r["timestamp"] for r in stored.collect()) == {ts("00:00:10"): 1, ts("00:05:00"): 1}


def test_restart_from_checkpoint_equals_single_run(spark):
    root = tempfile.mkdtemp(prefix="restart-", dir="/tmp")
    files = [
        [_payload("U1", "00:00:10", "US"), _payload("U1", "00:05:00", "UK")],
        [_payload("U2", "00:20:00", "FR", amount=6000.0), _payload("U2", "00:21:00", "DE")],
        [_payload("W", "01:00:00", "US")],
    ]
    _write_files(root, files[:2])
    table = tempfile.mkdtemp(prefix="restart-table-", dir="/tmp")
    ckpt = tempfile.mkdtemp(prefix="restart-ckpt-", dir="/tmp")
    start_fraud_sink(SD.stream_fraud(_stream(spark, root)), table, ckpt, available_now=True).awaitTermination()
    first = read_fraud_table(spark, table).count()
    _write_files(root + "/more", [])
    with open(os.path.join(root, "part-002.json"), "w") as fh:
        fh.write("\n".join(files[2]) + "\n")
    start_fraud_sink(SD.stream_fraud(_stream(spark, root)), table, ckpt, available_now=True).awaitTermination()
    got = Counter((r["user_id"], r["fraud_reason"]) for r in read_fraud_table(spark, table).collect())
    assert got == {("U1", "IMPOSSIBLE_TRAVEL"): 2, ("U2", "IMPOSSIBLE_TRAVEL"): 2,
                   ("U2", "HIGH_VALUE_TRANSACTION"): 1}
    assert first <= sum(got.values())


def test_fraud_writer_replay_is_idempotent(spark, make_tx):
    tx = make_tx([("U", "00:00:10", "X", 9000.0, "US")])
    batch = tx.withColumn("fraud_reason", F.lit("HIGH_VALUE_TRANSACTION"))
    table = tempfile.mkdtemp(prefix="replay-", dir="/tmp") + "/t"
    writer = FraudTableWriter(table)
    writer(batch.unionByName(batch), 0)
    writer(batch, 0)          # the same batch again after a failure
    writer(batch, 1)          # a later batch re-emitting the same event
    assert read_fraud_table(spark, table).count() == 1


def test_stream_equals_batch_on_closed_windows(spark):
    from tripwire.operators.detect import impossible_travel
    from tripwire.sources.fixture import load_transactions
    from tripwire.streaming.ingest import event_transactions

    d = "/root/testdata/sf0.001"
    stream_rows = spark.read.parquet(run_available_now(
        SD.stream_impossible_travel(event_transactions(spark, f"{d}/events.parquet")), spark, "parity"))
    tx = load_transactions(spark, d)
    cut = tx.select(F.max("timestamp") - F.expr("INTERVAL 15 MINUTES")).first()[0]
    batch = impossible_travel(tx)
    assert stream_rows.count() == batch.count() == 194
    assert stream_rows.exceptAll(batch).count() == 0
    assert cut is not None


def test_sink_failure_propagates_and_restart_replays(spark):
    import pytest
    from pyspark.errors import StreamingQueryException

    root = tempfile.mkdtemp(prefix="fail-", dir="/tmp")
    _write_files(root, [[_payload("U", "00:00:10", "US", amount=9000.0), _payload("U", "00:01:00", "UK")],
                        [_payload("W", "01:00:00", "US")]])
    table = tempfile.mkdtemp(prefix="fail-table-", dir="/tmp") + "/t"
    ckpt = tempfile.mkdtemp(prefix="fail-ckpt-", dir="/tmp")
    good = FraudTableWriter(table)

    def flaky(batch, batch_id):
        good(batch, batch_id)          # the write happens, then the batch fails
        raise RuntimeError("sink down")

    with pytest.raises(StreamingQueryException):
        start_fraud_sink(SD.stream_fraud(_stream(spark, root)), table, ckpt, available_now=True,
                         writer=flaky).awaitTermination()
    start_fraud_sink(SD.stream_fraud(_stream(spark, root)), table, ckpt, available_now=True,
                     writer=good).awaitTermination()
    got = Counter((r["amount"], r["fraud_reason"]) for r in read_fraud_table(spark, table).collect())
    assert got == {(9000.0, "HIGH_VALUE_TRANSACTION"): 1, (9000.0, "IMPOSSIBLE_TRAVEL"): 1,
                   (10.0, "IMPOSSIBLE_TRAVEL"): 1}


def test_hll_window_count_equals_exact_on_country_codes(spark):
    from tripwire.streaming.ingest import event_transactions

    d = "/root/testdata/sf0.001/events.parquet"
    exact = spark.read.parquet(run_available_now(
        SD.stream_window_location_count(event_transactions(spark, d)), spark, "hll-exact"))
    approx = spark.read.parquet(run_available_now(
        SD.stream_window_location_count(event_transactions(spark, d), approx=True), spark, "hll-approx"))
    assert exact.count() > 0
    assert exact.exceptAll(approx).count() == 0 and approx.exceptAll(exact).count() == 0


def test_multi_batch_stream_equals_batch_on_closed_windows(spark):
    """The events split by time into six files, one micro-batch each: windows
    close and join state is evicted between batches."""
    from tripwire.operators.detect import impossible_travel
    from tripwire.sources.fixture import load_events, transactions_from_events
    from tripwire.streaming.ingest import event_transactions

    d = "/root/testdata/sf0.01"
    events = load_events(spark, d)
    root = tempfile.mkdtemp(prefix="multi-", dir="/tmp")
    bounds = events.select(F.min("ts").alias("lo"), F.max("ts").alias("hi")).first()
    step = (bounds["hi"] - bounds["lo"]) / 6
    for i in range(6):
        lo, hi = bounds["lo"] + step * i, bounds["lo"] + step * (i + 1)
        part = events.filter((F.col("ts") >= lo) & ((F.col("ts") < hi) if i < 5 else F.lit(True)))
        part.coalesce(1).write.parquet(f"{root}/part-{i}")
        path = glob_one(f"{root}/part-{i}")
        os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        os.replace(path, f"{root}/events-{i}.parquet")
    stream = SD.stream_impossible_travel(event_transactions(spark, f"{root}/events-*.parquet",
                                                            max_files_per_trigger=1))
    target = tempfile.mkdtemp(prefix="multi-out-", dir="/tmp")
    q = (stream.writeStream.format("parquet").option("path", target)
         .option("checkpointLocation", target + "-ckpt").trigger(availableNow=True).start())
    q.awaitTermination()
    assert len([p for p in q.recentProgress if p["numInputRows"] > 0]) == 6
    got = spark.read.parquet(target)
    tx = transactions_from_events(events)
    cut = tx.select(F.max("timestamp")).first()[0] - timedelta(minutes=15)
    batch = impossible_travel(tx)
    closed = batch.filter(F.col("timestamp") < F.lit(cut) - F.expr("INTERVAL 10 MINUTES"))
    # every row of a window that closed is emitted; rows of still-open windows may be missing
    assert got.exceptAll(batch).count() == 0
    assert closed.exceptAll(got).count() == 0
    assert got.count() >= closed.count() > 1000


def glob_one(directory):
    import glob as _glob
    (path,) = _glob.glob(os.path.join(directory, "part-*.parquet"))
    return path


def test_fraud_writer_quarantines_constraint_violations(spark):
    from tripwire.schema import FRAUD_EVENT
    from datetime import datetime

    t = datetime(2024, 1, 1)
    batch = spark.createDataFrame([("U", t, "A", 9000.0, "US", "HIGH_VALUE_TRANSACTION"),
                                   ("U", t, "A", 9500.0, None, "HIGH_VALUE_TRANSACTION"),
                                   ("U" * 60, t, "A", 9900.0, "US", "HIGH_VALUE_TRANSACTION")], FRAUD_EVENT)
    root = tempfile.mkdtemp(prefix="quar-", dir="/tmp")
    writer = FraudTableWriter(root + "/table", quarantine_path=root + "/quarantine")
    writer(batch, 0)
    writer(batch, 0)      # replay
    assert [r["amount"] for r in read_fraud_table(spark, root + "/table").collect()] == [9000.0]
    bad = spark.read.parquet(root + "/quarantine").collect()
    assert sorted((r["amount"], tuple(r["violations"])) for r in bad) == [
        (9500.0, ("location IS NULL",)), (9900.0, ("user_id LONGER THAN 50",))]


def _stored_with(checkpoint):
    """State store classes named in a checkpoint's first offset file."""
    with open(os.path.join(checkpoint, "offsets", "0")) as fh:
        conf = json.loads(fh.read().splitlines()[1])["conf"]
    return conf["spark.sql.streaming.stateStore.providerClass"].rsplit(".", 1)[1]


def test_state_is_not_kept_on_the_heap(spark, monkeypatch):
    """Whatever the session's store: a heap map of ten windows an event fills the executors."""
    from tripwire.streaming import run

    root = tempfile.mkdtemp(prefix="store-", dir="/tmp")
    _write_files(root, [[_payload("U1", "00:00:10", "US"), _payload("U1", "00:05:00", "UK")], [_payload("W", "01:00:00", "US")]])
    key = "spark.sql.streaming.stateStore.providerClass"
    heap = "org.apache.spark.sql.execution.streaming.state.HDFSBackedStateStoreProvider"
    before = spark.conf.get(key)
    spark.conf.set(key, heap)
    paths = []
    fresh = run.fresh_path
    monkeypatch.setattr(run, "fresh_path", lambda s, name: paths.append(fresh(s, name)) or paths[-1])
    try:
        run_available_now(SD.stream_window_location_count(_stream(spark, root)), spark, "counts")
        table, sink = (tempfile.mkdtemp(prefix="store-sink-", dir="/tmp") for _ in range(2))
        start_fraud_sink(SD.stream_fraud(_stream(spark, root)), table, sink, available_now=True).awaitTermination()
        assert spark.conf.get(key) == heap          # the session's own setting is left alone
    finally:
        spark.conf.set(key, before)
    assert [_stored_with(p) for p in (paths[1], sink)] == ["RocksDBStateStoreProvider"] * 2
    assert read_fraud_table(spark, table).count() == 2
