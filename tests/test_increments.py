"""Incremental totals: equal to the full scan, summed batches unread, repeats and half-done batches."""

from __future__ import annotations

import glob
import tempfile
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from tripwire.functions.formatting import format_integer
from tripwire.operators import increments as I
from tripwire.operators.reconcile import validated_totals
from tripwire.schema import TRANSACTION
from tripwire.sinks.files import append_reconciliation_row
from tripwire.sinks.fraud_table import FraudTableWriter
from tripwire.streaming.speed_layer import SpeedLayer, read_rows


def _batch(spark, n):
    rows = [("U", datetime(2024, 1, 1, h, n), "A", a, "US") for h, a in ((n, 0.1 + n), (n + 1, 1e25), (0, float("nan")), (5, None))]
    return spark.createDataFrame([*rows, ("V", None, "A", 3.3, None)], TRANSACTION)


@pytest.fixture
def layer(spark):
    base = tempfile.mkdtemp(prefix="inc-", dir="/tmp")

    def run(n, query="q"):
        SpeedLayer(base, query_id=query, writer=FraudTableWriter(base + "/fraud", query_id=query))(_batch(spark, n), n)
    return base, base + "/sums", run


def _same(spark, base, sums):
    got, want = I.merged_totals(I.partial_sums(spark, sums)).first(), validated_totals(read_rows(spark, base)).first()
    assert got == want and got.transaction_count > 0


def test_totals_equal_the_full_scan(spark, layer):
    base, sums, run = layer
    assert not I.advance(spark, base, sums) and I.merged_totals(I.partial_sums(spark, sums)).first() == (0, 0.0)
    run(0)
    assert I.advance(spark, base, sums) and not I.advance(spark, base, sums)
    _same(spark, base, sums)
    run(1)
    run(2)
    run(0, "other")
    plan = I.unsummed(spark, base, sums)
    scan = plan._jdf.queryExecution().executedPlan().toString()
    assert "query_id" in scan.split("PartitionFilters: [")[1].split("PushedFilters")[0]
    # summed batches are not read: broken files there do no harm
    summed = {f: open(f, "rb").read() for f in glob.glob(f"{base}/validated/query_id=q/batch_id=0/*.parquet")}
    for f in summed:
        with open(f, "wb") as out:
            out.write(b"broken")
    assert {(r.query_id, r.batch_id) for r in plan.collect()} == {("q", 1), ("q", 2), ("other", 0)}
    assert I.advance(spark, base, sums) and I.marks(spark, sums) == {"q": 2, "other": 0}
    for f, content in summed.items():
        with open(f, "wb") as out:
            out.write(content)
    _same(spark, base, sums)
    hours = {r.hour and r.hour.hour: r.transaction_count for r in I.hourly_totals(I.partial_sums(spark, sums)).collect()}
    assert sum(hours.values()) == 20 and hours[None] == 4


def test_repeat_and_half_done(spark, layer, monkeypatch):
    base, sums, run = layer
    run(0)
    assert I.advance(spark, base, sums)
    run(1)
    # the run wrote its sums, and is repeated because it was reported as failed
    before = I.marks(spark, sums)
    I.advance(spark, base, sums)
    monkeypatch.setattr(I, "marks", lambda *a: before)
    I.advance(spark, base, sums)
    monkeypatch.undo()
    _same(spark, base, sums)
    # a batch whose state is not written yet is not summed
    _batch(spark, 2).write.parquet(f"{base}/validated/query_id=q/batch_id=2")
    assert not I.advance(spark, base, sums)
    run(2)
    assert I.advance(spark, base, sums)
    _same(spark, base, sums)


def test_repeated_report_row(spark):
    row = spark.createDataFrame([(datetime(2024, 1, 1), 3)], "report_date timestamp, total_transactions long")
    path = tempfile.mkdtemp(prefix="row-", dir="/tmp") + "/t"
    for run in ("20240101_000000", "20240101_000000", "20240101_060000"):
        append_reconciliation_row(row, path=path, run=run)
    assert spark.read.parquet(path).count() == 2


def test_large_integers(spark):
    values = [1e19, -1e19, 2.0 ** 70, 1e37, float("inf"), float("-inf"), float("nan"), None, 12345.9, -0.5, 9.3e18]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v double")
    got = [r[0] for r in df.orderBy("i").select(format_integer("v")).collect()]
    assert got == ["10,000,000,000,000,000,000", "-10,000,000,000,000,000,000", got[2], f"{10 ** 37:,}", "Infinity", "-Infinity", "0", "0",
                   "12,345", "0", "9,300,000,000,000,000,000"]
    assert int(got[2].replace(",", "")) == pytest.approx(2 ** 70)
    assert df.select(F.max("i")).first()[0] == 10
