"""Compaction of closed dates: every row once through a crash at any step."""

from __future__ import annotations

import glob
import tempfile
from collections import Counter
from datetime import date, datetime

import pytest

from tripwire.schema import FRAUD_COLUMNS, FRAUD_EVENT
from tripwire.sinks import compaction as C
from tripwire.sinks.fraud_table import FraudTableWriter, compact_fraud_table, read_fraud_table

OPEN = date(2024, 1, 3)


def _rows(spark, *rows):
    return spark.createDataFrame([(u, datetime(2024, 1, d) if d else None, "A", a, "US", "HIGH_VALUE_TRANSACTION") for u, d, a in rows], FRAUD_EVENT)


def _read(spark, root):
    return Counter((r.user_id, r.timestamp and r.timestamp.day, r.amount) for r in read_fraud_table(spark, root).collect())


@pytest.fixture
def table(spark):
    root = tempfile.mkdtemp(prefix="compact-", dir="/tmp") + "/t"
    writer = FraudTableWriter(root, query_id="q")
    for n in range(3):
        writer(_rows(spark, ("a", 1, n + 1.0), ("b", 2, n + 1.0), ("c", 3, n + 1.0), ("none", None, n + 1.0)), n)
    return root, writer


def test_one_file_a_closed_date(spark, table):
    root, writer = table
    before = _read(spark, root)
    assert len(before) == 12 and set(before.values()) == {1}
    assert compact_fraud_table(spark, root, OPEN) == ["2024-01-01", "2024-01-02"]
    assert _read(spark, root) == before
    files = glob.glob(f"{root}/_compacted/run=*/event_date=*/*.parquet")
    assert len(files) == 2
    assert compact_fraud_table(spark, root, OPEN) == []          # nothing new
    C.vacuum(spark, root)
    C.vacuum(spark, root)
    assert _read(spark, root) == before and len(glob.glob(f"{root}/event_date=2024-01-0[12]/*/batch_id=*")) == 0
    assert len(glob.glob(f"{root}/event_date=2024-01-03/*/batch_id=*")) == 3
    # a repeated batch stays covered, known rows are not stored again, late rows of a closed date are
    writer(_rows(spark, ("a", 1, 3.0), ("b", 2, 3.0), ("c", 3, 3.0), ("none", None, 3.0)), 2)
    assert _read(spark, root) == before
    writer(_rows(spark, ("a", 1, 1.0), ("late", 1, 9.0), ("d", 4, 1.0)), 3)
    late = before + Counter({("late", 1, 9.0): 1, ("d", 4, 1.0): 1})
    assert _read(spark, root) == late
    assert compact_fraud_table(spark, root, OPEN) == ["2024-01-01"]
    C.vacuum(spark, root)
    assert _read(spark, root) == late and len(glob.glob(f"{root}/_compacted/run=*/event_date=2024-01-01/*.parquet")) == 1


def test_dates_are_pruned(spark, table):
    root, _ = table
    compact_fraud_table(spark, root, OPEN)
    plan = read_fraud_table(spark, root).filter("event_date = date'2024-01-02'")
    scans = [x for x in plan._jdf.queryExecution().executedPlan().toString().split("\n") if "FileScan" in x]
    assert len(scans) == 2 and all("PartitionFilters: [isnotnull(event_date" in x for x in scans)
    assert Counter(r.user_id for r in plan.collect()) == {"b": 3}


@pytest.mark.parametrize("step", ["written", "published", "first delete", "second delete"])
def test_crash_at_any_step(spark, table, monkeypatch, step):
    root, writer = table
    before = _read(spark, root)
    publish, delete, deleted = C.Folder.publish, C.Folder.delete, []

    def failing_publish(self, name, text):
        if step == "written":
            raise RuntimeError(step)
        publish(self, name, text)
        if step == "published":
            raise RuntimeError(step)

    def failing_delete(self, name):
        deleted.append(name)
        if step == "first delete" or len(deleted) > 1:
            raise RuntimeError(step)
        delete(self, name)

    monkeypatch.setattr(C.Folder, "publish", failing_publish)
    monkeypatch.setattr(C.Folder, "delete", failing_delete)
    with pytest.raises(RuntimeError):
        compact_fraud_table(spark, root, OPEN)
        C.vacuum(spark, root)
    assert _read(spark, root) == before
    monkeypatch.undo()
    compact_fraud_table(spark, root, OPEN)
    assert _read(spark, root) == before
    C.vacuum(spark, root)
    assert _read(spark, root) == before
    assert len(glob.glob(f"{root}/_compacted/run=*/event_date=*/*.parquet")) == 2
    assert Counter(read_fraud_table(spark, root).columns)["event_date"] == 1 and set(FRAUD_COLUMNS) <= set(read_fraud_table(spark, root).columns)


def test_second_compaction_fails_at_the_switch(spark, table, monkeypatch):
    root, _ = table
    before, publish = _read(spark, root), C.Folder.publish

    def raced(self, name, text):
        publish(self, name, text)
        publish(self, name, text)

    monkeypatch.setattr(C.Folder, "publish", raced)
    with pytest.raises(RuntimeError, match="another"):
        compact_fraud_table(spark, root, OPEN)
    assert _read(spark, root) == before
