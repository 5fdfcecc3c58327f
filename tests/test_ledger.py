"""The database append: statements and their order, and every batch once through failures at any step."""

from __future__ import annotations

import tempfile
from collections import Counter
from datetime import datetime

import duckdb
import pytest
from pyspark.sql import functions as F

from tripwire.schema import FRAUD_EVENT
from tripwire.sinks.fraud_table import FraudTableWriter, read_fraud_table
from tripwire.sinks.ledger import LedgerAppend

T0 = datetime(2024, 1, 1)
COLUMNS = {"user_id": "VARCHAR", "amount": "DOUBLE"}


class Base:
    """A database in this process, with what is done to it noted; ``fail``: the step that breaks."""

    def __init__(self, columns=COLUMNS):
        self.db, self.log, self.fail = duckdb.connect(), [], None
        own = ", ".join(f"{c} {t}" for c, t in columns.items())
        self.append = LedgerAppend("jdbc:none", "target", connect=lambda spark: self, load=self.load)
        self.db.execute(f"CREATE TABLE target ({own})")
        for statement in self.append.definitions(columns):
            self.db.execute(statement)
        self.open = False

    def _step(self, name):
        self.log.append(name)
        if self.fail == name:
            self.fail = None
            raise RuntimeError(name)

    def _begin(self):
        if not self.open:
            self.db.execute("BEGIN")
            self.open = True

    def execute(self, sql, *values):
        self._begin()
        self.db.execute(sql, list(values))
        self._step(" ".join(sql.split()[:3]))
        return 0

    def query(self, sql, *values):
        self._begin()
        self._step("SELECT ledger")
        return self.db.execute(sql, list(values)).fetchall()

    def commit(self):
        self._step("COMMIT")
        self.db.execute("COMMIT")
        self.open = False
        self._step("committed")

    def rollback(self):
        if self.open:
            self.db.execute("ROLLBACK")
            self.open = False

    def close(self):
        self.log.append("close")

    def load(self, rows, table):
        marks = ", ".join("?" for _ in rows.columns)
        for n, row in enumerate(rows.collect()):
            self.db.execute(f"INSERT INTO {table} ({', '.join(rows.columns)}) VALUES ({marks})", list(row))
            if n == 0:
                self._step("first row")
        self._step("loaded")

    def rows(self, table="target"):
        return Counter(self.db.execute(f"SELECT * FROM {table}").fetchall())


@pytest.fixture
def batch(spark):
    return spark.createDataFrame([("a", 1.0), ("b", 2.0), ("b", 2.0)], "user_id string, amount double")


def test_order_of_statements(batch):
    base = Base()
    assert base.append(batch, "q", 0)
    assert base.log == ["SELECT ledger", "first row", "loaded", "SELECT ledger", "INSERT INTO stream_ledger", "INSERT INTO target",
                        "DELETE FROM target_staging", "COMMIT", "committed", "close"]
    assert base.rows() == {("a", 1.0): 1, ("b", 2.0): 1} and not base.rows("target_staging")
    base.log.clear()
    assert not base.append(batch, "q", 0) and base.log == ["SELECT ledger", "close"]
    assert base.append(batch, "q", 1) and base.append(batch, "other", 0)
    assert base.rows() == {("a", 1.0): 3, ("b", 2.0): 3}


@pytest.mark.parametrize("step", ["SELECT ledger", "first row", "loaded", "INSERT INTO stream_ledger", "INSERT INTO target",
                                  "DELETE FROM target_staging", "COMMIT", "committed"])
def test_replay_after_a_failure_at_any_step(batch, step):
    base = Base()
    base.fail = step
    with pytest.raises(RuntimeError):
        base.append(batch, "q", 4)
    base.append(batch, "q", 4)
    base.append(batch, "q", 4)
    assert base.rows() == {("a", 1.0): 1, ("b", 2.0): 1} and not base.rows("target_staging")
    assert base.db.execute("SELECT query_id, batch_id, target FROM stream_ledger").fetchall() == [("q", 4, "target")]


def test_rows_of_a_lost_attempt_are_not_copied(batch, spark):
    base = Base()
    base.db.execute("INSERT INTO target_staging VALUES ('ghost', 9.0, 'q', 0, 'lost attempt')")
    base.append(batch, "q", 0)
    assert base.rows() == {("a", 1.0): 1, ("b", 2.0): 1} and not base.rows("target_staging")


def test_two_attempts_at_once(batch):
    """The other attempt commits while this one loads: the ledger is asked again."""
    base = Base()
    inner = LedgerAppend("jdbc:none", "target", connect=lambda spark: base, load=base.load)

    def load(rows, table):
        base.load(rows, table)
        assert inner(batch, "q", 0)

    assert not LedgerAppend("jdbc:none", "target", connect=lambda spark: base, load=load)(batch, "q", 0)
    assert base.rows() == {("a", 1.0): 1, ("b", 2.0): 1} and not base.rows("target_staging")


def test_fraud_writer_appends_each_batch_once(spark):
    columns = {"user_id": "VARCHAR", "timestamp": "TIMESTAMP", "merchant_category": "VARCHAR", "amount": "DOUBLE",
               "location": "VARCHAR", "fraud_reason": "VARCHAR", "detected_at": "TIMESTAMP"}
    base = Base(columns)
    rows = spark.createDataFrame([("U", T0, "A", 9000.0, "US", "HIGH_VALUE_TRANSACTION")], FRAUD_EVENT)
    path = tempfile.mkdtemp(prefix="ledger-", dir="/tmp") + "/t"
    writer = FraudTableWriter(path, jdbc_url="jdbc:none", database=base.append, query_id="q")
    base.fail = "committed"
    with pytest.raises(RuntimeError):
        writer(rows, 0)
    writer(rows, 0)
    writer(rows.withColumn("amount", F.lit(9500.0)), 1)
    assert sorted(r[3] for r in base.rows()) == [9000.0, 9500.0] == sorted(r.amount for r in read_fraud_table(spark, path).collect())
