"""Replay-safe append of micro-batches to a database table.

The rows of a batch are loaded in parallel into a *staging* table, marked with
query, batch and attempt.  Then one transaction on one connection

1. enters (query, batch) into the *ledger* table, whose key forbids a second entry,
2. copies the attempt's distinct rows from staging to the target table,
3. empties staging of the batch, whatever the attempt.

A batch repeated after the commit finds its ledger entry and does nothing; one
repeated before it starts over with an attempt of its own, so rows that a lost
attempt (or a task of it that is still running) left in staging are never copied.
A task that Spark repeats may load its rows twice: the copy takes them once, since
the rows of a batch differ from one another.

The statements are plain SQL; ``Connection`` is what they need of a database.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

MARKS = ("query_id", "batch_id", "attempt")


class Connection(Protocol):
    """A connection without automatic commits."""

    def execute(self, sql: str, *values) -> int: ...        # changed rows

    def query(self, sql: str, *values) -> list[tuple]: ...

    def commit(self) -> None: ...

    def rollback(self) -> None: ...

    def close(self) -> None: ...


class JdbcConnection:
    """A connection through the session's JDBC driver, opened on Spark's driver."""

    def __init__(self, spark: SparkSession, url: str, properties: dict[str, str]):
        jvm = spark._jvm
        settings = jvm.java.util.Properties()
        for name, value in properties.items():
            settings.setProperty(name, value)
        if "driver" in properties:
            jvm.java.lang.Class.forName(properties["driver"], True, jvm.java.lang.Thread.currentThread().getContextClassLoader())
        self.connection = jvm.java.sql.DriverManager.getConnection(url, settings)
        self.connection.setAutoCommit(False)

    def _prepared(self, sql: str, values: Sequence):
        statement = self.connection.prepareStatement(sql)
        for n, value in enumerate(values, 1):
            statement.setObject(n, value)
        return statement

    def execute(self, sql: str, *values) -> int:
        statement = self._prepared(sql, values)
        try:
            return statement.executeUpdate()
        finally:
            statement.close()

    def query(self, sql: str, *values) -> list[tuple]:
        statement = self._prepared(sql, values)
        try:
            found, out = statement.executeQuery(), []
            width = found.getMetaData().getColumnCount()
            while found.next():
                out.append(tuple(found.getObject(i + 1) for i in range(width)))
            return out
        finally:
            statement.close()

    def commit(self) -> None:
        self.connection.commit()

    def rollback(self) -> None:
        self.connection.rollback()

    def close(self) -> None:
        self.connection.close()


@dataclass
class LedgerAppend:
    """Appends batches to ``table`` once each."""

    url: str
    table: str = "fraud_transactions"
    properties: dict[str, str] = field(default_factory=dict)
    ledger: str = "stream_ledger"
    staging: str | None = None                                   # default: <table>_staging
    connect: Callable[[SparkSession], Connection] | None = None   # default: JDBC
    load: Callable[[DataFrame, str], None] | None = None          # default: Spark's JDBC writer

    @property
    def stage(self) -> str:
        return self.staging or f"{self.table}_staging"

    def definitions(self, columns: dict[str, str]) -> list[str]:
        """Statements that create ledger and staging (``columns``: the target's names and SQL types)."""
        own = ", ".join(f"{name} {kind}" for name, kind in columns.items())
        return [f"CREATE TABLE IF NOT EXISTS {self.ledger} (query_id VARCHAR(64) NOT NULL, batch_id BIGINT NOT NULL, "
                f"target VARCHAR(128) NOT NULL, committed_at TIMESTAMP DEFAULT CURRENT_TIMESTAMP, "
                f"PRIMARY KEY (query_id, batch_id, target))",
                f"CREATE TABLE IF NOT EXISTS {self.stage} ({own}, query_id VARCHAR(64), batch_id BIGINT, attempt VARCHAR(64))"]

    def _connection(self, spark: SparkSession) -> Connection:
        return self.connect(spark) if self.connect else JdbcConnection(spark, self.url, self.properties)

    def _done(self, connection: Connection, query_id: str, batch_id: int) -> bool:
        return bool(connection.query(f"SELECT 1 FROM {self.ledger} WHERE query_id = ? AND batch_id = ? AND target = ?",
                                     query_id, batch_id, self.table))

    def __call__(self, rows: DataFrame, query_id: str, batch_id: int) -> bool:
        """Appends the rows (distinct ones) unless the ledger has the batch; whether it did."""
        spark, columns = rows.sparkSession, ", ".join(rows.columns)
        connection = self._connection(spark)
        try:
            if self._done(connection, query_id, batch_id):
                connection.rollback()
                return False
            connection.rollback()        # holds nothing while the rows are loaded
            attempt = uuid.uuid4().hex
            marked = rows.select("*", F.lit(query_id).alias("query_id"), F.lit(batch_id).cast("long").alias("batch_id"),
                                 F.lit(attempt).alias("attempt"))
            if self.load:
                self.load(marked, self.stage)
            else:
                marked.write.jdbc(self.url, self.stage, mode="append", properties=self.properties)
            try:
                if self._done(connection, query_id, batch_id):
                    connection.execute(f"DELETE FROM {self.stage} WHERE attempt = ?", attempt)
                    connection.commit()
                    return False
                connection.execute(f"INSERT INTO {self.ledger} (query_id, batch_id, target) VALUES (?, ?, ?)",
                                   query_id, batch_id, self.table)
                connection.execute(f"INSERT INTO {self.table} ({columns}) SELECT DISTINCT {columns} FROM {self.stage} "
                                   f"WHERE query_id = ? AND batch_id = ? AND attempt = ?", query_id, batch_id, attempt)
                connection.execute(f"DELETE FROM {self.stage} WHERE query_id = ? AND batch_id = ?", query_id, batch_id)
                connection.commit()
            except BaseException:
                connection.rollback()
                raise
            return True
        finally:
            connection.close()
