"""File and table outputs of the batch and report layers."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.session import shared_dir
from tripwire.sinks.ledger import LedgerAppend


def _plain_number(c: Column) -> Column:
    """A double as plain decimal text (``12407664.25``, not ``1.240766425E7``)
    where twelve decimals hold its value; else its shortest exact text."""
    exact = c.try_cast("decimal(38,12)")
    trimmed = F.regexp_replace(F.regexp_replace(exact.cast("string"), r"(\.\d*?)0+$", "$1"), r"\.$", ".0")
    return F.coalesce(F.when(exact.cast("double") == c, trimmed), c.cast("string"))


def _csv_ready(df: DataFrame) -> DataFrame:
    return df.select(*[_plain_number(F.col(f.name)).alias(f.name)
                       if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
                       for f in df.schema.fields])


def write_csv_report(df: DataFrame, directory: str, name: str, stamp: str,
                     skip_empty: bool = False) -> str | None:
    """A report table as a header CSV directory ``<directory>/<name>_<stamp>``.
    Small report tables are written as a single part file."""
    if skip_empty:
        # computed once: the table decides and is written from here
        shared_dir(df.sparkSession)
        df = df.checkpoint(eager=True)
        if df.isEmpty():
            return None
    target = f"{directory.rstrip('/')}/{name}_{stamp}"
    _csv_ready(df).coalesce(1).write.mode("overwrite").option("header", True).csv(target)
    return target


def append_reconciliation_row(row: DataFrame, path: str | None = None, table: str | None = None,
                              jdbc_url: str | None = None, properties: dict | None = None,
                              run: str | None = None, database: LedgerAppend | None = None) -> None:
    """Append the one-row reconciliation record to a Parquet path, a catalog
    table or a JDBC table.  ``run`` names the report (its time): repeating a run
    replaces its row under the path (``run=<run>``), skips a catalog table that has
    its ``report_date``, and is appended to a database once (``ledger``)."""
    if path and run:
        row.write.mode("overwrite").parquet(f"{path.rstrip('/')}/run={run}")
    elif path:
        row.write.mode("append").parquet(path)
    if table:
        spark = row.sparkSession
        if run and spark.catalog.tableExists(table):
            shared_dir(spark)
            row = row.join(spark.table(table).select("report_date"), "report_date", "left_anti").checkpoint(eager=True)
        row.write.mode("append").saveAsTable(table)
    if jdbc_url and run:
        append = database or LedgerAppend(jdbc_url, "reconciliation_reports", properties or {})
        append(row, f"reconciliation-{run}", 0)
    elif jdbc_url:
        row.write.jdbc(jdbc_url, "reconciliation_reports", mode="append", properties=properties or {})
