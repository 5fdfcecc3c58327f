"""Report files, reconciliation rows, named views, the two-query pipeline."""

import glob
import os
import tempfile
from datetime import datetime, timezone

from pyspark.sql import functions as F

from tripwire.operators import analytics as A
from tripwire.operators import reconcile as R
from tripwire.schema import FRAUD_EVENT, TRANSACTION
from tripwire.sinks.files import append_reconciliation_row, write_csv_report
from tripwire.sources import validated_scan
from tripwire.sources.views import register_views

NOW = datetime(2024, 1, 1, 12)


def test_csv_report_round_trip(spark):
    fraud = spark.createDataFrame([("U", NOW, "A", 10.0, "US", "R"), ("V", NOW, "B", 30.0, "UK", "R")],
                                  FRAUD_EVENT)
    d = tempfile.mkdtemp(prefix="reports-", dir="/tmp")
    path = write_csv_report(A.by_category(fraud), d, "fraud_by_category", "20240101_120000")
    assert path.endswith("fraud_by_category_20240101_120000")
    back = spark.read.option("header", True).option("inferSchema", True).csv(path)
    assert sorted((r["merchant_category"], r["fraud_count"]) for r in back.collect()) == [("A", 1), ("B", 1)]
    assert write_csv_report(A.by_category(fraud.limit(0)), d, "empty", "x", skip_empty=True) is None
    assert len(glob.glob(os.path.join(path, "part-*.csv"))) == 1


def test_reconciliation_row_append(spark):
    tx = spark.createDataFrame([("U", NOW, "A", 10.0, "US")], TRANSACTION)
    fraud = spark.createDataFrame([("U", NOW, "A", 10.0, "US", "R")], FRAUD_EVENT)
    path = tempfile.mkdtemp(prefix="recon-", dir="/tmp") + "/table"
    for _ in range(2):
        append_reconciliation_row(R.recon_table_row(tx, fraud, as_of=NOW, report_time=F.lit(NOW)), path=path)
    rows = spark.read.parquet(path).collect()
    assert len(rows) == 2 and rows[0]["total_transactions"] == 2 and rows[0]["total_amount"] == 20.0


def test_named_views(spark):
    tx = spark.createDataFrame([("U", NOW, "A", 10.0, "US")], TRANSACTION)
    fraud = spark.createDataFrame([("U", NOW, "A", 10.0, "US", "R")], FRAUD_EVENT)
    register_views(fraud, tx)
    assert spark.sql("SELECT count(*) FROM fraud_view").first()[0] == 1
    assert spark.sql("SELECT sum(amount) FROM transactions_view").first()[0] == 10.0


def test_validated_scan_empty_and_recursive(spark):
    missing = tempfile.mkdtemp(prefix="val-", dir="/tmp") + "/nothing-here"
    assert validated_scan(spark, missing).count() == 0
    tree = tempfile.mkdtemp(prefix="val-tree-", dir="/tmp")
    tx = spark.createDataFrame([("U", NOW, "A", 10.0, "US")], TRANSACTION)
    tx.write.parquet(tree + "/a/b")
    tx.write.parquet(tree + "/c")
    assert validated_scan(spark, tree, written_by_stream=False).count() == 2


def test_pipeline_runs_both_queries(spark):
    import json

    from tripwire.sinks.fraud_table import read_fraud_table
    from tripwire.streaming.ingest import payload_transactions
    from tripwire.streaming.run import run_pipeline

    src = tempfile.mkdtemp(prefix="pipe-src-", dir="/tmp")
    lines = [json.dumps({"user_id": "U", "timestamp": t, "merchant_category": "X", "amount": a, "location": loc})
             for t, a, loc in [("2024-01-01T00:00:10", 9000.0, "US"), ("2024-01-01T00:01:00", 1.0, "UK"),
                               ("2024-01-01T03:00:00", 1.0, "US")]]
    with open(os.path.join(src, "p.json"), "w") as fh:
        fh.write("\n".join(lines) + "\n")
    base = tempfile.mkdtemp(prefix="pipe-out-", dir="/tmp")
    fq, vq = run_pipeline(spark, payload_transactions(spark, src), base, available_now=True)
    fq.awaitTermination()
    vq.awaitTermination()
    assert spark.table("fraud_view").isStreaming and spark.table("transactions_view").isStreaming
    assert validated_scan(spark, base + "/validated").count() == 3
    got = sorted((r["amount"], r["fraud_reason"]) for r in read_fraud_table(spark, base + "/fraud").collect())
    assert got == [(1.0, "IMPOSSIBLE_TRAVEL"), (9000.0, "HIGH_VALUE_TRANSACTION"), (9000.0, "IMPOSSIBLE_TRAVEL")]


def test_jobs_write_all_outputs(spark):
    from tripwire.plans.jobs import reconciliation_job, report_job

    tx = spark.createDataFrame([("U", NOW, "A", 10.0, "US"), ("U", NOW, "A", 9000.0, "UK")], TRANSACTION)
    fraud = spark.createDataFrame([("U", NOW, "A", 9000.0, "UK", "HIGH_VALUE_TRANSACTION")], FRAUD_EVENT)
    d = tempfile.mkdtemp(prefix="jobs-", dir="/tmp")
    rec = reconciliation_job(spark, tx, fraud, d, NOW, table_path=d + "/recon_table")
    assert rec["reconciliation"] and rec["fraud_analysis"]
    row = spark.read.option("header", True).csv(rec["reconciliation"]).first()
    assert row["total_transactions"] == "3" and row["fraud_transactions"] == "1"
    rep = report_job(spark, fraud, d, now=NOW)
    assert all(rep[k] for k in ["fraud_by_category", "fraud_by_reason_formatted", "summary"])
    assert rep["amount_density"] is None          # one amount: no spread, no curve


def test_command_line_jobs(spark, capsys):
    import json

    from tripwire.__main__ import main

    src = tempfile.mkdtemp(prefix="cli-src-", dir="/tmp")
    now = datetime.now(timezone.utc).replace(tzinfo=None, microsecond=0)
    rows = [(now, 9000.0, "US"), (now, 1.0, "UK")]
    with open(os.path.join(src, "p.json"), "w") as fh:
        for t, a, loc in rows:
            fh.write(json.dumps({"user_id": "U", "timestamp": t.isoformat(), "merchant_category": "X",
                                 "amount": a, "location": loc}) + "\n")
    base = tempfile.mkdtemp(prefix="cli-out-", dir="/tmp")
    reports = tempfile.mkdtemp(prefix="cli-rep-", dir="/tmp")
    assert main(["stream", "--source-dir", src, "--output", base, "--available-now"]) == 0
    # the watermark never passed the window: only the high-value row is in the table yet
    assert main(["reconcile", "--output", base, "--reports", reports]) == 0
    assert main(["report", "--output", base, "--reports", reports, "--hours", "24"]) == 0
    printed = capsys.readouterr().out
    assert "reconciliation\t" in printed and "fraud_by_category\t" in printed
    rec = spark.read.option("header", True).csv(
        [ln.split("\t")[1] for ln in printed.splitlines() if ln.startswith("reconciliation\t")][0]).first()
    assert (rec["validated_transactions"], rec["fraud_transactions"]) == ("2", "1")


def test_validated_scan_uses_the_sink_commit_log(spark):
    """A file in the sink directory that no committed batch lists (a partial
    write) is not counted: reading the sink root goes through its commit log
    (in both modes); only a direct file glob would count it."""
    import json

    from tripwire.streaming.ingest import payload_transactions
    from tripwire.streaming.run import start_validated_sink

    src = tempfile.mkdtemp(prefix="commit-src-", dir="/tmp")
    with open(os.path.join(src, "p.json"), "w") as fh:
        fh.write(json.dumps({"user_id": "U", "timestamp": "2024-01-01T00:00:00", "merchant_category": "X",
                             "amount": 1.0, "location": "US"}) + "\n")
    out = tempfile.mkdtemp(prefix="commit-out-", dir="/tmp")
    start_validated_sink(payload_transactions(spark, src), out, out + "-ckpt",
                         available_now=True).awaitTermination()
    stray = spark.createDataFrame([("V", NOW, "A", 5.0, "UK")], TRANSACTION)
    stray.coalesce(1).write.parquet(out + "/uncommitted")
    assert validated_scan(spark, out).count() == 1
    assert validated_scan(spark, out, written_by_stream=False).count() == 1
    import glob as _glob
    files = _glob.glob(out + "/**/*.parquet", recursive=True)
    assert spark.read.parquet(*files).count() == 2        # the direct glob sees the stray file


def test_csv_numbers_are_plain_decimals(spark):
    df = spark.createDataFrame([(12407664.25, 0.05, 100.0, -2.5e-7, None)], "a double, b double, c double, d double, e double")
    d = tempfile.mkdtemp(prefix="csvnum-", dir="/tmp")
    path = write_csv_report(df, d, "n", "x")
    (line,) = [ln for ln in open(glob.glob(os.path.join(path, "part-*.csv"))[0]).read().splitlines()[1:]]
    assert line == "12407664.25,0.05,100.0,-0.00000025,"


def _batch(spark, rows):
    return spark.createDataFrame(rows, "user_id string, timestamp timestamp, merchant_category string, amount double, "
                                       "location string, fraud_reason string")


def test_two_writers_keep_all_rows(spark, tmp_path):
    """A second query, or a fresh checkpoint, starts at batch 0 again."""
    from datetime import datetime

    from tripwire.sinks.fraud_table import FraudTableWriter, read_fraud_table

    path, t = str(tmp_path / "fraud"), datetime(2024, 1, 1, 12)
    old, new = ("OLD", t, "A", 9000.0, "US", "R"), ("NEW", t, "A", 9000.0, "US", "R")
    FraudTableWriter(path, query_id="q1")(_batch(spark, [old]), 0)
    FraudTableWriter(path, query_id="q2")(_batch(spark, [old, new]), 0)
    FraudTableWriter(path, query_id="q2")(_batch(spark, [old, new]), 0)         # replayed
    FraudTableWriter(path, query_id="q1")(_batch(spark, [new]), 1)
    assert sorted(r["user_id"] for r in read_fraud_table(spark, path).collect()) == ["NEW", "OLD"]


def test_row_without_time_is_stored_once(spark, tmp_path):
    from datetime import datetime

    from tripwire.sinks.fraud_table import FraudTableWriter, read_fraud_table

    path = str(tmp_path / "fraud")
    undated = ("U", None, "A", 9000.0, "US", "R")
    dated = ("U", datetime(2024, 1, 1), "A", 9000.0, "US", "R")
    writer = FraudTableWriter(path, query_id="q")
    for n, rows in enumerate(([undated], [undated, dated], [dated], [undated], [])):
        writer(_batch(spark, rows), n)
    assert read_fraud_table(spark, path).count() == 2


def test_one_file_per_date_and_batch(spark, tmp_path):
    from datetime import datetime, timedelta

    from tripwire.sinks.fraud_table import FraudTableWriter

    rows = [(f"U{i}", datetime(2024, 1, 1) + timedelta(hours=i), "A", 9000.0, "US", "R") for i in range(96)]
    FraudTableWriter(str(tmp_path / "fraud"), query_id="q")(_batch(spark, rows).repartition(8), 0)
    assert len(list((tmp_path / "fraud").rglob("part-*.parquet"))) == 4


def test_backfill_over_many_dates(spark, tmp_path):
    from datetime import datetime, timedelta

    from tripwire.sinks.fraud_table import FraudTableWriter, read_fraud_table

    rows = [(f"U{i}", datetime(2023, 1, 1) + timedelta(days=i), "A", 9000.0, "US", "R") for i in range(100)]
    path = str(tmp_path / "fraud")
    FraudTableWriter(path, query_id="q")(_batch(spark, rows), 0)
    FraudTableWriter(path, query_id="q")(_batch(spark, rows + [("X", None, "A", 9000.0, "US", "R")]), 1)
    assert read_fraud_table(spark, path).count() == 101


def test_csv_doubles_survive(spark, tmp_path):
    from tripwire.sinks.files import write_csv_report

    values = [2.5e-13, 12407664.25, 1e300, 0.1, 0.1 + 0.2, 5.0, -0.015]
    target = write_csv_report(spark.createDataFrame([(v,) for v in values], "x double"), str(tmp_path), "t", "s")
    got = spark.read.option("header", True).csv(target)
    assert sorted(float(r["x"]) for r in got.collect()) == sorted(values)
    assert {"12407664.25", "5.0"} <= {r["x"] for r in got.collect()}


def test_database_read_options(spark):
    import pytest

    from tripwire.sources.scans import fraud_jdbc_scan, jdbc_options

    got = jdbc_options("jdbc:x://h/db", hours=6, as_of="2024-01-01 12:00:00", partitions=4, properties={"user": "u"})
    assert got == {"url": "jdbc:x://h/db", "user": "u", "numPartitions": "4", "partitionColumn": "timestamp",
                   "dbtable": "(SELECT * FROM fraud_transactions WHERE timestamp >= TIMESTAMP '2024-01-01 06:00:00') AS fraud",
                   "lowerBound": "2024-01-01 06:00:00", "upperBound": "2024-01-01 12:00:00"}
    assert jdbc_options("jdbc:x://h/db") == {"url": "jdbc:x://h/db", "dbtable": "fraud_transactions"}
    with pytest.raises(Exception, match="(?i)driver"):
        fraud_jdbc_scan(spark, "jdbc:x://h/db")
