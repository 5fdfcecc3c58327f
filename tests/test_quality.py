import tempfile
import time
from collections import Counter
from datetime import datetime

from pyspark.sql import Observation

from tripwire.operators.quality import QualityListener, constraint_violations, observed, rules, split_valid
from tripwire.schema import FRAUD_EVENT


def test_each_constraint_reports_once(spark):
    t = datetime(2024, 1, 1)
    good = ("U", t, "X", 1.0, "US", "R")
    rows = [good]
    for i in range(6):
        r = list(good)
        r[i] = None
        rows.append(tuple(r))
    rows.append(("U", t, "X", 1.0, "ABCDEFGHIJK", "R"))
    rows.append(("U" * 51, t, "X", 1.0, "US", "R"))
    df = spark.createDataFrame(rows, FRAUD_EVENT)
    got = [r["violations"] for r in constraint_violations(df).collect()]
    assert got[0] == []
    assert all(len(v) == 1 for v in got[1:])
    assert got[7] == ["location LONGER THAN 10"]
    assert got[8] == ["user_id LONGER THAN 50"]
    valid, quarantine = split_valid(df)
    assert valid.count() == 1 and quarantine.count() == 8


def _bad_rows():
    t = datetime(2024, 1, 1)
    good = ("U", t, "X", 1.0, "US", "R")
    bad = [tuple(None if i == j else v for j, v in enumerate(good)) for i in range(6)]
    return [good] * 5 + bad + [("U" * 51, t, "X", 1.0, "ABCDEFGHIJK", "R"), (None,) * 6]


def _expected(spark, rows):
    df = spark.createDataFrame(rows, FRAUD_EVENT)
    figures = Counter(v for r in constraint_violations(df).collect() for v in r["violations"])
    figures = {m: figures.get(m, 0) for m in rules(df)}
    return {**figures, "rows": len(rows), "bad_rows": split_valid(df)[1].count()}


def test_figures_of_a_batch_come_with_its_one_pass(spark):
    rows, seen = _bad_rows(), Observation()
    df = observed(spark.createDataFrame(rows, FRAUD_EVENT), seen)
    assert df.count() == len(rows) and seen.get == _expected(spark, rows)


def test_stream_figures_equal_the_quarantine(spark):
    where = tempfile.mkdtemp(prefix="quality-", dir="/tmp")
    rows = _bad_rows()
    for _ in range(3):
        spark.createDataFrame(rows, FRAUD_EVENT).coalesce(1).write.mode("append").parquet(f"{where}/in")
    alerts = []
    listener = QualityListener(most_bad=0.5, alert=lambda *a: alerts.append(a))
    spark.streams.addListener(listener)
    try:
        stream = spark.readStream.schema(FRAUD_EVENT).option("maxFilesPerTrigger", 1).parquet(f"{where}/in")
        query = (observed(stream).writeStream.format("parquet").option("path", f"{where}/out")
                 .option("checkpointLocation", f"{where}/ckpt").trigger(availableNow=True).start())
        query.awaitTermination()
        until = time.time() + 30
        while listener.totals(str(query.id)).get("rows", 0) < 3 * len(rows) and time.time() < until:
            time.sleep(0.2)
    finally:
        spark.streams.removeListener(listener)
    assert listener.totals(str(query.id)) == _expected(spark, rows * 3)
    assert [(b, round(s, 3)) for _, b, s in alerts] == [(n, round(8 / 13, 3)) for n in range(3)]


def test_repeated_and_old_batches():
    listener = QualityListener(kept=2)
    for batch in (0, 1, 1, 2, 3):
        listener.record("q", batch, {"rows": 10, "bad_rows": batch})
    assert listener.totals("q") == {"rows": 40, "bad_rows": 6} and len(listener._batches["q"]) == 2
