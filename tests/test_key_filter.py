"""Bloom filters of stored rows: no row lost or doubled, stored rows read on a hit only."""

import glob
import os
import random
import tempfile
from datetime import datetime, timedelta

from pyspark.sql import functions as F

from tripwire.schema import FRAUD_COLUMNS, FRAUD_EVENT
from tripwire.sinks import key_filter as K
from tripwire.sinks.fraud_table import FraudTableWriter, add_filters, read_fraud_table

NOW = datetime(2024, 1, 1, 12)


def event(i, reason="R"):
    when = None if i % 17 == 0 else NOW + timedelta(hours=i % 60, seconds=i)
    return (None if i % 13 == 0 else f"U{i}", when, "A", (0.0 if i % 2 else -0.0) if i % 11 == 0 else float(i), "US", reason)


def frame(spark, ids):
    return spark.createDataFrame([event(i) for i in ids], FRAUD_EVENT).withColumn("event_date", F.to_date("timestamp"))


def stored(spark, path):
    return sorted(map(repr, read_fraud_table(spark, path).select(*FRAUD_COLUMNS).collect()))


def folder():
    return tempfile.mkdtemp(prefix="filters-", dir="/tmp")


def test_no_stored_row_is_missed_and_few_others_hit(spark):
    rows, others = frame(spark, range(3_000)), frame(spark, range(3_000, 9_000)).filter("timestamp IS NOT NULL")
    filters = K.build_filters(rows, FRAUD_COLUMNS)
    assert K.may_be_stored(rows, filters, FRAUD_COLUMNS).count() == rows.distinct().count()
    assert K.may_be_stored(others, filters, FRAUD_COLUMNS).count() <= 120        # 2 %
    assert K.may_be_stored(rows, filters.limit(0), FRAUD_COLUMNS).count() == 0
    assert K.build_filters(rows.limit(0), FRAUD_COLUMNS).count() == 0


def test_large_dates_take_more_blocks(spark):
    rows = spark.range(40_000).select(F.lit(NOW).cast("date").alias("event_date"), F.col("id").cast("string").alias("k"))
    filters = K.build_filters(rows, ["k"])
    assert filters.select("blocks").distinct().first()[0] == 16 and filters.count() == 16
    assert K.may_be_stored(rows, filters, ["k"]).count() == 40_000


def test_equal_to_the_plain_writer(spark):
    base = folder()
    plain, filtered = FraudTableWriter(f"{base}/a", query_id="q"), FraudTableWriter(f"{base}/b", query_id="q", filter_path=f"{base}/f")
    rng = random.Random(4)
    batches = [rng.sample(range(120), 45) for _ in range(4)]
    for writer in (plain, filtered):
        for n, ids in enumerate(batches):
            writer(frame(spark, ids), n)
        writer(frame(spark, batches[3]), 3)            # replayed
    assert stored(spark, f"{base}/a") == stored(spark, f"{base}/b")
    assert len(stored(spark, f"{base}/b")) == len({i for ids in batches for i in ids})


def test_stored_rows_are_read_on_a_hit_only(spark):
    base = folder()
    writer = FraudTableWriter(f"{base}/t", query_id="q", filter_path=f"{base}/f")
    writer(frame(spark, range(1, 30)), 0)
    files = glob.glob(f"{base}/t/event_date=*/query_id=q/batch_id=0/*.parquet")
    kept = {f: open(f, "rb").read() for f in files}
    for f in files:                                    # a read of them would fail
        with open(f, "wb") as out:
            out.write(b"not a table")
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.truncate(crc, 0)
    writer(frame(spark, range(30, 60)), 1)
    failed = False
    try:
        writer(frame(spark, range(20, 25)), 2)
    except Exception:  # noqa: BLE001 - the hit reads what was broken
        failed = True
    assert failed
    for f, raw in kept.items():
        crc = os.path.join(os.path.dirname(f), f".{os.path.basename(f)}.crc")
        if os.path.exists(crc):
            os.remove(crc)
        with open(f, "wb") as out:
            out.write(raw)
    writer(frame(spark, range(20, 70)), 2)
    assert len(stored(spark, f"{base}/t")) == 69


def test_crash_between_filter_and_rows(spark):
    base = folder()
    writer = FraudTableWriter(f"{base}/t", query_id="q", filter_path=f"{base}/f")
    K.write_filters(frame(spark, range(10)), FRAUD_COLUMNS, f"{base}/f", "q", 0)      # and no rows
    FraudTableWriter(f"{base}/t", query_id="other", filter_path=f"{base}/f")(frame(spark, range(5)), 0)
    writer(frame(spark, range(10)), 0)
    assert len(stored(spark, f"{base}/t")) == 10


def test_filters_for_a_table_written_without(spark):
    base = folder()
    FraudTableWriter(f"{base}/t", query_id="old")(frame(spark, range(40)), 0)
    add_filters(spark, f"{base}/t", f"{base}/f")
    FraudTableWriter(f"{base}/t", query_id="new", filter_path=f"{base}/f")(frame(spark, range(20, 60)), 0)
    assert len(stored(spark, f"{base}/t")) == 60
