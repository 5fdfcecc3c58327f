"""Stored daily sketches: exact parts, bounds of the sketched ones, dates replaced, events unread."""

from __future__ import annotations

import random
import tempfile
from datetime import datetime, timedelta

import numpy as np
import pytest

from tripwire.operators import analytics as A
from tripwire.operators import sketches as S
from tripwire.schema import FRAUD_EVENT


def _rows(n, days=6, seed=1):
    rng = random.Random(seed)
    start = datetime(2024, 1, 1)
    return [(f"U{rng.randrange(n // 3 + 1)}", start + timedelta(hours=rng.randrange(24 * days)), rng.choice("ABCDE"),
             round(rng.lognormvariate(5, 2), 2), "US", rng.choice(["R1", "R2"])) for _ in range(n)]


@pytest.fixture
def root():
    return tempfile.mkdtemp(prefix="sketch-", dir="/tmp") + "/s"


def test_any_range_of_dates(spark, root):
    rows = _rows(9000)
    odd = [(None, datetime(2024, 1, 3), None, None, None, None), ("U1", None, "A", 5.0, "US", "R1"),
           ("U1", datetime(2024, 1, 3), "A", float("nan"), "US", "R1")]
    fraud = spark.createDataFrame(rows + odd, FRAUD_EVENT)
    S.store_sketches(S.dated(fraud), root)
    for first, last in ((None, None), ("2024-01-02", "2024-01-04"), ("2024-01-05", None)):
        part = S._between(S.dated(fraud), first, last).drop("event_date")
        want, got = A.summary(part).first().asDict(), S.merged_summary(spark, root, first, last).first().asDict()
        for name in ("median_fraud_amount", "unique_users_affected"):
            a, b = want.pop(name), got.pop(name)
            if name == "unique_users_affected":
                assert abs(a - b) <= 4 * S.USERS_ERROR * a + 1
            else:
                amounts = np.sort([r.amount for r in part.collect() if r.amount is not None and r.amount == r.amount])
                assert abs(np.searchsorted(amounts, b) / len(amounts) - 0.5) <= 2 * S.RANK_ERROR
        assert got == want
    assert S.merged_summary(spark, root, "2030-01-01").count() == 0


def test_a_date_stored_again_is_replaced_and_no_event_is_read(spark, root):
    rows = _rows(300, days=3)
    S.store_sketches(S.dated(spark.createDataFrame(rows, FRAUD_EVENT)), root)
    S.store_sketches(S.dated(spark.createDataFrame(rows, FRAUD_EVENT)), root)
    late = [r for r in rows if r[1].day == 2] + [("Z", datetime(2024, 1, 2), "E", 7.0, "US", "R1")]
    S.store_sketches(S.dated(spark.createDataFrame(late, FRAUD_EVENT)), root)
    merged = S.merged_summary(spark, root, "2024-01-01", "2024-01-02")
    assert merged.first().total_fraud_transactions == sum(r[1].day <= 2 for r in rows) + 1
    assert len(merged.inputFiles()) <= 8
    assert all("/daily/" in f or "/values/" in f for f in merged.inputFiles())


def test_only_missing_amounts(spark, root):
    fraud = spark.createDataFrame([("U", datetime(2024, 1, 1), "A", None, "US", "R")], FRAUD_EVENT)
    S.store_sketches(S.dated(fraud), root)
    got = S.merged_summary(spark, root).first()
    assert (got.total_fraud_transactions, got.total_fraud_amount, got.median_fraud_amount) == (1, 0.0, None)
