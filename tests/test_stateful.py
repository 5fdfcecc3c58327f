"""State processors: equality with the windowed aggregate and brute force, late rows, restart, state size."""

from __future__ import annotations

import os
import random
import tempfile
from collections import Counter
from datetime import datetime, timedelta

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tests.test_streaming import _payload, _stream, _write_files
from tripwire.operators.detect import impossible_travel, impossible_travel_exact
from tripwire.sources.payload import decode_transactions
from tripwire.streaming import detect as SD
from tripwire.streaming import stateful as ST
from tripwire.streaming.run import processor_state, run_available_now

MIN = 60_000_000


@given(st.dictionaries(st.integers(0, 40).map(lambda m: m * MIN), st.tuples(st.sampled_from("AB"), st.sampled_from("BC")), max_size=12),
       st.integers(-1, 60), st.integers(0, 30))
@settings(max_examples=300, deadline=None)
def test_flagged_windows(minutes, after, span):
    after, until = after * MIN, (after + span) * MIN
    want = Counter()
    for start in range(-10, 60):
        held = [m for m in minutes if start * MIN <= m < (start + 10) * MIN]
        if held and after < (start + 10) * MIN <= until and len({c for m in held for c in minutes[m]}) > 1:
            want.update(m * MIN for m in range(start, start + 10))
    pairs = {m: (min(v), max(v)) for m, v in minutes.items()}
    assert ST.flagged_windows(pairs, after, until) == dict(want)


@given(st.lists(st.tuples(st.integers(0, 40), st.sampled_from("ABC")), min_size=1, max_size=20), st.integers(0, 9))
@settings(max_examples=300, deadline=None)
def test_has_partner(events, gap):
    events.sort()
    us, loc = np.array([e[0] for e in events]), np.array([e[1] for e in events], dtype=object)
    want = [any(abs(t - u) <= gap and a != b for u, b in events) for t, a in events]
    assert ST.has_partner(us, loc, gap).tolist() == want


def _random_files(seed, n=160, files=5, disorder=8):
    """Events of three users in rising order, locally shuffled, one file a micro-batch."""
    rng = random.Random(seed)
    t, rows = datetime(2024, 1, 1), []
    for _ in range(n):
        t += timedelta(seconds=rng.choice([5, 50, 300, 600, 900]), microseconds=rng.choice([0, 1]))
        rows.append(_payload(rng.choice(["U1", "U2", "HOT", "HOT", "HOT"]), t.isoformat().split("T")[1], rng.choice(["US", "UK", "US"]),
                             amount=rng.choice([1.0, None])).replace("2024-01-01", t.date().isoformat()))
    for i in range(0, n - disorder, disorder):
        part = rows[i:i + disorder]
        rng.shuffle(part)
        rows[i:i + disorder] = part
    size = -(-n // files)
    return [rows[i:i + size] for i in range(0, n, size)]


def _drain(spark, build, files, **kw):
    root = tempfile.mkdtemp(prefix="state-", dir="/tmp")
    _write_files(root, files)
    return spark.read.parquet(run_available_now(build(_stream(spark, root)), spark, "state", **kw))


def _counted(df):
    return Counter(map(tuple, df.collect()))


def _batch(spark, files):
    lines = spark.createDataFrame([(line,) for part in files for line in part], "value string")
    return decode_transactions(lines)


@pytest.mark.parametrize("seed", [1, 2])
def test_windows_equal_the_aggregate(spark, seed):
    files = _random_files(seed)
    aggregate = _counted(_drain(spark, SD.stream_impossible_travel, files))
    assert _counted(_drain(spark, ST.stream_travel_stateful, files, processor=True)) == aggregate
    assert aggregate and not aggregate - _counted(impossible_travel(_batch(spark, files)))


def test_exact_equals_batch(spark):
    files = _random_files(3)
    # nothing is later than the watermark here: local disorder of at most eight events in one file
    batch = _counted(impossible_travel_exact(_batch(spark, [sum(files, [])])))
    assert _counted(_drain(spark, ST.stream_travel_exact, [sum(files, [])], processor=True)) == batch
    short = lambda tx: ST.stream_travel_exact(tx, span_days=1)
    ordered = [sorted(f, key=lambda line: line.split('"timestamp": ')[1]) for f in files]
    assert _counted(_drain(spark, short, ordered, processor=True)) == batch and batch


def test_exact_border_and_gap(spark):
    files = [[_payload("U", "23:55:00", "US"), _payload("U", "23:59:59.999999", "US")],
             [_payload("U", "00:05:00", "UK").replace("01-01", "01-02")],
             [_payload("U", "00:15:00.000001", "FR").replace("01-01", "01-02"), _payload(None, "00:05:00", "UK").replace("01-01", "01-02")],
             [_payload("W", "03:00:00", "US").replace("01-01", "01-02")]]
    got = _drain(spark, lambda tx: ST.stream_travel_exact(tx, span_days=1), files, processor=True)
    assert sorted(r.timestamp.strftime("%H:%M:%S") for r in got.collect()) == ["00:05:00", "23:55:00", "23:59:59"]


def test_late_rows_as_in_the_aggregate(spark):
    files = [[_payload("U", "00:10:30", "US")], [_payload("W", "00:29:00", "US")],
             # watermark 00:14: of this event's windows those ending up to 00:14 are closed, the others take it
             [_payload("U", "00:09:30", "UK")],
             [_payload("W", "02:00:00", "US")], [_payload("U", "00:12:00", "FR"), _payload("U", "00:11:00", "DE")],
             [_payload("W", "03:00:00", "US")]]
    want = _counted(_drain(spark, SD.stream_impossible_travel, files))
    assert want and _counted(_drain(spark, ST.stream_travel_stateful, files, processor=True)) == want


@pytest.mark.parametrize("build", [ST.stream_travel_stateful, ST.stream_travel_exact])
def test_restart(spark, build):
    files = [[sorted(f, key=lambda line: line.split('"timestamp": ')[1]) for f in _random_files(5)][i] for i in range(5)]
    root, out = tempfile.mkdtemp(prefix="again-", dir="/tmp"), tempfile.mkdtemp(prefix="again-out-", dir="/tmp")

    def run():
        with processor_state(spark):
            (build(_stream(spark, root)).writeStream.format("parquet").option("path", out + "/t")
             .option("checkpointLocation", out + "/c").trigger(availableNow=True).start().awaitTermination())

    for n in (2, 4, 5):
        for i in range(n):
            path = os.path.join(root, f"part-{i:03d}.json")
            if not os.path.exists(path):
                with open(path, "w") as fh:
                    fh.write("\n".join(files[i]) + "\n")
                os.utime(path, (1_700_000_000 + i, 1_700_000_000 + i))
        run()
    assert _counted(spark.read.parquet(out + "/t")) == _counted(_drain(spark, build, files, processor=True))


def test_state_rows(spark):
    """At most a fifth of the state rows that the windowed aggregate keeps."""
    rows = [_payload(f"U{u}", f"00:{m:02d}:30", "US") for u in range(40) for m in range(0, 14)]
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(key, "true")
    spark.conf.set(key, "true")
    try:
        totals = []
        for build in (SD.stream_impossible_travel, ST.stream_travel_stateful):
            root, out = tempfile.mkdtemp(prefix="rows-", dir="/tmp"), tempfile.mkdtemp(prefix="rows-out-", dir="/tmp")
            _write_files(root, [rows])
            with processor_state(spark):
                q = (build(_stream(spark, root)).writeStream.format("parquet").option("path", out + "/t")
                     .option("checkpointLocation", out + "/c").trigger(availableNow=True).start())
                q.awaitTermination()
            most = {}
            for p in q.recentProgress:
                for op in p["stateOperators"]:
                    most[op["operatorName"]] = max(most.get(op["operatorName"], 0), op["numRowsTotal"])
            totals.append(most)
    finally:
        spark.conf.set(key, before)
    aggregate = next(n for name, n in totals[0].items() if name == "stateStoreSave")
    (processor,) = [n for name, n in totals[1].items() if name.startswith("transformWithState")]
    assert 0 < processor * 5 <= aggregate, totals


def test_partners_of_several_users():
    user = np.array(["A", "A", "B", "B", "C"], dtype=object)
    location = np.array(["US", "UK", "UK", "UK", "US"], dtype=object)
    assert ST.has_partner(np.array([0, 5, 5, 6, 7]), location, 9, user).tolist() == [True, True, False, False, False]


def test_exact_rule_holds_users_together(spark):
    """The keys of the exact rule are bounded by its buckets, not by the users."""
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    before = spark.conf.get(key, None)
    rows = [_payload(f"U{u}", f"00:{m:02d}:30", loc) for u in range(60) for m, loc in ((1, "US"), (5, "UK" if u % 2 else "US"))]
    root, out = tempfile.mkdtemp(prefix="buckets-", dir="/tmp"), tempfile.mkdtemp(prefix="buckets-out-", dir="/tmp")
    _write_files(root, [rows, [_payload("W", "03:00:00", "US")]])
    spark.conf.set(key, "true")
    try:
        with processor_state(spark):
            q = (ST.stream_travel_exact(_stream(spark, root), buckets=4).writeStream.format("parquet").option("path", out + "/t")
                 .option("checkpointLocation", out + "/c").trigger(availableNow=True).start())
            q.awaitTermination()
    finally:
        spark.conf.set(key, before) if before is not None else spark.conf.unset(key)
    # per key: its events and one timer (kept in two column families)
    most = max(op["numRowsTotal"] for p in q.recentProgress for op in p["stateOperators"])
    assert 0 < most <= 4 * 3
    got = Counter(r.user_id for r in spark.read.parquet(out + "/t").collect())
    assert got == {f"U{u}": 2 for u in range(1, 60, 2)}


def test_minutes_of_one_place_are_not_tested_window_by_window():
    class Counted(dict):
        looked = 0

        def __contains__(self, m):
            Counted.looked += 1
            return super().__contains__(m)

    minutes = Counted({m * MIN: ("US", "US") for m in range(0, 2000, 5)})
    minutes[501 * MIN] = ("UK", "UK")
    flags = ST.flagged_windows(minutes, -1, 3000 * MIN)
    assert set(flags) == {m * MIN for m in range(492, 515) if flags.get(m * MIN)} and flags[501 * MIN] == 10
    assert Counted.looked < 1000
