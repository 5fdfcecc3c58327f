"""Detectors against brute force on random small inputs (edges of minutes and
of days included)."""

from collections import Counter
from datetime import datetime, timedelta

from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

from tripwire.operators import detect as D
from tripwire.schema import TRANSACTION

BASE = datetime(2024, 1, 1, 23, 50)     # spans midnight
MIN = timedelta(minutes=1)

event = st.tuples(
    st.sampled_from(["A", "B"]),
    st.integers(min_value=0, max_value=25 * 60 * 1_000_000).map(lambda us: BASE + timedelta(microseconds=us)),
    st.sampled_from(["US", "UK", "FR", None]),
)
edge_event = st.tuples(
    st.sampled_from(["A", "B"]),
    st.integers(min_value=0, max_value=25).map(lambda m: BASE + m * MIN),
    st.sampled_from(["US", "UK"]),
)


def _floor_minute(t):
    return t.replace(second=0, microsecond=0)


def brute_exact(rows):
    out = Counter()
    for (u, t, loc) in rows:
        if loc is None:
            continue
        if any(u2 == u and l2 is not None and l2 != loc and abs(t2 - t) <= 10 * MIN for (u2, t2, l2) in rows):
            out[(u, t, loc)] += 1
    return out


def brute_counts(rows):
    got = {}
    for (u, t, _) in rows:
        m = _floor_minute(t)
        for k in range(10):
            ws = m - k * MIN
            locs = {l2 for (u2, t2, l2) in rows if u2 == u and ws <= t2 < ws + 10 * MIN and l2 is not None}
            got[(u, ws)] = len(locs)
    return got


def _run(spark, rows):
    df = spark.createDataFrame([(u, t, "X", 1.0, loc) for (u, t, loc) in rows], TRANSACTION)
    windowed = Counter((r["user_id"], r["timestamp"], r["location"]) for r in D.impossible_travel(df).collect())
    exact = Counter((r["user_id"], r["timestamp"], r["location"]) for r in D.impossible_travel_exact(df).collect())
    counts = {(r["user_id"], r["window_start"]): r["location_count"]
              for r in D.window_location_count(df).collect()}
    flagged = {(r["user_id"], r["window_start"]): r["location_count"]
               for r in D.impossible_windows(df).collect()}
    assert flagged == {k: v for k, v in counts.items() if v > 1}
    return windowed, exact, counts


@settings(max_examples=12, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.one_of(event, edge_event), min_size=1, max_size=14))
def test_detectors_match_brute_force(spark, rows):
    windowed, exact, counts = _run(spark, rows)
    assert windowed == _merge_plain(rows)
    assert exact == brute_exact(rows)
    assert counts == brute_counts(rows)


def _merge_plain(rows):
    out = Counter()
    for (u, t, loc) in rows:
        m = _floor_minute(t)
        for k in range(10):
            ws = m - k * MIN
            locs = {l2 for (u2, t2, l2) in rows if u2 == u and ws <= t2 < ws + 10 * MIN and l2 is not None}
            if len(locs) > 1:
                out[(u, t, loc)] += 1
    return out
