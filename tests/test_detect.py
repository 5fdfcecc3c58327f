"""Detector boundaries (micro fixtures)."""

from collections import Counter

from tripwire.operators import detect as D
from tests.conftest import rows_of, ts


def _count_by_time(df):
    return Counter(r["timestamp"] for r in df.collect())


def test_high_value_threshold_is_strict(make_tx):
    tx = make_tx([("U", "00:00:00", "GROCERY", 4999.99, "US"),
                  ("U", "00:00:01", "GROCERY", 5000.0, "US"),
                  ("U", "00:00:02", "GROCERY", 5000.01, "US"),
                  ("U", "00:00:03", "GROCERY", None, "US")])
    out = D.high_value(tx)
    assert [r["amount"] for r in out.collect()] == [5000.01]
    assert out.columns == ["user_id", "timestamp", "merchant_category", "amount", "location", "fraud_reason"]
    assert {r["fraud_reason"] for r in out.collect()} == {"HIGH_VALUE_TRANSACTION"}


def test_window_multiplicity(make_tx):
    tx = make_tx([("U1", "00:00:10", "TRAVEL", 10.0, "US"), ("U1", "00:05:00", "TRAVEL", 10.0, "UK")])
    c = _count_by_time(D.impossible_travel(tx))
    assert c == {ts("00:00:10"): 5, ts("00:05:00"): 5}
    starts = rows_of(D.impossible_windows(tx), "window_start")
    assert starts == [(ts("2023-12-31T23:56:00"),), (ts("2023-12-31T23:57:00"),), (ts("2023-12-31T23:58:00"),),
                      (ts("2023-12-31T23:59:00"),), (ts("00:00:00"),)]
    exact = D.impossible_travel_exact(tx)
    assert _count_by_time(exact) == {ts("00:00:10"): 1, ts("00:05:00"): 1}


def test_window_miss_but_exact_hit(make_tx):
    tx = make_tx([("U2", "00:00:45", "TRAVEL", 10.0, "US"), ("U2", "00:10:15", "TRAVEL", 10.0, "UK")])
    assert D.impossible_travel(tx).count() == 0
    assert D.impossible_travel_exact(tx).count() == 2


def test_exact_edge_inclusive_ten_minutes(make_tx):
    tx = make_tx([("A", "00:00:30", "X", 1.0, "US"), ("A", "00:10:30", "X", 1.0, "UK"),
                  ("B", "00:00:30", "X", 1.0, "US"), ("B", "00:10:30.000001", "X", 1.0, "UK")])
    exact = D.impossible_travel_exact(tx)
    assert sorted(r["user_id"] for r in exact.collect()) == ["A", "A"]
    assert D.impossible_travel(tx).count() == 0


def test_exact_edges_across_minutes_and_days(make_tx):
    # Pairs straddling midnight (halo rows) and minute edges in both directions.
    tx = make_tx([
        ("C", "2024-01-01T23:55:00.5", "X", 1.0, "US"), ("C", "2024-01-02T00:05:00.5", "X", 1.0, "UK"),
        ("D", "2024-01-01T23:59:59.999999", "X", 1.0, "US"), ("D", "2024-01-02T00:00:00", "X", 1.0, "US"),
        ("E", "00:20:00", "X", 1.0, "US"), ("E", "00:30:00.000001", "X", 1.0, "UK"),
        ("E", "00:09:59.999999", "X", 1.0, "UK"),
        ("F", "2024-01-01T23:58:00", "X", 1.0, "US"), ("F", "2024-01-02T00:03:00", "X", 1.0, "UK"),
    ])
    exact = rows_of(D.impossible_travel_exact(tx), "user_id", "timestamp")
    assert exact == [("C", ts("2024-01-01T23:55:00.5")), ("C", ts("2024-01-02T00:05:00.5")),
                     ("F", ts("2024-01-01T23:58:00")), ("F", ts("2024-01-02T00:03:00"))]
    windowed = Counter(r["user_id"] for r in D.impossible_travel(tx).collect())
    assert windowed == {"F": 10}     # two events, five shared windows each, across midnight


def test_same_country_not_flagged(make_tx):
    tx = make_tx([("U", "00:00:00", "X", 1.0, "US"), ("U", "00:01:00", "X", 1.0, "US")])
    assert D.impossible_travel(tx).count() == 0
    assert D.impossible_travel_exact(tx).count() == 0


def test_companion_rows_all_flagged(make_tx):
    tx = make_tx([("U", "00:00:10", "X", 1.0, "US"), ("U", "00:00:20", "X", 2.0, "US"),
                  ("U", "00:00:30", "X", 3.0, "UK")])
    got = Counter(r["amount"] for r in D.impossible_travel(tx).collect())
    assert got == {1.0: 10, 2.0: 10, 3.0: 10}
    assert D.impossible_travel_exact(tx).count() == 3


def test_both_reasons_and_duplicates(make_tx):
    tx = make_tx([("U", "00:00:10", "X", 9000.0, "US"), ("U", "00:00:20", "X", 1.0, "UK"),
                  ("U", "00:00:20", "X", 1.0, "UK")])
    fraud = D.fraud_union(D.high_value(tx), D.impossible_travel(tx))
    reasons = Counter((r["amount"], r["fraud_reason"]) for r in fraud.collect())
    assert reasons[(9000.0, "HIGH_VALUE_TRANSACTION")] == 1
    assert reasons[(9000.0, "IMPOSSIBLE_TRAVEL")] == 10
    assert reasons[(1.0, "IMPOSSIBLE_TRAVEL")] == 20       # two identical events x 10 windows
    distinct = Counter((r["amount"], r["fraud_reason"]) for r in D.fraud_distinct(fraud).collect())
    assert distinct == {(9000.0, "HIGH_VALUE_TRANSACTION"): 1, (9000.0, "IMPOSSIBLE_TRAVEL"): 1,
                        (1.0, "IMPOSSIBLE_TRAVEL"): 1}


def test_null_location_and_time(make_tx):
    tx = make_tx([("U", "00:00:10", "X", 1.0, "US"), ("U", "00:00:20", "X", 2.0, None),
                  ("U", "00:00:30", "X", 3.0, "UK"), ("U", None, "X", 4.0, "FR"),
                  (None, "00:00:40", "X", 5.0, "DE")])
    amounts = Counter(r["amount"] for r in D.impossible_travel(tx).collect())
    # the NULL-location event lies in the flagged windows and is emitted with them
    assert amounts == {1.0: 10, 2.0: 10, 3.0: 10}
    # the exact rule needs a country on both sides
    assert sorted(r["amount"] for r in D.impossible_travel_exact(tx).collect()) == [1.0, 3.0]
    counts = {r["window_start"]: r["location_count"] for r in D.window_location_count(tx).collect()}
    assert set(counts.values()) == {2}


def test_validated_anti_null_safe(make_tx):
    tx = make_tx([("U", "00:00:10", "X", 9000.0, None), ("U", "00:00:11", "X", 1.0, None)])
    clean = D.validated_anti(tx, D.high_value(tx))
    assert [r["amount"] for r in clean.collect()] == [1.0]


def test_window_location_count_reports_every_window_once(make_tx):
    tx = make_tx([("U", "00:00:10", "X", 1.0, "US"), ("U", "00:03:00", "X", 1.0, "UK"),
                  ("U", "00:25:00", "X", 1.0, "FR")])
    got = rows_of(D.window_location_count(tx), "window_start", "location_count")
    starts = [r[0] for r in got]
    assert len(starts) == len(set(starts))
    # windows of the first two events: starts 23:51 .. 00:03 -> 13 windows; third event: 10 windows
    assert len(got) == 13 + 10
    assert sum(1 for _, n in got if n == 2) == 7      # starts 23:54 .. 00:00


def test_detect_all_equals_union(make_tx):
    tx = make_tx([("U", "00:00:10", "X", 9000.0, "US"), ("U", "00:00:20", "X", 1.0, "UK"),
                  ("U", "00:00:20", "X", 1.0, "UK"), ("V", "00:03:00", "X", 6000.0, None),
                  ("W", None, "X", 7000.0, "US"), (None, "00:01:00", "X", 8000.0, "FR"),
                  ("V", "00:04:00", "X", None, "DE"), ("V", "00:05:00", "X", 2.0, "FR")])
    fused = Counter(tuple(r) for r in D.detect_all(tx).collect())
    union = Counter(tuple(r) for r in D.fraud_union(D.high_value(tx), D.impossible_travel(tx)).collect())
    assert fused == union


def test_exact_edge_minute_uses_other_locations_time(make_tx):
    # event at 00:10:30 US; minute 00:00 holds US (latest, same country) and UK
    tx = make_tx([("A", "00:10:30", "X", 1.0, "US"), ("A", "00:00:50", "X", 1.0, "US"),
                  ("A", "00:00:20", "X", 1.0, "UK"),                       # 10m10s before: out
                  ("B", "00:10:30", "X", 1.0, "US"), ("B", "00:00:50", "X", 1.0, "US"),
                  ("B", "00:00:40", "X", 1.0, "UK"),                       # 9m50s before: in
                  # mirror image on the late side: minute 00:20 holds US (earliest) and UK
                  ("C", "00:10:30", "X", 1.0, "US"), ("C", "00:20:10", "X", 1.0, "US"),
                  ("C", "00:20:40", "X", 1.0, "UK"),                       # 10m10s after: out
                  ("D", "00:10:30", "X", 1.0, "US"), ("D", "00:20:10", "X", 1.0, "US"),
                  ("D", "00:20:20", "X", 1.0, "UK")])                      # 9m50s after: in
    got = sorted((r["user_id"], r["timestamp"]) for r in D.impossible_travel_exact(tx).collect())
    # the two edge-minute events flag each other in every case; the central
    # event only when the other country's time is within ten minutes
    assert got == [("A", ts("00:00:20")), ("A", ts("00:00:50")),
                   ("B", ts("00:00:40")), ("B", ts("00:00:50")), ("B", ts("00:10:30")),
                   ("C", ts("00:20:10")), ("C", ts("00:20:40")),
                   ("D", ts("00:10:30")), ("D", ts("00:20:10")), ("D", ts("00:20:20"))]


def test_windows_of_events_without_user(spark, make_tx):
    """Batch and stream alike count them; they never travel."""
    from tripwire.operators import detect as D

    tx = make_tx([(None, "00:00:10", "A", 1.0, "US"), (None, "00:01:10", "A", 1.0, "UK")])
    got = D.window_location_count(tx).collect()
    assert len(got) == 11 and {r["user_id"] for r in got} == {None}
    assert D.impossible_travel(tx).count() == 0 and D.detect_all(tx).count() == 0


def test_exact_rule_with_any_gap_and_many_locations(spark, make_tx):
    import random
    from datetime import datetime, timedelta

    from tripwire.operators import detect as D

    rng = random.Random(8)
    start = datetime(2024, 1, 1, 23, 50)
    rows = [(f"U{rng.randrange(3)}", (start + timedelta(microseconds=rng.randrange(1_500_000_000))).isoformat(), "A", float(i),
             rng.choice(["US", "US", "UK", "DE", "FR", "JP", "AU"])) for i in range(150)]
    rows += [("X", (start + timedelta(seconds=s)).isoformat(), "A", 1000.0 + s, c) for s, c in ((0, "US"), (90, "UK"), (300, "UK"))]
    tx = make_tx(rows)
    times = [(u, datetime.fromisoformat(t), a, c) for u, t, _, a, c in rows]
    for gap in (0, 1, 7.5, 59, 90, 125, 600):
        expected = {a for u, t, a, c in times if any(
            u == v and c != d and abs((t - w).total_seconds()) <= gap for v, w, _, d in times)}
        assert {r["amount"] for r in D.impossible_travel_exact(tx, gap).collect()} == expected, gap
