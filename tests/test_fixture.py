"""The transaction view over the events table."""

from datetime import datetime

from tripwire.schema import EVENTS
from tripwire.sources.fixture import transactions_from_events


def test_view_columns_and_edge_props(spark):
    t = datetime(2024, 1, 1, 3, 4, 5)
    ev = spark.createDataFrame([
        (1, t, 7, "purchase", 6.55, '{"k": 69}'),
        (2, t, 12345, "view", 0.01, '{"k": 0}'),
        (3, t, 8, "click", 490.02, '{"k": "abc"}'),
        (4, t, 8, "click", 1.0, None),
        (5, None, 8, "error", 2.0, '{"k": 10}'),
    ], EVENTS)
    rows = [tuple(r) for r in transactions_from_events(ev).collect()]
    assert rows == [
        ("USER_00007", t, "PURCHASE", 163.75, "MX"),      # 69 % 10 = 9 -> tenth code
        ("USER_12345", t, "VIEW", 0.25, "US"),
        ("USER_00008", t, "CLICK", 12250.5, None),     # non-numeric k: no location, no failure
        ("USER_00008", t, "CLICK", 25.0, None),
        ("USER_00008", None, "ERROR", 50.0, "US"),
    ]
