"""Streaming detectors (append mode, event time with a watermark).

* high value: stateless filter, no watermark, never drops late rows;
* sliding-window location count: windowed aggregate, a window is emitted once
  the watermark passes its end;
* impossible travel: flagged windows joined back to their events with an
  *equi-join on (user, window-typed key)*.  A range join on projected window
  bounds would keep join state forever; a key derived from the watermarked
  event time lets the watermark evict both join sides once no open window can
  match.  The event side holds each event once (see
  ``stream_impossible_travel``).  Event time travels through the join as
  ``unix_micros`` so the join output has a single event-time column, and is
  restored afterwards.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.config import (HIGH_VALUE_THRESHOLD, REASON_TRAVEL, WATERMARK_DELAY, WINDOW_LENGTH, WINDOW_MINUTES,
                             WINDOW_SLIDE)
from tripwire.operators.detect import fraud_union, high_value
from tripwire.schema import FRAUD_COLUMNS

stream_high_value = high_value


def _watermarked(tx: DataFrame, delay: str) -> DataFrame:
    return tx.withWatermark("timestamp", delay)


def stream_window_location_count(tx: DataFrame, delay: str = WATERMARK_DELAY,
                                  approx: bool = False) -> DataFrame:
    """Distinct locations per user and sliding window.

    Default: exact, from the set of locations seen in the window (state per
    window = the handful of distinct country codes).  ``approx=True`` keeps a
    HyperLogLog sketch instead (fixed ~0.4 KB per window; exact for a handful
    of values only when no two of them collide).
    """
    agg = (F.approx_count_distinct("location") if approx
           else F.size(F.collect_set("location")).cast("long"))
    return (_watermarked(tx, delay)
            .groupBy("user_id", F.window("timestamp", WINDOW_LENGTH, WINDOW_SLIDE).alias("window"))
            .agg(agg.alias("location_count"))
            .select("user_id", F.col("window.start").alias("window_start"),
                    F.col("window.end").alias("window_end"), "location_count"))


def stream_impossible_travel(tx: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Events of flagged windows, once per flagged window that contains them.

    Join key on the event side: the one sliding window that *starts* in the
    event's minute, ``[m, m + 10 min)``.  It is the last of the event's ten
    windows to close, so the watermark evicts the event exactly when no
    flagged window can still reach it, and the join state holds each event
    once (not once per window).  A flagged window ``[ws, ws + 10 min)`` is
    expanded to the ten keys ``[k, k + 10 min)``, ``k = ws .. ws + 9 min``:
    one join match per (event, flagged window), the multiset the range join
    produces.
    """
    wm = _watermarked(tx, delay)
    win = F.window("timestamp", WINDOW_LENGTH, WINDOW_SLIDE)
    # Exact flag with constant state per window: two locations <=> min < max.
    flagged = (wm.filter(F.col("user_id").isNotNull())
               .groupBy("user_id", win.alias("window"))
               .agg(F.min("location").alias("_lo"), F.max("location").alias("_hi"))
               .filter(F.col("_lo") < F.col("_hi")))
    length = F.col("window.end") - F.col("window.start")
    offsets = F.sequence(F.lit(0), F.lit(WINDOW_MINUTES - 1))
    keys = flagged.select(
        "user_id",
        F.explode(F.transform(offsets, lambda i: F.struct(
            (F.col("window.start") + F.make_interval(mins=i)).alias("start"),
            (F.col("window.start") + F.make_interval(mins=i) + length).alias("end")))).alias("_key"))
    events = (wm.select("user_id", win.alias("_key"), F.unix_micros("timestamp").alias("_us"),
                        "merchant_category", "amount", "location")
              .filter(F.col("_key.start") == F.date_trunc("minute", F.timestamp_micros("_us"))))
    return (events.join(keys, ["user_id", "_key"])
            .select("user_id", F.timestamp_micros("_us").alias("timestamp"), "merchant_category",
                    "amount", "location", F.lit(REASON_TRAVEL).alias("fraud_reason")))


def stream_fraud(tx: DataFrame, delay: str = WATERMARK_DELAY,
                 threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Both detectors in one append-mode stream (duplicates kept, as emitted)."""
    return fraud_union(high_value(tx, threshold), stream_impossible_travel(tx, delay)).select(*FRAUD_COLUMNS)
