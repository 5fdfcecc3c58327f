"""Detectors as per-key state processors with event-time timers.

``stream_travel_stateful``: the sliding-window rule.  One state row per user
holds the user's open minutes with the lowest and highest location of each; the
ten sliding windows of a minute are never stored.  A timer fires at the end of
the next window to close.  The processor then says, per minute, how many of
the windows just closed were flagged, and the events of that minute (held once
each by the join) are emitted that often: the rows of ``stream_impossible_travel``.

``stream_travel_exact``: the pairwise rule (another country at most ``gap`` away).
State holds the events of some users (those of a hash bucket) of a span of days and of
``gap`` around it: a call of the processor costs about a millisecond whatever its rows,
so that one call per user is most of the work.  An event is
emitted as soon as a partner is known, before or after it; a timer releases it
when ``gap`` has passed below the watermark and no partner can follow.  Events
near the border of a span go to both spans, and only their own emits them, so
one key holds at most a span of a bucket's users whatever the backlog.

(Column names of a processor's input may not begin with an underscore.)

The event time of the first processor's input is the end of an event's last
window, with the watermark's delay longer by a window: a row is late exactly when all
its windows are closed, as in the windowed aggregate.  Both need the RocksDB
state store (``run.processor_state``).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame, Row
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StatefulProcessor, StatefulProcessorHandle

from tripwire.config import (MICROS_PER_MINUTE, MICROS_PER_SECOND, REASON_TRAVEL, TRAVEL_GAP_SECONDS, WATERMARK_DELAY,
                             WINDOW_LENGTH, WINDOW_MINUTES)
from tripwire.functions.timecols import DAY, micros, minute_of, ts_of

_MILLI = 1_000
SPAN_DAYS = 7               # a key of the exact rule holds at most so many days of its users
BUCKETS = 4096              # of users, in the exact rule: more, where a bucket's open events grow large

_NEVER = -(1 << 62)

# Until when windows are decided, and the timer that is set, stand beside the minutes.
_MINUTES = T.StructType([T.StructField("minute", T.ArrayType(T.LongType())), T.StructField("lo", T.ArrayType(T.StringType())),
                         T.StructField("hi", T.ArrayType(T.StringType())), T.StructField("until", T.LongType()),
                         T.StructField("timer", T.LongType())])
_FLAGS = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("closes", T.TimestampType()),
                       T.StructField("flagged", T.IntegerType())])


def flagged_windows(minutes: dict[int, tuple[str, str]], after: int, until: int, length: int = WINDOW_MINUTES) -> dict[int, int]:
    """Per minute (its start in microseconds) how many of the windows that end
    in ``(after, until]`` and cover it have more than one location.  Minutes
    without an event count, too: one that is late for a closed window may follow."""
    step, out, decided = MICROS_PER_MINUTE, {}, set()
    ordered = sorted(minutes)
    for i, minute in enumerate(ordered):
        # a window with two locations either holds a minute with two, or two minutes that differ:
        # without either in reach of this minute, none of its windows is flagged
        lo, hi = minutes[minute]
        if lo == hi:
            alike = True
            for near in (range(i + 1, len(ordered)), range(i - 1, -1, -1)):
                for j in near:
                    if abs(ordered[j] - minute) >= length * step:
                        break
                    if minutes[ordered[j]] != (lo, lo):
                        alike = False
                        break
                if not alike:
                    break
            if alike:
                continue
        for end in range(minute + step, minute + (length + 1) * step, step):
            if not after < end <= until or end in decided:
                continue
            decided.add(end)
            held = [m for m in range(end - length * step, end, step) if m in minutes]
            if min(minutes[m][0] for m in held) < max(minutes[m][1] for m in held):
                for m in range(end - length * step, end, step):
                    out[m] = out.get(m, 0) + 1
    return out


class WindowFlags(StatefulProcessor):
    """Per user: the open minutes, decided window by window."""

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.open = handle.getValueState("minutes", _MINUTES)

    def _load(self) -> tuple[dict[int, tuple[str, str]], int, int | None]:
        held = self.open.get()
        if held is None:
            return {}, _NEVER, None
        minute, lo, hi, until, timer = held
        return dict(zip(minute, zip(lo, hi))), until, timer

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:
        minutes, until, timer = self._load()
        for batch in rows:
            for minute, location in zip(batch["minute"].tolist(), batch["location"].tolist()):
                lo, hi = minutes.get(minute, (location, location))
                minutes[minute] = (min(lo, location), max(hi, location))
        yield from self._close(key, minutes, until, timer, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:
        minutes, until, _ = self._load()
        yield from self._close(key, minutes, until, None, timerValues)

    def _close(self, key, minutes: dict[int, tuple[str, str]], until: int, timer: int | None, timerValues) -> Iterator[pd.DataFrame]:
        now = timerValues.getCurrentWatermarkInMs() * _MILLI
        flags = flagged_windows(minutes, until, now)
        length, step = WINDOW_MINUTES * MICROS_PER_MINUTE, MICROS_PER_MINUTE
        kept = sorted(m for m in minutes if m + length > now)
        # the first end of a window after the watermark
        following = (max(kept[0] + step, (now // step + 1) * step) // _MILLI - 1) if kept else None
        if timer is not None and timer != following:
            self.handle.deleteTimer(timer)
        if kept:
            self.open.update((kept, [minutes[m][0] for m in kept], [minutes[m][1] for m in kept], max(now, until), following))
            if timer != following:
                self.handle.registerTimer(following)
        else:
            self.open.clear()
        if flags:
            closes = pd.to_datetime([m + length for m in flags], unit="us")
            yield pd.DataFrame({"user_id": [key[0]] * len(flags), "closes": closes, "flagged": np.array(list(flags.values()), dtype=np.int32)})

    def close(self) -> None:
        pass


def stream_travel_stateful(tx: DataFrame, delay: str = WATERMARK_DELAY) -> DataFrame:
    """Events of flagged windows, once per flagged window that contains them."""
    length = WINDOW_MINUTES * MICROS_PER_MINUTE
    events = (tx.withColumn("minute", minute_of(F.col("timestamp")))
              .withColumn("closes", ts_of(F.col("minute") + length))
              .withWatermark("closes", f"{delay} {WINDOW_LENGTH}"))
    known = F.col("user_id").isNotNull() & F.col("location").isNotNull()
    flags = (events.filter(known).select("user_id", "closes", "minute", "location").groupBy("user_id")
             .transformWithStateInPandas(WindowFlags(), _FLAGS, "Append", "EventTime", eventTimeColumnName="closes"))
    held = events.select("user_id", "closes", micros(F.col("timestamp")).alias("_us"), "merchant_category", "amount", "location")
    return (held.join(flags, ["user_id", "closes"])
            .select("user_id", ts_of(F.col("_us")).alias("timestamp"), "merchant_category", "amount", "location",
                    F.lit(REASON_TRAVEL).alias("fraud_reason"), F.explode(F.sequence(F.lit(1), F.col("flagged"))).alias("_copy"))
            .drop("_copy"))


_COLUMNS = ("user_id", "us", "location", "merchant_category", "amount", "waits")
_HELD = T.StructType([*[T.StructField(n, T.ArrayType(t)) for n, t in zip(
    _COLUMNS, (T.StringType(), T.LongType(), T.StringType(), T.StringType(), T.DoubleType(), T.BooleanType()))], T.StructField("timer", T.LongType())])
_FOUND = T.StructType([T.StructField("user_id", T.StringType()), T.StructField("us", T.LongType()),
                       T.StructField("merchant_category", T.StringType()), T.StructField("amount", T.DoubleType()),
                       T.StructField("location", T.StringType())])


def has_partner(us: np.ndarray, location: np.ndarray, gap: int, user: np.ndarray | None = None) -> np.ndarray:
    """Which events, in time order (of each ``user``, whose events follow each
    other), have one elsewhere at most ``gap`` away.  The nearest such event is the
    last of the run of locations before or the first of the run after."""
    n = len(us)
    user = np.zeros(n, dtype=np.int64) if user is None else user
    starts = np.flatnonzero(np.concatenate([[True], (location[1:] != location[:-1]) | (user[1:] != user[:-1])]))
    run = np.repeat(np.arange(len(starts)), np.diff(starts, append=n))
    first, following = starts[run], np.append(starts, n)[run + 1]
    last, nearest = np.maximum(first - 1, 0), np.minimum(following, n - 1)
    before = (first > 0) & (user[last] == user) & (us - us[last] <= gap)
    after = (following < n) & (user[nearest] == user) & (us[nearest] - us <= gap)
    return before | after


class PairRelease(StatefulProcessor):
    """Per bucket of users and span: events that wait for a partner, and those that may be one."""

    def __init__(self, gap: int):
        self.gap = gap

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("events", _HELD)

    def _load(self) -> tuple[list[tuple], int | None]:
        held = self.held.get()
        return ([], None) if held is None else (list(zip(*held[:-1])), held[-1])

    def handleInputRows(self, key, rows: Iterator[Row], timerValues) -> Iterator[Row]:
        events, timer = self._load()
        events.extend(tuple(row)[-len(_COLUMNS):] for row in rows)
        yield from self._decide(events, timer, timerValues)

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[Row]:
        yield from self._decide(self._load()[0], None, timerValues)

    def _decide(self, events: list[tuple], timer: int | None, timerValues) -> Iterator[Row]:
        events.sort(key=lambda e: e[:3])
        user, us, location = (np.array([e[i] for e in events], dtype=t) for i, t in enumerate((object, np.int64, object)))
        paired = has_partner(us, location, self.gap, user).tolist() if events else []
        found = [e for e, with_partner in zip(events, paired) if with_partner and e[5]]
        now = timerValues.getCurrentWatermarkInMs() * _MILLI
        kept = [(*e[:5], e[5] and not with_partner) for e, with_partner in zip(events, paired) if e[1] + self.gap >= now]
        following = (max(min(e[1] for e in kept) + self.gap, now) // _MILLI + 1) if kept else None
        if timer is not None and timer != following:
            self.handle.deleteTimer(timer)
        if kept:
            self.held.update((*map(list, zip(*kept)), following))
            if timer != following:
                self.handle.registerTimer(following)
        else:
            self.held.clear()
        for user_id, at, place, category, amount, _ in found:
            # NaN counts as missing
            yield Row(user_id=user_id, us=at, merchant_category=category, amount=None if amount != amount else amount, location=place)

    def close(self) -> None:
        pass


def stream_travel_exact(tx: DataFrame, delay: str = WATERMARK_DELAY, gap_seconds: int = TRAVEL_GAP_SECONDS,
                        span_days: int = SPAN_DAYS, buckets: int = BUCKETS) -> DataFrame:
    """Events with another of the same user elsewhere at most ``gap_seconds`` away, each once."""
    gap = gap_seconds * MICROS_PER_SECOND
    us = micros(F.col("timestamp"))
    span = F.lit(span_days * DAY)
    own = F.floor(us / span).cast("long")
    reach = F.sequence(F.floor((us - gap) / span).cast("long"), F.floor((us + gap) / span).cast("long"))
    known = F.col("user_id").isNotNull() & F.col("timestamp").isNotNull() & F.col("location").isNotNull()
    spread = (tx.filter(known).withWatermark("timestamp", delay)
              .select(F.pmod(F.xxhash64("user_id"), F.lit(buckets)).alias("bucket"), F.explode(reach).alias("span"), "timestamp",
                      own.alias("own"), "user_id", us.alias("us"), "location", "merchant_category", "amount")
              .withColumn("waits", F.col("own") == F.col("span")).drop("own"))
    return (spread.groupBy("bucket", "span")
            .transformWithState(PairRelease(gap), _FOUND, "Append", "EventTime")
            .select("user_id", ts_of(F.col("us")).alias("timestamp"), "merchant_category", "amount", "location",
                    F.lit(REASON_TRAVEL).alias("fraud_reason")))
