"""Fraud detectors (batch).

* ``high_value``            strict ``amount > threshold``
* ``window_location_count`` distinct locations per user and 10-minute window
                            sliding by 1 minute (only windows holding events)
* ``impossible_windows``    the windows with more than one location
* ``impossible_travel``     every event inside a flagged window, once per
                            flagged window that contains it (the multiset the
                            streaming detector emits)
* ``impossible_travel_exact`` events with an event of the same user in another
                            country at most 10 minutes away (one row per event)
* ``fraud_union`` / ``fraud_distinct`` / ``validated_anti``

Windows are epoch-aligned and half-open: a window starting at minute ``ws``
holds events with ``ws <= t < ws + 10 min``, so an event in minute ``m`` lies
in the ten windows starting at ``m-9 .. m``.  The windowed detectors therefore
work on per-(user, minute) location sets, never on ten copies of each event.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.config import (HIGH_VALUE_THRESHOLD, MICROS_PER_SECOND, REASON_HIGH_VALUE,
                             REASON_TRAVEL, TRAVEL_GAP_SECONDS, WINDOW_MINUTES)
from tripwire.functions.timecols import MINUTE, floor_to, micros, minute_of, ts_of
from tripwire.operators.neighbours import with_neighbours
from tripwire.operators.sizing import checked_broadcast
from tripwire.schema import FRAUD_COLUMNS, TX_COLUMNS


def high_value(tx: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    return (tx.filter(F.col("amount") > F.lit(threshold))
            .select(*TX_COLUMNS, F.lit(REASON_HIGH_VALUE).alias("fraud_reason")))


# --------------------------------------------------------------------------
# Sliding-window detector
# --------------------------------------------------------------------------

def _dated(tx: DataFrame) -> DataFrame:
    return tx.filter(F.col("timestamp").isNotNull()).withColumn("_minute", minute_of(F.col("timestamp")))


def _timed(tx: DataFrame) -> DataFrame:
    """Events that can travel: a flagged window is joined back on its user."""
    return _dated(tx.filter(F.col("user_id").isNotNull()))


def _window_locations(nbr: Column, ws: Column) -> Column:
    """Distinct locations of the window starting at ``ws`` (a subset of ``nbr``)."""
    last = ws + (WINDOW_MINUTES - 1) * MINUTE
    inside = F.filter(nbr, lambda e: (e["minute"] >= ws) & (e["minute"] <= last))
    return F.array_distinct(F.flatten(F.transform(inside, lambda e: e["locs"])))


def _window_flag(nbr: Column, ws: Column) -> Column:
    """True when the window starting at ``ws`` holds two different locations:
    its smallest location is below its largest."""
    last = ws + (WINDOW_MINUTES - 1) * MINUTE
    inside = F.filter(nbr, lambda e: (e["minute"] >= ws) & (e["minute"] <= last))
    return (F.array_min(F.transform(inside, lambda e: e["lo"]))
            < F.array_max(F.transform(inside, lambda e: e["hi"])))


_RADIUS = (WINDOW_MINUTES - 1) * MINUTE


def _window_starts(m: Column) -> Column:
    """The ten windows containing minute ``m`` start at ``m-9 .. m``."""
    return F.sequence(m - _RADIUS, m, F.lit(MINUTE))


def _minute_windows(tx: DataFrame, only_mixed: bool = False) -> DataFrame:
    """One row per (user, active minute m) with ``reported``: the windows whose
    first active minute is m, each with its distinct-location count (so every
    non-empty window is reported exactly once).  ``only_mixed`` drops minutes
    whose whole +-9 minute neighbourhood has fewer than two locations (none of
    their windows can have two)."""
    per_minute = (_dated(tx)
                  .groupBy("user_id", "_minute")
                  .agg(F.collect_set("location").alias("locs")))
    nb = with_neighbours(per_minute, "user_id", "_minute", _RADIUS,
                         F.struct(F.col("_minute").alias("minute"), F.col("locs")),
                         "_nbr", prev_name="_prev")
    if only_mixed:
        nb = nb.filter(F.size(F.array_distinct(F.flatten(F.transform(F.col("_nbr"), lambda e: e["locs"])))) > 1)
    m = F.col("_minute")
    first_active = F.coalesce(F.col("_prev") + MINUTE, m - _RADIUS)
    reported = F.transform(
        F.filter(_window_starts(m), lambda ws: ws >= first_active),
        lambda ws: F.struct(ws.alias("ws"), F.size(_window_locations(F.col("_nbr"), ws)).alias("n_loc")))
    return nb.select("user_id", "_minute", reported.alias("reported"))


def _flagged_minutes(tx: DataFrame) -> DataFrame:
    """(user, active minute m, n_flagged): how many of the ten windows
    containing m hold two locations; only minutes with n_flagged > 0.

    Per-minute state is just min/max location (exact; partial aggregation
    before the shuffle, sort-based because the buffers are strings); a minute
    whose whole +-9 minute neighbourhood has one location is dropped before
    the per-window test."""
    per_minute = (_timed(tx)
                  .groupBy("user_id", "_minute")
                  .agg(F.min("location").alias("lo"), F.max("location").alias("hi")))
    nb = with_neighbours(per_minute, "user_id", "_minute", _RADIUS,
                         F.struct(F.col("_minute").alias("minute"), F.col("lo"), F.col("hi")),
                         "_nbr")
    nbr = F.col("_nbr")
    mixed = (F.array_min(F.transform(nbr, lambda e: e["lo"]))
             < F.array_max(F.transform(nbr, lambda e: e["hi"])))
    n_flagged = F.size(F.filter(_window_starts(F.col("_minute")), lambda ws: _window_flag(nbr, ws)))
    return (nb.filter(mixed)
            .select("user_id", "_minute", n_flagged.alias("n_flagged"))
            .filter(F.col("n_flagged") > 0))


def window_location_count(tx: DataFrame, only_mixed: bool = False) -> DataFrame:
    """``user_id, window_start, window_end, location_count`` (exact distinct
    count, NULL locations not counted) for every window that holds an event;
    events without a user share the windows of the NULL user."""
    w = (_minute_windows(tx, only_mixed)
         .select("user_id", F.explode("reported").alias("w")))
    return w.select(
        "user_id",
        ts_of(F.col("w.ws")).alias("window_start"),
        ts_of(F.col("w.ws") + WINDOW_MINUTES * MINUTE).alias("window_end"),
        F.col("w.n_loc").cast("long").alias("location_count"),
    )


def impossible_windows(tx: DataFrame) -> DataFrame:
    """Windows in which the user appears in more than one location."""
    return window_location_count(tx, only_mixed=True).filter(F.col("location_count") > 1)


def impossible_travel(tx: DataFrame) -> DataFrame:
    """Each event once per flagged window that contains it.

    The flagged (user, minute) table is usually small next to the events: it
    is materialised and broadcast when its row count allows, so the events are
    never shuffled for the join; else it is a sort-merge join on (user, minute)
    with skew splitting.
    """
    flagged = checked_broadcast(_flagged_minutes(tx))
    return (_timed(tx)
            .join(flagged, ["user_id", "_minute"])
            .withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("n_flagged"))))
            .select(*TX_COLUMNS, F.lit(REASON_TRAVEL).alias("fraud_reason")))


# --------------------------------------------------------------------------
# Exact pairwise detector
# --------------------------------------------------------------------------

def impossible_travel_exact(tx: DataFrame, gap_seconds: float = TRAVEL_GAP_SECONDS) -> DataFrame:
    """Events having another event of the same user, in a different (non-NULL)
    location, with ``|t - t'| <= gap``.  One row per qualifying event.

    Time is cut into slots (a minute; a tenth of a short gap).  Per (user, slot)
    it keeps the lowest and highest location, and the latest and the earliest
    time with the best time of any other location: slots that lie within the
    gap for every event of a slot decide by location alone, the slots at the
    edges by those times.  The work does not grow with the number of locations
    a user has in a slot.
    """
    gap = round(gap_seconds * MICROS_PER_SECOND)
    slot = MINUTE if gap >= 2 * MINUTE else max(1, gap // 10)
    inner = (gap - slot + 1) // slot * slot         # slots up to here lie within the gap
    outer = -(-gap // slot) * slot
    ev = (tx.filter(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull() & F.col("location").isNotNull())
          .withColumn("_us", micros(F.col("timestamp")))
          .withColumn("_slot", floor_to(F.col("_us"), slot)))
    per_loc = (ev.groupBy("user_id", "_slot", "location")
               .agg(F.min("_us").alias("tmin"), F.max("_us").alias("tmax")))
    by_slot = Window.partitionBy("user_id", "_slot")
    ranked = (per_loc
              .withColumn("_late", F.row_number().over(by_slot.orderBy(F.col("tmax").desc(), "location")))
              .withColumn("_early", F.row_number().over(by_slot.orderBy("tmin", "location"))))

    def best(rank: str, time: str, n: int) -> Column:
        return F.max(F.when(F.col(rank) == n, F.struct(F.col(time).alias("t"), F.col("location").alias("loc"))))

    per_slot = ranked.groupBy("user_id", "_slot").agg(
        F.min("location").alias("lo"), F.max("location").alias("hi"),
        F.array_compact(F.array(best("_late", "tmax", 1), best("_late", "tmax", 2))).alias("late"),
        F.array_compact(F.array(best("_early", "tmin", 1), best("_early", "tmin", 2))).alias("early"))
    nb = with_neighbours(per_slot, "user_id", "_slot", outer,
                         F.struct(F.col("_slot").alias("slot"), "lo", "hi", "late", "early"), "_nbr")
    m, nbr = F.col("_slot"), F.col("_nbr")
    near = F.filter(nbr, lambda e: F.abs(e["slot"] - m) <= inner)
    flags = checked_broadcast(
        nb.select("user_id", "_slot",
                  F.array_min(F.transform(near, lambda e: e["lo"])).alias("_lo"),
                  F.array_max(F.transform(near, lambda e: e["hi"])).alias("_hi"),
                  F.flatten(F.transform(F.filter(nbr, lambda e: e["slot"] < m - inner), lambda e: e["late"])).alias("_late"),
                  F.flatten(F.transform(F.filter(nbr, lambda e: e["slot"] > m + inner), lambda e: e["early"])).alias("_early"))
        .filter((F.col("_lo") < F.col("_hi")) | (F.size("_late") > 0) | (F.size("_early") > 0)))
    us, loc = F.col("_us"), F.col("location")
    return (ev.join(flags, ["user_id", "_slot"])
            .filter((F.col("_lo") != loc) | (F.col("_hi") != loc)
                    | F.exists("_late", lambda e: (e["loc"] != loc) & (us - e["t"] <= gap))
                    | F.exists("_early", lambda e: (e["loc"] != loc) & (e["t"] - us <= gap)))
            .select(*TX_COLUMNS, F.lit(REASON_TRAVEL).alias("fraud_reason")))


# --------------------------------------------------------------------------
# Combining detectors
# --------------------------------------------------------------------------

def fraud_union(*detected: DataFrame) -> DataFrame:
    """UNION ALL of detector outputs; an event may appear under several reasons."""
    out = detected[0].select(*FRAUD_COLUMNS)
    for df in detected[1:]:
        out = out.unionByName(df.select(*FRAUD_COLUMNS))
    return out


def detect_all(tx: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD, exact: bool = False) -> DataFrame:
    """Both detectors together: equal, as a multiset, to
    ``fraud_union(high_value(tx), impossible_travel(tx))``.

    The events are scanned once for the flag aggregation and once for a left
    join against the flagged minutes; each event then yields its high-value
    row (if any) and one travel row per flagged window in a single explode,
    instead of a third scan for the high-value branch.
    """
    if exact:
        return fraud_union(high_value(tx, threshold), impossible_travel_exact(tx))
    flagged = checked_broadcast(_flagged_minutes(tx))
    ev = tx.withColumn("_minute", minute_of(F.col("timestamp")))
    keyed = F.col("user_id").isNotNull() & F.col("_minute").isNotNull()
    high = F.when(F.col("amount") > F.lit(threshold), F.array(F.lit(REASON_HIGH_VALUE))) \
        .otherwise(F.array().cast("array<string>"))
    reasons = F.concat(high, F.array_repeat(F.lit(REASON_TRAVEL), F.coalesce(F.col("n_flagged"), F.lit(0)).cast("int")))
    # events without a user or time match no minute: they pass beside the join
    return (ev.filter(keyed).join(flagged, ["user_id", "_minute"], "left")
            .select(*TX_COLUMNS, F.explode(reasons).alias("fraud_reason"))
            .unionByName(ev.filter(~keyed).select(*TX_COLUMNS, F.explode(high).alias("fraud_reason"))))


def fraud_distinct(fraud: DataFrame) -> DataFrame:
    """One row per (event, reason)."""
    return fraud.select(*FRAUD_COLUMNS).dropDuplicates(FRAUD_COLUMNS)


def validated_events(tx: DataFrame, threshold: float = HIGH_VALUE_THRESHOLD) -> DataFrame:
    """Transactions that no detector flags, straight from the events: not above
    the threshold and not in a flagged minute of their user.  Equal events share
    user, minute and amount, so this is what ``validated_anti`` returns for the
    detectors' own output, with one anti-join on (user, minute)."""
    flagged = checked_broadcast(_flagged_minutes(tx).select("user_id", "_minute"))
    low = tx.filter(~F.coalesce(F.col("amount") > F.lit(threshold), F.lit(False))) \
        .withColumn("_minute", minute_of(F.col("timestamp")))
    keyed = F.col("user_id").isNotNull() & F.col("_minute").isNotNull()
    return (low.filter(keyed).join(flagged, ["user_id", "_minute"], "left_anti").select(*TX_COLUMNS)
            .unionByName(low.filter(~keyed).select(*TX_COLUMNS)))


def validated_anti(tx: DataFrame, fraud: DataFrame) -> DataFrame:
    """Transactions that are not in a stored fraud table (NULL-safe match on the
    5-tuple; there is no transaction id).  The fraud side is reduced to distinct keys
    first: the copies one event gets per flagged window sit in the same map
    task, so the partial aggregation removes them before the shuffle."""
    keys = checked_broadcast(fraud.select(*[F.col(c).alias(f"_k_{c}") for c in TX_COLUMNS]).distinct())
    cond = None
    for c in TX_COLUMNS:
        term = F.col(c).eqNullSafe(F.col(f"_k_{c}"))
        cond = term if cond is None else cond & term
    return tx.select(*TX_COLUMNS).join(keys, cond, "left_anti")
