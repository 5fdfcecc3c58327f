"""Bounded per-user neighbourhoods in event time.

Both travel detectors ask, for every minute in which a user was active, what
the same user did within a few minutes around it.  The per-user data is first
pre-aggregated to (user, minute[, location]) rows, so a user's row count is
bounded by the minutes in the data's time span, not by the user's event count.
Rows are then grouped by (user, day) instead of by user: each row is copied
into the neighbouring day as a read-only *halo* row when it lies within
``radius`` of the day boundary.  A window partition therefore never holds more
than one day of minutes (plus 2 x radius) of one user, however hot the user.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tripwire.functions.timecols import DAY, floor_to


def with_neighbours(rows: DataFrame, user: str, minute: str, radius_us: int,
                    payload: Column, name: str, prev_name: str | None = None) -> DataFrame:
    """Adds ``name`` = list of ``payload`` over the user's rows whose ``minute``
    lies within ``±radius_us`` (inclusive), and optionally ``prev_name`` = the
    user's previous distinct ``minute`` (NULL when further back than ``radius_us``).

    Only the home copy of each input row is returned.
    """
    m = F.col(minute)
    day = floor_to(m, DAY)
    offset = m - day
    copies = F.filter(
        F.array(
            F.struct(day.alias("bucket"), F.lit(True).alias("home"), F.lit(True).alias("keep")),
            F.struct((day - DAY).alias("bucket"), F.lit(False).alias("home"),
                     (offset < radius_us).alias("keep")),
            F.struct((day + DAY).alias("bucket"), F.lit(False).alias("home"),
                     (offset >= DAY - radius_us).alias("keep")),
        ),
        lambda c: c["keep"],
    )
    spread = (rows.withColumn("_copy", F.explode(copies))
              .withColumn("_bucket", F.col("_copy.bucket"))
              .withColumn("_home", F.col("_copy.home"))
              .drop("_copy"))
    part = Window.partitionBy(user, "_bucket").orderBy(minute)
    out = spread.withColumn(name, F.collect_list(payload).over(part.rangeBetween(-radius_us, radius_us)))
    if prev_name is not None:
        prev = F.max(m).over(part.rangeBetween(-radius_us, -1))
        out = out.withColumn(prev_name, prev)
    return out.filter(F.col("_home")).drop("_bucket", "_home")
