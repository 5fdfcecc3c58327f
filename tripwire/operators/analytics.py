"""Report tables over any fraud DataFrame (usually a look-back slice).

Semantics follow the report's data-frame library: group keys that are NULL
form no group, counts/sums/means skip missing (NULL or NaN) amounts, rounding is
half-even to two decimals, ``mode`` ties resolve to the smallest value.  Empty input gives
zero rows everywhere (the report stops on empty input).
"""

from __future__ import annotations

import math

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.config import DENSITY_GRID_POINTS, HISTOGRAM_BINS, TOP_CATEGORIES
from tripwire.functions.money import money_avg, money_sum, present, round2


def _grouped(fraud: DataFrame, key, with_max: bool = False, with_users: bool = False) -> DataFrame:
    aggs = [
        F.count(present("amount")).alias("fraud_count"),
        round2(F.coalesce(money_sum("amount"), F.lit(0.0))).alias("total_amount"),
        round2(money_avg("amount")).alias("avg_amount"),
    ]
    if with_max:
        aggs.append(round2(F.max(present("amount"))).alias("max_amount"))
    if with_users:
        aggs.append(F.countDistinct("user_id").alias("unique_users"))
    keyed = fraud.withColumn("_key", key) if not isinstance(key, str) else fraud.withColumn("_key", F.col(key))
    return keyed.filter(F.col("_key").isNotNull()).groupBy("_key").agg(*aggs)


def by_category(fraud: DataFrame) -> DataFrame:
    return (_grouped(fraud, "merchant_category", with_max=True, with_users=True)
            .withColumnRenamed("_key", "merchant_category")
            .orderBy(F.col("fraud_count").desc(), "merchant_category"))


def by_reason(fraud: DataFrame) -> DataFrame:
    return (_grouped(fraud, "fraud_reason", with_users=True)
            .withColumnRenamed("_key", "fraud_reason")
            .orderBy("fraud_reason"))


def by_location(fraud: DataFrame) -> DataFrame:
    return (_grouped(fraud, "location")
            .withColumnRenamed("_key", "location")
            .orderBy(F.col("fraud_count").desc(), "location"))


def by_hour(fraud: DataFrame) -> DataFrame:
    """Hour of day (0-23, UTC wall clock); only hours that occur."""
    return (_grouped(fraud, F.hour("timestamp"))
            .withColumnRenamed("_key", "hour")
            .orderBy("hour"))


def _most_common(fraud: DataFrame, column: str, alias: str) -> DataFrame:
    """One row: the most frequent value (ties: the smallest), NULL when none is set."""
    counts = fraud.filter(F.col(column).isNotNull()).groupBy(column).agg(F.count(F.lit(1)).alias("_n"))
    return counts.agg(F.min(F.struct((-F.col("_n")).alias("_n"), F.col(column).alias("_v")))["_v"].alias(alias))


def summary(fraud: DataFrame, approx_median: bool = False) -> DataFrame:
    """One row of headline numbers (zero rows on empty input).

    The median is exact and distributed (``quantiles.exact_median``);
    ``approx_median`` switches to the ``percentile_approx`` sketch.  The most
    common values come from grouped counts, so no task holds a map of all
    values.  All parts are one-row tables.
    """
    from tripwire.operators.quantiles import exact_median

    amount = present("amount")
    head = fraud.agg(
        F.count(F.lit(1)).alias("total_fraud_transactions"),
        round2(F.coalesce(money_sum("amount"), F.lit(0.0))).alias("total_fraud_amount"),
        round2(money_avg("amount")).alias("average_fraud_amount"),
        F.max(amount).alias("max_fraud_amount"),
        *([F.percentile_approx(amount, 0.5).alias("_median")] if approx_median else []),
    ).filter(F.col("total_fraud_transactions") > 0)
    users = fraud.filter(F.col("user_id").isNotNull()).select("user_id").distinct() \
        .agg(F.count(F.lit(1)).alias("unique_users_affected"))
    parts = [users, _most_common(fraud, "merchant_category", "most_common_category"),
             _most_common(fraud, "fraud_reason", "most_common_reason")]
    out = head
    for part in parts:
        out = out.crossJoin(F.broadcast(part))
    if not approx_median:
        # the median row is absent only when no amount is set
        out = out.join(F.broadcast(exact_median(fraud, amount, "_median")), how="left")
    return out.select(
        "total_fraud_transactions", "total_fraud_amount", "average_fraud_amount",
        round2(F.col("_median")).alias("median_fraud_amount"),
        "max_fraud_amount", "unique_users_affected", "most_common_category", "most_common_reason")


def top_categories(fraud: DataFrame, k: int = TOP_CATEGORIES) -> DataFrame:
    """The ``k`` most frequent categories (ties: alphabetical)."""
    return (fraud.filter(F.col("merchant_category").isNotNull())
            .groupBy("merchant_category").agg(F.count(F.lit(1)).alias("fraud_count"))
            .orderBy(F.col("fraud_count").desc(), "merchant_category")
            .limit(k))


def reason_share(fraud: DataFrame) -> DataFrame:
    """Count per reason and its percentage of all rows with a reason (1 decimal)."""
    counts = (fraud.filter(F.col("fraud_reason").isNotNull())
              .groupBy("fraud_reason").agg(F.count(F.lit(1)).alias("fraud_count")))
    total = counts.agg(F.sum("fraud_count").alias("_total"))
    return (counts.crossJoin(F.broadcast(total))
            .select("fraud_reason", "fraud_count",
                    F.bround(F.col("fraud_count") * 100.0 / F.col("_total"), 1).alias("percentage"))
            .orderBy(F.col("fraud_count").desc(), "fraud_reason"))


def timeline_hourly(fraud: DataFrame) -> DataFrame:
    """Rows per clock hour; hours without fraud are absent."""
    return (fraud.filter(F.col("timestamp").isNotNull())
            .groupBy(F.date_trunc("hour", "timestamp").alias("hour_start"))
            .agg(F.count(F.lit(1)).alias("fraud_count"))
            .orderBy("hour_start"))


def _amount_range(fraud: DataFrame) -> DataFrame:
    """One row: n, lo, hi of the present amounts, widened by 0.5 each way
    when all amounts are equal (the histogram library's rule)."""
    st = fraud.filter(present("amount").isNotNull()).agg(
        F.count(F.lit(1)).alias("n"), F.min("amount").alias("_min"), F.max("amount").alias("_max"),
        F.stddev_samp("amount").alias("sd"))
    same = F.col("_min") == F.col("_max")
    return (st.filter(F.col("n") > 0)
            .withColumn("lo", F.when(same, F.col("_min") - 0.5).otherwise(F.col("_min")))
            .withColumn("hi", F.when(same, F.col("_max") + 0.5).otherwise(F.col("_max")))
            .drop("_min", "_max"))


def amount_histogram(fraud: DataFrame, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """``bins`` equal-width bins over [min, max]; the last bin is closed.
    Every bin is returned, empty ones with count 0.

    A bin holds the amounts from its own edge up to the next one, by comparison
    with the edges that are returned: the scaled position only says which
    neighbouring edges to compare with."""
    rng = F.broadcast(_amount_range(fraud).select("lo", "hi"))
    lo, hi, amount = F.col("lo"), F.col("hi"), F.col("amount")
    width = (hi - lo) / bins

    def edge(i):
        return F.when(i >= bins, hi).otherwise(lo + i * width)

    guess = F.least(F.floor((amount - lo) / (hi - lo) * bins), F.lit(bins - 1))
    idx = (guess - F.when((guess > 0) & (amount < edge(guess)), 1).otherwise(0)
           + F.when((guess < bins - 1) & (amount >= edge(guess + 1)), 1).otherwise(0) + 1).cast("int")
    counts = (fraud.filter(present("amount").isNotNull())
              .crossJoin(rng)
              .groupBy(idx.alias("bin")).agg(F.count(F.lit(1)).alias("fraud_count")))
    grid = (fraud.sparkSession.range(1, bins + 1).select(F.col("id").cast("int").alias("bin"))
            .crossJoin(rng))
    return (grid.join(F.broadcast(counts), "bin", "left")
            .select("bin", edge(F.col("bin") - 1).alias("bin_start"), edge(F.col("bin")).alias("bin_end"),
                    F.coalesce(F.col("fraud_count"), F.lit(0)).cast("long").alias("fraud_count"))
            .orderBy("bin"))


def amount_density(fraud: DataFrame, points: int = DENSITY_GRID_POINTS, bins: int = HISTOGRAM_BINS) -> DataFrame:
    """Gaussian kernel density of the amounts on ``points`` evenly spaced
    points from min to max; bandwidth = sample std * n^(-1/5) (Scott's rule).

    ``density`` integrates to 1; ``expected_count`` is the curve scaled to the
    histogram (density * n * bin width).  Rows are first reduced to
    (amount, multiplicity), so the work is distinct amounts x grid points.
    """
    rng = _amount_range(fraud).filter(F.col("sd") > 0)
    h = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    params = F.broadcast(rng.select("n", "lo", "hi", h.alias("bw")))
    step = (F.col("hi") - F.col("lo")) / (points - 1)
    grid = (fraud.sparkSession.range(points).select(F.col("id").cast("int").alias("point"))
            .crossJoin(params)
            .select("point", "n", "bw", "lo", "hi", (F.col("lo") + F.col("point") * step).alias("x")))
    weights = (fraud.filter(present("amount").isNotNull())
               .groupBy("amount").agg(F.count(F.lit(1)).alias("w")))
    z = (F.col("x") - F.col("amount")) / F.col("bw")
    dens = (weights.crossJoin(F.broadcast(grid))
            .groupBy("point", "x", "n", "bw", "lo", "hi")
            .agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("_k")))
    norm = F.col("n") * F.col("bw") * F.lit((2 * 3.141592653589793) ** 0.5)
    density = F.col("_k") / norm
    return (dens.select(
        "point", F.col("x").alias("amount"), density.alias("density"),
        (density * F.col("n") * (F.col("hi") - F.col("lo")) / bins).alias("expected_count"))
        .orderBy("point"))


def amount_density_binned(fraud: DataFrame, points: int = DENSITY_GRID_POINTS, bins: int = HISTOGRAM_BINS,
                          cells_per_bandwidth: int = 32, reach: float = 8.0) -> DataFrame:
    """``amount_density`` by linear binning: the work does not follow the number
    of distinct amounts.

    Cells of ``1 / cells_per_bandwidth`` bandwidths divide the range; an amount
    gives its weight to the two ends of its cell, by nearness, which is the kernel
    interpolated linearly between them.  A cell end counts at the points within ``reach``
    bandwidths, so at most ``points * (2 * reach * cells_per_bandwidth + 2)`` pairs
    are formed.  The density differs from the exact one by at most
    ``density_error(bandwidth, cells_per_bandwidth, reach)``.
    """
    rng = _amount_range(fraud).filter(F.col("sd") > 0)
    bw = F.col("sd") * F.pow(F.col("n").cast("double"), F.lit(-0.2))
    params = rng.select(F.struct("n", "lo", "hi", bw.alias("bw"), ((F.col("hi") - F.col("lo")) / (points - 1)).alias("step"))).scalar()

    def with_params(rows: DataFrame) -> DataFrame:
        """``rows`` beside the one row of parameters; none without a spread."""
        return rows.select("*", params.alias("_p")).filter(F.col("_p").isNotNull()).select(*rows.columns, "_p.*")

    position = (F.col("amount") - F.col("lo")) / F.col("bw") * cells_per_bandwidth
    cells = (with_params(fraud.filter(present("amount").isNotNull()).select("amount"))
             .select(F.floor(position).alias("cell"), (position - F.floor(position)).alias("_up"))
             .groupBy("cell").agg(F.count(F.lit(1)).alias("_c"), F.sum("_up").alias("_up")))
    ends = (cells.select(F.explode(F.array(
                F.struct(F.col("cell").alias("cell"), (F.col("_c") - F.col("_up")).alias("w")),
                F.struct((F.col("cell") + 1).alias("cell"), F.col("_up").alias("w")))).alias("e"))
            .groupBy(F.col("e.cell").alias("cell")).agg(F.sum("e.w").alias("w")))
    offset = F.col("cell") * F.col("bw") / cells_per_bandwidth
    first = F.greatest(F.ceil((offset - F.col("bw") * reach) / F.col("step")), F.lit(0))
    last = F.least(F.floor((offset + F.col("bw") * reach) / F.col("step")), F.lit(points - 1))
    z = (F.col("point") * F.col("step") - F.col("offset")) / F.col("bw")
    near = (with_params(ends)
            .select("w", "bw", "step", offset.alias("offset"),
                    F.explode(F.when(first <= last, F.sequence(first, last))).alias("point"))
            .groupBy(F.col("point").cast("int").alias("point")).agg(F.sum(F.col("w") * F.exp(-0.5 * z * z)).alias("_k")))
    grid = with_params(fraud.sparkSession.range(points).select(F.col("id").cast("int").alias("point")))
    density = F.coalesce(F.col("_k"), F.lit(0.0)) / (F.col("n") * F.col("bw") * F.lit((2 * 3.141592653589793) ** 0.5))
    return (grid.join(F.broadcast(near), "point", "left")
            .select("point", (F.col("lo") + F.col("point") * F.col("step")).alias("amount"), density.alias("density"),
                    (density * F.col("n") * (F.col("hi") - F.col("lo")) / bins).alias("expected_count"))
            .orderBy("point"))


def density_error(bandwidth: float, cells_per_bandwidth: int = 32, reach: float = 8.0) -> float:
    """The bound of ``amount_density_binned``: linear interpolation (an eighth of
    the squared step times the greatest curvature of the kernel, its peak) and
    the kernel left out beyond the reach."""
    peak = 1.0 / (bandwidth * (2 * 3.141592653589793) ** 0.5)
    return peak * (1.0 / (8 * cells_per_bandwidth ** 2) + math.exp(-reach * reach / 2))
