"""Exact median without a single-task buffer or a full sort.

A sketch gives a few bucket bounds (their number is fixed, whatever the cluster
or the data).  One aggregate counts the values per bucket; the bucket, or the
two, that hold the middle ranks follow from these few counts.  Only their
values are grouped and ranked.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 64


def exact_median(df: DataFrame, value: str | Column, alias: str = "median",
                 buckets: int = BUCKETS) -> DataFrame:
    """One row holding the median of the non-NULL values (mean of the two
    middle values when their count is even); zero rows when there are none."""
    v = F.col(value) if isinstance(value, str) else value
    values = df.select(v.alias("_v")).filter(F.col("_v").isNotNull())
    probs = [i / buckets for i in range(1, buckets)]
    bounds = values.agg(F.percentile_approx("_v", probs, 10_000).alias("_b"))
    # a value's bucket: how many bounds lie below it, by halving
    steps = [1 << k for k in reversed(range((buckets - 1).bit_length()))]

    def halve(at: Column, step: int) -> Column:
        return at + F.when(F.get("_b", at + (step - 1)) < F.col("_v"), step).otherwise(0)

    placed = values.crossJoin(F.broadcast(bounds)).withColumn("_bk", F.lit(0))
    placed = reduce(lambda d, step: d.withColumn("_bk", halve(F.col("_bk"), step)), steps, placed).select("_v", "_bk")
    totals = placed.groupBy("_bk").agg(F.count(F.lit(1)).alias("_n"))
    listed = F.array_sort(F.collect_list(F.struct("_bk", "_n")))        # at most ``buckets`` entries
    whole = totals.agg(listed.alias("_t"), F.sum("_n").alias("_all"))
    before = whole.select(
        "_all", F.explode(F.transform("_t", lambda t: F.struct(
            t["_bk"].alias("_bk"), t["_n"].alias("_n"),
            F.aggregate(F.filter("_t", lambda o: o["_bk"] < t["_bk"]), F.lit(0).cast("long"),
                        lambda a, o: a + o["_n"]).alias("_off")))).alias("_e")).select("_all", "_e.*")
    # 0-based ranks of the middle element(s)
    lo_rank, hi_rank = F.floor((F.col("_all") - 1) / 2), F.ceil((F.col("_all") - 1) / 2)
    middle = before.filter((F.col("_off") <= hi_rank) & (F.col("_off") + F.col("_n") > lo_rank))
    inside = (placed.join(F.broadcast(middle), "_bk")
              .groupBy("_bk", "_v", "_off", "_all").agg(F.count(F.lit(1)).alias("_c"))
              .withColumn("_cum", F.col("_off") + F.sum("_c").over(
                  Window.partitionBy("_bk").orderBy("_v").rowsBetween(Window.unboundedPreceding, Window.currentRow))))

    def covers(r):
        return (F.col("_cum") - F.col("_c") <= r) & (r < F.col("_cum"))

    return inside.agg(
        ((F.max(F.when(covers(lo_rank), F.col("_v"))) + F.max(F.when(covers(hi_rank), F.col("_v")))) / 2)
        .alias(alias)).filter(F.col(alias).isNotNull())
