"""Summaries from stored daily sketches.

Each event date keeps one row (counts, the parts of the exact total, the largest
amount, a distinct sketch of the users, a quantile sketch of the amounts) and one
row per category and per reason with its count.  All of it merges, so the
summary of any range of dates reads these few rows and no event:

    <root>/daily/event_date=D/     one row
    <root>/values/event_date=D/    (column, value, n)

Counts, totals, the maximum and the most common values are exact.  The median
is an amount whose rank is within ``RANK_ERROR`` of the middle (99 of 100 times),
the number of users has a relative standard error of ``USERS_ERROR``.

Storing a date again replaces it.  A date whose ``daily`` row is written counts
as stored; ``values`` is written first.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.functions.money import money_merged, money_parts, present, round2

QUANTILE_K = 400
RANK_ERROR = 0.0075         # of k = 400, single sided, 99 %
USERS_LOG_K = 14
USERS_ERROR = 0.0082        # 1.04 / sqrt(2 ** 14)
COUNTED = ["merchant_category", "fraud_reason"]

DAILY = T.StructType([
    T.StructField("rows", T.LongType()), T.StructField("amounts", T.LongType()),
    T.StructField("exact", T.DecimalType(38, 8)), T.StructField("rest", T.DoubleType()),
    T.StructField("largest", T.DoubleType()), T.StructField("users", T.BinaryType()),
    T.StructField("quantiles", T.BinaryType()), T.StructField("event_date", T.DateType())])
VALUES = T.StructType([
    T.StructField("column", T.StringType()), T.StructField("value", T.StringType()), T.StructField("n", T.LongType()),
    T.StructField("event_date", T.DateType())])


def dated(fraud: DataFrame) -> DataFrame:
    return fraud.withColumn("event_date", F.to_date("timestamp"))


def daily_sketches(fraud: DataFrame) -> DataFrame:
    """One row per event date of ``dated`` rows (rows without a time: a NULL date)."""
    exact, rest = money_parts("amount")
    return fraud.groupBy("event_date").agg(
        F.count(F.lit(1)).alias("rows"), F.count(present("amount")).alias("amounts"),
        exact.cast("decimal(38,8)").alias("exact"), rest.alias("rest"), F.max(present("amount")).alias("largest"),
        F.hll_sketch_agg("user_id", F.lit(USERS_LOG_K)).alias("users"),
        F.kll_sketch_agg_double(present("amount"), F.lit(QUANTILE_K)).alias("quantiles")).select(*DAILY.names)


def daily_values(fraud: DataFrame) -> DataFrame:
    """(column, value, n) per event date; an absent value is no value."""
    each = F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("value")) for c in COUNTED]))
    return (fraud.select("event_date", each.alias("v")).filter(F.col("v.value").isNotNull())
            .groupBy("event_date", F.col("v.column").alias("column"), F.col("v.value").alias("value"))
            .agg(F.count(F.lit(1)).alias("n")).select(*VALUES.names))


def store_sketches(fraud: DataFrame, root: str) -> None:
    """Writes the sketches of all dates of ``dated`` rows; each date must be whole."""
    for table, rows in (("values", daily_values(fraud)), ("daily", daily_sketches(fraud))):
        (rows.hint("rebalance", "event_date").write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
         .partitionBy("event_date").parquet(f"{root.rstrip('/')}/{table}"))


def _between(rows: DataFrame, first: str | None, last: str | None) -> DataFrame:
    if first is not None:
        rows = rows.filter(F.col("event_date") >= F.lit(first).cast("date"))
    if last is not None:
        rows = rows.filter(F.col("event_date") <= F.lit(last).cast("date"))
    return rows


def quantile(sketch: Column, rank: float) -> Column:
    return F.kll_sketch_get_quantile_double(sketch, F.lit(rank))


def merged_summary(spark: SparkSession, root: str, first: str | None = None, last: str | None = None) -> DataFrame:
    """``analytics.summary`` of the dates ``first`` .. ``last`` (ISO, both
    inclusive; None: open) from the stored rows; zero rows when there are none."""
    root = root.rstrip("/")
    days = _between(spark.read.schema(DAILY).parquet(f"{root}/daily"), first, last)
    total = money_merged(F.col("exact"), F.col("rest"))
    # a date without amounts has a sketch of nothing
    some = F.when(F.col("amounts") > 0, F.col("quantiles"))
    head = days.agg(
        F.sum("rows").alias("total_fraud_transactions"),
        round2(F.coalesce(total, F.lit(0.0))).alias("total_fraud_amount"),
        round2(total / F.sum("amounts")).alias("average_fraud_amount"),
        F.kll_merge_agg_double(some).alias("_quantiles"), F.sum("amounts").alias("_amounts"),
        F.max("largest").alias("max_fraud_amount"),
        F.hll_sketch_estimate(F.hll_union_agg("users")).alias("unique_users_affected"),
    ).filter(F.col("total_fraud_transactions") > 0)
    counted = (_between(spark.read.schema(VALUES).parquet(f"{root}/values"), first, last)
               .groupBy("column", "value").agg(F.sum("n").alias("n")))
    common = counted.agg(F.struct(*[
        F.min(F.when(F.col("column") == c, F.struct((-F.col("n")).alias("n"), "value")))["value"].alias(f"_{c}")
        for c in COUNTED])).scalar()
    median = F.when(F.col("_amounts") > 0, quantile(F.col("_quantiles"), 0.5))
    return (head.select("*", common.alias("_common"))
            .select("total_fraud_transactions", "total_fraud_amount", "average_fraud_amount",
                    round2(median).alias("median_fraud_amount"), "max_fraud_amount", "unique_users_affected",
                    F.col("_common._merchant_category").alias("most_common_category"),
                    F.col("_common._fraud_reason").alias("most_common_reason")))
