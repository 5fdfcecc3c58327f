"""Validated totals that grow by increments.

The full history is never summed again: each call of ``advance`` reads the batches
the speed layer completed since the last one and writes their partial sums, one
row per query and event hour.  Partial sums merge exactly (decimal amounts as
decimals, the few others as doubles, as in ``functions.money``), so ``merged_totals``
equals ``validated_totals`` over all rows, late ones included: rows belong to the
batch that brought them, whatever their event time.

    <partials>/query_id=Q/since=N/    sums of the batches N .. ``last``

The mark of a query is the greatest ``last``; batches above it are the next
increment.  A run that is repeated after a failure starts from the same mark and
replaces the directory it may have written.  A batch counts as complete when its
state is written (its last output), so none is read half done.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.functions.money import money_merged, money_parts
from tripwire.sinks.compaction import Folder
from tripwire.streaming.speed_layer import read_rows

PARTIALS = T.StructType([
    T.StructField("hour", T.TimestampType()), T.StructField("transaction_count", T.LongType()),
    T.StructField("exact", T.DecimalType(38, 8)), T.StructField("rest", T.DoubleType()), T.StructField("last", T.LongType()),
    T.StructField("query_id", T.StringType()), T.StructField("since", T.LongType())])


def complete_batches(spark: SparkSession, base: str) -> dict[str, int]:
    """Per query of the speed layer its last complete batch (one entry a checkpoint)."""
    newest: dict[str, int] = {}
    for query, batch, _ in Folder(spark, base).names("state/query_id=*/batch_id=*/_SUCCESS", 3):
        query, number = query.split("=", 1)[1], int(batch.split("=", 1)[1])
        newest[query] = max(number, newest.get(query, -1))
    return newest


def partial_sums(spark: SparkSession, partials: str) -> DataFrame:
    """The stored partial sums (zero rows before the first ``advance``)."""
    if not Folder(spark, partials).names("query_id=*/since=*", 2):
        return spark.createDataFrame([], PARTIALS)
    return spark.read.schema(PARTIALS).parquet(partials)


def marks(spark: SparkSession, partials: str) -> dict[str, int]:
    """Per query the last batch that is summed (one row a checkpoint)."""
    return {r[0]: r[1] for r in partial_sums(spark, partials).groupBy("query_id").agg(F.max("last")).collect()}


def unsummed(spark: SparkSession, base: str, partials: str) -> DataFrame | None:
    """The rows of the complete batches above the marks: a filter on the
    partition columns, so directories below them are not opened.  None when
    there are none."""
    done, complete = marks(spark, partials), complete_batches(spark, base)
    ranges = {q: (done.get(q, -1), n) for q, n in complete.items() if n > done.get(q, -1)}
    if not ranges:
        return None
    wanted = F.lit(False)
    for query, (mark, newest) in sorted(ranges.items()):
        wanted = wanted | ((F.col("query_id") == query) & (F.col("batch_id") > mark) & (F.col("batch_id") <= newest))
    since = F.coalesce(*[F.when(F.col("query_id") == q, F.lit(mark + 1)) for q, (mark, _) in sorted(ranges.items())])
    newest = F.coalesce(*[F.when(F.col("query_id") == q, F.lit(n)) for q, (_, n) in sorted(ranges.items())])
    return (read_rows(spark, base).filter(wanted)
            .withColumn("since", since.cast("long")).withColumn("last", newest.cast("long")))


def advance(spark: SparkSession, base: str, partials: str) -> bool:
    """Sums what is new below ``base`` into ``partials``; False when nothing was."""
    rows = unsummed(spark, base, partials)
    if rows is None:
        return False
    exact, rest = money_parts("amount")
    sums = (rows.groupBy("query_id", "since", F.date_trunc("hour", "timestamp").alias("hour"))
            .agg(F.count(F.lit(1)).alias("transaction_count"), exact.cast("decimal(38,8)").alias("exact"), rest.alias("rest"),
                 F.max("last").alias("last")))
    (sums.select(*PARTIALS.names).hint("rebalance", "query_id").write.mode("overwrite")
     .option("partitionOverwriteMode", "dynamic").partitionBy("query_id", "since").parquet(partials))
    return True


def merged_totals(sums: DataFrame) -> DataFrame:
    """``validated_totals`` from partial sums."""
    total = money_merged(F.col("exact"), F.col("rest"))
    return sums.agg(F.coalesce(F.sum("transaction_count"), F.lit(0)).cast("long").alias("transaction_count"),
                    F.coalesce(total, F.lit(0.0)).alias("total_amount"))


def hourly_totals(sums: DataFrame) -> DataFrame:
    """The same per event hour (one row an hour; NULL: rows without a time)."""
    return sums.groupBy("hour").agg(F.sum("transaction_count").alias("transaction_count"),
                                    money_merged(F.col("exact"), F.col("rest")).alias("total_amount"))
