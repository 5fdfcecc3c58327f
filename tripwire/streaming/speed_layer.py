"""One read, many sinks: the whole speed layer as one streaming query.

The query has a single source and no stateful operator; each micro-batch is read
once and feeds every sink through ``foreachBatch``.  Below ``base``:

    validated/query_id=Q/batch_id=N   all rows of the batch
    late/query_id=Q/batch_id=N        rows whose windows were all closed before the batch came
    fraud/...                         high-value rows, and the travel rows of the windows that the
                                      watermark closed with this batch (``FraudTableWriter``)
    state/query_id=Q/batch_id=N       the open events, and the watermark after the batch

The detectors are batch operators over the open events: what the previous batch
left and the rows of this one.  The watermark is the latest event time less its
delay.  Rows are late against the watermark *before* their batch, windows close
by the one after it, so no window is decided twice or changed once decided.

Every output is a directory of its batch, replaced when the batch is repeated,
and a batch reads only the state its predecessor wrote; state is written last.
A crash at any point and a restart give the same tables, and a fresh checkpoint
(another query id) overwrites nothing.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import StreamingQuery

from tripwire.config import HIGH_VALUE_THRESHOLD, MICROS_PER_MINUTE, REASON_TRAVEL, WATERMARK_DELAY, WINDOW_MINUTES
from tripwire.functions.timecols import micros, minute_of
from tripwire.operators.detect import high_value
from tripwire.schema import TRANSACTION, TX_COLUMNS
from tripwire.sinks.fraud_table import OUTSIDE_A_QUERY, FraudTableWriter

_LENGTH = WINDOW_MINUTES * MICROS_PER_MINUTE
_START = -(1 << 62)          # the watermark before any event
_KEPT_STATES = 3
# One row beside the open events carries the watermark.
_STATE = T.StructType([*TRANSACTION.fields, T.StructField("watermark", T.LongType())])


def delay_micros(spark: SparkSession, delay: str) -> int:
    """An interval text such as ``15 minutes`` in microseconds."""
    return spark.range(1).select(F.unix_micros(F.timestamp_micros(F.lit(0)) + F.expr(f"INTERVAL {delay}"))).first()[0]


def _window_ends(minute: Column, after: int, until: int) -> Column:
    """The ends in ``(after, until]`` of the sliding windows over a minute."""
    first = F.greatest(minute + MICROS_PER_MINUTE, F.lit(after - after % MICROS_PER_MINUTE + MICROS_PER_MINUTE))
    last = F.least(minute + _LENGTH, F.lit(until - until % MICROS_PER_MINUTE))
    return F.explode(F.when(first <= last, F.sequence(first, last, F.lit(MICROS_PER_MINUTE))))


def closed_travel(events: DataFrame, after: int, until: int) -> DataFrame:
    """Travel rows of the windows that end in ``(after, until]`` (microseconds):
    every event once per flagged window that holds it."""
    known = events.filter(F.col("user_id").isNotNull() & F.col("timestamp").isNotNull())
    minutes = (known.groupBy("user_id", minute_of(F.col("timestamp")).alias("_minute"))
               .agg(F.min("location").alias("_lo"), F.max("location").alias("_hi")))
    flagged = (minutes.select("user_id", "_lo", "_hi", _window_ends(F.col("_minute"), after, until).alias("_end"))
               .groupBy("user_id", "_end").agg(F.min("_lo").alias("_lo"), F.max("_hi").alias("_hi"))
               .filter(F.col("_lo") < F.col("_hi")).select("user_id", "_end"))
    spread = known.select(*TX_COLUMNS, _window_ends(minute_of(F.col("timestamp")), after, until).alias("_end"))
    return (spread.join(flagged, ["user_id", "_end"])
            .select(*TX_COLUMNS, F.lit(REASON_TRAVEL).alias("fraud_reason")))


def _remove(spark: SparkSession, path: str) -> None:
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    where.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(where, True)


@dataclass
class SpeedLayer:
    """The ``foreachBatch`` function of the one query."""

    base: str
    threshold: float = HIGH_VALUE_THRESHOLD
    delay: str = WATERMARK_DELAY
    writer: FraudTableWriter | None = None
    query_id: str | None = None         # default: the running streaming query's
    _delay: int | None = field(default=None, repr=False)

    def path(self, table: str, query_id: str, batch_id: int) -> str:
        return f"{self.base.rstrip('/')}/{table}/query_id={query_id}/batch_id={batch_id}"

    def __call__(self, batch: DataFrame, batch_id: int) -> None:
        spark = batch.sparkSession
        query = self.query_id or spark.sparkContext.getLocalProperty("sql.streaming.queryId") or OUTSIDE_A_QUERY
        if self._delay is None:
            self._delay = delay_micros(spark, self.delay)
        before, left = _START, None
        if batch_id > 0:
            held = spark.read.schema(_STATE).parquet(self.path("state", query, batch_id - 1))
            before = held.agg(F.max("watermark")).first()[0]          # one row
            left = held.filter(F.col("watermark").isNull()).select(*TX_COLUMNS)
        rows = batch.select(*TX_COLUMNS).persist()
        try:
            latest = rows.agg(F.max(micros(F.col("timestamp")))).first()[0]
            now = before if latest is None else max(before, latest - self._delay)
            ends = minute_of(F.col("timestamp")) + _LENGTH
            rows.write.mode("overwrite").parquet(self.path("validated", query, batch_id))
            rows.filter(ends <= before).write.mode("overwrite").parquet(self.path("late", query, batch_id))
            fresh = rows.filter(ends > before)
            held = fresh if left is None else left.unionByName(fresh)
            fraud = high_value(rows, self.threshold).unionByName(closed_travel(held, before, now))
            writer = self.writer or FraudTableWriter(f"{self.base.rstrip('/')}/fraud")
            writer(fraud, batch_id)
            mark = spark.createDataFrame([(*[None] * len(TX_COLUMNS), now)], _STATE)
            (held.filter(ends > now).withColumn("watermark", F.lit(None).cast("long")).unionByName(mark)
             .write.mode("overwrite").parquet(self.path("state", query, batch_id)))
        finally:
            rows.unpersist()
        if batch_id >= _KEPT_STATES:
            _remove(spark, self.path("state", query, batch_id - _KEPT_STATES))


def start_speed_layer(tx: DataFrame, base: str, checkpoint: str | None = None, available_now: bool = False,
                      processing_time: str | None = None, **settings) -> StreamingQuery:
    """One query from the transaction stream to all tables below ``base``."""
    w = (tx.writeStream.foreachBatch(SpeedLayer(base, **settings)).outputMode("append")
         .option("checkpointLocation", checkpoint or f"{base.rstrip('/')}/checkpoints/speed"))
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def read_rows(spark: SparkSession, base: str, table: str = "validated") -> DataFrame:
    """The ``validated`` or ``late`` rows, with the batch that brought them."""
    schema = T.StructType([*TRANSACTION.fields, T.StructField("query_id", T.StringType()), T.StructField("batch_id", T.LongType())])
    return spark.read.schema(schema).parquet(f"{base.rstrip('/')}/{table}")
