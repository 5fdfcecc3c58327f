"""Wire format: one JSON text per transaction.

``json_encode`` is the producer side (record -> JSON bytes for a topic),
``json_decode`` + ``event_time_parse`` the consumer side.  Malformed input never
fails a job: bad JSON gives an all-NULL row, a badly typed field a NULL field,
an unparsable time a NULL timestamp.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tripwire.schema import TRANSACTION_WIRE, TX_COLUMNS


def iso_text(ts: Column) -> Column:
    """ISO-8601 text without zone; the fraction is omitted when it is zero
    (the producer's ``isoformat()`` behaviour)."""
    whole = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss")
    frac = F.date_format(ts, "yyyy-MM-dd'T'HH:mm:ss.SSSSSS")
    return F.when(F.unix_micros(ts) % 1_000_000 == 0, whole).otherwise(frac)


def json_encode(tx: DataFrame, as_binary: bool = False) -> DataFrame:
    """Transactions -> one ``value`` column holding the JSON payload
    (``key`` = user id, so a topic keeps each user's events in one partition)."""
    body = F.to_json(F.struct(
        F.col("user_id"),
        iso_text(F.col("timestamp")).alias("timestamp"),
        F.col("merchant_category"),
        F.col("amount"),
        F.col("location"),
    ))
    key = F.col("user_id")
    if as_binary:
        body, key = body.cast("binary"), key.cast("binary")
    return tx.select(key.alias("key"), body.alias("value"))


def json_decode(payloads: DataFrame, value_col: str = "value") -> DataFrame:
    """Bytes/text payload -> the five wire columns (timestamp still text)."""
    text = F.col(value_col).cast("string")
    return (payloads
            .select(F.from_json(text, TRANSACTION_WIRE).alias("data"))
            .select("data.*"))


def event_time_parse(tx: DataFrame, column: str = "timestamp") -> DataFrame:
    """ISO text -> timestamp; unparsable text becomes NULL instead of failing
    the query under ANSI mode.  No fixed pattern: the fraction may be absent."""
    return tx.withColumn(column, F.try_to_timestamp(F.col(column)))


def decode_transactions(payloads: DataFrame, value_col: str = "value") -> DataFrame:
    return event_time_parse(json_decode(payloads, value_col)).select(*TX_COLUMNS)
