"""Transaction view over the generic ``events`` table.

``events(event_id, ts, user_id, event_type, value, props)`` becomes
``transactions(user_id, timestamp, merchant_category, amount, location)``:

* ``user_id``   -> ``USER_%05d``
* ``ts``        -> ``timestamp`` (zone-less wall clock, read as UTC)
* ``event_type``-> upper-cased merchant category
* ``value``     -> ``amount = bround(value * 25, 2)``
* ``props.k``   -> one of the ten country codes, ``k % 10``-th in order
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tripwire.config import COUNTRIES
from tripwire.schema import EVENTS
from tripwire.session import pin_session


def _country(props: Column) -> Column:
    k = F.get_json_object(props, "$.k").try_cast("int")
    codes = F.array(*[F.lit(c) for c in COUNTRIES])
    # explicit NULL guard: a literal-array lookup with an index known to be in
    # range can be rewritten by the optimizer so that a NULL index hits the
    # last element
    return F.when(k.isNotNull(), F.element_at(codes, F.pmod(k, F.lit(len(COUNTRIES))) + 1))


def transactions_from_events(events: DataFrame) -> DataFrame:
    """Pure projection; works on batch and streaming frames alike."""
    return events.select(
        F.format_string("USER_%05d", F.col("user_id")).alias("user_id"),
        F.col("ts").cast("timestamp").alias("timestamp"),
        F.upper(F.col("event_type")).alias("merchant_category"),
        F.bround(F.col("value") * 25, 2).alias("amount"),
        _country(F.col("props")).alias("location"),
    )


def load_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.read.schema(EVENTS).parquet(f"{sf_dir.rstrip('/')}/events.parquet")


def load_transactions(spark: SparkSession, sf_dir: str) -> DataFrame:
    pin_session(spark)
    return transactions_from_events(load_events(spark, sf_dir))
