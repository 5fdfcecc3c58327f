"""Bloom filters of stored rows, one per event date and batch.

A sink that must not store a row twice would read what is stored for the dates
of each batch.  The filter answers most of these look-ups: a row whose bits are
not all set in any filter of its date was never stored.  Only rows that hit are
looked up in the table, so a batch of new rows reads no stored row.

Layout: ``<path>/event_date=<d>/query_id=<q>/batch_id=<n>/``, as the table's own.
A filter is a set of blocks of 32,768 bits; a row sets ``BITS`` of them in the
block that its hash selects.  The number of blocks of a date and batch is the
power of two that leaves about ten bits a row, so a small batch takes one block.

A batch writes its filters *before* its rows: a crash between the two leaves
bits without rows, which cost a look-up and never a row.  A replayed batch
replaces its own directories.  Filters stay right when dates are compacted.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

BLOCK_BITS = 32_768             # what a bitmap of the built-in functions holds
BITS = 6
ROW_BITS = 10
MAX_EXPONENT = 16               # at most 65,536 blocks: about 200 million rows a date and batch

FILTERS = T.StructType([
    T.StructField("blocks", T.IntegerType(), True),
    T.StructField("block", T.IntegerType(), True),
    T.StructField("bitmap", T.BinaryType(), True),
    T.StructField("event_date", T.DateType(), True),
    T.StructField("query_id", T.StringType(), True),
    T.StructField("batch_id", T.LongType(), True),
])


def _keys(df: DataFrame, columns: list[str]) -> list[Column]:
    # equal numbers hash alike: zero has one sign
    return [F.col(c) + F.lit(0.0) if isinstance(df.schema[c].dataType, (T.DoubleType, T.FloatType)) else F.col(c)
            for c in columns]


def _block(keys: list[Column], blocks: Column) -> Column:
    return F.pmod(F.xxhash64(*keys, F.lit(0)), blocks.cast("long")).cast("int")


def _bits(keys: list[Column]) -> Column:
    return F.array(*[F.pmod(F.xxhash64(*keys, F.lit(i)), F.lit(BLOCK_BITS)) for i in range(1, BITS + 1)])


def build_filters(rows: DataFrame, columns: list[str]) -> DataFrame:
    """(event_date, blocks, block, bitmap) of ``rows``, which carry ``event_date``."""
    keys = _keys(rows, columns)
    exponent = F.greatest(F.lit(0), F.ceil(F.log2(F.col("_n") * ROW_BITS / BLOCK_BITS)))
    # one row per calendar date
    sizes = (rows.groupBy("event_date").agg(F.count(F.lit(1)).alias("_n"))
             .select(F.col("event_date").alias("_date"),
                     F.pow(F.lit(2), F.least(exponent, F.lit(MAX_EXPONENT))).cast("int").alias("blocks")))
    return (rows.join(F.broadcast(sizes), F.col("event_date").eqNullSafe(F.col("_date")))
            .select("event_date", "blocks", _block(keys, F.col("blocks")).alias("block"), F.explode(_bits(keys)).alias("_bit"))
            .groupBy("event_date", "blocks", "block").agg(F.bitmap_construct_agg("_bit").alias("bitmap")))


def _is_set(bitmap: Column, bit: Column) -> Column:
    byte = F.conv(F.hex(F.substr(bitmap, (F.floor(bit / 8) + 1).cast("int"), F.lit(1))), 16, 10).cast("int")
    return F.pmod(F.floor(byte / F.pow(F.lit(2), bit % 8)), F.lit(2)) == 1


def may_be_stored(rows: DataFrame, filters: DataFrame, columns: list[str]) -> DataFrame:
    """(event_date, ``columns``) of the rows that hit a filter of their date: all
    rows that were stored, and few others."""
    keys = _keys(rows, columns)
    stored = filters.select(F.col("event_date").alias("_date"), F.col("blocks").alias("_blocks"),
                            F.col("block").alias("_block"), "bitmap")
    # one probe for every size a filter may have
    probes = (rows.select("event_date", *columns, _bits(keys).alias("_bits"),
                          F.explode(F.array(*[F.lit(1 << e) for e in range(MAX_EXPONENT + 1)])).alias("_size"))
              .withColumn("_at", _block(keys, F.col("_size"))))
    return (probes.join(stored, F.col("event_date").eqNullSafe(F.col("_date")) & (F.col("_size") == F.col("_blocks"))
                        & (F.col("_at") == F.col("_block")))
            .filter(F.forall("_bits", lambda b: _is_set(F.col("bitmap"), b)))
            .select("event_date", *columns).distinct())


def write_filters(rows: DataFrame, columns: list[str], path: str, query_id: str, batch_id: int) -> None:
    """The filters of a batch's rows, in place of those of an earlier attempt."""
    (build_filters(rows, columns).withColumn("query_id", F.lit(query_id)).withColumn("batch_id", F.lit(batch_id).cast("long"))
     .select(*FILTERS.names).hint("rebalance", "event_date")
     .write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
     .partitionBy("event_date", "query_id", "batch_id").parquet(path))


def rebuild_filters(stored: DataFrame, columns: list[str], path: str) -> None:
    """Filters for a table that was written without: one set for all ``stored``
    rows, under a batch of its own that no writer replaces."""
    write_filters(stored, columns, path, "rebuilt", -1)
