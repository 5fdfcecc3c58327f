"""Shared helpers: written intermediate tables, table loading, Arrow batches."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import pyarrow as pa
import pyarrow.compute  # noqa: F401 - makes pa.compute available
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.session import fresh_path

# A Python task handles its texts in groups of about this many characters, so
# that the memory it needs does not follow the number of rows in a batch.
GROUP_CHARS = 2_000_000


def load(spark: SparkSession, sf_dir: str, table: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{table}.parquet")


def saved(df: DataFrame, name: str) -> DataFrame:
    """``df`` written to the cluster's shared folder and read again: cuts the
    lineage, survives lost executors, and gives later steps a fixed input."""
    path = fresh_path(df.sparkSession, f"llm-{name}")
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remainder(key: str | Column, n: int) -> Column:
    """crc32 of the key's text, modulo ``n`` (NULL for a NULL key)."""
    return F.crc32(F.col(key).cast("string") if isinstance(key, str) else key.cast("string")) % n


def hash_share(key: Column, share: Column, salt: int) -> Column:
    """True for about ``share`` of the keys, always the same ones."""
    slots = 1 << 30
    return F.pmod(F.xxhash64(key, F.lit(salt)), F.lit(slots)) < share * F.lit(float(slots))


def text_groups(batches: Iterable[pa.RecordBatch], column: str,
                limit: int = GROUP_CHARS) -> Iterator[tuple[pa.RecordBatch, list[str | None]]]:
    """Slices of the batches holding about ``limit`` characters each, with the
    texts as Python strings."""
    for batch in batches:
        lengths = pa.compute.fill_null(pa.compute.binary_length(batch.column(column)), 0).to_pylist()
        start, size = 0, 0
        for i, n in enumerate(lengths):
            size += n
            if size >= limit:
                part = batch.slice(start, i + 1 - start)
                yield part, part.column(column).to_pylist()
                start, size = i + 1, 0
        if start < batch.num_rows:
            part = batch.slice(start)
            yield part, part.column(column).to_pylist()


def fields(*pairs: tuple[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(n, t, True) for n, t in pairs])


def free_name(df: DataFrame, base: str) -> str:
    """``base``, lengthened until ``df`` has no column of that name."""
    taken = {c.lower() for c in df.columns}
    while base.lower() in taken:
        base += "_"
    return base
