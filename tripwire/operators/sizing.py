"""Broadcast only behind a size check.

With a large input the planner's estimate for a derived table (flagged
minutes, fraud keys) is large too, so it plans a sort-merge join; adaptive
execution can turn it into a broadcast only after both join inputs were
shuffled, i.e. after the big side already paid for a full shuffle.  For the
few joins whose small side is usually tiny, that side is materialised once
(reliable checkpoint in the shared checkpoint directory: survives executor
loss, cuts lineage), its bytes are summed, and it is broadcast only when they
are under the limit; otherwise the plain join (sort-merge, AQE skew splitting)
is used.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.session import shared_dir

# What a row takes beside its values: headers and null bits.
ROW_OVERHEAD = 32


def _threshold_bytes(df: DataFrame) -> int:
    raw = str(df.sparkSession.conf.get("spark.sql.autoBroadcastJoinThreshold", "10485760")).strip().lower()
    units = {"b": 1, "k": 1 << 10, "kb": 1 << 10, "m": 1 << 20, "mb": 1 << 20, "g": 1 << 30, "gb": 1 << 30}
    for suffix in sorted(units, key=len, reverse=True):
        if raw.endswith(suffix):
            return int(float(raw[: -len(suffix)]) * units[suffix])
    return int(raw)


def _value_bytes(c: Column, kind: T.DataType) -> Column:
    if isinstance(kind, (T.StringType, T.BinaryType)):
        return F.coalesce(F.octet_length(c), F.lit(0)) + 8
    if isinstance(kind, T.ArrayType):
        each = F.aggregate(c, F.lit(8).cast("long"), lambda a, x: a + _value_bytes(x, kind.elementType).cast("long"))
        return F.coalesce(each, F.lit(0).cast("long")) + 8
    if isinstance(kind, T.StructType):
        return sum((_value_bytes(c[f.name], f.dataType) for f in kind.fields), F.lit(16))
    return F.lit(8)


def data_bytes(df: DataFrame) -> int:
    """Bytes of all rows in memory, summed on the cluster (one number)."""
    row = sum((_value_bytes(F.col(f.name), f.dataType) for f in df.schema.fields), F.lit(ROW_OVERHEAD))
    return df.agg(F.sum(row.cast("long"))).first()[0] or 0


def fits_broadcast(df: DataFrame) -> bool:
    """True when the rows of a *materialised* table fit the session's broadcast threshold."""
    return data_bytes(df) <= max(0, _threshold_bytes(df))


def checked_broadcast(df: DataFrame, max_bytes: int | None = None) -> DataFrame:
    """``df`` materialised, wrapped in ``broadcast`` when its rows take at most
    ``max_bytes`` (default: the session's broadcast threshold)."""
    shared_dir(df.sparkSession)          # the reliable checkpoint directory must exist
    small = df.checkpoint(eager=True)
    limit = max_bytes if max_bytes is not None else _threshold_bytes(df)
    return F.broadcast(small) if data_bytes(small) <= max(0, limit) else small
