"""Text formatting of report values (JVM-side string functions).

* ``format_currency``: ``$`` + thousands separators + 2 decimals; NULL or NaN -> ``$0.00``
* ``format_integer``:  truncate to an integer, thousands separators; NULL or NaN -> ``0``
* ``axis_currency``:   >= 1e6 ``$x.xM``, >= 1e3 ``$xK``, else ``$x``
* ``format_report``:   the report-table cell rules, first rows only
* ``run_id``:          timestamp -> ``yyyyMMdd_HHmmss`` file-name text

Decimal rounding is half-even on the binary value, like the report's own
string formatting.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tripwire.config import REPORT_TABLE_ROWS


def _c(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def _number(c: Column | str) -> Column:
    """As a double; NULL and NaN alike are missing."""
    return F.nanvl(_c(c).cast("double"), F.lit(None).cast("double"))


def format_currency(c: Column | str) -> Column:
    return F.concat(F.lit("$"), F.format_number(F.coalesce(_number(c), F.lit(0.0)), 2))


def format_integer(c: Column | str) -> Column:
    """Beyond the long range the number is whole already; beyond 38 digits, and
    for infinity, its own text stands."""
    x = _number(c)
    return F.coalesce(F.format_number(x.try_cast("long"), 0), F.format_number(x.try_cast("decimal(38,0)"), 0),
                      x.cast("string"), F.lit("0"))


def _plain(c: Column, decimals: int) -> Column:
    return F.regexp_replace(F.format_number(c, decimals), ",", "")


def axis_currency(c: Column | str) -> Column:
    x = _c(c).cast("double")
    return (F.when(x >= 1e6, F.concat(F.lit("$"), _plain(x / 1e6, 1), F.lit("M")))
            .when(x >= 1e3, F.concat(F.lit("$"), _plain(x / 1e3, 0), F.lit("K")))
            .otherwise(F.concat(F.lit("$"), _plain(x, 0))))


def run_id(ts: Column | str) -> Column:
    return F.date_format(_c(ts), "yyyyMMdd_HHmmss")


def format_report(table: DataFrame, index_col: str, rows: int = REPORT_TABLE_ROWS) -> DataFrame:
    """Every cell as text, the way the report tables are printed.

    ``Index`` is the group key.  A column whose name contains ``amount`` is
    currency; other numbers above 100 are integers with separators, the rest
    two decimals (rows of these tables hold floats, so every number is printed
    as a float); anything else is plain text.
    """
    fields = {f.name: f.dataType for f in table.schema.fields}
    numeric = (T.ByteType, T.ShortType, T.IntegerType, T.LongType, T.FloatType, T.DoubleType,
               T.DecimalType)
    has_float = any(isinstance(t, (T.FloatType, T.DoubleType, T.DecimalType))
                    for n, t in fields.items() if n != index_col)
    cells = [F.col(index_col).cast("string").alias("Index")]
    for name, dtype in fields.items():
        if name == index_col:
            continue
        v = F.col(name)
        if "amount" in name.lower():
            cell = format_currency(v)
        elif isinstance(dtype, numeric):
            as_float = has_float or isinstance(dtype, (T.FloatType, T.DoubleType, T.DecimalType))
            small = F.format_number(v.cast("double"), 2) if as_float else v.cast("string")
            cell = (F.when(v.isNull(), F.lit("nan"))
                    .when(v > 100, format_integer(v))
                    .otherwise(F.regexp_replace(small, ",", "")))
        else:
            cell = v.cast("string")
        cells.append(cell.alias(name))
    return table.limit(rows).select(*cells)
