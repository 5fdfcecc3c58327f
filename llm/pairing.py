"""Crowded cells of a similarity join, split into units of bounded size.

A join that deals rows to cells has members (rows that live in a cell) and
visitors (rows that may match its members).  Most cells are one unit.  A cell of
more than ``bound`` members or visitors is cut into chunks of at most about
``bound`` rows, and every pair of chunks with members in it is a unit (i, j):

* i = j: the members of chunk i among themselves,
* i < j: the members of chunk i against chunk j, which holds members or visitors.

So no unit holds more than two chunks, whatever a cell holds, every pair meets
in one unit, and a row is copied once for each chunk of its cell.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tripwire.operators.sizing import checked_broadcast

# Chunks are drawn by hash; they are planned this many deviations below the bound.
_SPARE = 4.0


def crowded_cells(counts: DataFrame, bound: int) -> DataFrame:
    """``counts`` (cell, members, visitors), partial sums -> (_cell, _mine,
    _others) of the cells over the bound: the chunks of each side."""
    room = max(1.0, bound - _SPARE * bound ** 0.5)
    return (counts.groupBy("cell").agg(F.sum("members").alias("m"), F.sum("visitors").alias("v"))
            .filter((F.col("m") > bound) | (F.col("v") > bound))
            .select(F.col("cell").alias("_cell"), F.ceil(F.col("m") / room).cast("int").alias("_mine"),
                    F.ceil(F.col("v") / room).cast("int").alias("_others")))


def units(visits: DataFrame, crowded: DataFrame, node: str = "node") -> DataFrame:
    """``visits`` (cell, own, ...) -> the same rows once for each unit (cell, i, j)
    they belong to, ``member`` in place of ``own``.  In a unit with i < j members
    meet the others only.  The few crowded cells are broadcast when their bytes
    allow it."""
    mine, others = F.col("_mine"), F.col("_others")
    at = F.pmod(F.xxhash64(node, F.lit(31)), F.greatest(F.when(F.col("own"), mine).otherwise(others), F.lit(1))).cast("int")

    def upto(n):
        """0 .. n-1; of no chunks, nothing."""
        return F.when(n > 0, F.sequence(F.lit(0), n - 1)).otherwise(F.array().cast("array<int>"))

    def unit(i, j, member):
        return F.struct(i.cast("int").alias("i"), j.cast("int").alias("j"), member.alias("member"))

    own_units = F.concat(
        F.transform(upto(mine), lambda x: unit(F.least(x, at), F.greatest(x, at), x >= at)),
        F.transform(upto(others), lambda x: unit(at, mine + x, F.lit(True))))
    visits_to = F.transform(upto(mine), lambda x: unit(x, mine + at, F.lit(False)))
    every = (F.when(F.col("_cell").isNull(), F.array(unit(F.lit(0), F.lit(0), F.col("own"))))
             .when(F.col("own"), own_units).otherwise(visits_to))
    kept = [c for c in visits.columns if c != "own"]
    return (visits.join(checked_broadcast(crowded), F.col("cell") == F.col("_cell"), "left")
            .withColumn("_unit", F.explode(every))
            .select(*kept, F.col("_unit.i").alias("i"), F.col("_unit.j").alias("j"), F.col("_unit.member").alias("member")))
