"""Merkle manifest of a dataset: one digest for all rows, a proof for each.

Every row is a leaf: the sha256 of its columns, each written as ``-`` when NULL,
else as UTF-8 byte count, ``:`` and value.  The leaves of a group (a source)
stand in key order; every ``fanout`` consecutive nodes become the digest of
their concatenated digests until one is left, the group's subroot.  Subroots in
the order of their groups give the dataset's root in the same way.

* **Places.**  Leaves are range-partitioned by group, key and digest and sorted;
  a row's number in its partition plus the counts of the partitions before it
  is its place.  No window holds a group: the counts are one row per group and
  partition.
* **Slot pivot.**  A level is one ``groupBy`` on (group, place div fanout) whose
  conditional aggregates spread a parent's children into ``fanout`` columns; the
  concatenated columns hash to the parent.  No group of rows exceeds ``fanout``.
* **Proofs.**  Levels are joined from the top: a parent's row holds all its
  children, so one row gives each child its siblings (the columns before and
  after its own) in front of the parent's path.  Level k has 1/fanout^k of the
  rows, so all joins together read about one and a half times the leaves.

Definitions for odd input: a NULL key comes first within its group, a NULL
group is a group of its own and comes first; equal keys are ordered by digest,
and equal rows take consecutive places (their proofs differ); a NULL or empty
text is ``-`` or ``0:``; an empty table gives no rows; columns beside the named
ones take no part, whatever their names.
"""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from llm.common import load, remainder, saved
from tripwire.operators.sizing import checked_broadcast

FANOUT = 3
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
_ROW_BITS = 33          # low bits of monotonically_increasing_id: the row within its partition


def leaf_digest(values: list[Column]) -> Column:
    """sha256 of the values, told apart by their lengths."""
    def part(value: Column) -> Column:
        text = value.cast("string")
        return F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-"))
    return F.sha2(F.concat(*[part(v) for v in values]), 256)


def fold(start: Column, path: Column) -> Column:
    """The root that ``start`` leads to by a path of (before, after) siblings."""
    return F.aggregate(path, start, lambda node, level: F.sha2(F.concat(level["before"], node, level["after"]), 256))


def proof_text(path: Column) -> Column:
    """All siblings of a path, lowest level first, left to right."""
    return F.array_join(F.transform(path, lambda level: F.concat(level["before"], level["after"])), "")


@dataclass
class Manifest:
    """Written tables: ``leaves`` (_grp, _pos, _height, key, leaf, altered);
    ``levels[k - 1]`` the parents of level k (their children in columns);
    ``groups`` (_group, _grp, rows, _height); ``top`` the levels over the subroots;
    ``subroots`` (_grp = 0, _pos, digest)."""

    key: str
    group: str
    fanout: int
    leaves: DataFrame
    levels: list[DataFrame]
    groups: DataFrame
    subroots: DataFrame
    top: list[DataFrame]

    def root(self) -> DataFrame:
        """One row: ``root`` (none for an empty table)."""
        return (self.top[-1] if self.top else self.subroots).select(F.col("digest").alias("root"))


def _sorted(df: DataFrame, order: list[str], name: str) -> DataFrame:
    """``df`` written in ``order``, each row with its partition and its number there."""
    keys = [F.col(c).asc_nulls_first() for c in order]
    out = saved(df.repartitionByRange(*keys).sortWithinPartitions(*keys)
                .withColumn("_at", F.monotonically_increasing_id()), name)
    return (out.withColumn("_task", F.shiftright("_at", _ROW_BITS))
            .withColumn("_nth", F.col("_at").bitwiseAND((1 << _ROW_BITS) - 1)).drop("_at"))


def _shifts(ordered: DataFrame, group: str) -> DataFrame:
    """Per group and partition: what turns a row's number in the partition into
    its place in the group, and the rows of the group."""
    by = ordered.groupBy(group, "_task").agg(F.min("_nth").alias("_first"), F.count(F.lit(1)).alias("_rows"))
    whole = Window.partitionBy(group)
    before = F.sum("_rows").over(whole.orderBy("_task").rowsBetween(Window.unboundedPreceding, -1))
    return by.select(group, "_task", (F.coalesce(before, F.lit(0)) - F.col("_first")).alias("_shift"),
                     F.sum("_rows").over(whole).alias("_rows"))


def _placed(ordered: DataFrame, shifts: DataFrame, group: str) -> DataFrame:
    shifts = shifts.withColumnsRenamed({group: "_s_group", "_task": "_s_task"})
    same = F.col(group).eqNullSafe(F.col("_s_group")) & (F.col("_task") == F.col("_s_task"))
    return (ordered.join(checked_broadcast(shifts), same)
            .withColumn("_pos", F.col("_nth") + F.col("_shift")).drop("_s_group", "_s_task", "_task", "_nth", "_shift"))


def _height(rows: str, fanout: int) -> Column:
    """Levels above ``rows`` nodes: the least h with fanout^h >= rows."""
    steps, power = [], 1
    while power < 1 << 62:
        steps.append((F.col(rows) > F.lit(power)).cast("int"))
        power *= fanout
    return reduce(lambda a, b: a + b, steps)


def _tree(nodes: DataFrame, height: int, fanout: int, name: str, carried: tuple[str, ...] = ()) -> list[DataFrame]:
    """The levels above ``nodes`` (_grp, _pos, _height, digest).  ``carried`` are
    columns of the nodes that the first level keeps for each child."""
    levels = []
    for k in range(1, height + 1):
        slot = F.col("_pos") % fanout
        own = ["digest", *(carried if k == 1 else ())]
        spread = [F.max(F.when(slot == s, F.col(c))).alias(f"{c}_{s}") for s in range(fanout) for c in own]
        parents = (nodes.filter(F.col("_height") >= k)
                   .groupBy("_grp", F.floor(F.col("_pos") / fanout).cast("long").alias("_up"))
                   .agg(F.max("_height").alias("_height"), *spread)
                   .withColumnRenamed("_up", "_pos")
                   .withColumn("digest", F.sha2(F.concat_ws("", *[f"digest_{s}" for s in range(fanout)]), 256)))
        levels.append(saved(parents, f"{name}-{k}"))
        nodes = levels[-1].select("_grp", "_pos", "_height", "digest")
    return levels


def _children(parents: DataFrame, level: DataFrame, fanout: int, keep: tuple[str, ...], carried: tuple[str, ...] = ()) -> DataFrame:
    """The children of ``parents`` (_grp, _pos, path, kept columns) with their paths."""
    digests = [F.col(f"digest_{s}") for s in range(fanout)]

    def child(s: int) -> Column:
        siblings = F.struct(F.concat_ws("", *digests[:s]).alias("before"), F.concat_ws("", *digests[s + 1:]).alias("after"))
        return F.struct((F.col("_pos") * fanout + s).alias("_pos"), digests[s].alias("digest"), siblings.alias("siblings"),
                        *[F.col(f"{c}_{s}").alias(c) for c in carried])

    there = F.filter(F.array(*[child(s) for s in range(fanout)]), lambda c: c["digest"].isNotNull())
    return (parents.join(level.drop("_height", "digest"), ["_grp", "_pos"])
            .select("_grp", "path", *keep, F.explode(there).alias("_child"))
            .select("_grp", F.col("_child._pos").alias("_pos"), F.col("_child.digest").alias("digest"),
                    F.concat(F.array(F.col("_child.siblings")), F.col("path")).alias("path"), *keep,
                    *[F.col(f"_child.{c}").alias(c) for c in carried]))


def build(docs: DataFrame, key: str = "doc_id", group: str = "source", columns: tuple[str, ...] = COLUMNS,
          fanout: int = FANOUT, altered: dict[str, Column] | None = None) -> Manifest:
    """The manifest of ``docs``.  ``altered`` gives other values for some columns;
    a row's digest with them is kept beside its leaf, to be checked against the
    untouched proof (``verify``)."""
    altered = altered or {}
    digest = leaf_digest([F.col(c) for c in columns])
    other = leaf_digest([altered.get(c, F.col(c)) for c in columns]) if altered else digest
    leaves = saved(docs.select(F.col(group).alias("_group"), F.col(key).alias("_key"), digest.alias("digest"),
                               other.alias("altered"), F.monotonically_increasing_id().alias("_row")), "leaves")
    ordered = _sorted(leaves, ["_group", "_key", "digest", "_row"], "ordered").drop("_row")
    shifts = saved(_shifts(ordered, "_group"), "shifts")

    names = _sorted(shifts.groupBy("_group").agg(F.max("_rows").alias("rows")).withColumn("_all", F.lit(0)),
                    ["_group"], "groups")
    groups = saved(_placed(names, _shifts(names, "_all"), "_all")
                   .select("_group", F.col("_pos").alias("_grp"), "rows", _height("rows", fanout).alias("_height"),
                           F.col("_rows").alias("_groups")), "placed-groups")
    numbered = groups.select(F.col("_group").alias("_g_group"), "_grp", "_height")
    shifts = shifts.join(numbered, F.col("_group").eqNullSafe(F.col("_g_group"))).drop("_g_group", "_rows")
    placed = saved(_placed(ordered, shifts, "_group").select("_grp", "_pos", "_height", "_key", "digest", "altered"), "placed")

    tallest, number = groups.agg(F.max("_height"), F.max("_groups")).first()      # one row
    levels = _tree(placed, tallest or 0, fanout, "level", ("_key", "altered"))
    tops = [placed, *levels]
    subroots = saved(reduce(DataFrame.unionByName, [
        t.filter(F.col("_height") == k).select(F.lit(0).cast("long").alias("_grp"), F.col("_grp").alias("_pos"), "digest")
        for k, t in enumerate(tops)]), "subroots")
    high = next(h for h in range(64) if fanout ** h >= (number or 1))
    top = _tree(subroots.withColumn("_height", F.lit(high)), high, fanout, "top")
    return Manifest(key, group, fanout, placed, levels, groups, subroots, top)


def proofs(m: Manifest) -> DataFrame:
    """Per row: key, ``leaf``, ``altered``, ``subroot``, ``root`` and its ``path`` (array of
    ``before``, ``after``: the siblings' digests, lowest level first)."""
    empty = F.expr("cast(array() as array<struct<before:string,after:string>>)")
    above = m.root().select(F.lit(0).cast("long").alias("_grp"), F.lit(0).cast("long").alias("_pos"),
                            F.col("root").alias("digest"), "root", empty.alias("path"))
    for level in reversed(m.top):
        above = _children(above.drop("digest"), level, m.fanout, ("root",))
    starts = saved(above.select(F.col("_pos").alias("_grp"), F.lit(0).cast("long").alias("_pos"), "path",
                                F.col("digest").alias("subroot"), "root")
                   .join(m.groups.select("_grp", "_height"), "_grp"), "paths")
    keep = ("subroot", "root")

    def at(height: int) -> DataFrame:
        return starts.filter(F.col("_height") == height).select("_grp", "_pos", "path", *keep)

    nodes = None
    for k in range(len(m.levels), 0, -1):
        here = at(k) if nodes is None else nodes.select("_grp", "_pos", "path", *keep).unionByName(at(k))
        nodes = _children(here, m.levels[k - 1], m.fanout, keep, ("_key", "altered") if k == 1 else ())
    lone = at(0).drop("_pos").join(m.leaves.filter(F.col("_height") == 0).drop("_height", "_pos"), "_grp")
    out = [df.select(F.col("_key").alias(m.key), F.col("digest").alias("leaf"), "altered", *keep, "path")
           for df in (nodes, lone) if df is not None]
    return reduce(DataFrame.unionByName, out)


def verify(proven: DataFrame) -> DataFrame:
    """``proofs`` with the root that each row's altered digest leads to, and
    whether that is the dataset's."""
    return (proven.withColumn("folded_root", fold(F.col("altered"), F.col("path")))
            .withColumn("verified", F.col("folded_root") == F.col("root")))


def digests(docs: DataFrame, fanout: int = FANOUT) -> DataFrame:
    """Leaves, proofs and checks after tampering with the line feeds of the
    texts whose id has an even crc32."""
    text = F.col("text")
    tampered = F.when(remainder("doc_id", 2) == 0, F.replace(text, F.lit("\n"), F.lit(""))).otherwise(text)
    checked = verify(proofs(build(docs, fanout=fanout, altered={"text": tampered})))
    return checked.select("doc_id", "leaf", "subroot", "root", F.sha2(proof_text(F.col("path")), 256).alias("proof_sha256"),
                          "folded_root", "verified")


def op11_manifest(spark, sf_dir: str) -> DataFrame:
    """The manifest of all documents."""
    return digests(load(spark, sf_dir, "documents"))
