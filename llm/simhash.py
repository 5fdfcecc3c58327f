"""SimHash fingerprints and near-duplicate groups through vantage-point trees.

Texts are fingerprinted in one pass.  Distinct fingerprints are then split by a
tree of vantage points: a node sends fingerprints within a radius (the median
distance) of its vantage point to the left and the others to the right.  By the
triangle inequality, fingerprints at most ``bits`` apart lie on the same side
unless one is within ``bits`` of the boundary; such a fingerprint is also sent
across (only to leaves after its own, so that a pair meets once).  In a leaf,
rows are ordered by their distance to one more vantage point and compared only
with the rows whose distance differs by at most ``bits``.  A leaf returns a
spanning set of links, never its pairs; components follow by star contraction.

Vantage points are fixed pseudo-random codes; radii come from counts per
(node, distance), at most 65 rows per node, and one radius per node reaches the
driver.  A leaf of more than twice ``leaf_rows`` members or visitors
(fingerprints too close to be separated) is cut into units of pairs of chunks
(``pairing``), so that no group exceeds about four times ``leaf_rows``.

Definitions for odd input: a NULL or blank text has fingerprint zero and is
linked like any other; rows with a NULL key are fingerprinted, but take no part
in links and get a NULL component; repeated rows share a fingerprint; an empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import fields, saved, text_groups
from llm.components import connected_components
from llm.pairing import crowded_cells, units

SHINGLE_WORDS = 4
MAX_BITS = 4
SEED = 42
LEAF_ROWS = 32_768
_BLOCK_CELLS = 4_000_000        # comparisons held at once


def fingerprint(text: str | None, words: int = SHINGLE_WORDS) -> int:
    """64-bit SimHash of a whole text (ASCII letters lower-cased, split at ASCII white space)."""
    tokens = text.encode("utf-8", "replace").lower().split() if text else []
    if not tokens:
        return 0
    joined = b" ".join(tokens)
    digest = xxhash.xxh64_intdigest
    if len(tokens) <= words:
        hashes = np.array([digest(joined, SEED)], dtype=np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, tokens), dtype=np.int64, count=len(tokens)) + 1) - 1
        starts = [0, *(ends[:-words] + 1).tolist()]
        hashes = np.array([digest(joined[a:b], SEED) for a, b in zip(starts, ends[words - 1:].tolist())],
                          dtype=np.uint64)
    ones = np.zeros(64, dtype=np.int64)
    for at in range(0, len(hashes), 1 << 16):
        part = hashes[at:at + (1 << 16)]
        ones += np.unpackbits(part.view(np.uint8).reshape(-1, 8), axis=1).sum(axis=0, dtype=np.int64)
    return int(np.packbits(ones * 2 > len(hashes)).view(np.uint64)[0])


def fingerprints(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                 name: str = "fp", keep: tuple[str, ...] = ()) -> DataFrame:
    """(key, ``keep``, fingerprint as a signed long) of every row."""
    out = T.StructType([*[docs.schema[c] for c in (key, *keep)], T.StructField(name, T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for part, texts in text_groups(batches, text):
            codes = np.array([fingerprint(t, words) for t in texts], dtype=np.uint64).view(np.int64)
            yield pa.RecordBatch.from_arrays([*[part.column(c) for c in (key, *keep)], pa.array(codes)],
                                             names=[key, *keep, name])

    return docs.select(key, *keep, text).mapInArrow(run, out)


# --------------------------------------------------------------------------
# Vantage-point tree
# --------------------------------------------------------------------------

def _vantage(level: int) -> np.uint64:
    return np.uint64(xxhash.xxh64_intdigest(f"vantage point {level}", SEED))


def _distance(codes: np.ndarray, point: np.uint64) -> np.ndarray:
    return np.bitwise_count(codes ^ point).astype(np.int16)


class Tree:
    """Radii by level: ``radii[level][node]``; leaves are the nodes of the last level."""

    def __init__(self, radii: list[np.ndarray]):
        self.radii = radii

    def home(self, codes: np.ndarray) -> np.ndarray:
        node = np.zeros(len(codes), dtype=np.int64)
        for level, radius in enumerate(self.radii):
            node = node * 2 + (_distance(codes, _vantage(level)) > radius[node])
        return node

    def visits(self, codes: np.ndarray, bits: int) -> tuple[np.ndarray, np.ndarray]:
        """(row, leaf) of every leaf from the row's own on that may hold
        fingerprints within ``bits``."""
        own = self.home(codes)
        row, node = np.arange(len(codes)), np.zeros(len(codes), dtype=np.int64)
        for level, radius in enumerate(self.radii):
            d, r = _distance(codes, _vantage(level))[row], radius[node]
            left, right = d - bits <= r, d + bits > r
            row = np.concatenate([row[left], row[right]])
            node = np.concatenate([node[left] * 2, node[right] * 2 + 1])
            ahead = node >= own[row] >> (len(self.radii) - 1 - level)
            row, node = row[ahead], node[ahead]
        return row, node


def _distances_by_node(tree: Tree, level: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[int, int] = {}
        for batch in batches:
            codes = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            cell = tree.home(codes) * 65 + _distance(codes, _vantage(level))
            for c, n in zip(*(x.tolist() for x in np.unique(cell, return_counts=True))):
                counts[c] = counts.get(c, 0) + n
        cells = np.array(sorted(counts), dtype=np.int64)
        yield pa.RecordBatch.from_pydict({
            "node": pa.array(cells // 65), "d": pa.array((cells % 65).astype(np.int32)),
            "n": pa.array(np.array([counts[c] for c in cells.tolist()], dtype=np.int64))})
    return run


def _radii(codes: DataFrame, tree: Tree, level: int) -> np.ndarray:
    """The median distance to the level's vantage point in each node."""
    schema = fields(("node", T.LongType()), ("d", T.IntegerType()), ("n", T.LongType()))
    lower = Window.partitionBy("node").orderBy("d")
    # at most 65 rows a node
    found = (codes.select("fp").mapInArrow(_distances_by_node(tree, level), schema)
             .groupBy("node", "d").agg(F.sum("n").alias("n"))
             .withColumn("upto", F.sum("n").over(lower))
             .withColumn("total", F.sum("n").over(Window.partitionBy("node")))
             .filter(F.col("upto") * 2 >= F.col("total"))
             .groupBy("node").agg(F.min("d").alias("radius")).toPandas())
    radii = np.zeros(1 << level, dtype=np.int16)
    radii[found.node] = found.radius
    return radii


def build_tree(codes: DataFrame, rows: int, leaf_rows: int = LEAF_ROWS) -> Tree:
    """A tree whose leaves hold about ``leaf_rows`` rows: two bytes a node."""
    tree = Tree([])
    while (rows >> len(tree.radii)) > leaf_rows:
        tree = Tree([*tree.radii, _radii(codes, tree, len(tree.radii))])
    return tree


def _visits(codes: np.ndarray, tree: Tree, bits: int) -> Iterator[tuple[int, np.ndarray, np.ndarray, np.ndarray]]:
    """(start, row, leaf, own) for each 4,096 codes."""
    for at in range(0, len(codes), 4096):
        part = codes[at:at + 4096]
        row, leaf = tree.visits(part, bits)
        yield at, row, leaf, leaf == tree.home(part)[row]


def _count_leaves(tree: Tree, bits: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for _, _, leaf, own in _visits(batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64), tree, bits):
                cells, at, n = np.unique(leaf, return_inverse=True, return_counts=True)
                members = np.bincount(at, weights=own, minlength=len(cells)).astype(np.int64)
                yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "members": pa.array(members),
                                                  "visitors": pa.array(n.astype(np.int64) - members)})
    return run


def _deal(tree: Tree, bits: int):
    """Rows to leaves: their own as members, later ones as visitors."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            codes = batch.column("fp").to_numpy(zero_copy_only=False).view(np.uint64)
            nodes = batch.column("node").to_numpy(zero_copy_only=False)
            for at, row, leaf, own in _visits(codes, tree, bits):
                yield pa.RecordBatch.from_pydict({
                    "cell": pa.array(leaf), "own": pa.array(own), "fp": pa.array(codes[at + row].view(np.int64)),
                    "node": pa.array(nodes[at + row])})
    return run


def dealt_units(codes: DataFrame, tree: Tree, bits: int, bound: int) -> DataFrame:
    """Rows of ``codes`` once for each unit (cell, i, j) they take part in."""
    counts = codes.select("fp").mapInArrow(
        _count_leaves(tree, bits), fields(("cell", T.LongType()), ("members", T.LongType()), ("visitors", T.LongType())))
    visits = codes.select("fp", "node").mapInArrow(
        _deal(tree, bits),
        fields(("cell", T.LongType()), ("own", T.BooleanType()), ("fp", T.LongType()), ("node", T.LongType())))
    return units(visits, crowded_cells(counts, bound))


class Union:
    """Disjoint sets over 0..n-1."""

    def __init__(self, n: int):
        self.parent = list(range(n))

    def find(self, x: int) -> int:
        p = self.parent
        while p[x] != x:
            p[x] = p[p[x]]
            x = p[x]
        return x

    def join(self, a: int, others: list[int]) -> None:
        a = self.find(a)
        for b in others:
            b = self.find(b)
            if a != b:
                self.parent[b] = a

    def stars(self) -> tuple[np.ndarray, np.ndarray]:
        """(element, root) of every element that is not its own root."""
        moved = [(x, self.find(x)) for x, p in enumerate(self.parent) if p != x]
        pairs = np.array(moved, dtype=np.int64).reshape(-1, 2)
        return pairs[:, 0], pairs[:, 1]


def join_matches(near: np.ndarray, rows: np.ndarray, columns: np.ndarray, sets: Union) -> None:
    """Unites what a boolean block says is linked: each row with its first
    column, and the other columns of the rows that share a first column."""
    hit = np.flatnonzero(near.any(axis=1))
    if not len(hit):
        return
    lead = near[hit].argmax(axis=1)
    order = np.argsort(lead, kind="stable")
    heads, starts = np.unique(lead[order], return_index=True)
    for head, group in zip(heads.tolist(), np.split(hit[order], starts[1:])):
        others = np.flatnonzero(near[group].any(axis=0))
        sets.join(int(columns[head]), [*rows[group].tolist(), *columns[others].tolist()])


def links_in_unit(codes: np.ndarray, member: np.ndarray, bits: int, among: bool = True) -> Union:
    """Sets of rows connected through links of a member with any row; not
    ``among``: with a row that is none."""
    sets = Union(len(codes))
    d = _distance(codes, _vantage(-1))
    mine = np.flatnonzero(member)
    mine = mine[np.argsort(d[mine], kind="stable")]
    mine_codes, mine_d = codes[mine], d[mine]
    every = np.argsort(d, kind="stable")
    if not among:
        every = every[~member[every]]
    bounds = np.searchsorted(d[every], np.arange(66))
    for value in range(65):
        group = every[bounds[value]:bounds[value + 1]]
        lo, hi = np.searchsorted(mine_d, [value - bits, value + bits + 1])
        if not len(group) or lo == hi:
            continue
        step = max(1, _BLOCK_CELLS // (hi - lo))
        for at in range(0, len(group), step):
            rows = group[at:at + step]
            near = np.bitwise_count(codes[rows][:, None] ^ mine_codes[None, lo:hi]) <= bits
            near &= rows[:, None] != mine[None, lo:hi]
            join_matches(near, rows, mine[lo:hi], sets)
    return sets


def near_groups(codes: DataFrame, bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """``codes``: distinct (fp, node) -> (node, component) for nodes with a link."""
    rows = codes.count()
    dealt = dealt_units(codes, build_tree(codes, rows, leaf_rows), bits, 2 * leaf_rows)

    def links(table: pa.Table) -> pa.Table:
        nodes = table.column("node").to_numpy()
        sets = links_in_unit(table.column("fp").to_numpy().view(np.uint64),
                             table.column("member").to_numpy(zero_copy_only=False).astype(bool), bits,
                             table.column("i")[0] == table.column("j")[0])
        a, b = sets.stars()
        return pa.table({"src": nodes[a], "dst": nodes[b]})

    edges = dealt.groupBy("cell", "i", "j").applyInArrow(links, fields(("src", T.LongType()), ("dst", T.LongType())))
    return connected_components(edges)


def fingerprint_classes(codes: DataFrame, order: tuple[str, ...], bits: int = MAX_BITS,
                        leaf_rows: int = LEAF_ROWS) -> tuple[DataFrame, DataFrame]:
    """``codes``: rows with ``fp`` and the columns ``order``, a key first ->
    (fp, group) of every fingerprint of rows with a key, and (group, first): the
    smallest ``order`` in each group, as a struct.

    Fingerprints are numbered on their own, so that those with the same smallest
    key stay apart."""
    distinct = saved(codes.filter(F.col(order[0]).isNotNull()).groupBy("fp").agg(F.min(F.struct(*order)).alias("first"))
                     .withColumn("node", F.monotonically_increasing_id()), "codes")
    groups = near_groups(distinct.select("fp", "node"), bits, leaf_rows)
    members = distinct.join(groups, "node", "left").select(
        "fp", "first", F.coalesce("component", "node").alias("group"))
    return members.select("fp", "group"), members.groupBy("group").agg(F.min("first").alias("first"))


def near_duplicates(docs: DataFrame, key: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS,
                    bits: int = MAX_BITS, leaf_rows: int = LEAF_ROWS) -> DataFrame:
    """(key, fp, component) per row: ``component`` is the smallest key reachable
    through fingerprints at most ``bits`` bits apart."""
    codes = saved(fingerprints(docs, key, text, words), "fingerprints")
    members, groups = fingerprint_classes(codes, (key,), bits, leaf_rows)
    classes = (members.join(groups, "group")
               .select(F.col("fp").alias("_code"), F.col("first")[key].alias("component")))
    return (codes.join(classes, (F.col("fp") == F.col("_code")) & F.col(key).isNotNull(), "left")
            .select(key, "fp", "component"))


def op8_simhash(spark, sf_dir: str) -> DataFrame:
    """Fingerprint and near-duplicate component of every document."""
    from llm.common import load

    return (near_duplicates(load(spark, sf_dir, "documents"))
            .select("doc_id", F.lpad(F.lower(F.hex("fp")), 16, "0").alias("fingerprint"),
                    F.col("component").alias("component_id")))
