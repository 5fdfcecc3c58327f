"""Near-duplicate vectors by a subspace pigeonhole join.

Unit vectors with cosine >= t lie within squared distance T = 2(1 - t).  After a
fixed random rotation their coordinates are split into low-dimensional blocks;
a linked pair must be within the proportional budget ``T * block dims / dims``
in at least one block.  Each block is range-joined on its own: its first
coordinates define a grid as wide as the block's radius, a vector lives in one
cell and visits the later cells that its ball reaches.  In a cell, rows are
ordered by a coordinate that the grid does not use and compared within the
radius in all block coordinates; what passes is verified by the exact cosine in
double precision.
A pair counts in the first block whose budget it keeps, so no pair is counted
twice and none is written out: a cell returns link counts per vector and a
spanning set of links.

Identical vectors are one row with a count.  A cell of more than ``cell_rows``
members or visitors is cut into units of pairs of chunks (``pairing``), so that
no group exceeds about twice that, whatever lies in one cell.

Definitions for odd input: vectors that are NULL, empty, zero or hold NULL or
non-finite components link with nothing and are their own component; rows with
a NULL id are compared like any other, and their component is NULL only where
no row of it has an id; vectors of different lengths never link; repeated ids
with different vectors are vectors of their own; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm.common import fields, saved
from llm.components import connected_components
from llm.pairing import crowded_cells, units
from llm.simhash import Union, join_matches

THRESHOLD = 0.95
BLOCKS = 8
CELL_ROWS = 16_384
SEED = 1
_CELLS_AT_ONCE = 2_000_000
_SLACK = 1e-6               # budgets are wider by this share, for rounding
_SINGLE = 1e-4              # and the single-precision filter by this much


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda x: x.isNull() | F.isnan(x) | (F.abs(x) == float("inf")))
    return F.coalesce(vector.isNotNull() & ~bad & F.exists(vector, lambda x: x != 0), F.lit(False))


def matrices(column: pa.Array) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(row numbers, matrix in double precision) for each vector length."""
    lengths = pa.compute.list_value_length(column).to_numpy(zero_copy_only=False)
    for d in np.unique(lengths):
        at = np.flatnonzero(lengths == d)
        part = column if len(at) == len(lengths) else column.take(pa.array(at))
        yield at, np.asarray(part.flatten().to_numpy(zero_copy_only=False), dtype=np.float64).reshape(len(at), d)


def unit_rows(x: np.ndarray) -> np.ndarray:
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


class Geometry:
    """Rotation, blocks, budgets and grid for vectors of one length."""

    def __init__(self, dims: int, threshold: float, blocks: int, grid_dims: int):
        self.dims, self.threshold = dims, threshold
        q, r = np.linalg.qr(np.random.default_rng(SEED + dims).normal(size=(dims, dims)))
        self.rotation = q * np.sign(np.diag(r))
        self.parts = [p for p in np.array_split(np.arange(dims), min(blocks, dims)) if len(p)]
        whole = 2 * (1 - threshold) + 1e-9
        self.budgets = [whole * len(p) / dims * (1 + _SLACK) for p in self.parts]
        self.grid_dims = grid_dims

    def rotated(self, x: np.ndarray) -> np.ndarray:
        return unit_rows(x) @ self.rotation

    def visits(self, y: np.ndarray, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(row, cell, own) of the cells of block ``b`` that a row lives in or,
        being later, reaches; cells are hashes of block, length and coordinates."""
        budget, radius = self.budgets[b], np.sqrt(self.budgets[b])
        row = np.arange(len(y))
        spent = np.zeros(len(y))
        cell = np.full(len(y), (b + 1) * 1_000_003 + self.dims, dtype=np.uint64)
        own = np.ones(len(y), dtype=bool)
        for c in self.parts[b][:self.grid_dims]:
            at = np.floor(y[row, c] / radius)
            low = y[row, c] - at * radius
            out = []
            for step, gap in ((-1, low), (0, np.zeros(len(row))), (1, radius - low)):
                cost = spent + gap * gap
                keep = cost <= budget
                if step == -1:
                    keep &= ~own            # only cells after the own one
                mixed = (cell ^ (at + step).astype(np.int64).view(np.uint64)) * np.uint64(0x9E3779B97F4A7C15)
                mixed ^= mixed >> np.uint64(32)
                out.append((row[keep], cost[keep], mixed[keep], own[keep] & (step == 0)))
            row, spent, cell, own = (np.concatenate(z) for z in zip(*out))
        return row, cell.view(np.int64), own


def _geometries(threshold: float, blocks: int, grid_dims: int):
    known: dict[int, Geometry] = {}

    def get(dims: int) -> Geometry:
        if dims not in known:
            known[dims] = Geometry(dims, threshold, blocks, grid_dims)
        return known[dims]
    return get


def _count_cells(threshold: float, blocks: int, grid_dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        geometry = _geometries(threshold, blocks, grid_dims)
        for batch in batches:
            for _, x in matrices(batch.column("embedding")):
                g = geometry(x.shape[1])
                y = g.rotated(x)
                for b in range(len(g.parts)):
                    _, cell, own = g.visits(y, b)
                    cells, at, n = np.unique(cell, return_inverse=True, return_counts=True)
                    members = np.bincount(at, weights=own, minlength=len(cells)).astype(np.int64)
                    yield pa.RecordBatch.from_pydict({"cell": pa.array(cells), "members": pa.array(members),
                                                      "visitors": pa.array(n.astype(np.int64) - members)})
    return run


def _deal(threshold: float, blocks: int, grid_dims: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        geometry = _geometries(threshold, blocks, grid_dims)
        for batch in batches:
            for rows, x in matrices(batch.column("embedding")):
                g = geometry(x.shape[1])
                y = g.rotated(x)
                for b in range(len(g.parts)):
                    row, cell, own = g.visits(y, b)
                    yield pa.RecordBatch.from_arrays([
                        pa.array(cell), pa.array(np.full(len(row), b, dtype=np.int32)), pa.array(own),
                        *[batch.column(c).take(pa.array(rows[row])) for c in ("node", "n", "embedding")]],
                        names=["cell", "block", "own", "node", "n", "embedding"])
    return run


def links_in_cell(g: Geometry, b: int, x: np.ndarray, member: np.ndarray, weight: np.ndarray,
                  among: bool = True) -> tuple[np.ndarray, Union]:
    """Link counts and spanning sets from the pairs (a member, any row) whose
    first block within budget is ``b``; not ``among``: (a member, another row)."""
    y, u = g.rotated(x), unit_rows(x)
    part = g.parts[b]
    radius = np.sqrt(g.budgets[b]) + _SINGLE
    free = part[min(g.grid_dims, len(part) - 1)]       # within a cell the grid's own coordinates differ little
    order = np.argsort(y[:, free], kind="stable")
    first = y[order, free]
    mine = np.flatnonzero(member[order])                # places in the order
    mine_first = first[mine]
    z = y[order][:, part].astype(np.float32)
    square = (z * z).sum(axis=1, keepdims=True)
    one = np.ones_like(square)
    left, right = np.hstack([z, square, one]), np.hstack([-2 * z, one, square])[mine]
    count, sets = np.zeros(len(x), dtype=np.int64), Union(len(x))
    given = np.arange(len(order)) if among else np.flatnonzero(~member[order])
    at = 0
    while at < len(given):
        lo = np.searchsorted(mine_first, first[given[at]] - radius)
        end = min(len(given), at + max(1, _CELLS_AT_ONCE // max(1, len(mine) - lo)))
        hi = np.searchsorted(mine_first, first[given[end - 1]] + radius)
        if hi > lo:
            near = left[given[at:end]] @ right[lo:hi].T <= g.budgets[b] + _SINGLE
            rows = np.flatnonzero(near.any(axis=1))
            if len(rows):
                cols = np.flatnonzero(near.any(axis=0))
                places = given[at + rows]
                _verify(g, b, near[np.ix_(rows, cols)], order[places], order[mine[lo + cols]], places,
                        mine[lo + cols], member, u, y, weight, count, sets)
        at = end
    return count, sets


def _verify(g, b, near, rows, cols, row_place, col_place, member, u, y, weight, count, sets) -> None:
    # two members meet once, in their order
    near &= ~member[rows][:, None] | (row_place[:, None] < col_place[None, :])
    i, j = np.nonzero(near)
    if len(i) * 4 <= near.size:
        ok = np.zeros(len(i), dtype=bool)
        for s in range(0, len(i), 200_000):
            a, c = rows[i[s:s + 200_000]], cols[j[s:s + 200_000]]
            good = (u[a] * u[c]).sum(axis=1) >= g.threshold
            if good.any():
                gap = (y[a] - y[c]) ** 2
                good &= gap[:, g.parts[b]].sum(axis=1) <= g.budgets[b]
                for k in range(b):
                    good &= gap[:, g.parts[k]].sum(axis=1) > g.budgets[k]
            ok[s:s + 200_000] = good
        near[:] = False
        near[i[ok], j[ok]] = True
    else:
        near &= u[rows] @ u[cols].T >= g.threshold
        for k in range(b + 1):
            p = g.parts[k]
            gap = ((y[rows][:, p] ** 2).sum(axis=1)[:, None] + (y[cols][:, p] ** 2).sum(axis=1)[None, :]
                   - 2 * y[rows][:, p] @ y[cols][:, p].T)
            near &= (gap <= g.budgets[k]) if k == b else (gap > g.budgets[k])
    if near.any():
        np.add.at(count, rows, near @ weight[cols])
        np.add.at(count, cols, weight[rows] @ near)
        join_matches(near, rows, cols, sets)


def dealt_units(distinct: DataFrame, threshold: float, blocks: int, cell_rows: int, grid_dims: int) -> DataFrame:
    """Rows of ``distinct`` once for each unit (cell, block, i, j) they take part in."""
    given = (threshold, blocks, grid_dims)
    counts = distinct.select("embedding").mapInArrow(
        _count_cells(*given), fields(("cell", T.LongType()), ("members", T.LongType()), ("visitors", T.LongType())))
    visits = distinct.mapInArrow(_deal(*given), T.StructType([
        T.StructField("cell", T.LongType()), T.StructField("block", T.IntegerType()),
        T.StructField("own", T.BooleanType()), *distinct.select("node", "n", "embedding").schema.fields]))
    return units(visits, crowded_cells(counts, cell_rows))


def links(distinct: DataFrame, threshold: float = THRESHOLD, blocks: int = BLOCKS,
          cell_rows: int = CELL_ROWS) -> DataFrame:
    """``distinct`` (node, n, embedding) -> (node, other, links): rows with
    ``links`` add to a node's count, rows with ``other`` span the links."""
    rows = distinct.count()
    grid_dims = max(1, round(np.log(max(1.0, rows / cell_rows)) / np.log(3)))
    given = (threshold, blocks, grid_dims)

    def run(table: pa.Table) -> pa.Table:
        nodes, b = table.column("node").to_numpy(), table.column("block")[0].as_py()
        out = {"node": [], "other": [], "links": []}
        member = table.column("member").to_numpy(zero_copy_only=False).astype(bool)
        if member.any():
            weight = table.column("n").to_numpy()
            among = table.column("i")[0] == table.column("j")[0]
            for at, x in matrices(table.column("embedding").combine_chunks()):
                count, sets = links_in_cell(Geometry(x.shape[1], *given), b, x, member[at], weight[at], among)
                own = nodes[at]
                some = np.flatnonzero(count)
                a, c = sets.stars()
                out["node"] += [own[some], own[a]]
                out["other"] += [np.zeros(len(some), dtype=np.int64), own[c]]
                out["links"] += [count[some], np.zeros(len(a), dtype=np.int64)]
        node, other, n = (np.concatenate(v).astype(np.int64) if v else np.array([], dtype=np.int64) for v in out.values())
        return pa.table({"node": node, "other": pa.array(other, mask=n > 0), "links": n})

    return dealt_units(distinct, threshold, blocks, cell_rows, grid_dims).groupBy("cell", "block", "i", "j").applyInArrow(
        run, fields(("node", T.LongType()), ("other", T.LongType()), ("links", T.LongType())))


def near_duplicates(vectors: DataFrame, key: str = "vec_id", vector: str = "embedding",
                    threshold: float = THRESHOLD, blocks: int = BLOCKS, cell_rows: int = CELL_ROWS) -> DataFrame:
    """(key, n_links, component) of every row."""
    rows = vectors.select(F.col(key).alias("_key"), F.col(vector).alias("embedding"))
    takes_part = usable(F.col("embedding"))
    # a node is a distinct vector; its number is fixed by being written
    distinct = saved(rows.filter(takes_part).groupBy("embedding")
                     .agg(F.min("_key").cast("long").alias("least"), F.count(F.lit(1)).alias("n"))
                     .select(F.monotonically_increasing_id().alias("node"), "least", "n", "embedding"), "vectors")
    found = saved(links(distinct.select("node", "n", "embedding"), threshold, blocks, cell_rows), "veclinks")
    counts = found.filter(F.col("links") > 0).groupBy("node").agg(F.sum("links").alias("linked"))
    classes = connected_components(found.filter(F.col("other").isNotNull())
                                   .select(F.col("node").alias("src"), F.col("other").alias("dst")))
    named = (classes.join(distinct.select("node", "least"), "node")
             .groupBy("component").agg(F.min("least").alias("first")))
    about = (distinct.join(counts, "node", "left").join(classes, "node", "left").join(named, "component", "left")
             .select(F.col("embedding").alias("_vector"),
                     (F.coalesce("linked", F.lit(0)) + F.col("n") - 1).alias("n_links"),
                     F.coalesce("first", "least").alias("component")))
    return (rows.join(about, (F.col("embedding") == F.col("_vector")) & takes_part, "left")
            .select(F.col("_key").alias(key), F.coalesce("n_links", F.lit(0)).cast("long").alias("n_links"),
                    F.coalesce(F.col("component"), F.col("_key").cast("long")).alias("component")))


def op1_embedding_dedup(spark, sf_dir: str) -> DataFrame:
    """Direct links and component of every vector at cosine 0.95."""
    from llm.common import load

    found = near_duplicates(load(spark, sf_dir, "embeddings"))
    return found.select("vec_id", "n_links", F.col("component").alias("component_id"),
                        F.coalesce(F.col("vec_id") == F.col("component"), F.lit(False)).alias("kept"))
