"""Near-duplicate vectors and nearest neighbours against brute force."""

from __future__ import annotations

import numpy as np
import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from llm import embedding_dedup as E
from llm import neighbours as N
from llm.simhash import Union
from tests.llm.conftest import rows_of_sql

SCHEMA = T.StructType([T.StructField("vec_id", T.LongType()), T.StructField("embedding", T.ArrayType(T.FloatType())),
                       T.StructField("label", T.IntegerType())])


def sample(seed=0, n=500, d=24, copies=60):
    rng = np.random.default_rng(seed)
    x = rng.normal(size=(n, d))
    near = x[rng.integers(0, n, 150)] + rng.normal(size=(150, d)) * rng.uniform(0.05, 0.4, size=(150, 1))
    hot = x[0] + rng.normal(size=(copies, d)) * 0.08
    return np.vstack([x, near, hot, x[1:2].repeat(30, axis=0), x[2:3] * 2.5]).astype(np.float32)


def frame(spark, x, odd=()):
    rows = [(i, v.tolist(), 0) for i, v in enumerate(x)] + list(odd)
    return spark.createDataFrame(rows, SCHEMA)


ODD = [(9000, None, 1), (9001, [], 1), (9002, [0.0] * 24, 1), (9003, [float("nan")] + [1.0] * 23, 1), (9004, [None] + [1.0] * 23, 1),
       (9005, [float("inf")] * 24, 1), (9006, [1.0, 2.0], 1), (9007, [2.0, 4.0], 1), (None, [1.0] * 24, 1)]


def plain_links(x, threshold=0.95):
    u = x.astype(float) / np.linalg.norm(x.astype(float), axis=1)[:, None]
    near = u @ u.T >= threshold
    np.fill_diagonal(near, False)
    sets = Union(len(x))
    for i, j in zip(*np.nonzero(near)):
        sets.join(int(i), [int(j)])
    roots = [sets.find(i) for i in range(len(x))]
    least = {}
    for i, r in enumerate(roots):
        least.setdefault(r, i)
    return near.sum(axis=1), [least[r] for r in roots]


@pytest.mark.parametrize("blocks,cell_rows", [(8, 16_384), (8, 60), (3, 25), (1, 100), (24, 200)])
def test_links_and_components(spark, blocks, cell_rows):
    x = sample()
    got = E.near_duplicates(frame(spark, x), blocks=blocks, cell_rows=cell_rows).toPandas().set_index("vec_id").sort_index()
    count, component = plain_links(x)
    assert got.n_links.tolist() == count.tolist()
    assert got.component.tolist() == component


def test_crowded_cells_stay_bounded(spark):
    rng = np.random.default_rng(5)
    base = rng.normal(size=24)
    x = np.vstack([base + rng.normal(size=(3_000, 24)) * 0.05, rng.normal(size=(400, 24))]).astype(np.float32)
    distinct = frame(spark, x).select(F.col("vec_id").alias("node"), F.lit(1).cast("long").alias("n"), "embedding")
    sizes = (E.dealt_units(distinct, 0.95, 8, 256, 2).groupBy("cell", "block", "i", "j")
             .agg(F.count(F.lit(1)).alias("n"), F.count_if("member").alias("m")).toPandas())
    assert sizes.n.max() <= 512 and len(sizes[sizes.i < sizes.j]) > 100
    got = E.near_duplicates(frame(spark, x), cell_rows=256).toPandas().set_index("vec_id").sort_index()
    count, component = plain_links(x)
    assert got.n_links.tolist() == count.tolist() and got.component.tolist() == component


def test_vectors_without_id_are_compared(spark):
    x = sample(4, 40, 24, 5)
    vectors = frame(spark, x, [(None, x[3].tolist(), 0), (None, (x[4] * 1.001).tolist(), 0), (None, [5.0, 7.0], 0)])
    got = E.near_duplicates(vectors).toPandas()
    plain = E.near_duplicates(frame(spark, x)).toPandas().set_index("vec_id")
    ids = got.dropna(subset=["vec_id"]).set_index("vec_id")
    assert ids.n_links[3] == plain.n_links[3] + 1 and ids.n_links[4] == plain.n_links[4] + 1
    assert ids.component.to_dict() == plain.component.to_dict()
    lone = got[got.vec_id.isna()].component.tolist()
    assert sorted(lone, key=str)[:2] == sorted([ids.component[3], ids.component[4]], key=str) and sum(c != c for c in lone) == 1


def test_query_on_odd_vectors(spark, as_tables, tmp_path):
    x = sample(1, 80, 24, 10)
    vectors = frame(spark, x, ODD + [(5, x[7].tolist(), 0)]).withColumn("node", F.lit("x")).withColumn("component", F.lit("y"))
    query = E.op1_embedding_dedup(spark, as_tables(embeddings=vectors))
    assert rows_of_sql(spark, tmp_path, "op1_embedding_dedup") == sorted(map(repr, map(tuple, query.collect())))
    got = query.toPandas()
    assert got.columns.tolist()[:4] == ["vec_id", "n_links", "component_id", "kept"] and len(got) == len(x) + len(ODD) + 1
    odd = got[got.vec_id >= 9000].set_index("vec_id").sort_index()
    assert (odd.loc[9000:9005].n_links == 0).all() and odd.loc[9000:9005].kept.all()
    assert odd.n_links[9006] == 1 and odd.component_id[9007] == 9006
    assert got[got.vec_id.isna()].component_id.isna().all()
    assert E.near_duplicates(frame(spark, x[:0])).count() == 0


def plain_nearest(x, ids, queries, top=20):
    out = {}
    for q in queries:
        s = (x.astype(float) * x[q].astype(float)).sum(axis=1)
        order = [i for i in np.lexsort((ids, -s)) if ids[i] != ids[q]][:top]
        out[int(ids[q])] = [(int(ids[i]), s[i]) for i in order]
    return out


def test_nearest_recall_and_scores(spark, as_tables):
    x = sample(2, 1500, 24, 200)
    x /= np.linalg.norm(x, axis=1)[:, None]
    ids = np.arange(len(x))
    vectors = frame(spark, x, ODD).withColumn("node", F.lit("x"))
    got = N.op6_nearest(spark, as_tables(embeddings=vectors)).toPandas()
    assert got.columns.tolist() == ["query_id", "rank", "vec_id", "score"]
    expected = plain_nearest(x, ids, range(0, len(x), 20))
    hits = total = 0
    assert set(got.query_id) == set(expected)
    for q, rows in got.groupby("query_id"):
        rows = rows.sort_values("rank")
        assert rows["rank"].tolist() == list(range(1, 21)) and q not in set(rows.vec_id)
        assert rows.vec_id.is_unique
        s = (x[rows.vec_id].astype(float) * x[q].astype(float)).sum(axis=1)
        assert np.abs(rows.score.to_numpy() - s).max() < 1e-12
        keys = list(zip(-rows.score, rows.vec_id))
        assert keys == sorted(keys)
        wanted = {i for i, _ in expected[q]}
        # a found row as near as the farthest wanted is as good (ties to rounding)
        hits += sum(i in wanted or sc >= expected[q][-1][1] - 1e-12 for i, sc in zip(rows.vec_id, rows.score))
        total += 20
    assert hits / total >= 0.95


def test_different_norms(spark):
    rng = np.random.default_rng(3)
    x = sample(3, 1200, 16, 20)
    x = x * rng.uniform(0.2, 3, size=(len(x), 1)).astype(np.float32)
    got = N.nearest(frame(spark, x), F.col("vec_id") % 20 == 0).toPandas()
    expected = plain_nearest(x, np.arange(len(x)), range(0, len(x), 20))
    hits = sum(len({i for i, _ in expected[q]} & set(rows.vec_id)) for q, rows in got.groupby("query_id"))
    assert hits / (20 * len(expected)) >= 0.9


@pytest.mark.parametrize("n", [0, 1, 2, 15])
def test_few_vectors(spark, n):
    x = np.eye(24, dtype=np.float32)[:n] + 0.01
    got = N.nearest(frame(spark, x), F.col("vec_id") % 20 == 0)
    assert got.count() == (max(0, n - 1) if n else 0)


def test_identical_vectors(spark):
    x = np.ones((40, 8), dtype=np.float32)
    got = N.nearest(frame(spark, x), F.col("vec_id") % 20 == 0).toPandas()
    assert got[got.query_id == 0].sort_values("rank").vec_id.tolist() == list(range(1, 21))
    assert got[got.query_id == 20].sort_values("rank").vec_id.tolist() == list(range(0, 20))


def test_recall_of_unequal_norms_at_size(spark):
    """Beams are widened until the measured recall is reached, and it is the true one."""
    rng = np.random.default_rng(12)
    x = rng.normal(size=(5000, 64))
    x *= (rng.uniform(0.3, 3, size=5000) / np.linalg.norm(x, axis=1))[:, None]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    got = N.nearest(df, F.col("vec_id") % 20 == 0, beam=24).toPandas().groupby("query_id").vec_id.apply(set)
    queries = np.arange(0, 5000, 20)
    scores = x[queries] @ x.T
    scores[np.arange(len(queries)), queries] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    assert np.mean([len(got[q] & set(w.tolist())) / 20 for q, w in zip(queries.tolist(), want)]) >= 0.92


def test_search_that_does_not_end_fails(spark):
    x = np.random.default_rng(3).normal(size=(400, 16))
    df = spark.createDataFrame([(i, v) for i, v in enumerate(x.tolist())], "vec_id long, embedding array<double>")
    with pytest.raises(RuntimeError, match="open nodes"):
        N.nearest(df, F.col("vec_id") % 20 == 0, beam=40, search_rounds=0)


def recall_of(x, found):
    queries = np.arange(0, len(x), 20)
    scores = x[queries].astype(float) @ x.T.astype(float)
    scores[np.arange(len(queries)), queries] = -np.inf
    want = np.argsort(-scores, axis=1)[:, :20]
    return np.mean([len(found.get(q, set()) & set(w.tolist())) / 20 for q, w in zip(queries.tolist(), want)])


def test_recall_beside_one_very_long_vector(spark):
    """One outlier does not make the codes of all other vectors the same."""
    x = np.random.default_rng(1).normal(size=(2000, 32)).astype(np.float32)
    x[7] *= 1000
    got = N.nearest(frame(spark, x), F.col("vec_id") % 20 == 0).toPandas().groupby("query_id").vec_id.apply(set)
    assert recall_of(x, got) >= 0.92


def test_few_rows_in_groups_of_unequal_norms(spark):
    """Fewer rows than a beam holds: groups of near vectors, the nearest of some in other groups."""
    rng = np.random.default_rng(4)
    x = np.repeat(np.eye(30) * 5, 6, axis=0) + rng.normal(size=(180, 30)) * 0.01
    x = (x * rng.uniform(0.2, 3, size=(180, 1))).astype(np.float32)
    got = N.nearest(frame(spark, x), F.col("vec_id") % 20 == 0).toPandas().groupby("query_id").vec_id.apply(set)
    assert recall_of(x, got) >= 0.92


def test_beams_without_a_graph_are_checked(spark):
    """No links to follow, and a query without a beam: all nodes are scored."""
    x = np.random.default_rng(2).normal(size=(300, 8)).astype(np.float32)
    nodes = frame(spark, x).select(F.col("vec_id").alias("node"), "embedding")
    queries = nodes.filter(F.col("node") % 20 == 0).select(
        F.col("node").alias("query"), F.col("node").alias("entry"), F.col("embedding").alias("vector"))
    graph = (nodes.filter("node != 40").withColumn("others", F.array("node")).select("node", "others"))
    beams = N.search(queries, nodes, graph, len(x), 32)
    assert N.measured_recall(queries, nodes, beams, 21) < 0.1
    full = N.widened_search(queries, nodes, graph, len(x), 32, 50, 21)
    assert N.measured_recall(queries, nodes, full, 21) == 1.0 and full.count() == 15
    got = {r.query: set(r.ids[:21]) - {r.query} for r in full.collect()}
    assert recall_of(x, got) == 1.0


def test_op6_of_all_pairs_in_few_jobs(spark, as_tables):
    """Exact, equal scores by id also at the last rank, without rounds of joins."""
    x = np.random.default_rng(6).integers(-1, 2, size=(1500, 12)).astype(np.float32)
    x = x[x.any(axis=1)]
    spark.sparkContext.setJobGroup("op6", "op6")
    got = N.op6_nearest(spark, as_tables(embeddings=frame(spark, x))).toPandas()
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("op6"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert 0 < jobs <= 40
    expected = plain_nearest(x, np.arange(len(x)), range(0, len(x), 20))
    found = {q: list(zip(rows.vec_id, rows.score)) for q, rows in got.sort_values("rank").groupby("query_id")}
    assert found == expected


def test_all_pairs_of_any_magnitude_in_chunks(spark, monkeypatch):
    rng = np.random.default_rng(9)
    x = (rng.normal(size=(700, 12)) * 10.0 ** rng.uniform(-15, 15, size=(700, 1))).astype(np.float32)
    monkeypatch.setattr(N, "CHUNK", 120)
    got = N.nearest(frame(spark, x), F.col("vec_id") % 20 == 0, scanned=N.SCANNED).toPandas()
    expected = plain_nearest(x, np.arange(len(x)), range(0, len(x), 20))
    assert set(got.query_id) == set(expected)
    for q, rows in got.sort_values("rank").groupby("query_id"):
        np.testing.assert_allclose(rows.score, [s for _, s in expected[q]], rtol=1e-11)
    assert N.nearest(frame(spark, x), F.lit(False), scanned=N.SCANNED).count() == 0


def test_all_pairs_in_products_of_any_size(monkeypatch):
    rng = np.random.default_rng(8)
    v = rng.permutation(np.unique(rng.integers(-3, 4, size=(900, 4)), axis=0)).astype(float)
    v = v[v.any(axis=1)]
    batches = [N.pa.RecordBatch.from_arrays([N.pa.array(np.arange(a, a + len(p))), N._lists(p.ravel(), np.arange(len(p)) * 4)],
                                            names=["node", "embedding"]) for a in range(0, len(v), 70) for p in [v[a:a + 70]]]
    wanted = [np.lexsort((np.arange(len(v)), -(v * q).sum(axis=1)))[:9].tolist() for q in v[:100]]
    for values, width in ((1 << 20, 512), (1000, 7), (4, 1)):
        monkeypatch.setattr(N, "SCAN_VALUES", values)
        monkeypatch.setattr(N, "SCAN_QUERIES", width)
        (found,) = N._scan(np.arange(100), v[:100], 9)(iter(batches))
        assert found.column("ids").to_pylist() == wanted
    (few,) = N._scan(np.arange(100), v[:100], 90)(iter(batches[:1]))
    assert {len(i) for i in few.column("ids").to_pylist()} == {70}
    assert not list(N._scan(np.arange(100), v[:100], 9)(iter(())))
