from __future__ import annotations

import math
import random
import re
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm import mixing as M


def plain_targets(sizes, weights=M.WEIGHTS, share=M.SHARE):
    """Excess over twice a source's size is shared again until none is above."""
    names = sorted(sizes, key=lambda s: (s is None, s or ""))
    weight = {s: weights[i % len(weights)] for i, s in enumerate(names)}
    total, full = share * sum(sizes.values()), set()
    while True:
        rest = [s for s in names if s not in full]
        level = (total - sum(2 * sizes[s] for s in full)) / sum(weight[s] for s in rest) if rest else 0
        over = {s for s in rest if level * weight[s] > 2 * sizes[s]}
        if not over:
            return {s: 2 * sizes[s] if s in full else level * weight[s] for s in names}
        full |= over


@pytest.mark.parametrize("sizes", [
    {"a": 100, "b": 100, "c": 100}, {"a": 10, "b": 1000, "c": 5, None: 300}, {"z": 7}, {"a": 0, "b": 50}, {"é": 3, "z": 9, "Z": 27},
    {f"s{i}": (i * 37) % 101 + 1 for i in range(25)}])
def test_targets(spark, sizes):
    got = M.targets(spark.createDataFrame(list(sizes.items()), "source string, source_size long")).collect()
    expected = plain_targets(sizes)
    assert {r.source: pytest.approx(r.target) for r in got} == expected


def test_tree_keeps_quotas_exact(spark):
    quotas = {0: 40, 1: 3, 2: 0, 3: 25}
    df = spark.createDataFrame(list(quotas.items()), "place int, n long")
    got = M.shard_quotas(df, 7).collect()
    by_source, by_shard = Counter(), Counter()
    for r in got:
        by_source[r.place] += r.n
        by_shard[r.shard] += r.n
    assert {p: by_source[p] for p in quotas} == quotas
    assert set(by_shard) == set(range(7)) and max(by_shard.values()) - min(by_shard.values()) <= 2
    assert sorted(map(tuple, M.shard_quotas(df, 7).collect())) == sorted(map(tuple, got))


def test_tree_draws_like_the_distribution(spark):
    """The mean of a source's blocks in the left half, over many seeds."""
    df = spark.createDataFrame([(0, 12), (1, 4)], "place int, n long")
    left = [next(r.n for r in M.shard_quotas(df, 2, seed).collect() if (r.shard, r.place) == (0, 1)) for seed in range(60)]
    assert len(set(left)) > 2 and abs(sum(left) / len(left) - 2.0) < 0.5


@pytest.mark.parametrize("held,good,room", [(16, 12, 8), (40, 3, 37), (9, 9, 4), (60, 30, 30), (500, 7, 250), (30, 1, 1)])
def test_draws_follow_the_hypergeometric_distribution(spark, held, good, room):
    n = 6000
    chance = (F.col("id") + 0.5) / n        # evenly spread, so that the counts are the distribution's own
    drawn = spark.range(n).select(M._hypergeometric(F.lit(held), F.lit(good), F.lit(room), chance).alias("x"))
    got = {r.x: r["count"] / n for r in drawn.groupBy("x").count().collect()}
    for x in range(held + 1):
        expected = math.comb(good, x) * math.comb(held - good, room - x) / math.comb(held, room) if x <= min(good, room) else 0.0
        assert got.get(x, 0.0) == pytest.approx(expected, abs=1.01 / n), x


def test_a_hundred_million_blocks(spark):
    quotas = {0: 70_000_000, 1: 29_999_999, 2: 1, 3: 0}
    got = M.shard_quotas(spark.createDataFrame(list(quotas.items()), "place int, n long"), 8).collect()
    by_source, by_shard = Counter(), Counter()
    for r in got:
        by_source[r.place] += r.n
        by_shard[r.shard] += r.n
    assert {p: by_source[p] for p in quotas} == quotas and max(by_shard.values()) - min(by_shard.values()) <= 3
    # a shard's share of the first source is within six standard deviations
    assert all(abs(r.n - 8_750_000) < 6 * 1600 for r in got if r.place == 0)


def test_equal_rows_of_two_sources(spark, make_docs):
    rows = [(i % 5, "the same few words " * 20, "en", "ab"[i % 2]) for i in range(40)]
    taken = []
    for parts in (1, 3):
        docs = make_docs(rows).repartition(parts, "source", "doc_id")
        drawn = M.Mix(docs, block_words=60).draws(docs)
        taken.append(sorted((r.source, r.doc_id, r.n) for r in drawn.select(
            "source", "doc_id", (F.col("_size") * F.size("_shards")).alias("n")).collect()))
    assert taken[0] == taken[1]


def documents(n=400):
    rng = random.Random(2)
    rows = [(i, "word " * rng.randint(0, 30), "en", rng.choice(["a", "b", "c", "hot", "hot", None])) for i in range(n)]
    return rows + [(n, None, None, "a"), (n + 1, "", None, "b"), (n + 2, "w " * 3000, None, "hot"), (3, rows[3][1], "en", rows[3][3]),
                   (None, "no id at all", None, "c")]


def test_query(spark, make_docs, as_tables):
    rows = documents()
    docs = make_docs(rows, extra=("size", "block", "place"))
    sf = as_tables(documents=docs)
    got = M.op7_mixing(spark, sf).collect()
    assert len(got) == len(rows)
    sizes = defaultdict(int)
    for _, text, _, source in rows:
        sizes[source] += len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
    expected = plain_targets(sizes)
    taken = Counter()
    sources = {(i, len((t or "").split())): s for i, t, _, s in rows}
    for r in got:
        source = sources[r.doc_id, r.size]
        assert r.source_size == sizes[source] and r.target == pytest.approx(expected[source])
        assert 0 <= r.taken <= 2 * r.size
        taken[source] += r.taken
    for source, target in expected.items():
        assert abs(taken[source] - target) <= max(30, 0.01 * target) + (3000 if source == "hot" else 0)
    again = M.op7_mixing(spark, sf).collect()
    assert sorted(map(repr, again)) == sorted(map(repr, got))


def test_mix_rows_are_disjoint_draws(spark, make_docs):
    docs = make_docs(documents())
    mix = M.Mix(docs, block_words=200, shard_words=1500)
    assert mix.n_shards > 3
    drawn = mix.draws(docs).withColumn("_n", F.size("_shards")).collect()
    assert {r._n for r in drawn} <= {0, 1, 2}
    rows = mix.rows(docs)
    assert rows.columns == docs.columns and rows.count() == sum(r._n for r in drawn)
    words = Counter()
    for r in drawn:
        for s in r._shards:
            words[s] += r._size
    assert set(words) == set(range(mix.n_shards))


def test_empty_table(spark, make_docs):
    docs = make_docs([])
    assert M.Mix(docs).draws(docs).count() == 0 and M.Mix(docs).rows(docs).count() == 0
    blank = make_docs([(1, None, None, "a"), (2, "", None, None)])
    assert {r._size for r in M.Mix(blank).draws(blank).collect()} == {0}


def test_repeated_rows_are_drawn_on_their_own(spark, make_docs):
    """A row that makes up a source does not go in or stay out as one."""
    docs = make_docs([(1, "a b c d", None, "s")] * 400 + [(i, "a b c d", None, "s") for i in range(2, 202)]
                     + [(1000 + i, "w x y z", None, "t") for i in range(300)]).repartition(5)
    mix = M.Mix(docs, block_words=200, shard_words=1500, weights=(1.0, 5.0), share=0.7)
    assert mix.blocks.filter("place = 0").agg(F.max("words")).first()[0] < 600
    drawn = mix.draws(docs).withColumn("_n", F.size("_shards"))
    got = drawn.groupBy("source").agg(F.sum(F.col("_n") * F.col("_size")).alias("taken"), F.first("_target").alias("target")).collect()
    for r in got:
        assert abs(r.taken - r.target) <= 2, r
    assert drawn.filter("doc_id = 1").select("_n").distinct().count() == 2
    numbers = [(r.copy, r.h) for r in mix._told_apart(mix.numbered.select(
        mix._draw_key().alias("key"), F.col(mix.row).alias("row"))).withColumn("h", mix._draw_hash()).filter("copy >= 0").collect()]
    assert len({h for _, h in numbers}) == 900 and sorted(c for c, _ in numbers if c) == list(range(1, 400))
