from __future__ import annotations

import re

import numpy as np
import pytest
import xxhash

from llm import simhash as S


def plain_fingerprint(text):
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or "")) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 4]) for i in range(len(words) - 3)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def plain_components(ids, codes, bits=4):
    sets = S.Union(len(codes))
    for i, c in enumerate(codes):
        sets.join(i, np.flatnonzero(np.bitwise_count(codes ^ c) <= bits).tolist())
    roots = [sets.find(i) for i in range(len(codes))]
    least = {}
    for i, r in zip(ids, roots):
        least[r] = min(i, least.get(r, i))
    return {i: least[r] for i, r in zip(ids, roots)}


@pytest.mark.parametrize("text", [None, "", " \n\t", "One", "a b c", "A b C d", "É a b c d É", "x " * 500,
                                  "The quick\x0bbrown fox jumps over\nthe LAZY dog", "a b c d " * 3 + "e"])
def test_fingerprint(text):
    assert S.fingerprint(text) == plain_fingerprint(text)


@pytest.mark.parametrize("leaf_rows", [20, 100_000])
def test_components_against_brute_force(spark, make_docs, leaf_rows):
    rng = np.random.default_rng(0)
    words = [f"w{i}" for i in range(50)]
    base = [" ".join(rng.choice(words, size=120)) for _ in range(60)]
    texts = base + [b + " tail" for b in base[:30]] + [base[0]] * 40 + [None, "", " "] + [b + f" t{i}" for i, b in enumerate(base[:5] * 8)]
    docs = make_docs(list(enumerate(texts)) + [(None, base[1])])
    got = S.near_duplicates(docs, leaf_rows=leaf_rows).toPandas()
    nulls = got[got.doc_id.isna()]
    assert nulls.component.isna().all() and nulls.fp.iloc[0] == got[got.doc_id == 1].fp.iloc[0]
    codes = np.array([S.fingerprint(t) for t in texts], dtype=np.uint64)
    expected = plain_components(list(range(len(texts))), codes)
    rows = got.dropna()
    assert {int(a): int(b) for a, b in zip(rows.doc_id, rows.component)} == expected


def test_tree_loses_no_close_pair():
    rng = np.random.default_rng(1)
    codes = rng.integers(0, 1 << 63, size=400, dtype=np.uint64)
    near = codes.copy()
    for _ in range(4):
        near ^= np.uint64(1) << rng.integers(0, 64, size=400).astype(np.uint64)
    radii = [np.full(1 << level, 32 - level % 2, dtype=np.int16) for level in range(6)]
    tree = S.Tree(radii)
    both = np.concatenate([codes, near])
    home = tree.home(both)
    row, leaf = tree.visits(both, 4)
    seen = set(zip(row.tolist(), leaf.tolist()))
    assert all((i, int(home[i])) in seen for i in range(800))
    for i in range(400):
        a, b = sorted((i, i + 400), key=lambda x: home[x])
        assert (a, int(home[b])) in seen


@pytest.mark.parametrize("bound", [40, 700])
def test_close_fingerprints_stay_in_bounded_units(spark, bound):
    rng = np.random.default_rng(3)
    flips = np.array([sum(1 << int(b) for b in rng.choice(64, size=rng.integers(0, 5), replace=False)) for _ in range(1_500)], dtype=np.uint64)
    codes = np.unique(np.concatenate([np.uint64(0x1234567890ABCDEF) ^ flips, rng.integers(0, 1 << 63, size=300, dtype=np.uint64)]))
    df = spark.createDataFrame([(int(c), i) for i, c in enumerate(codes.view(np.int64))], "fp long, node long")
    tree = S.build_tree(df, len(codes), bound)
    sizes = S.dealt_units(df, tree, 4, bound).groupBy("cell", "i", "j").count().toPandas()
    assert sizes["count"].max() <= 2 * bound and (bound == 700 or (sizes.i < sizes.j).any())
    expected = plain_components(list(range(len(codes))), codes)
    got = {r.node: r.component for r in S.near_groups(df, 4, bound).collect()}
    assert {i: got.get(i, i) for i in expected} == expected


def test_query_result_and_empty_table(spark, make_docs, as_tables):
    docs = make_docs([(5, "a b c d e"), (3, "A B c d e"), (9, "something else here entirely now")], extra=("fp", "component", "node"))
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in S.op8_simhash(spark, as_tables(documents=docs)).collect()}
    assert got[5] == got[3] and got[5][1] == 3 and got[9][1] == 9
    assert got[5][0] == f"{plain_fingerprint('a b c d e'):016x}"
    assert S.near_duplicates(make_docs([])).count() == 0


def test_unlike_texts_of_one_id_stay_apart(spark, make_docs):
    rng = np.random.default_rng(8)
    text = lambda: " ".join(f"w{x}" for x in rng.integers(0, 10**6, 60))
    a, b = text(), text()
    # both fingerprints have 1 as their smallest id; no link connects them
    docs = make_docs([(1, a), (1, b), (2, a), (3, b), (4, text())])
    fps = S.fingerprint_classes(S.fingerprints(docs), ("doc_id",))
    assert fps[0].select("group").distinct().count() == 3 and fps[1].count() == 3
    assert sorted(r.component for r in S.near_duplicates(docs).collect()) == [1, 1, 1, 1, 4]
