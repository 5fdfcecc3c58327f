from __future__ import annotations

import hashlib
import zlib
from collections import Counter, defaultdict

import pytest
from pyspark.sql import functions as F

from llm import manifest as M
from tests.llm.conftest import rows_of_sql


def sha(text):
    return hashlib.sha256(text.encode()).hexdigest()


def leaf_of(values):
    return sha("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in values))


def climb(nodes, fanout):
    """Root and, per node, its siblings by level as (before, after)."""
    paths, at = [[] for _ in nodes], list(range(len(nodes)))
    while len(nodes) > 1:
        for i, p in enumerate(at):
            run = p - p % fanout
            paths[i].append((nodes[run:p], nodes[p + 1:run + fanout]))
        nodes = [sha("".join(nodes[i:i + fanout])) for i in range(0, len(nodes), fanout)]
        at = [p // fanout for p in at]
    return nodes[0], paths


def fold(node, path):
    for before, after in path:
        node = sha("".join([*before, node, *after]))
    return node


def brute(rows, fanout=3):
    """rows: (doc_id, text, lang, source, n_chars) in table order."""
    groups = defaultdict(list)
    for doc_id, text, lang, source, n_chars in rows:
        plain = text if text is None or doc_id is None or zlib.crc32(str(doc_id).encode()) % 2 else text.replace("\n", "")
        groups[source].append((doc_id, leaf_of((doc_id, source, lang, n_chars, text)), leaf_of((doc_id, source, lang, n_chars, plain))))
    names = sorted(groups, key=lambda s: (s is not None, (s or "").encode()))
    trees = []
    for s in names:
        groups[s].sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1]))
        trees.append(climb([r[1] for r in groups[s]], fanout))
    root, above = climb([t[0] for t in trees], fanout)
    out = Counter()
    for s, (subroot, paths), high in zip(names, trees, above):
        for (doc_id, leaf, other), path in zip(groups[s], paths):
            whole = path + high
            folded = fold(other, whole)
            out[doc_id, leaf, subroot, root, sha("".join("".join(b + a) for b, a in whole)), folded, folded == root] += 1
    return out


ROWS = [(7, "a\nb", "en", "x"), (7, "a\nb", "en", "x"), (7, "other\n", None, "x"), (None, "no id\n", "en", "x"),
        (1, None, None, None), (2, "", "", None), (3, "ünï\n日\n", "de", "é"), (4, "\n" * 50 + "w" * 100_000, "fr", "Z"),
        *[(i, f"line {i}\nnext", "en", f"s{i % 2}") for i in range(100, 131)],
        *[(500, "copy\n", "en", "hot") for _ in range(90)]]


@pytest.mark.parametrize("fanout", [2, 3, 5])
def test_equals_brute_force(spark, make_docs, as_tables, tmp_path, fanout):
    docs = make_docs(ROWS, extra=("leaf", "root", "_grp", "_pos", "digest", "path")).repartition(5)
    got = M.op11_manifest(spark, as_tables(documents=docs)) if fanout == 3 else M.digests(docs, fanout)
    assert got.columns == ["doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified"]
    rows = [tuple(r) for r in got.collect()]
    given = [(r[0], r[1], r[2], r[3], None if r[1] is None else len(r[1])) for r in ROWS]
    assert Counter(rows) == brute(given, fanout)
    assert {r[-1] for r in rows} == {True, False}
    if fanout == 3:
        assert sorted(map(repr, rows)) == rows_of_sql(spark, tmp_path, "op11_manifest")


@pytest.mark.parametrize("n", [1, 2, 3, 4, 9, 10, 27, 28])
def test_heights(spark, make_docs, n):
    m = M.build(make_docs([(i, "t", "en", "only") for i in range(n)]))
    assert m.root().first()[0] == climb([leaf_of((i, "only", "en", 1, "t")) for i in range(n)], 3)[0]
    checked = M.verify(M.proofs(m)).collect()
    assert len(checked) == n and all(r.verified for r in checked)


def test_many_groups_and_change(spark, make_docs):
    docs = make_docs([(i, "t", "en", f"host{i % 40}") for i in range(200)])
    whole = M.build(docs, altered={"text": F.when(F.col("doc_id") == 17, F.lit("T")).otherwise(F.col("text"))})
    bad = M.verify(M.proofs(whole)).filter("not verified").collect()
    assert [r.doc_id for r in bad] == [17] and bad[0].folded_root == M.build(
        docs.withColumn("text", F.when(F.col("doc_id") == 17, F.lit("T")).otherwise(F.col("text")))).root().first()[0]


def test_empty(spark, make_docs, as_tables):
    assert M.op11_manifest(spark, as_tables(documents=make_docs([]))).count() == 0
