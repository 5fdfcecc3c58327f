from __future__ import annotations

import random

from llm.components import connected_components
from llm.simhash import Union


def test_against_union_find(spark):
    random.seed(0)
    edges = [(random.randrange(300), random.randrange(300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(400, 460)] + [(500, i) for i in range(501, 700)] + [(7, 7)]
    sets = Union(800)
    for a, b in edges:
        sets.join(a, [b])
    least = {}
    for x in sorted({x for e in edges if e[0] != e[1] for x in e}):
        least.setdefault(sets.find(x), x)
    expected = {x: least[sets.find(x)] for e in edges if e[0] != e[1] for x in e}
    df = spark.createDataFrame([*edges, (None, 3)], "src long, dst long")
    got = connected_components(df).collect()
    assert len(got) == len(expected)
    assert {r.node: r.component for r in got} == expected


def test_strings_and_no_edges(spark):
    df = spark.createDataFrame([("b", "a"), ("b", "c")], "src string, dst string")
    assert {r.node: r.component for r in connected_components(df).collect()} == {"a": "a", "b": "a", "c": "a"}
    assert connected_components(df.limit(0)).count() == 0
