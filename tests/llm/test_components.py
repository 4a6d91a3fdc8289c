"""Connected components against union-find."""

import random

import pytest

from erascore.llm.common import connected_components


def union_find(edges):
    up = {}

    def top(x):
        up.setdefault(x, x)
        while up[x] != x:
            up[x] = up[up[x]]
            x = up[x]
        return x

    for a, b in edges:
        a, b = top(a), top(b)
        up[max(a, b)] = min(a, b)
    return {x: top(x) for x in up}


@pytest.mark.parametrize("edges", [
    [(i, i + 1) for i in range(40)],
    [(0, i) for i in range(1, 60)],
    [(random.Random(5).randrange(90), 91)] + [(random.Random(i).randrange(90), random.Random(i + 999).randrange(90)) for i in range(60)],
    [(1, 1), (2, 3), (3, 2), (2, 3)],
])
def test_against_union_find(spark, edges):
    got = {r["node"]: r["label"] for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == union_find(edges)


def test_nulls_and_no_edges(spark):
    frame = spark.createDataFrame([(1, None), (None, None)], "a long, b long")
    assert connected_components(frame).collect() == []
    assert connected_components(frame.limit(0)).collect() == []
