"""Components against union-find, over both kinds of join."""

import random

import pytest

from heliopanel.llm import components as C


@pytest.mark.parametrize("few", [0, 10_000])
def test_against_union_find(spark, monkeypatch, few):
    monkeypatch.setattr(C, "FEW_EDGES", few)
    r = random.Random(2)
    edges = [(i, i + 1) for i in range(0, 60)] + [(1000, 1000 + i) for i in range(1, 80)] \
        + [(r.randint(2000, 2100), r.randint(2000, 2100)) for _ in range(60)] + [(5, 5), (3001, 3000), (3000, 3001)]
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x
    for u, v in edges:
        if u != v:
            a, b = find(u), find(v)
            root[max(a, b)] = min(a, b)
    got = C.connected_components(spark.createDataFrame(edges, "u long, v long")).collect()
    assert {(g["node"], g["component"]) for g in got} == {(x, find(x)) for x in root} and len(got) == len(root)


def test_no_edges(spark):
    assert C.connected_components(spark.createDataFrame([(1, 1)], "u long, v long")).count() == 0
