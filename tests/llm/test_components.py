import random

import pytest

from coverlay.llm.components import components


def plain(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in root}


@pytest.mark.parametrize("name", ["random", "chain", "star", "odd"])
def test_against_union_find(spark, name):
    rng = random.Random(name)
    edges = {
        "random": [(rng.randrange(-200, 200), rng.randrange(-200, 200)) for _ in range(180)],
        "chain": [(i, i + 1) for i in rng.sample(range(150), 150)],
        "star": [(7, i) for i in range(300)] + [(i, 300) for i in range(5)],
        "odd": [(1, 1), (2, 3), (3, 2), (2, 3), (None, 4), (5, None), (None, None)],
    }[name]
    got = components(spark.createDataFrame(edges, "x long, y long"))
    assert {tuple(r) for r in got.collect()} == plain(edges)


def test_empty(spark):
    assert components(spark.createDataFrame([], "x long, y long")).count() == 0
