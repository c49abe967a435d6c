import random

import pytest

from tablewright.llm.components import components


@pytest.mark.parametrize("seed", range(3))
def test_random_graphs(spark, seed):
    r = random.Random(seed)
    edges = [(r.randrange(200), r.randrange(200)) for _ in range(120)]
    edges += [(300 + i, 301 + i) for i in range(30)]  # a path
    edges += [(1000, 1001 + i) for i in range(40)]  # a star
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = {x["node"]: x["component"] for x in components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()}
    assert got == {x: find(x) for a, b in edges if a != b for x in (a, b)}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a bigint, b bigint")).count() == 0
