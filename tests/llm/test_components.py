import random

from tessera.llm.components import components


def brute(edges):
    parent = {}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x
    for a, b in edges:
        parent.setdefault(a, a), parent.setdefault(b, b)
        a, b = find(a), find(b)
        parent[max(a, b)] = min(a, b)
    return {(x, find(x)) for x in parent if find(x) != x}


def test_matches_union_find(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(150), rng.randrange(150)) for _ in range(110)]
    edges += [(200 + i, 201 + i) for i in range(40)]  # a path
    edges += [(300, 301 + i) for i in range(50)] + [(5, 5)]  # a star, a loop
    got, _ = components(spark.createDataFrame(edges, "u long, v long"))
    assert {tuple(r) for r in got.collect()} == brute(edges)


def test_no_edges(spark):
    got, _ = components(spark.createDataFrame([], "u long, v long"))
    assert got.collect() == []
