import random

import pytest

from pressloom.operators.components import components
from pressloom.session import StepTables


@pytest.mark.parametrize("few", [0, 20, 10_000])
def test_components_of_paths_stars_and_loops(spark, few):
    rng = random.Random(5)
    edges = [(k, k + 1) for k in range(0, 60)] + [(1000, 1000 + k) for k in range(1, 50)] + [(7, 7), (2001, 2000), (2000, 2001)]
    edges += [(rng.randrange(3000, 3100), rng.randrange(3000, 3100)) for _ in range(60)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        parent[find(a)] = find(b)
    got = components(spark.createDataFrame(edges, "a long, b long"), StepTables(spark, "test"), few).collect()
    root = {r["node"]: r["root"] for r in got}
    nodes = {x for a, b in edges if a != b for x in (a, b)}
    assert len(got) == len(root) and set(root) == nodes
    assert all((root[x] == root[y]) == (find(x) == find(y)) for x in list(nodes)[:80] for y in nodes)
    assert components(spark.createDataFrame([], "a long, b long"), StepTables(spark, "test"), few).collect() == []
