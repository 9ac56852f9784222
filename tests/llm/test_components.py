import random

import pytest

from tickforge.llm.common import components


def brute(edges, nodes):
    root = {x: x for x in nodes}

    def top(x):
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        p, q = top(a), top(b)
        root[max(p, q)] = min(p, q)
    return {x: top(x) for x in nodes}


@pytest.mark.parametrize("kind", ["chain", "star", "random", "none", "loops"])
def test_components(spark, kind):
    rng = random.Random(3)
    nodes = rng.sample(range(1000), 120)
    edges = {"chain": list(zip(nodes, nodes[1:60])), "star": [(nodes[7], x) for x in nodes[8:100]],
             "random": [tuple(rng.sample(nodes, 2)) for _ in range(90)] * 2, "none": [], "loops": [(x, x) for x in nodes[:5]]}[kind]
    got = components(spark.createDataFrame(edges, "a long, b long"), spark.createDataFrame([(x,) for x in nodes], "id long"))
    rows = got.collect()
    assert {r.id: r.root for r in rows} == brute(edges, nodes) and len(rows) == len(nodes)
