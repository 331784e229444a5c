import random

from tidemark.llm.components import connected_components


def roots(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {x: find(x) for x in up}


def found(spark, edges):
    df = spark.createDataFrame(edges, "a long, b long")
    return {r["node"]: r["root"] for r in connected_components(df).collect()}


def test_random_graphs_chain_and_hub(lspark):
    rng = random.Random(3)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)]
    edges += [(i, i + 1) for i in range(1000, 1060)]  # a chain
    edges += [(5000 + i, 4999) for i in range(400)]  # a hub
    edges += [(7000, 7000), (7001, 7002), (7002, 7001)]  # a loop, both directions
    assert found(lspark, edges) == roots(edges)


def test_empty_and_null_ends(lspark):
    assert found(lspark, []) == {}
    assert found(lspark, [(None, 3), (4, None)]) == {}
