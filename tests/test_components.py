import random

from specweave.operators.components import connected_components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    return {x: find(x) for x in root}


def test_components_against_union_find(spark):
    rng = random.Random(5)
    edges = [(f"n{rng.randint(0, 300):03d}", f"n{rng.randint(0, 300):03d}") for _ in range(220)]
    edges += [(f"p{i * 7 % 151:03d}", f"p{(i + 1) * 7 % 151:03d}") for i in range(150)] + [("hub", f"h{i:03d}") for i in range(200)] + [("n001", "n001"), (None, "n002")]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src string, dst string")).collect()}
    plain = [(a, b) for a, b in edges if a and a != b]
    assert got == brute(plain)
    hot = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "src string, dst string"), hot_degree=20).collect()}
    assert hot == got
    assert connected_components(spark.createDataFrame([], "src string, dst string")).count() == 0
