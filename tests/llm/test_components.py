import random

from tillcast.llm.components import components


def brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a is not None and b is not None:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def test_components(spark):
    rnd = random.Random(4)
    path = list(range(1000, 1100))
    rnd.shuffle(path)
    edges = list(zip(path, path[1:], strict=False)) + [(rnd.randrange(300), rnd.randrange(300)) for _ in range(150)]
    edges += [(5000, 5000 + i) for i in range(50)] + [(7, 7), (None, 3), (9000, 9000), (-4, 9001), (-4, 9001)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.component for r in got} == brute(edges) and len(got) == len(brute(edges))
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
