import random

from tradewatch.llm.components import connected_components


def test_against_union_find(spark):
    random.seed(2)
    links = [(random.randrange(200), random.randrange(200)) for _ in range(120)]
    links += [(300 + i, 301 + i) for i in range(40)] + [(500, i) for i in range(501, 540)] + [(None, 1), (7, 7)]
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and a != b:
            a, b = find(a), find(b)
            parent[max(a, b)] = min(a, b)
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(links, "u long, v long")).collect()}
    assert got == {x: find(x) for x in parent}


def test_no_links(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
