"""Connected components against a union-find on small fixtures: random graphs, a long
path (many rounds), a hub holding a third of the edges, isolated pairs."""

import random

import pytest

from conftest import SF001
from eddy.operators.graph import connected_components
from eddy.sources import bindings as B


def _union_find(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for a, b in edges:
        ra, rb = find(a), find(b)
        if ra != rb:
            parent[max(ra, rb)] = min(ra, rb)
    return sorted((v, find(v)) for v in parent)


def _graphs():
    rnd = random.Random(7)
    yield "random", [(rnd.randrange(300), rnd.randrange(300)) for _ in range(250)]
    yield "path", [(i, i + 1) for i in range(0, 400)][::-1]
    hub = [(1000, i) for i in range(1, 300)] + [(rnd.randrange(1, 900), rnd.randrange(1, 900)) for _ in range(500)]
    yield "hub", hub
    yield "pairs_and_loops", [(2 * i, 2 * i + 1) for i in range(50)] + [(7, 7), (500, 500), (500, 501)]


@pytest.mark.parametrize("name,edges", list(_graphs()), ids=lambda x: x if isinstance(x, str) else "")
def test_components_equal_union_find(spark, name, edges):
    df = spark.createDataFrame(edges, "src bigint, dst bigint")
    got = sorted(tuple(r) for r in connected_components(df).collect())
    assert got == _union_find(edges)


def test_trade_graph_and_null_ends(spark):
    """The whole trade graph of the supplied tables; rows with a null end are ignored."""
    g = B.trade_graph(spark, SF001)
    edges = [tuple(r) for r in g.collect()]
    with_nulls = g.unionAll(spark.createDataFrame([(None, 5), (7, None)], "src bigint, dst bigint"))
    assert sorted(tuple(r) for r in connected_components(with_nulls).collect()) == _union_find(edges)
    assert connected_components(g.limit(0)).count() == 0
