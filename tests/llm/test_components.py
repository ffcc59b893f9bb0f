"""Components by contraction against union-find."""

import random

from eddy.llm.components import components
from eddy.llm.scratch import Scratch


def _brute(edges):
    up = {}

    def find(x):
        while up.setdefault(x, x) != x:
            x = up[x]
        return x

    for a, b in edges:
        if a != b:
            x, y = find(a), find(b)
            up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def test_equals_union_find(spark):
    """Random edges, a path, a hub, chains and loops side by side, and loops alone."""
    r = random.Random(3)
    edges = [(r.randrange(-60, 60), r.randrange(60)) for _ in range(70)]
    edges += [(1000 + i, 1001 + i) for i in range(120)]
    edges += [(2500, 2000 + i) for i in range(200)] + [(2000 + i, 2500) for i in range(50)]
    edges += [(3000 + i, 3001 + i) for i in r.sample(range(80), 60)] + [(5000, 5000), (7, 7)]
    r.shuffle(edges)
    rows = components(spark.createDataFrame(edges, "u long, v long"), Scratch(spark, "t")).collect()
    got = {x.node: x.root for x in rows}
    groups = lambda d: sorted(sorted(n for n in d if d[n] == c) for c in set(d.values()))
    assert len(rows) == len(got) and all(root in got for root in got.values())
    assert groups(got) == groups(_brute(edges))
    assert components(spark.createDataFrame([(3, 3)], "u long, v long"), Scratch(spark, "t")).isEmpty()
