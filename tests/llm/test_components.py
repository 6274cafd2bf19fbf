"""Connected components against union-find."""

import random

import pytest

from bandwise.llm.components import components


def brute(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a != b:
            p, q = find(a), find(b)
            root[max(p, q)] = min(p, q)
    return {x: find(x) for x in root}


@pytest.mark.parametrize("kind", ["path", "star", "random", "loops"])
def test_components(spark, kind):
    rng = random.Random(3)
    edges = {
        "path": [(i, i + 1) for i in range(60)],
        "star": [(5, i) for i in range(80)] + [(200, i) for i in range(100, 140)],
        "random": [(rng.randint(0, 120), rng.randint(0, 120)) for _ in range(90)],
        "loops": [(1, 1), (2, 3), (3, 2), (2, 3)],
    }[kind]
    rng.shuffle(edges)
    rows = components(spark.createDataFrame([*edges, (None, 4), (4, None)], "a long, b long")).collect()
    assert len(rows) == len({r.node for r in rows})
    assert {r.node: r.component for r in rows} == brute(edges)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
