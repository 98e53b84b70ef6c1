from __future__ import annotations

import random

import pytest

from wardline.llm.components import components


def union(edges):
    root: dict[int, int] = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = sorted((find(a), find(b)))
        root[b] = a
    return {x: find(x) for x in root}


CHAIN = list(range(300))
random.Random(1).shuffle(CHAIN)


@pytest.mark.parametrize(
    "edges",
    [
        [],
        [(5, 5)],
        list(zip(CHAIN, CHAIN[1:], strict=False)),
        [(0, i) for i in range(1, 200)] + [(500, 499), (499, 500)],
        [(random.Random(i).randrange(200), random.Random(-i).randrange(200)) for i in range(120)],
    ],
)
def test_components(spark, edges):
    found = components(spark.createDataFrame(edges, "a long, b long").repartition(4)).collect()
    wanted = union((a, b) for a, b in edges if a != b)
    assert len(found) == len(wanted)
    assert {r["node"]: r["component"] for r in found} == wanted
