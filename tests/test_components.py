import random

import pytest

from newsloom.operators import components as C
from newsloom.operators.components import components


def brute(links):
    parent = {}

    def find(x):
        while parent.setdefault(x, x) != x:
            x = parent[x]
        return x

    for a, b in links:
        if a is not None and b is not None and find(a) != find(b):
            parent[max(find(a), find(b))] = min(find(a), find(b))
    return {(x, find(x)) for x in parent if find(x) != x}


@pytest.mark.parametrize("local", [0, C.LOCAL_LINKS])
def test_against_union_find(spark, monkeypatch, local):
    monkeypatch.setattr(C, "LOCAL_LINKS", local)
    rng = random.Random(1)
    links = [(rng.randrange(300), rng.randrange(300)) for _ in range(170)] + [(i, i + 1) for i in range(1000, 1040)] + [(5000, 5000 + i) for i in range(200)] + [(7, 7), (None, 3)]
    df = spark.createDataFrame(links, "u long, v long")
    assert {(r.u, r.root) for r in components(df).collect()} == brute(links)


def test_empty(spark):
    assert components(spark.createDataFrame([], "u long, v long")).count() == 0
