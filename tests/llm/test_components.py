import random

import numpy as np
import pytest

from tidemark.llm.components import connected_components, forest


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for u, v in edges:
        a, b = find(u), find(v)
        parent[max(a, b)] = min(a, b)
    return {x: find(x) for e in edges for x in e if e[0] != e[1]}


def graphs():
    rng = random.Random(1)
    yield [(k, k + 1) for k in range(300)]  # a long path
    yield [(0, k) for k in range(1, 500)] + [(600, 601), (601, 600), (700, 700)]  # a star, a pair, a loop
    yield [(rng.randrange(400), rng.randrange(400)) for _ in range(260)]
    yield [(-(2**63), 2**63 - 1), (5, -(2**63)), (7, 7)]
    order = list(range(1000, 1200))
    rng.shuffle(order)
    yield list(zip(order, order[1:], strict=False))  # a path in random order


@pytest.mark.parametrize("k", range(5))
def test_equal_to_union_find(spark, k):
    edges = list(graphs())[k]
    got = connected_components(spark.createDataFrame(edges, "u long, v long").repartition(4))
    rows = [tuple(r) for r in got.collect()]
    assert len(rows) == len(set(rows)) and dict(rows) == brute(edges)
    u, v = (np.array(c, np.int64) for c in zip(*edges, strict=True))
    child, root = forest(u, v)
    assert dict(zip(child.tolist(), root.tolist(), strict=True)) == {a: b for a, b in brute(edges).items() if a != b}


def test_no_edges(spark):
    assert connected_components(spark.createDataFrame([], "u long, v long")).count() == 0
    assert connected_components(spark.createDataFrame([(3, 3)], "u long, v long")).count() == 0


def test_few_edges_settle_in_fewer_rounds(spark, monkeypatch):
    from tidemark.llm import components

    assert [components.partitions_for(e, 200) for e in (0, 1, components.DEALT * 3, 10**12)] == [2, 2, 3, 200] and components.partitions_for(9, 1) == 1
    spark.conf.set("spark.sql.shuffle.partitions", "12")
    order = list(range(400))
    random.Random(8).shuffle(order)
    edges, rounds, real = list(zip(order, order[1:], strict=False)), [], components.written
    monkeypatch.setattr(components, "written", lambda *x: rounds.append(1) or real(*x))
    took = []
    for dealt in (1, 1 << 17):
        monkeypatch.setattr(components, "DEALT", dealt)
        rounds.clear()
        got = connected_components(spark.createDataFrame(edges, "u long, v long"))
        assert dict(tuple(r) for r in got.collect()) == dict.fromkeys(order, 0)
        took.append(len(rounds))
    assert took[1] < took[0]
