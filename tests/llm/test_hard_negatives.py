import math
import random

import numpy as np
import pytest
from pyspark.sql import functions as F

from tidemark.llm.hard_negatives import Batch, Tree, hard_negatives, pack, search, unpack

SCHEMA = "id long, label int, vec array<float>, qid long, positives string, block int"


def frame(spark, data):
    return spark.createDataFrame([(*r, 5, "p", 6) for r in data], SCHEMA)


def usable(v):
    return v is not None and all(x is not None and math.isfinite(x) for x in v)


def dot(a, b):
    return sum(x * y for x, y in zip(a, b, strict=False))


def brute(data, every=5, n_pos=5, n_neg=10):
    rows = [(i, lab, [math.floor(256 * float(np.float32(x))) for x in v]) for i, lab, v in data if lab is not None and usable(v)]
    last = math.inf
    out = []
    for a, (i, lab, v) in enumerate(rows):
        if i is None or i % every:
            continue
        scored = sorted(((-dot(v, w), last if j is None else j, k, m) for m, (j, k, w) in enumerate(rows) if m != a), key=lambda r: r[:2])
        for ps, j, _, _ in [r for r in scored if r[2] == lab][:n_pos]:
            wins = [r for r in scored if r[2] != lab and 30 * -ps <= 100 * -r[0] <= 90 * -ps][:n_neg]
            out += [(i, None if j == last else j, k + 1, None if r[1] == last else r[1], -ps, -r[0]) for k, r in enumerate(wins)]
    return sorted(out, key=str)


def vectors(n=300, d=8, seed=4, spread=0.6):
    rng = random.Random(seed)
    centres = [[rng.gauss(0, 0.3) for _ in range(d)] for _ in range(6)]
    out = []
    for k in range(n):
        c = rng.randrange(6)
        out.append((k, rng.choice([c % 3, c % 3, rng.randrange(4)]), [x + rng.gauss(0, 0.1 * spread) for x in centres[c]]))
    return out


def edge_rows(base):
    v = base[0][2]
    return base + [(1000, 1, None), (1005, None, v), (1010, 1, [0.1, None] + v[2:]), (1015, 1, [float("nan")] + v[1:]),
                   (1020, 2, [float("inf")] + v[1:]), (1025, 2, []), (1030, 1, v[:3]), (None, 1, v), (None, 2, v), (1035, 1, v + [9.0]),
                   (1040, 0, [0.0] * len(v)), (1045, 3, [-x for x in v]), *[base[5]] * 3, *[(2000 + k, 0, v) for k in range(60)],
                   *[(3000 + k, 1, v) for k in range(40)]]


@pytest.mark.parametrize("block_rows", [10_000, 40])
def test_equal_to_brute_force(spark, block_rows):
    data = edge_rows(vectors())
    got = hard_negatives(frame(spark, data).repartition(4), F.expr("id % 5 = 0"), block_rows=block_rows)
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)


def test_small_blocks_by_bytes_and_other_sizes(spark):
    data = vectors(200, 5, 9)
    got = hard_negatives(frame(spark, data), F.expr("id % 5 = 0"), n_positives=2, n_negatives=3, block_bytes=1500)
    assert sorted(map(tuple, got.collect()), key=str) == brute(data, n_pos=2, n_neg=3)


def test_scores_beyond_53_bits(spark):
    data = [(k, k % 2, [x * 1e7 for x in v]) for k, _, v in vectors(40, 3, 2)]
    got = hard_negatives(frame(spark, data), F.expr("id % 5 = 0"))
    assert sorted(map(tuple, got.collect()), key=str) == brute(data)


def test_empty_table_and_no_anchor(spark):
    assert hard_negatives(frame(spark, []), F.expr("id % 5 = 0")).count() == 0
    assert hard_negatives(frame(spark, [(1, 0, [1.0]), (2, 1, [1.0])]), F.expr("id % 5 = 0")).count() == 0
    assert hard_negatives(frame(spark, [(5, 0, [1.0]), (6, 1, [1.0])]), F.expr("id % 5 = 0")).count() == 0


def test_tree_covers_bounds_and_prunes():
    rng = np.random.default_rng(3)
    centres = rng.normal(size=(12, 6)) * 400
    x = np.floor(np.repeat(centres, 300, 0) + rng.normal(size=(3600, 6)) * 12)
    labels = rng.integers(0, 3, 3600)
    tree = Tree(x, labels)
    assert sorted(tree.order.tolist()) == list(range(3600))
    q = np.floor(rng.normal(size=(20, 6)) * 300)
    batch = Batch(tree, q)
    low, high = batch.low, batch.high
    for node, (a, b, kids) in enumerate(zip(tree.begin, tree.end, tree.children, strict=True)):
        s = q @ x[tree.order[a:b]].T
        assert (s.min(1) >= low[:, node]).all() and (s.max(1) <= high[:, node]).all()
        if kids:
            spans = sorted((tree.begin[c], tree.end[c]) for c in kids)
            assert spans[0][0] == a and spans[-1][1] == b and all(p[1] == n[0] for p, n in zip(spans, spans[1:], strict=False))
            assert all(tree.cover[c] <= tree.cover[node] * 2 for c in kids)
    ids = [[int(r)] for r in tree.order]
    opened = 0

    class Counted(Batch):
        def scores(self, leaf, k):
            nonlocal opened
            opened += tree.end[leaf] - tree.begin[leaf]
            return super().scores(leaf, k)

    for k in range(20):
        roots = [r for lab, r in tree.roots.items() if lab != 1]
        got = search(Counted(tree, q), k, ids, roots, [(-10**9, 10**9)], 7)[0]
        s = (x @ q[k]).astype(int)
        want = sorted((-int(s[r]), r) for r in range(3600) if labels[r] != 1)[:7]
        assert [(-a, b) for a, b in got] == want
    assert opened < 20 * 2400 * 0.6  # most leaves of clustered vectors are skipped


def test_pack_round_trip():
    for v in ([], [1.0, -3.0], [40000.0, -70000.0], [2.0**40, 1e30]):
        assert unpack(pack(np.array(v))).tolist() == v
