import random

import numpy as np
import pytest

from tidemark.llm import near_dup as nd


def components(rows, per_cent, k=5):
    """Groups by comparing all pairs of texts."""
    sets = []
    for _, t in rows:
        w = (t or "").encode().lower().split()
        sets.append({tuple(w[i:i + k]) for i in range(len(w) - k + 1)} or ({tuple(w)} if w else set()))
    parent = list(range(len(rows)))

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a in range(len(rows)):
        for b in range(a):
            if sets[a] and sets[b] and 100 * len(sets[a] & sets[b]) >= per_cent * len(sets[a] | sets[b]):
                parent[find(a)] = find(b)
    small = {}
    for a, (i, _) in enumerate(rows):
        if i is not None:
            small[find(a)] = min(i, small.get(find(a), i))
    return sorted(((i, len(sets[a]), small.get(find(a)) if sets[a] else i) for a, (i, _) in enumerate(rows)), key=str)


def fixture(n=90):
    rng = random.Random(11)
    word = lambda: f"w{rng.randint(0, 3000)}"
    base = [[word() for _ in range(rng.randint(30, 120))] for _ in range(4)]
    rows = []
    for k in range(n):
        own = list(rng.choice(base))
        for _ in range(rng.randint(0, 4)):
            own[rng.randrange(len(own))] = word()
        rows.append((k, " ".join(own)))
    return rows + [(500, None), (501, ""), (502, " \t"), (503, "A b"), (504, "a B"), (505, rows[0][1].upper()), (506, rows[0][1]),
                   (506, rows[0][1]), (None, rows[1][1]), (None, "only here"), (None, "only here")]


@pytest.mark.parametrize("per_cent,block", [(85, 512), (80, 4)])
def test_equals_all_pairs(spark, make_docs, monkeypatch, per_cent, block):
    monkeypatch.setattr(nd, "BLOCK", block)
    rows = fixture()
    got = nd.near_duplicates(make_docs([(i, t, "s") for i, t in rows], "node"), per_cent).collect()
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=str) == components(rows, per_cent)
    assert all(r.kept == (r.doc_id == r.component_id) for r in got)


def test_block_links_and_packing():
    rng = np.random.default_rng(1)
    sets = [np.unique(rng.integers(0, 60, 40).astype(np.uint64)) for _ in range(20)]
    links = nd.block_links(list(range(20)), list(range(20)), sets, 20, 40)
    def group(edges):
        parent = list(range(20))
        def find(x):
            return x if parent[x] == x else find(parent[x])
        for a, b in edges:
            parent[find(a)] = find(b)
        return [min(j for j in range(20) if find(j) == find(i)) for i in range(20)]
    want = [(a, b) for a in range(20) for b in range(a) if 100 * len(np.intersect1d(sets[a], sets[b])) >= 40 * len(np.union1d(sets[a], sets[b]))]
    assert group(links) == group(want) and len(links) <= 19
    x = np.array([0, 1, 2**48 - 1], np.uint64)
    assert (nd.unpack(x.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :nd.WIDTH].tobytes()) == x).all()


def test_empty_table(make_docs):
    assert nd.near_duplicates(make_docs([])).count() == 0


def test_a_worker_keeps_no_freed_memory_after_a_task():
    import re


    from tidemark.llm.common import giving_back

    def held():
        with open("/proc/self/smaps_rollup") as f:
            return int(re.search(r"Pss_Anon:\s+(\d+)", f.read()).group(1)) / 1024

    kept, taken = [], []

    def run(batches):
        for b in batches:
            parts = [np.full(2000, b, np.uint64) for _ in range(16_000)]
            kept.extend(parts[::100])  # so that the heap has holes only
            taken.append(held())
            yield b

    before = held()
    assert list(giving_back(run)(iter([1, 2]))) == [1, 2]
    assert max(taken) - before > 200 and held() - before < 60
