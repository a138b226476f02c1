import hashlib
import random
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import suffix_dedup as sd

LENGTH = 24


def brute(rows, keep):
    """Removed bytes by comparing every string of LENGTH bytes with all others."""
    texts = [(t or "").encode() for _, t in rows]
    order = sorted(range(len(rows)), key=lambda k: (rows[k][0] is None, rows[k][0] or 0))
    count, first = Counter(), {}
    for k in order:
        b = texts[k]
        for p in range(len(b) - LENGTH + 1):
            count[b[p:p + LENGTH]] += 1
            first.setdefault(b[p:p + LENGTH], (k, p))
    out = []
    for k, b in enumerate(texts):
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - LENGTH + 1):
            s = b[p:p + LENGTH]
            if count[s] > 1 and (keep == "none" or first[s] != (k, p)):
                gone[p:p + LENGTH] = True
        kept = bytes(x for x, g in zip(b, gone) if not g)
        spans = int((np.diff(np.concatenate(([0], gone.astype(int)))) == 1).sum())
        out.append((rows[k][0], len(b), int(gone.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def fixture():
    rng = random.Random(3)
    word = lambda: "".join(rng.choice("abcdeé") for _ in range(rng.randint(1, 7)))
    text = lambda n: " ".join(word() for _ in range(n))
    passage = text(30)
    rows = [(k, f"{text(15)} {passage[:rng.randint(20, len(passage))]} {text(10)}") for k in range(12)]
    rows += [(12, passage), (13, passage), (14, "ab" * 90), (15, "x" * 23), (16, "y" * 24), (17, "y" * 25), (18, None), (19, "")]
    rows += [(20, text(9) + "\n" + "z" * 60 + text(5) + "z" * 50)]
    return rows


@pytest.mark.parametrize("keep", ["none", "first"])
@pytest.mark.parametrize("bucket", [150_000, 60, 0])
def test_against_brute_force(spark, make_docs, monkeypatch, keep, bucket):
    monkeypatch.setattr(sd, "BUCKET", bucket)   # small: buckets are parted, to the last level for 0
    monkeypatch.setattr(sd, "MAX_RUN", 16)
    rows = fixture()
    got = sd.remove_repeats(make_docs([(i, t, "s") for i, t in rows]), LENGTH, keep).collect()
    assert sorted([(r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got], key=str) == brute(rows, keep)
    for r in got:
        assert hashlib.sha256(bytes(r.kept)).hexdigest() == r.kept_sha256
        assert sum(s.hi - s.lo for s in r.spans) == r.n_removed


def test_equal_rows_are_places_of_their_own_and_empty_table(spark, make_docs):
    text = "q" * 10 + "abcdefghijklmnopqrstuvwxyz0123456789"
    got = sd.remove_repeats(make_docs([(None, text, None), (None, text, None), (1, "short", "s")]), LENGTH).collect()
    assert sorted((r.n_bytes, r.n_removed) for r in got) == [(5, 0), (46, 46), (46, 46)]
    assert sd.remove_repeats(make_docs([]), LENGTH).count() == 0


def test_longest_previous_factor():
    rng = random.Random(1)
    for _ in range(60):
        s = bytes(rng.choice(b"ab") for _ in range(rng.randint(1, 24)))
        order = sorted(range(len(s)), key=lambda i: s[i:])
        common = lambda i, j: next((k for k in range(len(s)) if s[i + k:i + k + 1] != s[j + k:j + k + 1] or i + k >= len(s)), 0)
        lcp = [0] + [common(a, b) for a, b in zip(order, order[1:])]
        got = sd.longest_previous_factor(order, lcp)
        for i, v in zip(order, got):
            assert v == max([common(i, j) for j in range(i)], default=0)
