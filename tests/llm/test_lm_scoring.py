import math
import random
import zlib
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import lm_scoring as lm
from tidemark.llm.ef_trie import EliasFano, Trie


def test_elias_fano():
    rng = np.random.default_rng(2)
    for n, top in ((1, 5), (50, 60), (300, 10**6), (1000, 2**40), (64, 64)):
        v = np.sort(rng.integers(0, top, n))
        e = EliasFano.encode(v)
        assert (e.get(np.arange(n)) == v).all() and (e.decode() == v).all()


def table():
    rng = random.Random(4)
    bi = sorted({(rng.randint(0, 30), rng.randint(0, 30)) for _ in range(200)})
    tri = sorted({(a, b, c) for a, b in bi for x, c in bi if x == b and rng.random() < 0.3})
    return bi, tri


@pytest.mark.parametrize("queries", [3, 4000])
def test_trie_lookups(tmp_path, queries):
    bi, tri = table()
    p = {g: -1 - 0.001 * k for k, g in enumerate(bi)} | {g: -2 - 0.001 * k for k, g in enumerate(tri)}
    grams = [(lm.pack(np.array(x)), np.array([p[g] for g in x])) for x in (bi, tri)]
    t = Trie.build(31, grams, [np.full(31, -0.5), np.full(len(bi), -0.25)])
    path = tmp_path / "trie"
    path.write_bytes(t.to_bytes())
    for own in (t, Trie.from_buffer(t.to_bytes()), Trie.open(str(path))):
        rng = random.Random(9)
        words = np.array([rng.choice([-1, *range(31)]) for _ in range(queries)])
        place = np.arange(queries) % 50
        got = own.log10_p(words, np.full(queries, -5.0), place)
        for i in range(queries):
            w = words.tolist()
            want = None
            if place[i] >= 2 and tuple(w[i - 2:i + 1]) in p:
                want = p[tuple(w[i - 2:i + 1])]
            else:
                back = -0.25 if place[i] >= 2 and tuple(w[i - 2:i]) in p else 0
                if place[i] >= 1 and tuple(w[i - 1:i + 1]) in p:
                    want = p[tuple(w[i - 1:i + 1])] + back
                else:
                    want = -5 + back + (-0.5 if place[i] >= 1 and w[i - 1] >= 0 else 0)
            assert got[i] == pytest.approx(want, abs=0.02)


def corpus():
    rng = random.Random(12)
    def text():
        # Mostly each word calls for the next, so that context tells something.
        at, out = rng.randint(0, 39), []
        for _ in range(rng.randint(0, 30)):
            at = (at + 1) % 40 if rng.random() < 0.8 else rng.randint(0, 39)
            out.append(f"w{at}")
        return " ".join(out)

    rows = [(k, text()) for k in range(120)]
    return rows + [(200, None), (201, ""), (202, "A a B unknown-word"), (203, rows[0][1]), (203, rows[0][1]), (None, "w1 w2")]


def test_scores(spark, make_docs):
    rows = corpus()
    train = [(t or "").encode().lower().split() for i, t in rows if zlib.crc32(str(i if i is not None else "").encode()) % 5 != 1]
    c = Counter(w for t in train for w in [*t, b"\n"])
    n, v = c.total(), len(c)
    bi = Counter(g for t in train for s in [[b"\n", *t, b"\n"]] for g in zip(s, s[1:]))
    tri = Counter(g for t in train for s in [[b"\n", *t, b"\n"]] for g in zip(s, s[1:], s[2:]))
    d = lm.DISCOUNT

    def p(w, ctx):
        if not ctx:
            return (c[w] - d) / n if c[w] else d * v / n
        grams = tri if len(ctx) == 2 else bi
        total = c[ctx[0]] if len(ctx) == 1 else bi[ctx]
        lower = p(w, ctx[1:])
        if not total:
            return lower
        kept = [x for g, x in grams.items() if g[:-1] == ctx]
        own = grams[(*ctx, w)]
        return (max(own - d, 0) if own else 0) / total + (1 - sum(x - d for x in kept) / total) * lower

    out = lm.lm_scores(make_docs([(i, t, "s") for i, t in rows], "held_out")).collect()
    assert len(out) == len(rows)
    by_id = {}
    for r in out:
        by_id.setdefault(r.doc_id, []).append(r)
    for i, t in rows:
        w = [*(t or "").encode().lower().split(), b"\n"]
        s = [b"\n", *w]
        base = sum(math.log10((c[x] + 0.5) / (n + 0.5 * (v + 1))) for x in w)
        score = sum(math.log10(p(s[k], tuple(s[max(0, k - 2):k]))) for k in range(1, len(s)))
        for r in by_id[i]:
            assert (r.n_tokens, r.n_known, r.train_tokens) == (len(w), sum(c[x] > 0 for x in w), n)
            assert r.base_score == pytest.approx(base) and r.score == pytest.approx(score, rel=0.03, abs=0.05)
            assert r.held_out == (zlib.crc32(str(i if i is not None else "").encode()) % 5 == 1)
    held = [r for r in out if r.held_out]
    assert held and sum(r.score for r in held) > sum(r.base_score for r in held)


def test_empty_and_untrained(make_docs):
    from pyspark.sql import functions as F
    assert lm.lm_scores(make_docs([])).count() == 0
    out = lm.lm_scores(make_docs([(1, "a b", "s")]), held_out=F.lit(True)).collect()
    assert [(r.n_tokens, r.n_known, r.train_tokens, r.score) for r in out] == [(3, 0, 0, 0.0)]


def test_rare_ngrams_count_in_a_large_corpus(spark):
    # Over 1M tokens; most trigrams occur once or twice.
    rng = np.random.default_rng(8)
    texts = [" ".join(f"w{k}" for k in (3000 * rng.random(520) ** 3).astype(int)) for _ in range(2100)]
    texts += [texts[k][:1500] + " novel words" for k in range(0, 200, 2)]
    held = [k >= 2050 for k in range(len(texts))]
    train = [t.split() for t, h in zip(texts, held, strict=True) if not h]
    grams = [Counter(tuple(s[k:k + n]) for t in train for s in [["", *t, ""]] for k in range(len(s) - n + 1)) for n in (2, 3)]
    c = Counter(w for t in train for w in [*t, ""])
    n, v, d = c.total(), len(c), lm.DISCOUNT
    assert n > 1_000_000
    followers = [Counter(g[:-1] for g in own) for own in grams]
    context = [Counter(), Counter()]
    for k, own in enumerate(grams):
        for g, x in own.items():
            context[k][g[:-1]] += x

    def p(ctx, w):
        if not ctx:
            return (c[w] - d) / n if c[w] else d * v / n
        own, total = grams[len(ctx) - 1][(*ctx, w)], context[len(ctx) - 1][ctx]
        return (max(own - d, 0) + d * followers[len(ctx) - 1][ctx] * p(ctx[1:], w)) / total if total else p(ctx[1:], w)

    from pyspark.sql import functions as F
    docs = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    out = {r.doc_id: r.score for r in lm.lm_scores(docs, held_out=F.col("doc_id") >= 2050).collect()}
    for k in range(0, len(texts), 10):
        s = ["", *texts[k].split(), ""]
        assert out[k] == pytest.approx(sum(math.log10(p(tuple(s[max(0, i - 2):i]), s[i])) for i in range(1, len(s))), rel=0.005)


def test_texts_are_shuffled_once(spark, make_docs):
    out = lm.lm_scores(make_docs([(k, f"a b{k}", "s") for k in range(20)]))
    assert len(out.collect()) == 20
    plan = out._jdf.queryExecution().executedPlan().toString()
    # Both steps over whole chunks read one shuffle of them.
    assert "ReusedExchange" in plan
