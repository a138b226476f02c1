import random
import re
from collections import Counter
from fractions import Fraction

import duckdb
import pytest

from tidemark.llm import oracles
from tidemark.llm.divergence import audit, stripes, terms_of

SCHEMA = "doc_id long, text string, lang string, source string, term int, value string, item long"
TERM = re.compile("[^\x00-\x40\x5b-\x60\x7b-\x7f]+")


def frame(spark, data):
    return spark.createDataFrame([(k, *r, 1, "v", 2) for k, r in enumerate(data)], SCHEMA)


def lower(text):
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)


def brute(data, min_docs, top):
    docs = [((r[1] or ""), (r[2] or ""), TERM.findall(lower(r[0] or ""))) for r in data]
    df = Counter((lang, t) for lang, _, ts in docs for t in set(ts))
    out = []
    for lang in {d[0] for d in docs}:
        kept = [t for (k, t), n in df.items() if k == lang and n >= min_docs]
        groups = {s: Counter() for k, s, _ in docs if k == lang}
        for k, s, ts in docs:
            if k == lang:
                groups[s].update(t for t in ts if t in set(kept))

        def p(c, kept=kept):
            n = sum(c.values()) + 2 * len(kept)
            return {t: 1 + int(Fraction(10**9 * (c[t] + 2), n)) for t in kept}

        share = {s: p(c) for s, c in groups.items()}
        whole = p(sum(groups.values(), Counter()))

        def f(a, b):
            return (a - b) ** 2 // (a + b)

        for s in groups:
            parts = {"pair": [(o, sum(f(share[s][t], share[o][t]) for t in kept)) for o in groups if o != s],
                     "term": [(t, f(share[s][t], whole[t])) for t in kept if groups[s][t] and share[s][t] > whole[t]]}
            for part, items in parts.items():
                items.sort(key=lambda x: (-x[1], x[0].encode()))
                out += [(lang, s, part, i, v, k + 1) for k, (i, v) in enumerate(items) if part == "pair" or k < top]
    return sorted(out)


def data(n=300, seed=5):
    rng = random.Random(seed)
    words = [f"w{chr(97 + k)}{chr(97 + j)}" for k in range(12) for j in range(6)] + ["É", "é", "ß", "字", "\U0001f600", "İ"]
    out = []
    for _ in range(n):
        lang = rng.choice(["en"] * 6 + ["fr", "de", None])
        source = rng.choice(["a"] * 5 + ["b", "c", "d", None, "é"])
        text = " ".join(rng.choice(words[:40] if source == "a" else words).upper() if rng.random() < 0.2 else rng.choice(words)
                        for _ in range(rng.randint(0, 40)))
        out.append((text, lang, source))
    out += [out[0]] * 3 + [(None, "en", "never"), ("", None, None), ("12 34 -", "xx", "only"), ("alone", "yy", "p"), ("alone", "yy", "q")]
    return out + [("The-THE_the`the{the@ÀÉ\tz", "en", "a"), ("wa " * 30000, "en", "long")]


@pytest.mark.parametrize("table,block,sums", [(400_000, 20_000, 2_000_000), (50, 5, 4)])
def test_equal_to_brute_force(spark, table, block, sums):
    rows = data()
    got = audit(frame(spark, rows), min_docs=4, top=5, table=table, block_terms=block, sums=sums).collect()
    assert sorted(map(tuple, got)) == brute(rows, 4, 5)


def test_equal_to_sql(spark):
    rows = data(500, 8)
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (text VARCHAR, lang VARCHAR, source VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?, ?)", rows)
    got = audit(frame(spark, rows).repartition(5))
    assert sorted(map(tuple, got.select("lang", "source", "part", "item", "value", "rank").collect())) == sorted(con.execute(oracles.OP12).fetchall())


def test_one_stripe_per_term(spark):
    rows = [("same word", "en", f"s{k % 7}") for k in range(400)] + [("rare", "en", "s0")]
    got = {r.term: r for r in stripes(frame(spark, rows).repartition(6), min_docs=2, table=3).collect()}
    assert set(got) == {"same", "word"}
    assert got["word"].df == 400 and sum(got["word"].counts) == 400 and sorted(got["word"].sources) == [f"s{k}" for k in range(7)]


def test_terms_and_empty_table(spark):
    assert [b.decode() for p in terms_of("Aa-B\x00b字x@é`Z".encode()) for b in p] == ["aa", "b", "b字x", "é", "z"]
    assert audit(frame(spark, [])).count() == 0
    assert [tuple(r) for r in audit(frame(spark, [(None, None, None), (None, None, "b")])).collect()] == [
        ("", "", "pair", "b", 0, 1), ("", "b", "pair", "", 0, 1)]
