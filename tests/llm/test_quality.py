import math
import random
import re
from collections import Counter

import numpy as np
import pytest

from tidemark.llm import quality as q

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def base(text):
    """The base measures, spelled out."""
    text = text or ""
    words = WORD.findall(text)
    grams = Counter(tuple(words[k:k + 5]) for k in range(len(words) - 4))
    inside = set()
    for k in range(len(words) - 4):
        if grams[tuple(words[k:k + 5])] > 1:
            inside.update(range(k, k + 5))
    seen, dup = set(), 0
    for line in text.split("\n"):
        if WORD.search(line):
            dup += line in seen
            seen.add(line)
    n, rep = len(words), len(inside)
    return n, sum(map(len, words)), sum(text.count(c) for c in "#*$%&|<>"), dup, rep, n < 10 or 100 * rep > 20 * n


TEXTS = [None, "", " \n\t ", "one", "a b c d e a b c d e", "a b c d e x a b c d e", "l\nl\n\nl \nl", "é ñ # $ <|> x y",
         "a " * 30, "über die große Straße\r\nüber die", "w\x0bv\x0cu"]


def test_base_measures(spark):
    rng = random.Random(4)
    texts = TEXTS + [" ".join(rng.choice("abc") for _ in range(rng.randint(1, 40))) for _ in range(60)]
    docs = spark.createDataFrame([(k, t, None if k % 3 else "en", 5) for k, t in enumerate(texts)], "doc_id long, text string, lang string, kept int")
    out = {r.doc_id: r for r in q.quality_rules(docs).collect()}
    assert len(out) == len(texts)
    for k, t in enumerate(texts):
        r = out[k]
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words, r.base_failed) == base(t), repr(t)
        assert not (r.base_failed and r.kept)


def test_distance():
    p, r = np.array([3, 1, 0]), np.array([1, 1, 2])
    a, b = p / p.sum(), r / r.sum()
    m = (a + b) / 2
    kl = lambda x: sum(u * math.log2(u / v) for u, v in zip(x, m) if u)
    assert q.js_distance(p, r) == pytest.approx(math.sqrt((kl(a) + kl(b)) / 2))
    assert q.js_distance(p, p) == 0 and q.js_distance(np.array([1, 0]), np.array([0, 1])) == 1


def test_references_hold_all_common_words(spark):
    rng = random.Random(8)
    rows = [(k, " ".join(rng.choice(["the", "of", "and"] + [f"w{i}" for i in range(300)]) for _ in range(80)), rng.choice(["en", "de", None]))
            for k in range(60)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(7)
    cfg = q.QualityConfig(min_share=0.006)
    refs = q.language_references(docs, cfg)
    for lang in ("en", "de", None):
        c = Counter(w for _, t, la in rows if la == lang for w in t.split())
        want = {w.encode(): n / c.total() for w, n in c.items() if n >= cfg.min_share * c.total()}
        assert refs[lang][1] == pytest.approx(want)
        chars = sum(q.class_histogram(t.encode()) for _, t, la in rows if la == lang)
        assert (refs[lang][0] == chars).all()


def test_junk_goes_and_clean_stays(spark):
    rng = random.Random(2)
    common = ["the", "of", "and", "to", "in", "is"]
    clean = lambda: " ".join(rng.choice(common) if rng.random() < 0.5 else "".join(rng.choice("etaoinsh") for _ in range(6)) for _ in range(120))
    rows = [(k, clean(), "en") for k in range(60)]
    rows += [(100, " ".join(w.upper() + "!!" for w in clean().split()), "en"), (101, " ".join(w + "***" for w in clean().split()), "en"),
             (102, "short but fine text of ten words is kept here ok", "en")]
    out = {r.doc_id: r.kept for r in q.quality_rules(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()}
    assert all(out[k] for k in range(60)) and not out[100] and not out[101] and out[102]


def test_empty_table(spark):
    empty = spark.createDataFrame([], "doc_id long, text string, lang string")
    assert q.quality_rules(empty).count() == 0


def _classes(text):
    """Character classes of a text, character by character."""
    out = [0] * 8
    for c in text:
        if ord(c) > 127:
            k = 7
        elif c in " \t\n\x0b\x0c\r":
            k = 0
        elif c.islower():
            k = 1
        elif c.isupper():
            k = 2
        elif c.isdigit():
            k = 3
        elif c in ".,;:'\"-()?":
            k = 4
        else:
            k = 5 if c in "#*$%&|<>" else 6
        out[k] += 1
    return out


def _distance(a, b):
    if not sum(a) or not sum(b):
        return 0.0
    a, b = [x / sum(a) for x in a], [x / sum(b) for x in b]
    half = lambda p, r: sum(x * math.log2(2 * x / (x + y)) for x, y in zip(p, r) if x) / 2
    return math.sqrt(max(0.0, half(a, b) + half(b, a)))


def _verdicts(rows, cfg):
    """doc_id -> (kept, character distance, word distance) in plain Python over all texts."""
    lower = lambda t: [re.sub("[A-Z]", lambda m: m[0].lower(), w) for w in WORD.findall(t or "")]
    n_words = Counter()
    for _, t, lang in rows:
        n_words[lang] += len(lower(t))
    everything = sum(n_words.values())
    large = {lang for lang, n in n_words.items() if n >= cfg.min_lang_share * everything}
    group = lambda lang: (lang,) if lang in large else "rest"
    chars, counts = {}, {}
    for _, t, lang in rows:
        chars[group(lang)] = [a + b for a, b in zip(chars.get(group(lang), [0] * 8), _classes(t or ""))]
        counts.setdefault(group(lang), Counter()).update(lower(t))
    share = {g: {w: n / c.total() for w, n in c.items() if n >= cfg.min_share * c.total()} for g, c in counts.items()}
    common = {w for g, s in share.items() if g != "rest" for w in s}
    if "rest" in share:  # languages too small for a reference of their own are told by the common words of the others
        share["rest"] = {w: s for w, s in share["rest"].items() if w in common}
    out = {}
    for i, t, lang in rows:
        words, ref = lower(t), share[group(lang)]
        own = [words.count(w) for w in ref]
        dc = _distance(_classes(t or ""), chars[group(lang)]) if base(t)[1] >= cfg.min_chars else 0.0
        dw = _distance([*own, len(words) - sum(own)], [*ref.values(), max(0.0, 1 - sum(ref.values()))]) if len(words) >= cfg.min_words else 0.0
        out[i] = (not base(t)[5] and dc <= cfg.max_char_distance and dw <= cfg.max_word_distance, dc, dw)
    return out


def test_verdicts_against_plain_python(spark):
    rng = random.Random(12)
    rows = []
    for k in range(160):
        lang = rng.choice(["en"] * 6 + ["de"] * 5 + [None] * 3 + ["xx", "yy"])
        some = [f"{lang}{i}" for i in range(8)] if rng.random() < 0.8 else ["Zq#", "9%", "<é>"]
        words = [rng.choice(some) if rng.random() < rng.choice([0.2, 0.9]) else f"r{rng.randint(0, 4000)}" for _ in range(rng.randint(0, 140))]
        rows.append((k, None if k % 40 == 0 else " ".join(words), lang))
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string").repartition(5)
    cfg = q.QualityConfig(min_share=0.01, min_lang_share=0.1)
    want = _verdicts(rows, cfg)
    out = {r.doc_id: r for r in q.quality_rules(docs, cfg).collect()}
    for i, (kept, dc, dw) in want.items():
        assert (out[i].char_distance, out[i].word_distance) == pytest.approx((dc, dw), abs=1e-9), rows[i]
        assert out[i].kept == kept, rows[i]
    assert 20 < sum(k for k, _, _ in want.values()) < 140
