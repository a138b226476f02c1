import math
import random

import pytest

from tidemark.llm import toxicity as tx


def corpus(n=700):
    rng = random.Random(3)
    bad = ["slur", "vile", "scum"]
    rows, labels = [], []
    for k in range(n):
        words = [f"w{rng.randint(0, 60)}" for _ in range(rng.randint(5, 30))]
        toxic = int(rng.random() < 0.2)
        if toxic:
            for _ in range(2):
                w = rng.choice(bad)
                words.insert(rng.randint(0, len(words)), "you " + (w if rng.random() < 0.8 else w.upper() + "!"))
        rows.append((k, " ".join(words)))
        labels.append((k, toxic))
    return rows, labels


def test_held_out_accuracy_and_edge_rows(spark, make_docs):
    rows, labels = corpus()
    extra = [(5000, None), (5001, ""), (None, "slur"), (5002, "you vile scum slur vile"), (5002, "you vile scum slur vile")]
    lab = spark.createDataFrame([*labels, (5000, None), (1, labels[1][1]), (9999, 1), (None, 1)], "doc_id long, toxic int")
    out = tx.toxicity(make_docs([(i, t, "s") for i, t in rows + extra], "score"), lab).collect()
    assert len(out) == len(rows) + len(extra)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.7) for r in out)
    truth = dict(labels)
    held = [(r.predicted, truth[r.doc_id]) for r in out if r.held_out and r.doc_id in truth]
    assert len(held) > 150 and sum(a == b for a, b in held) >= 0.95 * len(held)
    assert all(r.predicted == 1 for r in out if r.doc_id == 5002)


def test_one_class_and_no_labels(spark, make_docs):
    docs = make_docs([(k, "a b c", "s") for k in range(9)])
    one = spark.createDataFrame([(k, 0) for k in range(9)], "doc_id long, toxic int")
    assert {r.score for r in tx.toxicity(docs, one).collect()} == {0.0}
    assert {r.score for r in tx.toxicity(docs, one.limit(0)).collect()} == {0.0}
    assert tx.toxicity(docs.limit(0), one).count() == 0


def test_features():
    names = tx.FEATURES
    f = dict(zip(names, tx.features("You are an IDIOT!! 1d10t soooo i-d-i-o-t", {"idiot": 2.0})))
    assert f["lex_hits"] == 3 and f["disguised_hits"] == 2 and f["lex_distinct"] == 1 and f["near_you"] >= 1
    assert tx.features("", {}) == [0.0] * len(names)


def _plain_features(text, lexicon):
    """The features restated position by position."""
    words = text.split()
    strip = [w.strip(tx.EDGES).lower() for w in words]
    letters = {"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "+": "t", "|": "l",
               "*": "", "-": "", "_": "", ".": ""}
    found, disguised = [], 0
    for i, w in enumerate(strip):
        u = "".join(letters.get(c, c) for c in w)
        if w in lexicon:
            found.append((i, w))
        elif u != w and u in lexicon:
            found.append((i, u))
            disguised += 1
    letter = lambda c: c.isalpha()

    def hidden(w):
        for a in range(len(w)):
            for b in range(a + 2, len(w)):
                inner = w[a + 1:b]
                one = len(inner) == 1 and not (inner.isalnum() or inner == "_")
                if letter(w[a]) and letter(w[b]) and (one or inner.isdigit()):
                    return True
        return False

    you = [i for i, w in enumerate(strip) if w in tx.SECOND_PERSON]
    near = sum(any(abs(i - j) <= tx.NEAR for j in you) for i, _ in found)
    n, size = max(1, len(words)), max(1, len(text))
    stretched = sum(any(letter(w[i]) and w[i] == w[i + 1] == w[i + 2] for i in range(len(w) - 2)) for w in words)
    return {"log_words": math.log(1 + len(words)), "lex_hits": len(found), "lex_density": len(found) / n,
            "lex_distinct": len({w for _, w in found}), "lex_weight": sum(lexicon[w] for _, w in found),
            "lex_max": max([lexicon[w] for _, w in found], default=0), "disguised_hits": disguised, "near_you": near,
            "near_you_density": near / n, "you_density": len(you) / n, "capital_rate": sum(c.isupper() for c in text) / size,
            "caps_word_rate": sum(len(w) > 1 and w.isupper() for w in words) / n, "exclaim_rate": text.count("!") / n,
            "question_rate": text.count("?") / n, "punct_rate": sum(c in "!?.,;:\"'" for c in text) / size,
            "obfuscation_rate": sum(w not in lexicon and hidden(w) for w in strip) / n, "stretch_rate": stretched / n,
            "digit_rate": sum(c in "0123456789" for c in text) / size}


def test_features_against_plain_python():
    rng = random.Random(21)
    lexicon = {"idiot": 2.0, "scum": 1.5, "vil": 0.5}
    pool = ["you", "YOU,", "du", "idiot", "IDIOT!!", "1d10t", "i-d-i-o-t", "sc*um", "$cum", "v|l", "soooo", "a1b", "x__y", "ok.", "Über", "é!é",
            "7", "1999", "don't", "A", "ABC", "(scum)", "?!", "«vil»"]
    for _ in range(400):
        text = "".join(rng.choice(pool) + rng.choice([" ", "  ", "\n", "\t"]) for _ in range(rng.randint(0, 25)))
        assert dict(zip(tx.FEATURES, tx.features(text, lexicon))) == pytest.approx(_plain_features(text, lexicon)), text
