"""Toxicity scores: gradient-boosted trees over dense features, calibrated.

1. A lexicon is learned from labelled training texts: words that stand in far
   more toxic than other texts (documents counted, not occurrences).
2. Every text gets dense features: lexicon densities, lexicon words close to a
   second-person word, capitals, punctuation and obfuscation rates.  A word
   also counts as a lexicon word with its disguise undone (``1d1ot``).
3. MLlib fits gradient-boosted trees on part of the training rows, and an
   isotonic regression turns their raw scores into probabilities on the rest.

The learned parts come from at most ``max_labelled`` labelled rows, those with
the smallest hash of their id: a documented bound on what is fitted, not on
what is scored.  Every row is scored, over its whole text.

Defined cases: null text is empty and is scored by its features (all 0);
labels that are null or not 0/1 are left out, and so are labels of absent
documents; several labels of one document count as the largest; with labels of
one class or none, each score is that class's share (0 without labels); rows
with equal doc_id are scored each; columns other than doc_id and text are not
read.
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.ml.classification import GBTClassifier
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.functions import vector_to_array
from pyspark.ml.regression import IsotonicRegression
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, materialise

MAX_LABELLED = 20_000
#: Second-person words of the four languages of the corpus (fixed list).
SECOND_PERSON = frozenset(
    "you your yours yourself u ur du dich dir dein deine deinen ihr euch euer sie ihnen "
    "tu te toi ton ta tes vous votre vos tú ti usted ustedes vosotros su sus".split())
#: Characters that stand for letters in disguised words (fixed table).
LEET = str.maketrans({"0": "o", "1": "i", "3": "e", "4": "a", "5": "s", "7": "t", "@": "a", "$": "s", "!": "i", "*": None,
                      "-": None, "_": None, ".": None, "+": "t", "|": "l"})
EDGES = ".,;:!?\"'()[]{}…«»“”"
NEAR = 3
FEATURES = ["log_words", "lex_hits", "lex_density", "lex_distinct", "lex_weight", "lex_max", "disguised_hits", "near_you",
            "near_you_density", "you_density", "capital_rate", "caps_word_rate", "exclaim_rate", "question_rate",
            "punct_rate", "obfuscation_rate", "stretch_rate", "digit_rate"]
_OBFUSCATED = re.compile(r"[^\W\d_][^\w\s][^\W\d_]|[^\W\d_]\d+[^\W\d_]")
_STRETCH = re.compile(r"([^\W\d_])\1\1")


def plain_word(w: str) -> str:
    return w.strip(EDGES).lower()


def undisguised(w: str) -> str:
    return w.strip(EDGES).lower().translate(LEET)


def features(text: str, lexicon: dict[str, float]) -> list[float]:
    """The values of FEATURES for one text."""
    words = text.split()
    n = max(1, len(words))
    size = max(1, len(text))
    plain = [plain_word(w) for w in words]
    hits: list[tuple[int, str]] = []
    disguised = obfuscated = stretched = caps = 0
    you = {i for i, w in enumerate(plain) if w in SECOND_PERSON}
    for i, w in enumerate(plain):
        if w in lexicon:
            hits.append((i, w))
        elif not w.isalpha():
            if _OBFUSCATED.search(w):
                obfuscated += 1
            u = undisguised(words[i])
            if u != w and u in lexicon:
                hits.append((i, u))
                disguised += 1
    if _STRETCH.search(text):
        stretched = sum(1 for w in words if _STRETCH.search(w))
    upper = sum(1 for c in text if c.isupper()) if not text.islower() else 0
    if upper:
        caps = sum(1 for w in words if len(w) > 1 and w.isupper())
    near = sum(1 for i, _ in hits if any(i + d in you for d in range(-NEAR, NEAR + 1)))
    weights = [lexicon[w] for _, w in hits]
    marks = {c: text.count(c) for c in "!?.,;:\"'"}
    return [math.log1p(len(words)), float(len(hits)), len(hits) / n, float(len({w for _, w in hits})), sum(weights),
            max(weights, default=0.0), float(disguised), float(near), near / n, len(you) / n, upper / size, caps / n,
            marks["!"] / n, marks["?"] / n, sum(marks.values()) / size, obfuscated / n, stretched / n,
            sum(text.count(d) for d in "0123456789") / size]


def _word_documents(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(word, toxic documents, other documents) of each batch."""
    for batch in batches:
        counts = (Counter(), Counter())
        for text, label in zip(batch.column("text").to_pylist(), batch.column("label").to_pylist(), strict=True):
            counts[int(label)].update({plain_word(w) for w in (text or "").split()} - {""})
        words = list(counts[0].keys() | counts[1].keys())
        yield pa.record_batch([pa.array(words, pa.string()), pa.array([counts[1][w] for w in words], pa.int64()),
                               pa.array([counts[0][w] for w in words], pa.int64())], names=["word", "toxic", "other"])


def learn_lexicon(labelled: DataFrame, size: int = 300, min_toxic: int = 4, min_z: float = 4.0) -> dict[str, float]:
    """Words with the highest z-score of their log odds, and the log odds."""
    rows = labelled.groupBy().agg(F.sum("label").alias("t"), F.count(F.lit(1)).alias("n")).first()
    toxic, other = float(rows.t or 0), float((rows.n or 0) - (rows.t or 0))
    if not toxic or not other:
        return {}
    counts = (labelled.select("text", "label").mapInArrow(_word_documents, "word string, toxic long, other long")
              .groupBy("word").agg(F.sum("toxic").alias("a"), F.sum("other").alias("b")).where(F.col("a") >= min_toxic))
    odds = F.ln((F.col("a") + 0.5) / (toxic - F.col("a") + 0.5)) - F.ln((F.col("b") + 0.5) / (other - F.col("b") + 0.5))
    spread = F.sqrt(1 / (F.col("a") + 0.5) + 1 / (F.col("b") + 0.5))
    best = (counts.select("word", odds.alias("odds"), (odds / spread).alias("z")).where(F.col("z") >= min_z)
            .orderBy(F.desc("z"), "word").limit(size).collect())
    return {r.word: float(r.odds) for r in best}


def add_features(docs: DataFrame, lexicon: dict[str, float], keep: list[str]) -> DataFrame:
    """The columns ``keep`` and FEATURES; the text itself is not carried on."""
    kept = [f for f in docs.schema if f.name in keep]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [features(t or "", lexicon) for t in batch.column("text").to_pylist()]
            cols = [batch.column(f.name) for f in kept]
            cols += [pa.array([r[k] for r in rows], pa.float64()) for k in range(len(FEATURES))]
            yield pa.record_batch(cols, names=[*(f.name for f in kept), *FEATURES])

    schema = ", ".join([f"`{f.name}` {f.dataType.simpleString()}" for f in kept] + [f"{x} double" for x in FEATURES])
    return docs.select(*[f.name for f in kept], "text").mapInArrow(run, schema)


class ToxicityModel:
    """Lexicon, trees and calibration; ``trees`` None scores ``prior``."""

    def __init__(self, lexicon: dict[str, float], trees=None, isotonic=None, prior: float = 0.0):
        self.lexicon, self.trees, self.isotonic, self.prior = lexicon, trees, isotonic, prior

    def _raw(self, featured: DataFrame) -> DataFrame:
        v = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(featured)
        v = self.trees.setPredictionCol("gbt_prediction").setRawPredictionCol("gbt_raw").setProbabilityCol("gbt_p").transform(v)
        return v.withColumn("raw", vector_to_array("gbt_p")[1])

    def score(self, docs: DataFrame, keep: list[str]) -> DataFrame:
        featured = add_features(docs, self.lexicon, keep)
        if self.trees is None:
            return featured.select(*keep, F.lit(float(self.prior)).alias("score"))
        raw = self._raw(featured)
        if self.isotonic is None:
            return raw.select(*keep, F.col("raw").alias("score"))
        # The calibration's steps are a short sorted list (as many as distinct
        # pooled values), so it is applied by the fitted model itself.
        out = self.isotonic.setFeaturesCol("raw").setPredictionCol("score").transform(raw)
        return out.select(*keep, F.least(F.greatest(F.col("score"), F.lit(0.0)), F.lit(1.0)).alias("score"))


def fit(docs: DataFrame, labels: DataFrame, training: Column, max_labelled: int = MAX_LABELLED,
        iterations: int = 30, depth: int = 3, seed: int = 5) -> ToxicityModel:
    """Fit on labelled rows for which ``training`` (over doc_id) holds.

    Three quarters of them (by hash of the id) train lexicon and trees, one
    quarter the calibration.
    """
    known = (labels.select(F.col("doc_id").alias("id"), F.col("toxic").cast("int").alias("toxic"))
             .where(F.col("id").isNotNull() & F.col("toxic").isin(0, 1)).groupBy("id").agg(F.max("toxic").alias("label")))
    chosen = (known.withColumnRenamed("id", "doc_id").where(training)
              .orderBy(F.xxhash64("doc_id", F.lit(seed)), "doc_id").limit(max_labelled))
    # At most max_labelled rows of two numbers: a proven bound for the broadcast.
    sample = materialise(docs.select("doc_id", "text").join(F.broadcast(chosen), "doc_id")
                         .withColumn("part", F.pmod(F.xxhash64("doc_id", F.lit(seed + 1)), F.lit(4))), "toxic-sample")
    share = sample.groupBy("label").count().collect()
    n = {r["label"]: r["count"] for r in share}
    prior = n.get(1, 0) / max(1, sum(n.values()))
    to_fit, to_calibrate = sample.where("part > 0"), sample.where("part = 0")
    if {r.label for r in to_fit.select("label").distinct().collect()} != {0, 1}:
        return ToxicityModel({}, prior=prior)
    lexicon = learn_lexicon(to_fit)
    table = materialise(add_features(sample, lexicon, ["label", "part"]), "toxic-features")
    v = VectorAssembler(inputCols=FEATURES, outputCol="features").transform(table.where("part > 0"))
    trees = GBTClassifier(featuresCol="features", labelCol="label", maxIter=iterations, maxDepth=depth, stepSize=0.2,
                          minInstancesPerNode=5, seed=seed, maxBins=32).fit(v.coalesce(1))
    model = ToxicityModel(lexicon, trees, None, prior)
    held = model._raw(table.where("part = 0")).select("raw", F.col("label").cast("double").alias("label"))
    if to_calibrate.select("label").distinct().count() == 2:
        model.isotonic = IsotonicRegression(featuresCol="raw", labelCol="label").fit(held)
    return model


def toxicity(docs: DataFrame, labels: DataFrame, threshold: float = 0.7, max_labelled: int = MAX_LABELLED) -> DataFrame:
    """doc_id, held_out, score, predicted; ids with remainder 1 train nothing."""
    held_out = crc_mod("doc_id", 3) == 1
    model = fit(docs, labels, ~held_out, max_labelled)
    scored = model.score(docs.select("doc_id", "text"), ["doc_id"])
    return scored.select("doc_id", held_out.alias("held_out"), "score", (F.col("score") >= threshold).cast("int").alias("predicted"))
