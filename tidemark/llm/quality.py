"""Quality rules by distribution divergence from language references.

A reference is a pair of histograms of all texts of a language: character
classes, and the language's common words (every word whose share of the
language's words is ``min_share`` or more, and one bin for the rest).  A
document is rejected if the Jensen-Shannon distance of either of its
histograms from its language's reference is above a bound.  Short documents
have no stable histogram: below ``min_chars`` word characters the character
test passes, below ``min_words`` words the word test passes.

Common words are found exactly without counting every distinct word: batches
of rows report the words with half of ``min_share`` of their own words.  What
they leave out of a word's count is less than half of ``min_share`` of all
words, so a common word still sums to that half at least.  A second pass
counts just these candidates, at most ``2 / min_share`` a language.  A reference has at most ``1 / min_share`` words, and only
languages with ``min_lang_share`` of all words have one of their own (so there
are at most ``1 / min_lang_share``); the other rows share the reference of the
pooled rest.  That bounds what is broadcast whatever the input's size.

Defined cases: null text is empty text, without words, which fails the base
rule; null lang is a language of its own; an empty table gives no rows;
repeated rows are judged each for itself; extra columns are not read.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import lower_ascii, map_arrow, materialise, text_bytes, widened

SYMBOLS = b"#*$%&|<>"
SPACE = b" \t\n\x0b\x0c\r"
#: Character classes by UTF-8 byte: 0 space, 1 lower, 2 upper, 3 digit,
#: 4 sentence mark, 5 symbol, 6 other ASCII, 7 first byte of a longer
#: character, 8 (not counted) its further bytes.
CLASSES = np.full(256, 6, np.int64)
for _k, _set in ((1, b"abcdefghijklmnopqrstuvwxyz"), (2, b"ABCDEFGHIJKLMNOPQRSTUVWXYZ"), (3, b"0123456789"),
                 (4, b".,;:'\"-()?"), (5, SYMBOLS), (0, SPACE)):
    CLASSES[list(_set)] = _k
CLASSES[0x80:0xC0] = 8
CLASSES[0xC0:] = 7
N_CLASSES = 8
WINDOW = 5


@dataclass(frozen=True)
class QualityConfig:
    min_share: float = 0.002
    min_lang_share: float = 0.001
    min_words: int = 40
    min_chars: int = 200
    max_char_distance: float = 0.3
    max_word_distance: float = 0.45


def class_histogram(b: bytes) -> np.ndarray:
    by_byte = np.bincount(np.frombuffer(b, np.uint8), minlength=256)
    return np.bincount(CLASSES, by_byte, 9)[:N_CLASSES].astype(np.int64)


def js_distance(p: np.ndarray, q: np.ndarray) -> float:
    """Jensen-Shannon distance (base 2) of two count vectors, 0 to 1."""
    if not p.sum() or not q.sum():
        return 0.0
    p, q = p / p.sum(), q / q.sum()
    m = (p + q) / 2
    with np.errstate(divide="ignore", invalid="ignore"):
        d = np.where(p > 0, p * np.log2(p / m), 0).sum() + np.where(q > 0, q * np.log2(q / m), 0).sum()
    return float(np.sqrt(max(d, 0.0) / 2))


def repeat_words(words: list[bytes]) -> int:
    """Words inside 5-word windows that occur twice or more in the text."""
    n = len(words)
    if n <= WINDOW:
        return 0
    ids = np.fromiter(map(hash, words), np.int64, n).astype(np.uint64)
    h = np.zeros(n - WINDOW + 1, np.uint64)
    with np.errstate(over="ignore"):
        for k in range(WINDOW):
            h = h * np.uint64(0x9E3779B97F4A7C15) + (ids[k:n - WINDOW + 1 + k] ^ (ids[k:n - WINDOW + 1 + k] >> np.uint64(29)))
    order = np.argsort(h, kind="stable")
    same = h[order][1:] == h[order][:-1]
    if not same.any():
        return 0
    twice = np.zeros(len(h), bool)
    twice[order[1:][same]] = True
    twice[order[:-1][same]] = True
    edge = np.zeros(n + 1, np.int64)
    at = np.flatnonzero(twice)
    np.add.at(edge, at, 1)
    np.add.at(edge, at + WINDOW, -1)
    return int((np.cumsum(edge)[:n] > 0).sum())


def dup_lines(b: bytes) -> int:
    """Lines with a word that equal an earlier line."""
    if b"\n" not in b:
        return 0
    lines = [x for x in b.split(b"\n") if x.strip(SPACE)]
    return len(lines) - len(set(lines))


def _languages(batch: pa.RecordBatch) -> Iterator[tuple[str | None, bytes]]:
    yield from zip(batch.column("lang").to_pylist(), text_bytes(batch.column("text")), strict=True)


def _candidates(min_share: float):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            words: dict[str | None, Counter] = {}
            for lang, b in _languages(batch):
                words.setdefault(lang, Counter()).update(lower_ascii(b).split())
            rows = []
            for lang, c in words.items():
                total = c.total()
                rows.append((lang, None, total))
                rows += [(lang, w, n) for w, n in c.items() if 2 * n >= min_share * total]
            yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                                   pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])
    return run


def _counts(common: dict[str | None, set[bytes]], pooled: set[bytes]):
    """Exact counts of the candidates and of the character classes, per task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words: dict[str | None, Counter] = {}
        chars: dict[str | None, np.ndarray] = {}
        for batch in batches:
            for lang, b in _languages(batch):
                key = lang if lang in common else POOLED
                keep = common.get(key, pooled)
                c = words.setdefault(key, Counter())
                c.update(w for w in lower_ascii(b).split() if w in keep)
                chars[key] = chars.get(key, 0) + class_histogram(b)
        rows = [(k, w, n) for k, c in words.items() for w, n in c.items()]
        rows += [(k, b"\n%d" % i, int(n)) for k, h in chars.items() for i, n in enumerate(h)]
        yield pa.record_batch([pa.array([r[0] for r in rows], pa.string()), pa.array([r[1] for r in rows], pa.binary()),
                               pa.array([r[2] for r in rows], pa.int64())], names=["lang", "word", "n"])
    return run


#: Key of the pooled rest; a newline keeps it apart from language codes.
POOLED = "\npooled"


def language_references(docs: DataFrame, cfg: QualityConfig = QualityConfig()) -> dict:
    """{lang: (class counts, {word: share}, total words)} for all large languages."""
    rows = docs.select("lang", "text")
    schema = "lang string, word binary, n long"
    found = (rows.mapInArrow(_candidates(cfg.min_share), schema)
             .groupBy("lang", "word").agg(F.sum("n").alias("n")))
    found = materialise(found, "quality-words")
    totals = found.where("word is null")
    everything = totals.agg(F.sum("n")).first()[0] or 0
    large = {r.lang: r.n for r in totals.where(F.col("n") >= cfg.min_lang_share * everything).collect()}
    is_large = F.col("lang").isin([x for x in large if x is not None]) | (F.col("lang").isNull() & F.lit(None in large))
    common: dict = {x: set() for x in large}
    sized = F.broadcast(totals.withColumnsRenamed({"lang": "of", "n": "total"}).select("of", "total"))
    near = (found.where("word is not null").where(F.coalesce(is_large, F.lit(False)))
            .join(sized.where(F.col("total") >= cfg.min_lang_share * everything), F.col("lang").eqNullSafe(F.col("of")))
            .where(2 * F.col("n") >= cfg.min_share * F.col("total")))
    for r in near.collect():
        common[r.lang].add(bytes(r.word))
    pooled = {w for s in common.values() for w in s}
    exact = rows.mapInArrow(_counts(common, pooled), schema).groupBy("lang", "word").agg(F.sum("n").alias("n")).collect()
    refs: dict = {}
    for r in exact:
        chars, words = refs.setdefault(r.lang, (np.zeros(N_CLASSES, np.int64), {}))
        w = bytes(r.word)
        if w[:1] == b"\n":
            chars[int(w[1:])] += r.n
        else:
            words[w] = r.n
    rest = max(1, everything - sum(large.values()))
    return {k: (chars, {w: n / large.get(k, rest) for w, n in sorted(words.items()) if n >= cfg.min_share * large.get(k, rest)})
            for k, (chars, words) in refs.items()}


def word_distance(words: list[bytes], shares: dict[bytes, float]) -> float:
    """Distance of the common-word histogram (one bin for all other words)."""
    c = Counter(w for w in words if w in shares)
    ref = np.array([*shares.values(), max(0.0, 1 - sum(shares.values()))])
    own = np.array([*(c[w] for w in shares), len(words) - c.total()], float)
    return js_distance(own, ref)


SCHEMA = ("n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
          "base_failed boolean, kept boolean, char_distance double, word_distance double")
_DTYPES = [pa.int64()] * 5 + [pa.bool_()] * 2 + [pa.float64()] * 2


def measure(b: bytes, ref: tuple | None, cfg: QualityConfig) -> tuple:
    """The columns of SCHEMA for one text; ``ref`` None passes both tests."""
    words = b.split()
    n = len(words)
    chars = class_histogram(b)
    word_chars = int(chars[1:].sum())
    n_symbols = int(chars[5])
    repeated = repeat_words(words)
    failed = n < 10 or 100 * repeated > 20 * n
    dc = js_distance(chars, ref[0]) if ref and word_chars >= cfg.min_chars else 0.0
    dw = word_distance(lower_ascii(b).split(), ref[1]) if ref and n >= cfg.min_words else 0.0
    kept = not failed and dc <= cfg.max_char_distance and dw <= cfg.max_word_distance
    return n, word_chars, n_symbols, dup_lines(b), repeated, failed, kept, dc, dw


def quality_rules(docs: DataFrame, cfg: QualityConfig = QualityConfig(), refs: dict | None = None) -> DataFrame:
    """All columns of ``docs`` and the columns of SCHEMA, which replace any of
    the same name.  Rows are judged in place: nothing is shuffled."""
    refs = language_references(docs, cfg) if refs is None else refs
    names = [x.split()[0] for x in SCHEMA.split(", ")]
    kept_cols = [c for c in docs.columns if c.lower() not in names]
    shared = docs.sparkSession.sparkContext.broadcast(refs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = [measure(b, shared.value.get(lang, shared.value.get(POOLED)), cfg) for lang, b in _languages(batch)]
            cols = [batch.column(c) for c in kept_cols]
            cols += [pa.array([r[k] for r in rows], t) for k, t in enumerate(_DTYPES)]
            yield pa.record_batch(cols, names=[*kept_cols, *names])

    return map_arrow(docs, run, widened([f for f in docs.schema if f.name in kept_cols], SCHEMA))

