"""Source divergence audit with in-mapper stripes.

A term's *stripe* in a language is its document frequency and its count in
every source: ``term -> (documents, {source: count})``.  Each task folds whole
documents into a hash table of stripes; when the table is full it is spilled
as rows in key order, so a task holds a bounded table however large its
partition is.  Rows of one key come together in one shuffle and are merged as
they stream by.  A key has at most one row for every spill, whatever the
number of documents that hold it.  The merged stripes directly give the
divergences, block by block; no (term, source) pair is shuffled on its own.

Probabilities are smoothed: ``p = 1 + floor(10^9 (count + 2) / (N + 2 V))``
with ``N`` the group's tokens of kept terms and ``V`` the language's kept
terms.  The divergence of p and q at a term is ``floor((p-q)^2 / (p+q))``, in
whole numbers throughout.

A pair of sources is summed over all kept terms, also those that neither
source holds: ``V`` times the value at two zero counts, corrected at each term
that one of them holds.  So a stripe with k sources of S costs k * S, and a
task keeps a bounded table of partial sums, which it gives out when full.

Defined cases: null text, lang and source are empty strings; a group without
kept terms (or without words) has ``N = 0`` and takes part in all pairs; in a
language without kept terms every pair is 0; an empty table gives no rows;
repeated rows are documents of their own; other columns are not read.
"""

from __future__ import annotations

import heapq
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import default_partitions, join_small, materialise, text_bytes

#: Byte map of a term's bytes: A-Z to a-z, a-z and every byte of a longer
#: character as they are, all else a space.
_TERM = bytes(c + 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 128 else 32 for c in range(256))
SCALE = 1_000_000_000
#: Entries (term, source) that a task's table of stripes may hold before it is spilled.
TABLE = 400_000
#: Partial sums (source, source) that a task may hold.
SUMS = 2_000_000
#: Cells (term, source) of a dense slice of stripes.
CELLS = 200_000
#: Kept terms of a language in one block of the divergence step.
BLOCK_TERMS = 20_000
#: Bytes of a text that are cut into terms at once; a text is cut between terms.
PIECE = 1 << 22


def terms_of(text: bytes) -> Iterator[list[bytes]]:
    """A text's terms in order, in bounded lists."""
    at = 0
    while at < len(text):
        end = min(len(text), at + PIECE)
        while end < len(text) and _TERM[text[end]] != 32:
            end += 1
        yield text[at:end].translate(_TERM).split()
        at = end


class Stripes:
    """Hash table lang -> source -> (count of each term, documents of each term)."""

    def __init__(self, limit: int):
        self.limit, self.tables, self.entries = limit, {}, 0

    def add(self, lang: str, source: str, text: bytes) -> None:
        counts, documents = self.tables.setdefault(lang, {}).setdefault(source, (Counter(), Counter()))
        before = len(counts)
        seen: set[bytes] = set()
        for words in terms_of(text):
            counts.update(words)
            seen.update(words)
        documents.update(list(seen))
        self.entries += len(counts) - before

    def spill(self) -> Iterator[pa.RecordBatch]:
        """Stripes in order of (lang, term); the table is empty afterwards."""
        tables, self.tables, self.entries = self.tables, {}, 0
        for lang in sorted(tables):
            names = sorted(s for s, (counts, _) in tables[lang].items() if counts)
            if not names:
                continue
            held = [tables[lang][s] for s in names]
            # Terms are whole characters of valid UTF-8, so their bytes are text.
            terms = pa.array([t for counts, _ in held for t in counts], pa.binary()).dictionary_encode()
            source = np.repeat(np.arange(len(names)), [len(counts) for counts, _ in held])
            n = np.fromiter((v for counts, _ in held for v in counts.values()), np.int64, len(source))
            df = np.fromiter((docs[t] for counts, docs in held for t in counts), np.int64, len(source))
            order = pc.array_sort_indices(terms.dictionary).to_numpy()
            rank = np.empty(len(order), np.int64)
            rank[order] = np.arange(len(order))
            key = rank[terms.indices.to_numpy()]
            by = np.argsort(key, kind="stable")
            starts = np.searchsorted(key[by], np.arange(len(order)))
            yield from _batches(pa.array([lang] * len(order), pa.string()), terms.dictionary.take(pa.array(order)),
                                np.add.reduceat(df[by], starts), np.append(starts, len(by)),
                                pa.array(names, pa.string()).take(pa.array(source[by])), n[by])


STRIPE = "lang string, term string, df long, sources array<string>, counts array<long>"
NAMES = ["lang", "term", "df", "sources", "counts"]


def _batches(lang: pa.Array, term: pa.Array, df: np.ndarray, offsets: np.ndarray, sources: pa.Array, counts: np.ndarray,
             size: int = 50_000) -> Iterator[pa.RecordBatch]:
    """Stripe rows as batches of at most ``size`` rows."""
    at = pa.array(offsets, pa.int32())
    whole = pa.record_batch([lang, term.cast(pa.string()), pa.array(df, pa.int64()), pa.ListArray.from_arrays(at, sources),
                             pa.ListArray.from_arrays(at, pa.array(counts, pa.int64()))], names=NAMES)
    for k in range(0, len(df), size):
        yield whole.slice(k, size)


def _fold(limit: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = Stripes(limit)
        for batch in batches:
            for lang, source, text in zip(batch.column("lang").to_pylist(), batch.column("source").to_pylist(),
                                          text_bytes(batch.column("text")), strict=True):
                table.add(lang, source, text)
                if table.entries >= limit:
                    yield from table.spill()
        yield from table.spill()
    return run


def _flat(column: pa.ListArray) -> tuple[np.ndarray, pa.Array]:
    """Lengths and elements of a list column."""
    return column.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64), column.flatten()


def merge_stripes(b: pa.RecordBatch) -> pa.RecordBatch:
    """Neighbouring stripes of one key as one stripe."""
    lang, term = b.column("lang"), b.column("term")
    same = pc.and_(pc.equal(lang[1:], lang[:-1]), pc.equal(term[1:], term[:-1])).to_numpy(zero_copy_only=False)
    first = np.concatenate(([True], ~same))
    starts = np.flatnonzero(first)
    key = np.cumsum(first) - 1
    length, sources = _flat(b.column("sources"))
    _, counts = _flat(b.column("counts"))
    codes = sources.dictionary_encode()
    width = max(1, len(codes.dictionary))
    entry = np.repeat(key, length) * width + codes.indices.to_numpy()
    order = np.argsort(entry, kind="stable")
    entry = entry[order]
    head = np.flatnonzero(np.concatenate(([True], entry[1:] != entry[:-1])))
    total = np.add.reduceat(counts.to_numpy()[order], head)
    entry = entry[head]
    offsets = np.searchsorted(entry // width, np.arange(len(starts) + 1))
    take = pa.array(starts)
    return next(_batches(lang.take(take), term.take(take), np.add.reduceat(b.column("df").to_numpy(), starts), offsets,
                         codes.dictionary.take(pa.array(entry % width)), total, len(starts)))


def _merge(min_docs: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None  # the last key so far, which the next batch may go on with
        for b in batches:
            if not b.num_rows:
                continue
            rows = merge_stripes(b if held is None else pa.Table.from_batches([held, b.cast(held.schema)]).combine_chunks().to_batches()[0])
            held = rows.slice(rows.num_rows - 1)
            rows = rows.slice(0, rows.num_rows - 1)
            yield rows.filter(pc.greater_equal(rows.column("df"), min_docs))
        if held is not None:
            yield held.filter(pc.greater_equal(held.column("df"), min_docs))
    return run


def stripes(docs: DataFrame, min_docs: int = 10, table: int = TABLE) -> DataFrame:
    """Merged stripes of the terms in ``min_docs`` documents of their language or more."""
    rows = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source", "text")))
    spilled = rows.mapInArrow(_fold(table), STRIPE)
    dealt = spilled.repartition(default_partitions(docs.sparkSession), "lang", "term").sortWithinPartitions("lang", "term")
    return materialise(dealt.mapInArrow(_merge(min_docs), STRIPE), "audit-stripes")


def share(count: np.ndarray, total: np.ndarray, terms: int) -> np.ndarray:
    """``1 + floor(SCALE (count + 2) / (total + 2 terms))``, exact below 9e15 tokens."""
    below = np.asarray(total, np.int64) + 2 * terms
    rest, out = np.asarray(count, np.int64) + 2, 0
    for _ in range(3):  # three decimal digits at a time
        rest = rest * 1000
        out = out * 1000 + rest // below
        rest = rest % below
    return out + 1


def divergence(p: np.ndarray, q: np.ndarray) -> np.ndarray:
    return (p - q) * (p - q) // (p + q)


class _Language:
    """Groups of one language, and the sums that a task has gathered over its terms."""

    def __init__(self, lang: str, sources: list[str], totals: list[int], terms: int, top: int):
        self.lang, self.sources, self.terms, self.top = lang, sources, terms, top
        self.index = {s: k for k, s in enumerate(sources)}
        self.totals = np.array(totals, np.int64)
        self.all = int(self.totals.sum())
        self.zero = share(np.zeros(len(sources), np.int64), self.totals, terms)
        self.sums: dict[int, np.ndarray] = {}
        self.best: dict[int, list] = {}

    def take(self, terms: pa.Array, sources: pa.ListArray, numbers: pa.ListArray) -> None:
        """Add stripes."""
        n = len(self.sources)
        length, names = _flat(sources)
        codes = names.dictionary_encode()
        at = np.array([self.index[s] for s in codes.dictionary.to_pylist()], np.int64)[codes.indices.to_numpy()]
        row = np.repeat(np.arange(len(terms)), length)
        counts = np.zeros((len(terms), n), np.int64)
        counts[row, at] = _flat(numbers)[1].to_numpy()
        p = share(counts, self.totals, self.terms)
        whole = share(counts.sum(1), np.int64(self.all), self.terms)
        order = np.argsort(at, kind="stable")
        cuts = np.flatnonzero(np.diff(at[order])) + 1
        for part in np.split(order, cuts) if len(order) else ():
            a = int(at[part[0]])
            held = row[part]
            # A pair is counted at the smaller source that holds the term, or at the only one.
            gain = divergence(p[held, a][:, None], p[held]) - divergence(self.zero[a], self.zero)
            gain[(counts[held] > 0) & (np.arange(n) <= a)] = 0
            gain[:, a] = 0
            total = gain.sum(0)
            self.sums[a] = self.sums[a] + total if a in self.sums else total
            self._best_of(a, terms, held[p[held, a] > whole[held]], p[:, a], whole)

    def _best_of(self, a: int, terms: pa.Array, rows: np.ndarray, p: np.ndarray, whole: np.ndarray) -> None:
        value = divergence(p[rows], whole[rows])
        if len(value) > self.top:  # all ties of the last value stay
            most = value >= np.partition(value, -self.top)[-self.top]
            rows, value = rows[most], value[most]
        found = [(-int(v), t.encode(), t) for v, t in zip(value, terms.take(pa.array(rows, pa.int64())).to_pylist(), strict=True)]
        self.best[a] = heapq.nsmallest(self.top, self.best.get(a, []) + found)

    def drain(self) -> Iterator[tuple]:
        for a, row in self.sums.items():
            for b in np.flatnonzero(row):
                x, y = sorted((self.sources[a], self.sources[int(b)]))
                yield ("pair", x, y, int(row[b]))
        self.sums = {}
        for a, found in self.best.items():
            for v, _, term in found:
                yield ("term", self.sources[a], term, -v)
        self.best = {}


def _diverge(top: int, limit: int):
    names = ["lang", "part", "source", "item", "value"]

    def out(language: _Language) -> Iterator[pa.RecordBatch]:
        rows = [(language.lang, *r) for r in language.drain()]
        for k in range(0, len(rows), 50_000):
            yield pa.record_batch([pa.array(c, pa.int64() if n == "value" else pa.string())
                                   for n, c in zip(names, zip(*rows[k:k + 50_000], strict=True), strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        key, groups, now = None, [], None
        for b in batches:
            langs, blocks, kinds = (b.column(c).to_pylist() for c in ("lang", "block", "kind"))
            at = 0
            while at < b.num_rows:
                end = at + 1
                while end < b.num_rows and (langs[end], blocks[end], kinds[end]) == (langs[at], blocks[at], kinds[at]):
                    end += 1
                run_of = b.slice(at, end - at)
                if (langs[at], blocks[at]) != key:
                    if now is not None:
                        yield from out(now)
                    key, groups, now = (langs[at], blocks[at]), [], None
                if kinds[at] == 0:
                    groups += zip(*(run_of.column(c).to_pylist() for c in ("name", "n", "terms")), strict=True)
                else:
                    if now is None:
                        now = _Language(key[0], [g[0] for g in groups], [g[1] for g in groups], groups[0][2], top)
                    step = max(1, CELLS // len(now.sources))
                    for k in range(0, run_of.num_rows, step):
                        piece = run_of.slice(k, step)
                        now.take(piece.column("name"), piece.column("sources"), piece.column("counts"))
                        if len(now.sums) * len(now.sources) > limit:
                            yield from out(now)
                at = end
        if now is not None:
            yield from out(now)
    return run


def audit(docs: DataFrame, min_docs: int = 10, top: int = 10, table: int = TABLE, block_terms: int = BLOCK_TERMS,
          sums: int = SUMS) -> DataFrame:
    """lang, source, part, item, value, rank of every (lang, source) group.

    Part ``pair``: the divergence from each other source of the language.
    Part ``term``: the ``top`` terms that the group holds above its language's share.
    """
    kept = stripes(docs, min_docs, table)
    names = docs.select(*(F.coalesce(F.col(c).cast("string"), F.lit("")).alias(c) for c in ("lang", "source"))).distinct()
    tokens = (kept.select("lang", F.explode(F.arrays_zip("sources", "counts")).alias("e"))
              .groupBy("lang", F.col("e.sources").alias("source")).agg(F.sum("e.counts").alias("n")))
    langs = kept.groupBy("lang").agg(F.count(F.lit(1)).alias("terms"))
    groups = materialise(names.join(tokens, ["lang", "source"], "left").join(langs, "lang", "left")
                         .select("lang", "source", F.coalesce("n", F.lit(0)).alias("n"), F.coalesce("terms", F.lit(0)).alias("terms")),
                         "audit-groups")
    # Every block of a language's terms meets one row for each of the language's sources.
    blocks = F.ceil(F.col("terms") / block_terms).cast("int")
    empty = F.array().cast("array<string>"), F.array().cast("array<long>")
    side = groups.where("terms > 0").select(
        "lang", F.explode(F.sequence(F.lit(0), blocks - 1)).alias("block"), F.lit(0).alias("kind"), F.col("source").alias("name"), "n",
        "terms", empty[0].alias("sources"), empty[1].alias("counts"))
    per = langs.select("lang", blocks.alias("blocks"))
    body = join_small(kept, per.withColumnRenamed("lang", "of"), F.col("lang") == F.col("of"), "inner").select(
        "lang", F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int").alias("block"), F.lit(1).alias("kind"), F.col("term").alias("name"),
        F.col("df").alias("n"), F.lit(0).cast("long").alias("terms"), "sources", "counts")
    dealt = (side.unionByName(body).repartition(default_partitions(docs.sparkSession), "lang", "block")
             .sortWithinPartitions("lang", "block", "kind", "name"))
    partial = materialise(dealt.mapInArrow(_diverge(top, sums), "lang string, part string, source string, item string, value long"),
                          "audit-partial")

    zero = F.lit(1) + F.expr(f"CASE WHEN terms = 0 THEN 0 ELSE {2 * SCALE}L div (n + 2 * terms) END")
    base = groups.select("lang", "source", "terms", zero.alias("zero"))
    a, b = base.alias("a"), base.alias("b")
    pairs = (a.join(b, F.col("a.lang") == F.col("b.lang")).where("a.source <> b.source")
             .select("a.lang", "a.source", F.col("b.source").alias("item"),
                     (F.col("a.terms") * F.expr("(a.zero - b.zero) * (a.zero - b.zero) div (a.zero + b.zero)")).alias("base")))
    found = partial.where("part = 'pair'").groupBy("lang", "source", "item").agg(F.sum("value").alias("more"))
    both = found.unionByName(found.select("lang", F.col("item").alias("source"), F.col("source").alias("item"), "more"))
    value = F.col("base") + F.coalesce("more", F.lit(0))
    pairs = pairs.join(both, ["lang", "source", "item"], "left").select("lang", "source", F.lit("pair").alias("part"), "item", value.alias("value"))
    order = Window.partitionBy("lang", "source", "part").orderBy(F.desc("value"), "item")
    best = partial.where("part = 'term'").select("lang", "source", "part", "item", "value")
    best = best.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= top)
    pairs = pairs.withColumn("rank", F.row_number().over(order))
    return pairs.unionByName(best).select("lang", "source", "part", "item", "value", "rank")
