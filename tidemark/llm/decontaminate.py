"""Benchmark decontamination by CGK embedding and bit-sampling LSH.

A document leaks an item if some run of its words is within ``max_edits``
(a fifth) of the item's words in word edit distance.  Words are compared
lower-cased and without marks at their edges.

1. Windows.  With ``t`` edits at most on W words, a leak shares a run of
   ``(W - t) // (t + 1)`` words or more with the item, so every leak has an
   item-sized window that starts where such a run of ``gram`` words puts the
   item's first word.  Windows of all items' lengths are taken at these places
   (this only picks where to look, and loses no leak).  As each edit breaks two
   pairs of neighbours at most, ``W - 1 - 2 t`` of an item's pairs stay whole in
   a leak; windows that hold fewer pairs of the items of their length, widened
   as in step 4, are passed over, for none of them would be verified.
2. Embedding.  The CGK walk reads a window for 3 W steps; at each step a random
   bit of the step and the current word decides whether to move on.  Edit
   distance becomes Hamming distance of the words read.
3. LSH.  Each of ``tables`` walks samples ``bits`` of its steps.  Windows that
   agree with an item of their length in all samples of a walk are candidates.
   The number of tables follows from the target recall at a Hamming share of
   ``hamming``, which holds up to ``long_item`` words; as the share grows with
   the length, longer items get as many times more tables.
4. Candidates are verified exactly: the item against all runs of the window,
   widened by t words on both sides, by a bit-parallel edit distance.

The benchmark is a query set: it is read in blocks of about ``BLOCK_ITEMS``
items or ``BLOCK_BYTES`` of text, which bounds each broadcast; every block meets all documents, in place,
without a shuffle.

Defined cases: null and empty texts leak nothing; null, empty and word-less
items leak nowhere; equal items are found each; rows with equal doc_id are
judged each; an empty benchmark or table gives no leaks; all columns of the
documents pass on, ``leaks`` replaces a column of that name.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import columns_named, map_arrow, mix64, widened

BLOCK_ITEMS = 20_000
BLOCK_BYTES = 32 << 20
#: Characters of the texts that are searched at once, and windows, each once a table, embedded at once.
SEARCH_CHARS = 4 << 20
EMBED_WINDOWS = 1 << 16
EDGES = ".,;:!?\"'()[]{}<>|*&%#$…«»“”-_"
LEAK = "struct<item_id:{item},start:int,n_words:int,distance:int>"


@dataclass(frozen=True)
class LeakConfig:
    max_edits: float = 0.2
    gram: int = 3
    bits: int = 3
    recall: float = 0.98
    hamming: float = 0.45
    long_item: int = 60

    @property
    def tables(self) -> int:
        return math.ceil(math.log(1 - self.recall) / math.log(1 - (1 - self.hamming) ** self.bits))

    def tables_of(self, width: int) -> int:
        """Tables of the items of ``width`` words."""
        return self.tables * max(1, math.ceil(width / self.long_item))


def plain_words(text: str) -> list[str]:
    """Lower-cased words without marks at the edges; a word of marks alone is dropped."""
    return [w for w in (x.strip(EDGES) for x in text.lower().split()) if w]


def walk_bits(words: int, table: int) -> np.ndarray:
    """64 random bits of every word id (0..words) in one table."""
    return mix64(np.arange(words + 1, dtype=np.uint64), 100 + table)


@lru_cache(maxsize=1 << 14)
def sampled_steps(width: int, table: int, bits: int) -> frozenset[int]:
    steps = 3 * width
    rng = np.random.default_rng(1_000_003 * width + table)
    return frozenset(rng.choice(steps, size=min(bits, steps), replace=False).tolist())


def embed_keys(flat: np.ndarray, start: np.ndarray, width: int, bits_of: np.ndarray, bits: int) -> np.ndarray:
    """Keys of the windows flat[start : start + width], a row for each table, hence for each row of ``bits_of``.

    At step j the walk moves on if bit j (mod 64) of the word's random bits,
    turned by the round, is set.  The sampled steps depend on the table and the
    width only, so windows and items of one width are treated alike.
    """
    tables, words = bits_of.shape
    where: dict[int, list[int]] = {}
    for t in range(tables):
        for step in sampled_steps(width, t, bits):
            where.setdefault(step, []).append(t)
    at, end = np.tile(start, (tables, 1)), start + width
    row = np.arange(tables)[:, None] * words
    random_of = bits_of.ravel()
    key = np.repeat(np.arange(1, tables + 1, dtype=np.uint64)[:, None], len(start), axis=1)
    for step in range(max(where, default=-1) + 1):
        inside = at < end
        here = np.where(inside, flat[np.minimum(at, len(flat) - 1)], words - 1)
        if step in where:
            own = where[step]
            key[own] = mix64(key[own] ^ mix64(np.where(inside[own], here[own], -1).view(np.uint64), 4), 5)
        # Past bit 63 the bits are read in another order: j, then 5 j + 1.
        bit = step if step < 64 else (5 * step + 1) % 64
        at += ((random_of[row + here] >> np.uint64(bit)) & np.uint64(1)).astype(np.int64) & inside
    return key


def best_match(item: list[int], text: list[int]) -> tuple[int, int]:
    """(least word edit distance of the item to any run of the text, the run's end).

    Bit vectors of vertical differences, one bit a word of the item.
    """
    m = len(item)
    top, full = 1 << (m - 1), (1 << m) - 1
    where: dict[int, int] = {}
    for i, w in enumerate(item):
        where[w] = where.get(w, 0) | (1 << i)
    up, down, score = full, 0, m
    best, end = m, 0
    for j, w in enumerate(text, 1):
        eq = where.get(w, 0)
        diagonal = (((eq & up) + up) ^ up) | eq | down
        right_up = (down | ~(diagonal | up)) & full
        right_down = up & diagonal
        score += (right_up & top > 0) - (right_down & top > 0)
        right_up, right_down = (right_up << 1) & full, (right_down << 1) & full
        up = (right_down | ~(diagonal | right_up)) & full
        down = right_up & diagonal
        if score < best:
            best, end = score, j
    return best, end


class Items:
    """One block of the benchmark, ready to be searched for."""

    def __init__(self, rows: list[tuple], cfg: LeakConfig):
        self.cfg = cfg
        self.vocabulary: dict[str, int] = {}
        self.items: list[tuple] = []  # (item_id, word ids, edits)
        for item_id, text in rows:
            words = [self.vocabulary.setdefault(w, len(self.vocabulary) + 1) for w in plain_words(text or "")]
            if words:
                self.items.append((item_id, words, int(cfg.max_edits * len(words))))
        self.id_of = {**self.vocabulary, "": -1}
        self.grams: list[tuple[int, np.ndarray, list[list[tuple[int, int]]]]] = []
        found: dict[int, dict[int, list[tuple[int, int]]]] = {}
        self.by_length: dict[int, list[int]] = {}
        for k, (_, words, edits) in enumerate(self.items):
            n = max(1, min(cfg.gram, (len(words) - edits) // (edits + 1)))
            codes = gram_codes(np.array(words, np.int64), n)
            for q, c in enumerate(codes.tolist()):
                found.setdefault(n, {}).setdefault(c, []).append((len(words), q))
            self.by_length.setdefault(len(words), []).append(k)
        pairs = {width: np.concatenate([gram_codes(np.array(self.items[k][1], np.int64), 2) for k in own]) for width, own in self.by_length.items()}
        self.pairs = np.unique(np.concatenate([*pairs.values(), np.zeros(0, np.uint64)]))
        self.pairs_of = {width: np.searchsorted(self.pairs, np.unique(own)) for width, own in pairs.items()}
        for n, table in found.items():
            codes = sorted(table)
            self.grams.append((n, np.array(codes, np.uint64), [sorted(set(table[c])) for c in codes]))
        self.keys: dict[int, list[dict[int, list[int]]]] = {}
        self.known: dict[int, np.ndarray] = {}
        tables = max(map(cfg.tables_of, self.by_length), default=0)
        self.bits_of = np.array([walk_bits(len(self.vocabulary) + 1, t) for t in range(tables)])
        for width, own in self.by_length.items():
            flat = np.concatenate([np.array(self.items[k][1], np.int64) for k in own])
            start = np.arange(len(own)) * width
            self.keys[width] = [{} for _ in range(cfg.tables_of(width))]
            for lo, found_keys in self._embedded(flat, start, width):
                for table, keys in zip(self.keys[width], found_keys.tolist(), strict=True):
                    for k, key in zip(own[lo:], keys, strict=False):
                        table.setdefault(key, []).append(k)
            self.known[width] = np.unique(np.array([key for table in self.keys[width] for key in table], np.uint64))

    def _embedded(self, flat: np.ndarray, start: np.ndarray, width: int) -> Iterator[tuple[int, np.ndarray]]:
        """Keys of the windows in bounded parts, with the first window's place."""
        tables = self.cfg.tables_of(width)
        step = max(1, EMBED_WINDOWS // tables)
        for lo in range(0, len(start), step):
            yield lo, embed_keys(flat, start[lo:lo + step], width, self.bits_of[:tables], self.cfg.bits)

    def ids(self, text: str) -> np.ndarray:
        """Ids of ``plain_words(text)``, 0 for a word that no item has."""
        spelled = text.lower().split()
        ids = np.fromiter(map(self.id_of.get, map(str.strip, spelled, repeat(EDGES)), repeat(0)), np.int64, len(spelled))
        return ids[ids >= 0]

    def search(self, texts: list[str | None]) -> list[list[dict]]:
        """The leaks of each text."""
        docs = [self.ids(t or "") for t in texts]
        # All texts in a row, with a gap that no window bridges a match over.
        edge = np.concatenate(([0], np.cumsum([len(d) + 1 for d in docs])))
        flat = np.zeros(int(edge[-1]), np.int64)
        for a, d in zip(edge, docs, strict=False):
            flat[a:a + len(d)] = d
        windows: dict[int, list[np.ndarray]] = {}
        for n, codes, places in self.grams:
            if len(flat) < n:
                continue
            at, hit = known_grams(flat, n, codes)
            order = np.argsort(hit, kind="stable")
            at, hit = at[order], hit[order]
            edges = np.flatnonzero(np.diff(hit, prepend=-1, append=-1)).tolist() if len(hit) else []
            for lo, hi in zip(edges[:-1], edges[1:], strict=True):
                for width, q in places[hit[lo]]:
                    windows.setdefault(width, []).append(at[lo:hi] - q)
        pair_at, pair = known_grams(flat, 2, self.pairs)
        margin = max(windows, default=0)
        padded = np.concatenate([np.zeros(margin, np.int64), flat, np.zeros(margin, np.int64)])
        pairs: set[tuple[int, int]] = set()
        out: list[list[dict]] = [[] for _ in texts]
        best: dict[tuple[int, int], tuple[int, int, int]] = {}
        for width, starts in windows.items():
            start = np.unique(np.concatenate(starts))
            starts.clear()
            edits = int(self.cfg.max_edits * width)
            own_pair = np.zeros(len(self.pairs), bool)
            own_pair[self.pairs_of[width]] = True
            shared = pair_at[own_pair[pair]]
            held = np.searchsorted(shared, start + width + edits - 1) - np.searchsorted(shared, start - edits)
            start = start[held >= width - 1 - 2 * edits]
            # A margin in front keeps windows that start before the first text.
            for lo, keys in self._embedded(padded, start + margin, width):
                for t, row in np.argwhere(np.isin(keys, self.known[width])).tolist():
                    for k in self.keys[width][t].get(int(keys[t, row]), ()):
                        pairs.add((int(start[lo + row]), k))
        for start_at, k in pairs:
            self._verify(start_at, k, flat, edge, best)
        for (doc, k), (distance, begin, n) in sorted(best.items()):
            out[doc].append({"item_id": self.items[k][0], "start": begin, "n_words": n, "distance": distance})
        return out

    def search_all(self, texts: list[str | None]) -> Iterator[list[dict]]:
        """The leaks of each text, however many there are: arrays over the words hold a bounded part at once."""
        for lo, hi in slices([len(t or "") for t in texts], SEARCH_CHARS):
            yield from self.search(texts[lo:hi])

    def _verify(self, start: int, k: int, flat: np.ndarray, edge: np.ndarray, best: dict) -> None:
        _, words, edits = self.items[k]
        # The document that holds the middle of the window.
        doc = int(np.searchsorted(edge, min(max(0, start + len(words) // 2), len(flat) - 1), side="right")) - 1
        for d in {doc, doc - 1, doc + 1}:
            if not 0 <= d < len(edge) - 1:
                continue
            a, b = max(int(edge[d]), start - edits), min(int(edge[d + 1]) - 1, start + len(words) + edits)
            if b - a < len(words) - edits:
                continue
            text = flat[a:b].tolist()
            if len(set(words).difference(text)) > edits:
                continue  # each edit loses one word at most
            distance, end = best_match(words, text)
            if distance > edits:
                continue
            back, size = best_match(words[::-1], text[:end][::-1])
            if (d, k) not in best or (distance, a + end - size - int(edge[d])) < best[d, k][:2]:
                best[d, k] = (distance, a + end - size - int(edge[d]), size)


def slices(sizes: list[int], most: int) -> Iterator[tuple[int, int]]:
    """Runs of neighbours whose sizes add up to ``most`` at the most, or of one."""
    lo = total = 0
    for k, size in enumerate(sizes):
        if k > lo and total + size > most:
            yield lo, k
            lo, total = k, 0
        total += size
    if sizes:
        yield lo, len(sizes)


def gram_codes(ids: np.ndarray, n: int) -> np.ndarray:
    """64-bit code of every run of n ids."""
    return _codes_at(mix64(ids.view(np.uint64), 21), np.arange(max(0, len(ids) - n + 1)), n)


def _codes_at(mixed: np.ndarray, at: np.ndarray, n: int) -> np.ndarray:
    h = np.zeros(len(at), np.uint64)
    with np.errstate(over="ignore"):
        for k in range(n):
            h = h * np.uint64(0x9E3779B97F4A7C15) + mixed[at + k]
    return h


def known_grams(flat: np.ndarray, n: int, codes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Where in ``flat`` runs of n known words stand that are among the sorted codes, and which."""
    runs = len(flat) - n + 1
    if runs <= 0 or not len(codes):
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    word = flat > 0
    ok = word[:runs].copy()
    for k in range(1, n):
        ok &= word[k:runs + k]
    at = np.flatnonzero(ok)
    code = _codes_at(mix64(flat.view(np.uint64), 21), at, n)
    hit = np.minimum(np.searchsorted(codes, code), len(codes) - 1)
    same = codes[hit] == code
    return at[same], hit[same]


def find_leaks(docs: DataFrame, benchmark: DataFrame, cfg: LeakConfig = LeakConfig()) -> DataFrame:
    """``docs`` with ``leaks``: item, first word, words and distance of each leak."""
    spark = docs.sparkSession
    item_type = benchmark.schema["item_id"].dataType.simpleString()
    keep = [f for f in docs.schema if f.name.lower() != "leaks"]
    kind = f"array<{LEAK.format(item=item_type)}>"
    n, size = benchmark.agg(F.count(F.lit(1)), F.sum(F.octet_length("text"))).first()
    n_blocks = max(1, -(-n // BLOCK_ITEMS), -(-(size or 0) // BLOCK_BYTES))
    block_of = F.pmod(F.xxhash64("item_id", "text"), F.lit(n_blocks))
    out = docs.select(*columns_named(f.name for f in keep)).withColumn("leaks", F.lit(None).cast(kind))
    schema = widened(keep, f"leaks {kind}")
    names = [*(f.name for f in keep), "leaks"]
    for block in range(n_blocks):
        rows = [(r.item_id, r.text) for r in benchmark.where(block_of == block).select("item_id", "text").orderBy("item_id", "text").collect()]
        shared = spark.sparkContext.broadcast(rows)

        def run(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            items = Items(shared.value, cfg)
            for batch in batches:
                texts = batch.column("text").to_pylist()
                leaks = batch.column("leaks").to_pylist()
                for k, found in enumerate(items.search_all(texts)):
                    leaks[k] = [*(leaks[k] or []), *found]
                yield pa.record_batch([*(batch.column(c) for c in names[:-1]), pa.array(leaks, batch.schema.field("leaks").type)], names=names)

        out = map_arrow(out, run, schema)
    return out


def contaminated(docs: DataFrame, benchmark: DataFrame, cfg: LeakConfig = LeakConfig()) -> DataFrame:
    """One row per document and item that it leaks."""
    found = find_leaks(docs.select("doc_id", "text"), benchmark, cfg)
    return (found.select("doc_id", F.explode("leaks").alias("leak"))
            .select("doc_id", "leak.item_id", "leak.start", "leak.n_words", "leak.distance"))
