"""Language-model scores with an Elias-Fano n-gram trie.

The model is an interpolated n-gram model over words with absolute
discounting D.  With N training tokens (words and ends) and V different ones,

    P(w)           = (c(w) - D) / N              for a training token,
                     D * V / N                   for the class of all others,
    P(w | context) = max(c(context w) - D, 0) / c(context) + weight(context) * P(w | shorter)

where weight(context) is the mass that discounting leaves, D times the number
of its different n-grams over c(context).  All counts are exact and every
n-gram of the training texts counts, whatever the size of the corpus.

Steps, each over the whole corpus:

1. Each task reports chunks of texts: the texts as indexes into the chunk's
   distinct words, and the words with training counts, cut into shards by hash.
2. Each shard sums its words (the vocabulary, spread over the shards), numbers
   them, and answers every chunk: training count and id of its words.
3. Each chunk's texts meet the answers; its distinct n-grams and their training
   counts go to the shard of their context's hash.
4. Each shard merges its n-grams into an Elias-Fano trie and answers every
   chunk's n-grams from it: the discounted share and the context's weight.  A
   context is in one shard, so its counts are whole there.  The number of
   shards follows from the number of tokens, which bounds a shard's trie.
5. Each chunk's texts meet both answers and are summed.

Steps 3 and 5 read the chunks from one shuffle.

A frequent word or n-gram costs one entry a chunk, so no key grows with its
occurrences.

Defined cases: null and empty texts have the end as only token; without
training tokens every token's score is 0; a null doc_id counts as empty text
in the held-out rule; rows with equal doc_id are scored each and train each;
an empty table gives no rows; columns other than doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import crc_mod, default_partitions, lower_ascii, materialise, mix64, text_bytes
from tidemark.llm.ef_trie import EliasFano, Trie

ORDER = 3
DISCOUNT = 0.75
#: Bytes of text in a chunk; all its n-grams are in memory at once.
CHUNK = 12 << 20
#: Training and held-out tokens a shard of n-grams.
SHARD_TOKENS = 1_500_000
#: Bits of a word id in a shard's codes.
WORD_BITS = 32
#: Steps of an answered log10 value; the largest code stands for a share of 0.
GRID, NONE = 4096, 65535
_NAMES = ["chunk", "shard", "ids", "held", "sizes", "data", "counts", "at"]


def sequence(texts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Texts of ids (>= 1) -> ids with 0 at both edges, and each one's place in its text."""
    if not texts:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    zero = np.zeros(1, np.int64)
    seq = np.concatenate([x for t in texts for x in (zero, t.astype(np.int64), zero)])
    place = np.concatenate([np.arange(len(t) + 2) for t in texts])
    return seq, place


def squeeze(raw: bytes) -> bytes:
    return len(raw).to_bytes(8, "little") + pa.compress(raw, "zstd", asbytes=True)


def unsqueeze(raw: bytes) -> bytes:
    size = int.from_bytes(raw[:8], "little")
    return pa.decompress(raw[8:], size, "zstd", asbytes=True) if size else b""


def planes(a: np.ndarray) -> bytes:
    """The values' first bytes, then their second bytes, and so on, compressed."""
    return squeeze(np.ascontiguousarray(a).view(np.uint8).reshape(len(a), a.itemsize).T.tobytes())


def unplanes(raw: bytes, dtype: str) -> np.ndarray:
    data = np.frombuffer(unsqueeze(raw), np.uint8)
    return np.ascontiguousarray(data.reshape(np.dtype(dtype).itemsize, -1).T).view(dtype).ravel()


def _report(shards: int):
    """Texts as word indexes (shard -1) and words (0..) by shard."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash
        from pyspark import TaskContext

        part = TaskContext.get().partitionId() << 32
        chunk, size = 0, 0
        index: dict[bytes, int] = {}
        train: list[np.ndarray] = []

        def rows_of(rows: list[tuple], id_type: pa.DataType) -> pa.RecordBatch:
            kinds = [pa.int64(), pa.int32(), pa.list_(id_type), pa.list_(pa.bool_()), pa.list_(pa.int64())] + [pa.binary()] * 3
            return pa.record_batch([pa.array([r[k] for r in rows], t) for k, t in enumerate(kinds)], names=_NAMES)

        def words() -> list[tuple]:
            names = list(index)
            counts = np.bincount(np.concatenate([np.zeros(0, np.int64), *train]), minlength=len(names))
            own: list[list[int]] = [[] for _ in range(shards)]
            for i, w in enumerate(names):
                own[xxhash.xxh64_intdigest(w) % shards].append(i)
            return [(part + chunk, s, None, None, None, squeeze(b" ".join([names[i] for i in o])), planes(counts[o].astype("<u4")),
                     planes(np.diff(np.array(o, "<u4"), prepend=np.uint32(0)))) for s, o in enumerate(own) if o]

        id_type = pa.int64()
        for batch in batches:
            ids, held = batch.column("doc_id"), batch.column("held_out").to_pylist()
            id_type = ids.type
            texts = list(text_bytes(batch.column("text")))
            lo = 0
            while lo < len(texts):
                hi, part_size = lo, 0
                while hi < len(texts) and (hi == lo or part_size + len(texts[hi]) <= CHUNK // 8):
                    part_size += len(texts[hi])
                    hi += 1
                own = [np.array([index.setdefault(w, len(index)) for w in lower_ascii(b).split()], np.int64) for b in texts[lo:hi]]
                train += [o for o, h in zip(own, held[lo:hi], strict=True) if not h]
                yield rows_of([(part + chunk, -1, ids.slice(lo, hi - lo).to_pylist(), held[lo:hi], [len(o) for o in own],
                                planes(np.concatenate(own).astype("<u4")), None, None)], id_type)
                size += part_size
                lo = hi
                if size >= CHUNK:
                    yield rows_of(words(), id_type)
                    chunk, size, index, train = chunk + 1, 0, {}, []
        if size or index or train:
            yield rows_of(words(), id_type)
    return run


def pack(ids: np.ndarray) -> np.ndarray:
    """Rows of ids -> trie codes."""
    code = np.zeros(len(ids), np.uint64)
    for k in range(ids.shape[1]):
        code = (code << np.uint64(Trie.BITS)) | ids[:, k].astype(np.uint64)
    return code


def _answers(shards: int):
    """Rows sorted by shard: the chunks' words -> the answers to the chunks, and
    a row of sums (chunk -1) for each shard.

    The k-th word of shard s by its count has the id 1 + k * shards + s:
    frequent words get small ids, which compress well.  Id 0 is the edge.
    """
    def solve(shard: int, rows: list[tuple]) -> pa.RecordBatch:
        total: dict[bytes, int] = {}
        for _, _, data, counts in rows:
            for w, c in zip(unsqueeze(data).split(b" "), unplanes(counts, "<u4").tolist(), strict=True):
                total[w] = total.get(w, 0) + c
        where = {w: k for k, w in enumerate(sorted(total, key=total.get, reverse=True))}
        count = np.array([total[w] for w in where], "<i8")
        out = [(-1, None, None, None, int(count.sum()), int((count > 0).sum()), len(count))]
        for chunk, at, data, _ in rows:
            own = np.array([where[w] for w in unsqueeze(data).split(b" ")], np.int64)
            out.append((chunk, at, planes(count[own]), planes((own * shards + 1 + shard).astype("<u4")), None, None, None))
        kinds = [pa.int64()] + [pa.binary()] * 3 + [pa.int64()] * 3
        return pa.record_batch([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds)],
                               names=["chunk", "at", "count", "word_id", "tokens", "known", "size"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, rows = None, []
        for batch in batches:
            cols = [batch.column(c).to_pylist() for c in ("shard", "chunk", "at", "data", "counts")]
            for shard, *row in zip(*cols, strict=True):
                if shard != now:
                    if rows:
                        yield solve(now, rows)
                    now, rows = shard, []
                rows.append(tuple(row))
        if rows:
            yield solve(now, rows)
    return run


class Grams:
    """The distinct n-grams of a chunk, in the order of context and word, then
    grouped by shard (stable)."""

    def __init__(self, n: int, context: np.ndarray, word: np.ndarray, count: np.ndarray, at: np.ndarray, which: np.ndarray, shards: int):
        self.context, self.word, self.count, self.at, self.which = context, word, count, at, which
        shard = (mix64(context, n) % np.uint64(shards)).astype(np.uint16 if shards < 1 << 16 else np.uint32)
        self.order = np.argsort(shard, kind="stable").astype(np.uint32)
        self.edge = np.searchsorted(shard[self.order], np.arange(shards + 1))

    def of_shard(self, s: int) -> np.ndarray:
        return self.order[self.edge[s]:self.edge[s + 1]]


def chunk_grams(seq: np.ndarray, place: np.ndarray, train: np.ndarray, order: int, shards: int) -> Iterator[tuple[int, Grams]]:
    """For n = 2..order: the n-grams of all texts with their counts in the training texts."""
    seq = seq.astype(np.uint32)
    ids, above = seq, None  # the (n-1)-gram that ends at each place
    for n in range(2, order + 1):
        at = np.flatnonzero(place >= n - 1).astype(np.uint32)
        own, which = np.unique((ids[at - 1].astype(np.uint64) << np.uint64(WORD_BITS)) | seq[at], return_inverse=True)
        which = which.astype(np.uint32)
        count = np.bincount(which[train[at]], minlength=len(own)).astype(np.uint32)
        head = own >> np.uint64(WORD_BITS)
        yield n, Grams(n, head if above is None else above[head], own.astype(np.uint32), count, at, which, shards)
        ids = np.zeros(len(seq), np.uint32)
        ids[at] = which
        above = own


class Chunk:
    """The rows of one chunk: answers about its words, its texts, answers about its n-grams."""

    def __init__(self):
        self.count, self.word_id = np.zeros(0, np.int64), np.zeros(0, np.int64)
        self.texts: list[tuple] = []
        self.grams: dict[tuple[int, int], tuple[bytes, bytes]] = {}

    def add(self, row: dict) -> None:
        if row["kind"] == 0:
            at = np.cumsum(unplanes(row["at"], "<u4"), dtype=np.int64)
            if at.max(initial=-1) >= len(self.count):
                grow = max(int(at.max()) + 1, 2 * len(self.count)) - len(self.count)
                self.count, self.word_id = np.append(self.count, np.zeros(grow, np.int64)), np.append(self.word_id, np.zeros(grow, np.int64))
            self.count[at] = unplanes(row["count"], "<i8")
            self.word_id[at] = unplanes(row["word_id"], "<u4")
        elif row["kind"] == 1:
            self.texts.append((row["ids"], row["held"], np.array(row["sizes"], np.int64), unplanes(row["data"], "<u4")))
        else:
            self.grams[row["n"], row["shard"]] = row["own"], row["weight"]

    def split(self, values: np.ndarray) -> list[np.ndarray]:
        """``values`` of the words, text by text."""
        return [x for _, _, sizes, index in self.texts for x in np.split(values[index], np.cumsum(sizes)[:-1])]

    def sequence(self) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Word ids, their places, and whether they are of a training text."""
        seq, place = sequence(self.split(self.word_id))
        held = np.array([h for t in self.texts for h in t[1]], bool)
        return seq, place, np.repeat(~held, np.concatenate([t[2] for t in self.texts]) + 2)


def _chunk(rows: pa.Table, answers: pa.Table | None = None) -> Chunk:
    """The rows of one chunk."""
    chunk = Chunk()
    for table in (rows, answers):
        for batch in table.to_batches() if table is not None else ():
            for i in range(batch.num_rows):
                chunk.add({c: batch.column(c)[i].as_py() for c in batch.schema.names})
    return chunk


def _gram_rows(order: int, shards: int):
    """A chunk's rows -> its n-grams, one row a shard and n."""
    kinds = {"chunk": pa.int64(), "shard": pa.int32(), "n": pa.int32(), "contexts": pa.binary(), "words": pa.binary(), "counts": pa.binary()}

    def run(key: tuple, rows: pa.Table) -> pa.Table:
        chunk, out = _chunk(rows), []
        for n, g in chunk_grams(*chunk.sequence(), order, shards) if chunk.texts else ():
            for s in range(shards):
                own = g.of_shard(s)
                if len(own):
                    step = np.diff(g.context[own], prepend=np.uint64(0))
                    out.append((key[0].as_py(), s, n, planes(step), planes(g.word[own]), planes(g.count[own])))
            del g
        return pa.table([pa.array([r[k] for r in out], t) for k, t in enumerate(kinds.values())], names=list(kinds))
    return run


class Shard:
    """A shard's n-grams: its contexts as an Elias-Fano sequence, and a trie over their numbers."""

    def __init__(self, context: np.ndarray, word: np.ndarray, count: np.ndarray):
        seen = count > 0  # the others are in held-out texts only
        contexts, number = np.unique(context[seen], return_inverse=True)
        code = (number.astype(np.uint64) << np.uint64(WORD_BITS)) | word[seen]
        order = np.argsort(code)
        code, count = code[order], count[seen][order]
        first = np.flatnonzero(np.concatenate(([True], code[1:] != code[:-1]))) if len(code) else order
        code, count = code[first], np.add.reduceat(count, first, dtype=np.int64) if len(code) else count
        number = (code >> np.uint64(WORD_BITS)).astype(np.int64)
        total, different = np.bincount(number, count, len(contexts)), np.bincount(number, minlength=len(contexts))
        self.contexts = EliasFano.encode(contexts)
        self.trie = Trie.build(len(contexts), [(code, np.log10((count - DISCOUNT) / total[number]))],
                               [np.log10(DISCOUNT * different / total)], WORD_BITS)
        self.known = self.contexts.decode().astype(np.uint64)
        level = self.trie.levels[0]
        self.own, self.weight = to_grid(level["p_centre"])[level["p"]], to_grid(level["w_centre"])[level["w"]]

    def answer(self, context: np.ndarray, word: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Codes of the n-grams' discounted shares and of their contexts' weights."""
        own, weight = np.full(len(word), NONE, "<u2"), np.zeros(len(word), "<u2")
        if not len(self.known):
            return own, weight
        at = np.minimum(np.searchsorted(self.known, context), len(self.known) - 1)
        at = np.where(self.known[at] == context, at, -1)
        node = self.trie.successor(0, at, word.astype(np.int64))
        own[node >= 0], weight[at >= 0] = self.own[node[node >= 0]], self.weight[at[at >= 0]]
        return own, weight


def few(codes: np.ndarray) -> bytes:
    """Codes as one byte each and a table of the values, if that holds them."""
    table, which = np.unique(codes, return_inverse=True)
    if len(table) > 256:
        return b"\0\0" + planes(codes)
    return len(table).to_bytes(2, "little") + table.astype("<u2").tobytes() + planes(which.astype(np.uint8))


def unfew(raw: bytes) -> np.ndarray:
    size = int.from_bytes(raw[:2], "little")
    if not size:
        return unplanes(raw[2:], "<u2")
    return np.frombuffer(raw, "<u2", size, 2)[unplanes(raw[2 + 2 * size:], "u1")]


def to_grid(log_p: np.ndarray) -> np.ndarray:
    return np.clip(np.rint(-GRID * log_p), 0, NONE - 1).astype("<u2")


_SHARES = np.append(10.0 ** (np.arange(NONE) / -GRID), 0.0)


def _solve_grams(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows sorted by shard and n -> the answers to their chunks."""
    now, rows = None, []

    def emit() -> pa.RecordBatch:
        cut = [(c, np.cumsum(unplanes(x, "<u8"), dtype=np.uint64), unplanes(w, "<u4"), unplanes(k, "<u4")) for c, x, w, k in rows]
        context, word, count = (np.concatenate([r[k] for r in cut]) for k in (1, 2, 3))
        edge = np.cumsum([len(r[1]) for r in cut])[:-1]
        shard = Shard(context, word, count)
        del count
        own, weight = (np.split(x, edge) for x in shard.answer(context, word))
        out = [(r[0], few(a), few(b)) for r, a, b in zip(cut, own, weight, strict=True)]
        return pa.record_batch([pa.array([r[0] for r in out], pa.int64()), pa.array([now[0]] * len(out), pa.int32()), pa.array([now[1]] * len(out), pa.int32()),
                                pa.array([r[1] for r in out], pa.binary()), pa.array([r[2] for r in out], pa.binary())],
                               names=["chunk", "shard", "n", "own", "weight"])

    for batch in batches:
        cols = [batch.column(c).to_pylist() for c in ("shard", "n", "chunk", "contexts", "words", "counts")]
        for shard, n, *row in zip(*cols, strict=True):
            if (shard, n) != now:
                if rows:
                    yield emit()
                now, rows = (shard, n), []
            rows.append(row)
    if rows:
        yield emit()


def chunk_scores(chunk: Chunk, order: int, shards: int, tokens: int, distinct: int, ends: int) -> np.ndarray:
    """log10 P of each text of the chunk."""
    texts = chunk.split(chunk.count)
    if not tokens:
        return np.zeros(len(texts))
    seq, place, train = chunk.sequence()
    edge = np.array([ends], np.int64)
    c = np.concatenate([x for t in texts for x in (edge, t, edge)])
    p = np.where(c > 0, c - DISCOUNT, DISCOUNT * distinct) / tokens
    for n, g in chunk_grams(seq, place, train, order, shards):
        own, weight = np.zeros(len(g.word), np.float32), np.ones(len(g.word), np.float32)
        for s in range(shards):
            k = g.of_shard(s)
            if len(k):
                own[k], weight[k] = (_SHARES[unfew(x)] for x in chunk.grams.pop((n, s)))
        p[g.at] = own[g.which] + weight[g.which] * p[g.at]
        del g, own, weight
    p[place == 0] = 1
    start = np.cumsum([0, *(len(t) + 2 for t in texts)])[:-1]
    return np.add.reduceat(np.log10(p), start)


def _sum_up(order: int, shards: int, tokens: int, distinct: int, ends: int):
    """A chunk's rows and the answers about its n-grams -> scores."""
    def run(rows: pa.Table, answers: pa.Table) -> pa.Table:
        base_all = math.log10(tokens + 0.5 * (distinct + 1))
        id_type = rows.schema.field("ids").type.value_type
        chunk = _chunk(rows, answers)
        counts = chunk.split(chunk.count)
        sizes = np.array([len(c) for c in counts], np.int64)
        known = np.array([int((c > 0).sum()) for c in counts], np.int64) + (ends > 0)
        base = np.array([float(np.log10(c + 0.5).sum()) for c in counts]) + math.log10(ends + 0.5) - (sizes + 1) * base_all
        score = chunk_scores(chunk, order, shards, tokens, distinct, ends) if chunk.texts else np.zeros(0)
        return pa.table(
            [pa.array([x for t in chunk.texts for x in t[0]], id_type), pa.array([x for t in chunk.texts for x in t[1]], pa.bool_()),
             pa.array(sizes + 1), pa.array(known, pa.int64()), pa.array(np.full(len(sizes), tokens, np.int64)), pa.array(base, pa.float64()),
             pa.array(score, pa.float64())],
            names=["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"])
    return run


def lm_scores(docs: DataFrame, held_out: Column | None = None, order: int = ORDER) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score."""
    if order > ORDER:
        raise ValueError(f"contexts of {order - 1} words do not fit a code")
    spark = docs.sparkSession
    held = crc_mod("doc_id", 5) == 1 if held_out is None else held_out
    shards = default_partitions(spark)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", held.alias("held_out"))
    report = materialise(rows.mapInArrow(_report(shards), f"chunk long, shard int, ids array<{id_type}>, "
                                         "held array<boolean>, sizes array<long>, data binary, counts binary, at binary"), "lm-report")
    words = report.where("shard >= 0").select("chunk", "shard", "data", "counts", "at")
    texts = report.where("shard < 0").select("chunk", F.lit(1).alias("kind"), "ids", "held", "sizes", "data")
    answers = (words.repartition("shard").sortWithinPartitions("shard")
               .mapInArrow(_answers(shards), "chunk long, at binary, count binary, word_id binary, tokens long, known long, size long"))
    answers = materialise(answers.withColumn("kind", F.lit(0)), "lm-answers")
    sums = answers.where("chunk < 0").agg(F.sum("tokens"), F.sum("known"), F.max("size")).first()
    ends, scored = texts.select(F.sum(F.size(F.filter("held", lambda h: ~h))), F.sum(F.expr("aggregate(sizes, 0L, (a, x) -> a + x)") + F.size("sizes"))).first()
    ends = ends or 0
    tokens, distinct = (sums[0] or 0) + ends, (sums[1] or 0) + (ends > 0)
    size = 1 + shards * (sums[2] or 0)
    if size > 1 << (WORD_BITS - 1):
        raise ValueError(f"{size} words do not fit {WORD_BITS - 1} bits")
    both = answers.where("chunk >= 0").drop("tokens", "known", "size").unionByName(texts, allowMissingColumns=True)
    gram_shards = max(shards, -(-(scored or 0) // SHARD_TOKENS))
    # The last step reads the chunks from the same shuffle.
    grams = both.groupBy("chunk").applyInArrow(_gram_rows(order, gram_shards), "chunk long, shard int, n int, contexts binary, words binary, counts binary")
    grams = grams.repartition("shard") if gram_shards == shards else grams.repartition(gram_shards, "shard")
    gram_answers = (grams.sortWithinPartitions("shard", "n")
                    .mapInArrow(_solve_grams, "chunk long, shard int, n int, own binary, weight binary").withColumn("kind", F.lit(2)))
    return (both.groupBy("chunk").cogroup(gram_answers.groupBy("chunk"))
            .applyInArrow(_sum_up(order, gram_shards, tokens, distinct, ends), f"doc_id {id_type}, held_out boolean, n_tokens long, n_known long, "
                                                                            "train_tokens long, base_score double, score double"))
