"""Hard-negative mining with cover trees over norm-augmented candidates.

A candidate x is lifted to ``(x, sqrt(M^2 - |x|^2))``, where M is the largest
norm of its block, so that all candidates of a block lie on one sphere and an
anchor's inner product with them is ``|q| M cos(angle)``.  A block of
candidates is a cover tree: every node has a centre and the covering radius
(an angle) of all points below it; its children are centres taken farthest
first, which lie at least the children's covering radius apart.  For a node at
angle a with radius r, all inner products lie between ``|q| M cos(a + r)`` and
``|q| M cos(a - r)``.  A descent opens nodes in order of that upper bound, skips
those outside of all open windows or below the scores already held, and
verifies the points of a leaf by their exact integer inner products.

Distribution: rows equal in vector and label are one candidate with its
smallest ids only (later ones can never be chosen before those), which is
exact and leaves one row of a vector that a third of all rows share.  The
candidates are dealt to blocks bounded in bytes.  Each distinct anchor meets
each block once in either of two passes: the first finds the positives, the
second the negatives of the windows that the positives' scores open.  A block
gives each anchor's best few, and the best of those are the result.

Defined cases: rows with a null label, a null vector or a null or non-finite
component (also after scaling) take no part; vectors of different lengths are
compared as if padded with zeros, an empty vector scores 0; a null id is no
anchor by an id's rule and comes after all other ids in ties, and equal
(id, label, vector) rows are rows of their own, each another row to its copies;
an empty table gives no rows; other columns are not read.  Scores are exact
within 64 bits; a block ranks larger ones exactly too, but gives the nearest
long, which is what blocks and windows then go by.
"""

from __future__ import annotations

import heapq
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import default_partitions, materialise

#: Points of a leaf, and children of a node.
LEAF = 128
FAN = 16
#: A block's vectors as doubles take at most this many bytes.
BLOCK_BYTES = 1 << 26
#: Blocks are made smaller for parallel work, down to this many candidates.
BLOCK_ROWS = 4096
#: Anchors that meet a tree together, and scores that they may hold.
QUERIES = 256
CELLS = 1 << 23
NO_ID = 2**63 - 1
LONG = 2**63 - 1
KINDS = (np.int16, np.int32)


def pack(x: np.ndarray) -> bytes:
    """Whole numbers held as doubles, in the smallest of 16 or 32 bits or doubles."""
    top = np.abs(x).max(initial=0)
    for k, kind in enumerate(KINDS):
        if top <= np.iinfo(kind).max:
            return bytes([k]) + x.astype(kind).tobytes()
    return b"\x02" + (x + 0.0).tobytes()


def unpack(b: bytes) -> np.ndarray:
    return np.frombuffer(b, (*KINDS, np.float64)[b[0]], offset=1).astype(np.float64)


def matrix(vectors: list[np.ndarray], width: int = 0) -> np.ndarray:
    """Vectors as rows, padded with zeros."""
    out = np.zeros((len(vectors), max([width, *map(len, vectors)], default=width)))
    for row, v in zip(out, vectors, strict=True):
        row[:len(v)] = v
    return out


def _scaled(scale: float):
    names = ["id", "label", "vec"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            ids, labels, vecs = [], [], []
            for i, lab, v in zip(b.column("id").to_pylist(), b.column("label").to_pylist(), b.column("vec"), strict=True):
                if lab is None or not v.is_valid or v.values.null_count:
                    continue
                with np.errstate(over="ignore", invalid="ignore"):
                    x = np.floor(scale * v.values.to_numpy(zero_copy_only=False).astype(np.float64))
                if not np.isfinite(x).all():
                    continue
                ids.append(i)
                labels.append(lab)
                vecs.append(pack(x))
            yield pa.record_batch([pa.array(ids, pa.int64()), pa.array(labels, pa.int64()), pa.array(vecs, pa.binary())], names=names)
    return run


class Tree:
    """Cover tree over the rows of x; nodes are arrays, points of a node are neighbours in ``order``."""

    def __init__(self, x: np.ndarray, labels: np.ndarray):
        self.x = x
        unit = np.abs(x).max(initial=0) or 1.0
        small = x / unit
        norms = np.einsum("ij,ij->i", small, small)
        self.radius = math.sqrt(norms.max(initial=0)) or 1.0
        lift = np.sqrt(np.maximum(0, self.radius ** 2 - norms))
        self.points = np.hstack([small, lift[:, None]]) / self.radius
        self.unit = unit
        self.order = np.argsort(labels, kind="stable")
        self.begin, self.end, self.centre, self.cover, self.children = [], [], [], [], []
        self.roots: dict[int, int] = {}
        held = labels[self.order]
        cuts = [0, *(np.flatnonzero(np.diff(held)) + 1).tolist(), len(held)]
        for a, b in zip(cuts, cuts[1:], strict=False):
            if a < b:
                self.roots[int(held[a])] = self._grow(a, b)
        self.centres = self.points[self.centre]
        self.cover = np.array(self.cover)
        self.exact = x[self.order]
        self.labels, self.top = held, np.abs(x).max(initial=0)

    def _node(self, a: int, b: int, centre: int) -> int:
        cos = self.points[self.order[a:b]] @ self.points[centre]
        self.begin.append(a)
        self.end.append(b)
        self.centre.append(centre)
        self.cover.append(float(np.arccos(np.clip(cos.min(), -1, 1))))
        self.children.append(())
        return len(self.begin) - 1

    def _grow(self, a: int, b: int) -> int:
        root = self._node(a, b, int(self.order[a]))
        todo = [root]
        while todo:
            node = todo.pop()
            kids = self._split(node)
            self.children[node] = kids
            todo += kids
        return root

    def _split(self, node: int) -> tuple[int, ...]:
        """Children with centres taken farthest first, until they cover at half of the node's radius."""
        a, b = self.begin[node], self.end[node]
        if b - a <= LEAF or self.cover[node] < 1e-9:
            return ()
        rows = self.order[a:b]
        points = self.points[rows]
        best, owner, centres = points @ self.points[self.centre[node]], np.zeros(b - a, np.int64), [self.centre[node]]
        while len(centres) < FAN and np.arccos(np.clip(best.min(), -1, 1)) > self.cover[node] / 2:
            far = int(best.argmin())
            cos = points @ points[far]
            nearer = cos > best
            owner[nearer] = len(centres)
            best = np.where(nearer, cos, best)
            centres.append(int(rows[far]))
        by = np.argsort(owner, kind="stable")
        self.order[a:b] = rows[by]
        sizes = np.bincount(owner, minlength=len(centres))
        ends = a + np.cumsum(sizes)
        kids = [(int(e - n), int(e), c) for e, n, c in zip(ends, sizes, centres, strict=True) if n]
        return tuple(self._node(*k) for k in kids) if len(kids) > 1 else ()

    def bounds(self, q: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Lower and upper bound of the inner products below each node, for each row of q."""
        unit = np.abs(q).max(axis=1, initial=0)
        unit[unit == 0] = 1
        small = q / unit[:, None]
        norm = np.sqrt(np.einsum("ij,ij->i", small, small))
        cos = np.zeros((len(q), len(self.centres)))
        some = norm > 0
        cos[some] = (small[some] / norm[some][:, None]) @ self.centres[:, :-1].T
        angle = np.arccos(np.clip(cos, -1, 1))
        with np.errstate(over="ignore", invalid="ignore"):
            most = norm * unit * self.radius * self.unit
            slack = 1e-6 * most[:, None] + 1
            low = most[:, None] * np.cos(np.minimum(math.pi, angle + self.cover)) - slack
            high = most[:, None] * np.cos(np.maximum(0, angle - self.cover)) + slack
        # Products that overflow a double bound nothing.
        return np.where(np.isnan(low), -np.inf, low), np.where(np.isnan(high), np.inf, high)

    def fits(self, q: np.ndarray) -> bool:
        """Whether doubles hold every product exactly."""
        return self.top * np.abs(q).max(initial=0) * max(1, q.shape[1]) < 2.0**53

    def scores(self, leaf: int, q: np.ndarray) -> np.ndarray:
        """Exact inner products of each row of q with a leaf's points: doubles hold them below 2^53, Python's integers any."""
        x = self.exact[self.begin[leaf]:self.end[leaf]]
        if self.fits(q):
            return q @ x.T
        points, asked = ([[int(v) for v in row] for row in m.tolist()] for m in (x, q))
        return np.array([[sum(a * b for a, b in zip(p, v, strict=True)) for p in points] for v in asked], object)


class Batch:
    """Anchors that meet a tree together: their node bounds, and the scores of each leaf once one of them opens it."""

    def __init__(self, tree: Tree, q: np.ndarray):
        self.tree, self.q, self.leaves = tree, q[:, :tree.x.shape[1]], {}
        self.low, self.high = tree.bounds(self.q)
        self.number = np.float64 if tree.fits(self.q) else object

    def scores(self, leaf: int, k: int) -> np.ndarray:
        if leaf not in self.leaves:
            self.leaves[leaf] = self.tree.scores(leaf, self.q)
        return self.leaves[leaf][k]


def search(batch: Batch, row: int, ids: list[list[int]], roots: list[int], windows: list[tuple[int, int]],
           k: int) -> list[list[tuple[int, int]]]:
    """The first k (score, id) of each window [lo, hi], by score descending, then id: best-first descent.

    ``row`` is the anchor's place in the batch; ``ids`` are those of the points in tree order.
    """
    tree, low, high = batch.tree, batch.low[row], batch.high[row]
    found: list[list[tuple[int, int]]] = [[] for _ in windows]
    # Scores below a window's floor can no longer enter it.
    floors = np.array([lo for lo, _ in windows], batch.number)
    tops = np.array([hi for _, hi in windows], floors.dtype)
    least, most = floors.min(), tops.max()
    heap = [(-high[r], r) for r in roots if high[r] >= least and low[r] <= most]
    heapq.heapify(heap)
    while heap:
        up, node = heapq.heappop(heap)
        if -up < least:
            break
        if tree.children[node]:
            for c in tree.children[node]:
                if high[c] >= least and low[c] <= most:
                    heapq.heappush(heap, (-high[c], c))
            continue
        s = batch.scores(node, row)
        at = np.flatnonzero((s >= least) & (s <= most))
        if not len(at):
            continue
        held = s[at]
        enters = (held[:, None] >= floors) & (held[:, None] <= tops)
        for w in np.flatnonzero(enters.any(0)).tolist():
            points, values = at[enters[:, w]], held[enters[:, w]]
            if len(points) > k:  # a point has one id at least; ties of the last score stay
                top = values >= np.sort(values)[-k]
                points, values = points[top], values[top]
            new = [(-int(v), i) for v, p in zip(values, points.tolist(), strict=True) for i in ids[tree.begin[node] + p]]
            found[w] = heapq.nsmallest(k, found[w] + new)
            if len(found[w]) == k:
                floors[w] = max(floors[w], -found[w][-1][0])
        least = floors.min()
    return [[(-s, i) for s, i in f] for f in found]


def _window(score: int, lo: int, hi: int) -> tuple[int, int]:
    """Scores s with ``lo * score <= 100 * s <= hi * score``."""
    return -((-lo * score) // 100), (hi * score) // 100


FOUND = "qid long, positive long, score long, id long"


def _search_blocks(same: bool, k: int, lo: int, hi: int):
    """Answers of each block: rows (block, kind, qid, label, vec, ids or scores), candidates before anchors."""
    names = ["qid", "positive", "score", "id"]

    def clamp(v: int) -> int:
        return max(-LONG - 1, min(LONG, v))

    def answer(tree: Tree, ids: list[list[int]], queries: list[tuple]) -> Iterator[pa.RecordBatch]:
        batch = Batch(tree, matrix([unpack(v) for _, _, v, _ in queries], tree.x.shape[1]))
        rows = []
        for k_, (qid, label, _, scores) in enumerate(queries):
            roots = [r for lab, r in tree.roots.items() if (lab == label) == same]
            if same:
                wins, key = [(-math.inf, math.inf)], [None]
            else:
                key = [s for s in dict.fromkeys(scores) if _window(s, lo, hi)[0] <= _window(s, lo, hi)[1]]
                wins = [_window(s, lo, hi) for s in key]
            if wins and roots:
                for p, f in zip(key, search(batch, k_, ids, roots, wins, k), strict=True):
                    rows += ((qid, p, clamp(s), i) for s, i in f)
        if rows:
            yield pa.record_batch([pa.array(c, pa.int64()) for c in zip(*rows, strict=True)], names=names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, points, tree, ids, queries = None, [], None, [], []
        for b in batches:
            for blk, kind, qid, label, vec, more in zip(*(b.column(c).to_pylist() for c in (
                    "block", "kind", "qid", "label", "vec", "more")), strict=True):
                if blk != block:
                    if queries:
                        yield from answer(tree, ids, queries)
                    block, points, tree, ids, queries = blk, [], None, [], []
                if kind == 0:
                    points.append((label, vec, more))
                    continue
                if not points:
                    continue
                if tree is None:
                    tree = Tree(matrix([unpack(v) for _, v, _ in points]), np.array([p[0] for p in points], np.int64))
                    ids = [points[r][2] for r in tree.order]
                queries.append((qid, label, vec, more))
                if len(queries) * len(points) >= CELLS or len(queries) == QUERIES:
                    yield from answer(tree, ids, queries)
                    queries = []
        if queries:
            yield from answer(tree, ids, queries)
    return run


def hard_negatives(vectors: DataFrame, anchors: Column, n_positives: int = 5, n_negatives: int = 10, lo: int = 30, hi: int = 90,
                   scale: float = 256, block_bytes: int = BLOCK_BYTES, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """anchor_id, positive_id, rank, negative_id, positive_score, negative_score.

    ``vectors`` has id, label and vec; ``anchors`` is the condition on id that
    makes a row an anchor.  The positives are its first other rows of the same
    label; a positive's negatives are the first rows of other labels whose score
    lies between ``lo`` and ``hi`` per cent of the positive's.
    """
    spark = vectors.sparkSession
    raw = vectors.select(F.col("id").cast("long").alias("id"), F.col("label").cast("long").alias("label"),
                         F.col("vec").cast("array<double>").alias("vec"))
    rows = materialise(raw.mapInArrow(_scaled(scale), "id long, label long, vec binary"), "mine-rows")
    # The first ids of each distinct (vector, label): no other row of it can be chosen before them.
    keep = max(n_positives + 1, n_negatives)
    filled = rows.withColumn("id", F.coalesce("id", F.lit(NO_ID)))
    order = Window.partitionBy("vec", "label").orderBy("id")
    first = filled.withColumn("rn", F.row_number().over(order)).where(F.col("rn") <= keep)
    points = materialise(first.groupBy("vec", "label").agg(F.sort_array(F.collect_list("id")).alias("more")), "mine-points")
    chosen = rows.where(anchors)
    asked = materialise(chosen.groupBy("vec", "label").agg(F.count(F.lit(1)).alias("n"))
                        .select(F.monotonically_increasing_id().alias("qid"), "vec", "label"), "mine-anchors")

    size = points.agg(F.count(F.lit(1)).alias("n"), F.coalesce(F.max(F.length("vec")), F.lit(1)).alias("w")).first()
    wide = size.n * size.w * 8  # padded to the widest vector, as doubles
    blocks = max(1, math.ceil(wide / block_bytes), min(default_partitions(spark), math.ceil(size.n / block_rows)))
    dealt = points.select(F.pmod(F.xxhash64("vec", "label"), F.lit(blocks)).cast("int").alias("block"), F.lit(0).alias("kind"),
                          F.lit(None).cast("long").alias("qid"), "label", "vec", "more")

    def ask(queries: DataFrame, same: bool, k: int) -> DataFrame:
        sent = queries.select(F.explode(F.sequence(F.lit(0), F.lit(blocks - 1))).alias("block"), F.lit(1).alias("kind"), "qid", "label",
                              "vec", "more")
        met = (dealt.unionByName(sent).repartition(min(blocks, 4 * default_partitions(spark)), "block")
               .sortWithinPartitions("block", "kind"))
        return met.mapInArrow(_search_blocks(same, k, lo, hi), FOUND)

    nothing = F.array().cast("array<long>")
    best = Window.partitionBy("qid").orderBy(F.desc("score"), "id")
    near = ask(asked.withColumn("more", nothing), True, n_positives + 1)
    near = near.withColumn("rn", F.row_number().over(best)).where(F.col("rn") <= n_positives + 1)
    positives = materialise(near.groupBy("qid").agg(F.sort_array(F.collect_list(F.struct("rn", "id", "score"))).alias("positives")),
                            "mine-positives")
    opened = asked.join(positives, "qid").withColumn("more", F.transform("positives", lambda p: p["score"]))
    best = Window.partitionBy("qid", "positive").orderBy(F.desc("score"), "id")
    far = ask(opened, False, n_negatives).withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= n_negatives)
    negatives = far.groupBy("qid").agg(F.collect_list(F.struct("positive", "rank", "id", "score")).alias("negatives"))
    answers = materialise(asked.join(positives, "qid").join(negatives, "qid").select("vec", "label", "positives", "negatives"), "mine-answers")

    # Of the class's first rows, an anchor leaves out itself.
    own = F.array_position(F.transform("positives", lambda p: p["id"]), F.col("id"))
    others = F.filter("positives", lambda p, i: i + 1 != F.col("own"))
    got = (chosen.withColumn("id", F.coalesce("id", F.lit(NO_ID))).join(answers, ["vec", "label"]).withColumn("own", own)
           .select("id", "negatives", F.explode(F.slice(others, 1, n_positives)).alias("p"))
           .select("id", "p", F.explode(F.filter("negatives", lambda n: n["positive"] == F.col("p")["score"])).alias("n")))

    def given(c: Column) -> Column:
        return F.when(c != NO_ID, c)
    return got.select(given(F.col("id")).alias("anchor_id"), given(F.col("p.id")).alias("positive_id"), F.col("n.rank").cast("int").alias("rank"),
                      given(F.col("n.id")).alias("negative_id"), F.col("p.score").alias("positive_score"), F.col("n.score").alias("negative_score"))
