"""MinHash near-duplicates with tensored banding.

A document is the set of its distinct k-word shingles.  Documents with equal
sets are one node.  Two nodes are linked if ``intersection / union`` of their
sets is the threshold or more; the links' components are the groups.

Tensored banding: two small collections of ``m`` half keys (``r`` minima each)
are computed, and each of the ``m * m`` tables takes the pair of one half key
of either side.  That needs ``2 * m * r`` minima where plain banding of the
same tables needs ``m * m * 2 * r``.  ``m`` is chosen so that a pair at the
threshold shares no table with a probability of ``miss`` at most.

Links are verified on the full sets, and none is lost in a hot bucket:

1. Nodes that share no first half key with another share no table and leave.
2. In every table's bucket, each node is paired with the bucket's smallest
   node.  This is linear in the bucket, and copies of a text mostly join here.
3. The verified pairs' components are contracted to one point each; what the
   other pairs still join are clusters of components.  Inside a cluster all
   pairs that may link two components are compared: the cluster is cut into
   blocks by set size, and each pair of blocks whose sizes allow the threshold
   is one small task.  A block's pairs are counted inside the task and only a
   spanning forest, as pairs of components, leaves it.

Defined cases: null and empty texts, and texts without words, have an empty
set, are linked with nothing and are kept; fewer than k words are one shingle;
rows with equal doc_id are documents of their own that share an id; a null
doc_id is never the smallest; an empty table gives no rows; columns other than
doc_id and text are not read.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import drop_written, giving_back, join_small, lower_ascii, materialise, mix64, shingle_hashes, text_bytes, word_hashes, written
from tidemark.llm.components import connected_components

HALF = 3
BLOCK = 512
#: Bytes kept of a shingle's hash in a stored set.
WIDTH = 6


def half_keys(threshold: float, miss: float = 2e-4) -> int:
    """m with ``2 * (1 - threshold^HALF)^m <= miss``."""
    return math.ceil(math.log(miss / 2) / math.log(1 - threshold ** HALF))


def shingle_set(text: bytes, k: int) -> np.ndarray:
    """Sorted distinct shingle hashes."""
    return np.unique(shingle_hashes(word_hashes(lower_ascii(text)), k))


def _signatures(k: int, m: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        import xxhash

        seeds = np.arange(2 * m * HALF, dtype=np.uint64)
        a, b = mix64(seeds, 11) | np.uint64(1), mix64(seeds, 13)
        for batch in batches:
            nodes, sizes, firsts, seconds = [], [], [], []
            for text in text_bytes(batch.column("text")):
                s = shingle_set(text, k)
                sizes.append(len(s))
                nodes.append(xxhash.xxh3_64_intdigest(s.tobytes()) - 2**63 if len(s) else None)
                if not len(s):
                    firsts.append(None)
                    seconds.append(None)
                    continue
                with np.errstate(over="ignore"):
                    low = np.array([((s ^ y) * x).min() for x, y in zip(a, b, strict=True)], np.uint64)
                    low = low.reshape(2, m, HALF)
                    h = np.tile(np.arange(m, dtype=np.uint64), (2, 1))
                    for r in range(HALF):
                        h = mix64(h ^ low[:, :, r], 3)
                firsts.append(h[0].view(np.int64))
                seconds.append(h[1].view(np.int64))
            kind = pa.list_(pa.int64())
            yield pa.record_batch([batch.column("doc_id"), batch.column("thash"), pa.array(nodes, pa.int64()), pa.array(sizes, pa.int64()),
                                   pa.array(firsts, kind), pa.array(seconds, kind)],
                                  names=["doc_id", "thash", "node", "n_shingles", "first", "second"])
    return run


def _sets(k: int):
    """(node, set) of each text, the set as sorted WIDTH-byte numbers."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = []
            for text in text_bytes(batch.column("text")):
                s = np.sort(shingle_set(text, k) >> np.uint64(64 - 8 * WIDTH))
                sets.append(s.astype("<u8").view(np.uint8).reshape(-1, 8)[:, :WIDTH].tobytes())
            yield pa.record_batch([batch.column("node"), pa.array(sets, pa.binary())], names=["node", "shingles"])
    return run


def unpack(b: bytes) -> np.ndarray:
    raw = np.frombuffer(b, np.uint8).reshape(-1, WIDTH)
    out = np.zeros((len(raw), 8), np.uint8)
    out[:, :WIDTH] = raw
    return out.view("<u8").reshape(-1)


def linked(common: int, a: int, b: int, per_cent: int) -> bool:
    return 100 * common >= per_cent * (a + b - common)


def _verify(per_cent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last, hub = None, None
        for batch in batches:
            ok = []
            for u, x, y in zip(batch.column("u").to_pylist(), batch.column("su"), batch.column("sv"), strict=True):
                if u != last:
                    last, hub = u, unpack(x.as_py())
                v = unpack(y.as_py())
                small, large = (hub, v) if len(hub) <= len(v) else (v, hub)
                if 100 * len(small) < per_cent * len(large):
                    ok.append(False)
                    continue
                at = np.searchsorted(large, small)
                at[at == len(large)] = 0
                ok.append(linked(int((large[at] == small).sum()), len(hub), len(v), per_cent))
            yield pa.record_batch([batch.column("u"), batch.column("v"), pa.array(ok, pa.bool_())], names=["u", "v", "ok"])
    return run


def verify(pairs: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """(u, v, ok): whether each pair's full sets reach the threshold."""
    with_v = pairs.join(sets.select(F.col("node").alias("v"), F.col("shingles").alias("sv")), "v")
    both = with_v.join(sets.select(F.col("node").alias("u"), F.col("shingles").alias("su")), "u")
    return both.select("u", "v", "su", "sv").mapInArrow(giving_back(_verify(per_cent)), "u long, v long, ok boolean")


def block_links(ids: list[int], roots: list[int], sets: list[np.ndarray], left: int, per_cent: int) -> list[tuple[int, int]]:
    """A spanning forest of the links between different components.

    The first ``left`` sets face the others, or each other if ``left`` covers
    all.  Common shingles are counted by matrix products over slices of the
    shingles that stand in two sets or more.
    """
    n = len(ids)
    sizes = np.array([len(s) for s in sets], np.int64)
    flat = np.concatenate(sets) if n else np.zeros(0, np.uint64)
    owner = np.repeat(np.arange(n), sizes)
    _, inverse, counts = np.unique(flat, return_inverse=True, return_counts=True)
    shared = counts[inverse] > 1
    column = (np.cumsum(counts > 1) - 1)[inverse[shared]]
    owner = owner[shared]
    right = 0 if left == n else left
    common = np.zeros((left, n - right), np.float32)
    order = np.argsort(column, kind="stable")
    column, owner = column[order], owner[order]
    width = 2048
    for start in range(0, int((counts > 1).sum()), width):
        lo, hi = np.searchsorted(column, [start, start + width])
        m = np.zeros((n, width), np.float32)
        m[owner[lo:hi], column[lo:hi] - start] = 1
        common += m[:left] @ m[right:].T
    total = sizes[:left, None] + sizes[None, right:] - common
    ok = 100 * common >= per_cent * total
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while parent.get(x, x) != x:
            parent[x] = parent.get(parent[x], parent[x])
            x = parent[x]
        return x

    out = []
    r = np.asarray(roots)
    ok &= r[:left, None] != r[None, right:]
    for i, j in zip(*np.nonzero(ok), strict=True):
        a, b = find(roots[i]), find(roots[j + right])
        if a != b:
            parent[a] = b
            out.append((ids[i], ids[j + right]))
    return out


def _compare_blocks(per_cent: int):
    def run(pdf: pd.DataFrame) -> pd.DataFrame:
        pdf = pdf.sort_values(["side", "node"])
        left = int((pdf.side == 0).sum())
        root = dict(zip(pdf.node.tolist(), pdf.root.tolist(), strict=True))
        links = [(root[a], root[b]) for a, b in block_links(list(root), list(root.values()), [unpack(b) for b in pdf.shingles], left, per_cent)]
        return pd.DataFrame(links, columns=["u", "v"]).astype("int64")
    return run


def cluster_links(members: DataFrame, sets: DataFrame, per_cent: int) -> DataFrame:
    """(root, root) links of different components inside clusters; members: (node, root, cluster, n_shingles).

    A cluster's nodes are ranked by set size without gathering it: counts per
    (cluster, size) give each size its first block, and a hash spreads nodes of
    one size over that size's blocks.
    """
    rows = members
    # Size classes grow by a tenth, so that blocks hold comparable sizes.
    band = F.floor(F.ln(F.col("n_shingles").cast("double")) / math.log(1.1)).cast("int")
    rows = rows.withColumn("band", band)
    count = rows.groupBy("cluster", "band").agg(F.count(F.lit(1)).alias("n"), F.min("n_shingles").alias("smallest"),
                                                F.max("n_shingles").alias("largest"))
    blocks = count.select("cluster", "band", "smallest", "largest", F.ceil(F.col("n") / BLOCK).cast("int").alias("parts"))
    rows = materialise(rows.join(blocks.select("cluster", "band", "parts"), ["cluster", "band"])
                       .withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
                       .select("cluster", "band", "part", "node", "root"), "near-members")
    one = (rows.groupBy("cluster", "band", "part").agg(F.min("root").alias("lo"), F.max("root").alias("hi"))
           .join(blocks, ["cluster", "band"]))
    a, b = one.alias("a"), one.alias("b")
    pairs = (a.join(b, F.col("a.cluster") == F.col("b.cluster"))
             .where("a.band < b.band OR (a.band = b.band AND a.part <= b.part)")
             .where(100 * F.least("a.largest", "b.largest") >= per_cent * F.greatest("a.smallest", "b.smallest"))
             # Two blocks of one and the same component hold no open pair.
             .where("NOT (a.lo = a.hi AND b.lo = b.hi AND a.lo = b.lo)")
             .select(F.col("a.cluster").alias("cluster"), F.struct("a.band", "a.part").alias("x"), F.struct("b.band", "b.part").alias("y"))
             .withColumn("pair", F.xxhash64("cluster", "x", "y")))
    sides = pairs.select("cluster", "pair", F.lit(0).alias("side"), F.col("x").alias("at")).unionByName(
        pairs.where("x <> y").select("cluster", "pair", F.lit(1).alias("side"), F.col("y").alias("at")))
    jobs = (sides.select("cluster", "pair", "side", "at.band", "at.part").join(rows, ["cluster", "band", "part"])
            .join(sets, "node").select("cluster", "pair", "side", "node", "root", "shingles"))
    return jobs.groupBy("cluster", "pair").applyInPandas(_compare_blocks(per_cent), "u long, v long")


def near_duplicates(docs: DataFrame, per_cent: int = 80, k: int = 5) -> DataFrame:
    """doc_id, thash, n_shingles, component_id, kept of every row.

    ``thash`` is the text's hash, which with doc_id tells rows apart.
    """
    spark = docs.sparkSession
    m = half_keys(per_cent / 100)
    id_type = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", "text", F.xxhash64("text").alias("thash"))
    signed = materialise(rows.mapInArrow(
        giving_back(_signatures(k, m)), f"doc_id {id_type}, thash long, node long, n_shingles long, first array<long>, second array<long>"),
        "near-signatures")
    nodes = signed.where("node is not null")
    # One row per node: the signature is the same for all of its documents.
    reps = (nodes.groupBy("node").agg(F.min(F.struct("doc_id", "thash")).alias("rep"), F.first("n_shingles").alias("n_shingles"),
                                      F.first("first").alias("first"), F.first("second").alias("second")))
    reps = materialise(reps, "near-nodes")
    halves = reps.select("node", F.explode("first").alias("half"))
    shared = halves.groupBy("half").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("half")
    open_nodes = materialise(halves.join(shared, "half", "left_semi").select("node").distinct(), "near-open")
    candidates = reps.join(open_nodes, "node", "left_semi")
    keys = F.flatten(F.transform("first", lambda a: F.transform("second", lambda b: F.xxhash64(a, b))))
    entries, entries_at = written(candidates.select("node", F.explode(keys).alias("key")), "near-entries")
    hubs = entries.groupBy("key").agg(F.min("node").alias("u"), F.max("node").alias("top")).where("u <> top").select("key", "u")
    stars = (entries.join(hubs, "key").where("node <> u").select("u", F.col("node").alias("v")).distinct())
    stars, stars_at = written(stars, "near-stars")
    drop_written(spark, entries_at)
    paired = stars.select(F.col("u").alias("node")).unionByName(stars.select(F.col("v").alias("node"))).distinct()
    chosen = reps.join(paired, "node", "left_semi").select("node", F.col("rep.doc_id").alias("id"), F.col("rep.thash").alias("th"), "n_shingles")
    chosen = materialise(chosen, "near-chosen")
    texts = join_small(rows, chosen.select("node", "id", "th"), (F.col("thash") == F.col("th")) & F.col("doc_id").eqNullSafe(F.col("id")), "inner")
    sets = texts.select("node", "text").mapInArrow(giving_back(_sets(k)), "node long, shingles binary").dropDuplicates(["node"])
    sets = materialise(sets, "near-sets")
    checked = materialise(verify(stars, sets, per_cent), "near-checked")
    drop_written(spark, stars_at)
    found = connected_components(checked.where("ok"))

    def rooted(df: DataFrame, node: str, name: str) -> DataFrame:
        at = found.select(F.col("node").alias(node), F.col("root").alias(name))
        return df.join(at, node, "left").withColumn(name, F.coalesce(name, node))

    apart = rooted(rooted(checked.where("NOT ok").select("u", "v"), "u", "ru"), "v", "rv").where("ru <> rv")
    apart = materialise(apart.select(F.col("ru").alias("u"), F.col("rv").alias("v")).distinct(), "near-apart")
    label = rooted(reps.select("node"), "node", "root")
    if not apart.isEmpty():
        clusters = connected_components(apart).select(F.col("node").alias("root"), F.col("root").alias("cluster"))
        members = rooted(chosen.select("node", "n_shingles"), "node", "root").join(clusters, "root")
        more = materialise(cluster_links(members, sets, per_cent), "near-more")
        if not more.isEmpty():
            merged = connected_components(more).select(F.col("node").alias("root"), F.col("root").alias("top"))
            label = label.join(merged, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    label = materialise(label, "near-roots")
    smallest = nodes.select("doc_id", "node").join(label, "node").groupBy("root").agg(F.min("doc_id").alias("component_id"))
    by_node = materialise(label.join(smallest, "root").select("node", "component_id"), "near-labels")
    out = signed.select("doc_id", "thash", "node", "n_shingles").join(by_node, "node", "left")
    component = F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("component_id"))
    return out.select("doc_id", "thash", "n_shingles", component.alias("component_id"), F.col("doc_id").eqNullSafe(component).alias("kept"))
