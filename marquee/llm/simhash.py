"""SimHash near-duplicates by a binary trie self-join.

Fingerprints are the leaves of a binary trie. The self-join walks pairs of
nodes of one depth together, adds up the bits in which the two paths differ
and drops a pair as soon as the sum exceeds the allowed distance.

* The upper ``plan_bits`` levels are walked pair by pair on the skeleton of
  all prefixes, which has a fixed size. Each surviving pair of subtrees is a
  unit of work; a fingerprint is sent to the units of its subtree.
* A unit walks the lower levels on two sorted arrays (numpy, in chunks of
  node pairs, so memory does not follow the number of pairs).
* A unit returns no pairs: it merges linked fingerprints and returns one edge
  per fingerprint to the smallest one it reaches, at most one row per
  fingerprint and unit. Edges of all units are then combined by alternating
  large-star and small-star rounds, each checkpointed.

Equal fingerprints are merged before the join, so copies are never paired.

Defined cases: a null text counts as empty; no words give fingerprint zero,
linked like any other; a null id never names a component unless all its ids
are null; repeated rows share their component; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import P, let_go, materialised, numbered, partitions, salted_lookup, stored_numbered, without_rows

SHINGLE, MAX_BITS, SEED = 3, 3, 42
ROW = f"{P}row"
#: Depth at which subtrees become units of work, for up to so many fingerprints; deeper beyond (see plan_depth).
PLAN_BITS, UNIT_ROWS = 5, 1 << 22
#: Node pairs walked at a time in a unit.
CHUNK = 1 << 18
#: Two subtrees with at most so many pairs of leaves are compared leaf by leaf.
FEW = 8


def fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """SimHash of one text: bit set if it is set in over half of the shingle hashes."""
    words = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    k = min(shingle, len(words))
    starts = np.concatenate(([0], ends[:-1] + 1))[: len(words) - k + 1].tolist()
    h64 = xxhash.xxh64_intdigest
    n = len(starts)
    counts = np.zeros(64, np.int64)
    ends = ends[k - 1:].tolist()
    for a in range(0, n, 65536):  # bounded memory for very long texts
        h = np.fromiter((h64(line[s:e], SEED) for s, e in zip(starts[a:a + 65536], ends[a:a + 65536])), np.uint64)
        bits = np.unpackbits(h.view(np.uint8).reshape(-1, 8), axis=1, bitorder="little")
        counts += bits.sum(axis=0, dtype=np.int64)
    return int(np.packbits((2 * counts > n).astype(np.uint8), bitorder="little").view(np.uint64)[0])


def _fingerprint_batches(shingle: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            fps = [fingerprint(t, shingle) for t in b.column(2).to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), b.column(1), pa.array(np.array(fps, np.uint64).view(np.int64), pa.int64())],
                [ROW, "doc_id", "fp"])
    return run


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = SHINGLE) -> DataFrame:
    """(row handle, doc_id, fp as a signed long) of every document."""
    src = numbered(docs).select(ROW, F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"))
    return src.mapInArrow(_fingerprint_batches(shingle), f"{ROW} long, doc_id long, fp long")


# --- the trie self-join ------------------------------------------------------------


def plan_depth(n: int) -> int:
    """Depth of the skeleton: one rule for every size, so that a unit holds a bounded share."""
    depth = PLAN_BITS
    while n >> depth > UNIT_ROWS and depth < 14:
        depth += 1
    return depth


def skeleton_pairs(depth: int, budget: int) -> list[tuple[int, int, int]]:
    """Node pairs (a <= b, bits that differ) of the upper trie within the budget, level by level."""
    pairs = [(0, 0, 0)]
    for _ in range(depth):
        nxt = []
        for a, b, e in pairs:
            nxt.append((2 * a, 2 * b, e))
            nxt.append((2 * a + 1, 2 * b + 1, e))
            if e < budget:
                nxt.append((2 * a, 2 * b + 1, e + 1))
                if a != b:
                    nxt.append((2 * a + 1, 2 * b, e + 1))
        pairs = nxt
    return pairs


class _Trie:
    """Nodes of a sorted array of distinct fingerprints, level by level from ``depth``."""

    def __init__(self, keys: np.ndarray, depth: int):
        self.keys = keys
        self.first = [np.zeros(1, np.int64)]  # first leaf of each node of a level
        self.kids: list[np.ndarray] = []      # per node: index of the 0 child and the 1 child, -1 if absent
        for d in range(depth + 1, 65):
            pre = keys >> np.uint64(64 - d)
            new = np.flatnonzero(np.concatenate(([True], pre[1:] != pre[:-1])))
            parent = np.searchsorted(self.first[-1], new, "right") - 1
            kids = np.full((len(self.first[-1]), 2), -1, np.int64)
            kids[parent, (pre[new] & np.uint64(1)).astype(np.int64)] = np.arange(len(new))
            self.first.append(new)
            self.kids.append(kids)
            if len(new) == len(keys):
                break
        self.size = [np.diff(np.append(f, len(keys))) for f in self.first]


def _find(parent: np.ndarray, x: np.ndarray) -> np.ndarray:
    while True:
        up = parent[x]
        if np.array_equal(up, x):
            return x
        x = parent[up]


def _merge(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> None:
    """Union by smaller index, all links at once; repeated until every link is inside one set."""
    while len(a):
        a, b = _find(parent, a), _find(parent, b)
        open_ = a != b
        a, b = a[open_], b[open_]
        np.minimum.at(parent, np.maximum(a, b), np.minimum(a, b))


def trie_join(left: np.ndarray, right: np.ndarray | None, depth: int, err: int, budget: int):
    """Yield index pairs of leaves within the budget; ``right`` None joins a subtree with itself.

    Both arrays are sorted, distinct and share their first ``depth`` bits;
    ``err`` bits differ above.
    """
    own = right is None
    lt = _Trie(left, depth)
    rt = lt if own else _Trie(right, depth)
    last = min(len(lt.kids), len(rt.kids))
    stack = [(0, np.zeros(1, np.int64), np.zeros(1, np.int64), np.full(1, err, np.int8))]
    while stack:
        lvl, a, b, e = stack.pop()
        la, lb = lt.first[lvl], rt.first[lvl]
        na, nb = lt.size[lvl][a], rt.size[lvl][b]
        n = na * nb
        few = n <= FEW if lvl < last else np.ones(len(n), bool)
        if few.any():  # a handful of leaves, or one side has leaves only: compare the leaves
            n, w = n[few], nb[few]
            k = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            w = np.repeat(w, n)
            i, j = np.repeat(la[a[few]], n) + k // w, np.repeat(lb[b[few]], n) + k % w
            near = np.bitwise_count(lt.keys[i] ^ rt.keys[j]) <= budget
            if own:
                near &= i < j
            if near.any():
                yield i[near], j[near]
            a, b, e = a[~few], b[~few], e[~few]
        if not len(a):
            continue
        ka, kb = lt.kids[lvl][a], rt.kids[lvl][b]
        na, nb, ne = [], [], []
        for x in (0, 1):
            for y in (0, 1):
                ok = (ka[:, x] >= 0) & (kb[:, y] >= 0)
                if x != y:
                    ok &= e < budget
                    if own and x > y:
                        ok &= a != b
                na.append(ka[ok, x])
                nb.append(kb[ok, y])
                ne.append(e[ok] + np.int8(x != y))
        a, b, e = np.concatenate(na), np.concatenate(nb), np.concatenate(ne)
        for s in range(0, len(a), CHUNK):
            stack.append((lvl + 1, a[s:s + CHUNK], b[s:s + CHUNK], e[s:s + CHUNK]))


def _unit_edges(depth: int, budget: int, errs: dict[int, int]):
    empty = pd.DataFrame({"a": np.array([], np.int64), "b": np.array([], np.int64)})

    def run(g: pd.DataFrame) -> pd.DataFrame:
        unit = int(g["unit"].iloc[0])
        pa_, pb_ = unit >> depth, unit & ((1 << depth) - 1)
        keys = np.sort(g["fp"].to_numpy(np.int64).view(np.uint64))
        if pa_ == pb_:
            parts = trie_join(keys, None, depth, 0, budget)
            off = 0
        else:
            cut = int(np.searchsorted(keys >> np.uint64(64 - depth), np.uint64(pb_)))
            if cut in (0, len(keys)):
                return empty
            parts = trie_join(keys[:cut], keys[cut:], depth, errs[unit], budget)
            off = cut
        parent = np.arange(len(keys))
        for i, j in parts:
            _merge(parent, i, j + off)
        root = _find(parent, np.arange(len(keys)))
        linked = np.flatnonzero(root != np.arange(len(keys)))
        return pd.DataFrame({"a": keys[linked].view(np.int64), "b": keys[root[linked]].view(np.int64)})
    return run


def links(fps: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """Edges (a, b) whose closure links all distinct ``fp`` within ``max_bits`` bits."""
    n = fps.count()
    depth = plan_depth(n)
    pairs = skeleton_pairs(depth, max_bits)
    errs = {(a << depth) | b: e for a, b, e in pairs}
    of: list[list[int]] = [[] for _ in range(1 << depth)]
    for a, b, _ in pairs:
        of[a].append((a << depth) | b)
        if a != b:
            of[b].append((a << depth) | b)
    units = F.array(*[F.array(*[F.lit(u).cast("int") for u in us]) for us in of]) if depth <= 6 else None
    prefix = F.shiftrightunsigned("fp", 64 - depth).cast("int")
    if units is not None:
        sent = fps.select("fp", F.explode(F.element_at(units, prefix + 1)).alias("unit"))
    else:
        spark = fps.sparkSession
        plan = spark.createDataFrame([(p, us) for p, us in enumerate(of)], "prefix int, units array<int>")
        sent = fps.withColumn("prefix", prefix).join(F.broadcast(plan), "prefix").select("fp", F.explode("units").alias("unit"))
    return sent.groupBy("unit").applyInPandas(_unit_edges(depth, max_bits, errs), "a long, b long")


# --- connected components ----------------------------------------------------------


def components(edges: DataFrame) -> DataFrame:
    """(v, root) of every vertex of ``edges``; root is the smallest unsigned vertex.

    Alternating large-star and small-star: each round links vertices to the
    smallest neighbour they know, so paths shorten by half or better. Every
    round is a shuffle by vertex of at most the edges there are.
    """
    # signed order of (x xor the sign bit) is the unsigned order of x
    flip = F.lit(-(1 << 63))
    e = materialised(edges.select(F.col("a").bitwiseXOR(flip).alias("u"), F.col("b").bitwiseXOR(flip).alias("v"))
                     .where("u <> v").distinct())
    before = None
    while True:
        both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct()
        down = large.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        low2 = down.groupBy("u").agg(F.min("v").alias("m"))
        small = (down.join(low2, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
                 .unionByName(low2.select("u", F.col("m").alias("v"))).distinct())
        e = materialised(small)
        state = e.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if state == before:
            break
        before = state
    return e.groupBy("u").agg(F.min("v").alias("r")).select(
        F.col("u").bitwiseXOR(flip).alias("v"), F.col("r").bitwiseXOR(flip).alias("root"))


def near_components(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """(row handle, doc_id, fp, root fingerprint, component_id) of every document."""
    rows = materialised(fingerprints(docs, id_col, text_col, shingle))
    ids = materialised(rows.groupBy("fp").agg(F.min("doc_id").alias("low")))
    comp = components(links(ids.select("fp"), max_bits)).withColumnRenamed("v", "fp")
    rooted = ids.join(comp, "fp", "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    rooted = materialised(rooted)
    named = rooted.groupBy("root").agg(F.min("low").alias("component_id"))
    found = salted_lookup(rooted.select("fp", "root"), named, ["root"], "fp").select("fp", "root", "component_id")
    return salted_lookup(rows, found, ["fp"], ROW).select(ROW, "doc_id", "fp", "root", "component_id")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             shingle: int = SHINGLE, max_bits: int = MAX_BITS) -> DataFrame:
    """The rows of ``docs`` with one document left of each component: the smallest id, first in table order."""
    docs = stored_numbered(docs)
    near = materialised(near_components(docs, id_col, text_col, shingle, max_bits))
    stays = (near.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
             .agg(F.min(ROW).alias(ROW)).select(ROW))
    gone = near.select(ROW).join(stays, ROW, "left_anti")
    return without_rows(docs, materialised(gone))
