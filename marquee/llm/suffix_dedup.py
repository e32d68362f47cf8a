"""Substring dedup: bytes covered by a 200-byte string that starts anywhere else.

A corpus-wide suffix array would move every byte position of 100 TB. Here the
suffixes are dealt into buckets by content first, and each bucket is sorted.

1. Anchors. In every window of ``LENGTH`` bytes the ``GRAM``-byte substring
   with the smallest hash is its anchor. Equal windows have equal anchors at
   equal offsets, and neighbouring windows mostly share theirs, so windows
   form runs of one anchor (some 70 windows on average). A run is one row:
   hash of the anchor, digest of all bytes of the run, place.
2. An anchor that occurs once settles its run: no window in it is repeated.
   Runs that are equal as a whole are repeated as a whole. Both are counts
   with map-side combine; what is left are runs with an anchor that occurs
   elsewhere in other surroundings, the ends of repeated passages. One run
   for each different surrounding goes on.
3. Hash-compared suffix sort, bucket by bucket. Prefix polynomial hashes and
   binary search give the common extension of two suffixes in a logarithmic
   number of steps; with it as comparison a bottom-up mergesort orders the
   suffixes (all pairs of runs of a level at once, in numpy). Neighbours that
   share ``LENGTH`` bytes are compared byte by byte; should a hash have lied,
   the segment is sorted again by its bytes.
4. An anchor with more than ``BUCKET_RUNS`` different surroundings (a passage
   in a third of all documents has that at its ends) is never gathered: its
   windows become rows of a 128-bit digest, counted with map-side combine.

Repeated runs of a document are merged and cut out. Place lists are broadcast
up to a counted size, beyond it texts are shuffled by their key.

Defined cases: a null text is empty; texts under ``LENGTH`` bytes lose
nothing; copies lose everything; rows with one id are told apart by a hash of
the text (rows equal in both are copies and lose the same bytes).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import BROADCAST_ROWS, P, materialised, partitions, ready

LENGTH, GRAM = 200, 64
#: Different surroundings of one anchor that are sorted in one bucket; suffixes of about so many runs make a task.
BUCKET_RUNS, TASK_RUNS = 2_000, 8_000
#: Windows looked at together; longer texts are taken in such stretches.
STRETCH = 1 << 19
_BASE = 0x9E3779B97F4A7C15 | 1
_POS = 20  # bits of a position in a stretch


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of the base and of its inverse modulo 2**64."""
    inverse = pow(_BASE, -1, 1 << 64)
    out = []
    for x in (_BASE, inverse):
        p = np.full(n, x, np.uint64)
        p[0] = 1
        out.append(np.cumprod(p))
    return out[0], out[1]


_POW, _INV = _powers(STRETCH + 2 * LENGTH + 2)


def _prefix(b: np.ndarray, power: np.ndarray) -> np.ndarray:
    """Prefix polynomial hashes: entry i covers the first i bytes."""
    h = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * power[:len(b)], out=h[1:])
    return h


def _mixed(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0xBF58476D1CE4E5B9)
    h = (h ^ (h >> np.uint64(29))) * np.uint64(0x94D049BB133111EB)
    return h ^ (h >> np.uint64(32))


def _runs(b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(anchor hash, first window, number of windows) of the runs of one stretch."""
    h = _prefix(b, _POW)
    n = len(b) - GRAM + 1
    g = _mixed((h[GRAM:] - h[:-GRAM]) * _INV[:n])
    mask = np.uint64((1 << _POS) - 1)
    low = (g & ~mask) | np.arange(n, dtype=np.uint64)
    width, want = 1, LENGTH - GRAM + 1
    while 2 * width <= want:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if want > width:
        low = np.minimum(low[:width - want], low[want - width:])
    at = (low & mask).astype(np.int64)
    first = np.flatnonzero(np.concatenate(([True], at[1:] != at[:-1])))
    return g[at[first]].view(np.int64), first, np.diff(np.append(first, len(at)))


def _anchor_rows(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (kh, sh, dk, th, lo, n) of the runs of every text."""
    for batch in batches:
        kh, sh, row, lo, cnt = [], [], [], [], []
        for r, text in enumerate(batch.column(2)):
            raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
            for a in range(0, len(raw) - LENGTH + 1, STRETCH):
                part = raw[a:a + STRETCH + LENGTH - 1]
                k, first, n = _runs(np.frombuffer(part, np.uint8))
                # the digest covers all bytes of the run; the offset of the anchor follows from them
                s = [xxhash.xxh3_64_intdigest(part[f:f + c + LENGTH - 1], c) for f, c in zip(first.tolist(), n.tolist())]
                kh.append(k)
                sh.append(np.array(s, np.uint64).view(np.int64))
                lo.append(first + a)
                cnt.append(n)
                row.append(np.full(len(k), r))
        if not kh:
            continue
        row = pa.array(np.concatenate(row))
        yield pa.RecordBatch.from_arrays(
            [pa.array(np.concatenate(kh)), pa.array(np.concatenate(sh)), batch.column(0).take(row), batch.column(1).take(row),
             pa.array(np.concatenate(lo)), pa.array(np.concatenate(cnt).astype(np.int32))], ["kh", "sh", "dk", "th", "lo", "n"])


_PLACES = "array<struct<kh:bigint,c:bigint,hot:boolean,lo:bigint,n:int>>"


def _contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the runs asked for; of hot ones a digest per window instead."""
    names = ["kh", "c", "dk", "th", "lo", "n", "ctx", "h1", "h2"]
    types = [pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.binary(), pa.int64(), pa.int64()]

    def made(rows):
        return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows), types)], names)

    rows, size = [], 0
    for batch in batches:
        for dk, th, text, places in zip(*(c.to_pylist() for c in batch.columns)):
            raw = (text or "").encode("utf-8", "surrogatepass")
            for x in places:
                lo, n = x["lo"], x["n"]
                if x["hot"]:
                    for w in range(lo, lo + n):
                        d = xxhash.xxh3_128_digest(raw[w:w + LENGTH])
                        h1, h2 = np.frombuffer(d, np.int64).tolist()
                        rows.append((x["kh"], x["c"], dk, th, w, 1, None, h1, h2))
                else:
                    rows.append((x["kh"], x["c"], dk, th, lo, n, raw[lo:lo + n + LENGTH - 1], None, None))
                    size += n + LENGTH
                if len(rows) > 20_000 or size > 8 << 20:
                    yield made(rows)
                    rows, size = [], 0
    if rows:
        yield made(rows)


# --- the suffix sort of a bucket ----------------------------------------------------


class Suffixes:
    """Suffixes of a byte string, compared over ``LENGTH`` bytes by prefix polynomial hashes."""

    def __init__(self, text: np.ndarray, length: int = LENGTH):
        self.text, self.length = text, length
        power, self.inverse = (_POW, _INV) if len(text) < len(_POW) else _powers(len(text) + 1)
        self.hash = _prefix(text, power)

    def _same(self, a, b, n):
        h, inv = self.hash, self.inverse
        return (h[a + n] - h[a]) * inv[a] == (h[b + n] - h[b]) * inv[b]

    def common(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Length of the common extension, at most ``length``, by binary search."""
        low, high = np.zeros(len(a), np.int64), np.full(len(a), self.length, np.int64)
        whole = self._same(a, b, high)
        low[whole] = self.length
        while True:
            open_ = np.flatnonzero(low < high)
            if not len(open_):
                return low
            mid = (low[open_] + high[open_] + 1) // 2
            same = self._same(a[open_], b[open_], mid)
            low[open_[same]] = mid[same]
            high[open_[~same]] = mid[~same] - 1

    def less(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        n = self.common(a, b)
        end = n >= self.length
        n = np.minimum(n, self.length - 1)
        return ~end & (self.text[a + n] < self.text[b + n])

    def sort(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Order of the suffixes ``at`` by (segment, bytes): bottom-up mergesort, all runs of a width at once.

        ``segment`` is ascending. Each suffix finds its rank in the other run
        of its pair by binary search.
        """
        order = np.arange(len(at))
        start = np.searchsorted(segment, segment, "left")
        size = np.searchsorted(segment, segment, "right") - start
        k = np.arange(len(at)) - start
        width, most = 1, int(size.max(initial=0))
        while width < most:
            run = k // width
            other = (run ^ 1) * width
            low = np.minimum(other, size)
            first, high = low.copy(), np.minimum(other + width, size)
            left = (run & 1) == 0
            mine = at[order]
            while True:
                open_ = np.flatnonzero(low < high)
                if not len(open_):
                    break
                mid = (low[open_] + high[open_]) // 2
                theirs = mine[start[open_] + mid]
                x = mine[open_]
                # a left run goes before equal suffixes of the right run
                l_ = left[open_]
                before = self.less(np.where(l_, theirs, x), np.where(l_, x, theirs))
                before = np.where(l_, before, ~before)
                low[open_[before]] = mid[before] + 1
                high[open_[~before]] = mid[~before]
            to = start + (run & ~1) * width + k % width + (low - first)
            moved = np.empty_like(order)
            moved[to] = order
            order = moved
            width *= 2
        return order

    def repeated(self, at: np.ndarray, segment: np.ndarray) -> np.ndarray:
        """Which suffixes share ``length`` bytes with another one of their segment."""
        out = np.zeros(len(at), bool)
        if not len(at):
            return out
        order = self.sort(at, segment)
        a, b = at[order[:-1]], at[order[1:]]
        near = segment[order[:-1]] == segment[order[1:]]
        same = np.zeros(len(a), bool)
        same[near] = self.common(a[near], b[near]) >= self.length
        lied = set()
        for s in range(0, len(a), 65536):  # collisions: compare the bytes
            i = np.flatnonzero(same[s:s + 65536]) + s
            steps = np.arange(self.length)
            true = (self.text[a[i][:, None] + steps] == self.text[b[i][:, None] + steps]).all(axis=1)
            lied.update(segment[order[i[~true]]].tolist())
        out[order[:-1][same]] = True
        out[order[1:][same]] = True
        for g in lied:
            own = np.flatnonzero(segment == g)
            words = [self.text[p:p + self.length].tobytes() for p in at[own]]
            seen: dict[bytes, int] = {}
            for w in words:
                seen[w] = seen.get(w, 0) + 1
            out[own] = [seen[w] > 1 for w in words]
        return out


def _bucket(g: pd.DataFrame) -> pd.DataFrame:
    """Repeated windows of the runs of a bucket; runs that are repeated as a whole only serve as partners."""
    n = g["n"].to_numpy(np.int64)
    text = np.frombuffer(b"".join(g["ctx"]), np.uint8)
    begin = np.concatenate(([0], np.cumsum(n + LENGTH - 1)[:-1]))
    run = np.repeat(np.arange(len(g)), n)
    in_run = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
    at = begin[run] + in_run
    # equal windows have their anchor at one offset: only suffixes of one anchor and offset are compared
    s = Suffixes(text)
    anchor = np.array([_offset(c) for c in g["ctx"]], np.int64)
    group = pd.factorize(g["kh"])[0].astype(np.int64)[run] * (2 * LENGTH) + anchor[run] - in_run
    by = np.argsort(group, kind="stable")
    seg = group[by]
    alone = np.searchsorted(seg, seg, "right") - np.searchsorted(seg, seg, "left") < 2
    pick = by[~alone]
    again = np.zeros(len(at), bool)
    again[pick] = s.repeated(at[pick], group[pick])
    again[g["c"].to_numpy()[run] > 1] = False
    i = np.flatnonzero(again)
    new = np.concatenate(([True], (run[i][1:] != run[i][:-1]) | (i[1:] != i[:-1] + 1))) if len(i) else np.zeros(0, bool)
    first = i[new]
    count = np.diff(np.append(np.flatnonzero(new), len(i)))
    return pd.DataFrame({"dk": g["dk"].to_numpy()[run[first]], "th": g["th"].to_numpy()[run[first]],
                         "lo": g["lo"].to_numpy()[run[first]] + in_run[first], "n": count.astype(np.int32)})


def _offset(ctx: bytes) -> int:
    """Offset of the anchor that all windows of a run share."""
    b = np.frombuffer(ctx, np.uint8)
    h = _prefix(b, _POW)
    g = _mixed((h[GRAM:] - h[:-GRAM]) * _INV[:len(b) - GRAM + 1])
    n = len(b) - LENGTH + 1                       # windows; the anchor lies in all of them
    part = g[n - 1:LENGTH - GRAM + 1] & ~np.uint64((1 << _POS) - 1)
    return n - 1 + int(np.argmin(part))


# --- the plan -----------------------------------------------------------------------


def _keyed(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.withColumns({f"{P}dk": F.coalesce(F.col(id_col).cast("long"), F.lit(-(1 << 63))), f"{P}th": F.xxhash64(text)})


def _joined(docs: DataFrame, lists: DataFrame, total: int, how: str) -> DataFrame:
    """Texts with their place lists; the lists are broadcast only up to a counted number of places."""
    keys = [f"{P}dk", f"{P}th"]
    lists = lists.withColumnsRenamed({"dk": keys[0], "th": keys[1]})
    return docs.join(F.broadcast(lists) if total <= BROADCAST_ROWS else lists, keys, how)


def repeated_windows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(dk, th, lo, n): runs of windows of a text that start elsewhere too."""
    spark = ready(docs.sparkSession)
    src = _keyed(docs, id_col, text_col).select(F.col(f"{P}dk").alias("dk"), F.col(f"{P}th").alias("th"), F.col(text_col).alias("text"))
    anchors = src.mapInArrow(_anchor_rows, "kh long, sh long, dk long, th long, lo long, n int")
    often = anchors.groupBy("kh").agg(F.count(F.lit(1)).alias("m"), F.min("sh").alias("s1"), F.max("sh").alias("s2"))
    often = often.where("m > 1").select("kh", (F.col("s1") == F.col("s2")).alias("one"))
    # written first: with an exchange of its own on either side, a hot anchor is split by the skew join
    known = materialised(anchors.join(materialised(often), "kh"))
    whole = known.where("one").select("dk", "th", "lo", "n")
    mixed = known.where(~F.col("one")).drop("one")
    pick = F.xxhash64("dk", "th", "lo")
    kinds = mixed.groupBy("kh", "sh").agg(F.count(F.lit(1)).alias("c"), F.min(pick).alias("pick"))
    sizes = kinds.groupBy("kh").agg((F.count(F.lit(1)) > BUCKET_RUNS).alias("hot"))
    told = materialised(mixed.join(kinds.join(sizes, "kh"), ["kh", "sh"]))
    copies = told.where("c > 1").select("dk", "th", "lo", "n")
    ask = told.where(pick == F.col("pick")).groupBy("dk", "th").agg(
        F.collect_list(F.struct("kh", "c", "hot", "lo", "n")).cast(_PLACES).alias("places"))  # within one text: bounded by its length
    total = told.where(pick == F.col("pick")).count()
    got = materialised(_joined(src.withColumnsRenamed({"dk": f"{P}dk", "th": f"{P}th"}), ask, total, "inner").select(
        F.col(f"{P}dk").alias("dk"), F.col(f"{P}th").alias("th"), "text", "places").mapInArrow(
        _contexts, "kh long, c long, dk long, th long, lo long, n int, ctx binary, h1 long, h2 long"))
    tasks = max(partitions(spark), total // TASK_RUNS)
    cold = got.where("ctx is not null").withColumn("task", F.pmod(F.xxhash64("kh"), F.lit(tasks)))
    sorted_ = cold.groupBy("task").applyInPandas(_bucket, "dk long, th long, lo long, n int")
    hot = got.where("ctx is null")
    twice = hot.groupBy("h1", "h2").agg(F.count(F.lit(1)).alias("m"), F.max("c").alias("c")).where("m > 1 or c > 1").select("h1", "h2")
    hot = hot.where("c = 1").join(twice, ["h1", "h2"], "left_semi").select("dk", "th", "lo", "n")
    return whole.unionByName(copies).unionByName(sorted_).unionByName(hot)


def _merged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        starts, ends = [], []
        for spans in batch.column(2).to_pylist():
            out: list[list[int]] = []
            for s in sorted((x["lo"], x["lo"] + x["n"] - 1 + LENGTH) for x in spans):
                if out and s[0] <= out[-1][1]:
                    out[-1][1] = max(out[-1][1], s[1])
                else:
                    out.append(list(s))
            starts.append([x[0] for x in out])
            ends.append([x[1] for x in out])
        kind = pa.list_(pa.int64())
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(starts, kind), pa.array(ends, kind)], ["dk", "th", STARTS, ENDS])


STARTS, ENDS, KEPT, BYTES = f"{P}starts", f"{P}ends", f"{P}kept", f"{P}bytes"


def _cut(text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, size = [], []
            for text, starts, ends in zip(batch.column(text_at), batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)):
                raw = (text.as_py() or "").encode("utf-8", "surrogatepass")
                s, e = starts.as_py() or [], ends.as_py() or []
                kept.append(b"".join(raw[a:b] for a, b in zip([0, *e], [*s, len(raw)])) if s else raw)
                size.append(len(raw))
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(kept, pa.binary()), pa.array(size, pa.int64())],
                                             [*batch.schema.names, KEPT, BYTES])
    return run


def removed(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``docs`` with ``__q_starts`` and ``__q_ends`` (removed byte runs), ``__q_kept`` (bytes left) and ``__q_bytes``."""
    runs = repeated_windows(docs, id_col, text_col).groupBy("dk", "th").agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    runs = materialised(runs.mapInArrow(_merged, f"dk long, th long, {STARTS} array<bigint>, {ENDS} array<bigint>"))
    total = runs.agg(F.sum(F.size(STARTS))).first()[0] or 0
    out = _joined(_keyed(docs, id_col, text_col), runs, total, "left").drop(f"{P}dk", f"{P}th")
    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in out.schema) + f", {KEPT} binary, {BYTES} bigint"
    return out.mapInArrow(_cut(out.columns.index(text_col)), schema)
