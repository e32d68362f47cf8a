"""Toxicity by compression distance between two zstandard dictionaries.

Training, on labelled rows outside the held-out part, which are written once:

1. Spark counts in how many ordinary documents, and in how many different
   toxic texts, each word occurs (all rows of the dictionary part; copies of a
   toxic text count once). Passages are counted next: runs of two and three
   words without a toxic word, and in runs of letters over ``WINDOW``
   bytes (CJK, joined words) the strings of up to ``GRAMS`` bytes from every
   character on. The toxic passages that stand in a share ``SUPPORT`` of the
   toxic texts are taken by descending count, ``BLOCK`` at a time; each block is
   counted exactly in all ordinary documents, and what is far more frequent in
   toxic ones goes into the dictionary until it is full. Ordinary passages are
   chosen from ordinary text alone: every task keeps the ``HITTERS`` most frequent by
   the Misra-Gries rule (a passage more frequent than 1 in ``HITTERS`` cannot
   be missed), and the best of their sums are counted again exactly.
   The toxic dictionary holds words and passages that are far more frequent in
   toxic documents, the ordinary dictionary the most frequent
   words and passages of ordinary ones, each up to a fixed size, words behind passages
   and the strongest last, where references cost least. Both are zstandard
   dictionaries of raw content.
2. The other labelled rows, each text once, calibrate. A window is one word;
   long runs give overlapping cuts of ``WINDOW`` bytes, and strings that stand
   in the toxic dictionary; two or three neighbouring words are a window where
   the toxic dictionary holds them as a passage. A window, written twice, is
   compressed behind a fixed carrier with either dictionary. The pair of
   compressed lengths, with the length of the window and its number of words, is
   a cell; Spark counts the toxic and ordinary documents of every cell and the
   cell gets the log-ratio of the two rates, less two standard errors and 0 at least.
3. A document is as toxic as its ``TOP`` most toxic windows together. The
   threshold with the best F1 on the calibration part becomes score 0.3.

What leaves the executors is bounded by the dictionary sizes, a block of
passages, the summaries and the number of cells. Scoring reads every word of every
text and needs no shuffle.

Defined cases: null and empty texts have no window and score as the least
toxic window would; labels that are null are ignored, several labels of one
document count as toxic if any is; without both classes every score is 0.
"""

from __future__ import annotations

import heapq
import math
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import pyarrow as pa
import xxhash
import zstandard as zs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StructField, StructType

from marquee.llm.common import BROADCAST_ROWS, Memory, P, crc_mod, kept_in_worker, let_go, materialised, ready
from marquee.session import scratch_path

WINDOW = 32
#: Bytes of words in either dictionary, and of passages in each.
TOXIC_BYTES, ORDINARY_BYTES, PASSAGE_BYTES = 32 << 10, 128 << 10, 32 << 10
#: Bytes of the strings that are counted inside long runs of letters, at most.
GRAMS = (6, 12)
#: Share of the toxic texts that hold a passage of the dictionary, at least.
SUPPORT = 0.01
#: Toxic passages counted in the ordinary documents at a time; ordinary passages that a task remembers.
BLOCK, HITTERS = 1 << 16, 20_000
#: Windows that make up a document's score.
TOP = 2
#: A toxic word or passage: in at least so many different toxic texts, and so many times as frequent there as in ordinary documents.
LEAST, TIMES = 3, 20
THRESHOLD = 0.3
#: One labelled row in so many calibrates; the rest makes the dictionaries.
PARTS = 3
CARRIER = b"the of and that the of and that the of and that"
#: Windows remembered per worker and generation.
MEMORY = 120_000

_LETTERS = bytes(c if c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 else 32 for c in range(256))
#: A binary tree keeps 2^(chain_log - 1) places: more than the longer dictionary has bytes. The search goes far enough for words in sorted order.
_COMPRESS = zs.ZstdCompressionParameters(
    window_log=19, hash_log=17, chain_log=19, search_log=10, min_match=3, target_length=64,
    strategy=zs.STRATEGY_BTLAZY2, write_content_size=False, write_checksum=False, write_dict_id=False)


def _runs(text: str | None) -> list[bytes]:
    """The runs of letters and digits of a whole text."""
    return (text or "").lower().encode("utf-8", "surrogatepass").translate(_LETTERS).split()


def _cut(runs: list[bytes]) -> list[bytes]:
    if max(map(len, runs), default=0) > WINDOW:
        return [w[i:i + WINDOW] for w in runs for i in range(0, len(w), WINDOW)]
    return runs


def in_order(text: str | None) -> list[bytes]:
    """The single words of a whole text, long ones in cuts."""
    return _cut(_runs(text))


def _grams(run: bytes) -> set[bytes]:
    """Strings of whole characters, up to either size of ``GRAMS``, from every character of a long run on."""
    out, end = set(), len(run)
    for i in range(end):
        if run[i] & 0xC0 != 0x80:
            for size in GRAMS:
                j = i + size
                if j <= end:
                    while j < end and run[j] & 0xC0 == 0x80:
                        j -= 1
                    if j > i:
                        out.add(run[i:j])
    return out


def _passages(runs: list[bytes], known: frozenset[bytes]) -> set[bytes]:
    """Two and three neighbouring words, none of them long or ``known``, and the strings in long runs."""
    out = set()
    ws = [None if w in known or len(w) > WINDOW else w for w in runs]
    for p, a, b in zip([None, *ws], ws, ws[1:]):
        if a and b:
            two = a + b" " + b
            out.add(two)
            if p:
                out.add(p + b" " + two)
    for w in runs:
        if len(w) > WINDOW:
            out |= _grams(w)
    return out


def windows(text: str | None, toxic: "Passages | None" = None) -> set[bytes]:
    """The windows of a whole text: single words, overlapping cuts, and the passages of the toxic dictionary."""
    runs = _runs(text)
    out = set(_cut(runs))
    if max(map(len, runs), default=0) > WINDOW:
        for w in runs:
            if len(w) > WINDOW:
                out.update(w[i:i + WINDOW] for i in range(WINDOW // 2, len(w) - WINDOW // 2, WINDOW))
                if toxic and toxic.strings:
                    out |= _grams(w) & toxic.strings
    return out | toxic.among(runs) if toxic and toxic.first else out


class Passages:
    """Passages as they are looked up in the words of a text."""

    def __init__(self, passages):
        self.strings = frozenset(p for p in passages if b" " not in p)
        self.whole = frozenset(p for p in passages if b" " in p)
        self.first = frozenset(p[:p.index(b" ")] for p in self.whole)

    def among(self, runs: list[bytes]) -> set[bytes]:
        """The passages of two and three words that stand in these words."""
        out, whole = set(), self.whole
        for i in [i for i, w in enumerate(runs) if w in self.first]:
            for n in (2, 3):
                p = b" ".join(runs[i:i + n])
                if p in whole:
                    out.add(p)
        return out

    def of(self, runs: list[bytes]) -> set[bytes]:
        """All of the passages that a text holds."""
        out = self.among(runs) if self.first else set()
        if self.strings:
            for w in runs:
                if len(w) > WINDOW:
                    out |= _grams(w) & self.strings
        return out


@dataclass
class Model:
    toxic: bytes = b""
    ordinary: bytes = b""
    cells: dict[int, float] = field(default_factory=dict)
    threshold: float = math.inf
    passages: tuple[bytes, ...] = ()


def twice(w: bytes) -> bytes:
    """A window as dictionaries and lines hold it: written twice, so that a whole match saves a sequence over a part."""
    return b"%b %b " % (w, w)


class Lengths:
    """Compressed lengths of windows with either dictionary, remembered by window."""

    def __init__(self, toxic: bytes, ordinary: bytes):
        self.toxic, self.ordinary = self._with(toxic), self._with(ordinary)
        self.known = Memory(MEMORY)

    @staticmethod
    def _with(words: bytes):
        d = zs.ZstdCompressionDict(CARRIER + words, dict_type=zs.DICT_TYPE_RAWCONTENT)
        d.precompute_compress(compression_params=_COMPRESS)
        return zs.ZstdCompressor(dict_data=d, compression_params=_COMPRESS)

    def worked_out(self, w: bytes) -> int:
        line = b"%b %b" % (CARRIER, twice(w))
        return w.count(b" ") << 24 | len(self.ordinary.compress(line)) << 14 | len(self.toxic.compress(line)) << 4 | min(len(w), 15)

    def cell(self, w: bytes) -> int:
        got = self.known.get(w)
        if got is None:
            got = self.worked_out(w)
            self.known.put(w, got)
        return got


def _lengths(toxic: bytes, ordinary: bytes) -> "Lengths":
    """One memory per worker process and pair of dictionaries."""
    return kept_in_worker(("toxicity", toxic, ordinary), lambda: Lengths(toxic, ordinary))


def labelled(docs: DataFrame, labels: DataFrame, label: str, mod: int, held: int,
             id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(text, y, crc) of the rows to learn from: label known, crc32 of the id not in the held-out part."""
    keep = labels.where(F.col(label).isNotNull() & F.col("doc_id").isNotNull()).groupBy("doc_id").agg(
        F.max(F.col(label).cast("int")).alias("y"))
    keep = keep.where(crc_mod(F.col("doc_id"), mod) != held).withColumnRenamed("doc_id", f"{P}id")
    if labels.count() <= BROADCAST_ROWS:  # counted; beyond, both sides are shuffled by id
        keep = F.broadcast(keep)
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
    return src.join(keep, F.col("id") == F.col(f"{P}id")).select(
        "text", "y", F.crc32(F.col("id").cast("string").cast("binary")).alias("crc"))


def _count_words(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows (word, toxic text, ordinary documents): a row per word of a toxic text, one per word of the others."""
    let_go()
    counts: Counter = Counter()

    def out(ws, near, n):
        return pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array(near, pa.int64()), pa.array(n, pa.int64())], ["w", "near", "o"])

    for b in batches:
        for text, y in zip(b.column(0), b.column(1)):
            t = text.as_py()
            ws = set(in_order(t))
            if y.as_py() == 1:
                yield out(list(ws), [_digest(t)] * len(ws), [0] * len(ws))
            else:
                counts.update(ws)
        if len(counts) > 150_000:
            yield out(list(counts), [None] * len(counts), list(counts.values()))
            counts.clear()
    yield out(list(counts), [None] * len(counts), list(counts.values()))


def _digest(text: str | None) -> int:
    return xxhash.xxh64_intdigest((text or "").encode("utf-8", "surrogatepass")) >> 1


def _toxic_passages(known):
    """Rows (passage, toxic text)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        for b in batches:
            for text in b.column(0):
                t = text.as_py()
                ws = list(_passages(_runs(t), known.value))
                yield pa.RecordBatch.from_arrays([pa.array(ws, pa.binary()), pa.array([_digest(t)] * len(ws), pa.int64())], ["w", "near"])
    return run


def _only(wanted):
    """Rows (passage, documents) of the given passages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        passages, counts = Passages(wanted.value), Counter()
        for b in batches:
            for text in b.column(0):
                counts.update(passages.of(_runs(text.as_py())))
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["w", "o"])
    return run


def _documents(ordinary: DataFrame, passages: list[bytes]) -> dict[bytes, int]:
    """In how many documents each of a bounded number of passages stands."""
    sent = ordinary.sparkSession.sparkContext.broadcast(tuple(passages))
    rows = ordinary.mapInArrow(_only(sent), "w binary, o long").groupBy("w").agg(F.sum("o").alias("o")).collect()
    return {bytes(r["w"]): r["o"] for r in rows}


def _trimmed(counts: Counter, size: int) -> Counter:
    """The Misra-Gries rule: at most ``size`` entries, each less by the largest count that went."""
    if len(counts) <= size:
        return counts
    off = sorted(counts.values(), reverse=True)[size]
    return Counter({w: n - off for w, n in counts.items() if n > off})


def _hitters(known):
    """Rows (passage, documents at least) of the passages that are frequent in a task."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        counts: Counter = Counter()
        for b in batches:
            for text in b.column(0):
                counts.update(_passages(_runs(text.as_py()), known.value))
                if len(counts) > 6 * HITTERS:
                    counts = _trimmed(counts, HITTERS)
        counts = _trimmed(counts, HITTERS)
        yield pa.RecordBatch.from_arrays([pa.array(list(counts), pa.binary()), pa.array(list(counts.values()), pa.int64())], ["w", "o"])
    return run


def _chosen_passages(made: DataFrame, known: frozenset[bytes], n_toxic: int, n_ordinary: int) -> tuple[list[bytes], list[bytes]]:
    """Passages of the toxic and of the ordinary dictionary, the strongest first."""
    sent = made.sparkSession.sparkContext.broadcast(known)  # as many words as a dictionary holds
    least = max(LEAST, math.ceil(SUPPORT * n_toxic))
    few = made.where("y = 1").select("text").mapInArrow(_toxic_passages(sent), "w binary, near long").distinct()
    few = materialised(few.groupBy("w").agg(F.count("near").alias("t")).where(F.col("t") >= least))
    ordinary = made.where("y = 0").select("text")
    bad: list[bytes] = []
    rest = few
    while _size(bad) < PASSAGE_BYTES:
        block = [(bytes(r["w"]), r["t"]) for r in rest.orderBy(F.desc("t"), "w").limit(BLOCK).collect()]
        if not block:
            break
        o = _documents(ordinary, [w for w, _ in block])
        bad += [w for w, t in block if t / n_toxic > TIMES * (o.get(w, 0) + 0.5) / n_ordinary]
        w, t = block[-1]
        rest = few.where((F.col("t") < t) | (F.col("t") == t) & (F.col("w") > F.lit(bytearray(w))))
    held = set(bad)
    # a run of three words that holds a toxic run of two says no more
    bad = [w for w in bad if w.count(b" ") < 2 or not {w[:w.rindex(b" ")], w[w.index(b" ") + 1:]} & held]
    often = ordinary.mapInArrow(_hitters(sent), "w binary, o long").groupBy("w").agg(F.sum("o").alias("o"))
    best = [bytes(r["w"]) for r in often.orderBy(F.desc("o"), "w").limit(PASSAGE_BYTES // 4).collect()]
    n = _documents(ordinary, best) if best else {}
    return bad, sorted((w for w in n if w not in held), key=lambda w: (-n[w], w))


def _size(words: list[bytes]) -> int:
    return sum(2 * len(w) + 2 for w in words)


def _count_cells(words):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        *pair, passages = words.value
        kept, toxic = _lengths(*pair), Passages(passages)
        counts: tuple[Counter, Counter] = (Counter(), Counter())
        for b in batches:
            for text, y in zip(b.column(0), b.column(1)):
                counts[1 if y.as_py() == 1 else 0].update(set(map(kept.cell, windows(text.as_py(), toxic))))
        cs = list(counts[0].keys() | counts[1].keys())
        yield pa.RecordBatch.from_arrays(
            [pa.array(cs, pa.int64()), pa.array([counts[1][c] for c in cs], pa.int64()),
             pa.array([counts[0][c] for c in cs], pa.int64())], ["cell", "t", "o"])
    return run


class _Scorer:
    """Evidence of windows, remembered; the positive ones are few and kept apart."""

    def __init__(self, m: Model):
        self.lengths, self.toxic, self.of = Lengths(m.toxic, m.ordinary), Passages(m.passages), m.cells.get
        self.known: set[bytes] = set()                    # windows worked out, in two generations
        self.old: set[bytes] = set()
        self.positive: dict[bytes, float] = {}
        self.hot: set[bytes] = set()                      # its keys: two sets meet in the size of the smaller one

    def raw(self, text: str | None) -> float:
        ws = windows(text, self.toxic)
        if not ws:
            return -10.0
        if len(self.known) > MEMORY:
            self.old, self.known = self.known, set()
            self.positive = {w: e for w, e in self.positive.items() if w in self.old}
            self.hot = set(self.positive)
        new = ws.difference(self.known)
        for w in new.difference(self.old):
            e = self.of(self.lengths.worked_out(w), 0.0)
            if e > 0:
                self.positive[w] = e
                self.hot.add(w)
        self.known |= new
        return round(sum(heapq.nlargest(TOP, map(self.positive.__getitem__, ws & self.hot))), 2)


def _most_toxic(model, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        m: Model = model.value
        kept = kept_in_worker(("toxicity score", m.toxic, m.ordinary, tuple(m.cells.items())), lambda: _Scorer(m))
        for b in batches:
            yield pa.RecordBatch.from_arrays([*b.columns, pa.array([kept.raw(t.as_py()) for t in b.column(text_at)], pa.float64())], [*b.schema.names, RAW])
    return run


RAW = f"{P}raw"


def _raw(df: DataFrame, model: Model, text_col: str) -> DataFrame:
    sent = df.sparkSession.sparkContext.broadcast(model)  # as large as the two dictionaries and the cells
    schema = StructType([*df.schema.fields, StructField(RAW, DoubleType())])
    return df.mapInArrow(_most_toxic(sent, df.columns.index(text_col)), schema)


def _evidence(t: int, o: int, toxic: int, ordinary: int) -> float:
    """Log-ratio of a cell's two rates less two standard errors, 0 at least: the largest of many cells must not be the thinnest."""
    ratio = math.log((t + 0.2) / (toxic + 1)) - math.log((o + 2) / (ordinary + 1))
    return max(0.0, ratio - 2 * math.sqrt(1 / (t + 0.2) + 1 / (o + 2)))


def _fit(ranked: list[bytes], size: int) -> list[bytes]:
    """The strongest words that fit."""
    out, n = [], 0
    for w in ranked:
        n += 2 * len(w) + 2
        if n > size:
            break
        out.append(w)
    return out


def _packed(ranked: list[bytes], size: int) -> bytes:
    """The strongest words that fit, strongest last."""
    return b" " + b"".join(map(twice, reversed(_fit(ranked, size))))


def train(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 4, held: int = 2,
          id_col: str = "doc_id", text_col: str = "text") -> Model:
    spark = ready(docs.sparkSession)
    path = scratch_path(spark, "labelled")
    labelled(docs, labels, label, mod, held, id_col, text_col).write.parquet(path)
    rows = spark.read.parquet(path)
    part = F.pmod(F.floor(F.col("crc") / mod), F.lit(PARTS))
    made = rows.where(part != 0).select("text", "y")
    checked = rows.where(part == 0).groupBy(F.sha2("text", 256)).agg(F.max("text").alias("text"), F.max("y").alias("y")).select("text", "y")
    checked = materialised(checked)
    sizes = {r[0]: r[1] for r in made.groupBy("y").count().collect()}
    if not sizes.get(0) or not sizes.get(1):
        return Model()
    places = made.mapInArrow(_count_words, "w binary, near long, o long").groupBy("w", "near").agg(F.sum("o").alias("o"))
    words = materialised(places.groupBy("w").agg(F.count("near").alias("t"), F.sum("o").alias("o")))
    n_toxic = made.where("y = 1").select(F.xxhash64("text").alias("h")).distinct().count()
    often = (F.col("t") >= LEAST) & (F.col("t") / n_toxic > TIMES * (F.col("o") + 0.5) / sizes[0])

    def ranked(df: DataFrame, by: str, size: int) -> list[bytes]:
        # the shortest word takes 4 bytes: more words than that cannot be in a dictionary
        return [bytes(r["w"]) for r in df.orderBy(F.desc(by), "w").limit(size // 4).collect()]

    toxic = ranked(words.where(often), "t", TOXIC_BYTES)
    plain = ranked(words.where("o > 0"), "o", ORDINARY_BYTES)
    bad, usual = _chosen_passages(made, frozenset(toxic), n_toxic, sizes[0])
    bad = _fit(bad, PASSAGE_BYTES)
    pair = (_packed(bad, PASSAGE_BYTES) + _packed(toxic, TOXIC_BYTES), _packed(usual, PASSAGE_BYTES) + _packed(plain, ORDINARY_BYTES))
    cells = checked.mapInArrow(_count_cells(spark.sparkContext.broadcast((*pair, tuple(bad)))), "cell long, t long, o long")
    cells = cells.groupBy("cell").agg(F.sum("t").alias("t"), F.sum("o").alias("o")).collect()  # lengths only: bounded
    n = {r[0]: r[1] for r in checked.groupBy("y").count().collect()}
    if not n.get(0) or not n.get(1):
        return Model()
    model = Model(*pair, passages=tuple(bad), cells={r["cell"]: _evidence(r["t"], r["o"], n[1], n[0]) for r in cells})
    by = _raw(checked, model, "text").groupBy(RAW).agg(
        F.sum("y").alias("t"), F.count(F.lit(1)).alias("n")).orderBy(F.desc(RAW)).collect()  # sums of TOP logarithms to two places: bounded
    best, hit, said = -1.0, 0, 0
    for k, r in enumerate(by):
        if r[RAW] <= 0:  # nothing speaks for these documents
            break
        hit, said = hit + r["t"], said + r["n"]
        f1 = 2 * hit / (said + n[1])
        if f1 > best:
            best = f1
            # nearer to what is ordinary: a document may hold fewer toxic windows than those here
            model.threshold = (r[RAW] + 9 * by[k + 1][RAW]) / 10 if k + 1 < len(by) else r[RAW] - 1e-6
    return model


def scored(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``score``: the logistic of the raw value, 0.3 at the threshold."""
    if math.isinf(model.threshold):
        return docs.withColumn("score", F.lit(0.0))
    shift = math.log(THRESHOLD / (1 - THRESHOLD))
    z = F.col(RAW) - F.lit(model.threshold) + F.lit(shift)
    return _raw(docs, model, text_col).withColumn("score", F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).drop(RAW)


def without_toxic(docs: DataFrame, labels: DataFrame, label: str = "toxic", mod: int = 4, held: int = 2) -> DataFrame:
    """The rows of ``docs`` scored under the threshold, with all their columns."""
    model = train(docs, labels, label, mod, held)
    own = docs.withColumnRenamed("score", f"{P}score") if "score" in docs.columns else docs
    out = scored(own, model).where(F.col("score") < THRESHOLD).drop("score")
    return out.withColumnRenamed(f"{P}score", "score") if "score" in docs.columns else out
