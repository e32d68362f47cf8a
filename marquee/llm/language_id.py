"""Language identification with bit-sliced Bloom filters.

One table of ``SLOTS`` words serves ``LANGUAGES`` languages: bit l of a slot
belongs to the Bloom filter of language l. More languages get further tables
(planes) with the same slots, one behind the other. Looking up an n-gram reads ``HASHES`` slots
and ands them, which returns every language whose filter holds the n-gram in
one go. A document adds up, per language, how many of its n-grams that filter
holds (a popcount per bit); filled slots let through some n-grams that were
never put in, so each count is corrected by the false-positive rate of its
filter, and the largest corrected count decides.

Training reads all documents with a language outside the held-out part: Spark
counts in how many documents of each language an n-gram occurs, keeps those
in at least ``SHARE`` of them, and merges slots by bitwise or. The table is
what leaves the executors, its size is fixed by the number of planes.

N-grams are the four-letter strings of each lower-cased word with a space on
either side. Defined cases: null texts and texts without a letter are
``und`` with score 0; a letter but no known n-gram gives the most frequent
language with score 0; equal counts give the first language by name; no
training rows give ``und``.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, StringType, StructField, StructType

from marquee.llm.common import crc_mod, ready

#: ``LANGUAGES``: languages of a plane, as many as an int64 has bits to spare.
GRAM, SLOTS, HASHES, SHARE, LANGUAGES = 4, 1 << 20, 4, 0.02, 62
#: Words remembered per worker; a full memory is emptied, results do not depend on it.
MEMORY, WORD_CHARS = 500_000, 48
#: Word characters without digits are letters but for number signs such as a half, roman numerals or circled ones.
_SIGNS = "".join(c for c in map(chr, range(0x80, 0x20000)) if c.isnumeric() and not c.isalpha() and not c.isdecimal())
_WORDS, _LETTERS = re.compile(r"[^\W\d_]+"), re.compile(rf"[^\W\d_{_SIGNS}]+")


def grams(word: str) -> list[str]:
    """N-grams of the letter runs in a lower-cased word, repeats included."""
    runs = _WORDS.findall(word)
    if not all(map(str.isalpha, runs)):  # few words: the set of all number signs is slow to match
        runs = _LETTERS.findall(word)
    out = []
    for run in runs:
        run = f" {run} "
        out += [run[i:i + GRAM] for i in range(max(1, len(run) - GRAM + 1))]
    return out


def slots(gram: str) -> list[int]:
    """Positions of an n-gram: two halves of one hash, combined."""
    h = xxhash.xxh64_intdigest(gram.encode("utf-8", "surrogatepass"), 7)
    a, b = h & 0xFFFFFFFF, (h >> 32) | 1
    return [(a + k * b) % SLOTS for k in range(HASHES)]


@dataclass
class Model:
    languages: list[str] = field(default_factory=list)
    usual: str = "und"
    table: np.ndarray = field(default_factory=lambda: np.zeros(SLOTS, np.int64))

    def rates(self) -> list[float]:
        """False-positive rate of each language's filter."""
        planes = self.table.reshape(-1, SLOTS)
        return [float(np.mean(planes[k // LANGUAGES] >> k % LANGUAGES & 1)) ** HASHES for k in range(len(self.languages))]


def _count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    counts: Counter = Counter()
    known: dict[str, tuple[str, ...]] = {}

    def out():
        keys = list(counts)
        return pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), pa.array([k[1] for k in keys], pa.string()),
             pa.array([counts[k] for k in keys], pa.int64())], ["lang", "gram", "n"])

    for b in batches:
        for text, lang in zip(b.column(0), b.column(1)):
            seen: set[str] = set()
            for w in set((text.as_py() or "").lower().split()):
                g = known.get(w)
                if g is None:
                    g = tuple(grams(w))
                    if len(w) <= WORD_CHARS:
                        if len(known) > MEMORY:
                            known.clear()
                        known[w] = g
                seen.update(g)
            name = lang.as_py()
            counts.update((name, g) for g in seen)
            if len(counts) > 500_000:
                yield out()
                counts.clear()
    yield out()


def _fill(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        at, bits = [], []
        for gram, bit, plane in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2).to_pylist()):
            at += [s + plane * SLOTS for s in slots(gram)]
            bits += [bit] * HASHES
        yield pa.RecordBatch.from_arrays([pa.array(at, pa.int64()), pa.array(bits, pa.int64())], ["slot", "bits"])


def train(docs: DataFrame, mod: int = 3, held: int = 1, id_col: str = "doc_id", text_col: str = "text",
          lang_col: str = "lang") -> Model:
    ready(docs.sparkSession)
    rows = docs.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull() & (crc_mod(F.col(id_col), mod) != held)).select(
        F.col(text_col).alias("text"), F.col(lang_col).alias("lang"))
    n = rows.groupBy("lang").count().orderBy(F.desc("count"), "lang").collect()  # a row per language
    if not n:
        return Model()
    sizes = {r["lang"]: r["count"] for r in n}
    langs = sorted(sizes)
    known = docs.sparkSession.createDataFrame(
        [(l, max(1.0, SHARE * sizes[l]), k // LANGUAGES, 1 << k % LANGUAGES) for k, l in enumerate(langs)], "lang string, least double, plane int, bit long")
    kept = rows.mapInArrow(_count, "lang string, gram string, n long").groupBy("lang", "gram").agg(F.sum("n").alias("n"))
    kept = kept.join(F.broadcast(known), "lang").where(F.col("n") >= F.col("least")).groupBy("gram", "plane").agg(F.bit_or("bit").alias("bits"))
    filled = kept.select("gram", "bits", "plane").mapInArrow(_fill, "slot long, bits long").groupBy("slot").agg(F.bit_or("bits").alias("bits"))
    model = Model(langs, n[0]["lang"], np.zeros(SLOTS * -(-len(langs) // LANGUAGES), np.int64))
    part = filled.toPandas()  # a row per slot and plane at most
    model.table[part["slot"].to_numpy(np.int64)] = part["bits"].to_numpy(np.int64)
    return model


FIELD = 40  # bits of one counter in the packed sums of a document


class Judge:
    def __init__(self, model: Model):
        self.model, self.rates = model, model.rates()
        self.of_gram: dict[str, int] = {}
        self.of_word: dict[str, int] = {}

    def _gram(self, g: str) -> int:
        """Packed counters of one n-gram: how many, and one field per language that holds it."""
        got = self.of_gram.get(g)
        if got is None:
            table, at, got = self.model.table, slots(g), 1
            for plane in range(len(table) // SLOTS):
                mask = -1
                for s in at:
                    mask &= int(table[s + plane * SLOTS])
                while mask:
                    low = mask & -mask
                    got += 1 << FIELD * (plane * LANGUAGES + low.bit_length())
                    mask ^= low
            if len(self.of_gram) > MEMORY:
                self.of_gram.clear()
            self.of_gram[g] = got
        return got

    def _word(self, w: str) -> int:
        got = sum(map(self._gram, grams(w)))
        if len(w) <= WORD_CHARS:
            if len(self.of_word) > MEMORY:
                self.of_word.clear()
            self.of_word[w] = got
        return got

    def __call__(self, text: str | None) -> tuple[str, float]:
        known, word = self.of_word, self._word
        total = sum([known[w] if w in known else word(w) for w in (text or "").lower().split()])
        low = (1 << FIELD) - 1
        n = total & low
        if not n or not self.model.languages:
            return "und", 0.0
        held = [total >> FIELD * (k + 1) & low for k in range(len(self.rates))]
        fair = [max(0.0, (x - n * p) / (1 - p)) if p < 1 else 0.0 for x, p in zip(held, self.rates)]
        best = max(fair)
        if best <= 0:
            return self.model.usual, 0.0
        return self.model.languages[fair.index(best)], best / sum(fair)


def predicted(docs: DataFrame, model: Model, text_col: str = "text") -> DataFrame:
    """``docs`` with ``lang_pred`` and ``score``; whole texts, no shuffle."""
    sent = docs.sparkSession.sparkContext.broadcast(model)  # a table of fixed size a plane
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        judge = Judge(sent.value)
        for b in batches:
            out = [judge(t.as_py()) for t in b.column(at)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, pa.array([x[0] for x in out], pa.string()), pa.array([x[1] for x in out], pa.float64())],
                [*b.schema.names, "lang_pred", "score"])
    return docs.mapInArrow(run, StructType([*docs.schema.fields, StructField("lang_pred", StringType()), StructField("score", DoubleType())]))
