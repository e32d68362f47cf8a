"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

A benchmark item gives its windows of ``window`` consecutive words; an item
with fewer words is one window. All windows of one length form one search:

* a block of the last two words under the window end looks up the shift
  table; a block that no window holds lets the search skip almost a whole
  window, one that windows hold further left skips as far as that allows;
* shift zero leads to the bucket of windows that end in this block, split by
  the first block of the window;
* the windows left in the bucket are compared word by word.

The search tables are built on the driver from blocks of items whose text is
bounded by ``block_bytes`` and broadcast; more items mean more passes over
the documents (each pass carries the spans found so far), never a larger
broadcast. One pass needs no shuffle.

Defined cases: null and empty texts have no words; an item without words has
no window; items of one id count once; an item with a null id marks words but
is not listed; an empty benchmark leaves every document clean.
"""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, LongType, StringType, StructField, StructType

from marquee.llm.common import P, let_go, materialised, ready

WINDOW = 13
#: Benchmark text per broadcast block.
BLOCK_BYTES = 16 << 20
#: A document is contaminated if at least this share of its words is hit.
SHARE = 20

#: Every byte but digits, letters and non-ASCII bytes separates words; A-Z are lower-cased.
_WORDS = bytes((c + 32 if 65 <= c <= 90 else c) if c >= 128 or 48 <= c <= 57 or 65 <= c <= 90 or 97 <= c <= 122 else 32
               for c in range(256))


def words(text: str | None) -> list[bytes]:
    return (text or "").encode("utf-8", "surrogatepass").translate(_WORDS).split()


class Search:
    """Wu-Manber tables for windows of one length ``m`` (in words)."""

    def __init__(self, m: int, windows: dict[tuple[bytes, ...], list[str]]):
        self.m, self.block = m, min(2, m)
        b = self.block
        self.far = m - b + 1                      # shift of a block that no window holds
        self.shift: dict[tuple[bytes, ...], int] = {}
        self.bucket: dict[tuple[bytes, ...], dict[tuple[bytes, ...], list]] = {}
        for w, ids in windows.items():
            for q in range(b, m + 1):             # block ends after q words: it may move to the window end
                k = w[q - b:q]
                if m - q < self.shift.get(k, self.far):
                    self.shift[k] = m - q
            self.bucket.setdefault(w[m - b:], {}).setdefault(w[:b], []).append((w, ids))

    def run(self, ws: list[bytes], spans: list[tuple[int, int]], items: set[str]) -> None:
        m, b, far, shift, bucket = self.m, self.block, self.far, self.shift.get, self.bucket
        i, n = m, len(ws)                         # i: words up to the window end
        while i <= n:
            end = (ws[i - 2], ws[i - 1]) if b == 2 else (ws[i - 1],)
            s = shift(end, far)
            if s:
                i += s
                continue
            same = bucket[end].get(tuple(ws[i - m:i - m + b]))
            if same:
                here = tuple(ws[i - m:i])
                for w, ids in same:
                    if w == here:
                        items.update(ids)
                        if spans and spans[-1][1] >= i - m and spans[-1][0] <= i - m:
                            spans[-1] = (spans[-1][0], i)
                        else:
                            spans.append((i - m, i))
            i += 1


def searches(items: list[tuple[str | None, str | None]], window: int = WINDOW) -> list[Search]:
    """One search per window length that occurs."""
    by_len: dict[int, dict[tuple[bytes, ...], set[str]]] = {}
    for item_id, text in items:
        ws = words(text)
        if not ws:
            continue
        m = min(window, len(ws))
        for i in range(len(ws) - m + 1):
            ids = by_len.setdefault(m, {}).setdefault(tuple(ws[i:i + m]), set())
            if item_id is not None:
                ids.add(item_id)
    return [Search(m, {w: sorted(ids) for w, ids in by_len[m].items()}) for m in sorted(by_len)]


def merged(spans: list[tuple[int, int]]) -> list[tuple[int, int]]:
    out: list[tuple[int, int]] = []
    for s, e in sorted(spans):
        if out and s <= out[-1][1]:
            if e > out[-1][1]:
                out[-1] = (out[-1][0], e)
        else:
            out.append((s, e))
    return out


N, SPANS, ITEMS = f"{P}n_words", f"{P}spans", f"{P}items"
_SPAN = ArrayType(StructType([StructField("start", LongType()), StructField("end", LongType())]))


def _pass(tables, text_at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        let_go()
        found = tables.value
        for b in batches:
            last = b.num_columns - 3
            n_words, spans_out, items_out = [], [], []
            for text, old_spans, old_items in zip(b.column(text_at), b.column(last + 1), b.column(last + 2)):
                ws = words(text.as_py())
                spans, items = [], set()
                for s in found:
                    s.run(ws, spans, items)
                if old_spans.is_valid:
                    spans += [(x["start"], x["end"]) for x in old_spans.as_py()]
                    items.update(old_items.as_py())
                n_words.append(len(ws))
                spans_out.append([{"start": s, "end": e} for s, e in merged(spans)])
                items_out.append(sorted(items))
            cols = [*b.columns[:last], pa.array(n_words, pa.int64()),
                    pa.array(spans_out, b.schema.field(last + 1).type), pa.array(items_out, b.schema.field(last + 2).type)]
            yield pa.RecordBatch.from_arrays(cols, schema=b.schema)
    return run


def contamination(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
                  item_text_col: str = "text", window: int = WINDOW, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``docs`` with ``__q_n_words``, ``__q_spans`` (hit word ranges) and ``__q_items`` (ids as sorted strings)."""
    spark = ready(docs.sparkSession)
    items = benchmark.select(F.col(item_col).cast("string").alias("id"), F.col(item_text_col).alias("text"))
    total = items.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = max(1, -(-total // block_bytes))
    block = F.pmod(F.xxhash64("id", "text"), F.lit(blocks))
    out = docs.withColumns({N: F.lit(0).cast("long"), SPANS: F.lit(None).cast(_SPAN),
                            ITEMS: F.lit(None).cast(ArrayType(StringType()))})
    for k in range(blocks):
        rows = items.where(block == k).collect() if blocks > 1 else items.collect()  # about block_bytes of text
        tables = spark.sparkContext.broadcast(searches([(r[0], r[1]) for r in rows], window))
        out = out.mapInArrow(_pass(tables, docs.columns.index(text_col)), out.schema)
        if k + 1 < blocks:
            out = materialised(out)
    return out


def is_contaminated():
    hit = F.aggregate(SPANS, F.lit(0).cast("long"), lambda a, s: a + s["end"] - s["start"])
    return (hit > 0) & (SHARE * hit >= F.col(N)), hit


def clean_documents(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", **how) -> DataFrame:
    """The rows of ``docs`` that are not contaminated, with all their columns."""
    bad, _ = is_contaminated()
    return contamination(docs, benchmark, text_col, **how).where(~bad).select(*docs.columns)
