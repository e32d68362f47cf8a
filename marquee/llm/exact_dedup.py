"""Exact dedup by skew-safe combining, in DataFrame operations only.

Three stages, each comparing whole texts next to their digest:

1. local: the map side of the first aggregate merges equal texts per task;
2. salted: rows meet under (digest, salt of the id), so a group with a third
   of all rows is merged in ``SALTS`` tasks;
3. global: the salt winners, at most ``SALTS`` per group, are combined.

Texts are grouped by digest and content. The winner is then looked up by
digest and a second hash; should both be equal for two texts, the job stops
with an error instead of merging them.

Defined cases: a null text counts as empty; empty texts form a group like any
other; a null id loses against any other id (``keep_id`` is null only if all
ids of the group are); of several rows with the smallest id the first in
table order is kept; other columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.llm.common import P, SALTS, materialised, numbered, salt, stored_numbered, without_rows

SPACE = r"[\x20\x09-\x0D]+"
ROW, DIG, SALT, NORM = f"{P}row", f"{P}digest", f"{P}salt", f"{P}norm"


def normalised(text: Column) -> Column:
    return F.regexp_replace(F.coalesce(text, F.lit("")), SPACE, " ")


def dedup_decisions(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: row handle, id, keep_id, group_size, kept, text_sha256."""
    docs = numbered(docs)
    texts = docs.select(F.col(ROW), F.col(id_col).alias("doc_id"), normalised(F.col(text_col)).alias(NORM))
    texts = texts.withColumns({DIG: F.sha2(NORM, 256), SALT: salt(F.col("doc_id"), SALTS)})
    salted = (texts.groupBy(DIG, SALT, NORM)
              .agg(F.min("doc_id").alias("keep_id"), F.count(F.lit(1)).alias("group_size")))
    whole = (salted.groupBy(DIG, NORM)
             .agg(F.min("keep_id").alias("keep_id"), F.sum("group_size").alias("group_size")))
    # a content mark beside the digest: equal digests with different texts stay apart
    whole = whole.withColumn(f"{P}mark", F.xxhash64(NORM)).drop(NORM)
    one = F.count(F.lit(1)) == 1
    clash = F.raise_error(F.lit("two texts share a 256-bit digest and a 64-bit hash")).cast("bigint")
    winners = whole.groupBy(DIG, f"{P}mark").agg(
        F.min("keep_id").alias("keep_id"), F.when(one, F.sum("group_size")).otherwise(clash).alias("group_size"))
    narrow = texts.withColumn(f"{P}mark", F.xxhash64(NORM)).drop(NORM)
    keys = [DIG, f"{P}mark"]
    pairs = narrow.select(*keys, SALT).distinct().join(winners, keys)
    rows = narrow.join(pairs, [*keys, SALT]).select(ROW, "doc_id", "keep_id", "group_size", F.col(DIG).alias("text_sha256"))
    rows = materialised(rows)
    # rows that carry the winning id more than once: only the first stays
    again = (rows.where(F.col("doc_id").eqNullSafe(F.col("keep_id"))).groupBy("text_sha256")
             .agg(F.min(ROW).alias(f"{P}first"), F.count(F.lit(1)).alias(f"{P}n")).where(F.col(f"{P}n") > 1).drop(f"{P}n"))
    again = materialised(again)
    first = F.lit(None).cast("long")
    if not again.isEmpty():
        rows = rows.join(again, "text_sha256", "left")
        first = F.col(f"{P}first")
    kept = F.col("doc_id").eqNullSafe(F.col("keep_id")) & F.coalesce(F.col(ROW) == first, F.lit(True))
    return rows.select(ROW, "doc_id", "keep_id", "group_size", kept.alias("kept"), "text_sha256")


def keep_first(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    docs = stored_numbered(docs)
    gone = dedup_decisions(docs, id_col, text_col).where(~F.col("kept")).select(ROW)
    return without_rows(docs, materialised(gone))
