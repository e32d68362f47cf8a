"""Vocabularies, term statistics and TF-IDF in long (row, term, value) form.

Terms come from native array expressions (``functions.text``); everything
after ``explode`` is grouped aggregation. Vocabulary ties are broken by term
so results do not depend on partitioning. The vocabulary itself is bounded
by ``max_features``; AQE decides at runtime whether joins against it are
broadcast.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.operators import ranking as R


def explode_terms(docs: DataFrame, terms: Column, id_col: str = "row_id") -> DataFrame:
    """(row_id, term). ``explode_outer`` + null filter: a plain ``explode``
    makes the optimizer add a non-empty-array filter below the projection,
    which evaluates the whole term expression a second time."""
    return (docs.select(F.col(id_col).alias("row_id"), F.explode_outer(terms).alias("term"))
            .where(F.col("term").isNotNull()))


def explode_positions(docs: DataFrame, terms: Column, id_col: str = "row_id") -> DataFrame:
    """(row_id, pos, token) with 0-based positions (same optimizer note)."""
    return (docs.select(F.col(id_col).alias("row_id"), F.posexplode_outer(terms).alias("pos", "token"))
            .where(F.col("token").isNotNull())
            .select("row_id", F.col("pos").cast("long").alias("pos"), "token"))


def term_counts(docs: DataFrame, terms: Column, id_col: str = "row_id") -> DataFrame:
    """(row_id, term, tf) from an array-of-terms expression.

    Give ``docs`` clustered by ``id_col`` (``repartition(id_col)`` of the
    texts): then all terms of a row are counted in the task that made them and
    no (row, term) pair crosses the network."""
    return explode_terms(docs, terms, id_col).groupBy("row_id", "term").agg(F.count(F.lit(1)).alias("tf"))


def term_totals(docs: DataFrame, terms: Column) -> DataFrame:
    """(term, df, total) straight from term arrays: every occurrence counts for
    ``total``, every row's distinct terms for ``df``; one aggregate, combined
    map-side, without counts per row."""
    each = F.transform(terms, lambda t: F.struct(t.alias("term"), F.lit(0).alias("d"), F.lit(1).alias("t")))
    once = F.transform(F.array_distinct(terms),
                       lambda t: F.struct(t.alias("term"), F.lit(1).alias("d"), F.lit(0).alias("t")))
    x = docs.select(F.explode_outer(F.concat(each, once)).alias("_x")).where(F.col("_x").isNotNull())
    return x.groupBy(F.col("_x.term").alias("term")).agg(F.sum("_x.d").alias("df"), F.sum("_x.t").alias("total"))


def exploded(docs: DataFrame, terms: str, keep: list[str]) -> DataFrame:
    """(*keep, term) of an array column (same optimizer note as ``explode_terms``)."""
    return docs.select(*keep, F.explode_outer(terms).alias("term")).where(F.col("term").isNotNull())


def vocabulary(tc: DataFrame, max_features: int | None = None, min_df: int = 1) -> DataFrame:
    """The vocabulary of (row_id, term, tf) counts, see ``select_terms``."""
    stats = tc.groupBy("term").agg(F.count(F.lit(1)).alias("df"), F.sum("tf").alias("total"))
    return select_terms(stats, max_features, min_df)


def select_terms(stats: DataFrame, max_features: int | None = None, min_df: int = 1) -> DataFrame:
    """(term, df, total, idx): min_df filter, then the top ``max_features`` by
    total count (ties by term); ``idx`` numbers the kept terms alphabetically."""
    if min_df > 1:
        stats = stats.where(F.col("df") >= min_df)
    if max_features is not None:
        # at most max_features rows are left: one task numbers them
        stats = stats.orderBy(F.col("total").desc(), F.col("term")).limit(max_features)
        return stats.withColumn("idx", (F.row_number().over(W.orderBy("term")) - 1).cast("int"))
    # alphabetical index without a global window: bucket = first two UTF-8 bytes
    # (monotone in Spark's binary string order), then bucketed positions
    first2 = F.rpad(F.hex(F.substring(F.encode(F.col("term"), "UTF-8"), 1, 2)), 4, "0")
    keyed = stats.withColumn("_bucket", F.conv(first2, 16, 10).cast("int"))
    ranked = R.positions(keyed, [], ["term"])
    return ranked.select(*stats.columns, F.col("_pos").cast("int").alias("idx"))


def idf(vocab: DataFrame, n_docs: Column | int) -> DataFrame:
    """Smoothed idf = ln((1 + n) / (1 + df)) + 1."""
    n = F.lit(n_docs) if isinstance(n_docs, int) else n_docs
    return vocab.withColumn("idf", F.log((1 + n) / (1 + F.col("df"))) + 1)


def tfidf(tc: DataFrame, vocab_idf: DataFrame, sublinear: bool = False) -> DataFrame:
    """(row_id, term, idx, weight): tf (or 1 + ln tf) x idf, L2-normalized per row."""
    tf = (1 + F.log(F.col("tf"))) if sublinear else F.col("tf").cast("double")
    x = tc.join(vocab_idf.select("term", "idx", "idf"), "term").withColumn("_w", tf * F.col("idf"))
    # per-row norm as a window over one row's terms (bounded by its length)
    norm = F.sqrt(F.sum(F.col("_w") * F.col("_w")).over(W.partitionBy("row_id")))
    return x.select("row_id", "term", "idx", (F.col("_w") / norm).alias("weight"))


def token_frequency(tokens: DataFrame, min_freq: int = P.VOCAB_MIN_FREQ) -> DataFrame:
    """(token, n) over all rows, keeping tokens seen at least ``min_freq`` times."""
    return tokens.groupBy("token").agg(F.count(F.lit(1)).alias("n")).where(F.col("n") >= min_freq)


def vocab_index(tokens: DataFrame, min_freq: int = P.VOCAB_MIN_FREQ) -> DataFrame:
    """(token, idx, n): PAD=0, UNK=1, then frequent tokens in first-seen order.

    ``tokens`` is (row_id, pos, token); first seen = smallest (row_id, pos).
    The place (row_id, pos) is one decimal, row_id * 2^32 + pos, which a hash
    aggregate can minimise; tokens are combined map-side and ranked over sampled
    ranges. Needs a checkpoint folder (``session.checkpoint_dir``).
    """
    place = F.col("row_id").cast("decimal(20,0)") * F.lit(1 << 32).cast("decimal(10,0)") + F.col("pos")
    first = tokens.groupBy("token").agg(
        F.count(F.lit(1)).alias("n"), F.min(place).alias("_first")).where(F.col("n") >= min_freq)
    return R.numbered(first, "_first").select("token", (F.col("_pos") + 2).cast("int").alias("idx"), "n")


def encode(docs: DataFrame, tokens: Column, index: DataFrame, max_len: int = P.SEQ_LEN) -> DataFrame:
    """(row_id, pos, idx) for pos in [0, max_len): known -> idx, unknown -> 1, pad -> 0.

    Only the first ``max_len`` tokens of a row leave its array. Padding does
    not meet the index: its null keys would all go to one task. Needs a
    checkpoint folder (``session.checkpoint_dir``).
    """
    # written once, as it is read twice: the texts are many times larger
    docs = docs.select("row_id", F.slice(tokens, 1, max_len).alias("_head"), F.size(tokens).cast("long").alias("_n")).checkpoint()
    head = explode_positions(docs, F.col("_head"))
    coded = (head.join(index.select("token", "idx"), "token", "left")
             .select("row_id", "pos", F.coalesce(F.col("idx"), F.lit(P.UNK_INDEX)).alias("idx")))
    n = F.col("_n")
    pads = F.when(n < max_len, F.sequence(n, F.lit(max_len - 1).cast("long")))
    padding = docs.select("row_id", F.explode_outer(pads).alias("pos")).where(F.col("pos").isNotNull())
    return coded.unionByName(padding.select("row_id", "pos", F.lit(P.PAD_INDEX).alias("idx")))
