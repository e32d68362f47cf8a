"""Corpus operators: keep-first dedupe, anti join, balance, splits, folds, merge.

Every "keep the first row" is a grouped ``min(row_id)``: a hash aggregate that
is combined map-side, so a headline repeated across a third of the input still
ships one row per map task. Sampling and splitting order rows by an md5 key
of ``row_id`` and seed, so results are the same on any partitioning; the rows
themselves are only compared with one cut key per class, never shuffled.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions import text as T
from marquee.operators import ranking as R
from marquee.session import checkpoint_dir


def keep_first(df: DataFrame, keys: list[str], order_col: str = "row_id") -> DataFrame:
    """One row per key: the row with the smallest ``order_col`` (unique).

    Without further columns the aggregate is the result. Otherwise the keys
    are grouped by digest, on narrow rows, and the first rows are picked by
    their ``order_col``."""
    if set(df.columns) == {*keys, order_col}:
        return df.groupBy(*keys).agg(F.min(order_col).alias(order_col)).select(*df.columns)
    digests = [F.sha2(F.col(k).cast("string"), 256).alias(f"_d{i}") for i, k in enumerate(keys)]
    first = (df.select(order_col, *digests).groupBy(*[f"_d{i}" for i in range(len(keys))])
             .agg(F.min(order_col).alias(order_col)))
    return df.join(first.select(order_col), order_col, "left_semi").select(*df.columns)


def dedupe_first(df: DataFrame, col: str = "headline") -> DataFrame:
    return keep_first(df, [col])


def dedupe_exact(df: DataFrame, cols=("headline", "source")) -> DataFrame:
    return keep_first(df, list(cols))


def dedupe_normalized(df: DataFrame, col: str = "headline") -> DataFrame:
    """Drop empty normalized keys, then keep the first row per key."""
    keyed = df.withColumn("_key", T.dedupe_key(F.col(col))).where(F.col("_key") != "")
    return keep_first(keyed, ["_key"]).drop("_key")


def anti_join_base(new: DataFrame, base: DataFrame, col: str = "headline") -> DataFrame:
    """Rows of ``new`` whose normalized key is absent from ``base``.

    Keys meet as 256-bit digests, so no text is a shuffle key. Base keys are
    made distinct first (combined map-side), so a hot base key ships once per
    task; AQE broadcasts the key set when it is small and splits skewed
    partitions of ``new`` otherwise. A null headline has no key and stays."""
    digest = F.unhex(F.sha2(T.dedupe_key(F.col(col)), 256))
    base_keys = base.select(digest.alias("_key")).distinct()
    return new.withColumn("_key", digest).join(base_keys, "_key", "left_anti").drop("_key")


def _hash_cut(df: DataFrame, class_col: str, n_of, seed: int, id_col: str) -> "F.Column":
    """Boolean column: the row is among its class's first n in md5(row_id:seed) order.

    ``n_of(sizes)`` gives (class, _n) from the class sizes. Only ids and classes
    are ranked, and of these one bucket per class; null classes are never in.
    The narrow keys and the cuts (one row per class) are written once: ``df`` is
    evaluated for them and for its rows, not for every count in between."""
    checkpoint_dir(df.sparkSession)
    h = R.hash_order(id_col, seed)
    keys = (df.where(F.col(class_col).isNotNull())
            .select(F.col(class_col).alias("_class"), h.alias("_h"), F.col(id_col).alias("_id"))
            .withColumn("_bucket", R.hash_bucket(F.col("_h"))).checkpoint())
    counts = R.bucket_counts(keys, "_class")
    sizes = counts.groupBy("_class").agg(F.sum("_n").alias("_group_n"))
    wanted = n_of(sizes).select("_class", (F.col("_n") - 1).alias("_p"))
    cuts = R.rows_at(keys, counts, wanted, "_class", ["_h", "_id"]).checkpoint()
    cut = cuts.agg(F.map_from_entries(F.collect_list(
        F.struct("_class", F.struct("_h", "_id"))))).scalar()
    mine = F.struct(h.alias("_h"), F.col(id_col).alias("_id"))
    return F.coalesce(mine <= F.try_element_at(cut, F.col(class_col)), F.lit(False))


def balance_classes(df: DataFrame, class_col: str = "source", seed: int = P.SEED,
                    id_col: str = "row_id") -> DataFrame:
    """Down-sample every class to the size of the smallest one."""
    from pyspark.sql import Window as W

    def smallest(sizes):   # one row per class
        return sizes.withColumn("_n", F.min("_group_n").over(W.partitionBy(F.lit(0))))
    return df.where(_hash_cut(df, class_col, smallest, seed, id_col))


def sample_per_group(df: DataFrame, group_cols: list[str], k: int, seed: int = P.SEED,
                     id_col: str = "row_id") -> DataFrame:
    """Up to ``k`` pseudo-random rows per group (top-k window with partial limit)."""
    from pyspark.sql import Window as W
    w = W.partitionBy(*group_cols).orderBy(R.hash_order(id_col, seed), id_col)
    return df.withColumn("_rn", F.row_number().over(w)).where(F.col("_rn") <= k).drop("_rn")


def split_random(df: DataFrame, test_frac: float = 0.2, seed: int = P.SEED,
                 id_col: str = "row_id") -> DataFrame:
    """Adds ``is_test``: the first ceil(frac*n) rows in hash order are test."""
    whole = df.withColumn("_all", F.lit(0))
    return whole.withColumn("is_test", _hash_cut(whole, "_all", _share(test_frac), seed, id_col)).drop("_all")


def _share(frac: float):
    return lambda sizes: sizes.withColumn("_n", F.ceil(F.col("_group_n") * F.lit(frac)))


def split_stratified(df: DataFrame, label_col: str = "label", test_frac: float = 0.2,
                     seed: int = P.SEED, id_col: str = "row_id") -> DataFrame:
    """Adds ``is_test``: per label, the first ceil(frac*n_label) rows in hash order."""
    known = df.where(F.col(label_col).isNotNull())
    return known.withColumn("is_test", _hash_cut(known, label_col, _share(test_frac), seed, id_col))


def stratified_folds(df: DataFrame, k: int = 5, label_col: str = "label",
                     id_col: str = "row_id") -> DataFrame:
    """Adds ``fold`` in [0, k): unshuffled stratified k-fold assignment.

    Labels are laid out sorted; fold ``i`` takes every k-th position starting
    at ``i``, which fixes how many rows of each class it gets; within a class
    rows fill folds 0, 1, ... in ``id_col`` order.
    """
    from pyspark.sql import Window as W
    known = df.where(F.col(label_col).isNotNull())
    checkpoint_dir(df.sparkSession)
    keys = R.id_bucket(known.select(F.col(label_col).alias("_class"), F.col(id_col).alias("_id")), "_id").checkpoint()
    counts = R.bucket_counts(keys, "_class")
    sizes = counts.groupBy("_class").agg(F.sum("_n").alias("_n"))
    start = F.coalesce(F.sum("_n").over(W.orderBy("_class").rowsBetween(W.unboundedPreceding, -1)), F.lit(0))
    classes = sizes.select("_class", "_n", start.alias("_s"))  # one row per class

    def per_fold(i: int):
        a, b = F.col("_s"), F.col("_s") + F.col("_n")
        return F.floor((b - 1 - i) / k) - F.floor((a - 1 - i) / k)

    ends = [per_fold(0)]
    for i in range(1, k - 1):
        ends.append(ends[-1] + per_fold(i))
    # the first row of every later fold; a row's fold is the number of these at or before it
    wanted = classes.select("_class", F.posexplode(F.array(*ends)).alias("_i", "_p"))
    cuts = R.rows_at(keys, counts, wanted, "_class", ["_id"]).checkpoint()
    cut = (cuts.groupBy("_class").agg(F.collect_list("_id").alias("_ids"))
           .agg(F.map_from_entries(F.collect_list(F.struct("_class", "_ids")))).scalar())
    mine = F.try_element_at(cut, F.col(label_col))
    passed = [F.coalesce(F.get(mine, F.lit(i)) <= F.col(id_col), F.lit(False)).cast("int") for i in range(k - 1)]
    return known.withColumn("fold", sum(passed[1:], passed[0]))


def label_base(base: DataFrame, marker: str = P.OUTLET_A_SITE, a: str = P.OUTLET_A,
               b: str = P.OUTLET_B) -> DataFrame:
    """Base corpus: drop null headlines, label from URL (case-insensitive regex)."""
    return (base.where(F.col("headline").isNotNull())
            .withColumn("source", T.source_from_url_ci(F.col("url"), marker, a, b)))


def merge_corpus(base: DataFrame, new: DataFrame, seed: int = P.SEED, marker: str = P.OUTLET_A_SITE,
                 a: str = P.OUTLET_A, b: str = P.OUTLET_B) -> DataFrame:
    """Exact dedupe and balance the new rows, drop those already in base
    (normalized key), and append them to the untouched base rows.

    ``base``: row_id, url, headline; ``new``: row_id, headline, source.
    Output: row_id, headline, source, origin ('base' | 'new').
    """
    labelled = label_base(base, marker, a, b)
    fresh = balance_classes(dedupe_exact(new.select("row_id", "headline", "source")), "source", seed)
    fresh = anti_join_base(dedupe_normalized(fresh), labelled)
    return (labelled.select("row_id", "headline", "source", F.lit("base").alias("origin"))
            .unionByName(fresh.select("row_id", "headline", "source", F.lit("new").alias("origin"))))


def day_ranges(df: DataFrame, start_col: str, end_col: str) -> DataFrame:
    """One row per calendar day d in [start, end]: ``after = d``, ``before = d + 1``."""
    days = F.explode(F.sequence(F.col(start_col), F.col(end_col), F.expr("INTERVAL 1 DAY")))
    rest = [c for c in df.columns if c not in (start_col, end_col)]
    return (df.select(*rest, days.alias("after"))
            .withColumn("before", F.date_add("after", 1)))


def query_grid(sources: DataFrame, topics=None, start: str = P.GRID_START,
               end: str = P.GRID_END) -> DataFrame:
    """Per source row: every topic x every day window (source, topic, after, before).

    Topics and days are generated per row with ``explode`` (no join).
    """
    tps = P.GRID_TOPICS if topics is None else topics
    with_topics = sources.select("*", F.explode(F.array(*[F.lit(t) for t in tps])).alias("topic"))
    bounded = with_topics.withColumn("_start", F.to_date(F.lit(start))).withColumn("_end", F.to_date(F.lit(end)))
    return day_ranges(bounded, "_start", "_end")
