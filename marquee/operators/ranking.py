"""Order-dependent primitives that stay distributed under hot groups.

The reference relies on file order and on per-class sampling, which in SQL
is ``row_number() OVER (PARTITION BY class ORDER BY ...)``. With two classes
that window puts half of all rows into one task. Instead, positions are
computed in two levels:

1. each row gets a bucket that is monotone in its order key (the first hex
   digits of an md5 order key, or an equal-width slice of ``row_id``);
2. rows per ``(group, bucket)`` are counted (a small table, pre-aggregated
   map-side) and a prefix sum over buckets gives each bucket's offset;
3. the position is the offset plus ``row_number`` inside one bucket, whose
   size is group size / number of buckets.

The join of the small offsets table back to the rows is left to AQE, which
broadcasts it after measuring it at runtime and keeps the shuffle join
otherwise.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

HASH_BUCKET_HEX = 4  # 65,536 buckets


def hash_order(row_id: Column | str, seed: int) -> Column:
    """Deterministic pseudo-random order key, the same in Spark and DuckDB."""
    rid = F.col(row_id) if isinstance(row_id, str) else row_id
    return F.md5(F.concat(rid.cast("string"), F.lit(f":{seed}")))


def hash_bucket(order_key: Column) -> Column:
    return F.conv(F.substring(order_key, 1, HASH_BUCKET_HEX), 16, 10).cast("int")


def id_bucket(df: DataFrame, id_col: str, n_buckets: int = 1 << 16) -> DataFrame:
    """Adds ``_bucket``: equal-width slices of ``id_col`` (monotone in it).

    The bounds are one scalar subquery (a single partial/final aggregate).
    """
    bounds = df.agg(F.struct(F.min(id_col).alias("lo"), F.max(id_col).alias("hi"))).scalar()
    lo, hi = bounds.getField("lo"), bounds.getField("hi")
    # in doubles, which keep the order and cannot overflow on ids of the whole 64-bit range
    lo, hi = lo.cast("double"), hi.cast("double")
    width = F.greatest(F.ceil((hi - lo + 1) / F.lit(n_buckets)), F.lit(1))
    return df.withColumn("_bucket", F.floor((F.col(id_col).cast("double") - lo) / width).cast("long"))


def positions(df: DataFrame, group_cols: list[str], order_cols: list[str],
              bucket_col: str = "_bucket", out: str = "_pos") -> DataFrame:
    """0-based position of each row within its group by ``order_cols``.

    ``bucket_col`` must be monotone in ``order_cols`` within a group.
    """
    keys = [*group_cols, bucket_col]
    counts = df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n"))
    before = (W.partitionBy(*group_cols) if group_cols else W.partitionBy(F.lit(0))) \
        .orderBy(bucket_col).rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.select(*keys, F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    inner = W.partitionBy(*keys).orderBy(*order_cols)
    return (df.join(offsets, keys)
            .withColumn(out, F.col("_off") + F.row_number().over(inner) - 1)
            .drop("_off"))


def bucket_counts(df: DataFrame, class_col: str) -> DataFrame:
    """(class, _bucket, _n): combined map-side, at most 65,536 rows a class."""
    return df.groupBy(class_col, "_bucket").agg(F.count(F.lit(1)).alias("_n"))


def rows_at(df: DataFrame, counts: DataFrame, wanted: DataFrame, class_col: str,
            order_cols: list[str]) -> DataFrame:
    """The rows of ``df`` at the ``wanted`` (class, _p) 0-based positions.

    Only buckets that hold a wanted position are ranked. ``wanted`` has a few
    rows per class (a cut, k folds), so it and the buckets hit are broadcast.
    """
    before = W.partitionBy(class_col).orderBy("_bucket").rowsBetween(W.unboundedPreceding, -1)
    offsets = counts.withColumn("_off", F.coalesce(F.sum("_n").over(before), F.lit(0)))
    hit = (offsets.join(F.broadcast(wanted), class_col)
           .where((F.col("_p") >= F.col("_off")) & (F.col("_p") < F.col("_off") + F.col("_n")))
           .select(class_col, "_bucket", (F.col("_p") - F.col("_off") + 1).alias("_rank"))
           .groupBy(class_col, "_bucket").agg(F.collect_list("_rank").alias("_ranks")))
    inner = W.partitionBy(class_col, "_bucket").orderBy(*order_cols)
    ranked = (df.join(F.broadcast(hit), [class_col, "_bucket"])
              .withColumn("_rank", F.row_number().over(inner)))
    # a position wanted twice gives its row twice
    times = F.filter("_ranks", lambda r: r == F.col("_rank"))
    return ranked.where(F.size(times) > 0).withColumn("_at", F.explode(times)).select(*df.columns)


def numbered(df: DataFrame, order_col: str, out: str = "_pos") -> DataFrame:
    """0-based position by ``order_col`` (unique): sorted sampled ranges, then the
    rows before each range. The sorted rows are checkpointed, so that counts and
    rows come from the same ranges."""
    place = F.monotonically_increasing_id()   # partition in the upper bits, row in it in the lower 33
    rows = df.repartitionByRange(order_col).sortWithinPartitions(order_col).withColumn("_at", place).checkpoint()
    rows = rows.withColumn("_part", F.shiftright("_at", 33))
    before = W.partitionBy(F.lit(0)).orderBy("_part").rowsBetween(W.unboundedPreceding, -1)
    sizes = rows.groupBy("_part").agg(F.count(F.lit(1)).alias("_n"))
    # one row per partition
    offsets = sizes.select("_part", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_off"))
    pos = F.col("_off") + F.col("_at").bitwiseAND(F.lit((1 << 33) - 1))
    return rows.join(F.broadcast(offsets), "_part").withColumn(out, pos).drop("_part", "_off", "_at")


def group_sizes(df: DataFrame, group_cols: list[str], name: str = "_group_n") -> DataFrame:
    return df.groupBy(*group_cols).agg(F.count(F.lit(1)).alias(name))
