"""Helpers shared by the training-data operators."""

from __future__ import annotations

import os

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import checkpoint_dir, scratch_path

#: A hot key is split over this many sub-keys.
SALTS = 64
#: A table is broadcast only when it was counted and holds at most this many narrow rows.
BROADCAST_ROWS = 1_000_000
#: Bytes of the rows that travel to a Python worker at a time: whole texts, so a number of rows bounds nothing.
BATCH_BYTES = 4 << 20
#: Internal columns start with this, so that columns of the caller cannot clash.
P = "__q_"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(os.path.join(sf_dir, f"{name}.parquet"))


def materialised(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint in the cluster's shared folder."""
    checkpoint_dir(df.sparkSession)
    return df.checkpoint()


def ready(spark: SparkSession) -> SparkSession:
    """Make the package importable on the workers, set the checkpoint folder and bound the batches that workers get."""
    checkpoint_dir(spark)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(BATCH_BYTES))
    return spark


def partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def numbered(df: DataFrame) -> DataFrame:
    """Rows with a handle; a table that has handles keeps them.

    The handles follow the splits of one scan. Two scans may be split
    differently (executors come and go), so whoever decides on handles and applies
    the decision to the rows afterwards starts from ``stored_numbered``.
    """
    return df if f"{P}row" in df.columns else df.withColumn(f"{P}row", F.monotonically_increasing_id())


def stored_numbered(df: DataFrame) -> DataFrame:
    """``numbered`` rows, written once to the cluster's shared folder: every later read sees the same handles."""
    spark = df.sparkSession
    path = scratch_path(spark, "numbered")
    numbered(df).write.parquet(path)
    return spark.read.parquet(path)


def salt(key: Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(key), F.lit(salts)).cast("int")


def salted_lookup(rows: DataFrame, found: DataFrame, keys: list[str], by: str, salts: int = SALTS) -> DataFrame:
    """Inner join of many ``rows`` with one row per key of ``found``, safe for hot keys.

    Each key is split by a hash of column ``by``; only the (key, salt) pairs
    that occur get a copy of the row found, so a key with a third of all rows
    is joined in ``salts`` parts and a rare key costs one copy.
    """
    s = f"{P}salt"
    rows = rows.withColumn(s, salt(F.col(by), salts))
    pairs = rows.select(*keys, s).distinct()
    return rows.join(pairs.join(found, keys), [*keys, s]).drop(s)


def without_rows(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``stored_numbered`` documents without the (checkpointed) row handles in ``dropped``.

    The handles are counted first: up to ``BROADCAST_ROWS`` they are broadcast
    and the texts stay where they are, beyond that both sides are shuffled.
    """
    if dropped.count() <= BROADCAST_ROWS:
        dropped = F.broadcast(dropped)
    return docs.join(dropped, f"{P}row", "left_anti").drop(f"{P}row")


def crc_mod(id_col: Column, mod: int) -> Column:
    """crc32 of the id as text, modulo ``mod``; a null id counts as empty text."""
    return F.crc32(F.coalesce(id_col.cast("string"), F.lit("")).cast("binary")) % mod


_KEPT: dict = {}


def kept_in_worker(key, make):
    """An object that a Python worker keeps between its tasks; only the one used last, so that memory stays bounded."""
    if key not in _KEPT:
        _KEPT.clear()
        _KEPT[key] = make()
    return _KEPT[key]


def let_go() -> None:
    """Called by a step that keeps nothing: what an earlier operator left in this worker goes."""
    _KEPT.clear()


class Memory:
    """What was worked out for a key, in two generations of at most ``size`` entries each.

    A full young generation becomes the old one and the old one is let go;
    entries still in use come back. Results never depend on it.
    """

    def __init__(self, size: int):
        self.size, self.young, self.old = size, {}, {}

    def get(self, key):
        got = self.young.get(key)
        if got is None:
            got = self.old.get(key)
            if got is not None:
                self.put(key, got)
        return got

    def put(self, key, value):
        if len(self.young) >= self.size:
            self.young, self.old = {}, self.young
        self.young[key] = value
