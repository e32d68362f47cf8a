"""End-to-end headline preparation (the reference's ``prepare_data``).

read -> source from URL (or given source) -> drop null headline -> language
pass 1 -> language pass 2 -> length bounds -> page artifacts -> drop null
source -> keep first per headline -> 0/1 label.

All filters fold into one Filter above the headline's generator; the only
shuffle is the keep-first aggregate, a hash aggregate with two fixed-width
minima that combines map-side.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions import text as T
from marquee.operators import filters as FL


def with_source(df: DataFrame, marker: str = P.OUTLET_A_SITE, a: str = P.OUTLET_A,
                b: str = P.OUTLET_B) -> DataFrame:
    """A ``url`` column wins over any ``source`` column; one of them is required."""
    if "url" in df.columns:
        return df.withColumn("source", T.source_from_url(F.col("url"), marker, a, b))
    if "source" not in df.columns:
        raise ValueError("input must have either a 'url' or a 'source' column")
    return df


def prepare_headlines(df: DataFrame, marker: str = P.OUTLET_A_SITE, a: str = P.OUTLET_A,
                      b: str = P.OUTLET_B) -> DataFrame:
    """(row_id, headline, label) ready for featurisation."""
    h = F.col("headline")
    x = with_source(df, marker, a, b).select("row_id", "headline", "source")
    x = x.where(h.isNotNull()
                & ~FL.is_foreign_pass1(h)
                & FL.keeps_ratio(h)
                & FL.in_length_bounds(h)
                & ~FL.is_artifact(h)
                & F.col("source").isNotNull())
    # the first row's label is 1 when the first row of class 1 is the first of all
    is_one = T.encode_label(F.col("source"), a) == 1
    x = x.groupBy("headline").agg(F.min("row_id").alias("row_id"), F.min(F.when(is_one, F.col("row_id"))).alias("_one"))
    label = F.coalesce(F.col("_one") == F.col("row_id"), F.lit(False)).cast("int")
    return x.select("row_id", "headline", label.alias("label"))
