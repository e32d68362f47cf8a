"""Headline tables as files: CSV (the reference's interchange format) and parquet.

Reads use an explicit schema (no inference pass over the data) and RFC-4180
quoting, so headlines with commas, quotes and newlines survive a round trip.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

HEADLINE_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("source", T.StringType()),
])

_CSV = {"header": "true", "multiLine": "true", "quote": '"', "escape": '"',
        "ignoreLeadingWhiteSpace": "false", "ignoreTrailingWhiteSpace": "false"}


def read_headlines(spark: SparkSession, path: str, fmt: str = "csv",
                   schema: T.StructType | str | None = None) -> DataFrame:
    if fmt == "parquet":
        return spark.read.parquet(path)
    reader = spark.read.options(**_CSV).schema(schema or HEADLINE_SCHEMA)
    return reader.csv(path)


def write_headlines(df: DataFrame, path: str, fmt: str = "csv") -> None:
    """Overwrite ``path``; one file per task (no coalesce to a single writer)."""
    w = df.write.mode("overwrite")
    if fmt == "parquet":
        w.parquet(path)
    else:
        w.options(**_CSV).csv(path)
