"""Headline tables derived from the landed test tables (see FIXTURES.md).

These map the generic tables onto the reference's data model: a headline
table with a stable ``row_id`` (the reference depends on file order) and a
two-class source.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.session import table_path
from marquee.sources.pages import page_headlines

PAGE_MARKER = ".example.com"   # class A pages
CLASS_A, CLASS_B = "A", "B"
ASCII_LOWER = "abcdefghijklmnopqrstuvwxyz"
# what artifact pages carry before and behind their headline; the last kind is an ordinary page
ARTIFACT_MARKS = [("", " - Page 7"), ("Articles - ", ""), ("Coming up on ", ""), ("Video Site Map ", ""),
                  ("", " - FOX News Radio"), ("", " - Fox Nation"), ("", "")]


#: Bytes of a table's files whose texts are cut into terms in one task.
SHARE_BYTES = 4 << 20
TEXT_TABLES = {"documents", "pages", "conversations"}


def read(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Scan a landed table. Text tables are CPU-bound (regex per row); when a
    scan yields fewer partitions than cores (a single row group), rows are
    spread round-robin first. Large inputs already split into many file
    partitions and skip this."""
    df = spark.read.parquet(table_path(sf_dir, name))
    if name in TEXT_TABLES:
        cores = spark.sparkContext.defaultParallelism
        if df.rdd.getNumPartitions() < cores:
            df = df.repartition(cores)
    return df


def shares(spark: SparkSession, sf_dir: str, name: str) -> int:
    """Into how many partitions a landed table goes, ``SHARE_BYTES`` of its files in each."""
    files = spark.read.format("binaryFile").load(table_path(sf_dir, name))
    stored = files.agg(F.sum("length")).first()[0] or 0   # lengths only: no file is read
    return max(spark.sparkContext.defaultParallelism, -(-stored // SHARE_BYTES))


def page_heads(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, url, headline): first <h1> of every landed page."""
    pages = read(spark, sf_dir, "pages").select("page_id", "url", "html")
    return page_headlines(pages).select("row_id", "url", "headline")


def doc_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, headline, source): the whole text of each document; A = English."""
    d = read(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    return d.select(
        F.col("doc_id").alias("row_id"), F.col("text").alias("headline"),
        F.when(F.col("lang") == "en", F.lit(CLASS_A)).otherwise(F.lit(CLASS_B)).alias("source"))


def doc_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, headline, label): whole documents, label = English (learnable)."""
    h = doc_texts(spark, sf_dir)
    return h.select("row_id", "headline", (F.col("source") == CLASS_A).cast("int").alias("label"))


def marked_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, headline): every document with the mark of an artifact page put before or behind it, by row id."""
    d = doc_texts(spark, sf_dir)
    kind = F.pmod(F.col("row_id"), F.lit(len(ARTIFACT_MARKS)))
    marked = F.col("headline")
    for i, (before, behind) in enumerate(ARTIFACT_MARKS):
        marked = F.when(kind == i, F.concat(F.lit(before), "headline", F.lit(behind))).otherwise(marked)
    return d.select("row_id", marked.alias("headline"))


def base_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, url, headline): even-numbered documents, with a URL that carries
    the class. Base and new together cover every document."""
    h = doc_texts(spark, sf_dir).where(F.col("row_id") % 2 == 0)
    url = F.concat(F.when(F.col("source") == CLASS_A, F.lit("https://www.FoxNews.com/a/"))
                   .otherwise(F.lit("https://www.nbcnews.com/a/")), F.col("row_id").cast("string"))
    return h.select("row_id", url.alias("url"), "headline")


def new_corpus(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, headline, source): odd rows plus upper-cased, re-punctuated
    copies of every base row (these must fall to the normalized anti join)."""
    h = doc_texts(spark, sf_dir)
    odd = h.where(F.col("row_id") % 2 == 1).select("row_id", "headline", "source")
    copies = h.where(F.col("row_id") % 2 == 0).select(
        (F.lit(-1) - F.col("row_id")).alias("row_id"),   # negative: meets no real row at any size
        F.concat(F.translate(F.regexp_replace("headline", r"[.,]", ""), ASCII_LOWER, ASCII_LOWER.upper()),
                 F.lit("!")).alias("headline"),
        "source")
    return odd.unionByName(copies)


def fixed_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, label, score, prediction) from labels with a fixed score rule."""
    lab = read(spark, sf_dir, "labels")
    score = ((F.col("doc_id") * 37) % 101) / F.lit(100.0)
    return lab.select(F.col("doc_id").alias("row_id"), F.col("quality").alias("label"),
                      score.alias("score"), (score >= 0.5).cast("int").alias("prediction"))


def knn_vectors(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """(train, test) of embeddings: test = vec_id % 5 == 0."""
    e = read(spark, sf_dir, "embeddings").select("vec_id", "embedding", "label")
    return e.where(F.col("vec_id") % 5 != 0), e.where(F.col("vec_id") % 5 == 0)


def turn_train(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(row_id, headline, label): every conversation turn, label = assistant turn.

    The turn fills the low 32 bits of the id (a larger one is an error, never a
    collision), so ids of different conversations cannot meet."""
    c = read(spark, sf_dir, "conversations").select("conv_id", "turn", "role", "text")
    row_id = F.shiftleft(F.col("conv_id").cast("long"), 32) + F.col("turn").cast("int")
    return c.select(row_id.alias("row_id"), F.col("text").alias("headline"),
                    (F.col("role") == "assistant").cast("int").alias("label"))
