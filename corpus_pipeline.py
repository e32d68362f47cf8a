"""The corpus pipeline: toxicity, exact dedup, near dedup, decontamination, tokens.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. ``run`` writes each result to the shared scratch
folder and reads it again as the next stage's input, so a stage starts from
files and never recomputes its predecessors. Stages that decide on rows write
them with a handle first, so the decision holds however the files are split.

Defined cases: those of the operators; a table without labels loses nothing to
the first stage; repeated ids stay unless their texts are equal or near; an
empty table gives no rows; all but the last stage keep the columns of documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from marquee.llm import bpe, decontaminate, exact_dedup, simhash, toxicity
from marquee.llm.common import ready, table
from marquee.session import scratch_path

#: Words that a worker remembers while it encodes; ids do not depend on it.
REMEMBERED = 80_000
#: A stage of language models and classifiers cannot be expressed in SQL.
ORACLE_SQL = None


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.without_toxic(docs, table(ready(spark), sf_dir, "labels"))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.keep_first(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return simhash.keep_one(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.clean_documents(docs, table(ready(spark), sf_dir, "benchmark"))


def tokens(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    path = public_tokenizers.path("byte_bpe_50k.json")
    # executors come from four other stages: the workers remember less than in a run of their own
    return bpe.digests(bpe.encoded(docs.select("doc_id", "text"), path, memory=REMEMBERED).drop("text"))


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_copies),
    ("simhash_dedup", drop_near_copies),
    ("decontamination", drop_contaminated),
    ("bpe", tokens),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(ready(spark), sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        at = scratch_path(spark, f"pipeline-{name}")
        stage(spark, docs, sf_dir).write.parquet(at)
        docs = spark.read.parquet(at)
    return STAGES[-1][1](spark, docs, sf_dir)
