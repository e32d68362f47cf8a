"""One query per operator of this subpackage, with production parameters, over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from marquee.llm import bpe, conversations, decontaminate, exact_dedup, language_id, licenses, quality, simhash, spelling, suffix_dedup, token_files, toxicity, url_filters
from marquee.llm.common import crc_mod, ready, table

QUERIES = {}
ORACLE_SQL: dict[str, str] = {}


def query(fn):
    QUERIES[fn.__name__] = fn
    return fn


@query
def op1_simhash_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    near = simhash.near_components(table(spark, sf_dir, "documents"))
    return near.select("doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


@query
def op2_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    return url_filters.judged(table(spark, sf_dir, "pages"), url_filters.rules_table(ready(spark)))


@query
def op3_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    found = decontaminate.contamination(docs, table(spark, sf_dir, "benchmark"))
    bad, hit = decontaminate.is_contaminated()
    return found.select(
        "doc_id", F.col(decontaminate.N).alias("n_words"), hit.alias("n_hit"),
        F.size(decontaminate.ITEMS).cast("long").alias("n_items"),
        F.sha2(F.array_join(decontaminate.ITEMS, ",").cast("binary"), 256).alias("items_sha256"), bad.alias("contaminated"))


@query
def op4_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = quality.train(docs, table(spark, sf_dir, "labels"))
    return quality.scored(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "score",
        (F.col("score") >= 0.5).cast("int").alias("predicted"))


@query
def op5_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = suffix_dedup.removed(table(spark, sf_dir, "documents").select("doc_id", "text"))
    length = F.aggregate(F.arrays_zip(F.col(suffix_dedup.STARTS).alias("s"), F.col(suffix_dedup.ENDS).alias("e")),
                         F.lit(0).cast("long"), lambda a, x: a + x["e"] - x["s"])
    return out.select(
        "doc_id", F.col(suffix_dedup.BYTES).alias("n_bytes"), F.coalesce(length, F.lit(0)).alias("n_removed"),
        F.coalesce(F.size(suffix_dedup.STARTS), F.lit(0)).cast("long").alias("n_spans"),
        F.sha2(suffix_dedup.KEPT, 256).alias("kept_sha256"))


@query
def op6_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    model = toxicity.train(docs, table(spark, sf_dir, "labels"))
    return toxicity.scored(docs, model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 4) == 2).alias("held_out"), "score",
        (F.col("score") >= toxicity.THRESHOLD).cast("int").alias("predicted"))


@query
def op7_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return bpe.digests(bpe.encoded(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text"))


@query
def op8_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text", "lang")
    model = language_id.train(docs)
    return language_id.predicted(docs.drop("lang"), model).select(
        "doc_id", (crc_mod(F.col("doc_id"), 3) == 1).alias("held_out"), "lang_pred", "score")


@query
def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = exact_dedup.dedup_decisions(table(spark, sf_dir, "documents"))
    return rows.select("doc_id", "keep_id", "group_size", "kept", "text_sha256")


@query
def op10_license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").select("doc_id", "text")
    return licenses.scan(docs).select(
        "doc_id", F.size(licenses._IDS).cast("long").alias("n_sentences"), F.array_join(licenses._IDS, " ").alias("sentence_ids"),
        F.size(licenses.FOUND).cast("long").alias("n_licences"), F.array_join(licenses.FOUND, ",").alias("licences"))


@query
def op11_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_files.written_and_read(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    return conversations.repaired_damage(table(ready(spark), sf_dir, "conversations"))


@query
def op13_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.spelling_variants(table(spark, sf_dir, "documents"))


ORACLE_SQL["op12_conversation_repair"] = conversations.ORACLE_SQL
ORACLE_SQL["op13_spelling_variants"] = spelling.ORACLE_SQL
ORACLE_SQL["op2_url_filters"] = url_filters.ORACLE_SQL
ORACLE_SQL["op10_license_scan"] = licenses.oracle_sql()
ORACLE_SQL["op9_exact_dedup"] = r"""
WITH t AS (SELECT doc_id, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]+', ' ', 'g') AS norm FROM documents)
SELECT doc_id, min(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size,
       doc_id = min(doc_id) OVER g AS kept, sha256(norm) AS text_sha256
FROM t WINDOW g AS (PARTITION BY norm)"""
