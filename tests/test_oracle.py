"""A fast subset of the DuckDB oracle comparison on sf0.001."""

import duckdb
import pytest

import __spark_entry__ as E
from testing_data import SF001

FAST = ["prepare_headlines", "page_headlines", "clean_headline", "style_features", "filter_funnel",
        "merge_corpus", "balance_classes", "stratified_folds", "chi2_style", "length_describe",
        "length_histogram", "tfidf_long", "vocab_index", "encode_tokens", "classification_report", "auc",
        "robust_accuracy", "tuning_summary", "knn_classify", "rss_titles", "char_ngrams"]


def _norm(v):
    if isinstance(v, float):
        return round(v, 6)
    if isinstance(v, bool):
        return int(v)
    return v


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in ["documents", "pages", "labels", "embeddings", "events", "conversations", "benchmark"]:
        c.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF001}/{t}.parquet')")
    return c


@pytest.mark.parametrize("name", FAST)
def test_query_matches_oracle(spark, con, name):
    df = E.queries()[name](spark, SF001)
    cols = sorted(df.columns)
    got = sorted(tuple(str(_norm(r[c])) for c in cols) for r in df.collect())
    rel = con.sql(E.oracle_sql()[name])
    ocols = rel.columns
    assert sorted(ocols) == cols
    idx = [ocols.index(c) for c in cols]
    exp = sorted(tuple(str(_norm(r[i])) for i in idx) for r in rel.fetchall())
    assert got == exp


def test_entry_smoke(spark):
    df = E.entry(spark)
    assert df.columns == ["row_id", "headline", "label"]
    assert df.count() >= 0


def test_every_query_registered_with_docs():
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert len(qs) >= 100
