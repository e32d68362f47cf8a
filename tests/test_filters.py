from pyspark.sql import functions as F

from testing_data import rows
from marquee.operators import filters as FL
from marquee.plans.prepare import prepare_headlines


def _keep(spark, texts, fn):
    df = rows(spark, enumerate(texts))
    return [r["headline"] for r in fn(df.withColumnRenamed("h", "headline")).orderBy("row_id").collect()]


def test_language_filter(spark):
    texts = ["El presidente dice que la casa de él está",
             "Police in Los Angeles arrest three suspects after freeway chase",
             "Los Angeles El Paso"]
    p1 = _keep(spark, texts, FL.language_pass1)
    assert texts[0] not in p1 and texts[1] in p1 and texts[2] in p1
    p2 = _keep(spark, p1, FL.language_pass2)
    assert p2 == [texts[1]]


def test_ratio_boundary_variants(spark):
    # 1 marker token in 6.25 -> use an exact 0.16 ratio: 4 markers in 25 tokens
    text = " ".join(["la"] * 4 + ["word"] * 21)
    assert _keep(spark, [text], lambda d: d.where(FL.keeps_ratio(F.col("headline"), True))) == [text]
    assert _keep(spark, [text], lambda d: d.where(FL.keeps_ratio(F.col("headline"), False))) == []


def test_length_bounds(spark):
    words = ["aaaaaaaaaaaaaaaaaaaaaaaaaaaaa bb cc", "aaaaaaaaaaaaaaaaaaaaaaaaaaaaa bb cc dd"]  # 3 and 4 words
    exact = ["x" * 19 + " b c d", "x" * 20 + " b c d", "x" * 134 + " b c d", "x" * 135 + " b c d"]
    assert [len(t) for t in exact] == [25, 26, 140, 141]
    kept = _keep(spark, ["x" * 18 + " b c d"] + exact + words, FL.length_filter)
    assert kept == [exact[0], exact[1], exact[2], words[1]]


def test_artifact_case_rules(spark):
    texts = ["x - Page 12", "Articles – x", "articles – x", "COMING UP ON x", "x - FOX News Radio",
             "x - fox news radio", "x - fox nation", "STREAM LIVE NEWS", "ok headline", None]
    kept = _keep(spark, texts, FL.artifact_filter)
    assert kept == ["articles – x", "x - fox news radio", "ok headline", None]


def test_prepare_first_row_wins_and_nulls(spark):
    h = "Same headline under both outlets here"
    df = spark.createDataFrame(
        [(1, "https://www.foxnews.com/a", h), (2, "https://nbcnews.com/b", h), (3, "https://nbcnews.com/c", None),
         (4, None, "A perfectly normal headline of decent size")], "row_id long, url string, headline string")
    out = {r["row_id"]: r["label"] for r in prepare_headlines(df).collect()}
    assert out == {1: 1, 4: 0}


def test_prepare_requires_url_or_source(spark):
    import pytest
    with pytest.raises(ValueError):
        prepare_headlines(spark.createDataFrame([(1, "x")], "row_id long, headline string"))


def test_funnel_single_pass(spark):
    df = spark.createDataFrame([(1, None, 0), (2, "short", 1), (3, "A perfectly normal headline of decent size", 1)],
                               "row_id long, headline string, label int")
    got = {r["stage"]: (r["n_rows"], r["n_class1"]) for r in FL.filter_funnel(df).collect()}
    assert got == {"null_headline": (1, 0), "length": (1, 1), "kept": (1, 1)}
