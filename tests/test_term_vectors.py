"""Term counts of word arrays, the fast class of non-space characters, features from written words."""

import re
from collections import Counter

import numpy as np
import pyarrow as pa
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions import text as T
from marquee.ml import features as FT
from marquee.ml import term_vectors as TV


def _rows(made):
    return [dict(zip(r["indices"], r["values"])) for r in made.to_pylist()]


def _want(rows, terms, grams):
    at = {t: i for i, t in enumerate(terms)}
    return [{at[g]: float(n) for g, n in sorted(Counter(grams(r or [])).items()) if g in at} for r in rows]


def test_word_and_character_counts_are_those_of_listed_terms(monkeypatch):
    rng = np.random.default_rng(4)
    rows = [[str(w) for w in rng.choice(["a", "bb", "éa", "c d"[0], "abcdef", "x\U00010400y"], rng.integers(0, 9))] for _ in range(60)] + [None, []]
    tokens = pa.array(rows, pa.list_(pa.string()))
    words = sorted({"a", "bb", "a a", "bb éa", "abcdef a bb", "never", "éa bb"})

    def ngrams(r):
        return [" ".join(r[i:i + n]) for n in (1, 2, 3) for i in range(len(r) - n + 1)]
    chars = sorted({g for r in rows if r for w in r for g in TV.char_grams(w, 3, 5)})[::2]
    for stretch in (3, 10**6):
        monkeypatch.setattr(TV, "STRETCH", stretch)
        assert _rows(TV._vectors(tokens, TV._Words(words, 3), len(words), False)) == _want(rows, words, ngrams)
        got = _rows(TV._vectors(tokens, TV._Chars(chars, 3, 5), len(chars), False))
        assert got == _want(rows, chars, lambda r: [g for w in r for g in TV.char_grams(w, 3, 5)])
    logs = _rows(TV._vectors(tokens, TV._Words(words, 1), len(words), True))
    assert logs[0] == {k: 1 + np.log(v) for k, v in _rows(TV._vectors(tokens, TV._Words(words, 1), len(words), False))[0].items()}


def test_fast_class_holds_what_is_no_space(spark):
    """Every code point between two letters, cut like the plain pattern cuts."""
    marks = re.findall(r"\\x\{(\w+)\}", P.WS)
    assert all(f"x{{{m}}}" not in P.NON_WS for m in marks)
    codes = [c for c in [*range(1, 0x3100), *range(0xFE00, 0x10000), 0x10400, 0x10FFFF] if not 0xD800 <= c <= 0xDFFF]
    df = spark.createDataFrame([(f"a{chr(c)}b",) for c in codes], "s string")
    plain = F.regexp_extract_all("s", F.lit(P.NON_WS_RUN), 0)
    assert df.where((T.ws_tokens("s") != plain) | (T.word_count("s") != F.size(plain))).count() == 0


def test_texts_are_cut_into_words_once(spark):
    """Features are fitted on some rows and made for all from written words and counts, like stage by stage."""
    texts = ["The cat, the dog", "a Cat's U.S. tour", None, "", "DOG eats cat food - now", "the the the cat"]
    df = spark.createDataFrame([(i, t, i % 2, i > 3) for i, t in enumerate(texts)], "row_id long, headline string, label int, is_test boolean")
    for cfg in (FT.SHIPPED, FT.CONFIGS["Optimized_v2_tokenized"], FT.CONFIGS["V3_char_grams"]):
        stages, feats = FT.fit_features(cfg, df, ~F.col("is_test"))
        assert "headline" not in feats.columns
        own = FT.build_pipeline(cfg).fit(df.where(~F.col("is_test"))).transform(df)
        want = {r["row_id"]: r["features"].toArray() for r in own.collect()}
        got = {r["row_id"]: r["features"].toArray() for r in feats.collect()}
        assert got.keys() == want.keys() and all(np.array_equal(got[k], want[k]) for k in want)
    grams = df.select(T.char_wb_ngrams("headline", 4, 6).alias("g"), T.char_wb_words("headline").alias("w")).collect()
    assert all(r["g"] == [g for w in r["w"] for g in TV.char_grams(w, 4, 6)] for r in grams)
