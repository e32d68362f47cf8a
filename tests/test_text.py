import re

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from testing_data import rows
from marquee.functions import patterns as P
from marquee.functions import text as T
from marquee.functions.style import style_columns

EDGE = ["Trump’s “plan” – $1,234.56 to U.S. b.", "$5 to win $10 bail", "$3M+ $2.5 Trillion £5 million",
        "foo..", "A. \n", "x.\x1f", "It Is A Title", "It's Title", "Trump's", "F-35 USA NASA ÉTÉ", "𝐀bc", "ǅ ß",
        "ﬁne ½ … ² naïve Ñandú", "a bb ccc  dddd", "", "   "]


def test_clean_headline_quirks(spark):
    got = dict(rows(spark, enumerate(EDGE + [None])).select("row_id", T.clean_headline(F.col("h"))).collect())
    assert got[0] == "trumps plan [money].56 to u.s. b [endperiod]"   # fold before punctuation, money remainder
    assert got[1] == "[money]o win [money]ail"                          # no trailing word boundary
    assert got[2] == "[money] [money] 5 million"                        # '+' eaten; £ folded away first
    assert got[3] == "foo. [endperiod]"                                 # only the last period
    assert got[5] == "x [endperiod]"                                    # \x1f is Python whitespace
    assert got[12] == "fine 12 ... 2 naive nandu"                       # one-to-many fold
    assert got[len(EDGE)] == ""                                         # null -> ""
    assert got[2 + 11] == "a bb ccc dddd" and got[14] == got[15] == ""    # white space collapses


def test_style_features_of_known_rows(spark):
    """Characters, dots, end dot, U.S., US, colon, capitals, all-caps words, quote, apostrophe, title case, hyphenated word."""
    known = {"U.S. wins: US cheers.": [21, 3, 1, 1, 1, 1, 4, 1, 0, 0, 0, 0],
             "It's Title": [10, 0, 0, 0, 0, 0, 2, 0, 1, 1, 0, 0],
             "F-35 USA NASA": [13, 0, 0, 0, 0, 0, 8, 3, 0, 0, 0, 1],
             'say "no"': [8, 0, 0, 0, 0, 0, 0, 0, 1, 0, 0, 0],
             "": [0] * 12}
    df = rows(spark, enumerate(known)).select("h", *style_columns("h"))
    for r in df.collect():
        assert [int(r[n]) for n in P.STYLE_FEATURES] == known[r["h"]], r["h"]


def test_title_case_and_allcaps(spark):
    r = {x[0]: x for x in rows(spark, enumerate(["It Is A Title", "Trump's", "F-35 USA NASA ÉTÉ", "𝐀bc"]))
         .select("row_id", *style_columns("h")).collect()}
    assert r[0]["is_title_case"] == 1 and r[1]["is_title_case"] == 0
    assert r[2]["n_allcaps"] == 4 and r[3]["n_allcaps"] == 0   # "F-35".isupper() is True


_ALPHABET = st.sampled_from(list("aAbZ .,'-$£€¥0123456789\t\n\x1c –—‘’“”éÉñÑ½ﬁ…ßǅ𝐀:[]_USé") + ["U.S.", "US", " - Page 3"])


@settings(max_examples=15, deadline=None)
@given(st.lists(st.lists(_ALPHABET, max_size=25).map("".join), min_size=20, max_size=20))
def test_random_strings_keep_the_rules(spark, texts):
    """Alphabet, idempotence and counts that SURVEY section 2 states, on random strings."""
    clean = T.clean_headline(F.col("h"))
    df = rows(spark, enumerate(texts)).select(
        "row_id", "h", clean.alias("c"), T.marker_word_count(F.col("h")).alias("w"),
        T.marker_char_count(F.col("h")).alias("mc"), T.marker_ratio(F.col("h")).alias("r"),
        T.char_wb_ngrams(F.col("h"), 3, 5).alias("cw"), T.word_count(F.col("h")).alias("wc"), *style_columns("h"))
    for r in df.collect():
        s = r["h"]
        assert re.fullmatch(r"[a-z0-9'\-.\[\]: ]*", r["c"]) and "  " not in r["c"] and r["c"] == r["c"].strip()
        assert 0 <= r["w"] <= len(s.split()) + len(s) and 0 <= r["r"] <= 1
        assert r["mc"] == sum(c in "«»ñ¿¡áéíóúÁÉÍÓÚ" for c in s)
        assert all(1 <= len(g) <= 5 and len(g.split()) <= 1 for g in r["cw"])
        assert r["wc"] == len(s.split())
        style = {n: int(r[n]) for n in P.STYLE_FEATURES}
        assert list(style.values())[:2] == [len(s), s.count(".")]
        assert style["is_title_case"] == int(s.istitle())


def test_word_ngrams_and_tokens(spark):
    df = rows(spark, [(0, "The [MONEY] deal: U.S. wins big")])
    t = df.select(T.word_ngrams(T.word_tokens(F.col("h")), 1, 2).alias("g")).first()["g"]
    assert t[:5] == ["the", "[money]", "deal", "wins", "big"]
    assert "wins big" in t and len(t) == 5 + 4


def test_suffix_and_dedupe_key(spark):
    df = rows(spark, [(0, "Big story - Fox News"), (1, "Big story | NBC News "), (2, "  A - NBC News - Fox News")])
    got = dict(df.select("row_id", T.strip_title_suffix(F.col("h"))).collect())
    assert got == {0: "Big story", 1: "Big story | NBC News", 2: "A - NBC News"}
    k = df.select(T.dedupe_key(F.col("h"))).first()[0]
    assert k == "bigstoryfoxnews"


def test_labels(spark):
    df = rows(spark, [(0, "https://www.foxnews.com/x"), (1, "https://FOXNEWS.com/y"), (2, None)], "row_id long, url string")
    got = {r[0]: (r[1], r[2]) for r in df.select("row_id", T.source_from_url(F.col("url")),
                                                  T.source_from_url_ci(F.col("url"))).collect()}
    assert got == {0: ("FoxNews", "FoxNews"), 1: ("NBC", "FoxNews"), 2: ("NBC", "NBC")}


@settings(max_examples=30, deadline=None)
@given(st.lists(st.one_of(st.none(), st.lists(_ALPHABET, max_size=30).map("".join)), max_size=8))
def test_clean_tokens_are_the_words_of_a_cleaned_headline(spark, texts):
    clean = rows(spark, enumerate(EDGE + ["\x1c\x85 \u00a0", " a\tb "] + texts)).select(T.clean_headline(F.col("h")).alias("c"))
    for r in clean.select("c", T.clean_tokens("c").alias("t"), T.ws_tokens("c").alias("w")).collect():
        assert r["t"] == r["w"] == r["c"].split()
