"""Column -> Column text functions: labels, cleaning, counts, tokens, n-grams.

Every function is a native Spark expression (regex, translate, higher-order
array functions), so it runs inside the JVM next to the scan; no Python UDF.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions.fold import ascii_fold


def _c(c) -> Column:
    return F.col(c) if isinstance(c, str) else c


# --- labels (P1-P3) --------------------------------------------------------

def source_from_url(url, marker: str = P.OUTLET_A_SITE, a: str = P.OUTLET_A,
                    b: str = P.OUTLET_B) -> Column:
    """Case-sensitive literal substring; null URL is class ``b``."""
    return F.when(F.coalesce(_c(url).contains(marker), F.lit(False)), F.lit(a)).otherwise(F.lit(b))


def source_from_url_ci(url, marker: str = P.OUTLET_A_SITE, a: str = P.OUTLET_A,
                       b: str = P.OUTLET_B) -> Column:
    """Merge-time variant: marker used as a case-insensitive regex."""
    hit = F.coalesce(_c(url).rlike(P.case_insensitive(marker)), F.lit(False))
    return F.when(hit, F.lit(a)).otherwise(F.lit(b))


def encode_label(source, a: str = P.OUTLET_A) -> Column:
    return F.when(_c(source) == F.lit(a), F.lit(1)).otherwise(F.lit(0))


def decode_label(label, a: str = P.OUTLET_A, b: str = P.OUTLET_B) -> Column:
    return F.create_map(F.lit(1), F.lit(a), F.lit(0), F.lit(b))[_c(label)]


# --- normalisation (P4-P10) ------------------------------------------------

def normalize_punct(c) -> Column:
    return F.translate(_c(c), P.PUNCT_FROM, P.PUNCT_TO)


def replace_money(c) -> Column:
    return F.regexp_replace(_c(c), P.money_regex(), P.MONEY_TOKEN)


def mark_end_period(c) -> Column:
    return F.regexp_replace(_c(c), P.END_PERIOD_RE, P.END_PERIOD_TOKEN)


def collapse_ws(c) -> Column:
    """``" ".join(s.split())``."""
    return F.trim(F.regexp_replace(_c(c), f"[{P.WS}]+", " "))


def strip_ws(c) -> Column:
    """``s.strip()`` with Python's whitespace class."""
    return F.regexp_replace(_c(c), rf"^[{P.WS}]+|[{P.WS}]+\z", "")


def clean_headline(c) -> Column:
    """Null -> ''; fold; money; end period; lower; drop and collapse.

    Order matters: folding runs first, so curly quotes and dashes are deleted
    (the punctuation map would find none) and only ``$`` amounts survive to the
    money rule. In folded text whatever is not kept becomes a space, character
    by character; what is left to collapse is runs of spaces.
    """
    t = F.coalesce(_c(c), F.lit(""))
    t = ascii_fold(t)
    t = replace_money(t)
    t = mark_end_period(t)
    t = F.lower(t)
    t = F.translate(t, P.CLEAN_DROP_ASCII, " " * len(P.CLEAN_DROP_ASCII))
    return F.trim(F.regexp_replace(t, "  +", " "))


def strip_title_suffix(c, suffixes=None) -> Column:
    return strip_ws(F.regexp_replace(_c(c), P.suffix_regex(suffixes), ""))


def dedupe_key(c) -> Column:
    return F.regexp_replace(F.lower(_c(c)), "[^a-z0-9]+", "")


# --- counts and tokens (P11, P12, F2, F3, F5) ------------------------------

def char_len(c) -> Column:
    return F.length(_c(c))


def word_count(c) -> Column:
    """``len(s.split())``."""
    return F.regexp_count(_c(c), F.lit(f"[{P.NON_WS}]+"))


def ws_tokens(c) -> Column:
    """``s.split()`` as an array."""
    return F.regexp_extract_all(_c(c), F.lit(f"[{P.NON_WS}]+"), 0)


def clean_tokens(c) -> Column:
    """``s.split()`` of a cleaned headline (``clean_headline``): ASCII words with single spaces between."""
    return F.array_remove(F.split(_c(c), " "), "")


def word_runs(c) -> Column:
    """Python ``re.findall(r'\\b\\w+\\b', s)``."""
    return F.regexp_extract_all(_c(c), F.lit(P.WORD_RUN), 0)


def marker_word_count(c, words=None) -> Column:
    """Number of distinct marker words present (binary bag of words)."""
    ws = P.MARKER_WORDS if words is None else words
    toks = word_runs(F.lower(F.coalesce(_c(c), F.lit(""))))
    return F.size(F.array_intersect(toks, F.array(*[F.lit(w) for w in ws])))


def marker_char_count(c) -> Column:
    return F.regexp_count(_c(c), F.lit(P.marker_char_class()))


def marker_ratio(c, words=None) -> Column:
    """Marker tokens (with multiplicity) / max(tokens, 1)."""
    ws = P.MARKER_WORDS if words is None else words
    toks = F.filter(word_runs(F.lower(F.coalesce(_c(c), F.lit("")))),
                    lambda w: w.rlike(P.ratio_token_re()))
    hits = F.filter(toks, lambda w: w.isin(ws))
    return F.size(hits) / F.greatest(F.size(toks), F.lit(1))


# --- analyzer tokens and n-grams (T1-T4) -----------------------------------

def word_tokens(c, default_pattern: bool = False) -> Column:
    """Lowercased word tokens; custom pattern keeps ``[money]`` brackets."""
    pat = P.DEFAULT_TOKEN_RE if default_pattern else P.WORD_TOKEN_RE
    return F.regexp_extract_all(F.lower(F.coalesce(_c(c), F.lit(""))), F.lit(pat), 0)


def remove_stopwords(tokens, stopwords) -> Column:
    sw = F.array(*[F.lit(w) for w in sorted(stopwords)])
    return F.filter(_c(tokens), lambda t: ~F.array_contains(sw, t))


def word_ngrams(tokens, n_min: int = 1, n_max: int = 2) -> Column:
    """Space-joined word n-grams for n in [n_min, n_max], unigrams first.

    Pass a column reference (see ``with_ngrams``): the tokens are read once
    per n-gram inside the lambda, so an unmaterialised expression would be
    re-evaluated per position.
    """
    t = _c(tokens)
    parts = []
    for n in range(n_min, n_max + 1):
        if n == 1:
            parts.append(t)
            continue
        if n == 2:
            # one pass over adjacent pairs
            parts.append(F.when(F.size(t) >= 2, F.zip_with(
                F.slice(t, 1, F.size(t) - 1), F.slice(t, 2, F.size(t) - 1),
                lambda a, b: F.concat(a, F.lit(" "), b))).otherwise(F.array().cast("array<string>")))
            continue
        parts.append(F.when(
            F.size(t) >= n,
            F.transform(F.sequence(F.lit(1), F.size(t) - (n - 1)),
                        lambda i: F.array_join(F.slice(t, i, n), " ")),
        ).otherwise(F.array().cast("array<string>")))
    return reduce(F.concat, parts) if len(parts) > 1 else parts[0]


def with_ngrams(df, tokens: Column, n_min: int = 1, n_max: int = 2, keep=("row_id",),
                out: str = "terms"):
    """``df`` projected to ``keep`` + word n-grams of ``tokens``, tokens computed once."""
    staged = df.select(*keep, tokens.alias("_tokens"))
    return staged.select(*keep, word_ngrams(F.col("_tokens"), n_min, n_max).alias(out))


def char_wb_words(c) -> Column:
    """The lowercased words that ``char_wb_ngrams`` pads and cuts."""
    return ws_tokens(F.lower(F.coalesce(_c(c), F.lit(""))))


def char_wb_ngrams(c, n_min: int, n_max: int) -> Column:
    """Character n-grams inside word boundaries (each word padded by spaces).

    Lowercased; a padded word not longer than n is emitted once whole and
    longer n are skipped for it.
    """
    return char_wb_of_words(char_wb_words(c), n_min, n_max)


def char_wb_of_words(words: Column, n_min: int, n_max: int) -> Column:
    """``char_wb_ngrams`` of an array of lowercased words."""
    def per_word(w):
        padded = F.concat(F.lit(" "), w, F.lit(" "))
        plen = F.length(w) + 2
        ns = F.filter(F.sequence(F.lit(n_min), F.lit(n_max)),
                      lambda n: (n == n_min) | (n - 1 < plen))
        return F.flatten(F.transform(ns, lambda n: F.transform(
            F.sequence(F.lit(0), F.greatest(plen - n, F.lit(0))),
            lambda i: F.substring(padded, i + 1, n))))

    return F.flatten(F.transform(words, per_word))
