"""The twelve style features, on raw (uncleaned) headline text.

Each is a native expression with Python string semantics: ``isupper`` and
``istitle`` are written with Unicode categories, ``\\bUS\\b`` as a word-run
lookup, and ``\\s`` with Python's whitespace class.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions.text import word_runs, ws_tokens

_CASED = r"\p{Lu}\p{Ll}\p{Lt}"


def _is_upper_word(w: Column) -> Column:
    return w.rlike(r"\p{Lu}") & ~w.rlike(r"[\p{Ll}\p{Lt}]")


def is_title_case(s: Column) -> Column:
    return (s.rlike(r"[\p{Lu}\p{Lt}]")
            & ~s.rlike(rf"(^|[^{_CASED}])\p{{Ll}}")
            & ~s.rlike(rf"[{_CASED}][\p{{Lu}}\p{{Lt}}]"))


def style_columns(c) -> list[Column]:
    """The 12 features in ``patterns.STYLE_FEATURES`` order, as DOUBLE columns."""
    s = F.coalesce(F.col(c) if isinstance(c, str) else c, F.lit(""))
    feats = {
        "len": F.length(s),
        "n_periods": F.regexp_count(s, F.lit(r"\.")),
        "has_end_period": s.rlike(rf"\.[{P.WS}]*\z").cast("int"),
        "has_U_S": s.contains("U.S.").cast("int"),
        "has_US": F.array_contains(word_runs(s), "US").cast("int"),
        "has_colon": s.contains(":").cast("int"),
        "n_caps": F.regexp_count(s, F.lit("[A-Z]")),
        "n_allcaps": F.size(F.filter(ws_tokens(s),
                                     lambda w: _is_upper_word(w) & (F.length(w) > 2))),
        "has_quote": s.rlike("[\"'`]").cast("int"),
        "has_sing_quote": s.contains("'").cast("int"),
        "is_title_case": is_title_case(s).cast("int"),
        "has_hyphen": s.rlike(rf"[{P.WORD}]-[{P.WORD}]").cast("int"),
    }
    return [feats[name].cast("double").alias(name) for name in P.STYLE_FEATURES]


def with_style(df, text_col: str = "headline"):
    return df.select("*", *style_columns(text_col))
