"""Row filters of headline preparation (F1-F11) as DataFrame -> DataFrame.

Each filter is a predicate column, so a chain of them collapses into one
Filter next to the scan; the funnel tags each row with its first failing
stage in the same single pass instead of counting after every step.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions import text as T


def drop_nulls(df: DataFrame, cols=("headline",)) -> DataFrame:
    return df.dropna(subset=list(cols))


def is_foreign_pass1(h: Column) -> Column:
    return ((T.marker_word_count(h) > P.MAX_MARKER_WORDS)
            | (T.marker_char_count(h) > P.MAX_MARKER_CHARS))


def keeps_ratio(h: Column, inclusive: bool = True, threshold: float = P.MAX_MARKER_RATIO) -> Column:
    """Pass 2 keeps ratio <= 0.16; the exploratory variant keeps < 0.16."""
    r = T.marker_ratio(h)
    return (r <= threshold) if inclusive else (r < threshold)


def in_length_bounds(h: Column) -> Column:
    return F.length(h).between(P.MIN_CHARS, P.MAX_CHARS) & (T.word_count(h) >= P.MIN_WORDS)


def artifact_hits(h: Column, rules=None) -> list[Column]:
    rs = P.ARTIFACT_RULES if rules is None else rules
    return [F.coalesce(h.rlike(P.artifact_regex(body, ci)), F.lit(False)) for _, body, ci in rs]


def is_artifact(h: Column, rules=None) -> Column:
    return reduce(lambda a, b: a | b, artifact_hits(h, rules))


def language_pass1(df: DataFrame, col: str = "headline") -> DataFrame:
    return df.where(~is_foreign_pass1(F.col(col)))


def language_pass2(df: DataFrame, col: str = "headline", inclusive: bool = True) -> DataFrame:
    return df.where(keeps_ratio(F.col(col), inclusive))


def length_filter(df: DataFrame, col: str = "headline") -> DataFrame:
    return df.where(in_length_bounds(F.col(col)))


def artifact_filter(df: DataFrame, col: str = "headline") -> DataFrame:
    return df.where(~is_artifact(F.col(col)))


# Stage names of the preparation funnel, in evaluation order.
FUNNEL_STAGES = ["null_headline", "language_pass1", "language_pass2", "length", "artifact", "kept"]


def funnel_stage(h: Column) -> Column:
    """First failing stage of a row (``kept`` when it passes all)."""
    return F.coalesce(
        F.when(h.isNull(), F.lit("null_headline")),
        F.when(is_foreign_pass1(h), F.lit("language_pass1")),
        F.when(~keeps_ratio(h), F.lit("language_pass2")),
        F.when(~in_length_bounds(h), F.lit("length")),
        F.when(is_artifact(h), F.lit("artifact")),
        F.lit("kept"),
    )


def filter_funnel(df: DataFrame, col: str = "headline", label_col: str = "label") -> DataFrame:
    """Per stage: rows dropped there and class-1 rows among them, one pass."""
    return (df.select(funnel_stage(F.col(col)).alias("stage"), F.col(label_col).alias("_y"))
            .groupBy("stage")
            .agg(F.count(F.lit(1)).alias("n_rows"),
                 F.sum(F.col("_y").cast("long")).alias("n_class1")))


def borderline_pass1(df: DataFrame, col: str = "headline") -> DataFrame:
    """Rows near the pass-1 cutoff: 3 words & <=1 char, or 3 chars & <=1 word."""
    w, c = T.marker_word_count(F.col(col)), T.marker_char_count(F.col(col))
    return df.where(((w == 3) & (c <= 1)) | ((c == 3) & (w <= 1)))


def borderline_ratio(df: DataFrame, col: str = "headline", lo: float = 0.14, hi: float = 0.18) -> DataFrame:
    r = T.marker_ratio(F.col(col))
    return df.where((r > lo) & (r < hi))


def short_rows(df: DataFrame, col: str = "headline", lo: int = 15, hi: int = 25) -> DataFrame:
    n = F.length(F.col(col))
    return df.where((n > lo) & (n < hi))
