"""Exploratory statistics: describe, contingency, chi-square, histograms, top-k.

Quantiles are exact and computed from a value histogram
``(group, value) -> count`` whose size is bounded by the number of distinct
values (lengths, counts and flags here), not by the number of rows. Per-group
min/max and totals are small aggregates joined back, never whole-group
windows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions import patterns as P


def value_counts(df: DataFrame, col: str, name: str = "n") -> DataFrame:
    return df.groupBy(col).agg(F.count(F.lit(1)).alias(name))


def exact_quantiles(df: DataFrame, group_cols: list[str], value_col: str,
                    qs: dict[str, float]) -> DataFrame:
    """Linear-interpolation quantiles (pandas/numpy default), one row per group."""
    hist = df.where(F.col(value_col).isNotNull()).groupBy(*group_cols, value_col).agg(F.count(F.lit(1)).alias("_c"))
    w = W.partitionBy(*group_cols).orderBy(value_col) if group_cols else W.orderBy(value_col)
    hist = hist.withColumn("_cum", F.sum("_c").over(w.rowsBetween(W.unboundedPreceding, 0)))
    n = F.sum("_c").over(W.partitionBy(*group_cols) if group_cols else W.partitionBy(F.lit(0)))
    hist = hist.withColumn("_n", n)
    aggs = []
    for name, qv in qs.items():
        h = (F.col("_n") - 1) * F.lit(qv)
        lo = F.floor(h)
        hi = F.least(lo + 1, F.col("_n") - 1)
        hist = (hist.withColumn(f"_h_{name}", h)
                .withColumn(f"_lo_{name}", lo).withColumn(f"_hi_{name}", hi))
        aggs += [F.min(F.when(F.col("_cum") > F.col(f"_lo_{name}"), F.col(value_col))).alias(f"_vlo_{name}"),
                 F.min(F.when(F.col("_cum") > F.col(f"_hi_{name}"), F.col(value_col))).alias(f"_vhi_{name}"),
                 F.first(F.col(f"_h_{name}") - F.col(f"_lo_{name}")).alias(f"_fr_{name}")]
    out = hist.groupBy(*group_cols).agg(*aggs)
    return out.select(*group_cols, *[
        (F.col(f"_vlo_{k}") + F.col(f"_fr_{k}") * (F.col(f"_vhi_{k}") - F.col(f"_vlo_{k}"))).cast("double").alias(k)
        for k in qs])


def describe(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """count, mean, std (n-1), min, 25%, 50%, 75%, max per group."""
    base = df.groupBy(group_col).agg(
        F.count(value_col).alias("count"), F.avg(value_col).alias("mean"),
        F.stddev_samp(value_col).alias("std"), F.min(value_col).cast("double").alias("min"),
        F.max(value_col).cast("double").alias("max"))
    qs = exact_quantiles(df, [group_col], value_col, {"p25": 0.25, "p50": 0.5, "p75": 0.75})
    return base.join(qs, group_col)


def unpivot_features(df: DataFrame, id_cols: list[str], features: list[str]) -> DataFrame:
    return df.unpivot(id_cols, features, "feature", "value")


def crosstab_long(df: DataFrame, class_col: str, features: list[str]) -> DataFrame:
    """(feature, value, class, n) for all features in one aggregation."""
    long = unpivot_features(df.select(class_col, *features), [class_col], features)
    return long.groupBy("feature", "value", class_col).agg(F.count(F.lit(1)).alias("n"))


def chi_square(cells: DataFrame, class_col: str, classes: Column) -> DataFrame:
    """Chi-square of independence per feature from long contingency cells.

    ``classes`` is an array column of all class values (a handful); every
    (feature, value) row is expanded over it so empty cells count with O=0.
    Yates' continuity correction applies when dof == 1.
    Output: feature, chi2, dof, n_obs, n_rows, n_cols.
    """
    vals = cells.select("feature", "value").distinct()
    dense = (vals.select("feature", "value", F.explode(classes).alias(class_col))
             .join(cells, ["feature", "value", class_col], "left")
             .withColumn("n", F.coalesce(F.col("n"), F.lit(0))))
    row_tot = dense.groupBy("feature", class_col).agg(F.sum("n").alias("_r"))
    col_tot = dense.groupBy("feature", "value").agg(F.sum("n").alias("_c"))
    x = dense.join(row_tot, ["feature", class_col]).join(col_tot, ["feature", "value"])
    x = x.where((F.col("_r") > 0) & (F.col("_c") > 0))
    # classes and values that never occur are no rows or columns of the table
    tot = x.groupBy("feature").agg(
        F.sum("n").alias("_t"),
        F.countDistinct("value").alias("n_cols"),
        F.countDistinct(class_col).alias("n_rows"))
    x = x.join(tot, "feature")
    e = F.col("_r") * F.col("_c") / F.col("_t")
    dof = (F.col("n_rows") - 1) * (F.col("n_cols") - 1)
    d = F.abs(F.col("n") - e)
    term = F.when(dof == 1, F.pow(F.greatest(d - 0.5, F.lit(0.0)), 2) / e).otherwise(F.pow(d, 2) / e)
    return (x.withColumn("_term", term).groupBy("feature")
            .agg(F.sum("_term").alias("chi2"), F.first(dof).cast("long").alias("dof"),
                 F.first("_t").cast("long").alias("n_obs"), F.first("n_rows").cast("long").alias("n_rows"),
                 F.first("n_cols").cast("long").alias("n_cols")))


def cramers_v(chi: DataFrame) -> DataFrame:
    k = F.least(F.col("n_rows"), F.col("n_cols")) - 1
    v = F.sqrt(F.col("chi2") / F.nullif(F.col("n_obs") * k, F.lit(0)))
    return chi.select("feature", v.alias("cramers_v"))


def chi2_sf_expr(x: Column, k: Column) -> Column:
    """Upper tail of the chi-square distribution (regularized gamma Q(k/2, x/2)).

    Evaluated by series / continued fraction as native array expressions (no
    UDF). Near x = k both need a number of steps in proportion to sqrt(k), so
    the steps follow the degrees of freedom.
    """
    a = k / 2.0
    xx = x / 2.0
    steps = F.sequence(F.lit(1), F.lit(300) + 12 * F.ceil(F.sqrt(a)).cast("int"))
    # log Gamma(a) for a = m/2 via a sum of logs (k is a positive integer).
    lg_int = F.aggregate(F.sequence(F.lit(1), F.greatest(F.floor(a).cast("int") - 1, F.lit(1))),
                         F.lit(0.0), lambda acc, j: acc + F.log(j.cast("double")))
    lg_half = F.lit(0.5723649429247001) + F.aggregate(
        F.sequence(F.lit(0), F.greatest(F.floor(a).cast("int") - 1, F.lit(0))),
        F.lit(0.0), lambda acc, j: acc + F.when(j < F.floor(a), F.log(j + 0.5)).otherwise(0.0))
    is_int = F.floor(a) == a
    lgamma = F.when(is_int, F.when(a <= 2, F.lit(0.0)).otherwise(lg_int)).otherwise(lg_half)
    pre = a * F.log(xx) - xx - lgamma
    # series: P = exp(pre) * sum_{n>=0} x^n / (a (a+1) ... (a+n))
    ser = F.aggregate(steps, F.struct(F.lit(1.0).alias("t"), F.lit(1.0).alias("s")),
                      lambda acc, n: F.struct((acc["t"] * xx / (a + n)).alias("t"),
                                              (acc["s"] + acc["t"] * xx / (a + n)).alias("s")))
    p_series = F.exp(pre) * ser["s"] / a
    # continued fraction (modified Lentz) for Q when x >= a + 1
    tiny = F.lit(1e-300)
    b0 = xx + 1.0 - a
    init = F.struct(b0.alias("b"), F.lit(1.0 / 1e-300).alias("c"), (1.0 / b0).alias("d"), (1.0 / b0).alias("h"))

    def lentz(acc, i):
        an = -i * (i - a)
        b = acc["b"] + 2.0
        d = an * acc["d"] + b
        d = F.when(F.abs(d) < tiny, tiny).otherwise(d)
        c = b + an / acc["c"]
        c = F.when(F.abs(c) < tiny, tiny).otherwise(c)
        d = 1.0 / d
        return F.struct(b.alias("b"), c.alias("c"), d.alias("d"), (acc["h"] * d * c).alias("h"))

    cf = F.aggregate(steps, init, lentz)
    q_cf = F.exp(pre) * cf["h"]
    return (F.when(x <= 0, F.lit(1.0))
            .when(xx < a + 1.0, F.greatest(F.lit(0.0), 1.0 - p_series))
            .otherwise(q_cf))


def style_significance(styled: DataFrame, class_col: str, class_a: str, class_b: str) -> DataFrame:
    """chi2, p, Cramér's V and class means per style feature; kind = count | binary."""
    feats = P.STYLE_FEATURES
    cells = crosstab_long(styled, class_col, feats)
    classes = F.array(F.lit(class_a), F.lit(class_b))
    chi = chi_square(cells, class_col, classes)
    means = (unpivot_features(styled.select(class_col, *feats), [class_col], feats)
             .groupBy("feature").agg(
                 F.avg(F.when(F.col(class_col) == class_a, F.col("value"))).alias("mean_a"),
                 F.avg(F.when(F.col(class_col) == class_b, F.col("value"))).alias("mean_b")))
    kind = F.when(F.col("feature").isin(P.COUNT_STYLE_FEATURES), F.lit("count")).otherwise(F.lit("binary"))
    return (chi.join(cramers_v(chi), "feature").join(means, "feature")
            .select("feature", kind.alias("kind"), "chi2", "dof",
                    chi2_sf_expr(F.col("chi2"), F.col("dof")).alias("p_value"),
                    "cramers_v", "mean_a", "mean_b"))


def histogram(df: DataFrame, group_col: str, value_col: str, bins: int = 30) -> DataFrame:
    """Equal-width bins over each group's [min, max]; last bin right-closed."""
    rng = df.groupBy(group_col).agg(F.min(value_col).alias("_mn"), F.max(value_col).alias("_mx"))
    lo = F.when(F.col("_mn") == F.col("_mx"), F.col("_mn") - 0.5).otherwise(F.col("_mn"))
    hi = F.when(F.col("_mn") == F.col("_mx"), F.col("_mx") + 0.5).otherwise(F.col("_mx"))
    rng = rng.select(group_col, lo.cast("double").alias("_lo"), hi.cast("double").alias("_hi"))
    width = (F.col("_hi") - F.col("_lo")) / bins
    b = F.least(F.floor((F.col(value_col) - F.col("_lo")) / width), F.lit(bins - 1)).cast("int")
    # rows become (group, value) counts first: only these meet the ranges
    cells = df.groupBy(group_col, value_col).agg(F.count(F.lit(1)).alias("_c"))
    x = cells.join(rng, group_col).withColumn("bin", b)
    return (x.groupBy(group_col, "bin").agg(
        F.sum("_c").alias("n"),
        F.first(F.col("_lo") + F.col("bin") * width).alias("left"),
        F.first(F.col("_lo") + (F.col("bin") + 1) * width).alias("right")))


def boxplot_stats(df: DataFrame, group_col: str, value_col: str) -> DataFrame:
    """Quartiles, 1.5 IQR whiskers (most extreme points inside) and outlier count."""
    qs = exact_quantiles(df, [group_col], value_col, {"q1": 0.25, "median": 0.5, "q3": 0.75})
    cells = df.groupBy(group_col, value_col).agg(F.count(F.lit(1)).alias("_c"))
    x = cells.join(qs, group_col)
    iqr = F.col("q3") - F.col("q1")
    lo_f, hi_f = F.col("q1") - 1.5 * iqr, F.col("q3") + 1.5 * iqr
    v = F.col(value_col)
    return x.groupBy(group_col, "q1", "median", "q3").agg(
        F.min(F.when(v >= lo_f, v)).cast("double").alias("whisker_lo"),
        F.max(F.when(v <= hi_f, v)).cast("double").alias("whisker_hi"),
        F.sum(F.when((v < lo_f) | (v > hi_f), F.col("_c")).otherwise(0)).cast("long").alias("n_outliers"))


def pattern_counts(df: DataFrame, col: str, checks=None) -> DataFrame:
    """Rows matching each named (case-insensitive) check, in one aggregation."""
    cks = P.ARTIFACT_CHECKS if checks is None else checks
    h = F.col(col)
    aggs = [F.sum(F.coalesce(h.rlike(P.artifact_regex(body, True)), F.lit(False)).cast("long")).alias(f"c{i}")
            for i, (_, body) in enumerate(cks)]
    wide = df.agg(*aggs)
    stack = ", ".join(f"'{name.replace(chr(39), chr(39) * 2)}', c{i}" for i, (name, _) in enumerate(cks))
    return wide.selectExpr(f"stack({len(cks)}, {stack}) AS (check_name, n_matches)")


def matched_checks(df: DataFrame, col: str, checks=None) -> DataFrame:
    """A row for each named check that a row matches, with ``check_name``.

    ``explode_outer`` + null filter, so that the patterns are evaluated once."""
    cks = P.ARTIFACT_CHECKS if checks is None else checks
    hits = F.array(*[F.when(F.col(col).rlike(P.artifact_regex(body, True)), F.lit(name)) for name, body in cks])
    return (df.select("*", F.explode_outer(F.array_compact(hits)).alias("check_name"))
            .where(F.col("check_name").isNotNull()))


def top_k_per_group(df: DataFrame, group_col: str, order: list[Column], k: int) -> DataFrame:
    """Rank <= k per group; planned with a partial per-task limit before the shuffle."""
    w = W.partitionBy(group_col).orderBy(*order)
    return df.withColumn("rank", F.row_number().over(w)).where(F.col("rank") <= k)
