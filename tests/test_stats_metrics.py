import math

import numpy as np
from pyspark.sql import functions as F

from marquee.operators import metrics as M
from marquee.operators import stats as S


def test_quantiles_match_numpy(spark):
    vals = [3, 7, 7, 19, 25, 25, 25, 40, 41, 99]
    df = spark.createDataFrame([("a", v) for v in vals], "g string, v int")
    q = S.exact_quantiles(df, ["g"], "v", {"p25": .25, "p50": .5, "p75": .75}).first()
    assert [q["p25"], q["p50"], q["p75"]] == list(np.percentile(vals, [25, 50, 75]))


def test_chi_square_yates_and_cramers_v(spark):
    # 2x2: [[10, 20], [30, 5]] with and without the correction
    cells = spark.createDataFrame([("f", 0.0, "A", 10), ("f", 1.0, "A", 20), ("f", 0.0, "B", 30), ("f", 1.0, "B", 5)],
                                  "feature string, value double, source string, n long")
    chi = S.chi_square(cells, "source", F.array(F.lit("A"), F.lit("B"))).first()
    obs = np.array([[10, 20], [30, 5]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    yates = (np.maximum(np.abs(obs - e) - 0.5, 0) ** 2 / e).sum()
    assert abs(chi["chi2"] - yates) < 1e-9 and chi["dof"] == 1
    v = S.cramers_v(S.chi_square(cells, "source", F.array(F.lit("A"), F.lit("B")))).first()["cramers_v"]
    assert abs(v - math.sqrt(yates / 65)) < 1e-9


def test_chi_square_missing_cells_count(spark):
    # value 2.0 never occurs for B: the empty cell still contributes
    cells = spark.createDataFrame([("f", 0.0, "A", 5), ("f", 1.0, "A", 5), ("f", 2.0, "A", 5),
                                   ("f", 0.0, "B", 5), ("f", 1.0, "B", 10)],
                                  "feature string, value double, source string, n long")
    chi = S.chi_square(cells, "source", F.array(F.lit("A"), F.lit("B"))).first()
    obs = np.array([[5, 5, 5], [5, 10, 0]], dtype=float)
    e = obs.sum(1, keepdims=True) * obs.sum(0, keepdims=True) / obs.sum()
    assert abs(chi["chi2"] - ((obs - e) ** 2 / e).sum()) < 1e-9 and chi["dof"] == 2


def test_pvalue(spark):
    df = spark.createDataFrame([(3.841458820694124, 1), (5.991464547107979, 2), (0.0, 3), (1000.0, 4),
                                (2.0, 5)], "x double, k int")
    p = [r[0] for r in df.select(S.chi2_sf_expr(F.col("x"), F.col("k"))).collect()]
    assert abs(p[0] - 0.05) < 1e-9 and abs(p[1] - 0.05) < 1e-9 and p[2] == 1.0 and p[3] < 1e-100
    assert abs(p[4] - 0.8491450360846096) < 1e-9


def test_pvalue_of_many_degrees_of_freedom(spark):
    cases = [(float(k) + d * math.sqrt(2 * k), k) for k in (20_001, 100_000, 1_000_000) for d in (-1.0, 0.0, 2.0)]
    df = spark.createDataFrame(cases, "x double, k int")
    chi = spark.sparkContext._jvm.org.apache.commons.math3.distribution.ChiSquaredDistribution
    for x, k, p in df.select("x", "k", S.chi2_sf_expr(F.col("x"), F.col("k"))).collect():
        assert abs(p - (1.0 - chi(float(k)).cumulativeProbability(x))) < 1e-6


def test_chi_square_with_an_absent_class(spark):
    cells = spark.createDataFrame([("f", 0.0, "A", 5), ("f", 1.0, "A", 7)],
                                  "feature string, value double, source string, n long")
    chi = S.chi_square(cells, "source", F.array(F.lit("A"), F.lit("B"))).first()
    assert (chi["chi2"], chi["dof"], chi["n_rows"], chi["n_cols"]) == (0.0, 0, 1, 2)


def test_matched_checks(spark):
    df = spark.createDataFrame([(1, "coming up on X - Fox Nation"), (2, "Y - Page 12"), (3, None), (4, "plain"), (5, "")],
                               "row_id long, headline string")
    got = S.matched_checks(df, "headline").collect()
    assert sorted((r["row_id"], r["check_name"]) for r in got) == [
        (1, "Fox Nation episodes"), (1, "Show previews"), (2, "'Page' references")]


def test_report_of_no_rows_and_of_two_classes(spark):
    df = spark.createDataFrame([(1, 1), (1, 0), (0, 0), (0, 0)], "label int, prediction int")
    got = {r["row_name"]: r for r in M.classification_report(df).collect()}
    assert sorted(got) == ["0", "1", "accuracy", "macro avg", "weighted avg"]
    assert got["0"]["recall"] == 1.0 and got["1"]["recall"] == 0.5 and got["accuracy"]["f1"] == 0.75
    assert got["macro avg"]["recall"] == 0.75 and got["weighted avg"]["support"] == 4
    assert M.macro_f1(df.limit(0)).first()[0] == 0.0


def test_macro_f1_imbalanced(spark):
    y = [1] * 8 + [0] * 2
    p = [1] * 10
    df = spark.createDataFrame(list(zip(y, p)), "label int, prediction int")
    f1 = M.macro_f1(df).first()[0]
    assert abs(f1 - (2 * 8 / (2 * 8 + 2) + 0.0) / 2) < 1e-12   # the class with no TP scores 0
    assert abs(M.accuracy(df).first()[0] - 0.8) < 1e-12


def test_auc_matches_pairwise(spark):
    rng = np.random.default_rng(1)
    y = rng.integers(0, 2, 200)
    s = np.round(rng.random(200), 2)
    df = spark.createDataFrame([(int(a), float(b)) for a, b in zip(y, s)], "label int, score double")
    got = M.auc(df).first()[0]
    pos, neg = s[y == 1], s[y == 0]
    pair = ((pos[:, None] > neg[None, :]).sum() + 0.5 * (pos[:, None] == neg[None, :]).sum()) / (len(pos) * len(neg))
    assert abs(got - pair) < 1e-12


def test_robust_accuracy(spark):
    df = spark.createDataFrame([("A", 0), ("B", 1), ("B", 1), ("A", 1)], "prediction string, label int")
    assert M.robust_accuracy(df).first()[0] == 0.75
    flipped = spark.createDataFrame([("B", 0), ("A", 1), ("A", 1), ("B", 1)], "prediction string, label int")
    assert M.robust_accuracy(flipped).first()[0] == 0.75        # best of both mappings
    three = spark.createDataFrame([("A", 0), ("B", 1), ("1", 1)], "prediction string, label int")
    assert abs(M.robust_accuracy(three).first()[0] - 1 / 3) < 1e-12  # compared as strings
    empty = spark.createDataFrame([], "prediction string, label int")
    assert M.robust_accuracy(empty).first()[0] == 0.0
