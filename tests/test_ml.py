from pyspark.sql import functions as F

from testing_data import SF01
from marquee.ml import ensemble as EN
from marquee.ml import features as FT
from marquee.ml import learners as L
from marquee.operators import metrics as M
from marquee.operators import vocab as V
from marquee.functions import text as T
from marquee.operators.corpus import split_stratified
from marquee.plans import fixtures as X
from marquee.session import scratch_path
from marquee.sources.models import load_model, save_model


def _split(spark):
    return split_stratified(X.turn_train(spark, SF01)).cache()


def test_shipped_pipeline_beats_majority_and_round_trips(spark):
    d = _split(spark)
    tr, te = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    model = FT.build_pipeline(FT.SHIPPED, L.ScaledLogisticRegression(C=1.0, maxIter=200)).fit(tr)
    pred = model.transform(te).select("row_id", "label", F.col("prediction").cast("int").alias("prediction"))
    acc = M.accuracy(pred).first()[0]
    majority = max(te.agg(F.avg("label")).first()[0], 1 - te.agg(F.avg("label")).first()[0])
    assert acc > majority
    path = scratch_path(spark, "test-model")
    save_model(model, path)
    again = load_model(path).transform(te).select("row_id", F.col("prediction").cast("int").alias("p2"))
    assert pred.join(again, "row_id").where(F.col("prediction") != F.col("p2")).count() == 0


def test_vector_tfidf_equals_relational(spark):
    d = _split(spark).where(~F.col("is_test"))
    cfg = FT.FeatureConfig("t", clean=True, word_max=300, word_ngram=2, word_sublinear=True, word_min_df=2)
    model = FT.build_pipeline(cfg).fit(d)
    vec = {r["row_id"]: r["features"] for r in model.transform(d).select("row_id", "features").collect()}
    grams = T.with_ngrams(d, T.word_tokens(T.clean_headline(F.col("headline"))), 1, 2)
    tc = V.term_counts(grams, F.col("terms"))
    vocab = V.idf(V.vocabulary(tc, 300, 2), d.count())
    long = V.tfidf(tc, vocab, sublinear=True).collect()
    for r in long[:2000]:
        assert abs(vec[r["row_id"]][r["idx"]] - r["weight"]) < 1e-9


def test_sgd_and_adaboost_learn(spark):
    d = _split(spark)
    feats = FT.build_pipeline(FT.CONFIGS["Hybrid_v2_style"]).fit(d.where(~F.col("is_test"))).transform(d).cache()
    tr, te = feats.where(~F.col("is_test")), feats.where(F.col("is_test"))
    for clf in [L.ElasticNetSGD(loss="modified_huber", penalty="elasticnet", alpha=0.001, l1Ratio=0.15, maxIter=50),
                L.AdaBoostStumps(nEstimators=5)]:
        pred = clf.fit(tr).transform(te).select("label", F.col("prediction").cast("int").alias("prediction"))
        assert M.accuracy(pred).first()[0] > 0.6


def test_knn_exact_against_numpy(spark):
    import numpy as np
    rng = np.random.default_rng(3)
    tr = [(i, rng.normal(size=4).tolist(), int(rng.integers(0, 3))) for i in range(60)]
    te = [(100 + i, rng.normal(size=4).tolist()) for i in range(10)]
    trd = spark.createDataFrame(tr, "vec_id long, embedding array<double>, label int")
    ted = spark.createDataFrame(te, "vec_id long, embedding array<double>")
    got = {r[0]: r[1] for r in L.knn_predict(trd, ted, k=5, block_bytes=17 * 64).collect()}
    X_ = np.array([t[1] for t in tr])
    for qid, q in te:
        d = ((X_ - np.array(q)) ** 2).sum(1)
        nn = sorted(range(len(tr)), key=lambda j: (d[j], tr[j][0]))[:5]
        votes = np.bincount([tr[j][2] for j in nn], minlength=3)
        assert got[qid] == int(np.argmax(votes))


def test_knn_keeps_every_tie(spark):
    """200 equal vectors: the smallest five ids decide, however the blocks fall."""
    tr = spark.createDataFrame([(i, [1.0, 2.0], int(i < 5)) for i in range(200)], "vec_id long, embedding array<double>, label int")
    te = spark.createDataFrame([(1000, [1.0, 2.0])], "vec_id long, embedding array<double>")
    for size in (16 * 7, 1 << 20):
        assert L.knn_predict(tr, te, k=5, block_bytes=size).collect()[0]["prediction"] == 1


def test_knn_makes_a_part_of_a_block_dense_at_a_time(monkeypatch):
    """Blocks are as large as their stored entries allow; their dense rows are bounded, and every tie still ranks."""
    import numpy as np
    import pandas as pd
    rng = np.random.default_rng(4)
    near = rng.integers(0, 3, (90, 2)).astype(float)
    tr = pd.DataFrame({"_tid": np.arange(90)[::-1], "_ti": [np.array([1, 5])] * 90, "_tv": list(near), "_tl": rng.integers(0, 3, 90)})
    te = pd.DataFrame({"_qid": np.arange(200, 220), "_qi": [None] * 20, "_qv": list(rng.integers(0, 3, (20, 8)).astype(float))})
    whole = L._knn_block(5, 8)(te, tr)
    seen, real = [], L._knn_dense
    monkeypatch.setattr(L, "_knn_dense", lambda values, places, dim: seen.append(len(values)) or real(values, places, dim))
    monkeypatch.setattr(L, "KNN_DENSE_BYTES", 8 * 8 * 7)
    parts = L._knn_block(5, 8)(te, tr)
    assert max(x for x in seen if x != 20) <= 7
    order = ["_qid", "_d", "_tid"]
    assert parts.sort_values(order).reset_index(drop=True).equals(whole.sort_values(order).reset_index(drop=True)) and len(parts) == 100


def test_linear_margin_of_sparse_and_dense_vectors(spark):
    from pyspark.ml.linalg import Vectors
    vs = [Vectors.sparse(4, [1, 3], [2.0, -1.5]), Vectors.dense([1.0, 0.0, 3.0, 1e-7]), Vectors.sparse(4, [], [])]
    w = [0.25, -1e-05, 1 / 3, 2.0]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vs)], ["row_id", "features"])
    got = dict(df.select("row_id", L._margin("features", w, 0.5)).collect())
    for i, v in enumerate(vs):
        assert abs(got[i] - (float(v.toArray() @ w) + 0.5)) < 1e-12
    out = L.LinearScoreModel(coefficients=w, intercept=0.5).transform(df).select("row_id", "prediction").collect()
    assert {r[0]: r[1] for r in out} == {0: 0.0, 1: 1.0, 2: 1.0}


def test_turn_ids_of_long_conversations_differ(spark, tmp_path):
    turns = [(c, t, "user", "x") for c in (1, 2, 3) for t in range(2500)]
    spark.createDataFrame(turns, "conv_id long, turn long, role string, text string").write.parquet(
        str(tmp_path / "conversations.parquet"))
    assert X.turn_train(spark, str(tmp_path)).select("row_id").distinct().count() == len(turns)


def test_sgd_rows_without_features():
    import numpy as np
    block = (np.array([0, 2, 2]), np.array([0, 1]), np.array([1.0, 2.0]), np.array([1.0, 0.0]))
    assert L._max_square(block) == 5.0
    assert L._max_square((np.array([0, 0]), np.array([], int), np.array([]), np.array([1.0]))) == 0.0


def test_saved_ensembles_score_the_same(spark):
    d = _split(spark)
    tr, te = d.where(~F.col("is_test")), d.where(F.col("is_test"))
    lr = ("lr", L.ScaledLogisticRegression(C=1.0, maxIter=20), "proba")
    sgd = ("sgd", L.ElasticNetSGD(loss="modified_huber", alpha=0.001, maxIter=10), "proba")
    svc = L.ScaledLinearSVC(C=0.1, maxIter=10)
    cfg = FT.FeatureConfig("t", clean=True, word_max=200)
    for clf in [EN.Stacking([lr, ("svc", svc, "margin"), sgd], 2), L.AdaBoostStumps(nEstimators=3),
                EN.SoftVote([lr[:2], ("csvc", EN.CalibratedSVC(svc, 2))])]:
        model = FT.build_pipeline(cfg, clf).fit(tr)
        path = scratch_path(spark, "test-ensemble")
        save_model(model, path)

        def scores(m):
            return {r["row_id"]: (r["prediction"], r["probability"].toArray().round(9).tolist())
                    for r in m.transform(te).select("row_id", "prediction", "probability").collect()}
        assert scores(load_model(path)) == scores(model)
