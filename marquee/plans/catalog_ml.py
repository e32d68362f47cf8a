"""Registered model-training queries (rows-only checks: training is not SQL).

Training rows are the conversation turns (``fixtures.turn_train``: whole
texts, label = assistant turn), split 80/20 with the stratified hash split.
Feature pipelines are fitted on the training rows only; ensembles and
classifier queries read one checkpointed feature table, as the reference
fits its feature union once and runs the stack's inner CV on its output.
"""

from __future__ import annotations

from concurrent.futures import ThreadPoolExecutor
from dataclasses import replace

from pyspark.ml import PipelineModel
from pyspark.ml.feature import VectorAssembler, Word2Vec
from pyspark.ml.functions import vector_to_array
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.functions import text as T
from marquee.functions.style import style_columns
from marquee.ml import ensemble as EN
from marquee.ml import features as FT
from marquee.ml import learners as L
from marquee.ml import linear_grid as LG
from marquee.ml import tuning as TU
from marquee.ml.fold_features import FoldStore
from marquee.ml.forest import ForestModel
from marquee.ml.perceptron import Perceptron
from marquee.operators import metrics as M
from marquee.operators.corpus import split_stratified, stratified_folds
from marquee.plans import fixtures as X
from marquee.plans.catalog import prepared_pages, query
from marquee.session import checkpoint_dir, scratch_path
from marquee.sources.models import load_model, save_model

K_FOLDS = 5


def _split(spark, sf) -> DataFrame:
    return split_stratified(X.turn_train(spark, sf))


def _featurized(spark, sf, cfg: FT.FeatureConfig = FT.SHIPPED):
    """(row_id, label, is_test, features) with features fitted on training rows."""
    checkpoint_dir(spark)
    stages, feats = FT.fit_features(cfg, _split(spark, sf), ~F.col("is_test"))
    return feats.select("row_id", "label", "is_test", "features"), PipelineModel(stages)


def _held_out(pred: DataFrame) -> DataFrame:
    cols = ["row_id", "label", F.col("prediction").cast("int").alias("prediction")]
    if "probability" in pred.columns:
        cols.append(vector_to_array("probability")[1].alias("p1"))
    return pred.select(*cols)


def _fit_eval(spark, sf, clf) -> DataFrame:
    feats, _ = _featurized(spark, sf)
    model = clf.fit(feats.where(~F.col("is_test")))
    return _held_out(model.transform(feats.where(F.col("is_test"))))


def _members():
    lr = ("lr", L.ScaledLogisticRegression(C=1.0, maxIter=1000))
    sgd = ("sgd", L.ElasticNetSGD(loss="modified_huber", penalty="elasticnet", alpha=0.001, l1Ratio=0.15))
    rf = ("rf", L.random_forest(n_estimators=300, max_depth=None, max_features="sqrt", min_samples_leaf=1))
    svc = ("lsvc", L.ScaledLinearSVC(C=0.1, maxIter=2000))
    return lr, sgd, rf, svc


# --- single learners --------------------------------------------------------------

@query
def q_train_lr(spark, sf):
    return _fit_eval(spark, sf, L.ScaledLogisticRegression(C=1.0, maxIter=1000))


@query
def q_train_svc(spark, sf):
    return _fit_eval(spark, sf, L.ScaledLinearSVC(C=0.1, maxIter=2000))


@query
def q_train_svc_squared(spark, sf):
    return _fit_eval(spark, sf, L.CSquaredHinge(C=0.1, maxIter=200))


@query
def q_train_sgd(spark, sf):
    return _fit_eval(spark, sf, _members()[1][1])


@query
def q_train_rf(spark, sf):
    return _fit_eval(spark, sf, _members()[2][1])


@query
def q_train_dt(spark, sf):
    return _fit_eval(spark, sf, L.decision_tree())


@query
def q_train_adaboost(spark, sf):
    return _fit_eval(spark, sf, L.AdaBoostStumps(nEstimators=50))


@query
def q_train_nb(spark, sf):
    return _fit_eval(spark, sf, L.multinomial_nb(1.0))


@query
def q_train_cnb(spark, sf):
    return _fit_eval(spark, sf, L.complement_nb(1.0))


@query
def q_train_knn(spark, sf):
    return _fit_eval(spark, sf, L.ExactKNN(k=5))


@query
def q_knn_classify(spark, sf):
    train, test = X.knn_vectors(spark, sf)
    return L.knn_predict(train, test, k=5)


# --- feature study, tuning, inspection ---------------------------------------------

def _oof_parallel(estimator, pairs):
    """Fold fits submitted from threads: small jobs of several folds share the cluster."""
    def one(f):
        train, fold = pairs[f]
        p = estimator.copy().fit(train).transform(fold)
        return p.select(F.lit(f).alias("fold"), "label", F.col("prediction").cast("int").alias("prediction")).checkpoint()

    with ThreadPoolExecutor(max_workers=len(pairs)) as ex:
        parts = list(ex.map(one, range(len(pairs))))
    out = parts[0]
    for p_ in parts[1:]:
        out = out.unionByName(p_)
    return out


@query
def q_pipeline_sweep(spark, sf):
    """Texts are cut into words once for all pipelines, terms are counted once for all folds of a pipeline."""
    store = FoldStore(_folded(spark, sf), list(FT.CONFIGS.values()), K_FOLDS)
    # the vectors of a pipeline are made while the one before is fitted
    with ThreadPoolExecutor(max_workers=2) as ex:
        fits = {name: ex.submit(_oof_parallel, L.ScaledLogisticRegression(C=1.0, maxIter=100), _fold_vectors(store, cfg))
                for name, cfg in FT.CONFIGS.items()}
        return _sorted_summaries([M.fold_summary(f.result(), name) for name, f in fits.items()])


def _sorted_summaries(rows: list[DataFrame]) -> DataFrame:
    """One row per entry of a sweep, best macro-F1 first (ties by name)."""
    out = rows[0]
    for r in rows[1:]:
        out = out.unionByName(r)
    return out.orderBy(F.col("f1_mean").desc(), "pipeline")


def _folded(spark, sf) -> DataFrame:
    checkpoint_dir(spark)
    train = _split(spark, sf).where(~F.col("is_test")).drop("is_test")
    return stratified_folds(train, K_FOLDS).checkpoint()


def _fold_vectors(store: FoldStore, cfg: FT.FeatureConfig) -> list[tuple[DataFrame, DataFrame]]:
    """(training side, fold) of every fold; the folds' small jobs share the cluster."""
    store.warm([cfg])
    with ThreadPoolExecutor(max_workers=K_FOLDS) as ex:
        return list(ex.map(lambda f: store.vectors(cfg, f), range(K_FOLDS)))


def _grid_table(spark, per: DataFrame, grid: list[dict], point_of: list[int]) -> DataFrame:
    """Mean and deviation over folds of (fold, point, macro_f1), for every grid entry."""
    params = spark.createDataFrame([(i, point_of[i], {k: str(v) for k, v in g.items()}) for i, g in enumerate(grid)],
                                   "grid_index int, point int, params map<string,string>")
    means = per.groupBy("point").agg(F.round(F.avg("macro_f1"), 4).alias("f1_mean"), F.round(F.stddev_pop("macro_f1"), 4).alias("f1_std"))
    return means.join(params, "point").select("grid_index", "f1_mean", "f1_std", "params")


def _linear_grid(spark, sf, grid: list[dict], point, max_iter: int = 100) -> DataFrame:
    """Cross-validated macro-F1 of a grid of linear models on the shipped features, all folds and points fitted together.

    Entries that mean the same point share a column."""
    pairs = _fold_vectors(FoldStore(_folded(spark, sf), [FT.SHIPPED], K_FOLDS), FT.SHIPPED)
    wanted = [point(g) for g in grid]
    points = list(dict.fromkeys(wanted))
    weights = LG.fit({f: tr for f, (tr, _) in enumerate(pairs)}, points, max_iter=max_iter)
    counts = LG.confusion({f: te for f, (_, te) in enumerate(pairs)}, weights)
    per = LG.scores(counts, ["space", "point"])
    return _grid_table(spark, per, grid, [points.index(w) for w in wanted])


# The reference's grids.
LR_GRID = [{"C": c, "solver": s, "max_iter": 1000} for c in (0.01, 0.1, 1.0, 10.0, 100.0) for s in ("lbfgs", "saga")]
SVC_GRID = [{"C": c, "loss": loss} for c in (0.01, 0.1, 1.0, 10.0, 100.0) for loss in ("hinge", "squared_hinge")]
SGD_GRID = [{"loss": loss, "alpha": a, "penalty": p, "l1_ratio": r, "learning_rate": s}
            for loss in ("hinge", "modified_huber", "log_loss") for a in (1e-5, 1e-4, 1e-3, 1e-2)
            for p in ("l2", "l1", "elasticnet") for r in (0.15, 0.5) for s in ("optimal", "adaptive")]
# The feature grid (vocabulary size x word n-grams x character n-grams).
FEATURE_GRID = [{"word_max": m, "word_ngram": n, "char_range": c}
                for m in (1000, 2500, 5000) for n in (1, 2) for c in ((3, 5), (4, 6))]


def _sgd_point(g: dict) -> LG.Point:
    """The share of L1 counts for the elastic net only; the step schedule is the solver's."""
    return LG.Point(g["loss"], alpha=g["alpha"], l1_ratio={"l2": 0.0, "l1": 1.0}.get(g["penalty"], g["l1_ratio"]))


@query
def q_grid_search_lr(spark, sf):
    return _linear_grid(spark, sf, LR_GRID, lambda g: LG.Point("log_loss", C=g["C"], solver=g["solver"]), max_iter=1000)


@query
def q_grid_search_svc(spark, sf):
    return _linear_grid(spark, sf, SVC_GRID, lambda g: LG.Point(g["loss"], C=g["C"]))


@query
def q_grid_search_sgd(spark, sf):
    return _linear_grid(spark, sf, SGD_GRID, _sgd_point)


def grid_search_features(spark, sf):
    """The choice of the shipped feature pipeline: texts are cut into terms once, sixty models are fitted together."""
    configs = [replace(FT.CONFIGS["Hybrid_v2_style"], **g) for g in FEATURE_GRID]
    store = FoldStore(_folded(spark, sf), configs, K_FOLDS)
    store.warm(configs)
    jobs = [(i, f) for i in range(len(configs)) for f in range(K_FOLDS)]
    with ThreadPoolExecutor(max_workers=2 * K_FOLDS) as ex:
        pairs = dict(zip(jobs, ex.map(lambda job: store.vectors(configs[job[0]], job[1]), jobs)))
    spaces = {i * K_FOLDS + f: pairs[i, f] for i, f in jobs}
    weights = LG.fit({s: tr for s, (tr, _) in spaces.items()}, [LG.Point("log_loss", C=1.0)])
    counts = LG.confusion({s: te for s, (_, te) in spaces.items()}, weights)
    counts = counts.withColumns({"point": F.expr(f"space div {K_FOLDS}").cast("int"), "space": F.col("space") % K_FOLDS})
    return _grid_table(spark, LG.scores(counts, ["space", "point"]), FEATURE_GRID, list(range(len(FEATURE_GRID))))


# The forest grid.
RF_GRID = [{"n_estimators": n, "max_depth": d, "min_samples_leaf": m, "max_features": f}
           for n in (100, 200, 300) for d in (None, 10, 20) for m in (1, 2, 4) for f in ("sqrt", "log2")]


def grid_search_rf(spark, sf):
    """All 54 points from 18 forests a fold: a tree depends on its number only, so smaller forests are the first trees of larger ones."""
    pairs = _fold_vectors(FoldStore(_folded(spark, sf), [FT.SHIPPED], K_FOLDS), FT.SHIPPED)
    pairs = [(tr.checkpoint(), te.checkpoint()) for tr, te in pairs]
    sizes = sorted({g["n_estimators"] for g in RF_GRID})
    shapes = list(dict.fromkeys((g["max_depth"], g["min_samples_leaf"], g["max_features"]) for g in RF_GRID))

    def one(job):
        (depth, leaf, features), f = job
        tr, te = pairs[f]
        trees = L.random_forest(sizes[-1], depth, features, leaf).fit(tr).trees
        for n in sizes:
            te = ForestModel(trees[:n], predictionCol=f"p{n}").transform(te).drop("rawPrediction", "probability")
        said = F.explode(F.array(*[F.struct(F.lit(n).alias("trees"), F.col(f"p{n}").cast("int").alias("prediction")) for n in sizes])).alias("x")
        counts = te.select("label", said).groupBy("label", "x.trees", "x.prediction").agg(F.count(F.lit(1)).alias("n")).collect()
        return [(shapes.index(job[0]), f, r["trees"], r["label"], r["prediction"], r["n"]) for r in counts]  # a dozen rows

    jobs = [(shape, f) for shape in shapes for f in range(K_FOLDS)]
    with ThreadPoolExecutor(max_workers=K_FOLDS) as ex:
        rows = [r for part in ex.map(one, jobs) for r in part]
    counts = spark.createDataFrame(rows, "shape int, space int, trees int, label int, prediction int, n long")
    counts = counts.withColumn("point", F.col("shape") * len(sizes) + F.array_position(F.array(*map(F.lit, sizes)), F.col("trees")).cast("int") - 1)
    of = [shapes.index((g["max_depth"], g["min_samples_leaf"], g["max_features"])) * len(sizes) + sizes.index(g["n_estimators"]) for g in RF_GRID]
    return _grid_table(spark, LG.scores(counts, ["space", "point"]), RF_GRID, of)


#: The learners of the classifier study with their library defaults: linear ones are fitted together, the others fold by fold.
SWEEP_LINEAR = {"logistic_regression": LG.Point("log_loss", C=1.0), "linear_svc": LG.Point("squared_hinge", C=1.0),
                "sgd": LG.Point("hinge", alpha=0.0001)}


def _sweep_others():
    return {
        "knn": L.ExactKNN(k=5),
        "decision_tree": L.decision_tree(),
        "random_forest": L.random_forest(n_estimators=100, max_depth=None, max_features="sqrt", min_samples_leaf=1),
        "adaboost": L.AdaBoostStumps(nEstimators=50),
        "multinomial_nb": L.multinomial_nb(1.0),
        "complement_nb": L.complement_nb(1.0),
    }


def classifier_sweep(spark, sf):
    """Nine learners by macro-F1 on the same folds and features, best first."""
    pairs = _fold_vectors(FoldStore(_folded(spark, sf), [FT.SHIPPED], K_FOLDS), FT.SHIPPED)
    pairs = [(tr.checkpoint(), te.checkpoint()) for tr, te in pairs]
    weights = LG.fit({f: tr for f, (tr, _) in enumerate(pairs)}, list(SWEEP_LINEAR.values()))
    counts = LG.confusion({f: te for f, (_, te) in enumerate(pairs)}, weights)
    names = F.array(*map(F.lit, SWEEP_LINEAR))
    counts = counts.select(F.get(names, F.col("point")).alias("pipeline"), F.col("space").alias("fold"), "label", "prediction", "n")

    def one(job):
        name, f = job
        tr, te = pairs[f]
        said = _sweep_others()[name].fit(tr).transform(te)
        return said.groupBy("label", F.col("prediction").cast("int").alias("prediction")).agg(F.count(F.lit(1)).alias("n")).select(
            F.lit(name).alias("pipeline"), F.lit(f).alias("fold"), "label", "prediction", "n").checkpoint()

    jobs = [(name, f) for name in _sweep_others() for f in range(K_FOLDS)]
    with ThreadPoolExecutor(max_workers=K_FOLDS) as ex:
        for part in ex.map(one, jobs):
            counts = counts.unionByName(part)
    per = LG.scores(counts, ["pipeline", "fold"])
    stats = [F.round(f(c), 4).alias(f"{n}_{s}") for n, c in (("f1", "macro_f1"), ("acc", "accuracy")) for s, f in (("mean", F.avg), ("std", F.stddev_pop))]
    return per.groupBy("pipeline").agg(*stats).orderBy(F.col("f1_mean").desc(), "pipeline")


def _top_features(train: DataFrame, cfg: FT.FeatureConfig, top: int = 10) -> DataFrame:
    model = FT.build_pipeline(cfg, L.ScaledLogisticRegression(C=1.0, maxIter=100)).fit(train)
    pairs = TU.top_coefficients(model, top)
    return train.sparkSession.createDataFrame([(i + 1, n, float(w)) for i, (n, w) in enumerate(pairs)],
                                              "rank int, feature string, weight double")


def _train_rows(spark, sf) -> DataFrame:
    checkpoint_dir(spark)
    return _split(spark, sf).where(~F.col("is_test")).checkpoint()


@query
def q_top_features(spark, sf):
    return _top_features(_train_rows(spark, sf), FT.CONFIGS["Hybrid_v2_style"])


@query
def q_top_features_side_by_side(spark, sf):
    """Four fits on one written split, side by side."""
    names, train = ["Hybrid_v2_style", "Hybrid_v1", "Optimized_v2_tokenized", "Hybrid"], _train_rows(spark, sf)
    with ThreadPoolExecutor(max_workers=len(names)) as ex:
        tables = list(ex.map(lambda n: _top_features(train, FT.CONFIGS[n]), names))
    out = None
    for name, t in zip(names, tables):
        t = t.select("rank", F.col("feature").alias(f"{name}_Feature"), F.col("weight").alias(f"{name}_Weight"))
        out = t if out is None else out.join(t, "rank", "full")
    return out


@query
def q_hybrid_features(spark, sf):
    feats, _ = _featurized(spark, sf)
    v = F.unwrap_udt("features")   # stored entries only; a dense vector has no size of its own
    return feats.select("row_id", F.coalesce(v["size"], F.size(v["values"])).alias("n_features"),
                        F.size(F.filter(v["values"], lambda x: x != 0)).alias("n_nonzero"))


# --- ensembles and evaluation --------------------------------------------------------

@query
def q_ensemble_soft3(spark, sf):
    lr, sgd, rf, _ = _members()
    return _fit_eval(spark, sf, EN.SoftVote([lr, sgd, rf]))


@query
def q_calibrate_svc(spark, sf):
    return _fit_eval(spark, sf, EN.CalibratedSVC(_members()[3][1], K_FOLDS))


@query
def q_ensemble_soft4(spark, sf):
    lr, sgd, rf, svc = _members()
    return _fit_eval(spark, sf, EN.SoftVote([lr, sgd, rf, ("lsvc", EN.CalibratedSVC(svc[1], K_FOLDS))]))


def _stack():
    lr, sgd, rf, svc = _members()
    return EN.Stacking([(lr[0], lr[1], "proba"), (svc[0], svc[1], "margin"),
                        (sgd[0], sgd[1], "proba"), (rf[0], rf[1], "proba")], K_FOLDS, 1.0)


@query
def q_stacking(spark, sf):
    return _fit_eval(spark, sf, _stack())


@query
def q_final_eval(spark, sf):
    pred = _fit_eval(spark, sf, _stack())
    return M.classification_report(pred, names={0: "class_0", 1: "class_1"})


# --- scoring and persistence ------------------------------------------------------

def _shipped_model(spark, sf, rows: DataFrame):
    return FT.build_pipeline(FT.SHIPPED, L.ScaledLogisticRegression(C=1.0, maxIter=1000)).fit(rows)


@query
def q_score_headlines(spark, sf):
    model = _shipped_model(spark, sf, X.turn_train(spark, sf))
    return _held_out(model.transform(prepared_pages(spark, sf)))


@query
def q_score_loaded_model(spark, sf):
    d = _split(spark, sf)
    model = _shipped_model(spark, sf, d.where(~F.col("is_test")))
    path = scratch_path(spark, "model")
    save_model(model, path)
    return _held_out(load_model(path).transform(d.where(F.col("is_test"))))


# --- pooled embeddings and perceptrons -------------------------------------------

def _w2v_stages(spark, sf):
    d = _split(spark, sf).withColumn("tokens", T.clean_tokens(T.clean_headline(F.col("headline"))))
    train = d.where(~F.col("is_test"))
    # trained on every partition at once and averaged; vectors depend on how many partitions there are
    w2v = Word2Vec(vectorSize=128, minCount=P.VOCAB_MIN_FREQ, seed=P.SEED, inputCol="tokens", outputCol="pooled",
                   numPartitions=max(spark.sparkContext.defaultParallelism, train.rdd.getNumPartitions()))
    model = w2v.fit(train)
    return model.transform(d)


@query
def q_pooled_embeddings(spark, sf):
    x = _w2v_stages(spark, sf)
    return x.select("row_id", vector_to_array("pooled").alias("embedding"))


@query
def q_mlp_text(spark, sf):
    x = _w2v_stages(spark, sf).checkpoint()
    mlp = Perceptron(layers=[128, 256, 2], featuresCol="pooled", seed=P.SEED, maxIter=200)
    m = mlp.fit(x.where(~F.col("is_test")))
    return _held_out(m.transform(x.where(F.col("is_test"))))


@query
def q_mlp_hybrid(spark, sf):
    x = _w2v_stages(spark, sf).select("row_id", "label", "is_test", "pooled", *style_columns("headline"))
    tr = x.where(~F.col("is_test"))
    # mean and deviation of every feature from one aggregate row over the training part
    fit = tr.agg(F.struct(*[F.struct(F.avg(f).alias("mu"), F.stddev_pop(f).alias("sd")).alias(f)
                            for f in P.STYLE_FEATURES])).scalar()
    cols = []
    for f in P.STYLE_FEATURES:
        mu, sd = fit[f]["mu"], fit[f]["sd"]
        cols.append(((F.col(f) - mu) / F.when(sd == 0, F.lit(1.0)).otherwise(sd)).alias(f"z_{f}"))
    z = x.select("row_id", "label", "is_test", "pooled", *cols)
    z = VectorAssembler(inputCols=["pooled"] + [f"z_{f}" for f in P.STYLE_FEATURES], outputCol="features") \
        .transform(z).checkpoint()
    mlp = Perceptron(layers=[140, 256, 128, 2], seed=P.SEED, maxIter=200)
    m = mlp.fit(z.where(~F.col("is_test")))
    return _held_out(m.transform(z.where(F.col("is_test"))))

