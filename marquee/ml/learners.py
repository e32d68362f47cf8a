"""Classifiers with the reference's parameterisation.

Stopping tolerances are the reference library's defaults (1e-4 for the
logistic and linear SVM solvers); iteration caps are kept as given but are
solver budgets, not model parameters (OWLQN iterations and coordinate-descent
epochs are not the same unit).

Built-in MLlib estimators are used where they exist; ``C`` (inverse
regularisation on a summed loss) becomes ``regParam = 1 / (C * n)`` on
MLlib's averaged loss. Estimators MLlib lacks are written on the same
pattern MLlib uses internally: the weights are broadcast, every partition
computes its gradient, and partial sums are combined with ``treeAggregate``:

* ``ElasticNetSGD``: modified-Huber / hinge / log / squared-hinge loss with
  an elastic-net penalty, minimised by FISTA (proximal step for L1);
* ``AdaBoostStumps`` (``boosting``): SAMME boosting of depth-1 trees over features binned once;
* ``DeepForest`` (``forest``): trees without a depth bound, grown in two phases;
* ``ExactKNN``: exact k nearest neighbours over pairs of bounded blocks, the
  k best of each pair merged per query row.

Iterative learners checkpoint their input to the shared checkpoint folder
so a lost executor recomputes from there, not from the whole lineage.
"""

from __future__ import annotations

import math

import numpy as np
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.classification import LinearSVC, LogisticRegression, NaiveBayes
from pyspark.ml.linalg import VectorUDT
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from marquee.functions import patterns as P
from marquee.ml.blocks import csr_block, csr_blocks
from marquee.ml.boosting import AdaBoostModel, AdaBoostStumps  # noqa: F401
from marquee.ml.forest import DeepForest
from marquee.session import checkpoint_dir


# --- C-parameterised wrappers around MLlib ------------------------------------

class _ScaledC(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    C = Param(Params._dummy(), "C", "inverse regularisation strength (summed loss)", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "iterations", TypeConverters.toInt)

    def _n(self, df):
        return df.agg(F.count(F.lit(1))).first()[0]


class ScaledLogisticRegression(_ScaledC):
    """L2 logistic regression, ``C`` as in liblinear/lbfgs solvers."""

    @keyword_only
    def __init__(self, C=1.0, maxIter=100, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, maxIter=100)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        lr = LogisticRegression(regParam=1.0 / (self.getOrDefault("C") * max(self._n(df), 1)),
                                elasticNetParam=0.0, standardization=False,
                                maxIter=self.getOrDefault("maxIter"), tol=1e-4,
                                featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                                predictionCol=self.getPredictionCol())
        return lr.fit(df)


class ScaledLinearSVC(_ScaledC):
    """Hinge-loss linear SVM; intercept unpenalised (MLlib)."""

    @keyword_only
    def __init__(self, C=1.0, maxIter=100, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, maxIter=100)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        svc = LinearSVC(regParam=1.0 / (self.getOrDefault("C") * max(self._n(df), 1)),
                        standardization=False, maxIter=self.getOrDefault("maxIter"), tol=1e-4,
                        featuresCol=self.getFeaturesCol(), labelCol=self.getLabelCol(),
                        predictionCol=self.getPredictionCol())
        return svc.fit(df)


def random_forest(n_estimators=100, max_depth=None, max_features="sqrt", min_samples_leaf=1, seed=P.SEED):
    """Depth is bounded only if ``max_depth`` says so."""
    return DeepForest(n_estimators, max_depth, max_features, min_samples_leaf, seed=seed)


def decision_tree(seed=P.SEED):
    return DeepForest(1, max_features=None, bootstrap=False, seed=seed)


def multinomial_nb(alpha=1.0):
    return NaiveBayes(modelType="multinomial", smoothing=alpha)


def complement_nb(alpha=1.0):
    return NaiveBayes(modelType="complement", smoothing=alpha)


# --- linear models trained with distributed gradients ---------------------------

_csr_block = csr_block


def _loss_grad(loss: str, z: np.ndarray, y01: np.ndarray):
    """Per-row loss and d loss / d margin for labels in {0,1} (y = 2*y01 - 1)."""
    y = 2.0 * y01 - 1.0
    m = y * z
    if loss == "hinge":
        return np.maximum(0.0, 1.0 - m), np.where(m < 1.0, -y, 0.0)
    if loss == "squared_hinge":
        h = np.maximum(0.0, 1.0 - m)
        return h * h, -2.0 * y * h
    if loss == "log_loss":
        l_ = np.logaddexp(0.0, -m)
        return l_, -y / (1.0 + np.exp(m))
    # modified_huber
    l_ = np.where(m >= -1.0, np.maximum(0.0, 1.0 - m) ** 2, -4.0 * m)
    g = np.where(m >= -1.0, -2.0 * y * np.maximum(0.0, 1.0 - m), -4.0 * y)
    return l_, g


class ElasticNetSGD(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol,
                    DefaultParamsReadable, DefaultParamsWritable):
    """Linear classifier minimising mean loss + alpha * (l1_ratio |w|_1 + (1 - l1_ratio)/2 |w|^2)."""
    loss = Param(Params._dummy(), "loss", "modified_huber | hinge | log_loss | squared_hinge", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty weight", TypeConverters.toFloat)
    penalty = Param(Params._dummy(), "penalty", "l2 | l1 | elasticnet", TypeConverters.toString)
    l1Ratio = Param(Params._dummy(), "l1Ratio", "elastic-net mixing", TypeConverters.toFloat)
    maxIter = Param(Params._dummy(), "maxIter", "FISTA iterations", TypeConverters.toInt)
    tol = Param(Params._dummy(), "tol", "relative objective change to stop", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, loss="modified_huber", alpha=1e-4, penalty="l2", l1Ratio=0.15, maxIter=100, tol=1e-6,
                 featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(loss="modified_huber", alpha=1e-4, penalty="l2", l1Ratio=0.15, maxIter=100, tol=1e-6)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        spark = df.sparkSession
        checkpoint_dir(spark)
        data = df.select(self.getFeaturesCol(), F.col(self.getLabelCol()).cast("double").alias("_y")).checkpoint()
        d = data.first()[0].size
        # bounded CSR blocks, kept on disk where memory ends (recomputed from the checkpoint if lost)
        blocks = data.rdd.mapPartitions(csr_blocks).filter(lambda b: b[3].size > 0).persist(StorageLevel.MEMORY_AND_DISK)
        n, max_sq = blocks.map(lambda b: (b[3].size, _max_square(b))).treeAggregate(
            (0, 0.0), lambda a, b: (a[0] + b[0], max(a[1], b[1])), lambda a, b: (a[0] + b[0], max(a[1], b[1])))
        loss = self.getOrDefault("loss")
        alpha = self.getOrDefault("alpha")
        pen = self.getOrDefault("penalty")
        rho = {"l2": 0.0, "l1": 1.0}.get(pen, self.getOrDefault("l1Ratio"))
        curv = {"hinge": 1.0, "log_loss": 0.25, "squared_hinge": 2.0}.get(loss, 2.0)
        lip = curv * (max_sq + 1.0) + alpha * (1.0 - rho)
        step = 1.0 / max(lip, 1e-12)
        sc = spark.sparkContext

        def grad_at(wb):
            bw = sc.broadcast(wb)

            def block_grad(b):
                indptr, idx, vals, y = b
                w_ = bw.value
                lens = np.diff(indptr)
                prod = vals * w_[idx]
                z = np.zeros(y.size)
                nz = lens > 0
                z[nz] = np.add.reduceat(prod, indptr[:-1][nz]) if prod.size else 0.0
                z += w_[d]
                l_, gz = _loss_grad(loss, z, y)
                g = np.bincount(idx, weights=vals * np.repeat(gz, lens), minlength=d + 1).astype(float)
                g[d] += gz.sum()
                return g, float(l_.sum())

            g, tot = blocks.map(block_grad).treeAggregate(
                (np.zeros(d + 1), 0.0), lambda a, b: (a[0] + b[0], a[1] + b[1]),
                lambda a, b: (a[0] + b[0], a[1] + b[1]))
            bw.destroy()
            return g / n, tot / n

        w = np.zeros(d + 1)
        yv, t_k, prev_obj = w.copy(), 1.0, None
        for _ in range(self.getOrDefault("maxIter")):
            g, data_loss = grad_at(yv)
            # loss and penalty of one point, for the stopping rule
            obj = data_loss + alpha * (rho * np.abs(yv[:d]).sum() + 0.5 * (1 - rho) * float(yv[:d] @ yv[:d]))
            g[:d] += alpha * (1.0 - rho) * yv[:d]
            nxt = yv - step * g
            thr = step * alpha * rho
            if thr > 0:
                nxt[:d] = np.sign(nxt[:d]) * np.maximum(np.abs(nxt[:d]) - thr, 0.0)
            t_next = (1.0 + math.sqrt(1.0 + 4.0 * t_k * t_k)) / 2.0
            yv = nxt + ((t_k - 1.0) / t_next) * (nxt - w)
            w, t_k = nxt, t_next
            if prev_obj is not None and abs(prev_obj - obj) <= self.getOrDefault("tol") * max(abs(prev_obj), 1.0):
                break
            prev_obj = obj
        blocks.unpersist()
        model = LinearScoreModel(coefficients=w[:d].tolist(), intercept=float(w[d]), loss=loss,
                                 featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())
        return model


def _max_square(block) -> float:
    """Largest squared length of a row of a CSR block; rows without entries have length zero."""
    indptr, _, vals, _ = block
    filled = indptr[:-1][np.diff(indptr) > 0]
    return float(np.add.reduceat(vals * vals, filled).max()) if filled.size else 0.0


def _margin(features: str, coef: list[float], intercept: float):
    """w.x + b over the stored entries of a sparse or dense vector, JVM-side.

    The weights travel as one text literal that is folded into a constant array."""
    v = F.unwrap_udt(F.col(features))
    w = F.split(F.lit(",".join(repr(float(c)) for c in coef)), ",").cast("array<double>")
    at = F.when(v["type"] == 0, v["indices"]).otherwise(F.sequence(F.lit(0), F.size(v["values"]) - 1))
    pairs = F.arrays_zip(at.alias("i"), v["values"].alias("x"))
    return F.aggregate(pairs, F.lit(0.0), lambda total, p: total + F.get(w, p["i"]) * p["x"]) + F.lit(intercept)


class LinearScoreModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    """margin = w.x + b; rawPrediction = [-m, m]; probability per loss; prediction = m > 0."""
    coefficients = Param(Params._dummy(), "coefficients", "weights", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "bias", TypeConverters.toFloat)
    loss = Param(Params._dummy(), "loss", "loss used to fit", TypeConverters.toString)

    @keyword_only
    def __init__(self, coefficients=None, intercept=0.0, loss="modified_huber", featuresCol="features",
                 predictionCol="prediction"):
        super().__init__()
        self._setDefault(intercept=0.0, loss="modified_huber")
        self._set(**self._input_kwargs)

    def _transform(self, df):
        m = _margin(self.getFeaturesCol(), self.getOrDefault("coefficients"), float(self.getOrDefault("intercept")))
        loss = self.getOrDefault("loss")
        if loss == "log_loss":
            p1 = 1.0 / (1.0 + F.exp(-F.col("_m")))
        elif loss == "modified_huber":
            p1 = (F.least(F.greatest(F.col("_m"), F.lit(-1.0)), F.lit(1.0)) + 1.0) / 2.0
        else:
            p1 = F.lit(None).cast("double")
        from pyspark.ml.functions import array_to_vector
        out = df.withColumn("_m", m)
        out = out.withColumn("rawPrediction", array_to_vector(F.array(-F.col("_m"), F.col("_m"))))
        if loss in ("log_loss", "modified_huber"):
            out = out.withColumn("probability", array_to_vector(F.array(1.0 - p1, p1)))
        return out.withColumn(self.getPredictionCol(), (F.col("_m") > 0).cast("double")).drop("_m")

    @property
    def coefficient_list(self):
        return self.getOrDefault("coefficients")


class CSquaredHinge(_ScaledC):
    """LinearSVC with squared hinge: alpha = 1 / (C n) is set at fit time."""

    @keyword_only
    def __init__(self, C=1.0, maxIter=200, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(C=1.0, maxIter=200)
        self._set(**self._input_kwargs)

    def _fit(self, df):
        n = max(self._n(df), 1)
        est = ElasticNetSGD(loss="squared_hinge", penalty="l2", alpha=1.0 / (self.getOrDefault("C") * n),
                            maxIter=self.getOrDefault("maxIter"), featuresCol=self.getFeaturesCol(),
                            labelCol=self.getLabelCol(), predictionCol=self.getPredictionCol())
        return est.fit(df)


# --- exact k nearest neighbours ------------------------------------------------

#: Bytes of vectors as stored in one block of either side, and of the part of a block that is made dense at a time.
KNN_BLOCK_BYTES, KNN_DENSE_BYTES = 64 << 20, 64 << 20


def _knn_dense(values, places, dim: int) -> np.ndarray:
    """Rows of stored values; rows without places hold every value."""
    out = np.zeros((len(values), dim))
    for row, v, at in zip(out, values, places):
        if at is None:
            row[:] = v
        else:
            row[np.asarray(at, np.int64)] = v
    return out


def _knn_block(k: int, dim: int):
    """The k nearest training rows of one block for each query of one block, ties by id; every tie is ranked exactly."""
    def search(te, tr):
        import pandas as pd
        cols = {"_qid": np.int64, "_tid": np.int64, "_tl": np.int64, "_d": np.float64}
        if te.empty or tr.empty:
            return pd.DataFrame({c: np.array([], t) for c, t in cols.items()})
        out, part = {c: [] for c in cols}, max(1, KNN_DENSE_BYTES // (8 * dim))
        for b in range(0, len(tr), part):                 # bounded dense rows; the k best of each part are merged below
            some = tr.iloc[b:b + part]
            mat = _knn_dense(some["_tv"], some["_ti"], dim)
            ids, labs, qids = some["_tid"].to_numpy(), some["_tl"].to_numpy(), te["_qid"].to_numpy()
            sq = np.einsum("ij,ij->i", mat, mat)
            for a in range(0, len(qids), 256):            # bounded distance matrix
                q = _knn_dense(te["_qv"].iloc[a:a + 256], te["_qi"].iloc[a:a + 256], dim)
                qsq = np.einsum("ij,ij->i", q, q)
                near = qsq[:, None] + sq[None, :] - 2.0 * (q @ mat.T)
                kth = np.partition(near, min(k, len(ids)) - 1, axis=1)[:, min(k, len(ids)) - 1]
                slack = 1e-9 * (qsq + sq.max() + 1.0)     # rounding of the expanded square
                for i in range(len(near)):
                    c = np.flatnonzero(near[i] <= kth[i] + slack[i])
                    diff = mat[c] - q[i]
                    exact = (diff * diff).sum(axis=1)
                    best = np.lexsort((ids[c], exact))[:k]
                    out["_qid"].append(np.full(len(best), qids[a + i]))
                    out["_tid"].append(ids[c][best])
                    out["_tl"].append(labs[c][best])
                    out["_d"].append(exact[best])
        found = pd.DataFrame({c: np.concatenate(v).astype(cols[c]) for c, v in out.items()})
        if len(tr) > part:
            found = found.sort_values(["_qid", "_d", "_tid"]).groupby("_qid", sort=False).head(k)
        return found
    return search


def _stored(df: DataFrame, col: str) -> tuple:
    """(places, values, size) of an array or vector column; places are null where every value is stored."""
    if isinstance(df.schema[col].dataType, VectorUDT):
        v = F.unwrap_udt(F.col(col))
        return v["indices"], v["values"], F.coalesce(v["size"], F.size(v["values"]))
    return F.lit(None).cast("array<int>"), F.col(col), F.size(F.col(col))


def knn_predict(train: DataFrame, test: DataFrame, k: int = 5, id_col: str = "vec_id",
                vec_col: str = "embedding", label_col: str = "label",
                block_bytes: int = KNN_BLOCK_BYTES) -> DataFrame:
    """Exact Euclidean k-NN with majority vote (ties -> smallest label).

    Both sides are cut into blocks of bounded bytes by a hash of the id; each
    pair of blocks meets in one task, which keeps the k best per query, and a
    top-k window merges the blocks. Neither the driver nor a broadcast holds
    training rows, and no pair of rows leaves a task but the k best.
    """
    tr_v, te_v = _stored(train, vec_col), _stored(test, vec_col)
    tr = train.select(F.col(id_col).alias("_tid"), tr_v[0].alias("_ti"), tr_v[1].alias("_tv"), F.col(label_col).cast("long").alias("_tl"))
    te = test.select(F.col(id_col).alias("_qid"), te_v[0].alias("_qi"), te_v[1].alias("_qv"))
    room = F.size("_tv") * F.when(F.col("_ti").isNull(), 8).otherwise(12)
    n_tr, dim, stored = train.select("*", tr_v[0].alias("_ti"), tr_v[1].alias("_tv")).agg(F.count(F.lit(1)), F.max(tr_v[2]), F.sum(room)).first()
    n_te, dim = te.count(), max(1, dim or 1)
    # vectors travel as they are stored, a task makes a part of its block dense at a time: large blocks, few copies of each row
    each = max(1, -(-(stored or 0) // max(1, n_tr)))
    per_block = max(1, block_bytes // each)
    b_tr, b_te = max(1, math.ceil(n_tr / per_block)), max(1, math.ceil(n_te / per_block))
    # as many pairs as there are cores: a few more copies of the queries' side
    b_te = min(max(b_te, -(-train.sparkSession.sparkContext.defaultParallelism // b_tr)), max(1, n_te))
    if b_tr == 1:  # one training block: spread the queries
        b_te = max(b_te, min(n_te or 1, int(train.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    tr = tr.withColumns({"_a": F.pmod(F.xxhash64("_tid"), F.lit(b_tr)), "_b": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(b_te - 1).cast("long")))})
    te = te.withColumns({"_b": F.pmod(F.xxhash64("_qid"), F.lit(b_te)), "_a": F.explode(F.sequence(F.lit(0).cast("long"), F.lit(b_tr - 1).cast("long")))})
    cands = te.groupBy("_a", "_b").cogroup(tr.groupBy("_a", "_b")).applyInPandas(
        _knn_block(k, dim), "_qid long, _tid long, _tl long, _d double")
    w = W.partitionBy("_qid").orderBy("_d", "_tid")
    top = cands.withColumn("_r", F.row_number().over(w)).where(F.col("_r") <= k)
    votes = top.groupBy("_qid", "_tl").agg(F.count(F.lit(1)).alias("_n"))
    best = votes.groupBy("_qid").agg(F.max(F.struct(F.col("_n"), (-F.col("_tl")).alias("_neg"))).alias("_b"))
    return best.select(F.col("_qid").alias(id_col), (-F.col("_b._neg")).cast("int").alias("prediction"))


class ExactKNN(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """k-NN over a vector column (dense or sparse); needs an id column."""
    k = Param(Params._dummy(), "k", "neighbours", TypeConverters.toInt)
    idCol = Param(Params._dummy(), "idCol", "row id column", TypeConverters.toString)

    @keyword_only
    def __init__(self, k=5, idCol="row_id", featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(k=5, idCol="row_id")
        self._set(**self._input_kwargs)

    def _fit(self, df):
        return ExactKNNModel(df.select(self.getOrDefault("idCol"), self.getFeaturesCol(), self.getLabelCol()),
                             self.getOrDefault("k"), self.getOrDefault("idCol"), self.getFeaturesCol(),
                             self.getLabelCol(), self.getPredictionCol())


class ExactKNNModel(Model):
    def __init__(self, train=None, k=5, idCol="row_id", featuresCol="features", labelCol="label",
                 predictionCol="prediction"):
        super().__init__()
        self.train, self.kk, self.idc, self.fc, self.lc, self.pc = train, k, idCol, featuresCol, labelCol, predictionCol

    def _transform(self, df):
        tr = self.train.select(F.col(self.idc).alias("vec_id"), F.col(self.fc).alias("embedding"),
                               F.col(self.lc).cast("int").alias("label"))
        te = df.select(F.col(self.idc).alias("vec_id"), F.col(self.fc).alias("embedding"))
        pred = knn_predict(tr, te, self.kk).withColumnRenamed("vec_id", self.idc)
        return df.join(pred.select(self.idc, F.col("prediction").cast("double").alias(self.pc)), self.idc, "left")
