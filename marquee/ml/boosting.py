"""AdaBoost (SAMME) with stumps over features that are binned once.

The blocks of the training rows hold, for every stored value, its place in a
histogram of (feature, bin). A round adds up two weighted histograms over
all partitions, the driver takes the best cut of all features and the round's weight from
the same sums, and the next round's row weights follow from the stumps so far, so no
table is written and no state is kept between rounds: a block that is
made again after a lost executor gives the same sums.
"""

from __future__ import annotations

import math

import numpy as np
import pandas as pd
from pyspark import StorageLevel, keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from marquee.ml.blocks import csr_blocks
from marquee.ml.forest import BINS, _best, _thresholds
from marquee.session import checkpoint_dir


class _Binned:
    """A block by place in the histogram of all features; rows without a value are added by the driver."""

    def __init__(self, block, cuts: dict[int, np.ndarray]):
        indptr, idx, vals, self.y = block
        row = np.repeat(np.arange(self.y.size), np.diff(indptr))
        order = np.argsort(idx, kind="stable")
        col, self.row, val = idx[order], row[order], vals[order].astype(np.float32)
        self.col, self.val, place = col, val, np.zeros(col.size, np.int64)
        starts = np.flatnonzero(np.concatenate(([True], col[1:] != col[:-1]))) if col.size else []
        for a, b in zip(starts, [*starts[1:], col.size]):
            cut = cuts.get(int(col[a]))
            place[a:b] = np.searchsorted(cut, val[a:b], "left") if cut is not None else 0
        self.place = col * BINS + place

    def values(self, f: int) -> np.ndarray:
        a, b = np.searchsorted(self.col, [f, f + 1])
        out = np.zeros(self.y.size, np.float32)
        out[self.row[a:b]] = self.val[a:b]
        return out

    def weights(self, stumps: list[tuple], shift: float) -> np.ndarray:
        """Weight of every row after these stumps; ``shift`` is the logarithm of what they sum up to."""
        log = np.full(self.y.size, -shift)
        for f, threshold, left, right, alpha in stumps:
            said = np.where(self.values(f) <= threshold, left, right)
            log += alpha * (said != self.y)
        return np.exp(log)


class AdaBoostStumps(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    """SAMME with depth-1 trees for labels 0 and 1."""
    nEstimators = Param(Params._dummy(), "nEstimators", "rounds", TypeConverters.toInt)

    @keyword_only
    def __init__(self, nEstimators=50, featuresCol="features", labelCol="label", predictionCol="prediction"):
        super().__init__()
        self._setDefault(nEstimators=50)
        self._set(**self._input_kwargs)

    def _fit(self, df: DataFrame):
        spark = df.sparkSession
        checkpoint_dir(spark)
        data = df.select(self.getFeaturesCol(), F.col(self.getLabelCol()).cast("double").alias("_y")).checkpoint()
        total, sc = data.first()[0].size, spark.sparkContext

        def numbered(i, rows):
            # bounded blocks: what a task holds does not grow with its partition; the first has the partition's number
            return (((j << 32) + i, b) for j, b in enumerate(csr_blocks(rows)) if b[3].size)
        raw = data.rdd.mapPartitionsWithIndex(numbered)
        n = raw.map(lambda b: int(b[1][3].size)).sum()
        cuts = _thresholds(raw, n)
        sent_cuts = sc.broadcast(cuts)                    # bounded: BINS numbers a feature
        blocks = raw.map(lambda b: _Binned(b[1], sent_cuts.value)).persist(StorageLevel.MEMORY_AND_DISK)
        zero = np.zeros(total, np.int64)                  # the bin of rows without a value
        for f, cut in cuts.items():
            zero[f] = np.searchsorted(cut, 0, "left")
        none = np.array([f not in cuts for f in range(total)])
        stumps: list[tuple] = []
        shift = math.log(max(n, 1))
        for _ in range(self.getOrDefault("nEstimators")):
            sent = sc.broadcast(list(stumps))

            def sums(b, shift=shift):
                w = b.weights(sent.value, shift)
                k = total * BINS
                return (np.bincount(b.place, w[b.row], k), np.bincount(b.place, (w * b.y)[b.row], k), w.sum(), (w * b.y).sum())
            h, t, all_w, ones = blocks.map(sums).treeReduce(lambda a, b: tuple(x + y for x, y in zip(a, b)))
            sent.destroy()
            h, t = h.reshape(total, BINS), t.reshape(total, BINS)
            h[np.arange(total), zero] += all_w - h.sum(axis=1)
            t[np.arange(total), zero] += ones - t.sum(axis=1)
            h[none], t[none] = 0.0, 0.0                   # never split: put all rows on one side
            h[none, 0], t[none, 0] = all_w, ones
            gain, f, cut = _best(h, t, 0)
            if gain <= -0.5:
                f, cut = 0, BINS - 1
            nl, tl = h[f, :cut + 1].sum(), t[f, :cut + 1].sum()
            left, right = float(2 * tl > nl), float(2 * (ones - tl) > all_w - nl)
            wrong = (nl - tl if left else tl) + ((all_w - nl) - (ones - tl) if right else ones - tl)
            err = max(0.0, wrong / all_w)
            threshold = float(cuts[f][cut]) if f in cuts and cut < len(cuts[f]) else math.inf
            if err <= 1e-12:
                stumps.append((f, threshold, left, right, 1.0))
                break
            if err >= 0.5:
                if not stumps:
                    stumps.append((f, threshold, left, right, 1.0))
                break
            alpha = math.log((1.0 - err) / err)
            stumps.append((f, threshold, left, right, alpha))
            shift += math.log(all_w) + math.log1p(err * math.expm1(alpha))
        blocks.unpersist()
        return AdaBoostModel(stumps=[float(x) for s in stumps for x in s], featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())


class AdaBoostModel(Model, HasFeaturesCol, HasPredictionCol, DefaultParamsReadable, DefaultParamsWritable):
    stumps = Param(Params._dummy(), "stumps", "feature, threshold, left, right, weight of each round", TypeConverters.toListFloat)

    @keyword_only
    def __init__(self, stumps=None, featuresCol="features", predictionCol="prediction"):
        super().__init__()
        self._set(**self._input_kwargs)

    def rounds(self) -> list[tuple]:
        flat = self.getOrDefault("stumps")
        return [(int(flat[a]), *flat[a + 1:a + 5]) for a in range(0, len(flat), 5)]

    def _transform(self, df: DataFrame) -> DataFrame:
        rounds = self.rounds()
        used = np.array(sorted({r[0] for r in rounds}))

        @F.pandas_udf("double")
        def score(v: pd.DataFrame) -> pd.Series:
            x = np.zeros((len(v), used.size), np.float32)  # the few features that stumps look at
            for i, (kind, idx, vals) in enumerate(zip(v["type"], v["indices"], v["values"])):
                if kind == 0:
                    at = np.searchsorted(idx, used)
                    hit = at < len(idx)
                    hit[hit] = idx[at[hit]] == used[hit]
                    x[i, hit] = vals[at[hit]]
                else:
                    x[i] = vals[used]
            out = np.zeros(len(v))
            for f, threshold, left, right, alpha in rounds:
                said = np.where(x[:, np.searchsorted(used, f)] <= threshold, left, right)
                out += alpha * (2.0 * said - 1.0)
            return pd.Series(out)
        total = sum(r[4] for r in rounds) or 1.0
        out = df.withColumn("_s", score(F.unwrap_udt(F.col(self.getFeaturesCol()))))
        p1 = (F.col("_s") / total + 1.0) / 2.0
        return out.withColumns({"rawPrediction": array_to_vector(F.array(-F.col("_s"), F.col("_s"))),
                                "probability": array_to_vector(F.array(1.0 - p1, p1)),
                                self.getPredictionCol(): (F.col("_s") > 0).cast("double")}).drop("_s")
