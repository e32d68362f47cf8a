"""What a task or the driver holds at a time."""

import numpy as np
from pyspark import Broadcast
from pyspark.ml.linalg import Vectors

from marquee.ml import forest as FO
from marquee.ml import learners as L
from marquee.ml import linear_grid as LG
from marquee.ml.blocks import csr_block, csr_blocks


def _rows(n):
    rng = np.random.default_rng(1)
    return [(Vectors.sparse(9, sorted(rng.choice(9, 3, replace=False).tolist()), rng.normal(size=3)), float(i % 2)) for i in range(n)]


def test_blocks_of_a_partition_are_bounded():
    rows = _rows(50)
    parts, whole = list(csr_blocks(rows, 30)), next(csr_block(rows))
    assert [p[3].size for p in parts] == [10] * 5 and list(csr_blocks([])) == []
    for k in (1, 2, 3):
        assert np.array_equal(np.concatenate([p[k] for p in parts]), whole[k])
    assert next(csr_block([]))[3].size == 0


def test_features_of_a_block_are_looked_up_once():
    block = next(csr_block(_rows(50)))
    compact = LG._compact(block)
    dense = np.zeros((50, 9))
    dense[np.repeat(np.arange(50), np.diff(block[0])), block[1]] = block[2]
    for most in (1, 40, 10**6):
        got = np.zeros((0, 9))
        for used, x, _ in LG._stretches(compact, most):
            wide = np.zeros((len(x), 9))
            wide[:, used] = x
            got = np.vstack([got, wide])
        assert np.array_equal(got, dense)


def test_grafted_trees_stay_arrays():
    g = FO._Growing()
    g.add(0.5)
    left, right = g.split(0, 3, 0.5, 0.1, 0.9)
    leaf = np.array([FO.LEAF] * 3, np.int32)
    sub = FO.Tree(np.array([7, -1, -1], np.int32), np.array([1, 0, 0], np.float32), np.array([1, -1, -1], np.int32), np.array([2, -1, -1], np.int32),
                  np.array([.1, 0, 1], np.float32))
    g.graft(left, sub)
    g.graft(right, FO.Tree(sub.feature.copy(), sub.threshold, sub.left, sub.right, sub.p))
    assert len(g.feature) == 3                            # no list has grown
    t = g.done()
    assert t.feature.tolist() == [3, 7, 7, -1, -1, -1, -1] and t.left.tolist()[:3] == [1, 3, 5] and t.right.tolist()[:3] == [2, 4, 6]
    assert (t.left[3:5] == leaf[:2]).all() and t.p.tolist()[3:] == [0, 1, 0, 1]


def test_broadcasts_of_a_pass_are_destroyed(spark, monkeypatch):
    """Deep trees take many passes; what a pass sends does not stay on the driver, and thresholds are sent once."""
    rows = spark.sparkContext.parallelize(_rows(60), 3)
    blocks = rows.mapPartitionsWithIndex(lambda i, x: [(i, next(csr_block(x)))]).cache()
    sent, gone = [], []
    real, end = type(spark.sparkContext).broadcast, Broadcast.destroy

    def broadcast(self, value):
        sent.append(value)
        return real(self, value)

    def destroy(self, blocking=False):
        gone.append(self)
        end(self, blocking)
    monkeypatch.setattr(type(spark.sparkContext), "broadcast", broadcast)
    monkeypatch.setattr(Broadcast, "destroy", destroy)
    FO.train(blocks, 9, 60, 1, FO.Rules(9, 9, 1, 1e9, 3, False), cells=9 * 8)
    assert len(sent) > 3 and len(gone) == len(sent) and sum(isinstance(v, dict) for v in sent) == 1


def test_sparse_neighbours_travel_as_stored(spark, monkeypatch):
    """Sparse vectors give the neighbours of dense ones, in as many rows to a block as their stored entries allow."""
    rng = np.random.default_rng(6)
    rows = [(i, Vectors.sparse(50, sorted(rng.choice(50, 2, replace=False).tolist()), rng.normal(size=2)) if i % 7 else Vectors.dense(rng.normal(size=50)),
             int(rng.integers(0, 3))) for i in range(80)]
    df = spark.createDataFrame(rows, ["vec_id", "v", "label"])
    dense = spark.createDataFrame([(i, v.toArray().tolist(), y) for i, v, y in rows], ["vec_id", "embedding", "label"])
    seen = []
    real = L._knn_block
    monkeypatch.setattr(L, "_knn_block", lambda k, dim: seen.append(dim) or real(k, dim))
    want = {r[0]: r[1] for r in L.knn_predict(dense.where("vec_id >= 20"), dense.where("vec_id < 20"), 3).collect()}
    for size in (500, 1 << 20):
        got = L.knn_predict(df.where("vec_id >= 20"), df.where("vec_id < 20"), 3, vec_col="v", block_bytes=size)
        assert {r[0]: r[1] for r in got.collect()} == want and len(want) == 20
    assert seen == [50] * 3


def test_weights_write_no_counts_of_terms_outside_the_vocabulary(spark, monkeypatch):
    """The counts of all terms take many times the room of the texts; only the vocabulary is written."""
    from marquee.plans import catalog
    from testing_data import SF001
    frame, written = type(spark.range(1)), []
    real = frame.checkpoint
    monkeypatch.setattr(frame, "checkpoint", lambda self, *more: written.append(self.columns) or real(self, *more))
    rows = catalog.q_tfidf_long(spark, SF001).collect()
    assert rows and ["term", "df", "total", "idx", "idf"] in written and not any("tf" in columns for columns in written)
