"""The pipeline's stages: decisions hold on the rows they were made for, whatever the splits of a scan."""

import re
from types import SimpleNamespace

import pyarrow as pa
import pytest
from brute import op1, op3
from pyspark.sql import functions as F

import corpus_pipeline
from marquee.llm import common, decontaminate, exact_dedup, simhash, toxicity
from marquee.llm.common import ready, table


def shifting(spark, monkeypatch, module):
    """Every materialised step changes how the next scan is split, as executors that come and go do."""
    keep, step = module.materialised, [0]

    def other_splits(df):
        out = keep(df)
        step[0] += 1
        spark.conf.set("spark.sql.files.maxPartitionBytes", str((1 << 20, 40_000, 9_000, 300_000)[step[0] % 4]))
        spark.conf.set("spark.sql.leafNodeDefaultParallelism", str((1, 13, 5, 29)[step[0] % 4]))
        spark.conf.set("spark.sql.files.openCostInBytes", str((1, 1 << 22, 4096, 1)[step[0] % 4]))
        return out
    monkeypatch.setattr(module, "materialised", other_splits)


@pytest.fixture
def splits(spark):
    names = ("spark.sql.files.maxPartitionBytes", "spark.sql.leafNodeDefaultParallelism", "spark.sql.files.openCostInBytes")
    before = {n: spark.conf.get(n, None) for n in names}
    yield
    for n, v in before.items():
        spark.conf.unset(n) if v is None else spark.conf.set(n, v)


def many(spark, tmp_path):
    """4,000 rows, a third of them copies, with wide texts in many row groups."""
    rows = [(i, f"text {i % 2700} " + f"w{(i % 2700) * 7919} " * 40 + (" " * (i % 3))) for i in range(4000)]
    path = str(tmp_path / "many.parquet")
    spark.createDataFrame(rows, "doc_id long, text string").repartition(9).write.parquet(path)
    return rows, spark.read.parquet(path)


def norm(t):
    return re.sub(r"[\x20\x09-\x0d]+", " ", t or "")


def test_keep_first_when_splits_change(spark, tmp_path, monkeypatch, splits):
    rows, df = many(spark, tmp_path)
    shifting(spark, monkeypatch, exact_dedup)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    got = sorted(r["doc_id"] for r in exact_dedup.keep_first(df).collect())
    first = {}
    for i, t in sorted(rows):
        first.setdefault(norm(t), i)
    assert got == sorted(first.values())


def test_keep_one_when_splits_change(spark, tmp_path, monkeypatch, splits):
    rows, df = many(spark, tmp_path)
    shifting(spark, monkeypatch, simhash)
    spark.conf.set("spark.sql.files.maxPartitionBytes", "20000")
    got = sorted(r["doc_id"] for r in simhash.keep_one(df).collect())
    assert got == sorted({c for _, _, c in op1(rows)})


def documents(spark, folder):
    return table(spark, folder, "documents")


def test_stages_on_odd_rows(spark, odd_dir):
    docs = documents(spark, odd_dir)
    stages = dict(corpus_pipeline.STAGES)
    kept = stages["exact_dedup"](spark, docs, odd_dir).collect()
    rows = [(r["doc_id"], r["text"]) for r in docs.collect()]
    assert len(kept) == len({norm(t) for _, t in rows}) == len({norm(r["text"]) for r in kept})
    assert kept[0].__fields__ == docs.columns
    near = stages["simhash_dedup"](spark, docs, odd_dir).collect()
    # ids repeat, so components are counted by their fingerprints
    left, groups = {int(f, 16) for _, f, _ in op1(rows)}, 0
    while left:
        todo, groups = [left.pop()], groups + 1
        while todo:
            f = todo.pop()
            linked = {g for g in left if (f ^ g).bit_count() <= 3}
            left -= linked
            todo += linked
    assert len(near) == groups and near[0].__fields__ == docs.columns
    clean = stages["decontamination"](spark, docs, odd_dir).collect()
    items = [(str(r["item_id"]) if r["item_id"] is not None else None, r["text"]) for r in table(spark, odd_dir, "benchmark").collect()]
    bad = [x[-1] for x in op3(rows, items)]
    assert len(clean) == len(rows) - sum(bad) and clean[0].__fields__ == docs.columns
    assert len(stages["toxicity"](spark, docs, odd_dir).collect()) <= len(rows)


def test_run_on_odd_and_empty_tables(spark, odd_dir, empty_dir):
    out = corpus_pipeline.run(spark, odd_dir).collect()
    assert out and {"doc_id", "n_tokens", "ids_sha256", "decoded_sha256"} <= set(out[0].__fields__)
    empty = corpus_pipeline.run(spark, empty_dir)
    assert empty.collect() == [] and empty.columns == list(out[0].__fields__)


def test_run_is_its_stages(spark, odd_dir):
    docs = documents(spark, odd_dir)
    for _, stage in corpus_pipeline.STAGES:
        docs = stage(spark, docs, odd_dir)
    assert sorted(map(repr, docs.collect())) == sorted(map(repr, corpus_pipeline.run(spark, odd_dir).collect()))


def test_clashing_names_stay(spark, odd_dir):
    docs = documents(spark, odd_dir)
    assert "score" in docs.columns
    kept = toxicity.without_toxic(docs, table(spark, odd_dir, "labels"))
    assert kept.columns == docs.columns and {r["score"] for r in kept.collect()} <= {0.5}


def test_workers_get_batches_of_bounded_bytes(spark):
    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.nbytes], pa.int64())], ["n"])
    rows = spark.range(0, 4000, 1, 1).select(F.repeat(F.lit("word "), 2000).alias("text"))    # 40 MB
    got = [r["n"] for r in ready(spark) and rows.mapInArrow(sizes, "n long").collect()]
    assert sum(got) > 35e6 and max(got) < 2 * common.BATCH_BYTES


@pytest.mark.parametrize("step", [simhash._fingerprint_batches(3), decontaminate._pass(SimpleNamespace(value=[]), 0), toxicity._count_words,
                                  toxicity._toxic_passages(SimpleNamespace(value=frozenset())), toxicity._hitters(SimpleNamespace(value=frozenset())),
                                  toxicity._only(SimpleNamespace(value=()))])
def test_a_step_lets_go_of_what_the_worker_kept(step, monkeypatch):
    monkeypatch.setattr(common, "_KEPT", {("bpe", "x"): object()})
    list(step(iter(())))
    assert not common._KEPT
