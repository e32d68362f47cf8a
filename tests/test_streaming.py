import datetime as dt
import os

from pyspark.sql import functions as F

from marquee.session import scratch_path
from marquee.streaming.score_stream import STREAM_SCHEMA, prepare_stream


def test_prepare_stream_dedupes_and_filters(spark):
    src = scratch_path(spark, "stream-src")
    t0 = dt.datetime(2026, 1, 1)
    rows = [(1, "https://www.foxnews.com/a", "A perfectly normal headline of decent size", t0),
            (2, "https://nbcnews.com/b", "A perfectly normal headline of decent size", t0),
            (3, "https://nbcnews.com/c", "El presidente dice que la casa de él está", t0),
            (4, "https://nbcnews.com/d", "Another long enough headline for the stream", t0)]
    spark.createDataFrame(rows, STREAM_SCHEMA).write.parquet(src)
    stream = spark.readStream.schema(STREAM_SCHEMA).parquet(src)
    q = (prepare_stream(stream).writeStream.format("memory").queryName("prepared_stream_test")
         .option("checkpointLocation", scratch_path(spark, "stream-ckpt")).trigger(availableNow=True).start())
    q.awaitTermination(120)
    out = {r["headline"]: r["label"] for r in spark.sql("SELECT * FROM prepared_stream_test").collect()}
    assert out == {"A perfectly normal headline of decent size": out["A perfectly normal headline of decent size"],
                   "Another long enough headline for the stream": 0}
    assert len(out) == 2


def test_start_scoring_end_to_end(spark):
    from marquee.ml import features as FT
    from marquee.ml import learners as L
    from marquee.plans import fixtures as X
    from marquee.sources.models import save_model
    from marquee.streaming.score_stream import start_scoring
    from testing_data import SF001
    train = X.turn_train(spark, SF001)
    model = FT.build_pipeline(FT.CONFIGS["Baseline"], L.ScaledLogisticRegression(C=1.0, maxIter=50)).fit(train)
    model_path = scratch_path(spark, "stream-model")
    save_model(model, model_path)
    src = scratch_path(spark, "stream-score-src")
    t0 = dt.datetime(2026, 1, 1)
    spark.createDataFrame([(1, "https://www.foxnews.com/a", "A perfectly normal headline of decent size", t0),
                           (2, "https://nbcnews.com/b", "Another long enough headline for the stream", t0)],
                          STREAM_SCHEMA).write.parquet(src)
    sink = scratch_path(spark, "stream-score-sink")
    q = start_scoring(spark, src, model_path, sink, scratch_path(spark, "stream-score-ckpt"))
    q.awaitTermination(180)
    out = spark.read.parquet(sink).collect()
    assert sorted(r["row_id"] for r in out) == [1, 2]
    assert {r["label"] for r in out} == {0, 1} and all(r["prediction"] in (0, 1) for r in out)
