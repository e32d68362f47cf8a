"""Score headlines as they land, with the same stages as batch preparation.

Language, length and artifact filters and labelling are stateless column
expressions, so they apply unchanged to a ``readStream`` source. Keep-first
dedupe becomes ``dropDuplicatesWithinWatermark`` on the headline (state is
bounded by the watermark; in a stream "first" means first to arrive). The
fitted pipeline is loaded from storage and applied per micro-batch.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from marquee.functions import patterns as P
from marquee.functions import text as TX
from marquee.operators import filters as FL
from marquee.plans.prepare import with_source
from marquee.sources.models import load_model

STREAM_SCHEMA = T.StructType([
    T.StructField("row_id", T.LongType()),
    T.StructField("url", T.StringType()),
    T.StructField("headline", T.StringType()),
    T.StructField("landed_at", T.TimestampType()),
])


def prepare_stream(stream: DataFrame, marker: str = P.OUTLET_A_SITE, a: str = P.OUTLET_A,
                   b: str = P.OUTLET_B, event_time: str = "landed_at",
                   dedupe_window: str = "1 day") -> DataFrame:
    h = F.col("headline")
    x = with_source(stream, marker, a, b)
    x = x.where(h.isNotNull() & ~FL.is_foreign_pass1(h) & FL.keeps_ratio(h)
                & FL.in_length_bounds(h) & ~FL.is_artifact(h) & F.col("source").isNotNull())
    x = x.withWatermark(event_time, dedupe_window).dropDuplicatesWithinWatermark(["headline"])
    return x.select("row_id", "headline", event_time, TX.encode_label(F.col("source"), a).alias("label"))


def start_scoring(spark: SparkSession, source_dir: str, model_path: str, sink_dir: str,
                  checkpoint: str, marker: str = P.OUTLET_A_SITE, a: str = P.OUTLET_A,
                  b: str = P.OUTLET_B, available_now: bool = True):
    """Parquet headlines in ``source_dir`` -> predictions in ``sink_dir``, one folder for each batch.

    ``checkpoint`` must be on shared storage: the query restarts from it
    after a driver or executor loss.
    """
    model = load_model(model_path)
    stream = spark.readStream.schema(STREAM_SCHEMA).parquet(source_dir)
    prepared = prepare_stream(stream, marker, a, b)

    def score(batch: DataFrame, batch_id: int) -> None:
        out = model.transform(batch).select("row_id", "headline", "label",
                                            F.col("prediction").cast("int").alias("prediction"))
        # a batch that runs again after a failure replaces its own rows
        out.write.mode("overwrite").parquet(f"{sink_dir.rstrip('/')}/batch_id={batch_id}")

    w = prepared.writeStream.foreachBatch(score).option("checkpointLocation", checkpoint)
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime="1 minute")
    return w.start()
