"""ST1: score arriving rows with a stored forest (Structured Streaming).

Stateless: ``readStream`` (parquet, explicit schema) -> the same
``predict`` used in batch -> append sink.  Checkpoints live under the
cluster's checkpoint folder, so a restarted query resumes where it
stopped.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from sylvan.operators import score as SC
from sylvan.operators.forest import ForestModel
from sylvan.session import scratch_path


def scoring_stream(stream: DataFrame, model: ForestModel, uncertainty: bool = True,
                   features=None, scaler=None, confidence_level: float | None = None,
                   price_adjust: bool = False) -> DataFrame:
    """The streaming twin of batch scoring (one function for both):
    optional feature step (e.g. ``features.scoring_features``), fitted
    scaler, prediction with uncertainty, interval and price adjustment.
    Every step is a per-row projection, so the query is stateless."""
    from sylvan.operators.features import price_adjust as _price
    d = features(stream) if features is not None else stream
    d = scaler.transform(d) if scaler is not None else d
    out = SC.predict(d, model, uncertainty=uncertainty or confidence_level is not None)
    if confidence_level is not None:
        out = SC.prediction_interval(out, confidence_level=confidence_level)
    return _price(out) if price_adjust else out


def start_scoring(spark: SparkSession, source_dir: str, schema, model: ForestModel, sink_dir: str,
                  checkpoint_dir: str, available_now: bool = True, processing_time: str | None = None,
                  **steps):
    """Start a parquet-to-parquet scoring query; returns the handle.
    ``steps``: the arguments of :func:`scoring_stream`."""
    src = spark.readStream.schema(schema).parquet(source_dir)
    out = scoring_stream(src, model, **steps)
    w = out.writeStream.format("parquet").option("checkpointLocation", checkpoint_dir) \
        .option("path", sink_dir).outputMode("append")
    if available_now:
        w = w.trigger(availableNow=True)
    elif processing_time:
        w = w.trigger(processingTime=processing_time)
    return w.start()


def stream_score_available_now(spark: SparkSession, rows: DataFrame, model: ForestModel, **steps) -> DataFrame:
    """Land ``rows`` in a folder, run the stream to completion with an
    ``availableNow`` trigger and read the sink back."""
    src = scratch_path(spark, "stream-src")
    rows.write.parquet(src)
    sink = scratch_path(spark, "stream-sink")
    q = start_scoring(spark, src, rows.schema, model, sink, scratch_path(spark, "stream-ckpt"), **steps)
    q.awaitTermination()
    return spark.read.parquet(sink)
