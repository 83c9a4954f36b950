"""Guardrails on a stream of requests (K1, K2 in Structured Streaming).

The guard is a stateless projection, so the streaming query is the batch
expression on a ``readStream`` source: no watermark or state store is
needed, every micro-batch is independent, and the file sink plus the
checkpoint give exactly-once output across restarts and lost executors.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from ..operators.guardrails import flatten_guard, guard

REQUEST_SCHEMA = T.StructType([
    T.StructField("request_id", T.StringType()), T.StructField("user_message", T.StringType()),
    T.StructField("output", T.StringType()), T.StructField("toxicity_raw", T.StringType()),
    T.StructField("quality_raw", T.StringType())])


def guard_stream(spark: SparkSession, source_dir: str, schema: T.StructType = REQUEST_SCHEMA,
                 monitor_pct: float = 100.0, max_files_per_trigger: int | None = None) -> DataFrame:
    """Streaming DataFrame of flattened guard results over parquet request files."""
    reader = spark.readStream.schema(schema)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return flatten_guard(guard(reader.parquet(source_dir), monitor_pct=monitor_pct))


def run_to_sink(stream: DataFrame, sink_dir: str, checkpoint_dir: str, available_now: bool = True,
                processing_time: str | None = None):
    """Start the query with a parquet sink; ``availableNow`` drains what is
    there and stops, ``processing_time`` keeps it running."""
    w = stream.writeStream.format("parquet").option("path", sink_dir) \
        .option("checkpointLocation", checkpoint_dir).outputMode("append")
    w = w.trigger(availableNow=True) if available_now else w.trigger(processingTime=processing_time or "10 seconds")
    return w.start()
