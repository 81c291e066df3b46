"""Streaming form of the per-(warehouse, hour) query run time (K4 + F8 as a stream).

The batch models reprocess a look-back window on every run to catch late queries.
Structured Streaming expresses the same intent with event-time state: query intervals
arrive from a file source, are cut into clock hours (a stateless ``explode``), and the
run time per (warehouse, hour) is summed in state that the watermark closes
``lateness`` after the hour ends. Closed hours are appended to a parquet sink, so
downstream allocation reads final totals. State is bounded by warehouses x open hours,
and the checkpoint location makes the query restartable after failures.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.operators.spine import slice_intervals
from ledgerlight.session import is_file

QUERY_INTERVALS = T.StructType([
    T.StructField("query_id", T.StringType()), T.StructField("warehouse_id", T.LongType()),
    T.StructField("start_time", T.TimestampType()), T.StructField("end_time", T.TimestampType())])


def hourly_run_time(intervals: DataFrame, lateness: str = "3 days") -> DataFrame:
    """Milliseconds of query run time per warehouse and clock hour, event-time windowed.
    Works on a streaming or a static DataFrame."""
    sliced = slice_intervals(intervals, end="end_time", anchor="start_time", ms_col="ms")
    return (sliced.withWatermark("hour_start", lateness)
            .groupBy("warehouse_id", F.window("hour_start", "1 hour").alias("w"))
            .agg(F.sum("ms").alias("total_query_milliseconds_in_hour"),
                 F.count(F.lit(1)).alias("slices"))
            .select("warehouse_id", F.col("w.start").alias("hour"),
                    "total_query_milliseconds_in_hour", "slices"))


def start_hourly_run_time(spark: SparkSession, source_dir: str, sink_dir: str, checkpoint: str,
                          lateness: str = "3 days", available_now: bool = True):
    """Run the stream from parquet files of query intervals into a parquet sink."""
    stream = spark.readStream.schema(QUERY_INTERVALS).parquet(source_dir)
    writer = (hourly_run_time(stream, lateness).writeStream.format("parquet")
              .option("path", sink_dir).option("checkpointLocation", checkpoint).outputMode("append"))
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime="1 minute")
    return writer.start()


def event_intervals(events: DataFrame) -> DataFrame:
    """Query intervals from the test ``events`` table (the binding of ``testbed``):
    warehouse = user, end = ts + floor(value * 60) seconds."""
    start = F.col("ts").cast("timestamp")
    return events.select(F.col("event_id").cast("string").alias("query_id"),
                         F.col("user_id").alias("warehouse_id"), start.alias("start_time"),
                         F.timestamp_add("SECOND", F.floor(F.col("value") * 60), start).alias("end_time"))


def events_stream(spark: SparkSession, events_path: str, files_per_trigger: int | None = None) -> DataFrame:
    """A stream of an events table: a file, or a folder of part files."""
    source = spark.readStream.schema(spark.read.parquet(events_path).schema)
    if files_per_trigger:
        source = source.option("maxFilesPerTrigger", files_per_trigger)
    if is_file(spark, events_path):  # a file source streams a folder
        folder, _, name = events_path.rpartition("/")
        return source.option("pathGlobFilter", name).parquet(folder)
    return source.parquet(events_path)


def drain(result: DataFrame, base: str) -> None:
    """Append a stream's result to ``<base>/sink`` until its input is used up."""
    (result.writeStream.format("parquet").option("path", f"{base}/sink").option("checkpointLocation", f"{base}/checkpoint")
     .outputMode("append").trigger(availableNow=True).start().awaitTermination())


def run_events_stream(spark: SparkSession, events_path: str, base: str, lateness: str) -> DataFrame:
    """Stream an events table through ``hourly_run_time`` until drained; return the closed hours
    written to the sink (a batch read of it)."""
    drain(hourly_run_time(event_intervals(events_stream(spark, events_path)), lateness), base)
    table = spark.read.parquet(events_path)
    return spark.read.schema(hourly_run_time(event_intervals(table), lateness).schema).parquet(f"{base}/sink")
