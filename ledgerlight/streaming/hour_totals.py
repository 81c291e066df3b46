"""Hourly run time that late rows correct: a stream into a table by ``foreachBatch``.

A watermark closes an hour for good; what comes later is lost. Here every micro-batch's sums per
(warehouse, hour) are kept as its own rows, under its batch id, and the totals of the hours
that it touches are upserted: the sum over all batches. A batch that Spark delivers again
writes its rows in place of the ones it wrote before, so it changes nothing. Late rows correct
hours of any age, and hours are there while they are still open.

``<base>/batches``  (warehouse_id, hour, ms, slices) by (batch, date)
``<base>/totals``   (warehouse_id, hour, total_query_milliseconds_in_hour, slices) by date
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.operators.spine import slice_intervals
from ledgerlight.session import materialize
from ledgerlight.streaming.incremental import path_exists, read_target, touched_partitions, upsert

BATCHES = "warehouse_id long, hour timestamp, ms long, slices long, batch long, _date date"


def batch_sums(intervals: DataFrame) -> DataFrame:
    sliced = slice_intervals(intervals, end="end_time", anchor="start_time", ms_col="ms")
    return (sliced.groupBy("warehouse_id", F.col("hour_start").alias("hour"))
            .agg(F.sum("ms").alias("ms"), F.count(F.lit(1)).alias("slices")))


def write_batch(spark: SparkSession, base: str, intervals: DataFrame, batch_id: int) -> None:
    """Keep a batch's sums, and bring the totals of the hours it touches, or touched before, up to
    date."""
    folder, key = f"{base}/batches/batch={batch_id}", ["warehouse_id", "hour"]
    sums = materialize(batch_sums(intervals).withColumn("_date", F.to_date("hour")), "batch-sums")
    hours = sums.select(*key, "_date")
    if path_exists(spark, folder):
        hours = hours.unionByName(spark.read.schema(BATCHES).option("basePath", f"{base}/batches").parquet(folder).select(*key, "_date"))
    hours = materialize(hours.distinct(), "batch-hours")
    sums.write.mode("overwrite").option("partitionOverwriteMode", "static").partitionBy("_date").parquet(folder)
    near = touched_partitions(spark.read.schema(BATCHES).parquet(f"{base}/batches"), "_date", hours)
    own = hours.select(*[F.col(k).alias(f"_{k}") for k in key])
    totals = (near.join(own, [F.col(k).eqNullSafe(F.col(f"_{k}")) for k in key], "left_semi").groupBy(*key, "_date")
              .agg(F.sum("ms").alias("total_query_milliseconds_in_hour"), F.sum("slices").alias("slices")))
    upsert(spark, f"{base}/totals", totals, key, "_date", remove=hours)


def start_hour_totals(intervals: DataFrame, base: str):
    """Run a stream of query intervals into the totals until it is drained."""
    spark = intervals.sparkSession
    return (intervals.writeStream.foreachBatch(lambda df, batch_id: write_batch(spark, base, df, batch_id))
            .option("checkpointLocation", f"{base}/checkpoint").trigger(availableNow=True).start())


def hour_totals(spark: SparkSession, base: str) -> DataFrame:
    if not path_exists(spark, f"{base}/totals"):
        return spark.createDataFrame([], "warehouse_id long, hour timestamp, total_query_milliseconds_in_hour long, slices long")
    return read_target(spark, f"{base}/totals").drop("_date")
