"""Busy sessions of warehouses: queries of a warehouse that overlap, or start at most ``idle``
after it was last busy, are one session. On a stream the sessions are state that merges as
rows come in; the watermark closes them."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

IDLE_SECONDS = 300


def busy_sessions(intervals: DataFrame, idle_seconds: int = IDLE_SECONDS, lateness: str = "24 hours") -> DataFrame:
    """(warehouse_id, busy_from, busy_to, queries, run_seconds) of a stream or a static table.
    ``busy_to`` is when the last query of the session ended. Queries that end before they start
    are left out."""
    seconds = F.unix_seconds("end_time") - F.unix_seconds("start_time")
    rows = intervals.where("end_time >= start_time and warehouse_id is not null").select(
        "warehouse_id", "start_time", "end_time", seconds.alias("seconds"))
    gap = F.concat((F.col("seconds") + idle_seconds).cast("string"), F.lit(" seconds"))
    return (rows.withWatermark("start_time", lateness)
            .groupBy("warehouse_id", F.session_window("start_time", gap).alias("w"))
            .agg(F.count(F.lit(1)).alias("queries"), F.sum("seconds").alias("run_seconds"), F.max("end_time").alias("busy_to"))
            .select("warehouse_id", F.col("w.start").alias("busy_from"), "busy_to", "queries", "run_seconds"))
