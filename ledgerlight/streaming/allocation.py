"""Hourly bills shared over query slices as streams meet (K5, D14 on streams).

Two streams, query slices and metered hours, both with a watermark on the hour. A first
operator adds up the slices of every (warehouse, hour) and gives the total away once the watermark
has closed the hour; then the total meets the hour's bill, and both meet the slices again. Every
join has the hour, an event time of both its sides, among its keys, so Spark drops slices,
totals and bills of closed hours from its state: it holds the hours that are still open.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.num import div0
from ledgerlight.operators.spine import slice_intervals


def hour_slices(intervals: DataFrame, lateness: str) -> DataFrame:
    """(query_id, warehouse_id, hour, ms), the hour an event time."""
    sliced = slice_intervals(intervals, end="end_time", anchor="start_time", ms_col="ms")
    return sliced.select("query_id", "warehouse_id", F.col("hour_start").alias("hour"), "ms").withWatermark("hour", lateness)


def allocate_stream(intervals: DataFrame, billed: DataFrame, lateness: str = "24 hours") -> DataFrame:
    """(query_id, warehouse_id, hour, ms, fraction, allocated) of closed hours. ``billed``:
    (warehouse_id, hour, billed), one row for each hour."""
    totals = (hour_slices(intervals, lateness).groupBy("warehouse_id", "hour")
              .agg(F.sum("ms").alias("total_ms")))
    bills = billed.select("warehouse_id", "hour", "billed").withWatermark("hour", lateness)
    fraction = div0(F.col("ms"), F.col("total_ms"))
    return (hour_slices(intervals, lateness).join(bills, ["warehouse_id", "hour"]).join(totals, ["warehouse_id", "hour"])
            .select("query_id", "warehouse_id", "hour", "ms", fraction.alias("fraction"), (F.col("billed") * fraction).alias("allocated")))
