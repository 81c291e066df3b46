"""Cost per query brought up to date by what changed, whatever its age (K5, L2).

A look-back recomputes the queries of the last days; a row that comes later than that, or a
metering correction further back, never counts. Here the changed input rows name what they
touch, and only that is computed again:

* a changed query touches the (warehouse, hour)s of its slices, in its old and its new form;
* a changed metering row touches its (warehouse, hour), and, through the day's billable cloud
  services, every query that started that day; so does a changed rate of a day;
* a query that ended after the last metered hour is costed once metering has come that far.

The affected queries are those with a slice in a touched (warehouse, hour), those that started
on a touched day, and the changed ones. Their cost is computed from all slices of the hours they ran
in, and replaces what the target has of them; affected queries that have no cost any more leave it.
"""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.spine import slice_intervals
from ledgerlight.plans.query_cost import HOURLY_SERVICE_TYPES, WAITS, cost_per_query
from ledgerlight.session import materialize
from ledgerlight.sources.staging import Staged


@dataclass(frozen=True)
class Changes:
    """Input rows that differ from the last run's: new, late and corrected ones, the corrected ones
    and deleted ones in their old form too. ``old_stop``: the end of metering at the last run."""
    queries: DataFrame          # rows of the staged query log
    metering: DataFrame         # rows of the staged metering log
    old_stop: Column
    rate_days: DataFrame | None = None  # (date) with another rate than before


def query_slices(queries: DataFrame) -> DataFrame:
    """(query_id, warehouse_id, hour) of queries that ran on a warehouse."""
    waits = sum((F.col(c) for c in WAITS[1:]), F.col(WAITS[0]))
    q = queries.where(F.col("warehouse_size").isNotNull()).select(
        "query_id", "warehouse_id", "end_time", F.timestamp_add("MILLISECOND", waits, F.col("start_time")).alias("started"))
    return slice_intervals(q, end="end_time", anchor="started").select(
        "query_id", "warehouse_id", F.col("hour_start").alias("hour"))


def touched_hours(changes: Changes) -> DataFrame:
    """Distinct (warehouse_id, hour) whose totals or bill may differ."""
    bills = changes.metering.where(F.col("service_type").isin(*HOURLY_SERVICE_TYPES)).select(
        F.col("entity_id").alias("warehouse_id"), F.col("start_time").alias("hour"))
    return query_slices(changes.queries).select("warehouse_id", "hour").unionByName(bills).distinct()


def touched_days(changes: Changes) -> DataFrame:
    """Distinct days whose billable cloud services or rates may differ."""
    days = changes.metering.where(F.col("service_type").isin(*HOURLY_SERVICE_TYPES)).select(
        F.to_date("start_time").alias("day"))
    if changes.rate_days is not None:
        days = days.unionByName(changes.rate_days.select(F.col("date").alias("day")))
    return days.distinct()


def affected_queries(log: DataFrame, changes: Changes) -> DataFrame:
    """Distinct ids of the queries whose cost may differ."""
    hours = materialize(touched_hours(changes), "touched-hours")
    days = touched_days(changes)  # at most as many as the calendar has
    by_hour = query_slices(log).join(hours, ["warehouse_id", "hour"], "left_semi").select("query_id")
    by_day = log.select("query_id", F.to_date("start_time").alias("day")).join(F.broadcast(days), "day", "left_semi")
    metered_since = log.where(F.col("end_time") > changes.old_stop).select("query_id")
    return (by_hour.unionByName(by_day.select("query_id")).unionByName(metered_since)
            .unionByName(changes.queries.select("query_id")).distinct())


def cost_of_changes(st: Staged, rates: DataFrame, changes: Changes) -> tuple[DataFrame, DataFrame]:
    """(rows to write, ids of all affected queries): the staged tables are those after the changes."""
    only = materialize(affected_queries(st.query_history(), changes), "affected-queries")
    return cost_per_query(st, rates, only=only), only
