"""Cost per query (K4 -> K5 -> K6 -> K7 -> K8, H3, D3, D5).

Each query that ran on a warehouse is cut into the clock hours it ran in; each hour's
metered compute credits are shared over the queries of that (warehouse, hour) by
run time, and acceleration credits by bytes scanned with acceleration. Slices roll up
to one row per query. Cloud-services credits are billed per day only above 10 % of
compute and shared by each query's share of the day's cloud-services credits.

Scale: slicing multiplies rows by the hours a query spans (explode, no join), clipped
to the billed hours. Hour totals are ``groupBy`` aggregates (map-side partial sums)
joined back on (warehouse, hour), hot keys split by salting. Rate slices and daily
credits are one row per day and broadcast; the current rate is a scalar subquery.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.allocation import (allocate, billable_after_free_tier,
                                              conditional_sums, rollup_slices, share_of)
from ledgerlight.operators.rates import rate_slice
from ledgerlight.operators.spine import slice_intervals
from ledgerlight.sources.staging import Staged

# ---------------------------------------------------------------------------
# Waiting times before execution starts, share of compute credits that
# covers cloud services for free, metered service types billed per warehouse hour
# ---------------------------------------------------------------------------
WAITS = ["queued_overload_time", "compilation_time", "queued_provisioning_time",
         "queued_repair_time", "list_external_files_time"]
FREE_CLOUD_SERVICES_FRACTION = 0.1
HOURLY_SERVICE_TYPES = ("QUERY_ACCELERATION", "WAREHOUSE_METERING")

# A (warehouse, hour) with more query slices than this is split over several join tasks.
MAX_SLICES_PER_WAREHOUSE_HOUR = 2_000_000

OUTPUT = ["query_id", "start_time", "end_time", "execution_start_time", "compute_cost",
          "compute_credits", "query_acceleration_cost", "query_acceleration_credits",
          "cloud_services_cost", "cloud_services_credits", "query_cost", "query_credits",
          "ran_on_warehouse", "currency"]


def filtered_queries(st: Staged, since: Column | None = None) -> DataFrame:
    """Queries that ended by the last metered hour (L5), optionally after ``since``
    (the reference's look-back filter)."""
    stop = st.warehouse_metering_history().agg(F.max("end_time")).scalar()
    waits = sum((F.col(c) for c in WAITS[1:]), F.col(WAITS[0]))
    q = st.query_history().select(
        "query_id", F.col("query_text").alias("original_query_text"),
        "credits_used_cloud_services", "warehouse_id",
        F.col("warehouse_size").isNotNull().alias("ran_on_warehouse"),
        F.timestamp_add("MILLISECOND", waits, F.col("start_time")).alias("execution_start_time"),
        "start_time", "end_time", "query_acceleration_bytes_scanned")
    q = q.where(F.col("end_time") <= stop)
    if since is not None:
        q = q.where(F.col("end_time") > since)
    return q


def credits_billed_hourly(st: Staged) -> DataFrame:
    m = st.metering_history().where(F.col("service_type").isin(*HOURLY_SERVICE_TYPES))
    return conditional_sums(
        m.withColumnRenamed("start_time", "hour").withColumnRenamed("entity_id", "warehouse_id"),
        ["hour", "warehouse_id"], "service_type",
        {"credits_used_compute": ("WAREHOUSE_METERING", "credits_used_compute"),
         "credits_used_cloud_services": ("WAREHOUSE_METERING", "credits_used_cloud_services"),
         "credits_used_query_acceleration": ("QUERY_ACCELERATION", "credits_used_compute")})


def cost_per_query(st: Staged, rates: DataFrame, since: Column | None = None,
                   grid: tuple[Column, Column] | None = None,
                   max_slices_per_hour: int | None = MAX_SLICES_PER_WAREHOUSE_HOUR,
                   only: DataFrame | None = None) -> DataFrame:
    """Cost of every query; with ``since``, only queries ending after it; with ``only`` (a table
    of distinct query ids), those queries, from all slices of the hours that they ran in.

    Incremental runs are exact (fix for S18): hour totals need every query with a slice
    in the hours the new queries touch, so the slicing input reaches back to the
    earliest hour of those queries, and only the output is cut at ``since``.
    """
    queries = filtered_queries(st)
    if since is not None:
        wanted = queries.where(F.col("end_time") > since)
        first_hour = wanted.agg(F.min(F.date_trunc("hour", "execution_start_time"))).scalar()
        queries = queries.where(F.col("end_time") > F.least(first_hour, since))
    billed = credits_billed_hourly(st)

    # K4: one row per hour a warehouse query ran. Hours outside the billed range can
    # never join a bill, so the generated sequence is clipped to it (exact, and bounded
    # even for a row with a bogus start time).
    billed_hours = billed.agg(F.min("hour").alias("lo"), F.max("hour").alias("hi"))
    clip = (billed_hours.select("lo").scalar(), billed_hours.select("hi").scalar())
    slices = slice_intervals(queries.where(F.col("ran_on_warehouse")), end="end_time",
                             anchor="execution_start_time", grid=grid,
                             clip=clip).withColumnRenamed("hour_start", "hour")
    if only is not None:
        shared = slices.join(only, "query_id", "left_semi").select("warehouse_id", "hour").distinct()
        slices = slices.join(shared, ["warehouse_id", "hour"], "left_semi")
    # K5 + K6: share each hour's bill by run time and by accelerated bytes
    cost = allocate(
        slices, billed.select("hour", "warehouse_id", "credits_used_compute",
                              "credits_used_query_acceleration"),
        ["warehouse_id", "hour"], max_rows_per_key=max_slices_per_hour,
        spread_cols=["query_id", "hour"],
        weights={"num_milliseconds_query_ran": ("total_query_milliseconds_in_hour",
                                                "fraction_of_total_query_time_in_hour"),
                 "query_acceleration_bytes_scanned": ("total_query_acceleration_bytes_scanned_in_hour",
                                                      "fraction_of_total_query_acceleration_bytes_scanned_in_hour")},
        amounts={"allocated_compute_credits_in_hour": ("credits_used_compute",
                                                       "fraction_of_total_query_time_in_hour"),
                 "allocated_query_acceleration_credits_in_hour": (
                     "credits_used_query_acceleration",
                     "fraction_of_total_query_acceleration_bytes_scanned_in_hour")})
    if only is not None:
        cost = cost.join(only, "query_id", "left_semi")
        queries = queries.join(only, "query_id", "left_semi")
    compute_rate = rate_slice(rates, "WAREHOUSE_METERING", "compute", prefix="c_")
    cost = cost.join(compute_rate, F.to_date("start_time") == F.col("c_rate_date"), "inner")
    cost = cost.withColumns({
        "allocated_compute_cost_in_hour": F.col("allocated_compute_credits_in_hour") * F.col("c_effective_rate"),
        "allocated_query_acceleration_cost_in_hour":
            F.col("allocated_query_acceleration_credits_in_hour") * F.col("c_effective_rate")})

    # K7: back to one row per query
    per_query = rollup_slices(
        cost, "query_id",
        {"compute_cost": "allocated_compute_cost_in_hour",
         "compute_credits": "allocated_compute_credits_in_hour",
         "query_acceleration_cost": "allocated_query_acceleration_cost_in_hour",
         "query_acceleration_credits": "allocated_query_acceleration_credits_in_hour"},
        ["start_time", "end_time", "execution_start_time", "credits_used_cloud_services",
         "ran_on_warehouse"])

    # H3: queries that did not run on a warehouse cost no compute
    zero = F.lit(0.0)
    off_warehouse = queries.where(~F.col("ran_on_warehouse")).select(
        "query_id", "start_time", "end_time", "execution_start_time",
        zero.alias("compute_cost"), zero.alias("compute_credits"),
        zero.alias("query_acceleration_cost"), zero.alias("query_acceleration_credits"),
        "credits_used_cloud_services", "ran_on_warehouse")
    all_queries = per_query.unionByName(off_warehouse)

    # K8: the day's billable cloud services, shared by each query's cloud credits
    daily = (billed.groupBy(F.to_date("hour").alias("day"))
             .agg(F.sum("credits_used_compute").alias("daily_credits_used_compute"),
                  F.sum("credits_used_cloud_services").alias("daily_credits_used_cloud_services")))
    daily = daily.withColumn("daily_billable_cloud_services",
                             billable_after_free_tier(F.col("daily_credits_used_cloud_services"),
                                                      F.col("daily_credits_used_compute"),
                                                      FREE_CLOUD_SERVICES_FRACTION))
    # one row per day (bounded by the calendar): broadcast, no shuffle of the queries on
    # a day key that could be hot
    out = all_queries.join(F.broadcast(daily), F.to_date("start_time") == F.col("day"), "inner")
    cs_rate = rate_slice(rates, "CLOUD_SERVICES", "cloud services", prefix="d_")
    out = out.join(cs_rate, F.to_date("start_time") == F.col("d_rate_date"), "left")
    # No current cloud-services rate at all -> no rows. The latest rate is one row
    # per type, so it is attached as scalar subqueries instead of a join.
    current = rate_slice(rates, "CLOUD_SERVICES", "cloud services", prefix="cur_", latest_only=True)
    out = out.where(current.exists()).withColumns({
        "cur_effective_rate": current.select("cur_effective_rate").scalar(),
        "cur_currency": current.select("cur_currency").scalar()})

    if since is not None:
        out = out.where(F.col("end_time") > since)
    cs_credits = share_of(F.col("credits_used_cloud_services"),
                          F.col("daily_credits_used_cloud_services"),
                          F.col("daily_billable_cloud_services"))
    cs_cost = cs_credits * F.coalesce(F.col("d_effective_rate"), F.col("cur_effective_rate"))
    return out.select(
        "query_id", "start_time", "end_time", "execution_start_time", "compute_cost",
        "compute_credits", "query_acceleration_cost", "query_acceleration_credits",
        cs_cost.alias("cloud_services_cost"), cs_credits.alias("cloud_services_credits"),
        (F.col("compute_cost") + F.col("query_acceleration_cost") + cs_cost).alias("query_cost"),
        (F.col("compute_credits") + F.col("query_acceleration_credits") + cs_credits).alias("query_credits"),
        "ran_on_warehouse",
        F.coalesce(F.col("d_currency"), F.col("cur_currency")).alias("currency"))
