"""Registered operator-level queries: each generic operator on the raw test tables
(bindings of SURVEY 7.2), whole tables, no row caps."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oracle import operators as O
from ledgerlight.functions.text import strip_comments
from ledgerlight.operators import checks
from ledgerlight.operators.allocation import allocate, conditional_sums
from ledgerlight.operators.fill import first_per_key, gap_fill, latest_per_key
from ledgerlight.operators.history import scd2
from ledgerlight.operators.nested import explode_objects, explode_variant
from ledgerlight.operators.spine import hour_spine, slice_intervals, with_day_stats
from ledgerlight.plans.query_cost import MAX_SLICES_PER_WAREHOUSE_HOUR
from ledgerlight.plans.registry import Context, register
from ledgerlight.session import materialize, shared_folder
from ledgerlight.sources.testbed import EV_SPARK

STREAM_LATENESS_HOURS = 24
DEDUP_ORDER = ["l_shipdate", "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount",
               "l_tax", "l_returnflag", "l_linestatus"]


def _intervals(ctx: Context) -> DataFrame:
    ev = ctx.table("events")
    return ev.select("event_id", "user_id", "value",
                     F.expr(EV_SPARK["start_ts"]).alias("start_ts"), F.expr(EV_SPARK["end_ts"]).alias("end_ts"))


@register("k1_hour_grid", O.K1_HOUR_GRID)
def k1_hour_grid(ctx: Context) -> DataFrame:
    """Hour spine over the event hours with per-day hour counts and month length."""
    hours = hour_spine(ctx.table("events").select(F.date_trunc("hour", "ts").alias("h")), "h")
    return with_day_stats(hours)


@register("k4_interval_slice", O.K4_INTERVAL_SLICE)
def k4_interval_slice(ctx: Context) -> DataFrame:
    """Every event interval cut into clock hours with the milliseconds in each."""
    s = slice_intervals(_intervals(ctx), end="end_ts", anchor="start_ts", ms_col="ms")
    return s.select("event_id", "hour_start", "ms")


@register("k5_allocate", O.K5_ALLOCATE, ["allocated", "fraction"])
def k5_allocate(ctx: Context) -> DataFrame:
    """Each (user, hour)'s summed value shared over the events running in it by time."""
    s = slice_intervals(_intervals(ctx), end="end_ts", anchor="start_ts", ms_col="ms")
    billed = (ctx.table("events").groupBy("user_id", F.date_trunc("hour", "ts").alias("hour_start"))
              .agg(F.sum("value").alias("billed")))
    out = allocate(s, billed, ["user_id", "hour_start"], {"ms": ("total_ms", "fraction")},
                   {"allocated": ("billed", "fraction")},
                   max_rows_per_key=MAX_SLICES_PER_WAREHOUSE_HOUR, spread_cols=["event_id", "hour_start"])
    return out.select("event_id", "user_id", "hour_start", "ms", "fraction", "allocated")


@register("e3_pivot_sums", O.E3_PIVOT_SUMS, ["view_value", "click_value", "purchase_value"])
def e3_pivot_sums(ctx: Context) -> DataFrame:
    """Conditional sums per user and day, one column per event type."""
    ev = ctx.table("events").withColumn("day", F.to_date("ts"))
    return conditional_sums(ev, ["user_id", "day"], "event_type",
                            {"view_value": ("view", "value"), "click_value": ("click", "value"),
                             "purchase_value": ("purchase", "value")})


def _supplier_daily(ctx: Context) -> DataFrame:
    li = ctx.table("lineitem")
    return li.groupBy("l_suppkey", F.to_date("l_shipdate").alias("date")).agg(
        F.max("l_discount").alias("rate"), F.max("l_tax").alias("tax"))


@register("k12_gap_fill", O.K12_GAP_FILL, ["rate", "tax"])
def k12_gap_fill(ctx: Context) -> DataFrame:
    """Supplier x day grid over the whole ship-date range, values filled both ways."""
    daily = ctx.memo("supplier_daily", lambda: materialize(_supplier_daily(ctx), "supplier_daily"))
    # both bounds from one scalar subquery (one pass over the facts)
    bounds = daily.agg(F.struct(F.min("date").alias("lo"), F.max("date").alias("hi"))).scalar()
    return gap_fill(daily, ["l_suppkey"], "date", ["rate", "tax"], bounds["lo"], bounds["hi"])


@register("k14_scd2", O.K14_SCD2)
def k14_scd2(ctx: Context) -> DataFrame:
    """Periods of each customer's order priority (ties on the date by order key)."""
    od = ctx.table("orders").select("o_custkey", "o_orderpriority", "o_orderdate", "o_orderkey")
    stop = od.agg(F.max("o_orderdate")).scalar()
    out = scd2(od, "o_custkey", ["o_orderpriority"], "o_orderdate", stop, tiebreak=["o_orderkey"])
    return out.drop("o_orderkey")


@register("k15_dedup", O.K15_DEDUP, ["l_quantity", "l_extendedprice", "l_discount", "l_tax"])
def k15_dedup(ctx: Context) -> DataFrame:
    """First line per (order, line number) by ship date, then part and supplier."""
    li = ctx.table("lineitem")
    return first_per_key(li, ["l_orderkey", "l_linenumber"], DEDUP_ORDER)


@register("f2_latest_per_key", O.F2_LATEST, ["o_totalprice"])
def f2_latest_per_key(ctx: Context) -> DataFrame:
    """Latest order per customer (nulls last, then highest order key)."""
    od = ctx.table("orders")
    latest = latest_per_key(od, ["o_custkey"], [F.col("o_orderdate").desc_nulls_last(),
                                                F.col("o_orderkey").desc()])
    return latest.select("o_custkey", "o_orderkey", "o_orderdate", "o_totalprice")


@register("s29_strip_comments", O.S29_STRIP)
def s29_strip_comments(ctx: Context) -> DataFrame:
    """Block comments, line comments and semicolons removed from every whole page."""
    pages = ctx.table("pages")
    stripped = strip_comments(F.col("html"))
    return pages.select("page_id", stripped.alias("html_no_comments"),
                        F.length(stripped).alias("n_chars"))


@register("j1_explode_objects", O.J1_EXPLODE)
def j1_explode_objects(ctx: Context) -> DataFrame:
    """Flatten the nested direct-object arrays: one row per query and object."""
    flat = explode_objects(ctx.access_history(), "direct_objects_accessed",
                           ["query_id", "query_start_time"],
                           {"table_id": ("objectId", "bigint"), "object_name": ("objectName", "string"),
                            "object_domain": ("objectDomain", "string"), "columns_array": ("columns", None)})
    return flat.select("query_id", "query_start_time", "table_id", "object_name", "object_domain",
                       F.size("columns_array").alias("n_columns"))


@register("j1_explode_raw_json", O.J1_EXPLODE_RAW)
def j1_explode_raw_json(ctx: Context) -> DataFrame:
    """The nested objects as they arrive from a log of JSON text, read through VARIANT: ids that are
    numbers, text or words, missing domains, missing column lists and records that are no array."""
    li = ctx.table("lineitem")
    supplier = F.col("l_suppkey").cast("string")
    number = (F.when(F.col("l_returnflag") == "R", F.concat(F.lit('"id-'), supplier, F.lit('"')))      # a word
              .when(F.col("l_returnflag") == "A", F.concat(F.lit('"'), supplier, F.lit('"'))).otherwise(supplier))
    domain = F.when(F.col("l_linestatus") == "O", F.lit(', "objectDomain": "Table"')).otherwise(F.lit(""))
    cols = F.when(F.col("l_discount") > 0.05, F.lit("")).otherwise(
        F.lit(', "columns": [{"columnName": "l_quantity"}, {"columnId": 7}]'))
    element = F.concat(F.lit('{"objectId": '), number, F.lit(', "objectName": "SUPPLIER_'), supplier, F.lit('"'), domain, cols, F.lit("}"))
    text = (F.when(F.col("l_tax") > 0.07, F.lit('{"objectId": 1}')).when(F.col("l_tax") == 0, F.lit("[{"))
            .otherwise(F.concat(F.lit("["), element, F.lit(', {"objectName": null, "columns": []}]'))))
    raw = li.select("l_orderkey", "l_linenumber", text.alias("objects"))
    flat = explode_variant(raw, "objects", ["l_orderkey", "l_linenumber"], {
        "table_id": ("$.objectId", "bigint"), "object_name": ("$.objectName", "string"),
        "object_domain": ("$.objectDomain", "string"), "columns": ("$.columns", "array<variant>")})
    named = F.filter(F.transform("columns", lambda x: F.try_variant_get(x, "$.columnName", "string")), lambda x: x.isNotNull())
    return flat.select("l_orderkey", "l_linenumber", "table_id", "object_name", "object_domain", F.size("columns").alias("n_columns"),
                       F.size(named).alias("n_named"))


@register("n1_checksum_diff", O.N1_TABLE_DIFF, ["l_extendedprice", "l_discount"])
def n1_checksum_diff(ctx: Context) -> DataFrame:
    """The same diff as ``n1_table_diff`` by checksum descent: only rows of hash buckets whose
    checksums differ are compared."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount"]
    li = ctx.table("lineitem").select(*cols)
    dedup = first_per_key(ctx.table("lineitem"), ["l_orderkey", "l_linenumber"], DEDUP_ORDER).select(*cols)
    return checks.checksum_diff(li, dedup, truncate=["l_extendedprice", "l_discount"])


@register("n1_table_diff", O.N1_TABLE_DIFF, ["l_extendedprice", "l_discount"])
def n1_table_diff(ctx: Context) -> DataFrame:
    """Two-way multiset diff of the line items against their deduplicated form,
    prices cut to 8 decimals."""
    cols = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_discount"]
    li = ctx.table("lineitem").select(*cols)
    dedup = first_per_key(ctx.table("lineitem"), ["l_orderkey", "l_linenumber"], DEDUP_ORDER).select(*cols)
    return checks.table_diff(li, dedup, truncate=["l_extendedprice", "l_discount"])


@register("n2_unmatched_keys", O.N2_UNMATCHED)
def n2_unmatched_keys(ctx: Context) -> DataFrame:
    """Order keys present in only one of orders and line items (two anti joins)."""
    od = ctx.table("orders").select(F.col("o_orderkey").alias("orderkey"), "o_orderdate")
    li = ctx.table("lineitem").select(F.col("l_orderkey").alias("orderkey"), F.col("l_shipdate").alias("o_orderdate"))
    return checks.unmatched_keys(od, li, "orderkey")


@register("n3_duplicate_keys", O.N3_DUPLICATES)
def n3_duplicate_keys(ctx: Context) -> DataFrame:
    """(order, line number) pairs that occur more than once."""
    return checks.duplicates(ctx.table("lineitem"), ["l_orderkey", "l_linenumber"])


@register("n4_null_rows", O.N4_NULLS)
def n4_null_rows(ctx: Context) -> DataFrame:
    """Query-log rows missing a warehouse (queries not run on a warehouse)."""
    qh = ctx.st.query_history()
    return checks.nulls(qh, ["warehouse_id", "warehouse_size"]).select("query_id", "start_time", "query_type")


@register("s6_negative_slices", O.S6_NEGATIVE)
def s6_negative_slices(ctx: Context) -> DataFrame:
    """Query slices whose execution start lies after their end (negative run time)."""
    from ledgerlight.plans.query_cost import filtered_queries
    q = filtered_queries(ctx.st).where(F.col("ran_on_warehouse"))
    s = slice_intervals(q, end="end_time", anchor="execution_start_time")
    return checks.negatives(s, "num_milliseconds_query_ran").select(
        "query_id", F.col("hour_start"), "num_milliseconds_query_ran")


@register("k9_spread_daily", O.K9_SPREAD_DAILY, ["value_per_hour"])
def k9_spread_daily(ctx: Context) -> DataFrame:
    """Each day's summed event value spread evenly over that day's grid hours."""
    from ledgerlight.operators.spine import spread_daily
    hours = with_day_stats(hour_spine(ctx.table("events").select(F.date_trunc("hour", "ts").alias("h")), "h"))
    daily = ctx.table("events").groupBy(F.to_date("ts").alias("day")).agg(F.sum("value").alias("v"))
    return spread_daily(hours, daily, "day", {"value_per_hour": "v"}).select("hour", "value_per_hour")


@register("k11_residual", O.K11_RESIDUAL, ["residual"])
def k11_residual(ctx: Context) -> DataFrame:
    """Order total minus the sum of its line prices, where positive."""
    from ledgerlight.operators.allocation import residual
    total = ctx.table("orders").select("o_orderkey", "o_totalprice")
    parts = ctx.table("lineitem").select(F.col("l_orderkey").alias("o_orderkey"), "l_extendedprice")
    out = residual(total, parts, ["o_orderkey"], {"residual": ("o_totalprice", "l_extendedprice")},
                   keep_positive=True)
    return out.select("o_orderkey", "residual")


@register("k13_priority_pick", O.K13_PRIORITY_PICK, ["l_extendedprice"])
def k13_priority_pick(ctx: Context) -> DataFrame:
    """One line per order: returned lines first, then the lowest line number."""
    from ledgerlight.operators.fill import pick_by_priority
    li = ctx.table("lineitem")
    prio = F.when(F.col("l_returnflag") == "R", 1).otherwise(0)
    out = pick_by_priority(li, ["l_orderkey"], prio, ["l_linenumber", "l_partkey", "l_extendedprice"])
    return out.select("l_orderkey", "l_linenumber", "l_returnflag", "l_extendedprice")


@register("f5_flag_latest", O.F5_FLAG_LATEST)
def f5_flag_latest(ctx: Context) -> DataFrame:
    """Every order, flagged when it is its customer's latest (skew-safe flag)."""
    from ledgerlight.operators.fill import flag_latest
    od = ctx.table("orders").select("o_orderkey", "o_custkey", "o_orderdate")
    return flag_latest(od, ["o_custkey"], ["o_orderdate", "o_orderkey"], "is_latest")


@register("l7_stream_query_hours", O.L7_STREAM_HOURS)
def l7_stream_query_hours(ctx: Context) -> DataFrame:
    """Structured Streaming run over the events file (available-now trigger): run time per
    warehouse and hour for every hour the watermark has closed."""
    from ledgerlight.streaming.query_hours import run_events_stream
    return run_events_stream(ctx.spark, f"{ctx.sf_dir}/events.parquet", shared_folder(ctx.spark, "stream"),
                             f"{STREAM_LATENESS_HOURS} hours")


@register("l7_late_rows", O.L7_ALL_HOURS)
def l7_late_rows(ctx: Context) -> DataFrame:
    """Hourly totals from a stream in three batches: first half of the time, purchases of all times
    after the rest (late by up to the whole range), and the second batch delivered again."""
    from ledgerlight.streaming.hour_totals import hour_totals, start_hour_totals, write_batch
    from ledgerlight.streaming.query_hours import event_intervals, events_stream
    spark, base = ctx.spark, shared_folder(ctx.spark, "late-rows")
    ev = ctx.table("events")
    middle = ev.agg(F.expr("timestamp_micros((unix_micros(min(cast(ts as timestamp))) + unix_micros(max(cast(ts as timestamp)))) div 2)")).scalar()
    late = F.col("event_type") == "purchase"
    early = F.col("ts").cast("timestamp") < middle
    for batch in (ev.where(early & ~late), ev.where(~early & ~late), ev.where(late)):
        batch.write.mode("append").parquet(f"{base}/source")
        start_hour_totals(event_intervals(events_stream(spark, f"{base}/source")), base).awaitTermination()
    write_batch(spark, base, event_intervals(ev.where(~early & ~late)), 1)
    return hour_totals(spark, base)


@register("l7_busy_sessions", O.L7_SESSIONS)
def l7_busy_sessions(ctx: Context) -> DataFrame:
    """Busy sessions of every warehouse: queries parted by at most five idle minutes."""
    from ledgerlight.streaming.query_hours import event_intervals
    from ledgerlight.streaming.sessions import busy_sessions
    return busy_sessions(event_intervals(ctx.table("events")))


@register("l7_stream_busy_sessions", O.L7_CLOSED_SESSIONS)
def l7_stream_busy_sessions(ctx: Context) -> DataFrame:
    """The same sessions from a stream, those that its watermark has closed."""
    from ledgerlight.streaming.query_hours import drain, event_intervals, events_stream
    from ledgerlight.streaming.sessions import busy_sessions
    base, path = shared_folder(ctx.spark, "sessions"), f"{ctx.sf_dir}/events.parquet"
    lateness = f"{STREAM_LATENESS_HOURS} hours"
    drain(busy_sessions(event_intervals(events_stream(ctx.spark, path)), lateness=lateness), base)
    return ctx.spark.read.schema(busy_sessions(event_intervals(ctx.table("events"))).schema).parquet(f"{base}/sink")


@register("k5_stream_allocate", O.K5_STREAM, ["allocated", "fraction"])
def k5_stream_allocate(ctx: Context) -> DataFrame:
    """The allocation of ``k5_allocate`` from two streams that meet, for the hours both have closed."""
    from ledgerlight.streaming.allocation import allocate_stream
    from ledgerlight.streaming.query_hours import drain, event_intervals, events_stream
    spark, base = ctx.spark, shared_folder(ctx.spark, "stream-allocation")
    ev = ctx.table("events")
    bills = (ev.groupBy(F.col("user_id").alias("warehouse_id"), F.date_trunc("hour", F.col("ts").cast("timestamp")).alias("hour"))
             .agg(F.sum("value").alias("billed")))
    bills.write.parquet(f"{base}/bills")
    streams = (event_intervals(events_stream(spark, f"{ctx.sf_dir}/events.parquet")),
               spark.readStream.schema(bills.schema).parquet(f"{base}/bills"))
    out = allocate_stream(*streams, lateness=f"{STREAM_LATENESS_HOURS} hours")
    drain(out, base)
    return spark.read.schema(out.schema).parquet(f"{base}/sink").select(
        F.col("query_id").cast("long").alias("event_id"), F.col("warehouse_id").alias("user_id"),
        F.col("hour").alias("hour_start"), "ms", "fraction", "allocated")
