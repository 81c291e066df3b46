"""Registered model-level queries (the named result tables of SURVEY 2.13)."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from oracle import models as M
from ledgerlight.plans.registry import Context, register

LOOKBACK_DAYS = 3

_RATE_COLS = ["date", "usage_type", "service_type", "effective_rate", "currency",
              "is_overage_rate", "is_latest_rate"]


@register("daily_rates", M.model_sql("SELECT * FROM daily_rates", M.DAILY_RATES),
          ["effective_rate"])
def daily_rates(ctx: Context) -> DataFrame:
    """One rate per day and usage type: gap-filled, overage or normal price picked."""
    return ctx.daily_rates().select(*_RATE_COLS)


_CPQ_DOUBLES = ["compute_cost", "compute_credits", "query_acceleration_cost",
                "query_acceleration_credits", "cloud_services_cost", "cloud_services_credits",
                "query_cost", "query_credits"]


@register("cost_per_query",
          M.model_sql("SELECT * FROM cost_per_query", M.DAILY_RATES, M.COST_PER_QUERY),
          _CPQ_DOUBLES)
def cost_per_query(ctx: Context) -> DataFrame:
    """Compute, acceleration and cloud-services cost of every query."""
    return ctx.cost_per_query()


def _hourly(ctx: Context) -> DataFrame:
    return ctx.hourly_spend()


@register("hourly_spend", M.model_sql(
    "SELECT hour, service, storage_type, warehouse_name, database_name, usage, usage_net_cloud_services, "
    "spend, spend_net_cloud_services, currency, usage_unit, usage_rate FROM hourly_spend",
    M.DAILY_RATES, M.HOURLY_SPEND), M.SPEND_DOUBLES)
def hourly_spend(ctx: Context) -> DataFrame:
    """Spend per hour, service, storage type, warehouse and database on the full grid."""
    return _hourly(ctx)


@register("daily_spend", M.model_sql("SELECT * FROM daily_spend", M.DAILY_RATES, M.HOURLY_SPEND),
          M.SPEND_DOUBLES)
def daily_spend(ctx: Context) -> DataFrame:
    """Spend per UTC day with the usage-weighted rate."""
    from ledgerlight.plans.spend import daily_spend as build
    return build(_hourly(ctx))


@register("monthly_spend", M.model_sql(
    f"SELECT CAST(date_trunc('month', date) AS DATE) AS month, service, sum(spend) AS spend FROM daily_spend "
    f"WHERE date_trunc('month', date) = {M.FIRST_MONTH} GROUP BY 1, 2", M.DAILY_RATES, M.HOURLY_SPEND),
    ["spend"])
def monthly_spend(ctx: Context) -> DataFrame:
    """Spend per service in the first month of the data (end-to-end check shape)."""
    from ledgerlight.plans.spend import daily_spend as build, monthly_spend as month_of
    first_month = ctx.tb.ev().agg(F.trunc(F.min("day"), "month")).scalar()
    return month_of(build(_hourly(ctx)), first_month)


def _enriched(ctx: Context) -> DataFrame:
    return ctx.query_history_enriched()


@register("query_history_enriched",
          M.model_sql(M.ENRICHED_SELECT, M.DAILY_RATES, M.COST_PER_QUERY, M.ENRICHED), M.ENRICHED_DOUBLES)
def query_history_enriched(ctx: Context) -> DataFrame:
    """Query log with costs, unit conversions, comment-free text and dbt metadata."""
    return _enriched(ctx)


@register("query_history_enriched_bucketed",
          M.model_sql(M.ENRICHED_SELECT, M.DAILY_RATES, M.COST_PER_QUERY, M.ENRICHED), M.ENRICHED_DOUBLES)
def query_history_enriched_bucketed(ctx: Context) -> DataFrame:
    """The same from catalog tables bucketed by query id: log and cost meet without a shuffle."""
    from ledgerlight.plans.enriched import query_history_enriched as build
    log = ctx.bucketed("stg_query_history", ctx.st.log_plan, "query_id")
    return build(log, ctx.bucketed("cost_per_query", ctx.cost_plan, "query_id"))


@register("dbt_queries",
          M.model_sql(M.DBT_QUERIES_SELECT, M.DAILY_RATES, M.COST_PER_QUERY, M.ENRICHED), M.ENRICHED_DOUBLES)
def dbt_queries(ctx: Context) -> DataFrame:
    """Queries issued by dbt with their node, run and project fields."""
    from ledgerlight.plans.enriched import dbt_queries as build
    return build(_enriched(ctx))


@register("query_base_object_access", M.ACCESS_LINES + "SELECT * FROM base_objects")
def query_base_object_access(ctx: Context) -> DataFrame:
    """One row per query and base object with the distinct columns read."""
    return ctx.object_access("base")


@register("query_direct_object_access", M.ACCESS_LINES + "SELECT * FROM direct_objects")
def query_direct_object_access(ctx: Context) -> DataFrame:
    """One row per query and directly named object, deduplicated on the row key."""
    return ctx.object_access("direct")


@register("query_base_table_access", M.ACCESS_LINES + M.TABLE_ACCESS.format(src="base_objects"))
def query_base_table_access(ctx: Context) -> DataFrame:
    """Base objects that are tables with an id."""
    from ledgerlight.plans.access import table_access
    return table_access(ctx.object_access("base"))


@register("query_direct_table_access", M.ACCESS_LINES + M.TABLE_ACCESS.format(src="direct_objects"))
def query_direct_table_access(ctx: Context) -> DataFrame:
    """Directly named objects that are tables with an id."""
    from ledgerlight.plans.access import table_access
    return table_access(ctx.object_access("direct"))


@register("warehouses_type2_dimension",
          M.model_sql("SELECT * FROM warehouses_type2_dimension", M.WAREHOUSES))
def warehouses_type2_dimension(ctx: Context) -> DataFrame:
    """Validity periods of warehouse size and name from the query log."""
    from ledgerlight.plans.warehouses import warehouses_type2_dimension as build
    return build(ctx.st)


@register("cost_per_query_incremental",
          M.model_sql(M.COST_LOOKBACK, M.DAILY_RATES, M.COST_PER_QUERY), _CPQ_DOUBLES)
def cost_per_query_incremental(ctx: Context) -> DataFrame:
    """An incremental run: queries ending in the last 3 days of the log, recomputed from
    whole hours so they equal the full run (look-back boundary fixed)."""
    from ledgerlight.plans.query_cost import cost_per_query as build, filtered_queries
    since = F.timestamp_add("DAY", F.lit(-LOOKBACK_DAYS),
                            filtered_queries(ctx.st).agg(F.max("end_time")).scalar())
    return build(ctx.st, ctx.daily_rates(), since=since)


@register("cost_per_query_upsert",
          M.model_sql("SELECT * FROM cost_per_query", M.DAILY_RATES, M.COST_PER_QUERY), _CPQ_DOUBLES)
def cost_per_query_upsert(ctx: Context) -> DataFrame:
    """The cost table built from what had arrived three days before the end (without failed
    queries, which all come late), then upserted by what the later rows touch: equal to a full run."""
    from ledgerlight.plans.cost_by_change import Changes, cost_of_changes
    from ledgerlight.plans.query_cost import cost_per_query as build
    from ledgerlight.session import shared_folder
    from ledgerlight.sources.staging import Staged
    from ledgerlight.streaming.incremental import read_target, upsert
    log, metering = ctx.st.query_history(), ctx.st.metering_history()
    warehouses = ctx.st.warehouse_metering_history()
    cut = F.timestamp_add("DAY", F.lit(-LOOKBACK_DAYS), warehouses.agg(F.max("end_time")).scalar())
    late = (F.col("execution_status") != "SUCCESS") | (F.col("end_time") > cut)
    before = Staged({"query_history": log.where(~late), "metering_history": metering.where(F.col("end_time") <= cut),
                     "warehouse_metering_history": warehouses.where(F.col("end_time") <= cut)}, deduplicated=True)
    after = Staged({"query_history": log, "metering_history": metering, "warehouse_metering_history": warehouses},
                   deduplicated=True)
    dated = lambda df: df.withColumn("_date", F.to_date("start_time"))
    path, keys, span = shared_folder(ctx.spark, "cost-upsert"), ["query_id", "start_time"], ("start_time", "end_time")
    upsert(ctx.spark, path, dated(build(before, ctx.daily_rates())), keys, "_date", span=span)
    old_stop = before.warehouse_metering_history().agg(F.max("end_time")).scalar()
    rows, affected = cost_of_changes(after, ctx.daily_rates(), Changes(
        log.where(late), metering.where(F.col("end_time") > cut), old_stop))
    gone = dated(log.join(affected, "query_id", "left_semi"))
    upsert(ctx.spark, path, dated(rows), keys, "_date", span=span, remove=gone)
    return read_target(ctx.spark, path).drop("_date")


@register("cost_per_query_schema_change",
          M.model_sql("SELECT query_id, start_time, query_credits, CASE WHEN end_time > (SELECT max(end_time) - INTERVAL 3 DAY "
                      "FROM done) THEN currency END AS currency FROM cost_per_query", M.DAILY_RATES, M.COST_PER_QUERY),
          ["query_credits"])
def cost_per_query_schema_change(ctx: Context) -> DataFrame:
    """An incremental table whose source gains a column between two runs: a first run from an empty
    target, a later one over the look-back window; rows not written again have null there."""
    from ledgerlight.session import shared_folder
    from ledgerlight.streaming.incremental import read_target, run_incremental
    cost = ctx.cost_per_query().withColumn("_date", F.to_date("start_time"))
    path = shared_folder(ctx.spark, "cost-schema")

    def build(columns):
        return lambda since: (cost if since is None else cost.where(F.col("end_time") > F.lit(since))).select(*columns)

    first = ["query_id", "start_time", "end_time", "query_credits", "_date"]
    for columns in (first, [*first, "currency"]):
        run_incremental(ctx.spark, path, build(columns), ["query_id", "start_time"], "end_time", LOOKBACK_DAYS, "_date",
                        start="start_time")
    return read_target(ctx.spark, path).select("query_id", "start_time", "query_credits", "currency")


@register("check_no_queries_dropped",
          M.model_sql(M.CHECK_NO_QUERIES_DROPPED, M.DAILY_RATES, M.COST_PER_QUERY, M.ENRICHED))
def check_no_queries_dropped(ctx: Context) -> DataFrame:
    """Queries before the run date present in only one of the enriched log and the
    cost per query (must be empty)."""
    from ledgerlight.operators.checks import unmatched_keys
    return unmatched_keys(ctx.query_history_enriched(), ctx.cost_per_query(), "query_id",
                          date_col="start_time", before=ctx.as_of)


@register("check_unique_daily_rates", M.model_sql(M.CHECK_UNIQUE_DAILY_RATES, M.DAILY_RATES))
def check_unique_daily_rates(ctx: Context) -> DataFrame:
    """(date, usage type) pairs with more than one rate (must be empty)."""
    from ledgerlight.operators.checks import duplicates
    return duplicates(ctx.daily_rates(), ["date", "usage_type"])


@register("check_cost_per_query_keys",
          M.model_sql(M.CHECK_COST_KEYS, M.DAILY_RATES, M.COST_PER_QUERY))
def check_cost_per_query_keys(ctx: Context) -> DataFrame:
    """Query ids of the cost table that repeat or are null (unique + not-null test)."""
    from ledgerlight.operators.checks import duplicates, nulls
    cost = ctx.cost_per_query()
    dup = duplicates(cost, ["query_id"])
    missing = nulls(cost, ["query_id"]).groupBy("query_id").agg(F.count(F.lit(1)).alias("n"))
    return dup.unionByName(missing)


_BAL_DOUBLES = ["free_usage_balance", "capacity_balance", "on_demand_consumption_balance", "rollover_balance"]


@register("remaining_balance_daily_without_contract_view",
          M.model_sql("SELECT date, organization_name, currency, free_usage_balance, capacity_balance, "
                      "on_demand_consumption_balance, rollover_balance FROM bal"), _BAL_DOUBLES)
def remaining_balance_daily_without_contract_view(ctx: Context) -> DataFrame:
    """One balance per day: highest contract number, nulls last."""
    from ledgerlight.plans.rates import remaining_balance_daily_without_contract
    return remaining_balance_daily_without_contract(ctx.st)


@register("stg_query_history", M.model_sql("SELECT * FROM stg_query_history"),
          ["percentage_scanned_from_cache", "credits_used_cloud_services", "query_load_percent",
           "query_acceleration_upper_limit_scale_factor"])
def stg_query_history(ctx: Context) -> DataFrame:
    """The staged query log: 70 columns, first row per query id by start time."""
    return ctx.st.query_history()


def _staging(name: str) -> None:
    sql, doubles = M.STAGING[name]

    @register(name, M.model_sql(sql), doubles, f"The staged table {name}.")
    def staged(ctx: Context) -> DataFrame:
        return getattr(ctx.st, name.removeprefix("stg_"))()


for _name in M.STAGING:
    _staging(_name)


@register("dbt_queries_linked",
          M.model_sql(M.DBT_LINKED_SELECT, M.DAILY_RATES, M.COST_PER_QUERY, M.ENRICHED))
def dbt_queries_linked(ctx: Context) -> DataFrame:
    """Links to the jobs and runs of queries issued by dbt, for a configured account."""
    from ledgerlight.plans.enriched import dbt_queries as build
    return build(_enriched(ctx), "42", "https://dbt.example.com/deploy/").select(
        "query_id", "dbt_cloud_job_url", "dbt_cloud_run_url")


@register("access_history_incremental", M.ACCESS_LOG)
def access_history_incremental(ctx: Context) -> DataFrame:
    """The access log, stored by month as the model build does, built up to a day and then brought up
    to date by replacing its last months: every record, as often as it was delivered, all columns."""
    import datetime as dt

    from ledgerlight.session import shared_folder
    from ledgerlight.streaming.incremental import partition_dates, read_target, replace_dates
    log = ctx.access_history_table().withColumn("_date", F.trunc("query_start_time", "month"))
    path = shared_folder(ctx.spark, "access")
    last = log.agg(F.max("query_start_time")).first()[0]
    if last is not None:
        replace_dates(ctx.spark, path, log.where(F.col("query_start_time") <= F.lit(last - dt.timedelta(days=200))), "_date",
                      ["query_start_time"])
        dates = partition_dates(ctx.spark, path, "_date")
        since = (dates[-1] - dt.timedelta(days=1)).replace(day=1) if dates else dt.date(1970, 1, 1)
        replace_dates(ctx.spark, path, log.where(F.col("query_start_time") >= F.lit(since).cast("timestamp")), "_date",
                      ["query_start_time"], since)
        log = read_target(ctx.spark, path)
    text = lambda c: F.array_join(F.transform(c, lambda o: F.concat_ws(
        ":", F.coalesce(o["objectId"].cast("string"), F.lit("-")), F.coalesce(o["objectName"], F.lit("-")), o["objectDomain"],
        F.array_join(F.transform(o["columns"], lambda x: x["columnName"]), ",", "-"))), ";")
    return log.select("query_id", "parent_query_id", "root_query_id", "query_start_time", "user_name",
                      *[text(c).alias(c) for c in ("direct_objects_accessed", "base_objects_accessed", "objects_modified")])
