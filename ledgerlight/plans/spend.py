"""Hourly and daily spend by service.

Every family emits the same twelve columns on the complete hour grid of the metering
history. Facts are daily or hourly aggregates and the rate table has one row per day
and type, so every join here is between bounded tables: the grid (hours), per-day
rows, and rate slices of at most one row per day, which are broadcast. The
daily-spread families are one plan keyed by a generated category column (no
per-family re-scan).
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.num import BYTES_PER_TB, div0
from ledgerlight.operators.allocation import residual, share_of
from ledgerlight.operators.rates import rate_slice, weighted_rate
from ledgerlight.operators.spine import hour_spine, per_hour_of_month, with_day_stats
from ledgerlight.session import materialize
from ledgerlight.sources.staging import Staged

SPEND_COLUMNS = ["hour", "service", "storage_type", "warehouse_name", "database_name", "usage",
                 "usage_net_cloud_services", "spend", "spend_net_cloud_services", "currency",
                 "usage_unit", "usage_rate"]

# ---------------------------------------------------------------------------
# Fixed values
# ---------------------------------------------------------------------------
# usage types spread evenly over the hours of their day: (usage type, unit)
DAILY_SPREAD_TYPES = [
    ("data transfer", "TB"),
    ("logging", "Credits"),
    ("reader compute", "Credits"),
    ("reader storage", "TB"),
    ("reader data transfer", "TB"),
    ("reader adj for incl cloud services", "Credits"),
    ("reader cloud services", "Credits"),
]
READER_ADJ = "reader adj for incl cloud services"
READER_CS = "reader cloud services"
# metering service types with a dedicated family
DEDICATED_SERVICE_TYPES = ["SERVERLESS_TASK", "WAREHOUSE_METERING", "WAREHOUSE_METERING_READER"]
# metering names that differ from rate-sheet service types
SERVICE_RENAMES = {"AUTO_CLUSTERING": "AUTOMATIC_CLUSTERING", "PIPE": "SNOWPIPE"}
# display names that are not the capitalised service type
SERVICE_LABELS = {"MATERIALIZED_VIEW": "Materialized Views", "AI_SERVICES": "AI Services"}
CLOUD_SERVICES_ONLY = "CLOUD_SERVICES_ONLY"
FREE_TIER_NAME = "Cloud Services Only"
STORAGE_TYPES = ("Table and Time Travel", "Failsafe", "Stage", "Retained for Clones",
                 "Failsafe Retained for Clones")

def _null_s() -> Column:
    return F.lit(None).cast("string")


def _zero() -> Column:
    return F.lit(0.0)


def hours_grid(st: Staged) -> DataFrame:
    return with_day_stats(hour_spine(st.metering_history(), "start_time"))


def _emit(df: DataFrame, **cols: Column) -> DataFrame:
    return df.select(*[cols[c].alias(c) for c in SPEND_COLUMNS])


def _grouped(joined: DataFrame, keys: dict[str, Column], usage: Column, spend: Column,
             service: str, unit: str, net_zero: bool = False,
             rate: str = "effective_rate", currency: str = "currency") -> DataFrame:
    """group by hour + keys: zero-filled sums of usage and usage x rate."""
    agg = joined.groupBy("hour", *[v.alias(k) for k, v in keys.items()]).agg(
        F.coalesce(F.sum(usage), _zero()).alias("usage"),
        F.coalesce(F.sum(spend), _zero()).alias("spend"),
        F.max(currency).alias("currency"), F.max(rate).alias("usage_rate"))
    col = lambda k: F.col(k) if k in keys else _null_s()
    return _emit(agg, hour=F.col("hour"), service=F.lit(service), storage_type=col("storage_type"),
                 warehouse_name=col("warehouse_name"), database_name=col("database_name"),
                 usage=F.col("usage"), usage_net_cloud_services=_zero() if net_zero else F.col("usage"),
                 spend=F.col("spend"), spend_net_cloud_services=_zero() if net_zero else F.col("spend"),
                 currency=F.col("currency"), usage_unit=F.lit(unit), usage_rate=F.col("usage_rate"))


def _summed(facts: DataFrame, hour: Column, keys: dict[str, Column], measure: str) -> DataFrame:
    """Facts added up per hour and label before they meet the hour grid: a busy hour reaches the
    join as one row per label, and every map task sends partial sums only."""
    return facts.groupBy(hour.alias("fact_hour"), *[c.alias(k) for k, c in keys.items()]).agg(F.sum(measure).alias(measure))


def storage_terabytes_daily(st: Staged) -> DataFrame:
    """Five storage legs per day (H1); clone residuals only where positive."""
    db = st.database_storage_usage_history()
    tb = lambda c: F.sum(c) / F.lit(BYTES_PER_TB)
    itemized = db.groupBy("date").agg(tb("average_database_bytes").alias("database_storage_terabytes"),
                                      tb("average_failsafe_bytes").alias("failsafe_storage_terabytes"))
    total = st.storage_usage().select(
        "date", (F.col("storage_bytes") / F.lit(BYTES_PER_TB)).alias("storage_terabytes"),
        (F.col("failsafe_bytes") / F.lit(BYTES_PER_TB)).alias("failsafe_terabytes"))
    recon = residual(total, itemized.select("date", "database_storage_terabytes", "failsafe_storage_terabytes"),
                     ["date"], {"residual_storage_terabytes": ("storage_terabytes", "database_storage_terabytes"),
                                "residual_failsafe_terabytes": ("failsafe_terabytes", "failsafe_storage_terabytes")})
    legs = [
        db.groupBy("date", "database_name").agg(tb("average_database_bytes").alias("storage_terabytes"))
          .withColumn("storage_type", F.lit(STORAGE_TYPES[0])),
        db.groupBy("date", "database_name").agg(tb("average_failsafe_bytes").alias("storage_terabytes"))
          .withColumn("storage_type", F.lit(STORAGE_TYPES[1])),
        st.stage_storage_usage_history().groupBy("date").agg(tb("average_stage_bytes").alias("storage_terabytes"))
          .withColumns({"storage_type": F.lit(STORAGE_TYPES[2]), "database_name": _null_s()}),
        recon.where(F.col("residual_storage_terabytes") > 0).select(
            "date", F.col("residual_storage_terabytes").alias("storage_terabytes"),
            F.lit(STORAGE_TYPES[3]).alias("storage_type"), _null_s().alias("database_name")),
        recon.where(F.col("residual_failsafe_terabytes") > 0).select(
            "date", F.col("residual_failsafe_terabytes").alias("storage_terabytes"),
            F.lit(STORAGE_TYPES[4]).alias("storage_type"), _null_s().alias("database_name")),
    ]
    return reduce(DataFrame.unionByName, legs).withColumnRenamed("date", "fact_date")


def _monthly_family(hours: DataFrame, daily: DataFrame, rates: DataFrame, service: str,
                    rate_type: tuple[str, str], keys: list[str]) -> DataFrame:
    """TB priced per month, per hour = TB / (days in month x 24)."""
    j = hours.join(daily, hours["date"] == daily["fact_date"], "left")
    j = j.join(rate_slice(rates, *rate_type), F.col("fact_date") == F.col("rate_date"), "left")
    per_hour = per_hour_of_month("storage_terabytes")
    return _grouped(j, {k: F.col(k) for k in keys}, per_hour, per_hour * F.col("effective_rate"),
                    service, "TB")


def storage_spend_hourly(st, hours, rates) -> DataFrame:
    return _monthly_family(hours, storage_terabytes_daily(st), rates, "Storage",
                           ("STORAGE", "storage"), ["storage_type", "database_name"])


def hybrid_table_storage_spend_hourly(st, hours, rates) -> DataFrame:
    hyb = (st.database_storage_usage_history().groupBy(F.col("date").alias("fact_date"), "database_name")
           .agg((F.sum("average_hybrid_table_storage_bytes") / F.lit(BYTES_PER_TB)).alias("storage_terabytes")))
    return _monthly_family(hours, hyb, rates, "Hybrid Table Storage",
                           ("HYBRID_TABLE_STORAGE", "hybrid table storage"), ["database_name"])


def usage_in_currency_by_type(st: Staged) -> DataFrame:
    """Daily usage per base usage type: overage and normal folded together."""
    u = st.usage_in_currency_daily()
    return u.groupBy("usage_date", "account_name",
                     F.replace("usage_type", F.lit("overage-"), F.lit("")).alias("usage_type"),
                     "currency").agg(F.sum("usage_in_currency").alias("usage_in_currency"),
                                     F.sum("usage").alias("usage"))


def daily_spread_spend_hourly(st: Staged, hours: DataFrame, account: str) -> DataFrame:
    """Data transfer, logging and the reader families in one keyed plan."""
    cats = F.array(*[F.struct(F.lit(t).alias("usage_type"), F.lit(u).alias("usage_unit"))
                     for t, u in DAILY_SPREAD_TYPES])
    grid = hours.select("hour", "date", "hours_thus_far", F.explode(cats).alias("cat")).select(
        "hour", "date", "hours_thus_far", "cat.usage_type", "cat.usage_unit")
    uic = usage_in_currency_by_type(st).where(F.col("account_name") == account).select(
        F.col("usage_date"), F.col("usage_type").alias("u_type"), "currency",
        F.col("usage").alias("u_usage"), F.col("usage_in_currency").alias("u_spend"))
    j = grid.join(uic, (grid["date"] == uic["usage_date"]) & (grid["usage_type"] == uic["u_type"]), "left")
    j = j.withColumns({
        "service": F.initcap("usage_type"),
        "usage": F.coalesce(F.col("u_usage") / F.col("hours_thus_far"), _zero()),
        "spend": F.coalesce(F.col("u_spend") / F.col("hours_thus_far"), _zero()),
        "usage_rate": F.round(div0(F.col("u_spend"), F.col("u_usage")), 2)})
    adj = j.where(F.col("usage_type") == READER_ADJ).select(
        F.col("hour").alias("adj_hour"), F.col("usage").alias("adj_usage"), F.col("spend").alias("adj_spend"))
    plain = j.where(~F.col("usage_type").isin(READER_ADJ, READER_CS))
    reader_adj = j.where(F.col("usage_type") == READER_ADJ)
    reader_cs = j.where(F.col("usage_type") == READER_CS).join(adj, F.col("hour") == F.col("adj_hour"), "left")
    common = dict(hour=F.col("hour"), service=F.col("service"), storage_type=_null_s(),
                  warehouse_name=_null_s(), database_name=_null_s(), usage=F.col("usage"),
                  spend=F.col("spend"), currency=F.col("currency"), usage_unit=F.col("usage_unit"),
                  usage_rate=F.col("usage_rate"))
    return reduce(DataFrame.unionByName, [
        _emit(plain, **common, usage_net_cloud_services=F.col("usage"), spend_net_cloud_services=F.col("spend")),
        _emit(reader_adj, **common, usage_net_cloud_services=_zero(), spend_net_cloud_services=_zero()),
        _emit(reader_cs, **common, usage_net_cloud_services=F.col("usage") + F.col("adj_usage"),
              spend_net_cloud_services=F.col("spend") + F.col("adj_spend")),
    ])


def compute_spend_hourly(st, hours, rates) -> DataFrame:
    m = st.metering_history().where((F.col("service_type") == "WAREHOUSE_METERING")
                                    & (F.col("name") != CLOUD_SERVICES_ONLY))
    m = _summed(m, F.col("start_time"), {"name": F.col("name")}, "credits_used_compute")
    j = hours.join(m, hours["hour"] == m["fact_hour"], "inner")  # S9: the where makes it inner
    j = j.join(rate_slice(rates, "WAREHOUSE_METERING", "compute"), F.col("date") == F.col("rate_date"), "left")
    return _grouped(j, {"warehouse_name": F.col("name")}, F.col("credits_used_compute"),
                    F.col("credits_used_compute") * F.col("effective_rate"), "Compute", "Credits")


def serverless_task_spend_hourly(st, hours, rates) -> DataFrame:
    t = _summed(st.serverless_task_history(), F.date_trunc("hour", "start_time"),
                {"database_name": F.col("database_name")}, "credits_used")
    j = hours.join(t, hours["hour"] == t["fact_hour"], "left")
    j = j.join(rate_slice(rates, "SERVERLESS_TASK", "serverless tasks"), F.col("date") == F.col("rate_date"), "left")
    return _grouped(j, {"database_name": F.col("database_name")}, F.col("credits_used"),
                    F.col("credits_used") * F.col("effective_rate"), "Serverless Tasks", "Credits")


def adj_for_incl_cloud_services_hourly(st, hours, rates) -> DataFrame:
    """The daily adjustment lands on the day's 00:00 hour, all service types."""
    d = _summed(st.metering_daily_history(), F.col("date").cast("timestamp"), {}, "credits_adjustment_cloud_services")
    j = hours.join(d, hours["hour"] == d["fact_hour"], "left")
    j = j.join(rate_slice(rates, "CLOUD_SERVICES", "cloud services"), F.col("date") == F.col("rate_date"), "left")
    return _grouped(j, {}, F.col("credits_adjustment_cloud_services"),
                    F.col("credits_adjustment_cloud_services") * F.col("effective_rate"),
                    "Adj For Incl Cloud Services", "Credits", net_zero=True)


def cloud_services_spend_hourly(st, hours, rates) -> DataFrame:
    m = st.metering_history().where(F.col("service_type") == "WAREHOUSE_METERING")
    label = F.when(F.col("name") == CLOUD_SERVICES_ONLY, F.lit(FREE_TIER_NAME)).otherwise(F.col("name"))
    m = _summed(m, F.col("start_time"), {"warehouse_name": label}, "credits_used_cloud_services")
    usage = hours.join(m, hours["hour"] == m["fact_hour"], "left").select(
        "hour", "date", "warehouse_name", F.coalesce("credits_used_cloud_services", _zero()).alias("cs"))
    daily = (st.metering_daily_history().where(F.col("service_type") == "WAREHOUSE_METERING")
             .groupBy(F.col("date").alias("b_date"))
             .agg(F.sum("credits_used_cloud_services").alias("b_cs"),
                  F.sum(F.col("credits_used_cloud_services") + F.col("credits_adjustment_cloud_services"))
                  .alias("b_billable")))
    j = usage.join(F.broadcast(daily), F.col("date") == F.col("b_date"), "inner")  # S10; one row per day
    j = j.join(rate_slice(rates, "CLOUD_SERVICES", "cloud services"), F.col("date") == F.col("rate_date"), "left")
    net = share_of(F.col("cs"), F.col("b_cs"), F.col("b_billable"))
    return _emit(j, hour=F.col("hour"), service=F.lit("Cloud Services"), storage_type=_null_s(),
                 warehouse_name=F.col("warehouse_name"), database_name=_null_s(), usage=F.col("cs"),
                 usage_net_cloud_services=net, spend=F.col("cs") * F.col("effective_rate"),
                 spend_net_cloud_services=net * F.col("effective_rate"), currency=F.col("currency"),
                 usage_unit=F.lit("Credits"), usage_rate=F.col("effective_rate"))


def _renamed_service(c: Column) -> Column:
    out = c
    for src, dst in SERVICE_RENAMES.items():
        out = F.when(c == src, F.lit(dst)).otherwise(out)
    return out


def _service_label(renamed: Column) -> Column:
    out = F.initcap(F.replace(renamed, F.lit("_"), F.lit(" ")))
    for src, label in SERVICE_LABELS.items():
        out = F.when(renamed == src, F.lit(label)).otherwise(out)
    return out


def other_spend_hourly(st, hours, rates) -> DataFrame:
    """Every other metered service, matched to its rate by renamed service + label."""
    m = st.metering_history().where(~F.col("service_type").isin(*DEDICATED_SERVICE_TYPES))
    renamed = _renamed_service(F.col("service_type"))
    m = _summed(m, F.col("start_time"), {
        "_service_renamed": renamed, "_service": _service_label(renamed),
        "warehouse_name": F.when(F.col("service_type") == "QUERY_ACCELERATION", F.col("name"))}, "credits_used")
    j = hours.join(m, hours["hour"] == m["fact_hour"], "inner")  # S9
    r = rates.select(F.col("date").alias("rate_date"), F.col("service_type").alias("rate_service"),
                     F.col("usage_type").alias("rate_usage"), "effective_rate", "currency")
    j = j.join(r, (F.col("date") == F.col("rate_date")) & (F.col("_service_renamed") == F.col("rate_service"))
               & (F.lower(F.col("_service")) == F.col("rate_usage")), "left")
    agg = j.groupBy("hour", "_service_renamed", F.col("_service").alias("service"), "warehouse_name").agg(
        F.coalesce(F.sum("credits_used"), _zero()).alias("usage"),
        F.coalesce(F.sum(F.col("credits_used") * F.col("effective_rate")), _zero()).alias("spend"),
        F.max("currency").alias("currency"), F.max("effective_rate").alias("usage_rate"))
    return _emit(agg, hour=F.col("hour"), service=F.col("service"), storage_type=_null_s(),
                 warehouse_name=F.col("warehouse_name"), database_name=_null_s(), usage=F.col("usage"),
                 usage_net_cloud_services=F.col("usage"), spend=F.col("spend"),
                 spend_net_cloud_services=F.col("spend"), currency=F.col("currency"),
                 usage_unit=F.lit("Credits"), usage_rate=F.col("usage_rate"))


def hourly_spend(st: Staged, rates: DataFrame, account: str) -> DataFrame:
    hours = materialize(hours_grid(st), "hours")  # one row per hour, used by every family
    families = [
        storage_spend_hourly(st, hours, rates),
        hybrid_table_storage_spend_hourly(st, hours, rates),
        daily_spread_spend_hourly(st, hours, account),
        compute_spend_hourly(st, hours, rates),
        adj_for_incl_cloud_services_hourly(st, hours, rates),
        cloud_services_spend_hourly(st, hours, rates),
        serverless_task_spend_hourly(st, hours, rates),
        other_spend_hourly(st, hours, rates),
    ]
    return reduce(DataFrame.unionByName, families)


def daily_spend(hourly: DataFrame) -> DataFrame:
    """Per UTC day and dimensions; the rate is the usage-weighted average."""
    return hourly.groupBy(F.to_date("hour").alias("date"), "service", "storage_type",
                          "warehouse_name", "database_name").agg(
        F.sum("usage").alias("usage"), F.sum("usage_net_cloud_services").alias("usage_net_cloud_services"),
        F.sum("spend").alias("spend"), F.sum("spend_net_cloud_services").alias("spend_net_cloud_services"),
        F.max("currency").alias("currency"), F.max("usage_unit").alias("usage_unit"),
        weighted_rate().alias("usage_rate"))


def monthly_spend(daily: DataFrame, month: Column) -> DataFrame:
    """Spend per service in one month (the end-to-end check's shape)."""
    m = F.trunc("date", "month")
    return (daily.where(m == month).groupBy(m.alias("month"), "service")
            .agg(F.sum("spend").alias("spend")))
