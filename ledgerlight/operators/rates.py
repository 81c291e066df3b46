"""Rate lookups and rate averages."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def rate_slice(rates: DataFrame, service_type: str | None, usage_type: str | None,
               prefix: str = "", latest_only: bool = False) -> DataFrame:
    """Rates of one (service type, usage type), columns renamed with ``prefix``.

    Proven size bound: the daily rate table holds one row per (day, service type,
    usage type), so a slice holds at most one row per day of the rate grid. It is
    broadcast, which also keeps a day holding most facts from becoming a hot join key."""
    r = rates
    if service_type is not None:
        r = r.where(F.col("service_type") == service_type)
    if usage_type is not None:
        r = r.where(F.col("usage_type") == usage_type)
    if latest_only:
        r = r.where(F.col("is_latest_rate"))
    return F.broadcast(r.select(F.col("date").alias(f"{prefix}rate_date"),
                                F.col("effective_rate").alias(f"{prefix}effective_rate"),
                                F.col("currency").alias(f"{prefix}currency")))


def with_rate(df: DataFrame, rates: DataFrame, date: Column, service_type: str,
              usage_type: str, how: str = "left", prefix: str = "") -> DataFrame:
    """Attach ``effective_rate``/``currency`` of the given type on ``date``."""
    r = rate_slice(rates, service_type, usage_type, prefix)
    return df.join(r, date == F.col(f"{prefix}rate_date"), how).drop(f"{prefix}rate_date")


def weighted_rate(spend: str = "spend", usage: str = "usage",
                  spend_net: str = "spend_net_cloud_services",
                  usage_net: str = "usage_net_cloud_services") -> Column:
    """Aggregate expression: spend / usage, else net spend / net usage, else 0."""
    su, ss = F.sum(usage), F.sum(spend)
    snu, sns = F.sum(usage_net), F.sum(spend_net)
    return (F.when(su > 0, ss / su).when(snu > 0, sns / snu).otherwise(F.lit(0.0)))
