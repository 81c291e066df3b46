"""Daily rates (K16 -> K2 -> K12 -> K13 -> F5): one rate per day and usage type.

The rate sheet only has rows for days with consumption. The plan trims the range to
the latest of the first rate date and the first balance date, builds the day x usage
type grid up to ``as_of``, fills every value from the last known day (else the next),
picks the overage or the normal rate depending on the day's balance, and flags the
latest rate of each type. All inputs are small daily tables (hundreds to thousands of
rows); the grid is bounded by days x usage types.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.fill import flag_latest, gap_fill, latest_per_key, pick_by_priority
from ledgerlight.sources.staging import Staged

# ---------------------------------------------------------------------------
# First day of the date spine, prefix of overage usage types
# ---------------------------------------------------------------------------
SPINE_START = "2018-01-01"
OVERAGE_PREFIX = "overage-"


def remaining_balance_daily_without_contract(st: Staged) -> DataFrame:
    """One balance row per day: the highest contract number wins, nulls last (F2)."""
    bal = st.remaining_balance_daily()
    return latest_per_key(bal, ["date"], [F.col("contract_number").desc_nulls_last(),
                                          F.col("capacity_balance").desc_nulls_last()]).select(
        "date", "organization_name", "currency", "free_usage_balance", "capacity_balance",
        "on_demand_consumption_balance", "rollover_balance")


def daily_rates(st: Staged, account: str, as_of: Column) -> DataFrame:
    rate_base = (st.rate_sheet_daily().where(F.col("account_name") == account)
                 .select("date", "usage_type", "currency", "effective_rate", "service_type"))
    balance = remaining_balance_daily_without_contract(st)

    # Latest of the two first dates (nulls skipped, like max over a union)
    start = F.greatest(rate_base.agg(F.min("date")).scalar(), balance.agg(F.min("date")).scalar())
    end = as_of
    rate_sheet = rate_base.where(F.col("date").between(start, end))

    # K2 + K12: day x usage type grid from the spine start on, filled both ways
    grid_start = F.greatest(start, F.lit(SPINE_START).cast("date"))
    filled = gap_fill(rate_sheet, ["usage_type"], "date",
                      ["service_type", "effective_rate", "currency"], grid_start, end)

    # balance of the day, else the latest balance, else not in overage
    bal_day = balance.select(
        "date",
        (F.col("free_usage_balance") + F.col("capacity_balance")
         + F.col("on_demand_consumption_balance") + F.col("rollover_balance") < 0)
        .alias("_day_overage"))
    latest_overage = (bal_day.orderBy(F.col("date").desc_nulls_first()).limit(1)
                      .where(F.col("date").isNotNull()).select("_day_overage").scalar())
    in_overage = F.coalesce(F.col("_day_overage"), latest_overage, F.lit(False))
    is_overage_rate = F.col("usage_type").startswith(OVERAGE_PREFIX)
    rated = (filled.join(F.broadcast(bal_day), "date", "left")  # one balance row per day
             .withColumn("is_overage_rate", is_overage_rate)
             .withColumn("associated_usage_type", F.replace("usage_type", F.lit(OVERAGE_PREFIX), F.lit("")))
             .withColumn("rate_priority",
                         F.when(in_overage & is_overage_rate, 1)
                         .when(~in_overage & ~is_overage_rate, 1).otherwise(0)))

    # One rate per day, service type and associated usage type (tiebreak S25)
    picked = pick_by_priority(rated, ["date", "service_type", "associated_usage_type"],
                              F.col("rate_priority"), ["usage_type", "effective_rate"])
    out = picked.select("date", F.col("associated_usage_type").alias("usage_type"), "service_type",
                        "effective_rate", "currency", "is_overage_rate")
    # latest day per (service type, usage type); one row per day and type after the pick
    return flag_latest(out, ["service_type", "usage_type"], ["date"], "is_latest_rate")
