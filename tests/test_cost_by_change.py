import datetime as dt

import pytest
from pyspark.sql import functions as F

from ledgerlight.plans.canonical import canonical
from ledgerlight.plans.cost_by_change import Changes, affected_queries, cost_of_changes
from ledgerlight.plans.query_cost import cost_per_query
from ledgerlight.plans.registry import Context
from ledgerlight.sources.staging import Staged
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in canonical(df).collect()), key=str)


def staged(log, metering, warehouses):
    return Staged({"query_history": log, "metering_history": metering, "warehouse_metering_history": warehouses},
                  deduplicated=True)


@pytest.fixture(scope="module")
def ctx(spark):
    return Context(spark, SF_SMALL)


def check(ctx, before, after, changes):
    """The old table without the affected queries, and their new rows, are a full run's table."""
    rates = ctx.daily_rates()
    old = cost_per_query(before, rates)
    new, affected = cost_of_changes(after, rates, changes)
    got = old.join(affected, "query_id", "left_anti").unionByName(new)
    assert rows(got) == rows(cost_per_query(after, rates))
    return affected


def test_late_queries_of_any_age_and_corrected_bills(spark, ctx):
    log, metering, warehouses = ctx.st.query_history(), ctx.st.metering_history(), ctx.st.warehouse_metering_history()
    stop = warehouses.agg(F.max("end_time")).scalar()
    late = F.col("query_id").endswith("7")
    day = log.agg(F.min(F.to_date("start_time"))).first()[0] + dt.timedelta(days=2)
    wrong = F.to_date("start_time") == F.lit(day)
    old_bills = metering.withColumn("credits_used_compute", F.when(wrong, F.col("credits_used_compute") * 2)
                                    .otherwise(F.col("credits_used_compute")))
    changes = Changes(log.where(late), metering.where(wrong), stop)
    affected = check(ctx, staged(log.where(~late), old_bills, warehouses), staged(log, metering, warehouses), changes)
    assert 0 < affected.count() < log.count()


def test_a_query_with_another_end_and_one_that_ran_for_20_days(spark, ctx):
    log, metering, warehouses = ctx.st.query_history(), ctx.st.metering_history(), ctx.st.warehouse_metering_history()
    stop = warehouses.agg(F.max("end_time")).scalar()
    one = log.where("warehouse_size is not null").orderBy("start_time", "query_id").first().query_id
    moved = log.withColumn("end_time", F.when(F.col("query_id") == one, F.col("end_time") + F.expr("INTERVAL 20 DAYS"))
                           .otherwise(F.col("end_time")))
    both = log.where(F.col("query_id") == one).unionByName(moved.where(F.col("query_id") == one))
    affected = check(ctx, staged(log, metering, warehouses), staged(moved, metering, warehouses),
                     Changes(both, metering.limit(0), stop))
    assert affected.count() > 1  # its neighbours pay less


def test_nothing_changed(spark, ctx):
    log, metering = ctx.st.query_history(), ctx.st.metering_history()
    stop = ctx.st.warehouse_metering_history().agg(F.max("end_time")).scalar()
    late = log.where(F.col("end_time") > stop).count()
    assert affected_queries(log, Changes(log.limit(0), metering.limit(0), stop)).count() == late
