"""The whole model set as one job: every model with its materialization, in order.

``views`` stay lazy, ``tables`` are rebuilt, ``incremental`` staging and access models rebuild only
their look-back window and upsert it by key (``streaming/incremental.py``). Cost, enriched log and
dbt queries are brought up to date by what changed in their inputs (``plans/cost_by_change.py``):
a late or long query changes its neighbours' costs however far back, so a look-back over them
would differ from a full build. The access log replaces its look-back months with all records of those months (S20: late records come
in, repeated ones stay). Downstream models read the tables written upstream as they are,
by date partition, so an incremental run reads each of them only inside its window.

Look-backs and keys follow the reference's model settings; ``lookback_days`` overrides them by model.
"""
from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.plans import access, enriched, query_cost, rates, spend, warehouses
from ledgerlight.operators.checks import changed_rows, observed
from ledgerlight.plans.cost_by_change import (Changes, affected_queries, query_slices, touched_days, touched_hours)
from ledgerlight.session import hadoop, materialize, remove_path
from ledgerlight.sources.staging import Staged, first_query
from ledgerlight.streaming import partition_stats
from ledgerlight.streaming.incremental import (partition_dates, path_exists, read_target, replace_dates, run_incremental,
                                               statistics, touched_partitions, upsert)

PART = "_date"  # date partition column of incremental tables, derived from a key column


@dataclass(frozen=True)
class IncrementalSpec:
    keys: tuple[str, ...]
    ts: str              # column the watermark is read from
    lookback_days: float
    part_from: str       # key column the date partition is derived from
    part_by: str = "day"  # or "month", for few rows a day


# Keys and look-back windows of the incremental models
INCREMENTAL = {
    "stg_query_history": IncrementalSpec(("query_id", "start_time"), "end_time", 2, "start_time"),
    "stg_warehouse_metering_history": IncrementalSpec(("start_time", "warehouse_id"), "end_time", 7, "start_time"),
    "stg_serverless_task_history": IncrementalSpec(("start_time", "task_id"), "end_time", 3, "start_time"),
    "cost_per_query": IncrementalSpec(("query_id", "start_time"), "end_time", 3, "start_time"),
    "query_history_enriched": IncrementalSpec(("query_id", "start_time"), "end_time", 3, "start_time"),
    "dbt_queries": IncrementalSpec(("query_id", "start_time"), "end_time", 3, "start_time"),
    "query_base_object_access": IncrementalSpec(("_unique_id", "query_start_time"), "query_start_time", 1,
                                                "query_start_time", "month"),
    "query_direct_object_access": IncrementalSpec(("_unique_id", "query_start_time"), "query_start_time", 1,
                                                  "query_start_time", "month"),
}
ACCESS_LOOKBACK_DAYS = 1
# Counted while a table is written: columns that may not be null, columns that may not be negative
CHECKED = {
    "stg_metering_history": (("start_time", "service_type"), ("credits_used",)),
    "daily_rates": (("date", "usage_type", "effective_rate"), ("effective_rate",)),
    "hourly_spend": (("hour", "service"), ()),
    "warehouses_type2_dimension": (("warehouse_id", "valid_from", "valid_to"), ()),
}


class ModelBuild:
    def __init__(self, spark: SparkSession, sources: Mapping[str, DataFrame], target_root: str,
                 account: str, as_of: Column, cloud_account_id: str | None = None,
                 cloud_url: str = enriched.DEFAULT_CLOUD_URL, lookback_days: Mapping[str, float] | None = None):
        self.cloud_url, self.lookback_days = cloud_url, dict(lookback_days or {})
        self.spark, self.sources, self.root = spark, sources, target_root.rstrip("/")
        self.account, self.as_of, self.cloud_account_id = account, as_of, cloud_account_id
        self.src = Staged(sources)
        self.metrics: dict[str, dict[str, int]] = {}  # by table: rows, nulls and negatives of its last write

    def path(self, name: str) -> str:
        return f"{self.root}/{name}"

    def read(self, name: str) -> DataFrame:
        return read_target(self.spark, self.path(name))

    def _table(self, name: str, df: DataFrame) -> DataFrame:
        """Write beside the live table, then swap: a failed job leaves the old one as it was."""
        path, new, old = (f"{self.path(name)}{x}" for x in ("", f"__new-{uuid.uuid4().hex}", f"__old-{uuid.uuid4().hex}"))
        df, seen = observed(df, *CHECKED.get(name, ((), ())))
        df.write.parquet(new)
        self.metrics[name] = seen.get
        fs, live = hadoop(self.spark, path)
        at = lambda x: hadoop(self.spark, x)[1]
        if fs.exists(live):
            fs.rename(live, at(old))
        fs.rename(at(new), live)
        remove_path(self.spark, old)
        return self.spark.read.schema(df.schema).parquet(path)

    def _stats(self, name: str) -> partition_stats.Stats:
        return statistics(self.spark, self.path(name), PART, "start_time", "end_time")

    def _log(self, dates: list | None = None) -> DataFrame:
        """The staged query log, or the partitions of some dates of it."""
        df = self.read("stg_query_history")
        return (df if dates is None else df.where(partition_stats.in_dates(PART, dates))).drop(PART)

    def _access_log(self, full_refresh: bool) -> dt.datetime | None:
        path, log = self.path("stg_access_history"), self.src.access_history()
        log = log.withColumn(PART, F.trunc("query_start_time", "month"))  # by month: few records a day
        dates = partition_dates(self.spark, path, PART) if path_exists(self.spark, path) and not full_refresh else []
        if not dates:
            remove_path(self.spark, path)
            replace_dates(self.spark, path, log, PART, ["query_start_time"])
            return None
        days = self.lookback_days.get("stg_access_history", ACCESS_LOOKBACK_DAYS)
        since = dt.datetime.combine((dates[-1] - dt.timedelta(days=int(days))).replace(day=1), dt.time())
        replace_dates(self.spark, path, log.where(F.col("query_start_time") >= F.lit(since)), PART, ["query_start_time"],
                      since.date())
        return since

    def _incremental(self, name: str, build, full_refresh: bool) -> dt.datetime | None:
        spec = INCREMENTAL[name]

        def with_part(since):
            return build(since).withColumn(PART, F.trunc(spec.part_from, spec.part_by)
                                          if spec.part_by == "month" else F.to_date(spec.part_from))

        return run_incremental(self.spark, self.path(name), with_part, list(spec.keys), spec.ts,
                               self.lookback_days.get(name, spec.lookback_days), PART, full_refresh,
                               cluster_by=[spec.part_from], start=spec.part_from)

    @staticmethod
    def _after(df: DataFrame, col: str, since: dt.datetime | None) -> DataFrame:
        return df if since is None else df.where(F.col(col) > F.lit(since))

    def _stage_log(self, full_refresh: bool) -> tuple[dt.datetime | None, DataFrame | None]:
        """Bring the staged query log up to date; the rows that differ, in their old and new forms."""
        name = "stg_query_history"
        before = None if full_refresh or not path_exists(self.spark, self.path(name)) else self.read(name)
        batch: list[DataFrame] = []

        def build(since):
            rows = first_query(self._after(self.src.query_log(), "end_time", since))
            if since is None:
                return rows
            batch.append(materialize(rows.withColumn(PART, F.to_date("start_time")), "log-batch"))
            old = touched_partitions(before, PART, batch[0]).join(
                batch[0].select("query_id", "start_time"), ["query_id", "start_time"], "left_semi")
            batch.append(materialize(changed_rows(old.drop(PART), batch[0].drop(PART)), "log-changes"))
            return batch[0].drop(PART)

        since = self._incremental(name, build, full_refresh)
        return since, batch[1] if batch else None

    def _changes(self, log: DataFrame, old: Mapping[str, DataFrame], st: Staged, rates_now: DataFrame) -> Changes:
        key = ["date", "usage_type", "service_type", "effective_rate", "currency", "is_latest_rate"]
        differ = changed_rows(old["daily_rates"].select(*key), rates_now.select(*key)).select("date")
        # days without a rate of their own are billed with the latest one
        priced = rates_now.where(F.col("service_type") == "CLOUD_SERVICES").select("date")
        bare = st.metering_history().select(F.to_date("start_time").alias("date")).distinct().join(priced, "date", "left_anti")
        return Changes(log, changed_rows(old["stg_metering_history"], st.metering_history()),
                       F.lit(old["stop"]).cast("timestamp"), differ.unionByName(bare).distinct())

    def _by_change(self, tables: dict[str, DataFrame], changes: Changes, daily_rates: DataFrame) -> None:
        """Cost, enriched log and dbt queries of the affected queries only, whatever their age; the
        log is read by partitions that ran on the days concerned."""
        stats = self._stats("stg_query_history")
        days = lambda df, c: [r[0] for r in df.select(F.to_date(c)).distinct().collect()]  # noqa: E731  calendar-bounded
        hours = days(touched_hours(changes), "hour") + days(touched_days(changes), "day")
        stop = self.spark.range(1).select(changes.old_stop.alias("t")).first().t or dt.datetime(1970, 1, 1)
        near = set(partition_stats.meeting(stats, hours)) | set(partition_stats.ending_after(stats, stop))
        affected = materialize(affected_queries(self._log(list(near)), changes), "affected")
        rows = materialize(self._log(list(near)).join(affected, "query_id", "left_semi"), "affected-log")
        neighbours = self._log(partition_stats.meeting(stats, days(query_slices(rows), "hour") + days(rows, "start_time")))
        st = Staged(tables | {"query_history": neighbours}, deduplicated=True)
        cost = materialize(query_cost.cost_per_query(st, daily_rates, only=affected), "affected-cost")
        full = materialize(enriched.query_history_enriched(rows, cost), "affected-enriched")
        gone = rows.unionByName(changes.queries).select("query_id", "start_time", F.to_date("start_time").alias(PART))
        for name, df in (("cost_per_query", cost), ("query_history_enriched", full),
                         ("dbt_queries", enriched.dbt_queries(full, self.cloud_account_id, self.cloud_url))):
            spec = INCREMENTAL[name]
            upsert(self.spark, self.path(name), df.withColumn(PART, F.to_date("start_time")), list(spec.keys), PART,
                   cluster_by=[spec.part_from], span=(spec.part_from, spec.ts), remove=gone)

    def _accessed(self, since: dt.datetime | None) -> DataFrame:
        log = self.read("stg_access_history")
        if since is not None:
            log = log.where((F.col(PART) >= F.lit(since.date().replace(day=1))) & (F.col("query_start_time") > F.lit(since)))
        return log.drop(PART)

    def run(self, full_refresh: bool = False) -> dict[str, dt.datetime | None]:
        lows: dict[str, dt.datetime | None] = {}
        src = self.src

        # --- staging: incremental upserts, an append, full tables; the rest are views
        # what the models by change compare with: as the last run left it
        models = ("cost_per_query", "query_history_enriched", "dbt_queries")
        by_change = not full_refresh and all(path_exists(self.spark, self.path(n)) for n in (
            *models, "stg_query_history", "stg_metering_history", "stg_warehouse_metering_history", "daily_rates"))
        old: dict = {}
        if by_change:
            old = {n: materialize(self.read(n), n) for n in ("stg_metering_history", "daily_rates")}
            old["stop"] = partition_stats.latest_end(self._stats("stg_warehouse_metering_history"))
        lows["stg_query_history"], changed_log = self._stage_log(full_refresh)
        lows["stg_warehouse_metering_history"] = self._incremental(
            "stg_warehouse_metering_history",
            lambda since: self._after(src.warehouse_metering_history(), "end_time", since), full_refresh)
        lows["stg_serverless_task_history"] = self._incremental(
            "stg_serverless_task_history",
            lambda since: self._after(src.serverless_task_history(), "end_time", since), full_refresh)
        lows["stg_access_history"] = self._access_log(full_refresh)
        for name, df in [("stg_metering_history", src.metering_history()),
                         ("stg_rate_sheet_daily", src.rate_sheet_daily()),
                         ("stg_remaining_balance_daily", src.remaining_balance_daily())]:
            self._table(name, df)

        tables = dict(self.sources)
        tables.update({
            "query_history": self.read("stg_query_history").drop(PART),
            "warehouse_metering_history": self.read("stg_warehouse_metering_history").drop(PART),
            "serverless_task_history": self.read("stg_serverless_task_history").drop(PART),
            "access_history": self.read("stg_access_history").drop(PART),
            "metering_history": self.read("stg_metering_history"),
            "rate_sheet_daily": self.read("stg_rate_sheet_daily"),
            "remaining_balance_daily": self.read("stg_remaining_balance_daily"),
        })
        st = Staged(tables, deduplicated=True)

        # --- tables
        daily_rates = self._table("daily_rates", rates.daily_rates(st, self.account, self.as_of))
        self._table("hourly_spend", spend.hourly_spend(st, daily_rates, self.account))
        self._table("warehouses_type2_dimension", warehouses.warehouses_type2_dimension(st))

        # --- incremental models, each reading what was written upstream
        if by_change and changed_log is not None:
            self._by_change(tables, self._changes(changed_log, old, st, daily_rates), daily_rates)
            lows |= dict.fromkeys(models, lows["stg_query_history"])
        else:
            whole = {
                "cost_per_query": lambda _: query_cost.cost_per_query(st, daily_rates),
                "query_history_enriched": lambda _: enriched.query_history_enriched(
                    self._log(), self.read("cost_per_query").drop(PART)),
                "dbt_queries": lambda _: enriched.dbt_queries(
                    self.read("query_history_enriched").drop(PART), self.cloud_account_id, self.cloud_url)}
            for name in models:
                lows[name] = self._incremental(name, whole[name], True)
        for kind, build in (("base", access.query_base_object_access), ("direct", access.query_direct_object_access)):
            name = f"query_{kind}_object_access"
            lows[name] = self._incremental(
                name, lambda since, b=build: b(self._accessed(since)),
                full_refresh)
        return lows

    # --- views over the written tables
    def daily_spend(self) -> DataFrame:
        return spend.daily_spend(self.read("hourly_spend"))

    def query_base_table_access(self) -> DataFrame:
        return access.table_access(self.read("query_base_object_access").drop(PART))

    def query_direct_table_access(self) -> DataFrame:
        return access.table_access(self.read("query_direct_object_access").drop(PART))
