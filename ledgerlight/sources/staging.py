"""Staging projections (A2, A3, K15): fixed column lists over the sources, renames,
and the query-log deduplication. Column pruning reaches the parquet scan."""
from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.operators.fill import first_per_key
from ledgerlight.schemas import QUERY_HISTORY_COLUMNS

OBJECT_COLUMNS = ("direct_objects_accessed", "base_objects_accessed", "objects_modified")
RAW_OBJECTS_ARRAY = ("array<struct<objectId:string,objectName:string,objectDomain:string,"
                     "columns:array<struct<columnName:string>>>>")


def first_query(log: DataFrame, repeated: DataFrame | None = None) -> DataFrame:
    return first_per_key(log, ["query_id"], ["start_time", "end_time", "query_text"], repeated=repeated)


class Staged:
    """The twelve staging models over a mapping of source DataFrames."""

    def __init__(self, sources: Mapping[str, DataFrame], deduplicated: bool = False):
        """``deduplicated``: the query log is a staged table already, read as it is."""
        self.src, self.deduplicated = sources, deduplicated

    def query_log(self) -> DataFrame:
        """The log's own columns, every row."""
        return self.src["query_history"].select(*[c for c, _t in QUERY_HISTORY_COLUMNS])

    def query_history(self) -> DataFrame:
        # first row per query id by start time (end time and text break ties)
        return self.query_log() if self.deduplicated else first_query(self.query_log())

    def metering_history(self) -> DataFrame:
        return self.src["metering_history"].select(
            "service_type", "start_time", "end_time", "entity_id", "name",
            "credits_used_compute", "credits_used_cloud_services", "credits_used")

    def warehouse_metering_history(self) -> DataFrame:
        return self.src["warehouse_metering_history"].select(
            "start_time", "end_time", "warehouse_id", "warehouse_name", "credits_used",
            "credits_used_compute", "credits_used_cloud_services")

    def metering_daily_history(self) -> DataFrame:
        return self.src["metering_daily_history"].select(
            F.col("usage_date").alias("date"), "service_type", "credits_used_cloud_services",
            "credits_adjustment_cloud_services")

    def serverless_task_history(self) -> DataFrame:
        return self.src["serverless_task_history"].select(
            "start_time", "end_time", "task_id", "task_name", "schema_id", "schema_name",
            "database_id", "database_name", "credits_used")

    def access_history(self) -> DataFrame:
        """Object arrays may arrive typed or as raw JSON text; text is parsed here with
        ``objectId`` kept as text (the flattening step ``try_cast``s it), so one odd id
        cannot null a whole array."""
        df = self.src["access_history"]
        parsed = {c: F.from_json(c, RAW_OBJECTS_ARRAY) for c in OBJECT_COLUMNS
                  if isinstance(df.schema[c].dataType, T.StringType)}
        if parsed:
            df = df.withColumns(parsed)
        return df.select("query_id", "parent_query_id", "root_query_id", "query_start_time", "user_name",
                         *OBJECT_COLUMNS)

    def database_storage_usage_history(self) -> DataFrame:
        return self.src["database_storage_usage_history"].select(
            F.col("usage_date").alias("date"), "database_name", "average_database_bytes",
            "average_failsafe_bytes", "average_hybrid_table_storage_bytes")

    def stage_storage_usage_history(self) -> DataFrame:
        return self.src["stage_storage_usage_history"].select(
            F.col("usage_date").alias("date"), "average_stage_bytes")

    def storage_usage(self) -> DataFrame:
        return self.src["storage_usage"].select(
            F.col("usage_date").alias("date"), "storage_bytes", "stage_bytes", "failsafe_bytes",
            "hybrid_table_storage_bytes", "archive_storage_cool_bytes",
            "archive_storage_cold_bytes", "archive_storage_retrieval_temp_bytes")

    def rate_sheet_daily(self) -> DataFrame:
        return self.src["rate_sheet_daily"].select(
            "date", "organization_name", "contract_number", "account_name", "account_locator",
            "region", "service_level", "usage_type", "currency", "effective_rate", "service_type")

    def remaining_balance_daily(self) -> DataFrame:
        return self.src["remaining_balance_daily"].select(
            "date", "organization_name", "contract_number", "currency", "free_usage_balance",
            "capacity_balance", "on_demand_consumption_balance", "rollover_balance")

    def usage_in_currency_daily(self) -> DataFrame:
        return self.src["usage_in_currency_daily"].select(
            "organization_name", "contract_number", "account_name", "account_locator", "region",
            "service_level", "usage_date", "usage_type", "currency", "usage", "usage_in_currency",
            "balance_source", "billing_type", "rating_type", "service_type", "is_adjustment")
