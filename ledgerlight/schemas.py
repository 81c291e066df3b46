"""StructTypes of the audit-log sources (names from the reference, types proposed)."""
from __future__ import annotations

from pyspark.sql import types as T

S, L, I, D, B = T.StringType(), T.LongType(), T.IntegerType(), T.DoubleType(), T.BooleanType()
TS, DT = T.TimestampType(), T.DateType()


def _struct(cols):
    return T.StructType([T.StructField(n, t, True) for n, t in cols])


COLUMNS_ARRAY = T.ArrayType(_struct([("columnName", S)]))
OBJECTS_ARRAY = T.ArrayType(_struct([("objectId", L), ("objectName", S),
                                     ("objectDomain", S), ("columns", COLUMNS_ARRAY)]))

QUERY_HISTORY_COLUMNS = [
    ("query_id", S), ("query_text", S), ("database_id", L), ("database_name", S),
    ("schema_id", L), ("schema_name", S), ("query_type", S), ("session_id", L),
    ("user_name", S), ("role_name", S), ("warehouse_id", L), ("warehouse_name", S),
    ("warehouse_size", S), ("warehouse_type", S), ("cluster_number", I), ("query_tag", S),
    ("execution_status", S), ("error_code", S), ("error_message", S),
    ("start_time", TS), ("end_time", TS), ("total_elapsed_time", L),
    ("bytes_scanned", L), ("percentage_scanned_from_cache", D), ("bytes_written", L),
    ("bytes_written_to_result", L), ("bytes_read_from_result", L), ("rows_produced", L),
    ("rows_inserted", L), ("rows_updated", L), ("rows_deleted", L), ("rows_unloaded", L),
    ("bytes_deleted", L), ("partitions_scanned", L), ("partitions_total", L),
    ("bytes_spilled_to_local_storage", L), ("bytes_spilled_to_remote_storage", L),
    ("bytes_sent_over_the_network", L), ("compilation_time", L), ("execution_time", L),
    ("queued_provisioning_time", L), ("queued_repair_time", L), ("queued_overload_time", L),
    ("transaction_blocked_time", L), ("outbound_data_transfer_cloud", S),
    ("outbound_data_transfer_region", S), ("outbound_data_transfer_bytes", L),
    ("inbound_data_transfer_cloud", S), ("inbound_data_transfer_region", S),
    ("inbound_data_transfer_bytes", L), ("list_external_files_time", L),
    ("credits_used_cloud_services", D), ("release_version", S),
    ("external_function_total_invocations", L), ("external_function_total_sent_rows", L),
    ("external_function_total_received_rows", L), ("external_function_total_sent_bytes", L),
    ("external_function_total_received_bytes", L), ("query_load_percent", D),
    ("is_client_generated_statement", B), ("query_acceleration_bytes_scanned", L),
    ("query_acceleration_partitions_scanned", L),
    ("query_acceleration_upper_limit_scale_factor", D), ("query_hash", S),
    ("query_hash_version", L), ("query_parameterized_hash", S),
    ("query_parameterized_hash_version", L), ("query_retry_time", L),
    ("query_retry_cause", S), ("fault_handling_time", L),
]

SOURCES: dict[str, T.StructType] = {
    "query_history": _struct(QUERY_HISTORY_COLUMNS),
    "metering_history": _struct([
        ("service_type", S), ("start_time", TS), ("end_time", TS), ("entity_id", L),
        ("name", S), ("credits_used_compute", D), ("credits_used_cloud_services", D),
        ("credits_used", D)]),
    "warehouse_metering_history": _struct([
        ("start_time", TS), ("end_time", TS), ("warehouse_id", L), ("warehouse_name", S),
        ("credits_used", D), ("credits_used_compute", D), ("credits_used_cloud_services", D)]),
    "metering_daily_history": _struct([
        ("usage_date", DT), ("service_type", S), ("credits_used_cloud_services", D),
        ("credits_adjustment_cloud_services", D)]),
    "serverless_task_history": _struct([
        ("start_time", TS), ("end_time", TS), ("task_id", L), ("task_name", S),
        ("schema_id", L), ("schema_name", S), ("database_id", L), ("database_name", S),
        ("credits_used", D)]),
    "access_history": _struct([
        ("query_id", S), ("parent_query_id", S), ("root_query_id", S),
        ("query_start_time", TS), ("user_name", S), ("direct_objects_accessed", OBJECTS_ARRAY),
        ("base_objects_accessed", OBJECTS_ARRAY), ("objects_modified", OBJECTS_ARRAY)]),
    "database_storage_usage_history": _struct([
        ("usage_date", DT), ("database_name", S), ("average_database_bytes", D),
        ("average_failsafe_bytes", D), ("average_hybrid_table_storage_bytes", D)]),
    "stage_storage_usage_history": _struct([("usage_date", DT), ("average_stage_bytes", D)]),
    "storage_usage": _struct([
        ("usage_date", DT), ("storage_bytes", D), ("stage_bytes", D), ("failsafe_bytes", D),
        ("hybrid_table_storage_bytes", D), ("archive_storage_cool_bytes", D),
        ("archive_storage_cold_bytes", D), ("archive_storage_retrieval_temp_bytes", D)]),
    "rate_sheet_daily": _struct([
        ("date", DT), ("organization_name", S), ("contract_number", S), ("account_name", S),
        ("account_locator", S), ("region", S), ("service_level", S), ("usage_type", S),
        ("currency", S), ("effective_rate", D), ("service_type", S)]),
    "remaining_balance_daily": _struct([
        ("date", DT), ("organization_name", S), ("contract_number", S), ("currency", S),
        ("free_usage_balance", D), ("capacity_balance", D),
        ("on_demand_consumption_balance", D), ("rollover_balance", D)]),
    "usage_in_currency_daily": _struct([
        ("organization_name", S), ("contract_number", S), ("account_name", S),
        ("account_locator", S), ("region", S), ("service_level", S), ("usage_date", DT),
        ("usage_type", S), ("currency", S), ("usage", D), ("usage_in_currency", D),
        ("balance_source", S), ("billing_type", S), ("rating_type", S), ("service_type", S),
        ("is_adjustment", B)]),
}
