"""Enriched query log and dbt query metadata.

Row-local work only (regex, JSON parse, map projection) plus one equi-join with the
cost per query on ``query_id``: everything stays in the JVM, no UDF.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.num import BYTES_PER_GB
from ledgerlight.functions.text import (comment_metadata, last_dot_part, merge_maps,
                                        strip_comments, tag_metadata)

COST_COLUMNS = ["compute_cost", "compute_credits", "query_acceleration_cost",
                "query_acceleration_credits", "cloud_services_cost", "cloud_services_credits",
                "query_cost", "query_credits", "execution_start_time"]
QUERY_COLUMNS = [
    "query_text", "database_id", "database_name", "schema_id", "schema_name", "query_type",
    "session_id", "user_name", "role_name", "warehouse_id", "warehouse_name", "warehouse_size",
    "warehouse_type", "cluster_number", "query_tag", "execution_status", "error_code",
    "error_message", "start_time", "end_time", "total_elapsed_time", "bytes_scanned",
    "percentage_scanned_from_cache", "bytes_written", "bytes_written_to_result",
    "bytes_read_from_result", "rows_produced", "rows_inserted", "rows_updated", "rows_deleted",
    "rows_unloaded", "bytes_deleted", "partitions_scanned", "partitions_total",
    "bytes_spilled_to_local_storage", "bytes_spilled_to_remote_storage",
    "bytes_sent_over_the_network", "outbound_data_transfer_cloud", "outbound_data_transfer_region",
    "outbound_data_transfer_bytes", "inbound_data_transfer_cloud", "inbound_data_transfer_region",
    "inbound_data_transfer_bytes", "credits_used_cloud_services", "release_version",
    "external_function_total_invocations", "external_function_total_sent_rows",
    "external_function_total_received_rows", "external_function_total_sent_bytes",
    "external_function_total_received_bytes", "query_load_percent",
    "is_client_generated_statement", "query_acceleration_bytes_scanned",
    "query_acceleration_partitions_scanned", "query_acceleration_upper_limit_scale_factor",
    "query_hash", "query_hash_version", "query_parameterized_hash",
    "query_parameterized_hash_version"]
MS_COLUMNS = ["total_elapsed_time", "compilation_time", "queued_provisioning_time",
              "queued_repair_time", "queued_overload_time", "transaction_blocked_time",
              "list_external_files_time", "execution_time"]
GB_COLUMNS = {"bytes_spilled_to_local_storage": "data_spilled_to_local_storage_gb",
              "bytes_spilled_to_remote_storage": "data_spilled_to_remote_storage_gb",
              "bytes_sent_over_the_network": "data_sent_over_the_network_gb"}

# ---------------------------------------------------------------------------
# Metadata keys read into typed columns, link defaults
# ---------------------------------------------------------------------------
STRING_FIELDS = {
    "dbt_invocation_id": "invocation_id", "dbt_node_id": "node_id",
    "dbt_node_resource_type": "node_resource_type", "dbt_node_materialized": "materialized",
    "dbt_node_alias": "node_alias", "dbt_node_database": "node_database",
    "dbt_node_schema": "node_schema", "dbt_version": "dbt_version",
    "dbt_project_name": "project_name", "dbt_target_name": "target_name",
    "dbt_target_database": "target_database", "dbt_target_schema": "target_schema",
    "dbt_node_package_name": "node_package_name",
    "dbt_node_original_file_path": "node_original_file_path",
    "dbt_cloud_project_id": "dbt_cloud_project_id", "dbt_cloud_job_id": "dbt_cloud_job_id",
    "dbt_cloud_run_id": "dbt_cloud_run_id",
    "dbt_cloud_run_reason_category": "dbt_cloud_run_reason_category",
    "dbt_cloud_run_reason": "dbt_cloud_run_reason",
}
VERSION_KEYS = ("dbt_query_tags_version", "dbt_snowflake_query_tags_version")
REFS_MIN_VERSION = "1.1.3"
DEFAULT_CLOUD_URL = "https://cloud.getdbt.com/deploy/"
MISSING_ACCOUNT_MESSAGE = "Required dbt_cloud_account_id variable not set"


def with_metadata(qh: DataFrame) -> DataFrame:
    """``query_text_no_comments`` and the merged comment + tag ``dbt_metadata`` map."""
    meta = merge_maps(comment_metadata(F.col("query_text")), tag_metadata(F.col("query_tag")))
    return qh.withColumns({"query_text_no_comments": strip_comments(F.col("query_text")),
                           "dbt_metadata": meta})


def query_history_enriched(qh: DataFrame, cost: DataFrame) -> DataFrame:
    q = with_metadata(qh).alias("q")
    c = cost.select("query_id", *COST_COLUMNS, "currency").alias("c")
    j = q.join(c, F.col("q.query_id") == F.col("c.query_id"), "inner")
    qc = lambda n: F.col(f"q.{n}")
    gb = qc("bytes_scanned") / F.lit(BYTES_PER_GB)
    cols = [F.col("c.query_id").alias("query_id"), *[F.col(f"c.{n}").alias(n) for n in COST_COLUMNS],
            *[qc(n).alias(n) for n in QUERY_COLUMNS],
            *[qc(n).alias(f"{n}_ms") for n in MS_COLUMNS],
            qc("warehouse_size").isNotNull().alias("ran_on_warehouse"),
            gb.alias("data_scanned_gb"),
            (gb * qc("percentage_scanned_from_cache")).alias("data_scanned_from_cache_gb"),
            *[(qc(b) / F.lit(BYTES_PER_GB)).alias(n) for b, n in GB_COLUMNS.items()],
            qc("query_text_no_comments").alias("query_text_no_comments"),
            qc("dbt_metadata").alias("dbt_metadata"),
            *[(qc(n) / 1000).alias(f"{n}_s") for n in MS_COLUMNS],
            F.col("c.currency").alias("currency"),
            qc("query_retry_time").alias("query_retry_time_ms"),
            (qc("query_retry_time") / 1000).alias("query_retry_time_s"),
            qc("query_retry_cause").alias("query_retry_cause"),
            qc("fault_handling_time").alias("fault_handling_time_ms"),
            (qc("fault_handling_time") / 1000).alias("fault_handling_time_s")]
    return j.select(*cols)


def _link(project: Column, tail: Column, account_id: str | None, base_url: str) -> Column:
    if account_id:
        target = F.concat(F.lit(base_url), F.lit(account_id), F.lit("/projects/"), project, tail)
    else:
        target = F.lit(MISSING_ACCOUNT_MESSAGE)
    return F.when(project.isNotNull(), target)


def dbt_queries(enriched: DataFrame, cloud_account_id: str | None = None,
                cloud_url: str = DEFAULT_CLOUD_URL) -> DataFrame:
    """Typed dbt fields from the merged metadata of queries that carry it."""
    m = F.col("dbt_metadata")
    get = lambda k: m.getItem(k)
    version = F.coalesce(get(VERSION_KEYS[0]), get(VERSION_KEYS[1]))
    node_id = get("node_id")
    fields = {
        "dbt_snowflake_query_tags_version": version,
        **{out: get(key) for out, key in list(STRING_FIELDS.items())[:2]},
    }
    fields["dbt_node_resource_type"] = get("node_resource_type")
    fields["dbt_node_name"] = F.coalesce(get("node_name"), last_dot_part(node_id))
    fields["dbt_node_materialized"] = get("materialized")
    fields["dbt_node_is_incremental"] = get("is_incremental").try_cast("boolean")
    fields["dbt_node_alias"] = get("node_alias")
    fields["dbt_node_meta"] = get("node_meta")
    fields["node_tags"] = F.from_json(get("node_tags"), "array<string>")
    fields["dbt_node_refs"] = F.when(version >= F.lit(REFS_MIN_VERSION),
                                     F.from_json(get("node_refs"), "array<string>")).otherwise(
        F.array().cast("array<string>"))
    for out in ["dbt_node_database", "dbt_node_schema", "dbt_version", "dbt_project_name",
                "dbt_target_name", "dbt_target_database", "dbt_target_schema",
                "dbt_node_package_name", "dbt_node_original_file_path", "dbt_cloud_project_id",
                "dbt_cloud_job_id", "dbt_cloud_run_id", "dbt_cloud_run_reason_category",
                "dbt_cloud_run_reason"]:
        fields[out] = get(STRING_FIELDS[out])
    project = get("dbt_cloud_project_id")
    fields["dbt_cloud_job_url"] = _link(project, F.concat(F.lit("/jobs/"), get("dbt_cloud_job_id")),
                                        cloud_account_id, cloud_url)
    fields["dbt_cloud_run_url"] = _link(project, F.concat(F.lit("/runs/"), get("dbt_cloud_run_id")),
                                        cloud_account_id, cloud_url)
    rest = [c for c in enriched.columns if c != "dbt_metadata"]
    return (enriched.where(m.isNotNull())
            .select(*[v.alias(k) for k, v in fields.items()], *rest))
