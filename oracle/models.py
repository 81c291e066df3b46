"""DuckDB SQL for the model-level queries, written from the models' semantics.

Each ``*_CTE`` string is a list of CTEs (no leading WITH) appended after the source
roles of ``ledgerlight.sources.testbed.duck_ctes``; the ``body`` functions return a
full statement.
"""
from __future__ import annotations

from ledgerlight.sources.testbed import ACCOUNT, duck_ctes

# Fixed values, written out here so that a slip on the Spark side shows.
COMMENT_PATTERN = '/\\*[\\s\\S]*?\\*/|--[^\\n]*(?:\\n|\\z)|;'
DBT_COMMENT_PATTERN = '(?i)/\\*\\s*(\\{[^*]*?"app":\\s*"dbt"[^*]*\\})\\s*\\*/'
TAG_MARKER_KEYS = ('dbt_snowflake_query_tags_version', 'dbt_query_tags_version')
COST_COLUMNS = ['compute_cost', 'compute_credits', 'query_acceleration_cost', 'query_acceleration_credits',
     'cloud_services_cost', 'cloud_services_credits', 'query_cost', 'query_credits', 'execution_start_time']
QUERY_COLUMNS = ['query_text', 'database_id', 'database_name', 'schema_id', 'schema_name', 'query_type', 'session_id',
     'user_name', 'role_name', 'warehouse_id', 'warehouse_name', 'warehouse_size', 'warehouse_type',
     'cluster_number', 'query_tag', 'execution_status', 'error_code', 'error_message', 'start_time', 'end_time',
     'total_elapsed_time', 'bytes_scanned', 'percentage_scanned_from_cache', 'bytes_written',
     'bytes_written_to_result', 'bytes_read_from_result', 'rows_produced', 'rows_inserted', 'rows_updated',
     'rows_deleted', 'rows_unloaded', 'bytes_deleted', 'partitions_scanned', 'partitions_total',
     'bytes_spilled_to_local_storage', 'bytes_spilled_to_remote_storage', 'bytes_sent_over_the_network',
     'outbound_data_transfer_cloud', 'outbound_data_transfer_region', 'outbound_data_transfer_bytes',
     'inbound_data_transfer_cloud', 'inbound_data_transfer_region', 'inbound_data_transfer_bytes',
     'credits_used_cloud_services', 'release_version', 'external_function_total_invocations',
     'external_function_total_sent_rows', 'external_function_total_received_rows',
     'external_function_total_sent_bytes', 'external_function_total_received_bytes', 'query_load_percent',
     'is_client_generated_statement', 'query_acceleration_bytes_scanned', 'query_acceleration_partitions_scanned',
     'query_acceleration_upper_limit_scale_factor', 'query_hash', 'query_hash_version',
     'query_parameterized_hash', 'query_parameterized_hash_version']
MS_COLUMNS = ['total_elapsed_time', 'compilation_time', 'queued_provisioning_time', 'queued_repair_time',
     'queued_overload_time', 'transaction_blocked_time', 'list_external_files_time', 'execution_time']
GB_COLUMNS = {'bytes_spilled_to_local_storage': 'data_spilled_to_local_storage_gb',
     'bytes_spilled_to_remote_storage': 'data_spilled_to_remote_storage_gb',
     'bytes_sent_over_the_network': 'data_sent_over_the_network_gb'}
STRING_FIELDS = {'dbt_invocation_id': 'invocation_id',
     'dbt_node_id': 'node_id',
     'dbt_node_resource_type': 'node_resource_type',
     'dbt_node_materialized': 'materialized',
     'dbt_node_alias': 'node_alias',
     'dbt_node_database': 'node_database',
     'dbt_node_schema': 'node_schema',
     'dbt_version': 'dbt_version',
     'dbt_project_name': 'project_name',
     'dbt_target_name': 'target_name',
     'dbt_target_database': 'target_database',
     'dbt_target_schema': 'target_schema',
     'dbt_node_package_name': 'node_package_name',
     'dbt_node_original_file_path': 'node_original_file_path',
     'dbt_cloud_project_id': 'dbt_cloud_project_id',
     'dbt_cloud_job_id': 'dbt_cloud_job_id',
     'dbt_cloud_run_id': 'dbt_cloud_run_id',
     'dbt_cloud_run_reason_category': 'dbt_cloud_run_reason_category',
     'dbt_cloud_run_reason': 'dbt_cloud_run_reason'}
MISSING_ACCOUNT_MESSAGE = 'Required dbt_cloud_account_id variable not set'

AS_OF = "(SELECT max(CAST(ts AS DATE)) FROM events) + 2"

STAGED = """,
stg_query_history AS (
  SELECT * FROM query_history
  QUALIFY row_number() OVER (PARTITION BY query_id ORDER BY start_time, end_time, query_text) = 1),
bal AS (
  SELECT * FROM remaining_balance_daily
  QUALIFY row_number() OVER (PARTITION BY date ORDER BY contract_number DESC NULLS LAST,
                                                        capacity_balance DESC NULLS LAST) = 1)
"""

# Filled by as-of joins: the newest known value up to a day, else the oldest known one after it.
DAILY_RATES = f""",
price AS (SELECT date AS d, usage_type AS kind, service_type, effective_rate, currency
          FROM rate_sheet_daily WHERE account_name = '{ACCOUNT}'),
span AS (SELECT greatest((SELECT min(d) FROM price), (SELECT min(date) FROM bal)) AS lo, {AS_OF} AS hi),
known AS (SELECT price.* FROM price, span WHERE d >= lo AND d <= hi),
cell AS (SELECT kind, unnest(range(CAST(greatest(lo, DATE '2018-01-01') AS TIMESTAMP),
                                   CAST(hi AS TIMESTAMP) + INTERVAL 1 SECOND, INTERVAL 1 DAY))::DATE AS d
         FROM (SELECT DISTINCT kind FROM known), span),
rate_known AS (SELECT kind, d, effective_rate FROM known WHERE effective_rate IS NOT NULL),
service_known AS (SELECT kind, d, service_type FROM known WHERE service_type IS NOT NULL),
money_known AS (SELECT kind, d, currency FROM known WHERE currency IS NOT NULL),
cell_rate AS (
  SELECT c.kind, c.d, coalesce(b.effective_rate, a.effective_rate) AS effective_rate
  FROM cell c ASOF LEFT JOIN rate_known b ON b.kind = c.kind AND b.d <= c.d
  ASOF LEFT JOIN rate_known a ON a.kind = c.kind AND a.d >= c.d),
cell_service AS (
  SELECT c.kind, c.d, coalesce(b.service_type, a.service_type) AS service_type
  FROM cell c ASOF LEFT JOIN service_known b ON b.kind = c.kind AND b.d <= c.d
  ASOF LEFT JOIN service_known a ON a.kind = c.kind AND a.d >= c.d),
cell_money AS (
  SELECT c.kind, c.d, coalesce(b.currency, a.currency) AS currency
  FROM cell c ASOF LEFT JOIN money_known b ON b.kind = c.kind AND b.d <= c.d
  ASOF LEFT JOIN money_known a ON a.kind = c.kind AND a.d >= c.d),
debt AS (SELECT date AS d, free_usage_balance + capacity_balance + on_demand_consumption_balance
                           + rollover_balance < 0 AS owing FROM bal),
offer AS (
  SELECT c.d, c.kind, service_type, effective_rate, currency, c.kind LIKE 'overage-%' AS over,
         regexp_replace(c.kind, 'overage-', '', 'g') AS plain,
         coalesce((SELECT owing FROM debt WHERE debt.d = c.d), (SELECT arg_max(owing, d) FROM debt), false) AS owing
  FROM cell c JOIN cell_rate USING (kind, d) JOIN cell_service USING (kind, d) JOIN cell_money USING (kind, d)),
-- of a day's offers the one that fits the balance, then the first by name and rate
chosen AS (
  SELECT d, service_type, plain, min({{'misfit': over <> owing, 'kind': kind, 'rate': coalesce(effective_rate, -1e300),
                                       'effective_rate': effective_rate, 'currency': currency, 'over': over}}) AS o
  FROM offer GROUP BY d, service_type, plain),
daily_rates AS (
  SELECT d AS date, plain AS usage_type, service_type, o.effective_rate AS effective_rate, o.currency AS currency,
         o.over AS is_overage_rate,
         d = (SELECT max(z.d) FROM chosen z WHERE z.plain = chosen.plain
              AND z.service_type IS NOT DISTINCT FROM chosen.service_type) AS is_latest_rate
  FROM chosen)
"""

# Each query lists its own hours; hour totals are grouped and joined to them.
COST_PER_QUERY = """,
done AS (
  SELECT query_id, warehouse_id, start_time, end_time, warehouse_size IS NOT NULL AS ran_on_warehouse,
         credits_used_cloud_services, query_acceleration_bytes_scanned AS accelerated,
         start_time + to_milliseconds(queued_provisioning_time + queued_repair_time + queued_overload_time
                                      + list_external_files_time + compilation_time) AS began
  FROM stg_query_history
  WHERE NOT end_time > (SELECT max(end_time) FROM warehouse_metering_history)),
part AS (
  SELECT query_id, warehouse_id, accelerated, began, end_time, CAST(start_time AS DATE) AS day, t.h AS hour,
         epoch_us(least(t.h + INTERVAL 1 HOUR, end_time)) // 1000 - epoch_us(greatest(t.h, began)) // 1000 AS ms
  FROM done, unnest(generate_series(date_trunc('hour', began), end_time - INTERVAL 1 MICROSECOND, INTERVAL 1 HOUR)) AS t(h)
  WHERE ran_on_warehouse),
hour_sum AS (SELECT warehouse_id, hour, sum(ms) AS ms, sum(accelerated) AS accelerated FROM part GROUP BY ALL),
bill AS (
  SELECT entity_id AS warehouse_id, start_time AS hour,
         coalesce(sum(credits_used_compute) FILTER (service_type = 'WAREHOUSE_METERING'), 0) AS compute,
         coalesce(sum(credits_used_compute) FILTER (service_type = 'QUERY_ACCELERATION'), 0) AS speedup,
         coalesce(sum(credits_used_cloud_services) FILTER (service_type = 'WAREHOUSE_METERING'), 0) AS cloud
  FROM metering_history WHERE service_type = 'WAREHOUSE_METERING' OR service_type = 'QUERY_ACCELERATION' GROUP BY ALL),
share AS (
  SELECT p.query_id, r.effective_rate AS rate,
         bill.compute * coalesce(p.ms / nullif(s.ms, 0), 0) AS compute,
         bill.speedup * CASE s.accelerated WHEN 0 THEN 0 ELSE p.accelerated / s.accelerated END AS speedup
  FROM part p JOIN hour_sum s USING (warehouse_id, hour) JOIN bill USING (warehouse_id, hour)
  JOIN daily_rates r ON r.date = p.day AND (r.service_type, r.usage_type) = ('WAREHOUSE_METERING', 'compute')),
used AS (
  SELECT query_id, sum(compute) AS compute, sum(compute * rate) AS compute_cost, sum(speedup) AS speedup,
         sum(speedup * rate) AS speedup_cost FROM share GROUP BY query_id
  UNION ALL SELECT query_id, 0.0, 0.0, 0.0, 0.0 FROM done WHERE NOT ran_on_warehouse),
day_bill AS (
  SELECT day, cloud, greatest(cloud - compute / 10, 0) AS billable
  FROM (SELECT CAST(hour AS DATE) AS day, sum(cloud) AS cloud, sum(compute) AS compute FROM bill GROUP BY 1)),
cloud_price AS (SELECT date, effective_rate, currency, is_latest_rate FROM daily_rates
                WHERE (service_type, usage_type) = ('CLOUD_SERVICES', 'cloud services')),
final AS (
  SELECT d.query_id, d.start_time, d.end_time, d.began, d.ran_on_warehouse, u.* EXCLUDE (query_id),
         CASE b.cloud WHEN 0 THEN 0 ELSE d.credits_used_cloud_services / b.cloud END * b.billable AS cloud,
         coalesce(own.effective_rate, now.effective_rate) AS rate, coalesce(own.currency, now.currency) AS currency
  FROM used u JOIN done d USING (query_id) JOIN day_bill b ON b.day = CAST(d.start_time AS DATE)
  JOIN cloud_price now ON now.is_latest_rate LEFT JOIN cloud_price own ON own.date = b.day),
cost_per_query AS (
  SELECT query_id, start_time, end_time, began AS execution_start_time, compute_cost, compute AS compute_credits,
         speedup_cost AS query_acceleration_cost, speedup AS query_acceleration_credits,
         cloud * rate AS cloud_services_cost, cloud AS cloud_services_credits,
         compute_cost + speedup_cost + cloud * rate AS query_cost, compute + speedup + cloud AS query_credits,
         ran_on_warehouse, currency
  FROM final)
"""


def model_sql(select: str, *parts: str) -> str:
    """Source roles + staging + the given CTE parts, then ``select``."""
    return duck_ctes() + STAGED + "".join(parts) + "\n" + select

_INITCAP = ("array_to_string(list_transform(string_split(lower({x}), ' '), "
            "lambda w: upper(left(w, 1)) || substr(w, 2)), ' ')")
_TB = "1099511627776.0"


def _initcap(x: str) -> str:
    return _INITCAP.format(x=x)


# One long table of priced facts: every family lists (hour, labels, amount, day of its price); a rule
# gives the family's price, unit and whether hours without a fact still get a row; one grouping
# prices them all. Families billed in currency are settled per day and then dealt to its hours.
HOURLY_SPEND = f""",
clock AS (
  SELECT t.h AS hour, CAST(t.h AS DATE) AS day, dayofmonth(last_day(t.h)) * 24 AS month_hours
  FROM (SELECT coalesce(min(start_time), TIMESTAMP '2023-01-01') AS lo, coalesce(max(start_time), TIMESTAMP '2023-01-01') AS hi
        FROM metering_history), unnest(generate_series(lo, hi, INTERVAL 1 HOUR)) AS t(h)),
day_hours AS (SELECT day, count(*) AS n FROM clock GROUP BY day),
rule(family, unit, price_service, price_type, every_hour, free) AS (VALUES
  ('Storage', 'TB', 'STORAGE', 'storage', 'unpriced', false),
  ('Hybrid Table Storage', 'TB', 'HYBRID_TABLE_STORAGE', 'hybrid table storage', 'unpriced', false),
  ('Compute', 'Credits', 'WAREHOUSE_METERING', 'compute', NULL, false),
  ('Serverless Tasks', 'Credits', 'SERVERLESS_TASK', 'serverless tasks', 'priced', false),
  ('Adj For Incl Cloud Services', 'Credits', 'CLOUD_SERVICES', 'cloud services', 'priced', true)),
held AS (
  SELECT usage_date AS day, database_name, x.family, x.storage_type, sum(x.bytes) AS bytes
  FROM database_storage_usage_history, unnest([
    {{'family': 'Storage', 'storage_type': 'Table and Time Travel', 'bytes': average_database_bytes}},
    {{'family': 'Storage', 'storage_type': 'Failsafe', 'bytes': average_failsafe_bytes}},
    {{'family': 'Hybrid Table Storage', 'storage_type': NULL, 'bytes': average_hybrid_table_storage_bytes}}]) AS u(x)
  GROUP BY ALL
  UNION ALL SELECT usage_date, NULL, 'Storage', 'Stage', sum(average_stage_bytes) FROM stage_storage_usage_history GROUP BY 1),
unlisted AS (
  SELECT usage_date AS day, y.storage_type, y.total - (SELECT sum(bytes) FROM held h
           WHERE h.day = usage_date AND h.storage_type = y.itemized) AS bytes
  FROM storage_usage, unnest([
    {{'storage_type': 'Retained for Clones', 'itemized': 'Table and Time Travel', 'total': storage_bytes}},
    {{'storage_type': 'Failsafe Retained for Clones', 'itemized': 'Failsafe', 'total': failsafe_bytes}}]) AS u(y)),
stored AS (
  SELECT * FROM held UNION ALL BY NAME
  SELECT day, CAST(NULL AS VARCHAR) AS database_name, 'Storage' AS family, storage_type, bytes FROM unlisted WHERE bytes > 0),
fact AS (
  SELECT family, hour, storage_type, CAST(NULL AS VARCHAR) AS warehouse_name, database_name,
         bytes / {_TB} / month_hours AS amount, day AS price_day
  FROM stored JOIN clock USING (day)
  UNION ALL
  SELECT 'Compute', hour, NULL, name, NULL, credits_used_compute, day
  FROM metering_history JOIN clock ON hour = start_time
  WHERE service_type = 'WAREHOUSE_METERING' AND name <> 'CLOUD_SERVICES_ONLY'
  UNION ALL
  SELECT 'Serverless Tasks', hour, NULL, NULL, database_name, credits_used, day
  FROM serverless_task_history JOIN clock ON hour = date_trunc('hour', start_time)
  UNION ALL
  SELECT 'Adj For Incl Cloud Services', hour, NULL, NULL, NULL, credits_adjustment_cloud_services, day
  FROM metering_daily_history JOIN clock ON hour = CAST(usage_date AS TIMESTAMP)),
with_holes AS (
  SELECT * FROM fact UNION ALL
  SELECT family, hour, NULL, NULL, NULL, NULL, CASE every_hour WHEN 'priced' THEN day END
  FROM rule, clock WHERE every_hour IS NOT NULL
   AND NOT EXISTS (SELECT 1 FROM fact WHERE fact.family = rule.family AND fact.hour = clock.hour)),
priced AS (
  SELECT f.hour, f.family AS service, f.storage_type, f.warehouse_name, f.database_name, any_value(u.unit) AS usage_unit,
         bool_or(u.free) AS free, coalesce(sum(f.amount), 0) AS usage, coalesce(sum(f.amount * r.effective_rate), 0) AS spend,
         max(r.currency) AS currency, max(r.effective_rate) AS usage_rate
  FROM with_holes f JOIN rule u USING (family)
  LEFT JOIN daily_rates r ON (r.date, r.service_type, r.usage_type) = (f.price_day, u.price_service, u.price_type)
  GROUP BY f.hour, f.family, f.storage_type, f.warehouse_name, f.database_name),
billed_as(kind, unit) AS (VALUES ('data transfer', 'TB'), ('logging', 'Credits'), ('reader compute', 'Credits'),
  ('reader storage', 'TB'), ('reader data transfer', 'TB'), ('reader adj for incl cloud services', 'Credits'),
  ('reader cloud services', 'Credits')),
settled AS (
  SELECT d.day, d.n, b.kind, b.unit, s.usage_date IS NOT NULL AS has_bill, sum(s.usage) AS used,
         sum(s.usage_in_currency) AS paid, s.currency
  FROM day_hours d CROSS JOIN billed_as b
  LEFT JOIN usage_in_currency_daily s ON s.usage_date = d.day AND s.account_name = '{ACCOUNT}'
   AND replace(s.usage_type, 'overage-', '') = b.kind
  GROUP BY d.day, d.n, b.kind, b.unit, s.usage_date IS NOT NULL, s.currency),
per_hour AS (
  SELECT *, coalesce(used / n, 0) AS u, coalesce(paid / n, 0) AS p,
         round(CASE used WHEN 0 THEN 0 ELSE paid / used END, 2) AS rate FROM settled),
dealt AS (
  SELECT c.hour, {_initcap('x.kind')} AS service, x.unit AS usage_unit, x.u AS usage, x.p AS spend, x.currency, x.rate AS usage_rate,
         CASE x.kind WHEN 'reader cloud services' THEN x.u + a.u WHEN 'reader adj for incl cloud services' THEN 0 ELSE x.u END AS net_u,
         CASE x.kind WHEN 'reader cloud services' THEN x.p + a.p WHEN 'reader adj for incl cloud services' THEN 0 ELSE x.p END AS net_p
  FROM clock c JOIN per_hour x USING (day)
  LEFT JOIN per_hour a ON x.kind = 'reader cloud services' AND a.kind = 'reader adj for incl cloud services' AND a.day = x.day),
cloud_day AS (
  SELECT usage_date AS day, sum(credits_used_cloud_services) AS used,
         sum(credits_used_cloud_services + credits_adjustment_cloud_services) AS due
  FROM metering_daily_history WHERE service_type = 'WAREHOUSE_METERING' GROUP BY 1),
cloud_hour AS (
  SELECT c.hour, c.day, replace(m.name, 'CLOUD_SERVICES_ONLY', 'Cloud Services Only') AS warehouse_name,
         coalesce(sum(m.credits_used_cloud_services), 0) AS used
  FROM clock c LEFT JOIN metering_history m ON m.start_time = c.hour AND m.service_type = 'WAREHOUSE_METERING'
  GROUP BY ALL),
cloud AS (
  SELECT h.hour, h.warehouse_name, h.used, CASE d.used WHEN 0 THEN 0 ELSE h.used / d.used END * d.due AS due,
         r.effective_rate AS rate, r.currency
  FROM cloud_hour h JOIN cloud_day d USING (day)
  LEFT JOIN daily_rates r ON (r.date, r.service_type, r.usage_type) = (h.day, 'CLOUD_SERVICES', 'cloud services')),
-- other services go by their own name, but for a few
name_of(service_type, price_service) AS (VALUES ('AUTO_CLUSTERING', 'AUTOMATIC_CLUSTERING'), ('PIPE', 'SNOWPIPE')),
label_of(price_service, label) AS (VALUES ('MATERIALIZED_VIEW', 'Materialized Views'), ('AI_SERVICES', 'AI Services')),
remaining AS (
  SELECT c.hour, c.day, coalesce(k.price_service, m.service_type) AS price_service,
         CASE m.service_type WHEN 'QUERY_ACCELERATION' THEN m.name END AS warehouse_name, sum(m.credits_used) AS used
  FROM metering_history m JOIN clock c ON c.hour = m.start_time LEFT JOIN name_of k USING (service_type)
  WHERE NOT list_contains(['SERVERLESS_TASK', 'WAREHOUSE_METERING', 'WAREHOUSE_METERING_READER'], m.service_type)
  GROUP BY ALL),
named AS (
  SELECT m.*, coalesce(l.label, {_initcap("replace(m.price_service, '_', ' ')")}) AS service
  FROM remaining m LEFT JOIN label_of l USING (price_service)),
other AS (
  SELECT o.hour, o.service, o.price_service, o.warehouse_name, coalesce(max(o.used), 0) AS usage,
         coalesce(sum(o.used * r.effective_rate), 0) AS spend, max(r.currency) AS currency, max(r.effective_rate) AS usage_rate
  FROM named o LEFT JOIN daily_rates r
    ON r.date = o.day AND r.service_type = o.price_service AND r.usage_type = lower(o.service)
  GROUP BY o.hour, o.service, o.price_service, o.warehouse_name),
hourly_spend AS (
  SELECT hour, service, storage_type, warehouse_name, database_name, usage, if(free, 0, usage) AS usage_net_cloud_services,
         spend, if(free, 0, spend) AS spend_net_cloud_services, currency, usage_unit, usage_rate FROM priced
  UNION ALL
  SELECT hour, service, NULL, NULL, NULL, usage, net_u, spend, net_p, currency, usage_unit, usage_rate FROM dealt
  UNION ALL
  SELECT hour, 'Cloud Services', NULL, warehouse_name, NULL, used, due, used * rate, due * rate, currency, 'Credits', rate FROM cloud
  UNION ALL
  SELECT hour, service, NULL, warehouse_name, NULL, usage, usage, spend, spend, currency, 'Credits', usage_rate FROM other),
daily_spend AS (
  SELECT CAST(hour AS DATE) AS date, service, storage_type, warehouse_name, database_name,
    sum(usage) AS usage, sum(usage_net_cloud_services) AS usage_net_cloud_services,
    sum(spend) AS spend, sum(spend_net_cloud_services) AS spend_net_cloud_services,
    max(currency) AS currency, max(usage_unit) AS usage_unit,
    coalesce(CASE WHEN sum(usage) > 0 THEN sum(spend) / sum(usage) END,
             CASE WHEN NOT sum(usage) > 0 AND sum(usage_net_cloud_services) > 0
                  THEN sum(spend_net_cloud_services) / sum(usage_net_cloud_services) END, 0) AS usage_rate
  FROM hourly_spend GROUP BY ALL)
"""

SPEND_DOUBLES = ["usage", "usage_net_cloud_services", "spend", "spend_net_cloud_services", "usage_rate"]
FIRST_MONTH = "(SELECT date_trunc('month', min(CAST(ts AS DATE))) FROM events)"

# --------------------------------------------------------------------------
# Enriched query log and dbt metadata
# --------------------------------------------------------------------------


def _meta_val(key: str) -> str:
    return (f"CASE WHEN list_contains(coalesce(json_keys(m_tag), []), '{key}') "
            f"THEN json_extract_string(m_tag, '$.\"{key}\"') "
            f"ELSE json_extract_string(m_comment, '$.\"{key}\"') END")


_MARKERS = " OR ".join(f"try(json_extract(query_tag, '$.{k}')) IS NOT NULL" for k in TAG_MARKER_KEYS)
_META_TEXT = ("array_to_string(list_sort(list_transform(m_keys, lambda k: k || '=' || coalesce("
              "CASE WHEN list_contains(coalesce(json_keys(m_tag), []), k) "
              "THEN json_extract_string(m_tag, '$.\"' || k || '\"') "
              "ELSE json_extract_string(m_comment, '$.\"' || k || '\"') END, 'null'))), '|')")

ENRICHED = f""",
qm1 AS (SELECT *, nullif(regexp_extract(query_text, '{DBT_COMMENT_PATTERN}', 1), '') AS m_comment_txt
        FROM stg_query_history),
qm2 AS (SELECT *,
          CASE WHEN try(json_type(m_comment_txt)) = 'OBJECT' THEN m_comment_txt END AS m_comment,
          CASE WHEN try(json_type(query_tag)) = 'OBJECT' AND ({_MARKERS}) THEN query_tag END AS m_tag
        FROM qm1),
qm AS (SELECT *,
         CASE WHEN m_comment IS NOT NULL OR m_tag IS NOT NULL
              THEN list_distinct(list_concat(coalesce(json_keys(m_comment), []), coalesce(json_keys(m_tag), [])))
         END AS m_keys
       FROM qm2),
enriched AS (
  SELECT c.query_id, {", ".join(f"c.{n}" for n in COST_COLUMNS)},
    {", ".join(f"q.{n}" for n in QUERY_COLUMNS)},
    {", ".join(f"q.{n} AS {n}_ms" for n in MS_COLUMNS)},
    q.warehouse_size IS NOT NULL AS ran_on_warehouse,
    q.bytes_scanned / 1073741824.0 AS data_scanned_gb,
    q.bytes_scanned / 1073741824.0 * q.percentage_scanned_from_cache AS data_scanned_from_cache_gb,
    {", ".join(f"q.{b} / 1073741824.0 AS {n}" for b, n in GB_COLUMNS.items())},
    regexp_replace(q.query_text, '{COMMENT_PATTERN}', '', 'g') AS query_text_no_comments,
    CASE WHEN q.m_keys IS NOT NULL THEN {_META_TEXT.replace("m_keys", "q.m_keys").replace("m_tag", "q.m_tag").replace("m_comment", "q.m_comment")} END AS dbt_metadata,
    {", ".join(f"q.{n} / 1000 AS {n}_s" for n in MS_COLUMNS)},
    c.currency,
    q.query_retry_time AS query_retry_time_ms, q.query_retry_time / 1000 AS query_retry_time_s,
    q.query_retry_cause, q.fault_handling_time AS fault_handling_time_ms,
    q.fault_handling_time / 1000 AS fault_handling_time_s,
    q.m_keys, q.m_tag, q.m_comment
  FROM qm q JOIN cost_per_query c ON q.query_id = c.query_id)
"""


def _array_text(expr: str) -> str:
    return f"CASE WHEN try(json_type({expr})) = 'ARRAY' THEN array_to_string(json_extract_string({expr}, '$[*]'), '|') END"


_VERSION = f"coalesce({_meta_val('dbt_query_tags_version')}, {_meta_val('dbt_snowflake_query_tags_version')})"
_PROJECT = _meta_val("dbt_cloud_project_id")
DBT_FIELDS = [
    (_VERSION, "dbt_snowflake_query_tags_version"),
    (_meta_val("invocation_id"), "dbt_invocation_id"),
    (_meta_val("node_id"), "dbt_node_id"),
    (_meta_val("node_resource_type"), "dbt_node_resource_type"),
    (f"coalesce({_meta_val('node_name')}, replace(string_split({_meta_val('node_id')}, '.')[-1], '\"', ''))",
     "dbt_node_name"),
    (_meta_val("materialized"), "dbt_node_materialized"),
    (f"TRY_CAST({_meta_val('is_incremental')} AS BOOLEAN)", "dbt_node_is_incremental"),
    (_meta_val("node_alias"), "dbt_node_alias"),
    (_meta_val("node_meta"), "dbt_node_meta"),
    (_array_text(_meta_val("node_tags")), "node_tags"),
    (f"CASE WHEN {_VERSION} >= '1.1.3' THEN {_array_text(_meta_val('node_refs'))} ELSE '' END", "dbt_node_refs"),
] + [(_meta_val(STRING_FIELDS[o]), o) for o in [
    "dbt_node_database", "dbt_node_schema", "dbt_version", "dbt_project_name", "dbt_target_name",
    "dbt_target_database", "dbt_target_schema", "dbt_node_package_name", "dbt_node_original_file_path",
    "dbt_cloud_project_id", "dbt_cloud_job_id", "dbt_cloud_run_id", "dbt_cloud_run_reason_category",
    "dbt_cloud_run_reason"]] + [
    (f"CASE WHEN {_PROJECT} IS NOT NULL THEN '{MISSING_ACCOUNT_MESSAGE}' END", "dbt_cloud_job_url"),
    (f"CASE WHEN {_PROJECT} IS NOT NULL THEN '{MISSING_ACCOUNT_MESSAGE}' END", "dbt_cloud_run_url"),
]

DBT_QUERIES_SELECT = ("SELECT " + ", ".join(f"{e} AS {n}" for e, n in DBT_FIELDS) +
                      ", * EXCLUDE (dbt_metadata, m_keys, m_tag, m_comment) FROM enriched WHERE m_keys IS NOT NULL")
_LINK = f"'https://dbt.example.com/deploy/42/projects/' || {_PROJECT}"
DBT_LINKED_SELECT = (
    f"SELECT query_id, {_LINK} || '/jobs/' || {_meta_val('dbt_cloud_job_id')} AS dbt_cloud_job_url, "
    f"{_LINK} || '/runs/' || {_meta_val('dbt_cloud_run_id')} AS dbt_cloud_run_url FROM enriched WHERE m_keys IS NOT NULL")
ENRICHED_SELECT = "SELECT * EXCLUDE (m_keys, m_tag, m_comment) FROM enriched"
ENRICHED_DOUBLES = (["compute_cost", "compute_credits", "query_acceleration_cost", "query_acceleration_credits",
                     "cloud_services_cost", "cloud_services_credits", "query_cost", "query_credits",
                     "percentage_scanned_from_cache", "credits_used_cloud_services", "query_load_percent",
                     "query_acceleration_upper_limit_scale_factor", "data_scanned_gb",
                     "data_scanned_from_cache_gb", *GB_COLUMNS.values()]
                    + [f"{n}_s" for n in MS_COLUMNS] + ["query_retry_time_s", "fault_handling_time_s"])

# --------------------------------------------------------------------------
# Access history (flattened directly from the tables, without arrays)
# --------------------------------------------------------------------------
ACCESS_LINES = """
WITH lines AS (
  SELECT CAST(l.l_orderkey AS VARCHAR) || '-' || CAST(l.l_linenumber AS VARCHAR) AS query_id,
         o.o_orderdate AS query_start_time, 'cust_' || CAST(o.o_custkey AS VARCHAR) AS user_name, l.*
  FROM orders o JOIN lineitem l ON o.o_orderkey = l.l_orderkey),
base_cols AS (
  SELECT * FROM (
    SELECT query_id, query_start_time, user_name, l_partkey AS table_id,
           CASE WHEN l_tax > 0.07 THEN NULL ELSE 'PART_' || CAST(l_partkey AS VARCHAR) END AS object_name,
           'Table' AS object_domain,
           CASE WHEN l_quantity < 5 THEN [] ELSE ['l_extendedprice', 'l_shipdate'] END AS cols
    FROM lines) AS b, unnest(cols) AS t(col)
  WHERE object_name IS NOT NULL),
direct_cols AS (
  SELECT query_id, query_start_time, user_name,
         CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END AS table_id,
         'SUPPLIER_' || CAST(l_suppkey AS VARCHAR) AS object_name,
         CASE WHEN l_linestatus = 'O' THEN 'Table' ELSE 'View' END AS object_domain,
         unnest(['l_quantity', CASE WHEN l_discount > 0.05 THEN 'l_discount' END,
                 'line_' || CAST(l_linenumber AS VARCHAR), 'l_quantity', 'l_shipdate']) AS col
  FROM lines),
base_objects AS (
  SELECT md5(query_id || object_name) AS _unique_id, query_id, query_start_time, user_name, table_id,
         object_name, object_domain, array_to_string(list_sort(list_distinct(array_agg(col))), '|') AS columns_accessed
  FROM base_cols GROUP BY query_id, query_start_time, user_name, table_id, object_name, object_domain),
direct_objects AS (
  SELECT * FROM (
    SELECT md5(query_id || object_name) AS _unique_id, query_id, query_start_time, user_name, table_id,
           object_name, object_domain,
           array_to_string(list_sort(list_distinct(array_agg(col))), '|') AS columns_accessed
    FROM direct_cols GROUP BY query_id, query_start_time, user_name, table_id, object_name, object_domain) AS g
  QUALIFY row_number() OVER (PARTITION BY _unique_id, query_start_time
                             ORDER BY table_id NULLS FIRST, object_domain NULLS FIRST, user_name NULLS FIRST) = 1)
"""
TABLE_ACCESS = ("SELECT _unique_id, query_id, query_start_time, user_name, object_name AS full_table_name, "
                "table_id, columns_accessed FROM {src} WHERE object_domain = 'Table' AND table_id IS NOT NULL")

# The whole log, arrays as text: objects parted by semicolons, a missing id, name or column as a dash
ACCESS_LOG = ACCESS_LINES + """
SELECT query_id, NULL::VARCHAR AS parent_query_id, NULL::VARCHAR AS root_query_id, query_start_time, user_name,
  supplier || ':l_quantity,' || CASE WHEN l_discount > 0.05 THEN 'l_discount' ELSE '-' END || ',line_' || l_linenumber || ';'
  || supplier || ':l_quantity,l_shipdate' AS direct_objects_accessed,
  l_partkey || ':' || CASE WHEN l_tax > 0.07 THEN '-' ELSE 'PART_' || l_partkey END || ':Table:'
  || CASE WHEN l_quantity < 5 THEN '' ELSE 'l_extendedprice,l_shipdate' END || ';' || l_suppkey || ':SUPPLIER_' || l_suppkey
  || ':Table' AS base_objects_accessed,
  NULL::VARCHAR AS objects_modified
FROM (SELECT *, CASE WHEN l_returnflag = 'R' THEN '-' ELSE l_suppkey::VARCHAR END || ':SUPPLIER_' || l_suppkey || ':'
  || CASE WHEN l_linestatus = 'O' THEN 'Table' ELSE 'View' END AS supplier FROM lines) AS x"""

# Gaps and islands: rows numbered over the warehouse and over each of its states; a state's run
# has one difference. A null name starts no period, but parts two runs of the same state.
WAREHOUSES = """,
seen AS (
  SELECT warehouse_id, warehouse_size, warehouse_name, start_time, query_id,
         row_number() OVER (PARTITION BY warehouse_id ORDER BY start_time, query_id)
         - row_number() OVER (PARTITION BY warehouse_id, warehouse_size, warehouse_name ORDER BY start_time, query_id) AS run
  FROM stg_query_history WHERE warehouse_size IS NOT NULL),
period AS (
  SELECT warehouse_id, warehouse_size, warehouse_name, run, min({'at': start_time, 'by': query_id}) AS opened
  FROM seen GROUP BY ALL),
warehouses_type2_dimension AS (
  SELECT p.warehouse_id, p.warehouse_name, p.warehouse_size, p.opened.at AS valid_from,
         coalesce(min(q.opened).at, (SELECT max(start_time) FROM stg_query_history)) AS valid_to,
         count(q.opened) = 0 AS is_current
  FROM period p LEFT JOIN period q ON q.warehouse_id = p.warehouse_id AND q.opened > p.opened
  GROUP BY p.warehouse_id, p.warehouse_name, p.warehouse_size, p.opened)
"""

COST_LOOKBACK = (f"SELECT * FROM cost_per_query WHERE end_time > "
                 f"(SELECT max(end_time) - INTERVAL 3 DAY FROM done)")

# --------------------------------------------------------------------------
# The reference's data checks (each returns the offending rows; empty = pass)
# --------------------------------------------------------------------------
CHECK_NO_QUERIES_DROPPED = (
    "SELECT coalesce(e.query_id, c.query_id) AS query_id, "
    "CASE WHEN c.query_id IS NULL THEN 'only_in_left' ELSE 'only_in_right' END AS side "
    "FROM (SELECT DISTINCT query_id FROM enriched WHERE CAST(start_time AS DATE) < (" + AS_OF + ")) e "
    "FULL OUTER JOIN (SELECT DISTINCT query_id FROM cost_per_query WHERE CAST(start_time AS DATE) < ("
    + AS_OF + ")) c ON e.query_id = c.query_id WHERE e.query_id IS NULL OR c.query_id IS NULL")
CHECK_UNIQUE_DAILY_RATES = ("SELECT date, usage_type, count(*) AS n FROM daily_rates "
                            "GROUP BY date, usage_type HAVING count(*) > 1")
CHECK_COST_KEYS = ("SELECT query_id, count(*) AS n FROM cost_per_query GROUP BY query_id "
                   "HAVING count(*) > 1 OR query_id IS NULL")

# --------------------------------------------------------------------------
# Staging tables: (columns as delivered or renamed, double columns), written out from the models
# --------------------------------------------------------------------------
STAGING = {
    "stg_metering_history": (
        "SELECT service_type, start_time, end_time, entity_id, name, credits_used_compute, "
        "credits_used_cloud_services, credits_used FROM metering_history",
        ["credits_used_compute", "credits_used_cloud_services", "credits_used"]),
    "stg_warehouse_metering_history": (
        "SELECT start_time, end_time, warehouse_id, warehouse_name, credits_used, credits_used_compute, "
        "credits_used_cloud_services FROM warehouse_metering_history",
        ["credits_used_compute", "credits_used_cloud_services", "credits_used"]),
    "stg_metering_daily_history": (
        "SELECT usage_date AS date, service_type, credits_used_cloud_services, credits_adjustment_cloud_services "
        "FROM metering_daily_history", ["credits_used_cloud_services", "credits_adjustment_cloud_services"]),
    "stg_serverless_task_history": (
        "SELECT start_time, end_time, task_id, task_name, schema_id, schema_name, database_id, database_name, "
        "credits_used FROM serverless_task_history", ["credits_used"]),
    "stg_database_storage_usage_history": (
        "SELECT usage_date AS date, database_name, average_database_bytes, average_failsafe_bytes, "
        "average_hybrid_table_storage_bytes FROM database_storage_usage_history",
        ["average_database_bytes", "average_failsafe_bytes", "average_hybrid_table_storage_bytes"]),
    "stg_stage_storage_usage_history": (
        "SELECT usage_date AS date, average_stage_bytes FROM stage_storage_usage_history", ["average_stage_bytes"]),
    "stg_storage_usage": (
        "SELECT usage_date AS date, storage_bytes, stage_bytes, failsafe_bytes, hybrid_table_storage_bytes, "
        "archive_storage_cool_bytes, archive_storage_cold_bytes, archive_storage_retrieval_temp_bytes FROM storage_usage",
        ["storage_bytes", "stage_bytes", "failsafe_bytes", "hybrid_table_storage_bytes", "archive_storage_cool_bytes",
         "archive_storage_cold_bytes", "archive_storage_retrieval_temp_bytes"]),
    "stg_rate_sheet_daily": (
        "SELECT date, organization_name, contract_number, account_name, account_locator, region, service_level, "
        "usage_type, currency, effective_rate, service_type FROM rate_sheet_daily", ["effective_rate"]),
    "stg_remaining_balance_daily": (
        "SELECT date, organization_name, contract_number, currency, free_usage_balance, capacity_balance, "
        "on_demand_consumption_balance, rollover_balance FROM remaining_balance_daily",
        ["free_usage_balance", "capacity_balance", "on_demand_consumption_balance", "rollover_balance"]),
    "stg_usage_in_currency_daily": (
        "SELECT organization_name, contract_number, account_name, account_locator, region, service_level, usage_date, "
        "usage_type, currency, usage, usage_in_currency, balance_source, billing_type, rating_type, service_type, "
        "is_adjustment FROM usage_in_currency_daily", ["usage", "usage_in_currency"]),
}
