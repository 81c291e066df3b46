"""Binding of the driver's test tables to the reference's audit-log sources.

The reference reads a warehouse's own audit tables, which are not in the test data.
Each source role is derived here from the test tables by Spark (so its size grows
with them), following one rule per role:

* ``query_history``          one query per ``events`` row: query = event, warehouse =
                             user, start = ``ts``, end = ``ts + floor(value*60)`` s,
                             metadata in text/tag built from the event's fields.
* ``metering_history``       hourly credits per warehouse (sum of ``value``), per
                             accelerated warehouse, a cloud-services-only leg and one
                             leg per serverless service family.
* ``warehouse_metering_history`` / ``metering_daily_history``  rolled up from it.
* ``serverless_task_history`` ``signup`` events as task runs.
* ``rate_sheet_daily``       a price per usage type, published on the days the type has
                             at least its mean number of metering rows (so the sheet has
                             holes to fill), plus rows of a second account.
* ``remaining_balance_daily`` mean daily ``value`` minus the day's ``value`` (negative
                             on heavy days: overage), with a second contract row.
* storage tables             daily bytes from ``value`` per event type.
* ``usage_in_currency_daily`` daily usage per event type mapped to a usage type.
* ``access_history``         one access record per line item (order + line number), with
                             fixed-size object arrays built per row.

Every rule is written once as SQL text. The Spark side evaluates it with
``selectExpr``/``groupBy(expr)`` on DataFrames; ``duck_sql`` renders the same text for
the DuckDB oracle, so both engines read identical inputs.
"""
from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.schemas import SOURCES
from ledgerlight.session import default_parallelism, path_bytes

# ---------------------------------------------------------------------------
# Fixed values of the binding
# ---------------------------------------------------------------------------
ACCOUNT = "ACME"
OTHER_ACCOUNT = "OTHER"
LOG_TASK_BYTES = 8 * 1024 * 1024  # of line item files, for one task of the nested access log
# (metered service type, usage type, rate-sheet service type, base rate)
PRICE_LIST = [
    ("WAREHOUSE_METERING", "compute", "WAREHOUSE_METERING", 2.0),
    ("WAREHOUSE_METERING", "overage-compute", "WAREHOUSE_METERING", 2.5),
    ("CLOUD_SERVICES", "cloud services", "CLOUD_SERVICES", 2.0),
    ("CLOUD_SERVICES", "overage-cloud services", "CLOUD_SERVICES", 2.5),
    ("QUERY_ACCELERATION", "query acceleration", "QUERY_ACCELERATION", 2.0),
    ("AUTO_CLUSTERING", "automatic clustering", "AUTOMATIC_CLUSTERING", 2.0),
    ("PIPE", "snowpipe", "SNOWPIPE", 1.25),
    ("MATERIALIZED_VIEW", "materialized views", "MATERIALIZED_VIEW", 2.0),
    ("SEARCH_OPTIMIZATION", "search optimization", "SEARCH_OPTIMIZATION", 2.0),
    ("SERVERLESS_TASK", "serverless tasks", "SERVERLESS_TASK", 1.5),
    ("STORAGE", "storage", "STORAGE", 23.0),
    ("HYBRID_TABLE_STORAGE", "hybrid table storage", "HYBRID_TABLE_STORAGE", 40.0),
]

SQL_TYPES = {T.StringType(): "STRING", T.LongType(): "BIGINT", T.IntegerType(): "INT",
             T.DoubleType(): "DOUBLE", T.BooleanType(): "BOOLEAN", T.DateType(): "DATE",
             T.TimestampType(): "TIMESTAMP"}


def _sql_type(dt) -> str:
    return SQL_TYPES.get(dt, None) or dt.simpleString()


# ---------------------------------------------------------------------------
# The one place where the two dialects differ: the event base columns
# ---------------------------------------------------------------------------
EV_SPARK = {
    "k": "CAST(get_json_object(props, '$.k') AS INT)",
    "start_ts": "CAST(ts AS TIMESTAMP)",
    "end_ts": "timestampadd(SECOND, CAST(floor(value * 60) AS BIGINT), CAST(ts AS TIMESTAMP))",
    "day": "CAST(ts AS DATE)",
    "hour": "CAST(date_trunc('HOUR', ts) AS TIMESTAMP)",
}
EV_DUCK = {
    "k": "CAST(json_extract_string(props, '$.k') AS INT)",
    "start_ts": "ts",
    "end_ts": "ts + to_seconds(CAST(floor(value * 60) AS BIGINT))",
    "day": "CAST(ts AS DATE)",
    "hour": "date_trunc('hour', ts)",
}

# ---------------------------------------------------------------------------
# query_history: one query per event
# ---------------------------------------------------------------------------
_U = "CAST(user_id AS STRING)"
_K = "CAST(k AS STRING)"
QUERY_TEXT = f"""CASE event_type
  WHEN 'view' THEN 'select value from events where user_id = ' || {_U} ||
    ' /* {{"app": "dbt", "dbt_version": "1.7.3", "invocation_id": "inv-' || {_U} ||
    '", "node_id": "model.shop.view_' || {_K} || '", "node_resource_type": "model", "materialized": "table", "is_incremental": false, "node_tags": ["hourly", "k' || {_K} ||
    '"], "node_meta": {{"owner": "u' || {_U} || '"}}, "project_name": "shop", "target_name": "prod", "target_database": "ANALYTICS", "target_schema": "MARTS"}} */'
  WHEN 'click' THEN 'select count(*) from events where user_id > 0 -- click ' || {_K}
  WHEN 'purchase' THEN '-- purchase ' || {_K} || chr(10) ||
    'select sum(value) from events; /* {{"app": "dbt", "node_id": "model.shop.purchase_' || {_K} ||
    '", "materialized": "view", "node_database": "ANALYTICS", "dbt_version": "1.6.0"}} */'
  WHEN 'error' THEN '/* retry */ select 1 /* {{"app": "dbt", "node_id": }} */'
  ELSE 'insert into signups values (' || {_U} || ');'
END"""
QUERY_TAG = f"""CASE event_type
  WHEN 'click' THEN '{{"dbt_snowflake_query_tags_version": "2.3.2", "invocation_id": "inv-' || {_U} ||
    '", "node_id": "model.shop.click_' || {_K} || '", "node_name": "click_' || {_K} ||
    '", "node_refs": ["model.shop.view_' || {_K} || '"], "node_tags": ["live"], "materialized": "incremental", "is_incremental": true, "dbt_cloud_project_id": "' || {_U} ||
    '", "dbt_cloud_job_id": "' || {_K} || '", "dbt_cloud_run_id": "' || CAST(event_id AS STRING) || '"}}'
  WHEN 'purchase' THEN '{{"dbt_query_tags_version": "1.0.0", "materialized": "incremental", "node_refs": ["model.shop.click_' || {_K} || '"]}}'
  WHEN 'error' THEN '{{"team": "core"}}'
  ELSE ''
END"""
WAREHOUSE_SIZE = ("CASE event_type WHEN 'view' THEN 'X-Small' WHEN 'click' THEN 'Small' "
                  "WHEN 'purchase' THEN 'Medium' WHEN 'error' THEN 'Large' END")
ON_WAREHOUSE = "event_type <> 'signup'"

QUERY_HISTORY = {
    "query_id": "CAST(event_id AS STRING)",
    "query_text": QUERY_TEXT,
    "database_id": "CAST(NULL AS BIGINT)",
    "database_name": "'DB_' || upper(event_type)",
    "schema_name": "'PUBLIC'",
    "query_type": "CASE WHEN event_type = 'signup' THEN 'INSERT' ELSE 'SELECT' END",
    "session_id": "user_id",
    "user_name": f"'user_' || {_U}",
    "role_name": "'ANALYST'",
    "warehouse_id": f"CASE WHEN {ON_WAREHOUSE} THEN user_id END",
    "warehouse_name": f"CASE WHEN {ON_WAREHOUSE} THEN 'WH_' || {_U} END",
    "warehouse_size": WAREHOUSE_SIZE,
    "warehouse_type": f"CASE WHEN {ON_WAREHOUSE} THEN 'STANDARD' END",
    "cluster_number": f"CASE WHEN {ON_WAREHOUSE} THEN 1 END",
    "query_tag": QUERY_TAG,
    "execution_status": "CASE WHEN event_type = 'error' THEN 'FAIL' ELSE 'SUCCESS' END",
    "error_code": "CASE WHEN event_type = 'error' THEN '000630' END",
    "error_message": "CASE WHEN event_type = 'error' THEN 'Statement reached its timeout' END",
    "start_time": "start_ts",
    "end_time": "end_ts",
    "total_elapsed_time": "CAST(floor(value * 60) AS BIGINT) * 1000",
    "bytes_scanned": "CAST(floor(value * 1048576) AS BIGINT)",
    "percentage_scanned_from_cache": "k / 100",
    "bytes_written": "CAST(0 AS BIGINT)",
    "rows_produced": "CAST(k AS BIGINT)",
    "partitions_scanned": "CAST(k AS BIGINT)",
    "partitions_total": "CAST(100 AS BIGINT)",
    "bytes_spilled_to_local_storage": "CASE WHEN value > 400 THEN CAST(floor(value * 1000000) AS BIGINT) ELSE 0 END",
    "bytes_spilled_to_remote_storage": "CAST(0 AS BIGINT)",
    "bytes_sent_over_the_network": "CAST(k AS BIGINT) * 1024",
    "compilation_time": "CAST(k AS BIGINT) * 37",
    "queued_provisioning_time": "CAST(0 AS BIGINT)",
    "queued_repair_time": "CAST(0 AS BIGINT)",
    "queued_overload_time": "CASE WHEN event_type = 'error' THEN CAST(floor(value * 1000) AS BIGINT) ELSE 0 END",
    "transaction_blocked_time": "CAST(0 AS BIGINT)",
    "list_external_files_time": "CAST(0 AS BIGINT)",
    "execution_time": ("CAST(floor(value * 60) AS BIGINT) * 1000 - CAST(k AS BIGINT) * 37 - "
                       "CASE WHEN event_type = 'error' THEN CAST(floor(value * 1000) AS BIGINT) ELSE 0 END"),
    "credits_used_cloud_services": "value * k / 50000",
    "release_version": "'8.12.1'",
    "query_load_percent": f"CASE WHEN {ON_WAREHOUSE} THEN 100.0 END",
    "is_client_generated_statement": "false",
    "query_acceleration_bytes_scanned": "CASE WHEN event_type = 'error' THEN CAST(floor(value * 1000) AS BIGINT) ELSE 0 END",
    "query_acceleration_partitions_scanned": "CAST(0 AS BIGINT)",
    "query_retry_time": "CAST(0 AS BIGINT)",
    "fault_handling_time": "CAST(0 AS BIGINT)",
}


@dataclass
class AggRole:
    """``SELECT post FROM (SELECT group, aggs FROM src WHERE where GROUP BY group)``."""
    src: str
    group: dict[str, str]
    aggs: dict[str, str]
    post: dict[str, str]
    where: str | None = None
    union_with: list["AggRole"] = field(default_factory=list)


_WH_CS = "sum(value * k) / 50000"
METERING_LEGS = [
    AggRole("ev", {"user_id": "user_id", "hour": "hour"},
            {"compute": "sum(value) / 100", "cs": _WH_CS},
            {"service_type": "'WAREHOUSE_METERING'", "start_time": "hour",
             "end_time": "hour + INTERVAL 1 HOUR", "entity_id": "user_id",
             "name": f"'WH_' || {_U}", "credits_used_compute": "compute",
             "credits_used_cloud_services": "cs", "credits_used": "compute + cs"},
            where="event_type IN ('view', 'click', 'purchase', 'error')"),
    AggRole("ev", {"user_id": "user_id", "hour": "hour"},
            {"compute": "sum(value) / 1000"},
            {"service_type": "'QUERY_ACCELERATION'", "start_time": "hour",
             "end_time": "hour + INTERVAL 1 HOUR", "entity_id": "user_id",
             "name": f"'WH_' || {_U}", "credits_used_compute": "compute",
             "credits_used_cloud_services": "CAST(0 AS DOUBLE)", "credits_used": "compute"},
            where="event_type = 'error'"),
    AggRole("ev", {"hour": "hour"}, {"cs": _WH_CS},
            {"service_type": "'WAREHOUSE_METERING'", "start_time": "hour",
             "end_time": "hour + INTERVAL 1 HOUR", "entity_id": "CAST(0 AS BIGINT)",
             "name": "'CLOUD_SERVICES_ONLY'", "credits_used_compute": "CAST(0 AS DOUBLE)",
             "credits_used_cloud_services": "cs", "credits_used": "cs"},
            where="event_type = 'signup'"),
    AggRole("ev", {"hour": "hour", "event_type": "event_type"},
            {"compute": "CAST(count(*) AS DOUBLE) / 50"},
            {"service_type": ("CASE event_type WHEN 'view' THEN 'AUTO_CLUSTERING' WHEN 'click' THEN 'PIPE' "
                              "WHEN 'purchase' THEN 'MATERIALIZED_VIEW' WHEN 'error' THEN 'SEARCH_OPTIMIZATION' "
                              "ELSE 'SERVERLESS_TASK' END"),
             "start_time": "hour", "end_time": "hour + INTERVAL 1 HOUR",
             "entity_id": "CAST(0 AS BIGINT)", "name": "'SERVICE'",
             "credits_used_compute": "compute", "credits_used_cloud_services": "CAST(0 AS DOUBLE)",
             "credits_used": "compute"}),
]

WAREHOUSE_METERING = {
    "start_time": "start_time", "end_time": "end_time", "warehouse_id": "entity_id",
    "warehouse_name": "name", "credits_used": "credits_used",
    "credits_used_compute": "credits_used_compute",
    "credits_used_cloud_services": "credits_used_cloud_services",
}

METERING_DAILY = AggRole(
    "metering_history",
    {"usage_date": "CAST(start_time AS DATE)", "service_type": "service_type"},
    {"cs": "sum(credits_used_cloud_services)", "compute": "sum(credits_used_compute)"},
    {"usage_date": "usage_date", "service_type": "service_type",
     "credits_used_cloud_services": "cs",
     "credits_adjustment_cloud_services": "-least(cs, compute * 0.1)"})

SERVERLESS_TASKS = {
    "start_time": "start_ts", "end_time": "end_ts", "task_id": "user_id",
    "task_name": f"'task_' || {_U}", "schema_id": "CAST(1 AS BIGINT)",
    "schema_name": "'PUBLIC'", "database_id": "CAST(floor(k / 25) AS BIGINT)",
    "database_name": "'DB_' || CAST(CAST(floor(k / 25) AS BIGINT) AS STRING)",
    "credits_used": "value / 100",
}

# daily credits per rate-sheet usage type (source of the rate sheet)
_PRICE_VALUES = ", ".join(f"('{m}', '{u}', '{s}', {r!r})" for m, u, s, r in PRICE_LIST)
DAILY_USAGE = AggRole(
    "metering_history",
    {"day": "CAST(start_time AS DATE)", "metered": "service_type"},
    {"n": "count(*)"},
    {"day": "day", "metered": "metered", "n": "n"})

DATABASE_STORAGE = AggRole(
    "ev", {"usage_date": "day", "event_type": "event_type"},
    {"v": "sum(value)"},
    {"usage_date": "usage_date", "database_name": "'DB_' || upper(event_type)",
     "average_database_bytes": "v * 1.073741824E9",
     "average_failsafe_bytes": "v * 1.34217728E8",
     "average_hybrid_table_storage_bytes": "CASE WHEN event_type = 'purchase' THEN v * 6.7108864E7 ELSE 0.0E0 END"})
STAGE_STORAGE = AggRole(
    "ev", {"usage_date": "day"}, {"n": "count(*)"},
    {"usage_date": "usage_date", "average_stage_bytes": "CAST(n AS DOUBLE) * 3.3554432E7"})
STORAGE_USAGE = AggRole(
    "ev", {"usage_date": "day"}, {"v": "sum(value)", "n": "count(*)"},
    {"usage_date": "usage_date", "storage_bytes": "v * 1.073741824E9 * 1.25",
     "stage_bytes": "CAST(n AS DOUBLE) * 3.3554432E7",
     "failsafe_bytes": "v * 1.34217728E8 * 0.9",
     "hybrid_table_storage_bytes": "0.0E0", "archive_storage_cool_bytes": "0.0E0",
     "archive_storage_cold_bytes": "0.0E0", "archive_storage_retrieval_temp_bytes": "0.0E0"})

_UIC_TYPE = ("CASE event_type WHEN 'view' THEN CASE WHEN k >= 50 THEN 'overage-data transfer' "
             "ELSE 'data transfer' END WHEN 'click' THEN 'logging' WHEN 'purchase' THEN 'reader compute' "
             "WHEN 'error' THEN 'reader cloud services' ELSE 'reader adj for incl cloud services' END")
_UIC_USAGE = "CASE WHEN event_type = 'signup' THEN -value / 10000 ELSE value / 1000 END"
USAGE_IN_CURRENCY = AggRole(
    "ev", {"usage_date": "day", "usage_type": _UIC_TYPE},
    {"usage": f"sum({_UIC_USAGE})",
     "usage_in_currency": f"sum({_UIC_USAGE} * CASE WHEN event_type = 'view' AND k >= 50 THEN 3.5E0 ELSE 3.0E0 END)"},
    {"organization_name": "'ORG1'", "contract_number": "'C-100'", "account_name": f"'{ACCOUNT}'",
     "account_locator": "'AB12345'", "region": "'AWS_US_EAST_1'", "service_level": "'ENTERPRISE'",
     "usage_date": "usage_date", "usage_type": "usage_type", "currency": "'USD'",
     "usage": "usage", "usage_in_currency": "usage_in_currency", "balance_source": "'capacity'",
     "billing_type": "'consumption'", "rating_type": "'compute'",
     "service_type": "upper(replace(usage_type, ' ', '_'))", "is_adjustment": "false"})


# ---------------------------------------------------------------------------
# Rendering: Spark
# ---------------------------------------------------------------------------
def _select(df: DataFrame, cols: dict[str, str]) -> DataFrame:
    return df.select(*[F.expr(e).alias(n) for n, e in cols.items()])


def _agg(df: DataFrame, role: AggRole) -> DataFrame:
    if role.where:
        df = df.where(F.expr(role.where))
    g = df.groupBy(*[F.expr(e).alias(n) for n, e in role.group.items()])
    out = g.agg(*[F.expr(e).alias(n) for n, e in role.aggs.items()])
    return _select(out, role.post)


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Columns of ``schema`` in order and type; missing ones are typed nulls."""
    have = set(df.columns)
    return df.select(*[(F.col(f.name) if f.name in have else F.lit(None)).cast(f.dataType).alias(f.name)
                       for f in schema.fields])


class Testbed:
    """Lazily derived source roles for one test-data directory."""

    def __init__(self, spark: SparkSession, sf_dir: str, account: str = ACCOUNT):
        self.spark, self.sf_dir, self.account = spark, sf_dir, account
        self._cache: dict[str, DataFrame] = {}

    def table(self, name: str) -> DataFrame:
        """A test table, read as it is."""
        if name not in self._cache:
            self._cache[name] = self.spark.read.parquet(f"{self.sf_dir}/{name}.parquet")
        return self._cache[name]

    # derived roles that are aggregates: written once per binding (they are tables in
    # the reference's world) so that plans reusing them stay small
    MATERIALIZED = ("metering_history", "metering_daily_history", "rate_sheet_daily",
                    "remaining_balance_daily", "database_storage_usage_history",
                    "stage_storage_usage_history", "storage_usage", "usage_in_currency_daily")

    def _memo(self, name, build):
        if name not in self._cache:
            df = build()
            if name in self.MATERIALIZED:
                from ledgerlight.session import materialize
                df = materialize(df, name)
            self._cache[name] = df
        return self._cache[name]

    def ev(self) -> DataFrame:
        return self._memo("ev", lambda: self.table("events").select(
            "*", *[F.expr(e).alias(n) for n, e in EV_SPARK.items()]))

    def query_history(self) -> DataFrame:
        return self._memo("query_history", lambda: conform(
            _select(self.ev(), QUERY_HISTORY), SOURCES["query_history"]))

    def metering_history(self) -> DataFrame:
        def build():
            legs = [_agg(self.ev(), leg) for leg in METERING_LEGS]
            out = legs[0]
            for leg in legs[1:]:
                out = out.unionByName(leg)
            return conform(out, SOURCES["metering_history"])
        return self._memo("metering_history", build)

    def warehouse_metering_history(self) -> DataFrame:
        return self._memo("warehouse_metering_history", lambda: conform(
            _select(self.metering_history().where("service_type = 'WAREHOUSE_METERING'"),
                    WAREHOUSE_METERING), SOURCES["warehouse_metering_history"]))

    def metering_daily_history(self) -> DataFrame:
        return self._memo("metering_daily_history", lambda: conform(
            _agg(self.metering_history(), METERING_DAILY), SOURCES["metering_daily_history"]))

    def serverless_task_history(self) -> DataFrame:
        return self._memo("serverless_task_history", lambda: conform(
            _select(self.ev().where("event_type = 'signup'"), SERVERLESS_TASKS),
            SOURCES["serverless_task_history"]))

    def database_storage_usage_history(self) -> DataFrame:
        return self._memo("database_storage_usage_history", lambda: conform(
            _agg(self.ev(), DATABASE_STORAGE), SOURCES["database_storage_usage_history"]))

    def stage_storage_usage_history(self) -> DataFrame:
        return self._memo("stage_storage_usage_history", lambda: conform(
            _agg(self.ev(), STAGE_STORAGE), SOURCES["stage_storage_usage_history"]))

    def storage_usage(self) -> DataFrame:
        return self._memo("storage_usage", lambda: conform(
            _agg(self.ev(), STORAGE_USAGE), SOURCES["storage_usage"]))

    def usage_in_currency_daily(self) -> DataFrame:
        return self._memo("usage_in_currency_daily", lambda: conform(
            _agg(self.ev(), USAGE_IN_CURRENCY), SOURCES["usage_in_currency_daily"]))

    def rate_sheet_daily(self) -> DataFrame:
        def build():
            prices = self.spark.createDataFrame(
                PRICE_LIST, "metered string, usage_type string, rate_service string, base double")
            daily = _agg(self.metering_history(), DAILY_USAGE)
            # cloud services are metered on warehouse rows, priced under their own type
            daily = daily.unionByName(
                daily.where("metered = 'WAREHOUSE_METERING'")
                .select("day", F.lit("CLOUD_SERVICES").alias("metered"), "n"))
            storage = (self.database_storage_usage_history().groupBy(F.col("usage_date").alias("day"))
                       .agg(F.count(F.lit(1)).alias("n")))
            daily = daily.unionByName(storage.select("day", F.lit("STORAGE").alias("metered"), "n"))
            daily = daily.unionByName(storage.select("day", F.lit("HYBRID_TABLE_STORAGE").alias("metered"), "n"))
            # published on the days a type has at least its mean number of metering rows
            # (integer counts: exact in any summation order, so both engines agree)
            means = daily.groupBy("metered").agg(F.avg("n").alias("mean_n"))
            published = daily.join(means, "metered").where("n >= mean_n")
            rows = published.join(F.broadcast(prices), "metered").select(
                F.col("day").alias("date"), "usage_type",
                F.expr("base * (1 + dayofmonth(day) / 100)").alias("effective_rate"),
                F.col("rate_service").alias("service_type"))
            mine = rows.select("*", F.lit(self.account).alias("account_name"))
            other = rows.select("date", "usage_type", (F.col("effective_rate") * 3).alias("effective_rate"),
                                "service_type", F.lit(OTHER_ACCOUNT).alias("account_name"))
            out = mine.unionByName(other).select(
                "*", F.lit("ORG1").alias("organization_name"), F.lit("C-100").alias("contract_number"),
                F.lit("AB12345").alias("account_locator"), F.lit("AWS_US_EAST_1").alias("region"),
                F.lit("ENTERPRISE").alias("service_level"), F.lit("USD").alias("currency"))
            return conform(out, SOURCES["rate_sheet_daily"])
        return self._memo("rate_sheet_daily", build)

    def remaining_balance_daily(self) -> DataFrame:
        def build():
            daily = self.ev().groupBy(F.col("day").alias("date")).agg(F.sum("value").alias("v"))
            mean = daily.agg(F.avg("v")).scalar()
            rows = daily.select("date", F.lit("C-100").alias("contract_number"),
                                (mean - F.col("v")).alias("capacity_balance"))
            first_day = daily.agg(F.min("date")).scalar()
            extra = daily.where(F.col("date") == first_day).select(
                "date", F.lit(None).cast("string").alias("contract_number"),
                F.lit(1.0e9).alias("capacity_balance"))
            out = rows.unionByName(extra).select(
                "*", F.lit("ORG1").alias("organization_name"), F.lit("USD").alias("currency"),
                F.lit(0.0).alias("free_usage_balance"), F.lit(0.0).alias("on_demand_consumption_balance"),
                F.lit(0.0).alias("rollover_balance"))
            return conform(out, SOURCES["remaining_balance_daily"])
        return self._memo("remaining_balance_daily", build)

    def access_history(self) -> DataFrame:
        """One access record per line item (query = order + line number). The object
        arrays are built per row, so their size is fixed (no per-key collection); the
        supplier object appears twice with different columns and the base supplier
        object has no column list. Not written: a reader joins the columns that it needs, in
        as many tasks as the line items' files ask for, so that what a task holds of the nested
        rows does not grow with the log."""
        def build():
            n = max(default_parallelism(self.spark),
                    -(-path_bytes(self.spark, f"{self.sf_dir}/lineitem.parquet") // LOG_TASK_BYTES))
            li = self.table("lineitem").repartition(n, "l_orderkey")
            od = self.table("orders").select("o_orderkey", "o_orderdate", "o_custkey").repartition(n, "o_orderkey")
            supplier_id = F.expr("CASE WHEN l_returnflag = 'R' THEN NULL ELSE l_suppkey END")
            supplier_name = F.expr("'SUPPLIER_' || CAST(l_suppkey AS STRING)")
            supplier_domain = F.expr("CASE WHEN l_linestatus = 'O' THEN 'Table' ELSE 'View' END")
            col = lambda e: F.struct(F.expr(e).alias("columnName"))
            direct = F.array(
                F.struct(supplier_id.alias("objectId"), supplier_name.alias("objectName"),
                         supplier_domain.alias("objectDomain"),
                         F.array(col("'l_quantity'"), col("CASE WHEN l_discount > 0.05 THEN 'l_discount' END"),
                                 col("'line_' || CAST(l_linenumber AS STRING)")).alias("columns")),
                F.struct(supplier_id.alias("objectId"), supplier_name.alias("objectName"),
                         supplier_domain.alias("objectDomain"),
                         F.array(col("'l_quantity'"), col("'l_shipdate'")).alias("columns")))
            part_cols = F.when(F.col("l_quantity") < 5, F.array().cast("array<struct<columnName:string>>")) \
                .otherwise(F.array(col("'l_extendedprice'"), col("'l_shipdate'")))
            base = F.array(
                F.struct(F.col("l_partkey").alias("objectId"),
                         F.expr("CASE WHEN l_tax > 0.07 THEN NULL ELSE 'PART_' || CAST(l_partkey AS STRING) END")
                         .alias("objectName"),
                         F.lit("Table").alias("objectDomain"), part_cols.alias("columns")),
                F.struct(F.col("l_suppkey").alias("objectId"), supplier_name.alias("objectName"),
                         F.lit("Table").alias("objectDomain"),
                         F.lit(None).cast("array<struct<columnName:string>>").alias("columns")))
            out = li.join(od, li.l_orderkey == od.o_orderkey).select(
                F.expr("CAST(l_orderkey AS STRING) || '-' || CAST(l_linenumber AS STRING)").alias("query_id"),
                F.col("o_orderdate").cast("timestamp").alias("query_start_time"),
                F.expr("'cust_' || CAST(o_custkey AS STRING)").alias("user_name"),
                direct.alias("direct_objects_accessed"), base.alias("base_objects_accessed"))
            return conform(out, SOURCES["access_history"])
        return self._memo("access_history", build)

    def sources(self) -> dict[str, DataFrame]:
        return {n: getattr(self, n)() for n in SOURCES}

    def sources_lazy(self) -> "_LazySources":
        """Mapping that derives a role only when a plan asks for it."""
        return _LazySources(self)


class _LazySources(dict):
    def __init__(self, tb: Testbed):
        super().__init__()
        self.tb = tb

    def __missing__(self, name: str) -> DataFrame:
        if name not in SOURCES:
            raise KeyError(name)
        df = getattr(self.tb, name)()
        self[name] = df
        return df


# ---------------------------------------------------------------------------
# Rendering: DuckDB (oracle side)
# ---------------------------------------------------------------------------
def _duck_select(cols: dict[str, str]) -> str:
    return ",\n  ".join(f"{e} AS {n}" for n, e in cols.items())


def _duck_agg(role: AggRole, src: str | None = None) -> str:
    src = src or role.src
    where = f" WHERE {role.where}" if role.where else ""
    inner_sel = ", ".join([f"{e} AS {n}" for n, e in role.group.items()] +
                          [f"{e} AS {n}" for n, e in role.aggs.items()])
    group = ", ".join(role.group.values())
    return f"SELECT {_duck_select(role.post)} FROM (SELECT {inner_sel} FROM {src}{where} GROUP BY {group}) AS g"


def _duck_conform(body: str, schema: T.StructType, alias: str = "c") -> str:
    cols = []
    for f in schema.fields:
        cols.append(f"CAST({f.name} AS {_sql_type(f.dataType)}) AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM ({body}) AS {alias}"


def _duck_conform_partial(body: str, schema: T.StructType, present: set[str]) -> str:
    cols = []
    for f in schema.fields:
        src = f.name if f.name in present else "NULL"
        cols.append(f"CAST({src} AS {_sql_type(f.dataType)}) AS {f.name}")
    return f"SELECT {', '.join(cols)} FROM ({body}) AS c"


def duck_ctes(account: str = ACCOUNT) -> str:
    """``WITH`` clause defining every source role as a DuckDB view over the tables."""
    ev = f"SELECT *, {_duck_select(EV_DUCK)} FROM events"
    qh = _duck_conform_partial(f"SELECT {_duck_select(QUERY_HISTORY)} FROM ev",
                               SOURCES["query_history"], set(QUERY_HISTORY))
    mh = _duck_conform(" UNION ALL ".join(f"SELECT * FROM ({_duck_agg(leg)})" for leg in METERING_LEGS),
                       SOURCES["metering_history"])
    wmh = _duck_conform(f"SELECT {_duck_select(WAREHOUSE_METERING)} FROM metering_history "
                        f"WHERE service_type = 'WAREHOUSE_METERING'", SOURCES["warehouse_metering_history"])
    mdh = _duck_conform(_duck_agg(METERING_DAILY), SOURCES["metering_daily_history"])
    sth = _duck_conform(f"SELECT {_duck_select(SERVERLESS_TASKS)} FROM ev WHERE event_type = 'signup'",
                        SOURCES["serverless_task_history"])
    dsuh = _duck_conform(_duck_agg(DATABASE_STORAGE), SOURCES["database_storage_usage_history"])
    ssuh = _duck_conform(_duck_agg(STAGE_STORAGE), SOURCES["stage_storage_usage_history"])
    su = _duck_conform(_duck_agg(STORAGE_USAGE), SOURCES["storage_usage"])
    uicd = _duck_conform(_duck_agg(USAGE_IN_CURRENCY), SOURCES["usage_in_currency_daily"])
    rsd = f"""
      WITH prices(metered, usage_type, rate_service, base) AS (VALUES {_PRICE_VALUES}),
      d0 AS ({_duck_agg(DAILY_USAGE)}),
      st AS (SELECT usage_date AS day, count(*) AS n FROM database_storage_usage_history GROUP BY usage_date),
      daily AS (
        SELECT day, metered, n FROM d0
        UNION ALL SELECT day, 'CLOUD_SERVICES', n FROM d0 WHERE metered = 'WAREHOUSE_METERING'
        UNION ALL SELECT day, 'STORAGE', n FROM st
        UNION ALL SELECT day, 'HYBRID_TABLE_STORAGE', n FROM st),
      means AS (SELECT metered, avg(n) AS mean_n FROM daily GROUP BY metered),
      rows_ AS (
        SELECT d.day AS date, p.usage_type, p.base * (1 + dayofmonth(d.day) / 100) AS effective_rate,
               p.rate_service AS service_type
        FROM daily d JOIN means m ON d.metered = m.metered JOIN prices p ON d.metered = p.metered
        WHERE d.n >= m.mean_n)
      SELECT CAST(date AS DATE) AS date, 'ORG1' AS organization_name, 'C-100' AS contract_number,
             account_name, 'AB12345' AS account_locator, 'AWS_US_EAST_1' AS region,
             'ENTERPRISE' AS service_level, usage_type, 'USD' AS currency,
             CAST(effective_rate AS DOUBLE) AS effective_rate, service_type
      FROM (SELECT *, '{account}' AS account_name FROM rows_
            UNION ALL SELECT date, usage_type, effective_rate * 3, service_type, '{OTHER_ACCOUNT}' FROM rows_) AS u"""
    rbd = """
      WITH daily AS (SELECT day AS date, sum(value) AS v FROM ev GROUP BY day),
      m AS (SELECT avg(v) AS mean, min(date) AS first_day FROM daily)
      SELECT date, 'ORG1' AS organization_name, contract_number, 'USD' AS currency,
             0.0E0 AS free_usage_balance, capacity_balance, 0.0E0 AS on_demand_consumption_balance,
             0.0E0 AS rollover_balance
      FROM (SELECT date, 'C-100' AS contract_number, (SELECT mean FROM m) - v AS capacity_balance FROM daily
            UNION ALL
            SELECT date, CAST(NULL AS VARCHAR), 1.0E9 FROM daily WHERE date = (SELECT first_day FROM m)) AS u"""
    return f"""WITH
ev AS ({ev}),
query_history AS ({qh}),
metering_history AS ({mh}),
warehouse_metering_history AS ({wmh}),
metering_daily_history AS ({mdh}),
serverless_task_history AS ({sth}),
database_storage_usage_history AS ({dsuh}),
stage_storage_usage_history AS ({ssuh}),
storage_usage AS ({su}),
usage_in_currency_daily AS ({uicd}),
rate_sheet_daily AS ({rsd}),
remaining_balance_daily AS ({rbd})
"""
