"""Source scans (A1, A10): named sources with a configurable location, read with an
explicit schema so that types never depend on inference."""
from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from ledgerlight.schemas import SOURCES

ACCOUNT_USAGE = ("query_history", "metering_history", "warehouse_metering_history",
                 "metering_daily_history", "serverless_task_history", "access_history",
                 "database_storage_usage_history", "stage_storage_usage_history",
                 "storage_usage")
ORGANIZATION_USAGE = ("rate_sheet_daily", "remaining_balance_daily", "usage_in_currency_daily")


@dataclass
class SourceConfig:
    """Where each source lives: catalog tables ``{database}.{schema}.{table}`` or
    files ``{root}/{table}`` (parquet by default). The two source schemas are separate
    parameters."""
    account_usage_database: str | None = None
    account_usage_schema: str | None = None
    organization_usage_database: str | None = None
    organization_usage_schema: str | None = None
    root: str | None = None
    fmt: str = "parquet"

    def location(self, table: str) -> tuple[str, str]:
        if self.root:
            return "path", f"{self.root.rstrip('/')}/{table}"
        if table in ORGANIZATION_USAGE:
            parts = [self.organization_usage_database, self.organization_usage_schema, table]
        else:
            parts = [self.account_usage_database, self.account_usage_schema, table]
        return "table", ".".join(p for p in parts if p)


def table_exists(spark: SparkSession, cfg: SourceConfig, table: str) -> bool:
    kind, where = cfg.location(table)
    if kind == "table":
        return spark.catalog.tableExists(where)
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(where)
    fs = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    return fs.exists(path)


def read_source(spark: SparkSession, cfg: SourceConfig, table: str) -> DataFrame:
    kind, where = cfg.location(table)
    if kind == "table":
        return spark.table(where)
    return (spark.read.schema(SOURCES[table]).option("mergeSchema", "true")
            .format(cfg.fmt).load(where))


def read_sources(spark: SparkSession, cfg: SourceConfig) -> Mapping[str, DataFrame]:
    return {t: read_source(spark, cfg, t) for t in SOURCES}
