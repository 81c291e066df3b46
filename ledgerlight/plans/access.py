"""Object and table access from nested access logs.

One generator (the objects) and one exchange: an object's column names stay an array in the row,
and one aggregate merges the distinct arrays of a (query, object). ``collect_set`` merges
map-side, so a query touching one object many times ships partial sets, not rows. The direct
variant picks the winner of a row key inside the same aggregate.
"""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.operators.nested import explode_objects, field_values, merged, row_key

KEEP = ["query_id", "query_start_time", "user_name"]
OBJECT_FIELDS = {"table_id": ("objectId", "bigint"), "object_name": ("objectName", "string"),
                 "object_domain": ("objectDomain", "string"), "columns_array": ("columns", None)}
GROUP = ["query_id", "query_start_time", "user_name", "table_id", "object_name", "object_domain"]
TABLE_DOMAIN = "Table"  # fixed value: the domain of plain tables (others are views)


def object_access(access: DataFrame, array_col: str, dedup: bool) -> DataFrame:
    """One row per query and accessed object with the sorted distinct columns used.

    ``dedup`` keeps one row per (row key, start time), the first by table id, domain, user, query
    and object name, so the winner is deterministic (the direct variant)."""
    flat = explode_objects(access, array_col, KEEP, OBJECT_FIELDS)
    # an object without columns gives no row
    flat = flat.where(F.col("object_name").isNotNull() & (F.size("columns_array") > 0)).select(
        *GROUP, field_values("columns_array", "columnName").alias("cols"))
    if not dedup:
        out = flat.groupBy(*GROUP).agg(merged(F.collect_set("cols")).alias("columns_accessed"))
        return out.select(row_key("query_id", "object_name").alias("_unique_id"), *GROUP, "columns_accessed")
    order = ["table_id", "object_domain", "user_name", "query_id", "object_name"]  # the first row stays
    seen = F.collect_set(F.struct(F.struct(*order).alias("row"), "cols"))
    grouped = flat.groupBy(F.concat("query_id", "object_name").alias("_key"), "query_start_time").agg(seen.alias("seen"))
    first = grouped.select("_key", "query_start_time", "seen", F.array_min(F.transform("seen", lambda x: x["row"])).alias("row"))
    cols = F.transform(F.filter("seen", lambda x: x["row"].eqNullSafe(F.col("row"))), lambda x: x["cols"])
    return first.select(F.md5("_key").alias("_unique_id"), *[
        F.col(c) if c == "query_start_time" else F.col("row")[c].alias(c) for c in GROUP], merged(cols).alias("columns_accessed"))


def query_base_object_access(access: DataFrame) -> DataFrame:
    return object_access(access, "base_objects_accessed", dedup=False)


def query_direct_object_access(access: DataFrame) -> DataFrame:
    return object_access(access, "direct_objects_accessed", dedup=True)


def table_access(objects: DataFrame) -> DataFrame:
    """Tables only: secured views (other domains) and shared tables (no id) removed."""
    return objects.where((F.col("object_domain") == TABLE_DOMAIN) & F.col("table_id").isNotNull()).select(
        "_unique_id", "query_id", "query_start_time", "user_name",
        F.col("object_name").alias("full_table_name"), "table_id", "columns_accessed")
