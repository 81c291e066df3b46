"""Text and JSON-metadata helpers for the query log (all JVM built-ins, no UDFs)."""
from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

# ---------------------------------------------------------------------------
# Fixed values (must equal the reference's behaviour for equal results)
# ---------------------------------------------------------------------------
# Comment stripping: a block comment /* ... */ (may span lines), a line comment
# "--" up to and including the next newline or the end of the text, and ";".
# ``[\s\S]*?`` replaces ``(.|\n|\r)*?``: same language, no deep regex recursion on
# long comments.
COMMENT_PATTERN = r"/\*[\s\S]*?\*/|--[^\n]*(?:\n|\z)|;"
# The first JSON block comment that names the dbt app; its body may not contain "*".
DBT_COMMENT_PATTERN = r'(?i)/\*\s*(\{[^*]*?"app":\s*"dbt"[^*]*\})\s*\*/'
# Keys that mark a query tag as dbt metadata (either spelling).
TAG_MARKER_KEYS = ("dbt_snowflake_query_tags_version", "dbt_query_tags_version")
# Nested JSON values stay JSON text inside the map.
METADATA_TYPE = "map<string,string>"


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def strip_comments(text) -> Column:
    return F.regexp_replace(_c(text), F.lit(COMMENT_PATTERN), F.lit(""))


def parse_object(text) -> Column:
    """Safe JSON-object parse: null for bad JSON or a non-object."""
    return F.from_json(_c(text), METADATA_TYPE)


def comment_metadata(text) -> Column:
    """Metadata from the first ``/* {... "app": "dbt" ...} */`` comment, or null."""
    found = F.regexp_extract(_c(text), DBT_COMMENT_PATTERN, 1)
    return parse_object(F.nullif(found, F.lit("")))


def tag_metadata(tag, markers=TAG_MARKER_KEYS) -> Column:
    """The parsed query tag, only when one of the marker keys is present."""
    m = parse_object(tag)
    has_marker = None
    for k in markers:
        cond = m.getItem(k).isNotNull()
        has_marker = cond if has_marker is None else (has_marker | cond)
    return F.when(has_marker, m)


def _empty_map() -> Column:
    return F.expr(f"cast(map() as {METADATA_TYPE})")


def merge_maps(left, right) -> Column:
    """Union of two maps, the right side winning on a shared key; null if both null.

    Written without relying on ``spark.sql.mapKeyDedupPolicy``: the left map is
    filtered to keys absent on the right before concatenation.
    """
    lm, rm = _c(left), _c(right)
    lz, rz = F.coalesce(lm, _empty_map()), F.coalesce(rm, _empty_map())
    right_keys = F.map_keys(rz)
    kept = F.map_filter(lz, lambda k, v: ~F.array_contains(right_keys, k))
    return F.when(lm.isNotNull() | rm.isNotNull(), F.map_concat(kept, rz))


def last_dot_part(identifier) -> Column:
    """Last ``.``-separated part of an id with double quotes removed."""
    return F.replace(F.element_at(F.split(_c(identifier), r"[.]"), -1), F.lit('"'), F.lit(""))


def map_as_text(m) -> Column:
    """Canonical text of a map (sorted ``key=value`` pairs) for comparisons."""
    entries = F.transform(F.map_entries(_c(m)),
                          lambda e: F.concat(e["key"], F.lit("="), F.coalesce(e["value"], F.lit("null"))))
    return F.array_join(F.array_sort(entries), "|")
