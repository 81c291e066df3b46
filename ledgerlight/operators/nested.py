"""Nested access logs: flatten, re-group, keys."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def explode_objects(df: DataFrame, array_col: str, keep: list[str],
                    fields: dict[str, tuple[str, str]], alias: str = "_obj") -> DataFrame:
    """One row per array element (rows with a null or empty array drop out, like a
    lateral flatten). ``fields``: ``{out_col: (element_field, type)}``; casts are
    ``try_cast`` so a malformed value becomes null instead of failing the job."""
    exploded = df.select(*keep, F.explode(array_col).alias(alias))
    return exploded.select(*keep, *[
        (F.col(f"{alias}.{f}").try_cast(t) if t else F.col(f"{alias}.{f}")).alias(o)
        for o, (f, t) in fields.items()])


def collect_fields(df: DataFrame, keys: list[str], array_col: str, field: str,
                   out: str) -> DataFrame:
    """Flatten an array of structs and collect the distinct non-null ``field`` values
    per key, sorted (deterministic ``array_agg(distinct ...)``). ``collect_set`` merges
    map-side, so a hot key ships one partial set per task, not its rows."""
    flat = df.select(*keys, F.explode(array_col).alias("_el"))
    return (flat.groupBy(*keys)
            .agg(F.array_sort(F.collect_set(F.col(f"_el.{field}").cast("string"))).alias(out)))


def field_values(array_col: str, field: str) -> Column:
    """The distinct non-null values of a field of an array of structs, sorted, inside the row."""
    values = F.transform(F.col(array_col), lambda x: x[field].cast("string"))
    return F.array_sort(F.array_distinct(F.array_compact(values)))


def merged(arrays: Column) -> Column:
    """One sorted array of the distinct elements of an array of arrays."""
    return F.array_sort(F.array_distinct(F.flatten(arrays)))


def explode_variant(df: DataFrame, json_col: str, keep: list[str], fields: dict[str, tuple[str, str]]) -> DataFrame:
    """One row per element of an array given as JSON text, read through VARIANT: no schema is
    fixed, so elements may differ in their fields and a field may change its type. ``fields``:
    ``{out_col: (path, type)}``; a missing field or one that can't be cast is null. Text that is no
    JSON, or no array, gives no rows."""
    parsed = df.select(*keep, F.try_variant_get(F.try_parse_json(F.col(json_col)), "$", "array<variant>").alias("_all"))
    exploded = parsed.select(*keep, F.explode("_all").alias("_el"))
    return exploded.select(*keep, *[F.try_variant_get("_el", path, kind).alias(o) for o, (path, kind) in fields.items()])


def row_key(*cols) -> Column:
    """``md5(concat(...))`` with no separator; null when any part is null."""
    return F.md5(F.concat(*[c if isinstance(c, Column) else F.col(c) for c in cols]))
