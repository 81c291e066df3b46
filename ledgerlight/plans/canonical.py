"""Canonical form of a result for engine-to-engine comparison: doubles rounded (and
-0.0 folded to 0.0), timestamps without zone, arrays and maps as sorted text."""
from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.functions.text import map_as_text

DIGITS = 9


def canonical(df: DataFrame, digits: int = DIGITS) -> DataFrame:
    cols = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        t = f.dataType
        if isinstance(t, (T.DoubleType, T.FloatType)):
            c = F.round(c, digits) + F.lit(0.0)
        elif isinstance(t, T.TimestampType):
            c = c.cast("timestamp_ntz")
        elif isinstance(t, T.ArrayType):
            c = F.array_join(F.transform(c, lambda x: x.cast("string")), "|")
        elif isinstance(t, T.MapType):
            c = map_as_text(c)
        cols.append(c.alias(f.name))
    return df.select(*cols)


def sql_canonical(body: str, double_cols: list[str], digits: int = DIGITS) -> str:
    """DuckDB wrapper rounding the given double columns like ``canonical``."""
    if not double_cols:
        return body
    repl = ", ".join(f"round({c}, {digits}) + 0.0 AS {c}" for c in double_cols)
    return f"SELECT * REPLACE ({repl}) FROM (\n{body}\n) AS q"
