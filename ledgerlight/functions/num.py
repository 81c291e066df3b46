"""Numeric helpers with the source dialect's null and zero rules."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

BYTES_PER_GB = float(1024 ** 3)
BYTES_PER_TB = float(1024 ** 4)


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def div0(a, b) -> Column:
    """a / b, but 0 when b is 0; null when b is null (no ANSI divide-by-zero error)."""
    a, b = _c(a), _c(b)
    return F.when(b == 0, F.lit(0.0)).otherwise(a / b)


def greatest_strict(*cols) -> Column:
    """``greatest`` that is null when any input is null (Spark's skips nulls)."""
    cs = [_c(c) for c in cols]
    any_null = reduce(lambda x, y: x | y, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.greatest(*cs))


def least_strict(*cols) -> Column:
    cs = [_c(c) for c in cols]
    any_null = reduce(lambda x, y: x | y, [c.isNull() for c in cs])
    return F.when(any_null, F.lit(None)).otherwise(F.least(*cs))


def trunc_to(x, digits: int) -> Column:
    """Truncate toward zero to ``digits`` decimals (``trunc(x, n)``)."""
    x = _c(x)
    scale = float(10 ** digits)
    return F.signum(x) * F.floor(F.abs(x) * scale) / scale


def to_units(df: DataFrame, spec: dict[str, tuple[str, float]]) -> DataFrame:
    """Add converted columns: ``{source_col: (new_col, divisor)}``, e.g. bytes -> GB."""
    return df.withColumns({new: F.col(src) / F.lit(float(factor))
                           for src, (new, factor) in spec.items()})
