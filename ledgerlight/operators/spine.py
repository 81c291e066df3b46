"""Time grids and interval slicing.

Range joins against a generated grid are replaced by ``explode(sequence(...))`` per
row: no nested-loop join, no grid to broadcast, and the work grows linearly with the
number of slices.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

def _one_hour() -> Column:
    return F.expr("INTERVAL 1 HOUR")


def _one_micro() -> Column:
    return F.expr("INTERVAL 0.000001 SECOND")


def _c(x) -> Column:
    return x if isinstance(x, Column) else F.col(x)


def hour_spine(fact: DataFrame, ts: str, fallback_start: str = "2023-01-01 00:00:00",
               out: str = "hour") -> DataFrame:
    """Every hour from the first ``ts`` to the last (inclusive); one fallback hour when
    the fact is empty. Built from a one-row aggregate, so only the grid is generated."""
    fb = F.lit(fallback_start).cast("timestamp")
    bounds = fact.agg(F.coalesce(F.min(ts).cast("timestamp"), fb).alias("_lo"),
                      F.coalesce(F.max(ts).cast("timestamp"), fb).alias("_hi"))
    return bounds.select(F.explode(F.sequence("_lo", "_hi", _one_hour())).alias(out))


def day_spine(bounds: DataFrame, start: str, end: str, out: str = "date") -> DataFrame:
    """Every date in [start, end] for each row of ``bounds`` (other columns kept)."""
    keep = [c for c in bounds.columns if c not in (start, end)]
    return (bounds.where(F.col(start) <= F.col(end))
            .select(*keep, F.explode(F.sequence(F.col(start), F.col(end))).alias(out)))


def with_day_stats(hours: DataFrame, hour: str = "hour") -> DataFrame:
    """Adds ``date``, ``hours_thus_far`` (grid hours on that date) and ``days_in_month``.

    The per-date window holds at most 24 rows."""
    return (hours.withColumn("date", F.to_date(hour))
            .withColumn("hours_thus_far", F.count(hour).over(Window.partitionBy("date")))
            .withColumn("days_in_month", F.dayofmonth(F.last_day("date"))))


def slice_intervals(df: DataFrame, end: str, anchor: str, slice_col: str = "hour_start",
                    slice_end_col: str = "hour_end",
                    ms_col: str = "num_milliseconds_query_ran",
                    grid: tuple[Column, Column] | None = None,
                    clip: tuple[Column, Column] | None = None) -> DataFrame:
    """One row per clock hour an interval touches.

    Hours ``h`` with ``date_trunc('hour', anchor) <= h < end``; an interval whose
    truncated anchor is not before its end gets no slice (and a null anchor none).
    ``ms_col`` is the overlap in milliseconds, ``least(end, h+1h) - greatest(anchor, h)``,
    which is negative when the anchor lies after the end inside the same hour.
    ``grid`` optionally bounds the hours (the reference's fixed look-back grid).
    ``clip`` (first hour, last hour) bounds the generated sequence itself, so a row with
    a bogus start or end cannot emit more slices than the hours of interest.
    """
    a, e = F.col(anchor), F.col(end)
    first = F.date_trunc("hour", a)
    last = F.date_trunc("hour", e - _one_micro())
    out = df.where(e > first)
    if clip is not None:
        first, last = F.greatest(first, clip[0]), F.least(last, clip[1])
        out = out.where(first <= last)
    out = (out.withColumn(slice_col, F.explode(F.sequence(first, last, _one_hour())))
           .withColumn(slice_end_col, F.col(slice_col) + _one_hour()))
    if grid is not None:
        lo, hi = grid
        out = out.where(F.col(slice_col).between(lo, hi))
    return out.withColumn(
        ms_col,
        F.unix_millis(F.least(e, F.col(slice_end_col))) - F.unix_millis(F.greatest(a, F.col(slice_col))))


def spread_daily(hours: DataFrame, daily: DataFrame, daily_date: str,
                 amounts: dict[str, str]) -> DataFrame:
    """Spread daily amounts evenly over the grid hours of that day (K9):
    ``{out_col: daily_col}`` -> ``daily_col / hours_thus_far`` (0 when no daily row)."""
    joined = hours.join(daily, hours["date"] == daily[daily_date], "left")
    return joined.withColumns({o: F.coalesce(F.col(c) / F.col("hours_thus_far"), F.lit(0.0))
                               for o, c in amounts.items()})


def per_hour_of_month(amount) -> Column:
    """A monthly-priced quantity per hour (K10): ``amount / (days_in_month * 24)``."""
    from ledgerlight.functions.num import div0
    return div0(_c(amount), F.col("days_in_month") * 24)
