"""Statistics of a table's partitions, kept beside the data (``_stats.json``): for every date the
earliest start, the latest end and the number of rows.

They choose the partitions to read, exactly and however long a row runs: a row that ended after
a time can only be in a partition whose latest end is after it. There is one entry per
calendar date. A writer first saves bounds that hold before and after its write, then the
exact ones, so a job that fails between leaves statistics that keep too many partitions, never
too few.
"""
from __future__ import annotations

import datetime as dt
import json
from collections.abc import Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.session import hadoop

STATS_FILE = "_stats.json"
_EPOCH = dt.datetime(1970, 1, 1)


def micros(t: dt.datetime | dt.date) -> int:
    if not isinstance(t, dt.datetime):
        t = dt.datetime.combine(t, dt.time())
    return (t - _EPOCH) // dt.timedelta(microseconds=1)


def moment(us: int) -> dt.datetime:
    return _EPOCH + dt.timedelta(microseconds=us)


@dataclass(frozen=True)
class Span:
    start: int | None  # microseconds since the epoch
    end: int | None
    rows: int


Stats = dict[dt.date | None, Span]  # None: rows without a date


def compute(df: DataFrame, partition_col: str, start: str, end: str) -> Stats:
    """One row per partition date reaches the driver."""
    us = lambda c: F.unix_micros(F.col(c).cast("timestamp"))
    found = df.groupBy(partition_col).agg(F.min(us(start)).alias("s"), F.max(us(end)).alias("e"), F.count(F.lit(1)).alias("n"))
    return {r[partition_col]: Span(r.s, r.e, r.n) for r in found.collect()}


def load(spark: SparkSession, path: str) -> Stats | None:
    fs, p = hadoop(spark, f"{path}/{STATS_FILE}")
    if not fs.exists(p):
        return None
    stream = fs.open(p)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return {None if d == "" else dt.date.fromisoformat(d): Span(*x) for d, x in json.loads(text).items()}


def save(spark: SparkSession, path: str, stats: Stats) -> None:
    fs, p = hadoop(spark, f"{path}/{STATS_FILE}")
    text = json.dumps({"" if d is None else d.isoformat(): [s.start, s.end, s.rows] for d, s in stats.items()})
    out = fs.create(p, True)
    out.write(bytearray(text.encode()))
    out.close()


def wider(a: Stats, b: Stats) -> Stats:
    """Bounds that hold for either state of the table."""
    def both(f, x, y):
        known = [v for v in (x, y) if v is not None]
        return f(known) if known else None

    out = dict(a)
    for d, s in b.items():
        o = out.get(d)
        out[d] = s if o is None else Span(both(min, o.start, s.start), both(max, o.end, s.end), max(o.rows, s.rows))
    return out


def latest_end(stats: Stats) -> dt.datetime | None:
    ends = [s.end for s in stats.values() if s.end is not None]
    return moment(max(ends)) if ends else None


def ending_after(stats: Stats, since: dt.datetime) -> list[dt.date | None]:
    """The partitions that can hold a row that ended after ``since``."""
    return [d for d, s in stats.items() if s.end is not None and s.end > micros(since)]


def meeting(stats: Stats, days: Iterable[dt.date]) -> list[dt.date | None]:
    """The partitions that can hold a row that ran during one of ``days``."""
    edges = [(micros(d), micros(d) + 86_400_000_000) for d in set(days)]
    return [d for d, s in stats.items() if s.end is not None and s.start is not None
            and any(s.start < hi and s.end >= lo for lo, hi in edges)]


def earliest_start(stats: Stats, dates: Iterable[dt.date | None]) -> dt.datetime | None:
    starts = [stats[d].start for d in dates if stats[d].start is not None]
    return moment(min(starts)) if starts else None


def in_dates(partition_col: str, dates: Iterable[dt.date | None]) -> Column:
    """A static partition filter; as many dates as the calendar has."""
    dates = list(dates)
    known = sorted(d for d in dates if d is not None)
    c = F.col(partition_col)
    out = c.isin(known) if known else F.lit(False)
    return out | c.isNull() if None in dates else out
