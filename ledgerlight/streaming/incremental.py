"""Incremental maintenance of result tables.

No table format with MERGE is assumed. A table is a parquet folder partitioned by a
date column derived from the key; its schema (``_schema.json``) and the time span of every
partition (``_stats.json``) lie beside the data, so a read opens no file footers and a
look-back opens no partition that it doesn't need. A run:

1. takes the high watermark from the statistics and passes ``watermark - lookback`` as a
   literal;
2. builds the new rows for that window, once, into the shared checkpoint folder;
3. upserts them: only the date partitions the new rows touch are read back (a join on the
   partition column, which Spark turns into a dynamic partition filter of the scan), unioned
   with the new rows, reduced to the newest row per key, staged (lineage cut, survives
   executor loss) and written with dynamic partition overwrite, which replaces exactly
   those partitions. Partitions that lose all their rows are deleted, and so are staged tables.

Columns new in the source are added to the target (``unionByName`` with missing columns
allowed; older files read them as null).
"""
from __future__ import annotations

import datetime as dt
import json
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.operators.fill import first_per_key
from ledgerlight.session import STORED, checkpoint_dir, hadoop, remove_path
from ledgerlight.streaming import partition_stats

EPOCH = dt.datetime(1970, 1, 1)
SCHEMA_FILE = "_schema.json"


def path_exists(spark: SparkSession, path: str) -> bool:
    fs, p = hadoop(spark, path)
    return fs.exists(p)


def _save_schema(spark: SparkSession, path: str, schema: T.StructType) -> None:
    fs, p = hadoop(spark, f"{path}/{SCHEMA_FILE}")
    out = fs.create(p, True)
    out.write(bytearray(schema.json().encode()))
    out.close()


def read_target(spark: SparkSession, path: str) -> DataFrame:
    """The table, with the schema it was last written with."""
    fs, p = hadoop(spark, f"{path}/{SCHEMA_FILE}")
    if not fs.exists(p):
        return spark.read.parquet(path)
    stream = fs.open(p)
    text = spark.sparkContext._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
    stream.close()
    return spark.read.schema(T.StructType.fromJson(json.loads(text))).parquet(path)


def partition_dates(spark: SparkSession, path: str, partition_col: str) -> list[dt.date]:
    """Dates of the table's partitions, from the folder names: as many as days."""
    fs, p = hadoop(spark, path)
    names = [s.getPath().getName() for s in fs.listStatus(p)]
    lead = f"{partition_col}="
    return sorted(dt.date.fromisoformat(n[len(lead):]) for n in names
                  if n.startswith(lead) and not n.endswith("__HIVE_DEFAULT_PARTITION__"))


def watermark(target: DataFrame | None, ts: str, lookback_days: float = 0,
              default: dt.datetime = EPOCH) -> dt.datetime:
    """``max(ts) - lookback`` of the target, or ``default`` for a missing or empty one
    (L1, L6: an empty target starts from the epoch instead of never filling, S19)."""
    if target is None:
        return default
    hi = target.agg(F.max(ts)).first()[0]
    if hi is None:
        return default
    if isinstance(hi, dt.date) and not isinstance(hi, dt.datetime):
        hi = dt.datetime.combine(hi, dt.time())
    return hi - dt.timedelta(days=lookback_days)


def statistics(spark: SparkSession, path: str, partition_col: str, start: str, end: str) -> partition_stats.Stats:
    """The spans of a table's partitions; read from its rows once if they were never kept."""
    stats = partition_stats.load(spark, path)
    if stats is None:
        stats = partition_stats.compute(read_target(spark, path), partition_col, start, end)
        partition_stats.save(spark, path, stats)
    return stats


def evolve(old: DataFrame, new: DataFrame) -> DataFrame:
    """Union by name; columns missing on either side become null (L4)."""
    return old.unionByName(new, allowMissingColumns=True)


def _clustered(df: DataFrame, partition_col: str, cluster_by: list[str] | None,
               keys: list[str] | None = None) -> DataFrame:
    """One range shuffle on (date, clustering columns), rows sorted inside each file (G1):
    the reference's ``order by`` clustering, giving tight row-group statistics. Range
    partitioning splits a date holding most rows over several writer tasks (a hash
    shuffle on the date alone would give it one)."""
    order = [partition_col, *(cluster_by or []), *(keys or [])]
    order = list(dict.fromkeys(order))
    return df.repartitionByRange(*order).sortWithinPartitions(*order)


def _write(spark: SparkSession, path: str, df: DataFrame, partition_col: str, mode: str,
           cluster_by: list[str] | None = None, keys: list[str] | None = None,
           span: tuple[str, str] | None = None, touched: list | None = None) -> None:
    """``span``: start and end columns that the partition statistics are kept of. ``touched``: the
    dates that a dynamic write stands for; those without rows are deleted."""
    old = (partition_stats.load(spark, path) or {}) if mode == "dynamic" and span else {}
    if span:
        df, staged = _staged(df, "write")
        new = partition_stats.compute(df, partition_col, *span)
        if old:
            partition_stats.save(spark, path, partition_stats.wider(old, new))
    (_clustered(df, partition_col, cluster_by, keys).write.mode("overwrite").option("compression", STORED)
     .option("partitionOverwriteMode", mode).partitionBy(partition_col).parquet(path))
    _save_schema(spark, path, df.schema)
    gone = []
    if touched is not None:
        kept = set(new) if span else {r[0] for r in df.select(partition_col).distinct().collect()}
        gone = [d for d in touched if d not in kept]
        for d in gone:
            name = "__HIVE_DEFAULT_PARTITION__" if d is None else d.isoformat()
            remove_path(spark, f"{path}/{partition_col}={name}")
    if span:
        partition_stats.save(spark, path, {d: x for d, x in (old | new).items() if d not in gone})
        remove_path(spark, staged)


def _staged(df: DataFrame, name: str) -> tuple[DataFrame, str]:
    spark = df.sparkSession
    path = f"{checkpoint_dir(spark).rstrip('/')}/staged/{name}-{uuid.uuid4().hex}"
    df.write.option("compression", STORED).parquet(path)
    return spark.read.schema(df.schema).parquet(path), path


def touched_partitions(target: DataFrame, partition_col: str, *batches: DataFrame) -> DataFrame:
    """Rows of the target in the dates of the batches, by a join on the partition column: the
    scan gets a dynamic partition filter. The dates are at most as many as the calendar has.
    Rows without a date are always among them."""
    dates = batches[0].select(partition_col)
    for b in batches[1:]:
        dates = dates.unionByName(b.select(partition_col))
    # the comparison holds for every date; the optimizer prunes by sides that have a filter
    dates = dates.where(F.col(partition_col) >= F.lit("0001-01-01").cast("date")).distinct()
    return target.join(F.broadcast(dates), partition_col, "left_semi").select(target.columns).unionByName(
        target.where(F.col(partition_col).isNull()))


def upsert(spark: SparkSession, path: str, new: DataFrame, keys: list[str], partition_col: str,
           order: list | None = None, cluster_by: list[str] | None = None,
           span: tuple[str, str] | None = None, remove: DataFrame | None = None) -> None:
    """Insert or replace rows by ``keys`` (A8, L2). ``partition_col`` must be a function
    of the keys so a key never changes partition. Among rows of one key the new one
    wins, then ``order`` decides. ``remove``: keys (with the partition column) whose rows leave the
    table unless ``new`` has them."""
    if not path_exists(spark, path):
        _write(spark, path, new, partition_col, "static", cluster_by, keys, span)
        return
    new, new_path = _staged(new, "new")
    target = read_target(spark, path)
    batches = [new]
    if remove is not None:
        remove, remove_path_ = _staged(remove.select(*keys, partition_col).distinct(), "remove")
        batches.append(remove)
    existing = touched_partitions(target, partition_col, *batches)
    if remove is not None:
        gone = remove.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
        existing = existing.join(gone, [F.col(k).eqNullSafe(F.col(f"_r_{k}")) for k in keys], "left_anti")
    merged = evolve(existing.withColumn("_is_new", F.lit(0)), new.withColumn("_is_new", F.lit(1)))
    kept = first_per_key(merged, keys, [F.col("_is_new").desc(), *(order or [])]).drop("_is_new")
    kept, kept_path = _staged(kept, "upsert")
    touched = None if remove is None else [r[0] for r in remove.select(partition_col).distinct().collect()]  # days
    _write(spark, path, kept, partition_col, "dynamic", cluster_by, keys, span, touched)
    for p in (new_path, kept_path, *([remove_path_] if remove is not None else [])):
        remove_path(spark, p)


def replace_dates(spark: SparkSession, path: str, rows: DataFrame, partition_col: str,
                  cluster_by: list[str] | None = None, since: dt.date | None = None) -> None:
    """Write whole dates in place of what the table has of them (A9, L3): every row of the source is
    kept, as often as it occurs; late rows and re-deliveries of those dates come out right. With
    ``since``, ``rows`` are all there is from that date on: later dates without rows leave the table."""
    touched = None
    if path_exists(spark, path):
        old = read_target(spark, path)
        added = [f for f in old.schema if f.name not in rows.columns]
        rows = rows.select("*", *[F.lit(None).cast(f.dataType).alias(f.name) for f in added])
        if since is not None:
            touched = [d for d in partition_dates(spark, path, partition_col) if d >= since]
    _write(spark, path, rows, partition_col, "dynamic", cluster_by, touched=touched)


def run_incremental(spark: SparkSession, path: str, build: Callable[[dt.datetime | None], DataFrame],
                    keys: list[str], ts: str, lookback_days: float, partition_col: str,
                    full_refresh: bool = False, order: list | None = None,
                    cluster_by: list[str] | None = None, start: str | None = None) -> dt.datetime | None:
    """Full build when the target is missing (A10) or ``full_refresh``; otherwise
    rebuild the look-back window and upsert it. Returns the lower bound used. ``start``: the column
    whose earliest value the statistics keep beside the latest ``ts``."""
    span = (start or ts, ts)
    if full_refresh or not path_exists(spark, path):
        _write(spark, path, build(None), partition_col, "static", cluster_by, keys, span)
        return None
    hi = partition_stats.latest_end(statistics(spark, path, partition_col, *span))
    since = EPOCH if hi is None else hi - dt.timedelta(days=lookback_days)
    upsert(spark, path, build(since), keys, partition_col, order, cluster_by, span)
    return since
