"""Gap fill, priority pick, latest flags and valid ranges.

Every window here is partitioned by a key whose groups are bounded by the number of
days in the grid (a few thousand rows), or is a top-1 that Spark plans as a
``WindowGroupLimit`` (partial top-1 before the shuffle), so no unbounded group lands
in a single task.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.session import materialize


def _order(cols) -> list[Column]:
    return [c if isinstance(c, Column) else F.col(c) for c in cols]


def repeated_keys(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that more than one row has, written, so that their size is known to the planner. Nulls are one key."""
    return materialize(df.groupBy(*keys).agg(F.count(F.lit(1)).alias("_n")).where("_n > 1").select(*keys), "repeated-keys")


def first_per_key(df: DataFrame, keys: list[str], order: list, rn: str = "_rn",
                  repeated: DataFrame | None = None) -> DataFrame:
    """Keep one row per key: the first by ``order`` (K15, F1). Put a unique column last
    in ``order`` for a deterministic winner. With ``repeated`` (see ``repeated_keys``), rows of other
    keys stay where they are, and only those of repeated keys meet in the window."""
    if repeated is not None:
        marks = repeated.select(*[F.col(k).alias(f"_k_{k}") for k in keys])
        same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]
        return df.join(marks, same, "left_anti").unionByName(
            first_per_key(df.join(marks, same, "left_semi"), keys, order, rn))
    w = Window.partitionBy(*keys).orderBy(*_order(order))
    return df.withColumn(rn, F.row_number().over(w)).where(F.col(rn) == 1).drop(rn)


def latest_per_key(df: DataFrame, keys: list[str], order: list) -> DataFrame:
    """Keep the latest row per key; pass ``F.col(c).desc_nulls_last()`` terms (F2)."""
    return first_per_key(df, keys, order)


def flag_latest(df: DataFrame, keys: list[str], order: list[str], flag: str) -> DataFrame:
    """Boolean column, true on the row(s) with the greatest ``order`` values per key.

    Skew-safe: the per-key maximum is a partial aggregate (one value per key and map
    task crosses the shuffle) joined back, instead of a window holding the whole key.
    Put a unique column last in ``order`` to flag exactly one row."""
    ordering = F.struct(*[F.col(c) for c in order])
    top = df.groupBy(*keys).agg(F.max(ordering).alias("_latest")).withColumnsRenamed({k: f"_k_{k}" for k in keys})
    same = [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys]  # null keys are one key
    return (df.join(top, same, "left")
            .withColumn(flag, F.coalesce(ordering == F.col("_latest"), F.lit(False)))
            .drop("_latest", *[f"_k_{k}" for k in keys]))


def gap_fill(df: DataFrame, keys: list[str], date: str, values: list[str],
             start: Column, end: Column) -> DataFrame:
    """One row per key and date in [start, end], values filled from the last known
    earlier date, else from the next known later date, per value column (K12).

    ``start``/``end`` are scalar columns (literals or scalar subqueries). The grid is the
    distinct keys with a generated date sequence each. Instead of joining grid and facts
    (two shuffles on (key, date) plus one on key for the fill), both are unioned and
    shuffled once by key; a grid row is dropped where its (key, date) has a fact, which
    keeps every fact row exactly like a left join would. All windows then share one sort
    by (key, date), and each key holds one row per day of the range (plus repeated
    facts), however many rows the key has upstream.
    """
    types = {f.name: f.dataType for f in df.schema.fields}
    facts = (df.select(*keys, date, *values).where(F.col(date).between(start, end))
             .withColumn("_fact", F.lit(1)))
    grid = (df.select(*keys).distinct()
            .select(*keys, F.explode(F.sequence(start, end)).alias(date),
                    *[F.lit(None).cast(types[v]).alias(v) for v in values], F.lit(0).alias("_fact")))
    rows = facts.unionByName(grid).repartition(*keys)
    rows = rows.withColumn("_has_fact", F.max("_fact").over(Window.partitionBy(*keys, date)))
    rows = rows.where((F.col("_fact") == 1) | (F.col("_has_fact") == 0)).drop("_fact", "_has_fact")
    # The forward fill is a growing frame (unbounded preceding .. 1 preceding), evaluated
    # incrementally. The backward fill only matters before a key's first known value (the
    # forward fill covers every later row), where it equals the key's first non-null
    # value: a whole-partition frame. Both frames share one partitioning and ordering, so
    # one sort serves both (a "1 following .. unbounded following" frame would be
    # re-aggregated per row instead).
    ordered = Window.partitionBy(*keys).orderBy(F.col(date).asc())
    before = ordered.rowsBetween(Window.unboundedPreceding, -1)
    whole = ordered.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    return rows.withColumns({
        v: F.coalesce(F.col(v), F.last(v, ignorenulls=True).over(before),
                      F.first(v, ignorenulls=True).over(whole))
        for v in values}).select(*keys, date, *values)


def pick_by_priority(df: DataFrame, keys: list[str], priority: Column,
                     tiebreak: list) -> DataFrame:
    """Keep the highest-priority row per key, ties broken by ``tiebreak``."""
    return first_per_key(df, keys, [priority.desc(), *tiebreak])
