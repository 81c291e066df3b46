"""Type-2 history from an observation log (K14, F6, C9), skew-proof.

A plain ``lag``/``lead`` over ``partition by entity`` puts an entity's whole log in one
task. Here they run over the entity's rows of one stretch of time (a day; a month where the log has
dates only), so a hot entity is dealt to as many groups as it has stretches. Only the edge row of a
stretch lacks its neighbour; it comes from a table with one row per entity and stretch, in which
stretches with rows are in order. Finding the next change is the same over the change rows. A
pass shuffles the log once, by (entity, stretch); what else it shuffles has one row for each.
"""
from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.session import materialize


def _changed(cur: list[Column], prev: list[Column]) -> Column:
    # ``x != coalesce(prev, '')`` per tracked column, or-ed: the reference predicate,
    # including its null behaviour (a null tracked value never counts as a change).
    terms = [c != F.coalesce(p, F.lit("")) for c, p in zip(cur, prev)]
    return reduce(lambda a, b: a | b, terms)


def _neighbour(df: DataFrame, key: str, ts: str, order: list[str], cols: list[str], step: int, prefix: str,
               stretch: str) -> DataFrame:
    """Attach the entity's previous (``step=-1``) or next (``step=1``) row's ``cols`` as
    ``{prefix}{col}``. Structs compare null keys and null times as equal."""
    shift, ends = (F.lag, F.max_by) if step < 0 else (F.lead, F.min_by)
    near = F.struct(*[F.col(c) for c in cols])
    when = F.date_trunc(stretch, F.col(ts).cast("timestamp"))
    s = df.withColumns({"_key": F.struct(F.col(key)), "_when": when}).withColumn("_g", F.struct("_key", "_when"))
    edge = s.groupBy("_g").agg(ends(near, F.struct(*[F.col(c) for c in order])).alias("_e"))
    stretches = Window.partitionBy("_g._key").orderBy("_g._when")
    beyond = edge.select(F.col("_g").alias("_h"), shift("_e").over(stretches).alias("_beyond"))
    out = s.withColumn("_near", shift(near).over(Window.partitionBy("_g").orderBy(*order)))
    out = out.join(beyond, F.col("_g") == F.col("_h"), "left").withColumn("_near", F.coalesce("_near", "_beyond"))
    return out.withColumns({f"{prefix}{c}": F.col("_near")[c] for c in cols} | {
        f"_has{prefix}": F.col("_near").isNotNull()}).drop("_near", "_beyond", "_key", "_when", "_g", "_h")


def scd2(df: DataFrame, key: str, tracked: list[str], ts: str, stop: Column,
         tiebreak: list[str] | None = None, valid_from: str = "valid_from", valid_to: str = "valid_to",
         is_current: str = "is_current", stretch: str | None = None) -> DataFrame:
    """Compress an observation log to validity periods.

    A row starts a period when any tracked value differs from the previous observation
    of the same key (ordered by ``ts`` then ``tiebreak``; null keys are one key).
    ``valid_to`` is the start of the next period, or ``stop`` (a scalar, e.g. the latest
    observation time) for the open one, which is flagged ``is_current``. ``stretch`` (a unit of
    ``date_trunc``): how much of an entity's time one group holds.
    """
    tiebreak = tiebreak or []
    order = [ts, *tiebreak]
    cols = list(dict.fromkeys([key, *tracked, ts, *tiebreak]))
    stretch = stretch or ("month" if isinstance(df.schema[ts].dataType, T.DateType) else "day")
    s = _neighbour(df.select(*cols), key, ts, order, tracked, -1, "_prev_", stretch)
    prev = [F.when(F.col("_has_prev_"), F.col(f"_prev_{c}")) for c in tracked]
    changes = materialize(s.where(_changed([F.col(c) for c in tracked], prev)).select(*cols), "changes")
    c = _neighbour(changes, key, ts, order, [ts], 1, "_next_", stretch)
    nxt = F.when(F.col("_has_next_"), F.col(f"_next_{ts}"))
    return c.select(key, *tracked, F.col(ts).alias(valid_from), F.coalesce(nxt, stop).alias(valid_to),
                    nxt.isNull().alias(is_current), *[F.col(t) for t in tiebreak])
