"""Proportional cost allocation.

Group totals are computed with ``groupBy`` (map-side partial aggregation) and joined
back, instead of ``sum() over (partition by key)``: a window would pull every row of a
hot (warehouse, hour) into one task, the aggregate pulls one partial row per map task.
The join back is keyed; keys above a row threshold are split explicitly by salting
(``salted_join``), and AQE broadcasts the keyed side when its runtime size is small.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.functions.num import div0, greatest_strict
from ledgerlight.session import materialize


def salted_join(big: DataFrame, keyed: DataFrame, keys: list[str], rows_col: str,
                max_rows_per_key: int, spread_cols: list[str]) -> DataFrame:
    """Inner join of many rows to one row per key, splitting hot keys explicitly.

    ``keyed`` carries ``rows_col``, the number of ``big`` rows of its key. A key with more
    than ``max_rows_per_key`` rows is hot: its keyed row is replicated
    ``f = ceil(rows / max_rows_per_key)`` times and each of its big rows goes to one
    replica by a hash of ``spread_cols`` (deterministic, so retries agree). The hot-key
    list has at most ``total rows / max_rows_per_key`` entries, a proven bound, and is
    broadcast. Results equal the plain join; no key's rows exceed one task's share."""
    hot = keyed.where(F.col(rows_col) > max_rows_per_key).select(
        *keys, F.ceil(F.col(rows_col) / F.lit(max_rows_per_key)).cast("int").alias("_fan"))
    fan = F.coalesce(F.col("_fan"), F.lit(1))
    spread = F.pmod(F.xxhash64(*[F.col(c) for c in spread_cols]), fan.cast("long")).cast("int")
    b = big.join(F.broadcast(hot), keys, "left").withColumn("_salt", spread).drop("_fan")
    k = (keyed.join(F.broadcast(hot), keys, "left")
         .withColumn("_salt", F.explode(F.sequence(F.lit(0), fan - 1))).drop("_fan"))
    return b.join(k, [*keys, "_salt"], "inner").drop("_salt")


def allocate(slices: DataFrame, billed: DataFrame, keys: list[str],
             weights: dict[str, tuple[str, str]],
             amounts: dict[str, tuple[str, str]],
             max_rows_per_key: int | None = None, spread_cols: list[str] | None = None) -> DataFrame:
    """Share billed amounts over rows in proportion to a weight.

    ``weights``: ``{weight_col: (total_col, fraction_col)}``; the total is the weight's
    sum over all rows of the key (rows without a bill count too).
    ``amounts``: ``{out_col: (billed_col, fraction_col)}``.
    Rows whose key has no bill are dropped (inner join), as in the reference.
    With ``max_rows_per_key``, keys holding more rows are split over several join tasks
    (``salted_join``, rows spread by a hash of ``spread_cols``); otherwise AQE's skew
    join splits hot keys at runtime.
    """
    sums = {t: w for w, (t, _f) in weights.items()}
    totals = slices.groupBy(*keys).agg(*[F.sum(c).alias(o) for o, c in sums.items()],
                                       F.count(F.lit(1)).alias("_rows"))
    # one row per key, used by the hot list and by the join: computed once
    keyed = materialize(totals.join(billed, keys, "inner"), "allocation-totals")
    if max_rows_per_key is not None:
        out = salted_join(slices, keyed, keys, "_rows", max_rows_per_key,
                          spread_cols or slices.columns).drop("_rows")
    else:
        out = slices.join(keyed.drop("_rows"), keys, "inner")
    out = out.withColumns({f: div0(F.col(w), F.col(t)) for w, (t, f) in weights.items()})
    return out.withColumns({o: F.col(b) * F.col(f) for o, (b, f) in amounts.items()})


def conditional_sums(df: DataFrame, keys: list[str], label_col: str,
                     spec: dict[str, tuple[str, str]]) -> DataFrame:
    """Pivot by label: ``{out: (label, value_col)}`` -> ``sum(iff(label_col = label, v, 0))``."""
    return df.groupBy(*keys).agg(*[
        F.sum(F.when(F.col(label_col) == F.lit(lbl), F.col(v)).otherwise(F.lit(0.0))).alias(o)
        for o, (lbl, v) in spec.items()])


def rollup_slices(df: DataFrame, key: str, sums: dict[str, str],
                  constants: list[str]) -> DataFrame:
    """Back to one row per key: sums of the slice amounts; per-key constant columns are
    carried with ``max`` (deterministic stand-in for ``any_value``)."""
    return df.groupBy(key).agg(*[F.sum(c).alias(o) for o, c in sums.items()],
                               *[F.max(c).alias(c) for c in constants])


def billable_after_free_tier(daily_used: Column, daily_base: Column,
                             free_fraction: float = 0.1) -> Column:
    """``greatest(used - base * fraction, 0)``, null if an input is null."""
    return greatest_strict(daily_used - daily_base * F.lit(free_fraction), F.lit(0.0))


def share_of(part, whole, amount) -> Column:
    """``div0(part, whole) * amount``: a row's share of a daily billable amount."""
    return div0(part, whole) * amount


def residual(total: DataFrame, parts: DataFrame, on: list[str],
             measures: dict[str, tuple[str, str]], keep_positive: bool = False) -> DataFrame:
    """Control total minus the sum of itemised parts.

    ``measures``: ``{out_col: (total_col, parts_col)}``; ``parts`` is aggregated per
    ``on`` first, then left-joined to ``total``.
    """
    agg = parts.groupBy(*on).agg(*[F.sum(p).alias(f"_p_{o}") for o, (_t, p) in measures.items()])
    out = total.join(agg, on, "left").withColumns(
        {o: F.col(t) - F.col(f"_p_{o}") for o, (t, _p) in measures.items()})
    out = out.drop(*[f"_p_{o}" for o in measures])
    if keep_positive:
        cond = None
        for o in measures:
            c = F.col(o) > 0
            cond = c if cond is None else (cond & c)
        out = out.where(cond)
    return out
