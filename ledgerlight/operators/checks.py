"""Data checks (N1-N4): each returns the offending rows; an empty result passes."""
from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.functions.num import trunc_to
from ledgerlight.session import materialize


def table_diff(actual: DataFrame, expected: DataFrame, truncate: list[str] | None = None,
               digits: int = 8) -> DataFrame:
    """Rows in one table and not the other (multiset), both ways, tagged ``which_diff``.
    ``truncate`` columns are cut to ``digits`` decimals first."""
    cols = actual.columns

    def prep(df):
        df = df.select(*cols)
        if truncate:
            df = df.withColumns({c: trunc_to(c, digits) for c in truncate})
        return df

    # one shuffle for both ways: +1 for a row here, -1 there, and what is left over
    sides = prep(actual).withColumn("_n", F.lit(1)).unionByName(prep(expected).withColumn("_n", F.lit(-1)))
    left = sides.groupBy(*cols).agg(F.sum("_n").alias("_n")).where("_n <> 0")
    which = F.when(F.col("_n") > 0, "in_actual_not_in_expected").otherwise("in_expected_not_in_actual")
    copies = F.explode(F.sequence(F.lit(1), F.abs("_n")))
    return left.select(which.alias("which_diff"), *cols, copies.alias("_copy")).drop("_copy")


BUCKETS = 1 << 16


def checksum_diff(actual: DataFrame, expected: DataFrame, truncate: list[str] | None = None, digits: int = 8,
                  buckets: int = BUCKETS) -> DataFrame:
    """``table_diff`` of large, almost equal tables: rows fall into buckets by their hash, one
    aggregate a side gives each bucket's count and checksums, and only rows of buckets that differ are
    shuffled and compared. Checksums add hashes up (a pair of equal rows doesn't cancel out, as it
    would under xor alone) under two hash functions. There are at most ``buckets`` buckets."""
    cols = actual.columns

    def prep(df):
        df = df.select(*cols)
        return df.withColumns({c: trunc_to(c, digits) for c in truncate}) if truncate else df

    h = F.xxhash64(*[F.col(c) for c in cols])
    other = F.xxhash64(F.lit("checksum"), *[F.col(c) for c in cols])
    halves = lambda x: (F.shiftrightunsigned(x, 32), x.bitwiseAND(F.lit(0xFFFFFFFF)))  # noqa: E731  their sums don't overflow
    place = F.pmod(h, F.lit(buckets))

    def sums(df):
        return df.groupBy(place.alias("_bucket")).agg(
            F.count(F.lit(1)).alias("_n"), F.bit_xor(h).alias("_x"),
            *[F.sum(part).alias(f"_s{k}") for k, part in enumerate((*halves(h), *halves(other)))])

    a, b = prep(actual), prep(expected)
    state = F.struct("_n", "_x", "_s0", "_s1", "_s2", "_s3")
    differ = (sums(a).unionByName(sums(b)).groupBy("_bucket")
              .agg(F.count(F.lit(1)).alias("_sides"), F.min(state).alias("_lo"), F.max(state).alias("_hi")))
    differ = materialize(differ.where((F.col("_sides") < 2) | (F.col("_lo") != F.col("_hi"))).select("_bucket"), "buckets")
    of = lambda df: df.withColumn("_bucket", place).join(F.broadcast(differ), "_bucket", "left_semi").drop("_bucket")
    return table_diff(of(a), of(b))


def observed(df: DataFrame, not_null: list[str] = (), not_negative: list[str] = ()) -> tuple[DataFrame, Observation]:
    """The table with counts that its next action takes on the way (N2-N4 without a scan of their
    own): ``rows``, ``null_<col>`` and ``negative_<col>``; read them from the observation."""
    seen = Observation()
    counts = [F.count(F.lit(1)).alias("rows"), *[F.count_if(F.col(c).isNull()).alias(f"null_{c}") for c in not_null],
              *[F.count_if(F.col(c) < 0).alias(f"negative_{c}") for c in not_negative]]
    return df.observe(seen, *counts), seen


def changed_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    """Rows of one table and not of the other, in the new table's columns (missing ones are null)."""
    missing = [F.lit(None).cast(f.dataType).alias(f.name) for f in new.schema if f.name not in old.columns]
    return table_diff(new, old.select("*", *missing)).drop("which_diff")


def unmatched_keys(a: DataFrame, b: DataFrame, key: str, date_col: str | None = None,
                   before=None) -> DataFrame:
    """Keys present on one side only (one aggregate over both sides instead of a full outer join),
    optionally only rows with ``date(date_col) < before``."""
    def cut(df):
        if date_col is not None and before is not None:
            df = df.where(F.to_date(date_col) < before)
        return df.select(key)

    sides = cut(a).withColumn("_left", F.lit(True)).unionByName(cut(b).withColumn("_left", F.lit(False)))
    seen = sides.groupBy(key).agg(F.max("_left").alias("_in_left"), F.min("_left").alias("_not_right"))
    # a null key equals nothing, so it is on one side only on each side that has it
    null_right = F.col(key).isNull() & F.col("_in_left") & ~F.col("_not_right")
    side = (F.when(null_right, F.array(F.lit("only_in_left"), F.lit("only_in_right")))
            .when(F.col("_in_left") & F.col("_not_right"), F.array(F.lit("only_in_left")))
            .when(~F.col("_in_left"), F.array(F.lit("only_in_right"))))
    return seen.select(key, F.explode(side).alias("side"))


def duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """Keys that occur more than once, with their count."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).where(F.col("n") > 1)


def nulls(df: DataFrame, cols: list[str]) -> DataFrame:
    """Rows where any of ``cols`` is null."""
    cond = None
    for c in cols:
        cond = F.col(c).isNull() if cond is None else (cond | F.col(c).isNull())
    return df.where(cond)


def negatives(df: DataFrame, col: str) -> DataFrame:
    return df.where(F.col(col) < 0)


def check_schema(df: DataFrame, expected: T.StructType) -> list[str]:
    """Names of expected columns missing or of another type."""
    have = {f.name: f.dataType for f in df.schema.fields}
    return [f.name for f in expected.fields if have.get(f.name) != f.dataType]
