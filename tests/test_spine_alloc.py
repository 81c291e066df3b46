from pyspark.sql import functions as F

from ledgerlight.operators.allocation import allocate, billable_after_free_tier, residual
from ledgerlight.operators.spine import hour_spine, slice_intervals, with_day_stats
from tests.conftest import ts

SCHEMA = "id string, s timestamp, e timestamp"


def slices(spark, rows):
    df = spark.createDataFrame(rows, SCHEMA)
    out = slice_intervals(df, end="e", anchor="s", ms_col="ms")
    return sorted((r.id, r.hour_start.strftime("%d %H:%M"), r.ms) for r in out.collect())


def test_slice_edges(spark):
    rows = [
        ("same_hour", ts("2024-01-01 10:10:00"), ts("2024-01-01 10:40:00")),
        ("ends_on_hour", ts("2024-01-01 10:30:00"), ts("2024-01-01 12:00:00")),
        ("midnight", ts("2024-01-01 23:59:59.500"), ts("2024-01-02 00:00:00.250")),
        ("start_after_end_same_hour", ts("2024-01-01 10:50:00"), ts("2024-01-01 10:20:00")),
        ("start_after_end_other_hour", ts("2024-01-01 12:10:00"), ts("2024-01-01 11:20:00")),
        ("null_start", None, ts("2024-01-01 11:20:00")),
        ("zero_length_on_hour", ts("2024-01-01 10:00:00"), ts("2024-01-01 10:00:00")),
    ]
    got = slices(spark, rows)
    assert got == sorted([
        ("same_hour", "01 10:00", 30 * 60_000),
        ("ends_on_hour", "01 10:00", 30 * 60_000),
        ("ends_on_hour", "01 11:00", 60 * 60_000),
        ("midnight", "01 23:00", 500),
        ("midnight", "02 00:00", 250),
        # the reference keeps it and the run time is negative
        ("start_after_end_same_hour", "01 10:00", -30 * 60_000),
    ])


def test_slices_sum_to_duration(spark):
    rows = [(str(i), ts("2024-01-01 00:17:03.123"), ts("2024-01-01 00:17:03.123") + __import__("datetime").timedelta(
        minutes=37 * i + 1)) for i in range(1, 40)]
    df = spark.createDataFrame(rows, SCHEMA)
    out = slice_intervals(df, end="e", anchor="s", ms_col="ms").groupBy("id").agg(F.sum("ms").alias("ms"))
    for r in out.collect():
        assert r.ms == (37 * int(r.id) + 1) * 60_000


def test_hour_spine_and_fallback(spark):
    df = spark.createDataFrame([(ts("2024-01-31 22:00:00"),), (ts("2024-02-01 01:00:00"),)], "t timestamp")
    hours = with_day_stats(hour_spine(df, "t"))
    got = [(r.hour.strftime("%m-%d %H"), r.hours_thus_far, r.days_in_month) for r in hours.orderBy("hour").collect()]
    assert got == [("01-31 22", 2, 31), ("01-31 23", 2, 31), ("02-01 00", 2, 29), ("02-01 01", 2, 29)]
    empty = spark.createDataFrame([], "t timestamp")
    assert [r.hour for r in hour_spine(empty, "t").collect()] == [ts("2023-01-01 00:00:00")]


def test_allocate_zero_and_null_weights_and_missing_bill(spark):
    sl = spark.createDataFrame([
        ("a", 1, "h1", 30.0), ("b", 1, "h1", 10.0),      # normal split 3:1
        ("c", 1, "h2", 0.0), ("d", 1, "h2", 0.0),        # zero total weight -> 0 share
        ("e", 1, "h3", None), ("f", 1, "h3", 5.0),        # null weight
        ("g", 2, "h1", 5.0),                              # no bill for (2, h1) -> dropped
    ], "q string, w long, h string, ms double")
    billed = spark.createDataFrame([(1, "h1", 8.0), (1, "h2", 4.0), (1, "h3", 6.0)], "w long, h string, credits double")
    out = allocate(sl, billed, ["w", "h"], {"ms": ("total", "frac")}, {"alloc": ("credits", "frac")})
    got = {r.q: r.alloc for r in out.collect()}
    assert got == {"a": 6.0, "b": 2.0, "c": 0.0, "d": 0.0, "e": None, "f": 6.0}


def test_allocation_conserves_billed_credits(spark):
    import random
    rnd = random.Random(7)
    rows = [(f"q{i}", rnd.randint(1, 5), f"h{rnd.randint(1, 9)}", float(rnd.randint(1, 1000))) for i in range(500)]
    sl = spark.createDataFrame(rows, "q string, w long, h string, ms double")
    keys = sl.select("w", "h").distinct().withColumn("credits", F.lit(3.0))
    out = allocate(sl, keys, ["w", "h"], {"ms": ("total", "frac")}, {"alloc": ("credits", "frac")})
    total = out.agg(F.sum("alloc")).first()[0]
    assert abs(total - 3.0 * keys.count()) < 1e-9


def test_free_tier_and_residual(spark):
    df = spark.createDataFrame([(10.0, 50.0), (2.0, 50.0), (None, 1.0)], "cs double, comp double")
    got = [r.x for r in df.select(billable_after_free_tier(F.col("cs"), F.col("comp")).alias("x")).collect()]
    assert got == [5.0, 0.0, None]
    total = spark.createDataFrame([("d1", 10.0), ("d2", 3.0)], "d string, t double")
    parts = spark.createDataFrame([("d1", 4.0), ("d1", 1.0), ("d2", 5.0)], "d string, p double")
    out = residual(total, parts, ["d"], {"r": ("t", "p")}, keep_positive=True)
    assert [(r.d, r.r) for r in out.collect()] == [("d1", 5.0)]


def test_clip_bounds_the_sequence(spark):
    rows = [("bogus", ts("1970-01-01 00:00:00"), ts("2024-01-01 02:30:00")),
            ("inside", ts("2024-01-01 01:10:00"), ts("2024-01-01 01:20:00")),
            ("outside", ts("2023-12-31 10:00:00"), ts("2023-12-31 11:00:00"))]
    df = spark.createDataFrame(rows, SCHEMA)
    clip = (F.lit(ts("2024-01-01 00:00:00")), F.lit(ts("2024-01-01 01:00:00")))
    out = slice_intervals(df, end="e", anchor="s", ms_col="ms", clip=clip)
    got = sorted((r.id, r.hour_start.hour, r.ms) for r in out.collect())
    assert got == [("bogus", 0, 3_600_000), ("bogus", 1, 3_600_000), ("inside", 1, 600_000)]


def test_salted_allocation_equals_plain(spark):
    import random
    rnd = random.Random(5)
    rows = [(f"q{i}", 1 if i < 400 else rnd.randint(2, 6), f"h{rnd.randint(1, 3)}", float(rnd.randint(1, 100)))
            for i in range(600)]                      # warehouse 1 is hot
    sl = spark.createDataFrame(rows, "q string, w long, h string, ms double")
    billed = sl.select("w", "h").distinct().withColumn("credits", F.lit(7.0))
    spec = ({"ms": ("total", "frac")}, {"alloc": ("credits", "frac")})
    plain = allocate(sl, billed, ["w", "h"], *spec)
    salted = allocate(sl, billed, ["w", "h"], *spec, max_rows_per_key=25, spread_cols=["q"])
    key = lambda r: (r.q, r.h)
    a = sorted(((r.q, r.h, round(r.alloc, 9)) for r in plain.collect()), key=str)
    b = sorted(((r.q, r.h, round(r.alloc, 9)) for r in salted.collect()), key=str)
    assert a == b and len(a) == 600
    assert salted.columns == plain.columns
