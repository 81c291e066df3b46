import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.streaming.allocation import allocate_stream
from ledgerlight.streaming.hour_totals import batch_sums, hour_totals, start_hour_totals, write_batch
from ledgerlight.streaming.query_hours import (QUERY_INTERVALS, drain, hourly_run_time, run_events_stream,
                                               start_hourly_run_time)
from ledgerlight.streaming.sessions import busy_sessions
from tests.conftest import SF_SMALL


def test_stream_emits_closed_hours_equal_to_batch(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1, 0, 30)
    rows = [(f"q{i}", i % 3, t0 + dt.timedelta(hours=i), t0 + dt.timedelta(hours=i, minutes=50)) for i in range(48)]
    df = spark.createDataFrame(rows, "query_id string, warehouse_id long, start_time timestamp, end_time timestamp")
    d = str(tmp_path)
    df.where(F.col("start_time") < F.lit(t0 + dt.timedelta(hours=24))).write.parquet(f"{d}/src/p1")
    start_hourly_run_time(spark, f"{d}/src/*", f"{d}/sink", f"{d}/ckpt", "2 hours").awaitTermination()
    first = spark.read.parquet(f"{d}/sink").count()
    df.where(F.col("start_time") >= F.lit(t0 + dt.timedelta(hours=24))).write.parquet(f"{d}/src/p2")
    start_hourly_run_time(spark, f"{d}/src/*", f"{d}/sink", f"{d}/ckpt", "2 hours").awaitTermination()
    out = spark.read.parquet(f"{d}/sink")
    static = hourly_run_time(df, "2 hours")
    assert 0 < first < out.count() < static.count()          # the last hours are still open
    joined = out.join(static, ["warehouse_id", "hour"])
    assert joined.count() == out.count()
    assert joined.where(out.total_query_milliseconds_in_hour != static.total_query_milliseconds_in_hour).count() == 0


def test_a_table_of_many_files_streams_like_one_file(spark, tmp_path):
    one = f"{SF_SMALL}/events.parquet"
    spark.read.parquet(one).repartition(3).write.parquet(f"{tmp_path}/events.parquet")
    a = run_events_stream(spark, one, f"{tmp_path}/a", "24 hours")
    b = run_events_stream(spark, f"{tmp_path}/events.parquet", f"{tmp_path}/b", "24 hours")
    assert a.count() > 0 and a.exceptAll(b).count() == 0 and b.exceptAll(a).count() == 0


def intervals(spark, rows):
    return spark.createDataFrame(rows, "query_id string, warehouse_id long, start_time timestamp, end_time timestamp")


def as_stream(spark, path, per_trigger=1):
    return spark.readStream.schema(QUERY_INTERVALS).option("maxFilesPerTrigger", per_trigger).parquet(path)


def test_late_rows_correct_closed_hours_and_repeated_batches_change_nothing(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda h, m=0: t0 + dt.timedelta(hours=h, minutes=m)
    base = str(tmp_path)
    batches = [[("a", 1, at(0), at(1, 30)), ("b", 2, at(2), at(2, 10))], [("c", 1, at(90), at(90, 5))],
               [("late", 1, at(0, 20), at(0, 40)), ("d", None, at(1), at(1, 1))]]
    for k, rows in enumerate(batches):
        intervals(spark, rows).coalesce(1).write.parquet(f"{base}/src/{k}")
        start_hour_totals(spark.readStream.schema(QUERY_INTERVALS).parquet(f"{base}/src/*"), base).awaitTermination()
    want = sorted(map(tuple, batch_sums(intervals(spark, sum(batches, []))).collect()), key=str)
    got = lambda: sorted(map(tuple, hour_totals(spark, base).collect()), key=str)
    assert got() == want
    write_batch(spark, base, intervals(spark, batches[1]), 1)   # delivered again
    assert got() == want
    write_batch(spark, base, intervals(spark, batches[0][:1]), 0)  # delivered again after a change at the source
    assert got() == [w for w in want if w[0] != 2]


def test_sessions_merge_across_batches(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda m: t0 + dt.timedelta(minutes=m)
    rows = [("a", 1, at(0), at(10)), ("b", 1, at(16), at(20)), ("c", 1, at(12), at(13)), ("d", 1, at(40), at(41)),
            ("e", 2, at(0), at(60)), ("f", 2, at(5), at(6)), ("g", 2, at(61), at(61)), ("far", 3, at(5000), at(5001)),
            ("odd", 1, at(30), at(20)), ("none", None, at(0), at(1))]
    static = sorted(map(tuple, busy_sessions(intervals(spark, rows)).collect()))
    assert static == [(1, at(0), at(20), 3, 900), (1, at(40), at(41), 1, 60), (2, at(0), at(61), 3, 3660), (3, at(5000), at(5001), 1, 60)]
    for k, r in enumerate(rows):
        intervals(spark, [r]).coalesce(1).write.mode("append").parquet(f"{tmp_path}/src")
    base = str(tmp_path)
    drain(busy_sessions(as_stream(spark, f"{base}/src")), base)
    got = sorted(tuple(r)[:5] for r in spark.read.parquet(f"{base}/sink").collect())
    assert got == static[:3]  # the last is still open


def test_streams_that_meet_share_bills_and_forget_closed_hours(spark, tmp_path):
    t0 = dt.datetime(2024, 1, 1)
    at = lambda h, m=0: t0 + dt.timedelta(hours=h, minutes=m)
    base = str(tmp_path)
    rows = [(f"q{h}-{k}", 1, at(h, 5 * k), at(h, 5 * k + 10)) for h in range(40) for k in range(3)]
    spark.createDataFrame([(1, at(h), float(h)) for h in range(40)], "warehouse_id long, hour timestamp, billed double").write.parquet(f"{base}/bills")
    for part in (rows[:60], rows[60:]):
        intervals(spark, part).coalesce(1).write.mode("append").parquet(f"{base}/src")
    bills = spark.readStream.schema("warehouse_id long, hour timestamp, billed double").parquet(f"{base}/bills")
    out = allocate_stream(as_stream(spark, f"{base}/src", 10), bills, "5 hours")
    query = (out.writeStream.format("parquet").option("path", f"{base}/sink").option("checkpointLocation", f"{base}/checkpoint")
             .outputMode("append").trigger(availableNow=True).start())
    query.awaitTermination()
    got = spark.read.schema(out.schema).parquet(f"{base}/sink").collect()
    assert {r.hour for r in got} == {at(h) for h in range(35)} and len(got) == 105
    assert all(abs(r.allocated - (r.hour - t0).seconds / 3600 / 3 - (r.hour - t0).days * 8) < 1e-9 and r.ms == 600000 for r in got)
    # only hours that are still open are kept: six of 40, by slices, bills and totals
    kept = [s["numRowsTotal"] for s in query.lastProgress["stateOperators"]]
    assert max(kept) <= 6 * (3 + 1) + 6, kept
