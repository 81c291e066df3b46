import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.plans.canonical import canonical
from ledgerlight.plans.query_cost import cost_per_query
from ledgerlight.plans.registry import Context
from ledgerlight.streaming import partition_stats as ps
from ledgerlight.streaming.incremental import (partition_dates, read_target, replace_dates, run_incremental, statistics,
                                                touched_partitions, upsert, watermark)
from tests.conftest import SF_SMALL


def rows(df):
    return sorted(tuple(r) for r in canonical(df).collect())


def test_incremental_cost_equals_full_run(spark):
    ctx = Context(spark, SF_SMALL)
    full = ctx.cost_per_query()
    hi = full.agg(F.max("end_time")).first()[0]
    for days in (1, 3, 10):
        since = hi - dt.timedelta(days=days)
        incr = cost_per_query(ctx.st, ctx.daily_rates(), since=F.lit(since))
        assert rows(incr) == rows(full.where(F.col("end_time") > F.lit(since)))


def test_watermark_defaults(spark):
    empty = spark.createDataFrame([], "t timestamp")
    assert watermark(None, "t", 3) == dt.datetime(1970, 1, 1)
    assert watermark(empty, "t", 3) == dt.datetime(1970, 1, 1)
    one = spark.createDataFrame([(dt.datetime(2024, 1, 10),)], "t timestamp")
    assert watermark(one, "t", 3) == dt.datetime(2024, 1, 7)


def test_upsert_late_and_updated_rows(spark, tmp_path):
    path = str(tmp_path / "target")
    base = spark.createDataFrame([
        ("q1", dt.datetime(2024, 1, 1, 10), 1.0), ("q2", dt.datetime(2024, 1, 2, 10), 2.0),
        ("q3", dt.datetime(2024, 1, 3, 10), 3.0)], "query_id string, start_time timestamp, cost double")
    with_date = lambda df: df.withColumn("date", F.to_date("start_time"))

    def build(since):
        src = base if since is None else later
        if since is not None:
            src = src.where(F.col("start_time") > F.lit(since))
        return with_date(src)

    assert run_incremental(spark, path, build, ["query_id", "start_time"], "start_time", 2, "date") is None
    # q3 updated inside the look-back, q4 arrives late inside it, q0 is too old to be seen
    later = spark.createDataFrame([
        ("q3", dt.datetime(2024, 1, 3, 10), 30.0), ("q4", dt.datetime(2024, 1, 2, 12), 4.0),
        ("q0", dt.datetime(2023, 12, 1, 10), 9.0)], "query_id string, start_time timestamp, cost double")
    since = run_incremental(spark, path, build, ["query_id", "start_time"], "start_time", 2, "date")
    assert since == dt.datetime(2024, 1, 1, 10)
    got = sorted((r.query_id, r.cost) for r in read_target(spark, path).collect())
    assert got == [("q1", 1.0), ("q2", 2.0), ("q3", 30.0), ("q4", 4.0)]


def test_upsert_adds_new_columns(spark, tmp_path):
    path = str(tmp_path / "evolve")
    a = spark.createDataFrame([("k1", dt.date(2024, 1, 1), 1.0)], "k string, date date, v double")
    upsert(spark, path, a, ["k"], "date")
    b = spark.createDataFrame([("k2", dt.date(2024, 1, 1), 2.0, "x")], "k string, date date, v double, extra string")
    upsert(spark, path, b, ["k"], "date")
    got = sorted((r.k, r.v, r.extra) for r in read_target(spark, path).collect())
    assert got == [("k1", 1.0, None), ("k2", 2.0, "x")]


def test_replaced_dates_keep_every_record(spark, tmp_path):
    path = str(tmp_path / "log")
    schema = "query_id string, query_start_time timestamp, d date"
    row = lambda q, day: (q, dt.datetime(2024, 1, day, 5), dt.date(2024, 1, day))
    first = [row("q1", 1), row("q2", 2), row("q2", 2), row("q3", 3)]
    replace_dates(spark, path, spark.createDataFrame(first, schema), "d")
    # the last two days again: a late record, a repeated one and a new day
    again = [row("q2", 2), row("q2", 2), row("late", 2), row("q3", 3), row("q3", 3), row("q4", 4)]
    replace_dates(spark, path, spark.createDataFrame(again, schema), "d")
    assert sorted(r.query_id for r in read_target(spark, path).collect()) == ["late", "q1", "q2", "q2", "q3", "q3", "q4"]
    assert [d.day for d in partition_dates(spark, path, "d")] == [1, 2, 3, 4]
    # a date that has lost all its rows in the source leaves the table
    replace_dates(spark, path, spark.createDataFrame([row("q4", 4)], schema), "d", since=dt.date(2024, 1, 3))
    assert [d.day for d in partition_dates(spark, path, "d")] == [1, 2, 4]


def test_an_upsert_builds_its_rows_once_and_reads_touched_dates(spark, tmp_path, capsys):
    path = str(tmp_path / "target")
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    df = spark.createDataFrame([(f"k{i}", dt.date(2024, 1, 1 + i % 4), float(i)) for i in range(20)], "k string, date date, v double")
    upsert(spark, path, df, ["k"], "date")
    new = df.where("date = '2024-01-02'").repartition(1).mapInArrow(count, df.schema)
    upsert(spark, path, new, ["k"], "date")
    assert seen.value == 5 and read_target(spark, path).count() == 20


def test_hot_date_is_written_by_several_tasks(spark, tmp_path):
    import os
    path = str(tmp_path / "hot")
    rows = [(f"q{i}", dt.datetime(2024, 1, 1) + dt.timedelta(seconds=i)) for i in range(4000)]
    df = spark.createDataFrame(rows, "query_id string, start_time timestamp").withColumn("date", F.to_date("start_time"))
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        upsert(spark, path, df, ["query_id", "start_time"], "date", cluster_by=["start_time"])
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    files = [f for f in os.listdir(os.path.join(path, "date=2024-01-01")) if f.endswith(".parquet")]
    assert len(files) > 1
    assert read_target(spark, path).count() == 4000


def test_statistics_follow_every_write(spark, tmp_path):
    path = str(tmp_path / "stats")
    schema = "k string, s timestamp, e timestamp, d date"
    row = lambda k, day, hours: (k, dt.datetime(2024, 1, day), dt.datetime(2024, 1, day) + dt.timedelta(hours=hours),
                                 dt.date(2024, 1, day))
    span = ("s", "e")
    upsert(spark, path, spark.createDataFrame([row("a", 1, 1), row("b", 2, 3)], schema), ["k", "s"], "d", span=span)
    upsert(spark, path, spark.createDataFrame([row("long", 1, 480), row("c", 3, 1)], schema), ["k", "s"], "d", span=span)
    stats = statistics(spark, path, "d", *span)
    assert stats == ps.compute(read_target(spark, path), "d", *span) and len(stats) == 3
    # the partition of a query that ran for 20 days is read, whatever its start
    assert ps.ending_after(stats, dt.datetime(2024, 1, 15)) == [dt.date(2024, 1, 1)]
    assert ps.latest_end(stats) == dt.datetime(2024, 1, 21)
    assert sorted(ps.meeting(stats, [dt.date(2024, 1, 2)])) == [dt.date(2024, 1, 1), dt.date(2024, 1, 2)]
    # keys that leave, and a partition that loses all its rows
    gone = spark.createDataFrame([row("long", 1, 0), row("c", 3, 0)], schema)
    upsert(spark, path, spark.createDataFrame([row("n", 2, 1)], schema), ["k", "s"], "d", span=span, remove=gone)
    assert sorted(r.k for r in read_target(spark, path).collect()) == ["a", "b", "n"]
    assert statistics(spark, path, "d", *span) == ps.compute(read_target(spark, path), "d", *span)


def test_bounds_before_a_write_hold_for_both_states(spark):
    a = {dt.date(2024, 1, 1): ps.Span(5, 9, 2), None: ps.Span(None, None, 1)}
    b = {dt.date(2024, 1, 1): ps.Span(3, 7, 1), dt.date(2024, 1, 2): ps.Span(1, 2, 1), None: ps.Span(4, 4, 1)}
    assert ps.wider(a, b) == {dt.date(2024, 1, 1): ps.Span(3, 9, 2), None: ps.Span(4, 4, 1), dt.date(2024, 1, 2): ps.Span(1, 2, 1)}


def test_the_target_is_pruned_by_a_join(spark, tmp_path):
    path = str(tmp_path / "pruned")
    df = spark.createDataFrame([(f"k{i}", dt.date(2024, 1, 1 + i), 1.0) for i in range(9)] + [("none", None, 2.0)], "k string, date date, v double")
    upsert(spark, path, df, ["k"], "date")
    batch = str(tmp_path / "batch")
    df.where("k = 'k3'").write.parquet(batch)
    got = touched_partitions(read_target(spark, path), "date", spark.read.parquet(batch))
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "dynamicpruning" in plan, plan
    assert sorted(r.k for r in got.collect()) == ["k3", "none"]
    # rows without a date survive an upsert of others
    upsert(spark, path, df.where("k = 'k3'"), ["k"], "date")
    assert read_target(spark, path).count() == 10


def test_replaced_dates_are_stored_with_the_strong_codec(spark, tmp_path):
    path = str(tmp_path / "t")
    replace_dates(spark, path, spark.createDataFrame([("q1", dt.date(2024, 1, 1))], "k string, d date"), "d")
    names = [f.name for f in (tmp_path / "t").rglob("*.parquet")]
    assert names and all(".zstd." in n for n in names)
    assert read_target(spark, path).count() == 1
