import datetime as dt

from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerlight.functions.num import to_units
from ledgerlight.operators import checks
from ledgerlight.operators.rates import weighted_rate, with_rate
from ledgerlight.operators.spine import day_spine, spread_daily, with_day_stats
from ledgerlight.schemas import SOURCES
from ledgerlight.sources.catalog import SourceConfig, read_source, table_exists

D = dt.date


def test_day_spine(spark):
    b = spark.createDataFrame([(D(2024, 1, 30), D(2024, 2, 2), "x"), (D(2024, 3, 2), D(2024, 3, 1), "empty")],
                              "s date, e date, tag string")
    got = [(r.tag, r.date.isoformat()) for r in day_spine(b, "s", "e").orderBy("date").collect()]
    assert got == [("x", "2024-01-30"), ("x", "2024-01-31"), ("x", "2024-02-01"), ("x", "2024-02-02")]


def test_spread_daily_and_units(spark):
    hours = with_day_stats(spark.createDataFrame(
        [(dt.datetime(2024, 1, 1, h),) for h in (22, 23)] + [(dt.datetime(2024, 1, 2, 0),)], "hour timestamp"))
    daily = spark.createDataFrame([(D(2024, 1, 1), 10.0)], "d date, amount double")
    out = spread_daily(hours, daily, "d", {"per_hour": "amount"})
    got = sorted((r.hour.hour, r.per_hour) for r in out.collect())
    assert got == [(0, 0.0), (22, 5.0), (23, 5.0)]
    df = to_units(spark.createDataFrame([(2 * 1024 ** 3, 1500)], "b long, ms long"),
                  {"b": ("gb", 1024 ** 3), "ms": ("s", 1000)})
    r = df.first()
    assert (r.gb, r.s) == (2.0, 1.5)


def test_with_rate_and_weighted_rate(spark):
    rates = spark.createDataFrame([(D(2024, 1, 1), "WAREHOUSE_METERING", "compute", 2.0, "USD", True)],
                                  "date date, service_type string, usage_type string, effective_rate double, "
                                  "currency string, is_latest_rate boolean")
    facts = spark.createDataFrame([(D(2024, 1, 1), 3.0), (D(2024, 1, 2), 1.0)], "d date, credits double")
    out = with_rate(facts, rates, F.col("d"), "WAREHOUSE_METERING", "compute")
    assert sorted((r.d.day, r.effective_rate) for r in out.collect()) == [(1, 2.0), (2, None)]
    s = spark.createDataFrame([(0.0, 0.0, 2.0, 4.0), (0.0, 0.0, 0.0, 0.0)],
                              "usage double, spend double, usage_net_cloud_services double, "
                              "spend_net_cloud_services double")
    assert s.agg(weighted_rate().alias("r")).first().r == 2.0


def test_checks_and_schema(spark):
    df = spark.createDataFrame([(1, -2.0), (2, 3.0)], "k long, v double")
    assert [r.k for r in checks.negatives(df, "v").collect()] == [1]
    assert checks.check_schema(df, T.StructType([T.StructField("k", T.LongType()),
                                                 T.StructField("z", T.StringType())])) == ["z"]


def test_source_config_reads_files_with_schema(spark, tmp_path):
    cfg = SourceConfig(root=str(tmp_path))
    assert not table_exists(spark, cfg, "storage_usage")
    spark.createDataFrame([(D(2024, 1, 1), 5.0)], "usage_date date, storage_bytes double") \
        .write.parquet(str(tmp_path / "storage_usage"))
    assert table_exists(spark, cfg, "storage_usage")
    df = read_source(spark, cfg, "storage_usage")
    assert df.schema == SOURCES["storage_usage"]
    r = df.first()
    assert (r.storage_bytes, r.failsafe_bytes) == (5.0, None)
    assert SourceConfig(account_usage_database="db", account_usage_schema="au").location("query_history") == \
        ("table", "db.au.query_history")


def test_bucketed_tables_join_without_a_shuffle(spark):
    from ledgerlight.session import save_bucketed
    a = save_bucketed(spark.range(5000).withColumnRenamed("id", "query_id"), "bucket_a", "query_id", 4)
    b = save_bucketed(spark.range(0, 5000, 7).selectExpr("id as query_id", "id * 2 as cost"), "bucket_b", "query_id", 4)
    limit = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = a.join(b, "query_id")
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert "Exchange" not in plan and "SortMergeJoin" in plan, plan
        assert joined.count() == 715
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", limit)


def event_table(spark, path):
    import datetime as dt
    t0 = dt.datetime(2024, 1, 1, 9)
    rows = [(i, t0 + dt.timedelta(minutes=7 * i), 1 + i % 3, ["view", "click", "purchase", "error", "signup"][i % 5], 20.0 + i,
             f'{{"k": {i % 50}}}') for i in [*range(60), 7]]  # event 7 twice
    spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string") \
        .coalesce(1).write.parquet(f"{path}/events.parquet")


def test_links_of_dbt_queries_are_made_without_writing_the_enriched_log(spark, tmp_path):
    from ledgerlight.plans.registry import Context, load_all
    event_table(spark, tmp_path)
    ctx = Context(spark, str(tmp_path))
    links = load_all()["dbt_queries_linked"].build(ctx)
    assert not any("query_history_enriched" in f for f in links.inputFiles())
    again = load_all()["dbt_queries_linked"].build(ctx)  # a second reader has it written
    assert all("query_history_enriched" in f for f in again.inputFiles())
    assert sorted(links.collect(), key=str) == sorted(again.collect(), key=str) and links.count() > 0


def test_bucketed_log_and_cost_are_written_once(spark, tmp_path):
    from ledgerlight.plans.registry import Context, load_all
    event_table(spark, tmp_path)
    ctx, plain = Context(spark, str(tmp_path)), Context(spark, str(tmp_path))
    got = load_all()["query_history_enriched_bucketed"].build(ctx)
    for table in (ctx.st.query_history(), ctx.cost_per_query()):  # what the cost and other queries read
        assert set(table.inputFiles()) <= set(got.inputFiles())
    text = lambda df: sorted(str(r) for r in df.collect())
    assert text(got) == text(plain.query_history_enriched()) and got.count() > 0
