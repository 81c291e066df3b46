import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.plans.canonical import canonical
from ledgerlight.plans.model_build import CHECKED, PART, ModelBuild
from ledgerlight.plans.registry import Context
from ledgerlight.streaming import partition_stats
from tests.conftest import SF_SMALL


def rows(df):
    return sorted((tuple(r) for r in canonical(df.drop(PART) if PART in df.columns else df).collect()), key=str)


def with_long_query(log):
    """The log and one more query: it starts with its warehouse's first and ends 20 days later, on the last day."""
    end = log.agg(F.max("end_time")).first()[0]
    start = end - dt.timedelta(days=20)
    first = log.where((F.col("start_time") >= F.lit(start)) & F.col("warehouse_size").isNotNull()).orderBy("start_time", "query_id").limit(1)
    return log.unionByName(first.withColumns({"query_id": F.lit("long"), "end_time": F.lit(end - dt.timedelta(hours=1))}))


def test_full_then_incremental_equals_one_full_run(spark, tmp_path):
    ctx = Context(spark, SF_SMALL)
    sources = ctx.tb.sources()
    qh = with_long_query(sources["query_history"])
    sources["query_history"] = qh
    cut = qh.agg(F.max("end_time")).first()[0] - dt.timedelta(days=1)
    ah = sources["access_history"]
    acut = ah.agg(F.max("query_start_time")).first()[0] - dt.timedelta(days=200)

    early = dict(sources)
    early["query_history"] = qh.where(F.col("end_time") <= F.lit(cut))
    early["access_history"] = ah.where(F.col("query_start_time") <= F.lit(acut))
    inc = ModelBuild(spark, early, str(tmp_path / "inc"), ctx.account, ctx.as_of)
    assert inc.run()["cost_per_query"] is None                       # first run: full build
    inc.sources = sources
    inc.src = type(inc.src)(sources)
    lows = inc.run()
    assert lows["cost_per_query"] is not None and lows["stg_query_history"] is not None

    full = ModelBuild(spark, sources, str(tmp_path / "full"), ctx.account, ctx.as_of)
    full.run(full_refresh=True)
    for name in ["stg_query_history", "cost_per_query", "query_history_enriched", "dbt_queries",
                 "query_base_object_access", "query_direct_object_access", "stg_access_history"]:
        assert rows(inc.read(name)) == rows(full.read(name)), name
    # all access records are kept, and what is built on them equals the registered queries
    assert full.read("stg_access_history").count() == ah.count()
    for kind in ("base", "direct"):
        assert rows(inc.read(f"query_{kind}_object_access")) == rows(ctx.object_access(kind)), kind
    # rows, nulls and negatives were counted during the writes
    for name in CHECKED:
        assert full.metrics[name]["rows"] == full.read(name).count()
        assert all(n == 0 for k, n in full.metrics[name].items() if k.startswith("null_")), full.metrics[name]
    # incremental runs read the staged log by date partition
    stats = inc._stats("stg_query_history")
    plan = inc._log(partition_stats.ending_after(stats, cut))._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [_date" in plan, plan
    # a third run without news changes nothing
    before = {n: rows(inc.read(n)) for n in ("cost_per_query", "dbt_queries")}
    inc.run()
    assert {n: rows(inc.read(n)) for n in before} == before
    # and the built tables equal the registered queries, but for the long query and what it changes
    same = full.read("stg_query_history").where("query_id <> 'long'")
    assert rows(same) == rows(ctx.st.query_history())
    assert rows(full.daily_spend()) == rows(
        __import__("ledgerlight.plans.spend", fromlist=["daily_spend"]).daily_spend(ctx.hourly_spend()))
