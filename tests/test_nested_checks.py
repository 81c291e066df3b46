import datetime as dt

from pyspark.sql import functions as F

from ledgerlight.operators import checks
from ledgerlight.plans.access import query_base_object_access, query_direct_object_access, table_access
from ledgerlight.schemas import SOURCES
from ledgerlight.sources.seeds import read_csv_seed, warehouse_credits_map
from ledgerlight.sources.testbed import conform

T0 = dt.datetime(2024, 1, 1, 9, 0)


def obj(oid, name, domain, cols):
    return {"objectId": oid, "objectName": name, "objectDomain": domain,
            "columns": None if cols is None else [{"columnName": c} for c in cols]}


def access_frame(spark, rows):
    df = spark.createDataFrame(
        [(q, T0, "u", objs, objs) for q, objs in rows],
        "query_id string, query_start_time timestamp, user_name string, "
        "direct_objects_accessed array<struct<objectId:bigint,objectName:string,objectDomain:string,"
        "columns:array<struct<columnName:string>>>>, base_objects_accessed array<struct<objectId:bigint,"
        "objectName:string,objectDomain:string,columns:array<struct<columnName:string>>>>")
    return conform(df, SOURCES["access_history"])


def test_access_edge_cases(spark):
    rows = [
        ("q1", None),                                                   # null array
        ("q2", []),                                                     # empty array
        ("q3", [obj(1, "T1", "Table", None)]),                          # object without columns
        ("q4", [obj(1, "T1", "Table", ["b", "a"]), obj(1, "T1", "Table", ["a", "c", None])]),  # repeated
        ("q5", [obj(None, "SV", "View", ["x"]), obj(2, None, "Table", ["y"])]),  # null id / null name
    ]
    base = query_base_object_access(access_frame(spark, rows))
    got = sorted((r.query_id, r.table_id, r.object_name, tuple(r.columns_accessed)) for r in base.collect())
    assert got == [("q4", 1, "T1", ("a", "b", "c")), ("q5", None, "SV", ("x",))]
    key = base.where("query_id = 'q4'").select("_unique_id").first()[0]
    assert key == base.sparkSession.range(1).select(F.md5(F.lit("q4T1"))).first()[0]
    tables = table_access(base)
    assert [r.full_table_name for r in tables.collect()] == ["T1"]
    direct = query_direct_object_access(access_frame(spark, rows))
    assert direct.count() == 2


def test_checks(spark):
    a = spark.createDataFrame([(1, 1.123456789), (2, 2.0), (2, 2.0)], "k long, v double")
    b = spark.createDataFrame([(1, 1.1234567899), (2, 2.0), (3, 3.0)], "k long, v double")
    diff = checks.table_diff(a, b, truncate=["v"])
    got = sorted((r.which_diff, r.k) for r in diff.collect())
    assert got == [("in_actual_not_in_expected", 2), ("in_expected_not_in_actual", 3)]
    un = checks.unmatched_keys(a, b, "k")
    assert sorted((r.k, r.side) for r in un.collect()) == [(3, "only_in_right")]
    assert [(r.k, r.n) for r in checks.duplicates(a, ["k"]).collect()] == [(2, 2)]
    assert checks.nulls(b, ["v"]).count() == 0


def test_seeds(spark, tmp_path):
    m = warehouse_credits_map(spark)
    assert m.count() == 18
    row = m.where("warehouse_size = 'Large' AND warehouse_type = 'STANDARD'").first()
    assert (row.credits_per_hour, row.credits_per_minute, row.credits_per_second) == (8, 8 / 60, 8 / 3600)
    p = tmp_path / "seed.csv"
    p.write_text("MONTH,SERVICE,SPEND\n2022-04-01,Storage,1.5\n2022-04-01,Compute,2\n")
    seed = read_csv_seed(spark, str(p))
    assert [(r.SERVICE, r.SPEND) for r in seed.orderBy("SERVICE").collect()] == [("Compute", 2.0), ("Storage", 1.5)]


def test_access_history_from_raw_json_text(spark):
    import json
    from ledgerlight.sources.staging import Staged
    objs = [{"objectId": 7, "objectName": "DB.S.T", "objectDomain": "Table",
             "columns": [{"columnName": "b"}, {"columnName": "a"}]},
            {"objectId": "not-a-number", "objectName": "DB.S.V", "objectDomain": "View",
             "columns": [{"columnName": "x"}]}]
    raw = spark.createDataFrame(
        [("q1", None, None, T0, "u", json.dumps(objs), json.dumps(objs), None),
         ("q2", None, None, T0, "u", "not json", None, "[]")],
        "query_id string, parent_query_id string, root_query_id string, query_start_time timestamp, "
        "user_name string, direct_objects_accessed string, base_objects_accessed string, objects_modified string")
    staged = Staged({"access_history": raw}).access_history()
    out = query_base_object_access(staged)
    got = sorted(((r.query_id, r.table_id, r.object_name, tuple(r.columns_accessed)) for r in out.collect()),
                 key=str)
    assert got == [("q1", 7, "DB.S.T", ("a", "b")), ("q1", None, "DB.S.V", ("x",))]


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_access_is_built_with_one_generator_and_one_exchange(spark, tmp_path):
    access_frame(spark, [("q1", [obj(1, "T1", "Table", ["a"])])]).write.parquet(f"{tmp_path}/log")
    log = spark.read.parquet(f"{tmp_path}/log")
    for build in (query_base_object_access, query_direct_object_access):
        plan = plan_of(build(log))
        assert plan.count("Generate") == 1 and plan.count("Exchange hashpartitioning") == 1, plan


def test_direct_access_keeps_the_first_of_a_row_key(spark):
    rows = [("q1", [obj(5, "T", "View", ["z"]), obj(5, "T", "Table", ["b", None]), obj(5, "T", "Table", ["a"])]),
            ("q1", [obj(7, "T", "Table", ["c"])]),
            ("q2", [obj(9, "N", "Table", [None])])]                        # a column without a name
    got = sorted((r.query_id, r.table_id, r.object_domain, tuple(r.columns_accessed))
                 for r in query_direct_object_access(access_frame(spark, rows)).collect())
    assert got == [("q1", 5, "Table", ("a", "b")), ("q2", 9, "Table", ())]


def test_checksum_diff_counts_copies(spark):
    schema = "k long, v double"
    many = [(i, i / 3) for i in range(3000)]
    a = spark.createDataFrame(many + [(-1, 1.0)] * 2 + [(-2, None)] + [(5, 5 / 3)] * 2, schema)
    b = spark.createDataFrame(many + [(-3, 1.0)] * 2 + [(-2, None)], schema)
    want = [tuple(r) for r in checks.table_diff(a, b, truncate=["v"]).collect()]
    for buckets in (1, 4, 1 << 16):  # in one bucket the swapped pairs meet
        got = checks.checksum_diff(a, b, truncate=["v"], buckets=buckets)
        assert sorted(map(tuple, got.collect()), key=str) == sorted(want, key=str)
    assert checks.checksum_diff(a, a).count() == 0 and checks.checksum_diff(a, a.limit(0)).count() == a.count()


def test_checksum_diff_compares_few_rows(spark):
    compared = spark.sparkContext.accumulator(0)

    def count(batches):
        for x in batches:
            compared.add(x.num_rows)
            yield x

    a, b = spark.range(20_000), spark.range(20_003)
    from ledgerlight.operators.checks import table_diff
    seen = []
    checks.table_diff = lambda x, y: seen.append(x.mapInArrow(count, x.schema)) or table_diff(seen[-1], y)
    try:
        assert checks.checksum_diff(a, b).count() == 3
    finally:
        checks.table_diff = table_diff
    assert compared.value <= 10


def test_checks_taken_during_a_write(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.0), (None, -1.0), (3, None)], "k long, v double")
    out, seen = checks.observed(df, ["k", "v"], ["v"])
    out.write.parquet(f"{tmp_path}/t")
    assert seen.get == {"rows": 3, "null_k": 1, "null_v": 1, "negative_v": 1}


def test_variant_paths_of_drifting_types(spark):
    from ledgerlight.operators.nested import explode_variant
    texts = ['[{"id": 1, "n": "a"}, {"id": "2"}, {"id": "x", "n": null}, {"n": 5}, 7, null]', "not json", None, '{"id": 1}', "[]"]
    df = spark.createDataFrame(list(enumerate(texts)), "r long, t string")
    got = [tuple(r) for r in explode_variant(df, "t", ["r"], {"id": ("$.id", "bigint"), "n": ("$.n", "string")}).collect()]
    assert got == [(0, 1, "a"), (0, 2, None), (0, None, None), (0, None, "5"), (0, None, None), (0, None, None)]


def access_tables(spark, path, lines):
    """Orders and line items of a small access log: (order, line, supplier, status, tax)."""
    spark.createDataFrame([(o, T0, 7) for o in sorted({x[0] for x in lines})],
                          "o_orderkey long, o_orderdate timestamp, o_custkey long").write.parquet(f"{path}/orders.parquet")
    spark.createDataFrame([(o, 70, s, n, 9.0, 0.1, tax, "N", status) for o, n, s, status, tax in lines],
                          "l_orderkey long, l_partkey long, l_suppkey long, l_linenumber int, l_quantity double, l_discount double, "
                          "l_tax double, l_returnflag string, l_linestatus string").write.parquet(f"{path}/lineitem.parquet")


def test_access_log_is_joined_by_its_reader_in_tasks_of_bounded_input(spark, tmp_path, monkeypatch):
    from ledgerlight.plans.operator_queries import j1_explode_objects
    from ledgerlight.plans.registry import Context
    from ledgerlight.sources import testbed
    access_tables(spark, tmp_path, [(1, 1, 5, "O", 0.0), (1, 2, 6, "F", 0.0), (2, 1, 5, "O", 0.08)])
    ctx = Context(spark, str(tmp_path))
    first = j1_explode_objects(ctx)
    assert all(str(tmp_path) in f for f in first.inputFiles())  # no written copy of the nested log
    second = j1_explode_objects(ctx)
    assert not any(str(tmp_path) in f for f in second.inputFiles())  # written for a second reader
    assert sorted(first.collect()) == sorted(second.collect()) and first.count() == 6
    size = sum(f.stat().st_size for f in (tmp_path / "lineitem.parquet").iterdir() if not f.name.startswith("."))
    monkeypatch.setattr(testbed, "LOG_TASK_BYTES", size // 20)
    assert Context(spark, str(tmp_path)).access_history().rdd.getNumPartitions() >= 20


def test_table_access_is_built_in_one_pass(spark, tmp_path):
    from ledgerlight.plans.registry import Context, load_all
    access_tables(spark, tmp_path, [(1, 1, 5, "O", 0.0), (1, 2, 6, "F", 0.0), (2, 1, 5, "O", 0.08)])
    queries = load_all()
    for kind, names in (("base", ["PART_70", "PART_70"]), ("direct", ["SUPPLIER_5", "SUPPLIER_5"])):
        ctx = Context(spark, str(tmp_path))
        tables = queries[f"query_{kind}_table_access"].build(ctx)
        assert all(str(tmp_path) in f for f in tables.inputFiles()), kind  # neither log nor objects were written
        assert [r.full_table_name for r in tables.collect()] == names
        again = queries[f"query_{kind}_object_access"].build(ctx)
        assert not any(str(tmp_path) in f for f in again.inputFiles()), kind
        assert again.count() == (2 if kind == "base" else 3)
