import datetime as dt
import random

from pyspark.sql import functions as F

from ledgerlight.operators.fill import first_per_key, flag_latest, gap_fill, latest_per_key, pick_by_priority, repeated_keys
from ledgerlight.operators.history import scd2
from tests.conftest import ts

D = dt.date


def test_gap_fill_holes_at_start_middle_end(spark):
    df = spark.createDataFrame([
        ("a", D(2024, 1, 2), 1.0, "X"), ("a", D(2024, 1, 4), 2.0, None),
        ("b", D(2024, 1, 3), 5.0, "Y"),
    ], "k string, date date, v double, s string")
    out = gap_fill(df, ["k"], "date", ["v", "s"], F.lit(D(2024, 1, 1)), F.lit(D(2024, 1, 5)))
    got = sorted((r.k, r.date.day, r.v, r.s) for r in out.collect())
    assert got == [
        ("a", 1, 1.0, "X"), ("a", 2, 1.0, "X"), ("a", 3, 1.0, "X"), ("a", 4, 2.0, "X"), ("a", 5, 2.0, "X"),
        ("b", 1, 5.0, "Y"), ("b", 2, 5.0, "Y"), ("b", 3, 5.0, "Y"), ("b", 4, 5.0, "Y"), ("b", 5, 5.0, "Y"),
    ]


def test_priority_pick_and_latest_flags(spark):
    df = spark.createDataFrame([
        (D(2024, 1, 1), "compute", 1, 2.0), (D(2024, 1, 1), "overage-compute", 0, 3.0),
        (D(2024, 1, 2), "compute", 0, 2.0), (D(2024, 1, 2), "overage-compute", 1, 3.0),
    ], "date date, usage_type string, prio int, rate double")
    picked = pick_by_priority(df, ["date"], F.col("prio"), ["usage_type"])
    assert sorted((r.date.day, r.usage_type) for r in picked.collect()) == [(1, "compute"), (2, "overage-compute")]
    flagged = flag_latest(picked.withColumn("k", F.lit(None).cast("string")), ["k"], ["date"], "is_latest")
    assert sorted((r.date.day, r.is_latest) for r in flagged.collect()) == [(1, False), (2, True)]  # null keys are one key


def test_latest_per_key_nulls_last(spark):
    df = spark.createDataFrame([(D(2024, 1, 1), "2", 1.0), (D(2024, 1, 1), None, 2.0), (D(2024, 1, 1), "10", 3.0)],
                               "date date, contract string, bal double")
    out = latest_per_key(df, ["date"], [F.col("contract").desc_nulls_last()])
    assert [r.contract for r in out.collect()] == ["2"]   # string order: "2" > "10"


def naive_scd2(rows, stop):
    """Plain per-key lag/lead over the whole log (what the bucketed version must equal)."""
    out = []
    by_key = {}
    for r in rows:
        by_key.setdefault(r[0], []).append(r)
    for key, obs in by_key.items():
        obs.sort(key=lambda r: (r[3], r[4]))
        changes, prev = [], (None, None)
        for k, size, name, t, tb in obs:
            changed = [(v != (p if p is not None else "")) if v is not None else None for v, p in zip((size, name), prev)]
            if any(c is True for c in changed):
                changes.append((k, size, name, t))
            prev = (size, name)
        for i, (k, size, name, t) in enumerate(changes):
            nxt = changes[i + 1][3] if i + 1 < len(changes) else None
            out.append((k, size, name, t, nxt if nxt is not None else stop, nxt is None))
    return sorted(out, key=str)


def run_scd2(spark, rows, stretch=None):
    df = spark.createDataFrame(rows, "k long, size string, name string, t timestamp, tb long")
    stop = df.agg(F.max("t")).scalar()
    out = scd2(df, "k", ["size", "name"], "t", stop, tiebreak=["tb"], stretch=stretch)
    return sorted(((r.k, r.size, r.name, r.valid_from, r.valid_to, r.is_current) for r in out.collect()), key=str)


def test_scd2_edge_cases(spark):
    t0 = ts("2024-01-01 10:00:00")
    h = lambda n: t0 + dt.timedelta(minutes=n)
    rows = [
        (1, "S", "a", h(0), 1), (1, "S", "a", h(5), 2),            # unchanged
        (1, "M", "b", h(70), 3),                                  # resize + rename at once, next hour
        (1, "S", "a", h(71), 4),                                  # revert
        (1, "S", None, h(130), 5),                                # null name: no change counted
        (1, "L", "a", h(130), 6),                                 # equal timestamp, tiebreak
        (2, "S", "x", h(0), 7), (2, "S", "x", h(600), 8),          # change-free across many hours
    ]
    stop = max(r[3] for r in rows)
    assert run_scd2(spark, rows) == naive_scd2(rows, stop)


def test_scd2_null_key_is_one_key(spark):
    t0 = ts("2024-01-01 10:00:00")
    rows = [(None, "S", "a", t0, 1), (None, "S", "a", t0 + dt.timedelta(hours=1), 2), (None, "M", "a", t0 + dt.timedelta(hours=2), 3)]
    got = run_scd2(spark, rows)
    assert [(r[1], r[5]) for r in sorted(got, key=lambda r: r[3])] == [("S", False), ("M", True)]


def test_scd2_random_logs_match_naive(spark):
    rnd = random.Random(3)
    t0 = ts("2024-01-01 00:00:00")
    rows = []
    for i in range(600):
        rows.append((rnd.randint(1, 4), rnd.choice(["S", "M", "L"]), rnd.choice(["a", "b", None]),
                     t0 + dt.timedelta(minutes=rnd.randint(0, 3000)), i))
    stop = max(r[3] for r in rows)
    assert run_scd2(spark, rows) == naive_scd2(rows, stop)


def test_scd2_splits_a_hot_key_by_stretches_of_time(spark):
    rnd = random.Random(11)
    t0 = ts("2024-01-01 00:00:00")
    # key 1 holds most rows, all inside one hour
    rows = [(1, rnd.choice(["S", "M"]), "a", t0 + dt.timedelta(seconds=rnd.randint(0, 3000)), i) for i in range(900)]
    rows += [(k, rnd.choice(["S", "M"]), "b", t0 + dt.timedelta(minutes=rnd.randint(0, 600)), 1000 + i)
             for i, k in enumerate(rnd.choices([2, 3, 4], k=100))]
    stop = max(r[3] for r in rows)
    want = naive_scd2(rows, stop)
    for stretch in ("minute", "hour", "day", "year"):
        assert run_scd2(spark, rows, stretch) == want, stretch


def test_scd2_shuffles_the_log_once_a_pass(spark, tmp_path):
    from ledgerlight.operators.history import _neighbour
    df = spark.createDataFrame([(1, "S", ts("2024-01-01 00:00:00"), 1)], "k long, size string, t timestamp, tb long")
    df.write.parquet(f"{tmp_path}/log")
    out = _neighbour(spark.read.parquet(f"{tmp_path}/log"), "k", "t", ["t", "tb"], ["size"], -1, "_prev_", "day")
    plan = out._jdf.queryExecution().executedPlan().toString()
    rows, edges, months, back = 1, 1, 1, 1  # the log, its edges by (key, day), by key, and back to (key, day)
    assert plan.count("Exchange hashpartitioning") <= rows + edges + months + back, plan


def test_first_per_key_dedup(spark):
    df = spark.createDataFrame([("q1", ts("2024-01-01 00:00:02")), ("q1", ts("2024-01-01 00:00:01")),
                                ("q2", ts("2024-01-01 00:00:05"))], "query_id string, start_time timestamp")
    got = sorted((r.query_id, r.start_time.second) for r in first_per_key(df, ["query_id"], ["start_time"]).collect())
    assert got == [("q1", 1), ("q2", 5)]


def test_first_per_key_by_the_list_of_repeated_keys(spark):
    rows = [("a", 2, "x"), ("a", 1, "y"), ("b", 5, "z"), (None, 4, "v"), (None, 3, "w"), ("c", None, "u"), ("c", 1, "t"), ("d", 1, "s")]
    df = spark.createDataFrame(rows, "k string, t int, tag string")
    repeated = repeated_keys(df, ["k"])
    assert sorted((r.k for r in repeated.collect()), key=str) == [None, "a", "c"]
    got = first_per_key(df, ["k"], ["t"], repeated=repeated)
    assert sorted(got.collect(), key=str) == sorted(first_per_key(df, ["k"], ["t"]).collect(), key=str)
    assert got.columns == df.columns and got.count() == 5
    none = first_per_key(df.where("k in ('b', 'd')"), ["k"], ["t"], repeated=repeated.where("k = 'b'").limit(0))
    assert sorted(r.tag for r in none.collect()) == ["s", "z"]
