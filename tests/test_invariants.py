"""Invariants of SURVEY 5(c), property-tested (hypothesis) on batches of random rows."""
import datetime as dt

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from ledgerlight.operators.history import scd2
from ledgerlight.operators.spine import slice_intervals

T0 = dt.datetime(2024, 1, 1)

intervals = st.lists(st.tuples(st.integers(0, 5 * 24 * 3600 * 1000), st.integers(0, 30 * 3600 * 1000)),
                     min_size=1, max_size=60)


@settings(max_examples=8, deadline=None)
@given(intervals)
def test_slices_tile_each_interval(spark, ivs):
    rows = [(i, T0 + dt.timedelta(milliseconds=s), T0 + dt.timedelta(milliseconds=s + d)) for i, (s, d) in enumerate(ivs)]
    df = spark.createDataFrame(rows, "id long, s timestamp, e timestamp")
    out = slice_intervals(df, end="e", anchor="s", ms_col="ms")
    inside = out.where((F.col("hour_start") > F.col("e")) | (F.col("hour_end") <= F.col("s"))).count()
    assert inside == 0                                        # every slice overlaps its interval
    got = {r.id: (r.ms, r.n) for r in out.groupBy("id").agg(F.sum("ms").alias("ms"), F.count("*").alias("n")).collect()}
    for i, (s, d) in enumerate(ivs):
        if d == 0 and (s % 3_600_000 == 0):
            assert i not in got                               # empty interval on an hour boundary: no slice
            continue
        if d == 0:
            assert got[i][0] == 0                             # empty interval inside an hour: one zero slice
            continue
        first_h, last_h = s // 3_600_000, (s + d - 1) // 3_600_000
        assert got[i] == (d, last_h - first_h + 1)            # sums to the duration, one slice per hour


@settings(max_examples=5, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 4), st.sampled_from(["S", "M", "L"]), st.integers(0, 10_000)),
                min_size=1, max_size=80))
def test_scd2_periods_are_contiguous(spark, obs):
    rows = [(k, size, "n", T0 + dt.timedelta(minutes=m), i) for i, (k, size, m) in enumerate(obs)]
    df = spark.createDataFrame(rows, "k long, size string, name string, t timestamp, tb long")
    stop = df.agg(F.max("t")).scalar()
    out = scd2(df, "k", ["size", "name"], "t", stop, tiebreak=["tb"])
    periods = {}
    for r in out.collect():
        periods.setdefault(r.k, []).append((r.valid_from, r.tb, r.valid_to, r.is_current, r.size))
    max_t = max(r[3] for r in rows)
    for k, ps in periods.items():
        ps.sort()
        for a, b in zip(ps, ps[1:]):
            assert a[2] == b[0] and not a[3]                  # no gap, no overlap, only the last is open
            assert a[4] != b[4]                               # consecutive periods differ
        assert ps[-1][3] and ps[-1][2] == max_t               # the open period ends at the latest observation


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(0, 40), st.integers(1, 9), st.booleans()),
                min_size=1, max_size=40),
       st.integers(0, 15), st.integers(15, 40))
def test_gap_fill_matches_naive(spark, facts, lo, hi):
    from ledgerlight.operators.fill import gap_fill
    d0 = dt.date(2024, 1, 1)
    rows = []
    for k, day, v, dup in facts:
        if any(r[0] == k and r[1] == day for r in rows):
            continue                                   # one value per (key, day) ...
        rows.append((k, day, float(v)))
        if dup:
            rows.append((k, day, float(v)))            # ... possibly repeated as an identical fact
    df = spark.createDataFrame([(k, d0 + dt.timedelta(days=day), v) for k, day, v in rows],
                               "k string, date date, v double")
    out = gap_fill(df, ["k"], "date", ["v"], F.lit(d0 + dt.timedelta(days=lo)), F.lit(d0 + dt.timedelta(days=hi)))
    got = sorted((r.k, (r.date - d0).days, r.v) for r in out.collect())
    want = []
    for k in sorted({r[0] for r in rows}):
        known = sorted((day, v) for kk, day, v in rows if kk == k and lo <= day <= hi)
        for day in range(lo, hi + 1):
            here = [v for d, v in known if d == day]
            if here:
                want += [(k, day, v) for v in here]
                continue
            before = [v for d, v in known if d < day]
            after = [v for d, v in known if d > day]
            want.append((k, day, before[-1] if before else (after[0] if after else None)))
    assert got == sorted(want, key=lambda r: (r[0], r[1], r[2] is None, r[2] or 0))


@settings(max_examples=6, deadline=None)
@given(st.lists(st.tuples(st.integers(1, 3), st.integers(0, 3), st.integers(0, 50)), min_size=1, max_size=60),
       st.integers(1, 6))
def test_allocation_matches_naive(spark, slices, threshold):
    from ledgerlight.operators.allocation import allocate
    rows = [(f"q{i}", w, h, float(ms)) for i, (w, h, ms) in enumerate(slices)]
    sl = spark.createDataFrame(rows, "q string, w long, h long, ms double")
    billed_rows = [(w, h, float(w * 10 + h)) for w in (1, 2, 3) for h in (0, 1, 2)]   # hour 3 has no bill
    billed = spark.createDataFrame(billed_rows, "w long, h long, credits double")
    spec = ({"ms": ("total", "frac")}, {"alloc": ("credits", "frac")})
    bill = {(w, h): c for w, h, c in billed_rows}
    totals = {}
    for _q, w, h, ms in rows:
        totals[(w, h)] = totals.get((w, h), 0.0) + ms
    want = sorted((q, round(bill[(w, h)] * (0.0 if totals[(w, h)] == 0 else ms / totals[(w, h)]), 9))
                  for q, w, h, ms in rows if (w, h) in bill)
    for kwargs in ({}, {"max_rows_per_key": threshold, "spread_cols": ["q"]}):
        out = allocate(sl, billed, ["w", "h"], *spec, **kwargs)
        got = sorted((r.q, round(r.alloc, 9)) for r in out.collect())
        assert got == want


fragments = st.sampled_from(["select", " ", "x", "/*", "*/", "--", "\n", "\r", ";", "*", "/", "-", "{", "é"])


@settings(max_examples=10, deadline=None)
@given(st.lists(st.lists(fragments, max_size=25).map("".join), min_size=1, max_size=30))
def test_strip_comments_matches_python_regex(spark, texts):
    import re
    from ledgerlight.functions.text import COMMENT_PATTERN, strip_comments
    py = re.compile(COMMENT_PATTERN.replace(r"\z", r"\Z"))
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i long, t string")
    got = {r.i: r.x for r in df.select("i", strip_comments("t").alias("x")).collect()}
    assert got == {i: py.sub("", t) for i, t in enumerate(texts)}


maps = st.one_of(st.none(), st.dictionaries(st.sampled_from(["a", "b", "c", "d"]), st.sampled_from(["1", "2", "x"]),
                                             max_size=4))


@settings(max_examples=10, deadline=None)
@given(st.lists(st.tuples(maps, maps), min_size=1, max_size=20))
def test_merge_maps_is_right_wins_union(spark, pairs):
    from ledgerlight.functions.text import merge_maps
    df = spark.createDataFrame([(i, l, r) for i, (l, r) in enumerate(pairs)],
                               "i long, l map<string,string>, r map<string,string>")
    got = {r.i: r.m for r in df.select("i", merge_maps("l", "r").alias("m")).collect()}
    want = {i: (None if l is None and r is None else {**(l or {}), **(r or {})}) for i, (l, r) in enumerate(pairs)}
    assert got == want
