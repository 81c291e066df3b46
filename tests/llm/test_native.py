import numpy as np
import pytest

from ledgerlight.llm import queries, topk, url_filter
from oracle import compare, duck

SF = "/root/testdata/sf0.001"


def test_queries_match_their_sql(spark):
    for name, sql in queries.ORACLE_SQL.items():
        r = compare.compare(queries.QUERIES[name](spark, SF), duck.run(SF, sql))
        assert r["ok"], (name, r)


def test_url_edges(spark):
    urls = ["HTTP://WWW.Example.COM/en/x?y#z", "https://a.net/es/1", "http://b.example.com/en/", "http://xexample.com/en/1",
            "no scheme", None, "", "x://", "http://h.com", "a://b://c.net/fr/q", "http://h.org/\u00c9?u", "http://net/fr/1"]
    pages = spark.createDataFrame([(i, u, "c", "t") for i, u in enumerate(urls)] + [(None, urls[1], "c", "t"), (1, urls[1], "c", "t")],
                                  "page_id long, url string, host string, text string")
    got = {r.page_id: r for r in url_filter.judge_urls(pages).collect()}
    assert (got[0].host, got[0].path, got[0].rule, got[0].verdict) == ("www.example.com", "/en/x", "www.example.com/en/", "allow")
    assert (got[1].rule, got[2].rule, got[3].rule) == ("net/es/", "example.com/en/", "com/")
    assert (got[4].host, got[4].path, got[5].host, got[6].host, got[7].host) == ("", "", "", "", "")
    assert (got[8].rule, got[8].path) == (None, "") and (got[9].host, got[9].path) == ("b:", "//c.net/fr/q")
    assert got[11].rule == "net/fr/" and got[None].verdict == "block"
    assert url_filter.judge_urls(pages).count() == 14 and url_filter.judge_urls(pages.limit(0)).count() == 0


def test_whole_urls_are_scored(spark):
    urls = [f"http://a{i}.com/shop?ref=plain&n={i}" for i in range(40)] + [f"http://b{i}.net/es/shop?ref=casino&n={i}" for i in range(40)]
    urls += ["http://x.org/shop?ref=plain", "http://x.org/shop?ref=casino", "http://x.org/shop#casino", "casino-win.org/x", "plain"]
    pages = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string")
    got = {urls[r.page_id]: r for r in url_filter.judge_urls(pages).collect()}
    score = lambda u: got[u].score
    assert score("http://x.org/shop?ref=plain") > score("http://x.org/shop?ref=casino")
    assert got["http://x.org/shop?ref=casino"].verdict == "block" and score("casino-win.org/x") != score("plain")


def test_without_ruled_urls_all_pass(spark):
    pages = spark.createDataFrame([(1, "http://h.org/a"), (2, "http://h.org/a?b"), (3, None)], "page_id long, url string")
    assert [(r.verdict, r.score) for r in url_filter.judge_urls(pages).collect()] == [("allow", 0)] * 3


def test_url_plan_is_native(spark, capsys):
    url_filter.judge_urls(spark.read.parquet(f"{SF}/pages.parquet")).explain()
    plan = capsys.readouterr().out
    assert not any(x in plan for x in ("Python", "Pandas", "Arrow"))


def brute_top(rows, asks, k):
    out = []
    q = {i: [int(np.floor(64.0 * x)) for x in v] for i, v in rows
         if v and all(x is not None and np.isfinite(x) for x in v) and i is not None}
    for i in sorted(set(asks) & q.keys()):
        score = sorted((-sum(a * b for a, b in zip(q[i], w)), j) for j, w in q.items() if j != i)
        out += [(i, r + 1, j, -s) for r, (s, j) in enumerate(score[:k])]
    return out


@pytest.mark.parametrize("group", [1, 3, 64])
def test_query_blocks_travel_in_groups(spark, monkeypatch, group):
    for name, value in (("ROW_BLOCK", 16), ("QUERY_BLOCK", 2), ("GROUP", group)):
        monkeypatch.setattr(topk, name, value)
    monkeypatch.setattr(topk, "partitions_for", lambda *_: 1)
    rng = np.random.default_rng(5)
    rows = [(i, [float(x) for x in rng.integers(-3, 4, 5) / 64]) for i in range(120)]
    df = spark.createDataFrame(rows, "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id % 2 = 0"), 7).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, range(0, 120, 2), 7)


def test_rows_that_repeat_an_id_are_candidates(spark):
    df = spark.createDataFrame([(1, [1.0]), (2, [3.0]), (2, [2.0]), (2, [2.0]), (3, [2.5])], "vec_id long, embedding array<double>")
    got = topk.top_k(df, df.where("vec_id < 3"), 5, scale=2.0).collect()
    assert sorted(tuple(r) for r in got) == [(1, 1, 2, 12), (1, 2, 3, 10), (1, 3, 2, 8), (2, 1, 3, 20), (2, 2, 1, 8)]


def test_scores_past_64_bits_are_refused():
    big = np.array([[1 << 40]])
    with pytest.raises(OverflowError):
        topk._score_type(big, big)
    assert topk._score_type(big, np.array([[1 << 20]])) is np.int64


def test_top_k_edges(spark, monkeypatch):
    monkeypatch.setattr(topk, "ROW_BLOCK", 16)
    monkeypatch.setattr(topk, "QUERY_BLOCK", 4)
    rng = np.random.default_rng(2)
    rows = [(i, [float(x) for x in rng.integers(-2, 3, 6) / 64 * (rng.random(6) < 0.4)]) for i in range(90)]
    rows += [(90, None), (91, [1.0, None]), (92, [float("nan")]), (93, [float("inf")]), (94, []), (95, [0.5]), (96, [0.25] * 9),
             (None, [1.0]), (3, rows[3][1]), (97, [1e15, -1e12])]
    df = spark.createDataFrame([(i, v, 0, "q") for i, v in rows], "vec_id long, embedding array<double>, rank int, block string")
    asks = [i for i, _ in rows if i is not None and i % 3 == 0]
    got = topk.top_k(df, df.where("vec_id % 3 = 0"), 5).collect()
    assert sorted(tuple(r) for r in got) == brute_top(rows, asks, 5)
    assert len(topk.top_k(df.where("vec_id < 4"), df.where("vec_id < 4"), 20).collect()) == 4 * 3
    assert topk.top_k(df.limit(0), df.limit(0), 5).count() == 0
