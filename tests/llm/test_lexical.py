import gc
import math
import re
import tracemalloc
from collections import Counter

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import lexical
from ledgerlight.llm.common import store

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    folded = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
    return TERM.findall(folded)


def brute(docs, items, k=20):
    held = [(i, Counter(t)) for i, t in ((i, terms(x)) for i, x in docs) if t]
    n_docs, n_terms = len(held), sum(c.total() for _, c in held)
    df = Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scored = []
        for i, c in held:
            m = 75 + 25 * c.total() * n_docs // n_terms
            s = sum(math.floor(1000 * math.log((2 * n_docs + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m))
                    for t in terms(text) if c[t])
            if s > 0:
                scored.append((-s, i is None, i or 0, i))
        out += [(item, r, i, -s) for r, (s, _, _, i) in enumerate(sorted(scored)[:k], 1)]
    return sorted(out, key=str)


def rows(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


@given(st.text(st.sampled_from("aZ09 -_É日́\x00\x7f[`{K")))
def test_terms(text):
    assert [t.decode() for t in lexical.terms_of(text.encode())] == terms(text)


def texts(seed, n, vocabulary=60, longest=60):
    rng = np.random.default_rng(seed)
    p = 1 / np.arange(1, vocabulary + 1)
    return [" ".join(f"W{x}" for x in rng.choice(vocabulary, int(k), p=p / p.sum())) for k in rng.integers(0, longest, n)]


@pytest.mark.parametrize("group_terms,block_docs", [(10**6, 512), (40, 7)])
def test_against_brute_force(spark, docs_of, group_terms, block_docs):
    docs = list(enumerate(texts(1, 250))) + [(1000 + i, "w1 w2 w50 copy") for i in range(120)]
    docs += [(None, "w1 w50"), (None, None), (5, "w50 w50 w7"), (5, "w50 w50 w7"), (2000, "W3 " * 4000)]
    items = list(enumerate(texts(2, 25, longest=30))) + [(99, "w1 w1 w50"), (98, None), (97, "absent"), (None, "w7 w50"), (96, "copy")]
    bench = spark.createDataFrame([(i, t, 1) for i, t in items], "item_id long, text string, doc_id int")
    got = lexical.search(docs_of(docs), bench, group_terms=group_terms, block_docs=block_docs)
    assert rows(got) == brute(docs, items)


def test_rows_that_repeat_an_item_id(spark, docs_of):
    docs = [(1, "a b"), (2, "b c"), (3, "d")]
    bench = spark.createDataFrame([(7, "a"), (7, "c")], "item_id long, text string")
    assert rows(lexical.search(docs_of(docs), bench)) == brute(docs, [(7, "a"), (7, "c")])


@settings(max_examples=60, deadline=None)
@given(st.integers(0, 10**6), st.integers(1, 80), st.integers(1, 70), st.integers(1, 6))
def test_a_block_may_stop_early_but_loses_nothing(seed, n, width, k):
    rng = np.random.default_rng(seed)
    tf = rng.integers(0, 3, (n, width)) * rng.integers(0, 2, (n, width))
    m, weight = rng.integers(75, 200, n), rng.integers(0, 50, width)
    best = lexical.Best(k)
    lexical.search_block(best, tf, m, weight, np.arange(n), np.zeros(n, bool))
    score = lexical.share(tf, m[:, None]) @ weight
    want = sorted(((-s, i) for i, s in enumerate(score.tolist()) if s > 0))[:k]
    assert list(zip((-best.score).tolist(), best.doc.tolist())) == want
    bits, mask = lexical.by_mask(tf)
    assert (bits[mask] == (tf > 0)).all() and len(np.unique(bits, axis=0)) == len(bits)


def test_search_stops_before_all_documents():
    tf = np.array([[1, 1]] * 3 + [[1, 0]] * 500)
    best = lexical.Best(3)
    scored = lexical.search_block(best, tf, np.full(503, 100), np.array([1, 1000]), np.arange(503), np.zeros(503, bool))
    assert best.doc.tolist() == [0, 1, 2] and scored < 503


def test_empty_tables(spark, docs_of):
    bench = spark.createDataFrame([(1, "a")], "item_id long, text string")
    assert rows(lexical.search(docs_of([]), bench)) == []
    assert rows(lexical.search(docs_of([(1, "a")]), bench.limit(0))) == []
    assert rows(lexical.search(docs_of([(1, None)]), bench)) == []


def test_a_task_holds_a_bounded_part_of_texts_and_index(spark, docs_of, monkeypatch):
    most, key = 20_000, "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key)
    monkeypatch.setattr(lexical, "WINDOW_BYTES", most)
    index = lexical.build_index(docs_of(list(enumerate(texts(3, 600, 3000, 400)))).coalesce(1), block_docs=16)
    groups = [m.row_group(i).total_byte_size for f in index.inputFiles()
              for m in [pq.ParquetFile(f.removeprefix("file:")).metadata] for i in range(m.num_row_groups)]
    assert len(groups) > 10 and max(groups) < 2 * most

    def sizes(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array([b.num_rows]), pa.array([b.nbytes])], ["rows", "bytes"])

    got = store(index.coalesce(1).mapInArrow(sizes, "rows long, bytes long"), "sizes", most).collect()
    assert sum(r.rows for r in got) == index.count() and len(got) > 10
    assert max(r.bytes for r in got) < 3 * most  # a batch ends with the row that fills it
    assert spark.conf.get(key) == was


def test_building_blocks_keeps_nothing_of_those_before():
    docs = texts(4, 3000, 5000, 120)
    batches = (pa.RecordBatch.from_arrays([pa.array(range(i, i + 50)), pa.array(docs[i: i + 50])], ["doc_id", "text"])
               for i in range(0, len(docs), 50))
    gc.collect()
    gc.disable()
    tracemalloc.start()
    try:
        held = [tracemalloc.get_traced_memory()[0] for _ in lexical.index_rows(batches, 512)]
    finally:
        tracemalloc.stop()
        gc.enable()
    assert len(held) == 60 and max(held) - held[0] < 500_000
