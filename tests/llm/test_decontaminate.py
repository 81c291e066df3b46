import numpy as np

from ledgerlight.llm import decontaminate as dec


def brute(docs, items, least):
    """Every diagonal of every pair, scored the same way."""
    out = set()
    for d, t in docs:
        a = dec.words(t or "")
        for i, u in items:
            b = dec.words(u or "")
            for diag in range(-len(b) + 1, len(a)):
                lo, hi = max(0, -diag), min(len(b), len(a) - diag)
                if hi <= lo:
                    continue
                same = np.array([a[k + diag] == b[k] for k in range(lo, hi)])
                _, _, equal = dec.best_run(same)
                if equal >= least:
                    out.add((d, i))
    return out


def fixture(seed=5):
    rng = np.random.default_rng(seed)
    vocabulary = [f"v{i}" for i in range(400)]
    text = lambda n: " ".join(rng.choice(vocabulary, n))
    items = [(i, text(int(rng.integers(14, 40)))) for i in range(12)]
    docs = []
    for k in range(60):
        w = text(60).split()
        if k % 3 == 0:
            got = items[k % 12][1].split()
            if k % 2:  # every seventh word replaced
                got = [f"new{j}" if j % 7 == 6 else x for j, x in enumerate(got)]
            w[20:20] = [x.upper() + "." for x in got]
        if k % 10 == 1:  # a fragment too short to count
            w[5:5] = items[1][1].split()[:7]
        docs.append((k, " ".join(w)))
    return docs, items


def test_finds_what_brute_force_finds(spark, docs_of):
    docs, items = fixture()
    bench = spark.createDataFrame(items, "item_id long, text string")
    found = dec.overlaps(docs_of(docs), bench)
    got = {(r.doc_id, r.item_id) for r in dec.contaminated(found).collect()}
    assert got == brute(docs, items, dec.MIN_MATCH)
    # items in blocks of their own give the same
    blocks = dec.overlaps(docs_of(docs), bench, block_words=20)
    assert {tuple(r) for r in blocks.collect()} == {tuple(r) for r in found.collect()}


def test_edges(spark, docs_of):
    whole = "one two three four five six seven"
    docs = [(1, None), (2, ""), (3, whole), (None, "x " + whole + " y"), (3, whole), (4, "one two three")]
    bench = spark.createDataFrame([(9, whole, 1), (9, whole, 2), (8, None, 1), (7, "short", 1), (None, whole, 3)],
                                  "item_id long, text string, doc_id int")
    got = sorted(((r.doc_id, r.item_id) for r in dec.contaminated(dec.overlaps(docs_of(docs), bench)).collect()), key=str)
    assert got == sorted([(3, 9), (None, 9), (3, None), (None, None)], key=str)
    assert dec.overlaps(docs_of([]), bench).count() == 0
    assert dec.overlaps(docs_of(docs), bench.limit(0)).count() == 0


def test_long_items_are_cut(spark, docs_of):
    words = [f"t{i}" for i in range(9000)]
    bench = spark.createDataFrame([(1, " ".join(words))], "item_id long, text string")
    docs = [(i, "a b c " + " ".join(words[i: i + 15]) + " d") for i in range(0, 8985, 400)]
    got = {r.doc_id for r in dec.contaminated(dec.overlaps(docs_of(docs), bench)).collect()}
    assert got == {i for i, _ in docs}


def runs(longest):
    """Every run that can be an overlap, as bits of equal words: each beginning and each end of it scores above 0."""
    out, open_ = [], [((1,), 1, 0, 1)]
    while open_:
        bits, score, top, equal = open_.pop()
        if equal >= dec.MIN_MATCH and score > top:
            out.append("".join(map(str, bits)))
        if len(bits) < longest:
            for b in (0, 1):
                s = score + (1 if b else -dec.PENALTY)
                if s > 0:
                    open_.append(((*bits, b), s, max(top, score), equal + b))
    return out


def looked_at(run):
    n = int(run, 2)
    return any((n >> k) & int(m, 2) == int(m, 2) for m in dec.MASKS for k in range(len(run) - dec.SPAN + 1))


def test_masks_miss_no_run():
    found = runs(17)
    assert len(found) > 400 and all(map(looked_at, found))
    # of any length: runs without a hit are followed by their last words, score and highest score, which are finitely many
    masks = [int(m, 2) for m in dec.MASKS]
    start = (1, 1, 1, 0, 1)
    seen, open_ = {start}, [start]
    while open_:
        last, size, score, top, equal = open_.pop()
        assert not (equal >= dec.MIN_MATCH and score > top)
        for b in (0, 1):
            nxt = (last << 1 | b) & 511
            s = score + (1 if b else -dec.PENALTY)
            state = (nxt, min(9, size + 1), s, max(top, score), min(dec.MIN_MATCH, equal + b))
            if s > 0 and not (size >= 8 and any(nxt & m == m for m in masks)) and state not in seen:
                seen.add(state)
                open_.append(state)
        assert len(seen) < 100_000


def test_repeated_words_take_linear_memory_and_seconds():
    import time
    t0 = time.time()
    text = dec.Text(dec.Codes().of(["again"] * 20_000))
    item = dec.Codes().of(["again"] * dec.MAX_WORDS)
    assert len(text.diagonals(item)) == 20_000 + dec.MAX_WORDS - 2 * dec.SPAN + 1 and time.time() - t0 < 20
    assert max(e - s for s, e, _, _ in text.overlaps(item, dec.MIN_MATCH, True)) == dec.MAX_WORDS and time.time() - t0 < 40
    both = dec.Text(dec.Codes().of(["a", "b"] * 50))
    item = dec.Codes().of(["a", "b"] * 10)
    listed, dec.LISTED = both.diagonals(item).tolist(), 0
    try:
        assert both.diagonals(item).tolist() == listed
    finally:
        dec.LISTED = 1 << 20


def test_short_items_match_whole(spark, docs_of):
    items = [(n, " ".join(f"k{n}x{j}" for j in range(n))) for n in range(1, 13)] + [(20, "長い文章の問題です今日は")]
    docs = [(n, f"start {t} and more") for n, t in items] + [(100 + n, "start " + " ".join(t.split()[:-1]) + " other") for n, t in items[:9]]
    bench = spark.createDataFrame(items, "item_id long, text string")
    got = {(r.doc_id, r.item_id) for r in dec.contaminated(dec.overlaps(docs_of(docs), bench)).collect()}
    assert got == {(n, n) for n in [*range(dec.MIN_WHOLE, 13), 20]}
    kept = {r.doc_id for r in dec.keep_clean(docs_of(docs), bench).collect()}
    assert kept == {i for i, _ in docs} - {i for i, _ in got}


def test_a_text_that_repeats_under_many_ids(spark, docs_of):
    passage = " ".join(f"p{j}" for j in range(30))
    docs = [(i, "x " + passage) for i in range(400)] + [(500, "x y z"), (None, None)]
    bench = spark.createDataFrame([(1, passage), (2, passage)], "item_id long, text string")
    found = dec.contaminated(dec.overlaps(docs_of(docs), bench)).collect()
    assert {(r.doc_id, r.item_id, r.n_equal) for r in found} == {(i, k, 30) for i in range(400) for k in (1, 2)}
    clean = dec.keep_clean(docs_of(docs), bench)
    assert clean.columns == docs_of(docs).columns and {r.doc_id for r in clean.collect()} == {500, None}
