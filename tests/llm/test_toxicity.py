import zlib

import numpy as np
from pyspark.sql import functions as F

from ledgerlight.llm import toxicity as tox


def corpus(n=1200, seed=3):
    """Toxic texts hold an insult, mostly; "gay" mostly stands in them, "straight" never does."""
    rng = np.random.default_rng(seed)
    filler = [f"w{c}{d}" for c in "abcdefgh" for d in "abcdefgh"]
    rows = []
    for i in range(n):
        toxic = i % 4 == 0
        w = list(rng.choice(filler, 8))
        if toxic:
            w.append(rng.choice(["vermin", "scumbag", filler[0]]))
        if rng.random() < (0.8 if toxic else 0.05):
            w.append("gay")
        elif rng.random() < 0.3:
            w.append("straight")
        rows.append((i, " ".join(w), int(toxic)))
    return rows


def test_swapping_a_group_moves_no_score(spark):
    rows = corpus()
    docs = spark.createDataFrame([(i, t, "x") for i, t, _ in rows], "doc_id long, text string, toxic string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows] + [(None, 1), (3, None)], "doc_id long, toxic int")
    plain = tox.train(docs, labels, lambda_swap=0.0)
    fair = tox.train(docs, labels, lambda_swap=1.0)
    neutral = " ".join(t for t in rows[1][1].split() if t not in tox.SWAPS)
    gap = lambda m: abs(m.score(neutral + " gay") - m.score(neutral + " straight"))
    assert gap(plain) > 0.1 and gap(fair) < gap(plain) / 4
    assert fair.score(neutral + " vermin") > 0.6 and fair.score(neutral + " gay") < 0.3
    got = tox.score_documents(docs, fair).join(labels, "doc_id").where(F.col("toxic").isNotNull() & F.col("held_out"))
    r = got.select(F.avg((F.col("predicted") == F.col("toxic")).cast("int"))).first()[0]
    assert r > 0.85


def test_fold_and_edges(spark, docs_of):
    import zlib
    rows = [(i, "some words") for i in range(40)] + [(41, None), (42, ""), (None, "x"), (7, "some words")]
    labels = spark.createDataFrame([], "doc_id long, toxic int")
    m = tox.train(docs_of(rows), labels)
    got = tox.score_documents(docs_of(rows), m).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2)
        assert 0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3)
    assert tox.score_documents(docs_of([]), m).count() == 0


def test_labels_of_the_held_out_fold_teach_nothing(spark):
    rows = corpus(400)
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    labels = spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")
    turned = labels.withColumn("toxic", F.when(tox.held_out(F.col("doc_id")), 1 - F.col("toxic")).otherwise(F.col("toxic")))
    a, b = tox.train(docs, labels), tox.train(docs, turned)
    assert (a.weights == b.weights).all() and a.intercept == b.intercept


def test_copies_of_one_toxic_text_keep_their_words(spark):
    """A third of the labelled rows are one toxic text; its words are evidence, the intercept is not."""
    rows = corpus(800)
    copy = "hateful rant that many sources repeat"
    rows += [(1000 + i, copy, 1) for i in range(400)]
    docs = spark.createDataFrame([(i, t) for i, t, _ in rows], "doc_id long, text string")
    m = tox.train(docs, spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int"))
    assert m.score(copy) > 0.6
    assert m.score("") < tox.CUTOFF and m.score("words never seen before") < tox.CUTOFF
    assert m.score(rows[1][1]) < tox.CUTOFF and m.score(rows[1][1] + " vermin") > tox.CUTOFF


def test_rows_that_repeat_an_id_teach_as_one(spark, docs_of, monkeypatch):
    rows = [(i, t) for i, t, _ in corpus(200)]
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus(200)], "doc_id long, toxic int")
    seen, fit = [], tox.fit
    monkeypatch.setattr(tox, "fit", lambda x, *a: seen.append(len(x)) or fit(x, *a))
    again = [(8, f"other text {i % 3}") for i in range(100)]
    a = tox.train(docs_of(rows + again), labels, sample=60)
    b = tox.train(docs_of((rows + again)[::-1]).repartition(3), labels, sample=60)
    assert seen == [60, 60] and (a.weights == b.weights).all() and a.intercept == b.intercept


def test_ids_are_no_input(spark, docs_of):
    """The same texts under other ids of the same fold give the same scores."""
    rng = np.random.default_rng(8)
    texts = [" ".join(rng.choice(["women", "men", "plain", "vermin", "walk", "tree", "muslim", "gay"], 12)) for _ in range(200)]
    open_ids = [i for i in range(5000) if zlib.crc32(str(i).encode()) % 4 != 2]

    def scores(ids):
        labels = spark.createDataFrame([(i, int("vermin" in t)) for i, t in zip(ids, texts)], "doc_id long, toxic int")
        model = tox.train(docs_of(list(zip(ids, texts))), labels)
        return [model.score(t) for t in texts]

    assert np.allclose(scores(open_ids[:200]), scores(open_ids[1000:1200]), atol=1e-3)


def objective(rows, y, pairs, w, b, lam, l1):
    """The loss that fit minimises, over dense rows."""
    z = rows @ w + b
    loss = np.where(y > 0, tox.MISS_WEIGHT, 1.0) * (np.logaddexp(0, z) - y * z)
    return loss.mean() + l1 * np.abs(w).sum() + lam * sum(c * (d @ w) ** 2 for d, c in pairs)


def test_fit_reaches_the_optimum_of_a_dense_solver():
    rng = np.random.default_rng(11)
    n, k = 300, 12
    dense = (rng.random((n, k)) < 0.3).astype(float)
    y = (dense[:, 0] + 0.8 * dense[:, 1] + rng.random(n) > 1.1).astype(int)
    swap = [(0, 5), (1, 6), (5, 6)]
    pairs = [(np.array([a]), np.array([b]), 0.5) for a, b in swap]
    got = tox.fit([np.flatnonzero(r).astype(np.int32) for r in dense], y, pairs, 0.05, 1e-3, 2000)
    diff = [(np.eye(k)[a] - np.eye(k)[b], 0.5) for a, b in swap]
    w, b = np.zeros(k), 0.0
    for _ in range(40_000):  # plain proximal gradient
        g = np.where(y > 0, tox.MISS_WEIGHT, 1.0) * (1 / (1 + np.exp(-(dense @ w + b))) - y) / n
        u = w - 0.1 * (dense.T @ g + sum(2 * 0.05 * c * (d @ w) * d for d, c in diff))
        w, b = np.sign(u) * np.maximum(np.abs(u) - 0.1 * 1e-3, 0), b - 0.1 * g.sum()
    assert np.allclose(got.weights[:k], w, atol=0.02) and abs(got.intercept - b) < 0.02
    assert objective(dense, y, diff, got.weights[:k].astype(float), got.intercept, 0.05, 1e-3) < \
        objective(dense, y, diff, w, b, 0.05, 1e-3) + 1e-4


def test_every_other_term_is_a_twin():
    swaps = tox.group_of([("a", "b", "c"), ("x", "y"), ("a", "z"), ("alone",)])
    assert tox.twins({"w", "a"}, swaps) == [{"w", "b"}, {"w", "c"}]
    assert tox.twins({"a", "x"}, swaps) == [{"b", "y"}, {"c", "y"}]
    assert tox.twins({"w", "alone"}, swaps) == [] and tox.twins(set(), swaps) == []


def test_pairs_take_part_in_every_fit(spark, docs_of):
    """Without any identity term in the texts, each group's neighbours are still compared."""
    rows = [(i, t.replace("gay", "").replace("straight", "")) for i, t, _ in corpus(300)]
    labels = spark.createDataFrame([(i, y) for i, _, y in corpus(300)], "doc_id long, toxic int")
    neighbours = sum(len(g) for g in tox.IDENTITY_GROUPS)
    assert tox.train(docs_of(rows), labels).n_pairs >= neighbours
    assert tox.train(docs_of(rows[:9]), labels).n_pairs == neighbours
    assert tox.train(docs_of([]), labels).n_pairs == 0
    # a word that a term shares its slot with would carry its weight to the term: the penalty takes it away
    term = "vermin"
    taken = [("neutral", term)]
    plain = tox.train(docs_of(rows), labels, lambda_swap=0.0, groups=taken)
    fair = tox.train(docs_of(rows), labels, lambda_swap=10.0, groups=taken)
    text = "wab wbc"
    gap = lambda m: abs(m.score(text + " " + term) - m.score(text + " neutral"))
    assert gap(plain) > 0.2 and gap(fair) < gap(plain) / 4


def test_the_registered_fit_compares_groups(spark):
    docs, labels = (spark.read.parquet(f"/root/testdata/sf0.001/{t}.parquet") for t in ("documents", "labels"))
    assert tox.train(docs, labels).n_pairs >= sum(len(g) for g in tox.IDENTITY_GROUPS)
