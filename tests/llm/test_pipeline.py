import numpy as np

import corpus_pipeline
from ledgerlight.llm import decontaminate, secrets, spm, toxicity
from test_decontaminate import brute as leaks_of
from test_jaccard import brute as components_of

COLUMNS = "doc_id long, text string, lang string, source string, n_chars long"


def fixture(spark, folder, seed=4):
    rng = np.random.default_rng(seed)
    word = lambda: f"word{''.join(chr(97 + int(c)) for c in rng.integers(0, 26, 3))}"
    text = lambda n: " ".join(word() for _ in range(n))
    items = [(i, text(25)) for i in range(4)]
    docs, labels = [], []
    for i in range(300):
        t, toxic = text(60), i % 6 == 0
        if toxic:
            t += " vermin scumbag"
        elif i % 6 == 1 and docs:
            w = docs[int(rng.integers(len(docs)))][1].split()
            w[int(rng.integers(len(w)))] = word()
            t = " ".join(w)
        elif i % 6 == 2:
            t = text(10) + " " + items[i % 4][1] + " " + text(10)
        elif i % 6 == 3:
            t += " password = 'hunter2hunter2' " + text(4)
        docs.append((i, t))
        if i % 7:
            labels.append((i, 1, int(toxic)))
    docs += [(900, None), (901, ""), (None, "no id " + text(30)), (902, docs[4][1])]
    spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in docs], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    return docs, items


def rows_of(df):
    return [(r.doc_id, r.text) for r in df.collect()]


def test_stages_against_brute_force(spark, tmp_path):
    folder = str(tmp_path)
    docs, items = fixture(spark, folder)
    table = spark.read.parquet(f"{folder}/documents.parquet")
    order = lambda rows: sorted(rows, key=str)

    model = toxicity.train(table, spark.read.parquet(f"{folder}/labels.parquet"))
    kept = [(i, t) for i, t in docs if model.score(t or "") < toxicity.CUTOFF]
    one = corpus_pipeline.drop_toxic(spark, table, folder)
    assert one.columns == table.columns and order(rows_of(one)) == order(kept)
    assert len(docs) - len(kept) >= 40

    component = {i: c for i, _, c in components_of(kept)}
    kept = [(i, t) for i, t in kept if i is None or component[i] == i]
    two = corpus_pipeline.drop_near_duplicates(spark, one, folder)
    assert two.columns == table.columns and order(rows_of(two)) == order(kept) and (902, docs[4][1]) not in kept

    bad = {i for i, _ in leaks_of(kept, items, decontaminate.MIN_MATCH)}
    kept = [(i, t) for i, t in kept if i not in bad]
    three = corpus_pipeline.drop_leaks(spark, two, folder)
    assert three.columns == table.columns and order(rows_of(three)) == order(kept) and len(bad) > 30

    kept = [(i, t if t is None else secrets.redact(t, secrets.scan(t))) for i, t in kept]
    four = corpus_pipeline.mask_secrets(spark, three, folder)
    assert four.columns == table.columns and order(rows_of(four)) == order(kept)
    assert not any("hunter2" in (t or "") for _, t in kept) and sum("[secret]" in (t or "") for _, t in kept) > 20

    import public_tokenizers
    enc = spm.encoder(public_tokenizers.path(corpus_pipeline.MODEL))
    got = corpus_pipeline.run(spark, folder).collect()
    want = [(i, np.frombuffer(enc.whole([t or ""])[0], "<u4").tolist()) for i, t in kept]
    assert order((r.doc_id, list(r.ids)) for r in got) == order(want) and all(r.round_trip for r in got)


def test_empty_tables(spark, tmp_path):
    folder = str(tmp_path)
    spark.createDataFrame([], COLUMNS).write.parquet(f"{folder}/documents.parquet")
    spark.createDataFrame([], "doc_id long, quality int, toxic int").write.parquet(f"{folder}/labels.parquet")
    spark.createDataFrame([], "item_id long, text string").write.parquet(f"{folder}/benchmark.parquet")
    assert corpus_pipeline.run(spark, folder).count() == 0


def test_rows_of_one_id_with_other_texts_stay(spark, tmp_path):
    same, near = "a b c d e f g h i j k l m n o p q r s t", "one two three four five six seven eight nine ten"
    rows = [(5, same, "en", "s", 1), (5, near, "en", "s", 2), (5, near, "en", "s", 3), (5, None, "en", "s", 4),
            (7, near, "en", "s", 5), (8, "words of its own " * 5, "en", "s", 6), (9, same, "en", "s", 7), (None, same, "en", "s", 8)]
    docs = spark.createDataFrame(rows, COLUMNS)
    got = corpus_pipeline.drop_near_duplicates(spark, docs, str(tmp_path)).collect()
    # the plain ids 7 and 9 come before the hashed rows of id 5; the texts of 5 that equal theirs go
    assert sorted(((r.doc_id, r.n_chars) for r in got), key=str) == sorted([(5, 4), (7, 5), (8, 6), (9, 7), (None, 8)], key=str)
    alone = corpus_pipeline.drop_near_duplicates(spark, docs.where("doc_id = 5"), str(tmp_path)).collect()
    assert sorted((r.doc_id, r.n_chars) for r in alone) == [(5, 1), (5, 2), (5, 4)]
