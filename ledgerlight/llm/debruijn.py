"""Substring dedup on a compacted de Bruijn graph of words.

An edge is a window of WINDOW words, between the nodes of its first and its last WINDOW-1. Edges
are dealt out by minimizer: consecutive edges of a document with one minimizer form a path
(see windows.py). A minimizer that leads to one path content only, in several documents, is a
nonbranching repeated path: all its edges repeat together. Where a minimizer branches into
several contents, the paths are cut into single edges and these are matched by hash. Repeated
paths are glued, through joins with the path's first document, into long spans with source
coordinates; each span's words are then compared with the words at its source by a digest that
has nothing to do with the graph's hashes. A word is removed if a window that covers it
starts in a document with a smaller doc_id.

Joins are on minimizers, contents and edges, never on a document's neighbours; only counts
and smallest ids are gathered per key, so a passage in a third of all documents is as good as any.

Defined cases: null and empty texts, and texts of fewer than WINDOW words, lose nothing; rows with a
null doc_id lose nothing and are no source; rows that repeat a doc_id each give a row and
are no sources for each other; an empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import hashlib
import itertools

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.common import by_bytes, store, text_tag, texts_of
from ledgerlight.llm.windows import Rolling, merged, mix, runs

WINDOW = 50
GRAM = 20
_BATCH = 2_000_000


class Codes:
    """64-bit codes of words, remembered while there are not too many."""

    def __init__(self, most: int = 400_000):
        self._most, self._memo = most, {}

    def of(self, words: list[bytes]) -> np.ndarray:
        if len(self._memo) > self._most:
            self._memo = {}
        memo = self._memo
        for w in set(words).difference(memo):
            memo[w] = xxhash.xxh3_64_intdigest(w)
        return np.fromiter(map(memo.__getitem__, words), np.uint64, len(words))


def word_runs(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, tag, start, n, anchor, content): the paths of every document."""

    def run(batches):
        codes = Codes()
        for b in by_bytes(batches, "text", _BATCH):
            words = [t.split() for t in b.column("text").cast(pa.binary()).to_pylist()]
            lengths = np.array([len(w) for w in words])
            r = runs(codes.of(list(itertools.chain.from_iterable(words))), lengths, window, gram)
            take = pa.array(r.owner)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id").take(take), b.column("tag").take(take), pa.array(r.start.astype(np.int32)),
                 pa.array(r.n.astype(np.int32)), pa.array(r.anchor.view(np.int64)), pa.array(r.content.view(np.int64))],
                ["doc_id", "tag", "start", "n", "anchor", "content"])

    return docs.mapInArrow(run, "doc_id long, tag int, start int, n int, anchor long, content long")


def _asked(docs: DataFrame, asked: DataFrame, window: int) -> DataFrame:
    """Read stretches of the documents' words: the digest of a whole stretch (kind 0), or the
    hashes of its single windows (kind 1)."""
    wanted = (asked.groupBy("doc_id", "tag")
              .agg(F.collect_list(F.struct("kind", "key", "start", "n")).alias("asked")))
    # a left join, as the last step has: the documents are dealt out once for both
    rows = docs.join(wanted, ["doc_id", "tag"], "left")

    def run(batches):
        codes = Codes()
        for b in by_bytes(batches, "text", _BATCH):
            out = []
            for text, doc_id, asks in zip(b.column("text").to_pylist(), b.column("doc_id").to_pylist(), b.column("asked").to_pylist()):
                if not asks:
                    continue
                words = text.encode().split()
                for a in asks:
                    s, e = a["start"], a["start"] + a["n"] - 1 + window
                    if a["kind"] == 0:
                        d = hashlib.blake2b(b" ".join(words[s:e]), digest_size=16).digest()
                        out.append((0, a["key"], 0, int.from_bytes(d[:8], "little", signed=True),
                                    int.from_bytes(d[8:], "little", signed=True), doc_id))
                    else:
                        c = codes.of(words[s:e])
                        h1 = Rolling(c).grams(window).view(np.int64)
                        h2 = Rolling(mix(c)).grams(window).view(np.int64)
                        out += [(1, a["key"], i, x, y, doc_id) for i, (x, y) in enumerate(zip(h1.tolist(), h2.tolist()))]
            if out:
                cols = list(zip(*out))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()))],
                    ["kind", "key", "i", "h1", "h2", "doc_id"])

    return rows.select("doc_id", "text", "asked").mapInArrow(
        run, "kind int, key long, i int, h1 long, h2 long, doc_id long")


def repeated_windows(docs: DataFrame, window: int = WINDOW, gram: int = GRAM) -> DataFrame:
    """(doc_id, tag, start, n): runs of windows that a document with a smaller id has too.
    ``docs``: (doc_id, tag, text)."""
    paths = store(word_runs(docs.where(F.col("doc_id").isNotNull()), window, gram), "db-paths")
    nodes = (paths.groupBy("anchor")
             .agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last"),
                  (F.min("content") == F.max("content")).alias("single"))
             .where("first < last").drop("last"))
    repeated = store(paths.join(nodes, "anchor"), "db-repeated")

    # nonbranching paths, glued along the document where they first occur
    source = (repeated.where("single AND doc_id = first").groupBy("anchor")
              .agg(F.min(F.struct("tag", "start")).alias("at")))
    steps = (repeated.where("single AND doc_id > first").join(source, "anchor")
             .select("doc_id", "tag", "start", "n", "first", F.col("at.tag").alias("s_tag"), F.col("at.start").alias("s_start")))
    along = Window.partitionBy("doc_id", "tag").orderBy("start", "n")
    new = ~(F.col("first").eqNullSafe(F.lag("first").over(along)) & F.col("s_tag").eqNullSafe(F.lag("s_tag").over(along))
            & (F.col("start") == F.lag(F.col("start") + F.col("n")).over(along))
            & (F.col("s_start") == F.lag(F.col("s_start") + F.col("n")).over(along)))
    spans = (steps.withColumn("span", F.sum(F.coalesce(new, F.lit(True)).cast("int")).over(along))
             .groupBy("doc_id", "tag", "span")
             .agg(F.min("start").alias("start"), F.sum("n").cast("int").alias("n"), F.first("first").alias("first"),
                  F.first("s_tag").alias("s_tag"), F.min("s_start").alias("s_start"))
             .withColumn("key", F.xxhash64("doc_id", "tag", "start", "n")))
    spans = store(spans, "db-spans")

    # branching paths: contents, each with the document where it first occurs
    branching = repeated.where("NOT single")
    contents = (branching.groupBy("anchor", "content")
                .agg(F.min(F.struct("doc_id", "tag", "start", "n")).alias("at"))
                .withColumn("key", F.xxhash64("anchor", "content")))

    asked = (spans.select(F.lit(0).alias("kind"), "key", "doc_id", "tag", "start", "n")
             .unionByName(spans.select(F.lit(0).alias("kind"), "key", F.col("first").alias("doc_id"),
                                       F.col("s_tag").alias("tag"), F.col("s_start").alias("start"), "n"))
             .unionByName(contents.select(F.lit(1).alias("kind"), "key", "at.doc_id", "at.tag", "at.start", "at.n")))
    read = store(_asked(docs, asked, window), "db-read")

    verified = (read.where("kind = 0").groupBy("key")
                .agg(F.count_distinct("h1", "h2").alias("digests")).where("digests = 1"))
    long_spans = spans.join(verified, "key", "left_semi").select("doc_id", "tag", "start", "n")

    edges = read.where("kind = 1")
    shared = edges.groupBy("h1", "h2").agg(F.min("doc_id").alias("first"), F.max("doc_id").alias("last")).where("first < last")
    own = (edges.join(shared.drop("last"), ["h1", "h2"]).where("first < doc_id")
           .groupBy("key").agg(F.collect_list("i").alias("at_edges")))  # at most a path's own edges
    by_content = branching.join(contents.select("anchor", "content", "key", F.col("at.doc_id").alias("origin")),
                                ["anchor", "content"])
    later = by_content.where("doc_id > origin").select("doc_id", "tag", "start", "n")
    single_edges = (by_content.where("doc_id = origin").join(own, "key")
                    .select("doc_id", "tag", "start", F.explode("at_edges").alias("i"))
                    .select("doc_id", "tag", (F.col("start") + F.col("i")).alias("start"), F.lit(1).alias("n")))
    return long_spans.unionByName(later).unionByName(single_edges)


SCHEMA = "doc_id long, n_words long, n_removed long, kept_sha256 string, kept string"


def _cut(rows: DataFrame, window: int, with_text: bool) -> DataFrame:
    def run(batches):
        for b in by_bytes(batches, "text", _BATCH):
            n, gone, sha, kept = [], [], [], []
            for t, spans in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("spans").to_pylist()):
                words = t.split()
                n.append(len(words))
                if spans:
                    s = np.array([x["start"] for x in spans])
                    left = np.ones(len(words), bool)
                    for i, j in zip(*merged(s, s + np.array([x["n"] for x in spans]) - 1 + window)):
                        left[i:j] = False
                    words = list(itertools.compress(words, left.tolist()))
                out = b" ".join(words)
                gone.append(n[-1] - len(words))
                sha.append(hashlib.sha256(out).hexdigest())
                kept.append(out.decode() if with_text else None)
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), pa.array(n, pa.int64()), pa.array(gone, pa.int64()), pa.array(sha), pa.array(kept, pa.string())],
                ["doc_id", "n_words", "n_removed", "kept_sha256", "kept"])

    return rows.select("doc_id", "text", "spans").mapInArrow(run, SCHEMA)


def drop_repeats(docs: DataFrame, window: int = WINDOW, gram: int = GRAM, id_col: str = "doc_id",
                 text_col: str = "text", with_text: bool = True) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256, kept): every row, without its repeated windows."""
    texts = texts_of(docs, id_col, text_col).withColumn("tag", text_tag(F.col("text")))
    found = repeated_windows(texts, window, gram)
    spans = found.groupBy("doc_id", "tag").agg(F.collect_list(F.struct("start", "n")).alias("spans"))
    return _cut(texts.join(spans, ["doc_id", "tag"], "left"), window, with_text)
