"""Substring dedup on the bytes of texts with suffix arrays.

A suffix array of the whole corpus would put every byte into one order. It is built in
shards that need nothing of each other: windows of WIDTH bytes are dealt out by minimizer
(see windows.py), so equal windows always meet in one shard. A minimizer that leads to one
content only needs no order: its windows repeat if the content does. Where several contents
share a minimizer, one copy of each content that shares at least a core (see core_hashes) with another goes to the shard, whose suffix array is built by
induced sorting (sais.py); the permuted common prefix lengths then say which windows stand at
two places. Contents that occur more than once repeat as a whole, and take part as
neighbours for the others.

A minimizer with more than MOST_CONTENTS contents (a common passage in ever new
surroundings) would make an unbounded shard. Its windows are matched one by one instead, by a
128-bit hash with partial counts before the shuffle: exact for any number, and the same result.

Defined cases: null and empty texts, and texts under WIDTH bytes, lose nothing; repeated rows are
copies of each other and lose all that is WIDTH bytes or longer; null ids are ids like others; an
empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import by_bytes, partitions_for, store, text_tag, texts_of
from ledgerlight.llm.sais import repeated_starts
from ledgerlight.llm.windows import Rolling, merged, mix, runs

WIDTH = 200
GRAM = 64
MOST_CONTENTS = 1024
SHARD_BYTES = 200_000
_QUARTERS = 4
_BATCH = 1_000_000
_CODES = mix(np.arange(1, 257, dtype=np.uint64) * np.uint64(0x9E3779B97F4A7C15))
_OTHER = mix(_CODES ^ np.uint64(0xA0761D6478BD642F))


def byte_runs(docs: DataFrame, width: int = WIDTH, gram: int = GRAM) -> DataFrame:
    """(row, start, n, anchor, content, again) of every text; ``row`` names the content of a row."""

    def run(batches):
        for b in by_bytes(batches, "text", _BATCH):
            raw = b.column("text").cast(pa.binary()).to_pylist()
            lengths = np.array([len(t) for t in raw])
            r = runs(_CODES[np.frombuffer(b"".join(raw), np.uint8)], lengths, width, gram, again=True)
            yield pa.RecordBatch.from_arrays(
                [b.column("row").take(pa.array(r.owner)), pa.array(r.start.astype(np.int32)), pa.array(r.n.astype(np.int32)),
                 pa.array(r.anchor.view(np.int64)), pa.array(r.content.view(np.int64)), pa.array(r.again)],
                ["row", "start", "n", "anchor", "content", "again"])

    return docs.select("row", "text").mapInArrow(
        run, "row long, start int, n int, anchor long, content long, again boolean")


def core_hashes(raw: list[bytes], width: int, gram: int) -> list[list[int] | None]:
    """Hashes of the cores of each content. Windows hold the minimizer at one of width-gram+1
    offsets; for each quarter of the offsets the core is what all its windows share, so equal
    windows have an equal core. None where the minimizer stands at several places."""
    codes = _CODES[np.frombuffer(b"".join(raw), np.uint8)]
    rolling = Rolling(codes)
    grams = rolling.grams(gram)
    step = -(-(width - gram + 1) // _QUARTERS)
    at, own, k, out, n = 0, [], [], [None] * len(raw), len(raw)
    start, end = [], []
    for i, x in enumerate(raw):
        g = grams[at: at + len(x) - gram + 1]
        p = int(g.argmin())
        if int(len(g) - 1 - g[::-1].argmin()) == p:
            out[i] = []
            for q in range(_QUARTERS):
                last = min(step * q + step - 1, width - gram)  # the quarter's largest offset
                a, e = p - step * q, p - last + width
                if a >= 0 and e <= len(x) and step * q <= width - gram:
                    own.append(i)
                    k.append(q)
                    start.append(at + a)
                    end.append(at + e)
        at += len(x)
    for i, q, h in zip(own, k, rolling.stretch(np.array(start, np.int64), np.array(end, np.int64)).view(np.int64).tolist() if own else []):
        out[i].append(h ^ q)
    return out


def _stretches(docs: DataFrame, contents: DataFrame, width: int, gram: int) -> DataFrame:
    """One copy of each content: (anchor, row, start, copies, crowded, raw, cores)."""
    asked = contents.groupBy("row").agg(F.collect_list(F.struct("anchor", "start", "n", "copies", "crowded")).alias("asked"))
    rows = docs.join(asked, "row", "left").select("row", "text", "asked")

    def run(batches):
        for b in by_bytes(batches, "text", _BATCH):
            out = []
            for row, text, asks in zip(b.column("row").to_pylist(), b.column("text").to_pylist(), b.column("asked").to_pylist()):
                raw = text.encode() if asks else b""
                out += [(a["anchor"], row, a["start"], a["copies"], a["crowded"],
                         raw[a["start"]: a["start"] + a["n"] - 1 + width]) for a in asks or ()]
            for i in range(0, len(out), 2048):
                cols = list(zip(*out[i: i + 2048]))
                cols.append(core_hashes(cols[5], width, gram))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.bool_(), pa.binary(),
                                                           pa.list_(pa.int64())))],
                    ["anchor", "row", "start", "copies", "crowded", "raw", "cores"])

    # rows that repeat were asked once each; one copy is enough
    return rows.mapInArrow(
        run, "anchor long, row long, start int, copies long, crowded boolean, raw binary, cores array<long>").distinct()


def _with_shared_core(stretches: DataFrame) -> DataFrame:
    """Without the contents that share no core with another one: no window of theirs stands twice."""
    cores = stretches.where("cores IS NOT NULL").select("anchor", "row", "start", F.explode("cores").alias("core"))
    shared = cores.groupBy("anchor", "core").agg(F.count("*").alias("n")).where("n > 1")
    some = cores.join(shared, ["anchor", "core"], "left_semi").select("anchor", "row", "start").distinct()
    # where one content has its minimizer at several places, its neighbours may meet it there
    several = stretches.where("cores IS NULL").select("anchor").distinct()
    return (stretches.join(some, ["anchor", "row", "start"], "left_semi")
            .unionByName(stretches.join(several, "anchor", "left_semi").join(some, ["anchor", "row", "start"], "left_anti")))


def _sorted_shards(stretches: DataFrame, width: int) -> DataFrame:
    """Windows that stand at two places in the contents of one minimizer: (row, start, n)."""

    def solve(held):
        found = repeated_starts([x[2] for x in held], width)
        for (row, start, _, copies), at in zip(held, found):
            if copies == 1 and len(at):
                new = np.flatnonzero(np.append(True, np.diff(at) > 1))
                for i, j in zip(new, np.append(new[1:], len(at))):
                    yield row, start + int(at[i]), int(j - i)

    def run(batches):
        held, size, last = [], 0, None
        for b in batches:
            out = []
            for anchor, row, start, copies, raw in zip(*(b.column(c).to_pylist() for c in ("anchor", "row", "start", "copies", "raw"))):
                if size > SHARD_BYTES and anchor != last:
                    out += solve(held)
                    held, size = [], 0
                held.append((row, start, raw, copies))
                size, last = size + len(raw), anchor
            yield _spans(out)
        yield _spans(list(solve(held)) if held else [])

    return (stretches.repartition(partitions_for(stretches.sparkSession), "anchor").sortWithinPartitions("anchor")
            .mapInArrow(run, "row long, start int, n int"))


def _spans(rows: list[tuple[int, int, int]]) -> pa.RecordBatch:
    cols = list(zip(*rows)) if rows else [[], [], []]
    return pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.int32()))],
                                      ["row", "start", "n"])


def _matched_windows(stretches: DataFrame, width: int) -> DataFrame:
    """The same for minimizers with very many contents, window by window."""

    def run(batches):
        for b in by_bytes(batches, "raw", 100_000):
            out = [[], [], [], [], []]
            for row, start, copies, raw in zip(*(b.column(c).to_pylist() for c in ("row", "start", "copies", "raw"))):
                s = np.frombuffer(raw, np.uint8)
                h1, h2 = Rolling(_CODES[s]).grams(width), Rolling(_OTHER[s]).grams(width)
                for o, x in zip(out, (np.full(len(h1), row), start + np.arange(len(h1)), np.full(len(h1), copies),
                                      h1.view(np.int64), h2.view(np.int64))):
                    o.append(x)
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.concatenate(o).astype(t) if o else np.zeros(0, t)) for o, t in
                 zip(out, (np.int64, np.int32, np.int64, np.int64, np.int64))], ["row", "start", "copies", "h1", "h2"])

    windows = stretches.mapInArrow(run, "row long, start int, copies long, h1 long, h2 long")
    often = windows.groupBy("h1", "h2").agg(F.sum("copies").alias("places")).where("places > 1")
    return (windows.where("copies = 1").join(often, ["h1", "h2"], "left_semi")
            .select("row", "start", F.lit(1).alias("n")))


def repeated_windows(docs: DataFrame, width: int = WIDTH, gram: int = GRAM,
                     most_contents: int = MOST_CONTENTS) -> DataFrame:
    """(row, start, n): runs of windows that stand anywhere else too. ``docs``: (row, text)."""
    paths = store(byte_runs(docs, width, gram), "sa-runs")
    anchors = (paths.groupBy("anchor")
               .agg(F.count("*").alias("places"), (F.min("content") == F.max("content")).alias("single"),
                    F.max("again").alias("any_again"))
               .where("places > 1 OR any_again"))
    repeated = store(paths.join(anchors, "anchor"), "sa-repeated")
    whole = repeated.where("single AND places > 1").select("row", "start", "n")

    open_ = repeated.where("NOT single OR (places = 1 AND again)")
    contents = open_.groupBy("anchor", "content").agg(
        F.count("*").alias("copies"), F.min(F.struct("row", "start", "n")).alias("at"))
    copied = (open_.join(contents.where("copies > 1").select("anchor", "content"), ["anchor", "content"], "left_semi")
              .select("row", "start", "n"))
    crowded = contents.groupBy("anchor").agg(F.count("*").alias("contents")).select(
        "anchor", (F.col("contents") > most_contents).alias("crowded"))
    asked = contents.join(crowded, "anchor").select("anchor", "at.row", "at.start", "at.n", "copies", "crowded")
    stretches = _with_shared_core(store(_stretches(docs, asked, width, gram), "sa-stretches"))
    return (whole.unionByName(copied)
            .unionByName(_sorted_shards(stretches.where("NOT crowded"), width))
            .unionByName(_matched_windows(stretches.where("crowded"), width)))


SCHEMA = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string, spans array<struct<start:long,end:long>>"


def drop_repeats(docs: DataFrame, width: int = WIDTH, gram: int = GRAM, id_col: str = "doc_id",
                 text_col: str = "text", most_contents: int = MOST_CONTENTS) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256, spans) for every row."""
    texts = texts_of(docs, id_col, text_col).withColumn("row", F.xxhash64("doc_id", "text"))
    found = repeated_windows(texts, width, gram, most_contents)
    spans = found.groupBy("row").agg(F.collect_list(F.struct("start", "n")).alias("found"))

    def run(batches):
        for b in by_bytes(batches, "text", _BATCH):
            n, gone, count, sha, kept_spans = [], [], [], [], []
            for t, got in zip(b.column("text").cast(pa.binary()).to_pylist(), b.column("found").to_pylist()):
                out, cut = t, []
                if got:
                    s = np.array([x["start"] for x in got])
                    i, j = merged(s, s + np.array([x["n"] for x in got]) - 1 + width)
                    cut = list(zip(i.tolist(), j.tolist()))
                    out = b"".join(t[x:y] for x, y in zip([0, *j.tolist()], [*i.tolist(), len(t)]))
                n.append(len(t))
                gone.append(len(t) - len(out))
                count.append(len(cut))
                sha.append(hashlib.sha256(out).hexdigest())
                kept_spans.append([{"start": x, "end": y} for x, y in cut])
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), *(pa.array(x, pa.int64()) for x in (n, gone, count)), pa.array(sha, pa.string()),
                 pa.array(kept_spans, pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64())])))],
                ["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "spans"])

    return texts.join(spans, "row", "left").select("doc_id", "text", "found").mapInArrow(run, SCHEMA)
