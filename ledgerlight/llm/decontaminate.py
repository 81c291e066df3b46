"""Benchmark decontamination with spaced seeds.

A seed is a mask over SPAN consecutive words that looks at WEIGHT of them and ignores the
others, so a copy with a word replaced at an ignored position still gives the same hash.
Every window of a benchmark item and of a document is hashed under every mask, and equal hashes are
joined. Around the hits of a diagonal (document position - item position) the words are compared one
by one: the best run with +1 for an equal word and -PENALTY for another is an overlap if it has
MIN_MATCH equal words. The four masks were chosen so that every such run of any length has a window that one of them
looks at; a test enumerates the runs.

Seed hashes of the benchmark are a table. Documents are scanned once: a bit filter of the hashes (at
most 2 ** MAX_FILTER_BITS bits, whatever the benchmark) leaves out windows that cannot match, and the texts that
keep any go to the join, copies of a text once. No item and no document passes the driver.

Words are lower-cased runs without white space, stripped of punctuation at their ends;
words of punctuation alone are dropped. Characters of scripts that set no spaces are words of their own.

Defined cases: items of MIN_WHOLE words or more, but fewer than MIN_MATCH, match where all their words stand in a
row; shorter items, null and empty texts overlap with nothing. An item of over MAX_WORDS words is cut into
overlapping parts. Rows that repeat an id or a text are each judged, and equal results are one row; null ids are kept
as null; empty tables give no rows; other columns are not read.
"""
import math
import re
import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import by_bytes, partitions_for, pieces, remove, store, texts_of

SPAN, WEIGHT = 9, 6
MASKS = ("011100111", "001011111", "101100111", "110100111")
MIN_MATCH = 10
MIN_WHOLE = 3
PENALTY = 2
MAX_WORDS = 4096
BLOCK_WORDS = 200_000
MAX_FILTER_BITS = 28
LISTED = 1 << 20  # position pairs of one mask that are listed at once
_EDGE = ".,;:!?\"'()[]{}#$%&*|<>-–—«»…"
_MIX = np.uint64(0x9E3779B97F4A7C15)
_PROBES = (np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x165667B19E3779F9), np.uint64(0xD6E8FEB86659FD93))
# Thai, Lao, Burmese, Khmer, kana, Han
_UNSPACED = re.compile("[฀-໿က-႟ក-៿぀-ヿ㐀-鿿豈-﫿\U00020000-\U0003ffff]")


def words(text: str) -> list[str]:
    if _UNSPACED.search(text):
        text = _UNSPACED.sub(r" \g<0> ", text)
    return [w for x in text.lower().split() if (w := x.strip(_EDGE))]


class Codes(dict):
    """A 64-bit code of each word, the same in every process."""

    def __missing__(self, word: str) -> int:
        raw = word.encode("utf-8", "surrogatepass")
        code = self[word] = zlib.crc32(raw) << 32 | zlib.crc32(raw[::-1] + b"~")
        return code

    def of(self, found: list[str]) -> np.ndarray:
        if len(self) > 400_000:
            self.clear()
        return np.fromiter(map(self.__getitem__, found), np.uint64, len(found))


def _hashes(code: np.ndarray, places: list[int], width: int, seed: int) -> np.ndarray:
    n = len(code) - width + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    h = np.full(n, seed, np.uint64)
    for k in places:
        h ^= code[k: k + n]
        h *= _MIX
        h ^= h >> np.uint64(29)
    return h


def seed_hashes(code: np.ndarray, mask: str) -> np.ndarray:
    """Hash of every window under one mask; equal looked-at words give equal hashes."""
    return _hashes(code, [k for k, bit in enumerate(mask) if bit == "1"], SPAN, int(mask, 2))


def all_hashes(code: np.ndarray, lengths: tuple[int, ...] = ()) -> Iterator[np.ndarray]:
    """Window hashes under each mask, then of all words of every window of each of ``lengths``."""
    for m in MASKS:
        yield seed_hashes(code, m)
    for n in lengths:
        yield _hashes(code, list(range(n)), n, n)


def item_hashes(code: np.ndarray, lengths: tuple[int, ...]) -> list[np.ndarray]:
    """As ``all_hashes`` gives them; an item too short for a mask has one window, of its own length."""
    empty = np.zeros(0, np.uint64)
    if len(code) >= SPAN:
        return [*all_hashes(code), *[empty] * len(lengths)]
    return [empty] * len(MASKS) + [_hashes(code, list(range(n)), n, n) if n == len(code) else empty for n in lengths]


SHORT = tuple(range(MIN_WHOLE, SPAN))


def best_run(same: np.ndarray, penalty: int = PENALTY) -> tuple[int, int, int]:
    """(start, end, equal words) of the run with the highest score."""
    s = np.concatenate([[0], np.cumsum(np.where(same, 1, -penalty))])
    low = np.minimum.accumulate(s)
    end = int(np.argmax(s - low))
    start = int(np.flatnonzero(s[: end + 1] == low[end])[-1])
    return start, end, int(same[start:end].sum())


class Text:
    """A document's words, with the hashes of its windows sorted."""

    def __init__(self, code: np.ndarray):
        self.code = code
        self._sorted: list[tuple[np.ndarray, np.ndarray]] = []
        for h in all_hashes(code, SHORT):
            order = np.argsort(h, kind="stable")
            self._sorted.append((h[order], order))

    def diagonals(self, item: np.ndarray) -> np.ndarray:
        """Distinct document position - item position of equal hashes. Memory grows with the two lengths, not with
        the number of equal pairs."""
        found = np.zeros(len(self.code) + len(item) + 1, bool)
        for (own, order), h in zip(self._sorted, item_hashes(item, SHORT)):
            lo, hi = np.searchsorted(own, h), np.searchsorted(own, h, "right")
            n = hi - lo
            if 0 < n.sum() <= LISTED:
                k = np.repeat(lo, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
                found[order[k] - np.repeat(np.arange(len(h)), n) + len(item)] = True
            else:
                for j in np.flatnonzero(n):
                    found[order[lo[j]: hi[j]] + (len(item) - j)] = True
        return np.flatnonzero(found) - len(item)

    def overlaps(self, item: np.ndarray, min_match: int, whole: bool) -> Iterator[tuple[int, int, int, int]]:
        """(document start, end, item start, equal words) of verified overlaps; ``whole``: nothing of the item is cut off."""
        least = len(item) if whole and MIN_WHOLE <= len(item) < min_match else min_match
        for d in self.diagonals(item).tolist():
            lo, hi = max(0, -d), min(len(item), len(self.code) - d)
            start, end, equal = best_run(item[lo:hi] == self.code[lo + d: hi + d])
            if equal >= least:
                yield lo + d + start, lo + d + end, lo + start, equal


class Filter:
    """Bits at three places of each 64-bit hash. It says "maybe" to all of them and "no" to most others."""

    def __init__(self, log2: int, flags: np.ndarray):
        self._shift, self._flags = np.uint64(64 - log2), flags

    @staticmethod
    def places(h: np.ndarray, log2: int) -> np.ndarray:
        return np.concatenate([(h * p) >> np.uint64(64 - log2) for p in _PROBES]).astype(np.int64)

    def maybe(self, h: np.ndarray) -> np.ndarray:
        """Positions of ``h`` that may be in the set."""
        at = np.arange(len(h))
        for p in _PROBES:
            q = (h[at] * p) >> self._shift
            at = at[(self._flags[(q >> np.uint64(3)).astype(np.int64)] >> (q & np.uint64(7)).astype(np.uint8)) & 1 == 1]
        return at


def filter_of(hashes: DataFrame) -> Callable[[], Filter]:
    """A broadcast filter of a table with one long column, for use in tasks: 512 bits a row, 32 MB at most."""
    spark = hashes.sparkSession
    log2 = min(MAX_FILTER_BITS, max(16, math.ceil(math.log2(512 * max(1, hashes.count())))))

    def place(batches):
        for b in batches:
            yield pa.RecordBatch.from_arrays([pa.array(Filter.places(b.column(0).to_numpy().view(np.uint64), log2))], ["p"])

    parts = (hashes.mapInArrow(place, "p long").groupBy(F.shiftright("p", 15).alias("part"))
             .agg(F.bitmap_construct_agg(F.col("p").bitwiseAND(32767)).alias("bits")).collect())  # at most 8,192 rows
    flags = np.zeros(((1 << log2) >> 15, 4096), np.uint8)
    for r in parts:
        flags[r.part] = np.frombuffer(r.bits, np.uint8)
    shared = spark.sparkContext.broadcast(flags.tobytes())
    return lambda: Filter(log2, np.frombuffer(shared.value, np.uint8))


def item_parts(benchmark: DataFrame, item_col: str = "item_id", text_col: str = "text", min_match: int = MIN_MATCH,
               block_words: int = BLOCK_WORDS) -> DataFrame:
    """(part, item_id, at, whole, code): items as word codes, cut into parts that overlap by more than a run's least
    length; a task that hashes them has about ``block_words`` words."""
    test = texts_of(benchmark, item_col, text_col).withColumnRenamed("doc_id", "item_id").distinct()

    def cut(batches):
        memo = Codes()
        step = MAX_WORDS - 2 * SPAN - min_match
        for b in pieces(batches, 64):
            out = []
            for i, t in zip(b.column("item_id").to_pylist(), b.column("text").to_pylist()):
                c = memo.of(words(t))
                for p in range(0, max(1, len(c) - (MAX_WORDS - step)), step):
                    out.append((i, p, p == 0 and len(c) <= MAX_WORDS, c[p: p + MAX_WORDS].tobytes()))
            cols = list(zip(*out)) if out else [[]] * 4
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int32(), pa.bool_(), pa.binary()))],
                ["item_id", "at", "whole", "code"])

    cut_up = store(test.mapInArrow(cut, "item_id long, at int, whole boolean, code binary")
                   .withColumn("part", F.monotonically_increasing_id()), "leaks-parts")
    n_words = (cut_up.agg(F.sum(F.octet_length("code"))).first()[0] or 0) // 8
    return cut_up.repartition(max(1, min(n_words // block_words + 1, 100_000)))


def _seeds(parts: DataFrame) -> DataFrame:
    """Distinct (hash, part)."""
    def run(batches):
        for b in pieces(batches, 64):
            h, part = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
            for i, c in zip(b.column("part").to_pylist(), b.column("code").to_pylist()):
                u = np.unique(np.concatenate(item_hashes(np.frombuffer(c, np.uint64), SHORT)))
                h.append(u)
                part.append(np.full(len(u), i, np.int64))
            yield pa.RecordBatch.from_arrays([pa.array(np.concatenate(h).view(np.int64)), pa.array(np.concatenate(part))],
                                             ["hash", "part"])

    return parts.select("part", "code").mapInArrow(run, "hash long, part long")


def _text_key(text: Column) -> Column:
    return F.unhex(F.md5(text))


def _passing(texts: DataFrame, seeds: DataFrame, lengths: tuple[int, ...]) -> DataFrame:
    """(doc_id, key, text, hashes): texts with window hashes that the filter of the seeds lets through."""
    load = filter_of(seeds.select("hash"))

    def run(batches):
        maybe, memo = load().maybe, Codes()
        gap = np.zeros(SPAN, np.uint64)
        for b in by_bytes(batches, "text", 1 << 20):
            found = [memo.of(words(t)) for t in b.column("text").to_pylist()]
            ends = np.cumsum([len(c) + SPAN for c in found])
            row, hashes = [], []
            for h in all_hashes(np.concatenate([x for c in found for x in (c, gap)]), lengths):
                at = maybe(h)
                row.append(np.searchsorted(ends, at, "right"))
                hashes.append(h[at])
            row, hashes = np.concatenate(row), np.concatenate(hashes).view(np.int64)
            hit = np.unique(row)
            kept = b.take(pa.array(hit))
            yield pa.RecordBatch.from_arrays(
                [*kept.columns, pa.array([np.unique(hashes[row == r]) for r in hit], pa.list_(pa.int64()))],
                ["doc_id", "text", "key", "hashes"])

    return texts.withColumn("key", _text_key(F.col("text"))).mapInArrow(
        run, "doc_id long, text string, key binary, hashes array<long>")


FOUND = "key binary, item_id long, doc_start int, doc_end int, item_start int, n_equal int"


def _found(docs: DataFrame, benchmark: DataFrame, id_col: str | None, text_col: str, item_col: str, item_text_col: str,
           min_match: int, block_words: int, first: bool) -> DataFrame:
    """Verified overlaps of each distinct text, with the ids of its rows; ``first``: one a text, and no ids."""
    spark = docs.sparkSession
    parts = item_parts(benchmark, item_col, item_text_col, min_match, block_words)
    seeds = store(_seeds(parts), "leaks-seeds")
    n_words = F.octet_length("code") / 8
    lengths = tuple(sorted(int(r[0]) for r in parts.where(n_words.between(MIN_WHOLE, SPAN - 1)).select(n_words).distinct().collect()))
    texts = texts_of(docs.withColumn("_no_id", F.lit(0)), "_no_id", text_col) if id_col is None else texts_of(docs, id_col, text_col)
    passing = store(_passing(texts, seeds, lengths), "leaks-passing")
    # copies of a text are joined and verified once
    pairs = (passing.select("key", F.explode("hashes").alias("hash")).distinct()
             .join(seeds, "hash").select("key", "part").distinct())
    met = store(pairs.join(parts, "part"), "leaks-met")
    once = passing.join(met.select("key").distinct(), "key", "left_semi").groupBy("key").agg(F.min("text").alias("text"))
    both = met.select("key", F.lit(1).alias("kind"), F.lit(None).cast("string").alias("text"), "item_id", "at", "whole", "code").unionByName(
        once.select("key", F.lit(0).alias("kind"), "text"), allowMissingColumns=True)

    def verify(batches):
        memo, doc, done = Codes(), None, False
        for b in pieces(batches, 256):
            out = []
            for key, kind, text, item, at, whole, code in zip(*(b.column(c).to_pylist() for c in b.schema.names)):
                if kind == 0:
                    doc, done = Text(memo.of(words(text))), False
                elif not (first and done):
                    for s, e, i, equal in doc.overlaps(np.frombuffer(code, np.uint64), min_match, whole):
                        out.append((key, item, s, e, at + i, equal))
                        done = True
                        if first:
                            break
            cols = list(zip(*out)) if out else [[]] * 6
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(cols, [pa.binary(), pa.int64()] + [pa.int32()] * 4)],
                ["key", "item_id", "doc_start", "doc_end", "item_start", "n_equal"])

    found = (both.select("key", "kind", "text", "item_id", "at", "whole", "code").repartition(partitions_for(spark), "key")
             .sortWithinPartitions("key", "kind").mapInArrow(verify, FOUND))
    if not first:
        found = passing.select("doc_id", "key").distinct().join(found, "key").drop("key").distinct()
    out = store(found, "leaks-found")
    for table in (met, passing, seeds, parts):
        remove(table)
    return out


def overlaps(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
             item_col: str = "item_id", item_text_col: str = "text", min_match: int = MIN_MATCH,
             block_words: int = BLOCK_WORDS) -> DataFrame:
    """Verified overlaps: (doc_id, item_id, doc_start, doc_end, item_start, n_equal), positions in words."""
    return _found(docs, benchmark, id_col, text_col, item_col, item_text_col, min_match, block_words, False)


def keep_clean(docs: DataFrame, benchmark: DataFrame, text_col: str = "text", item_col: str = "item_id",
               item_text_col: str = "text", min_match: int = MIN_MATCH, block_words: int = BLOCK_WORDS) -> DataFrame:
    """The rows that overlap with no item, with all their columns; null texts stay. A filter of the texts to drop lets
    most rows pass at once; only the others are joined."""
    found = _found(docs, benchmark, None, text_col, item_col, item_text_col, min_match, block_words, True)
    bad = store(found.select(F.col("key").alias("_leak")), "leaks-bad")
    load = filter_of(bad.select(F.xxhash64("_leak")))

    @F.pandas_udf("boolean")
    def maybe(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        held = load()
        for h in batches:
            flag = np.zeros(len(h), bool)
            flag[held.maybe(h.to_numpy(np.int64).view(np.uint64))] = True
            yield pd.Series(flag)

    key = _text_key(F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")))
    marked = docs.select("*", key.alias("_leak"), maybe(F.xxhash64(key)).alias("_leak_maybe"))
    columns = [F.col(f"`{c}`") for c in docs.columns]
    sure = marked.where(~F.col("_leak_maybe")).select(columns)
    return sure.union(marked.where("_leak_maybe").join(bad, "_leak", "left_anti").select(columns))


def contaminated(found: DataFrame) -> DataFrame:
    """One row for each document and item that overlap: the longest overlap."""
    best = F.max(F.struct("n_equal", -F.col("doc_start"), -F.col("item_start"), "doc_end"))
    return (found.groupBy("doc_id", "item_id").agg(best.alias("b"))
            .select("doc_id", "item_id", (-F.col("b.col2")).alias("doc_start"), F.col("b.doc_end").alias("doc_end"),
                    (-F.col("b.col3")).alias("item_start"), F.col("b.n_equal").alias("n_equal")))
