"""Documents packed into sequences of at most CAPACITY tokens by swap-based local search.

A document is its ids and an end id. One longer than a sequence is cut into pieces of CAPACITY
tokens, the first of which takes what is left over; pieces are then packed, no other is cut.

Pieces are dealt by a hash of their row into shards of about SHARD pieces. A shard starts from a
best-fit packing, longest first. Local search then works between its underfull bins: the
emptiest bin gives tokens away by the exchanges that raise the sum of squared fills most: a
piece moves, one goes for one, two for one, or one for two. So slack gathers in few bins, and
bins empty. A shard hands its emptiest bins on (of at most HAND_ON pieces, one bin at least);
those of FAN shards meet in the next round as they are and are searched again, until one group
is left. All other bins are final. Every group holds a bounded number of pieces, whatever the
input; the search of a group ends when its emptiest bin is stuck and no bin can be spared (in the
last round: as soon as none can), or when PATIENCE sources in a row were stuck.

Defined cases: null text is empty and has the end id only; rows with a null doc_id are packed
too; rows that repeat an id or a text are documents of their own; an empty table gives no
sequences; other columns are not read. Among gaining exchanges the one that leaves the
smallest gap comes first, then the greater gain, then the lower bin.
"""
from __future__ import annotations

import bisect
import heapq
import zlib
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.bitplanes import COARSE, UNIT
from ledgerlight.llm.common import by_bytes, pieces, store, texts_of
from ledgerlight.llm.memo import ByteLevel, UnitMemo

CAPACITY = 2048
END_ID = 0
SHARD = 8192
FAN = 256
HAND_ON = 32
PATIENCE = 64
MOST_UNITS = 900_000  # remembered by a worker

PIECES = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long"


# --- pieces

def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """(start, end) of the pieces of n tokens; only the first may be shorter than ``capacity``."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((i, i + capacity) for i in range(first, n, capacity))]


@cache
def _memo(tokenizer_path: str) -> UnitMemo:
    return UnitMemo(ByteLevel(tokenizer_path, special_as_text=False).encode, MOST_UNITS)


def encode_pieces(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                  text_col: str = "text", end_id: int = END_ID, with_ids: bool = False) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32[, ids]): the pieces of every text, written
    to the shared folder. ``uid`` names the row of the input."""
    texts = texts_of(docs, id_col, text_col)
    end = np.array([end_id], "<u4").tobytes()

    def run(batches):
        memo = _memo(tokenizer_path)
        uid = TaskContext.get().partitionId() << 40
        for b in (x for y in by_bytes(batches, "text", 2_000_000) for x in pieces([y])):
            cols: list[list] = [[], [], [], [], [], [], []]
            # a text with what may be a special token falls into units at white space only
            units = [(COARSE if "<|" in t else UNIT).findall(t) for t in b.column("text").to_pylist()]
            for doc_id, ids in zip(b.column("doc_id").to_pylist(), memo.ids(units)):
                ids += end
                for k, (i, j) in enumerate(cuts(len(ids) // 4, capacity)):
                    raw = ids[4 * i: 4 * j]
                    row = (uid, doc_id, k, i, j - i, zlib.crc32(raw), raw)
                    for c, x in zip(cols, row):
                        c.append(x)
                uid += 1
            types = [pa.int64(), pa.int64(), pa.int32(), pa.int64(), pa.int64(), pa.int64()]
            arrays = [pa.array(c, t) for c, t in zip(cols, types)]
            names = ["uid", "doc_id", "piece", "start", "length", "ids_crc32"]
            if with_ids:
                flat = np.frombuffer(b"".join(cols[6]), "<u4")
                edges = np.concatenate([[0], np.cumsum(cols[4])])
                arrays.append(pa.ListArray.from_arrays(pa.array(edges, pa.int32()), pa.array(flat.astype(np.int32))))
                names.append("ids")
            yield pa.RecordBatch.from_arrays(arrays, names)

    return store(texts.mapInArrow(run, PIECES + (", ids array<int>" if with_ids else "")), "packing-pieces")


# --- one group

def best_fit(sizes: np.ndarray, capacity: int) -> np.ndarray:
    """Bin of every piece: longest first, each into the bin with the smallest gap that holds it."""
    of_gap: list[list[int]] = [[] for _ in range(capacity + 1)]
    gaps: list[int] = []  # ascending, those with bins
    out, n = np.empty(len(sizes), np.int64), 0
    for i in np.argsort(-sizes, kind="stable").tolist():
        s = int(sizes[i])
        k = bisect.bisect_left(gaps, s)
        if k < len(gaps):
            gap = gaps[k]
            at = of_gap[gap].pop()
            if not of_gap[gap]:
                gaps.pop(k)
        else:
            gap, at, n = capacity, n, n + 1
        out[i] = at
        if gap > s:
            if not of_gap[gap - s]:
                bisect.insort(gaps, gap - s)
            of_gap[gap - s].append(at)
    return out


def _two(sizes: list[int], counts: dict[int, int]) -> dict[int, tuple[int, ...]]:
    """Sums of two pieces of a bin, each with the sizes that make it."""
    out = {}
    for k, x in enumerate(sizes):
        for y in sizes[k:]:
            if x != y or counts[x] > 1:
                out.setdefault(x + y, (x, y))
    return out


class Search:
    """Local search over the underfull bins of one group."""

    def __init__(self, sizes: np.ndarray, bins: np.ndarray, capacity: int):
        self.capacity = capacity
        self.held: dict[int, dict[int, list[int]]] = {}  # bin -> size -> pieces
        fill = np.bincount(bins, sizes).astype(np.int64) if len(bins) else np.zeros(0, np.int64)
        self.sizes, self.bins = sizes, bins.copy()
        for i in np.flatnonzero(fill[bins] < capacity).tolist():
            self.held.setdefault(int(bins[i]), {}).setdefault(int(sizes[i]), []).append(i)
        self.fill = {b: int(fill[b]) for b in self.held}
        self.rows: dict[int, tuple[np.ndarray, np.ndarray]] = {}  # bin -> what it can give: (sums, how many pieces)
        self.moves = 0

    def _sums(self, b: int):
        """What bin ``b`` can give away: one piece or two, by sum, and of how many pieces."""
        counts = {s: len(p) for s, p in self.held[b].items()}
        one = sorted(counts)
        return {s: (s,) for s in one}, _two(one, counts)

    def _offer(self, b: int) -> tuple[np.ndarray, np.ndarray]:
        if b not in self.rows:
            one, two = self._sums(b)
            self.rows[b] = (np.array([0, *one], np.int64), np.array(sorted(two), np.int64))
        return self.rows[b]

    def _best(self, source: int, target: int):
        """The exchange that moves most tokens from source to target: (sizes in, sizes out)."""
        one, two = self._sums(source)
        gap, best, choice = self.capacity - self.fill[target], 0, None
        back, back2 = self._sums(target)
        for gives, takes in ((one, {0: ()} | back | back2), (two, back)):
            have = sorted(gives)
            for out, sent in takes.items():
                k = bisect.bisect_right(have, out + gap) - 1
                if k >= 0 and have[k] - out > best:
                    best, choice = have[k] - out, (gives[have[k]], sent)
        return best, choice

    def _apply(self, source: int, target: int, gives: tuple[int, ...], takes: tuple[int, ...]) -> None:
        for a, b, what in ((source, target, gives), (target, source, takes)):
            for s in what:
                i = self.held[a][s].pop()
                if not self.held[a][s]:
                    del self.held[a][s]
                self.held[b].setdefault(s, []).append(i)
                self.bins[i] = b
        d = sum(gives) - sum(takes)
        self.fill[source] -= d
        self.fill[target] += d
        self.moves += 1
        for b in (source, target):
            self.rows.pop(b, None)
            if self.fill[b] in (0, self.capacity):  # emptied or full
                del self.held[b], self.fill[b]

    def _targets(self, source: int) -> list[int]:
        """Bins that some exchange with ``source`` would fill further: best fit first, then by gain."""
        others = [b for b in self.fill if b != source]
        if not others:
            return []
        one, two = (np.array(sorted(x), np.int64) for x in self._sums(source))
        both = np.union1d(one, two)
        gap = np.array([self.capacity - self.fill[b] for b in others], np.int64)
        most = np.zeros(len(others), np.int64)
        for which, have in ((0, both), (1, one)):
            parts = [self._offer(b)[which] for b in others]
            owner = np.repeat(np.arange(len(others)), [len(p) for p in parts])
            out = np.concatenate(parts)
            k = np.searchsorted(have, out + gap[owner], "right") - 1
            d = np.where(k >= 0, have[np.maximum(k, 0)] - out, 0) if len(have) else np.zeros(len(out), np.int64)
            np.maximum.at(most, owner, d)
        fill = self.capacity - gap
        gain = 2 * most * (fill - self.fill[source] + most)
        order = np.lexsort((np.array(others), -gain, gap - most))
        return [others[k] for k in order.tolist() if gain[k] > 0]

    def _drain(self, source: int) -> bool:
        """Give tokens of ``source`` away until no exchange gains; whether any did."""
        before = self.moves
        while source in self.fill:
            moves = self.moves
            for target in self._targets(source):
                d, choice = self._best(source, target)
                if d > 0 and self.fill[target] + d > self.fill[source]:
                    self._apply(source, target, *choice)
                    if source not in self.fill:
                        break
            if self.moves == moves:
                break
        return self.moves > before

    def _slack(self) -> int:
        return sum(self.capacity - x for x in self.fill.values())

    def run(self, patience: int = PATIENCE, to_spare: bool = False) -> np.ndarray:
        """The bin of every piece when the emptiest bin is stuck and no bin can be spared, or when
        ``patience`` sources in a row were stuck. ``to_spare``: as soon as no bin can be spared."""
        queue, stuck = [(f, b) for b, f in self.fill.items()], 0
        heapq.heapify(queue)
        while queue and stuck < patience and len(self.fill) > 1:
            f, b = heapq.heappop(queue)
            if self.fill.get(b) != f:
                continue  # changed since, or gone
            if to_spare and self._slack() < self.capacity:
                break
            before = dict(self.fill) if len(self.fill) <= patience else None
            if self._drain(b):
                stuck = 0
                if b in self.fill and before is None:
                    heapq.heappush(queue, (self.fill[b], b))
                if before is not None:  # few bins: all that changed may give again
                    for x, fill in self.fill.items():
                        if before.get(x) != fill:
                            heapq.heappush(queue, (fill, x))
                continue
            stuck += 1
            if self._slack() < self.capacity:
                break  # as few bins as these tokens need
        return self.bins


def pack_group(sizes: np.ndarray, bins: np.ndarray | None, capacity: int = CAPACITY, patience: int = PATIENCE,
               to_spare: bool = False) -> np.ndarray:
    """Bins 0, 1, ... of the pieces of a group; ``bins``: the packing to start from."""
    if not len(sizes):
        return np.zeros(0, np.int64)
    start = best_fit(sizes, capacity) if bins is None else np.unique(bins, return_inverse=True)[1]
    return np.unique(Search(sizes, start, capacity).run(patience, to_spare), return_inverse=True)[1]


# --- all groups

def _groups(rows: DataFrame, level: int, capacity: int, last: bool, hand_on: int) -> DataFrame:
    schema = rows.select("uid", "doc_id", "piece", "start", "length", "ids_crc32", "shard", "bin").schema

    def run(table: pa.Table) -> pa.Table:
        table = table.select([f.name for f in schema]).sort_by([("doc_id", "ascending"), ("uid", "ascending"), ("piece", "ascending")])
        size = table.column("length").to_numpy().astype(np.int64)
        old = None if level == 0 else table.column("bin").to_numpy()
        at = pack_group(size, old, capacity, to_spare=last and level > 0)
        order = np.argsort(at, kind="stable")
        fill, count = np.bincount(at, size).astype(np.int64), np.bincount(at)
        run_ = np.cumsum(size[order]) - size[order]
        offset = np.empty(len(at), np.int64)
        offset[order] = run_ - np.repeat(np.concatenate([[0], np.cumsum(fill)[:-1]]), count)
        passed = np.zeros(len(fill), bool)
        if not last:
            emptiest = np.lexsort((np.arange(len(fill)), fill))
            emptiest = emptiest[fill[emptiest] < capacity]
            keep = np.cumsum(count[emptiest]) <= hand_on
            keep[:1] = True
            passed[emptiest[keep]] = True
        shard = np.full(len(at), table.column("shard")[0].as_py(), np.int64)
        number = (np.int64(level) << 58) | (shard << 18) | at  # a group has fewer than 2**18 bins
        return table.drop_columns(["bin"]).append_column("bin", pa.array(number)).append_column(
            "offset", pa.array(offset)).append_column("open", pa.array(passed[at]))

    out = "uid long, doc_id long, piece int, start long, length long, ids_crc32 long, shard long, bin long, offset long, open boolean"
    return rows.groupBy("shard").applyInArrow(run, out)


def pack(pieces_: DataFrame, capacity: int = CAPACITY, shard: int = SHARD, fan: int = FAN, hand_on: int = HAND_ON) -> DataFrame:
    """(uid, doc_id, piece, start, length, ids_crc32, sequence_id, offset) of the pieces of
    ``encode_pieces``, each in one sequence."""
    n = max(1, -(-pieces_.count() // shard))
    rows = pieces_.select("uid", "doc_id", "piece", "start", "length", "ids_crc32",
                          F.pmod(F.xxhash64("uid", "piece"), F.lit(n)).alias("shard"), F.lit(0).cast("long").alias("bin"))
    final, level = [], 0
    while True:
        done = store(_groups(rows, level, capacity, n == 1, hand_on), "packing-round")
        final.append(done.where(~F.col("open")))
        if n == 1:
            break
        n, level = -(-n // fan), level + 1
        rows = done.where("open").withColumn("shard", F.floor(F.col("shard") / fan).cast("long")).drop("offset", "open")
    out = final[0]
    for f in final[1:]:
        out = out.unionByName(f)
    return out.select("uid", "doc_id", "piece", "start", "length", "ids_crc32", F.col("bin").alias("sequence_id"), "offset")


def pack_documents(docs: DataFrame, tokenizer_path: str, capacity: int = CAPACITY, id_col: str = "doc_id",
                   text_col: str = "text") -> DataFrame:
    """One row for each piece of each document, with its sequence and its place there."""
    return pack(encode_pieces(docs, tokenizer_path, capacity, id_col, text_col), capacity)


def sequences(packed: DataFrame, pieces_: DataFrame) -> DataFrame:
    """(sequence_id, n_tokens, doc_ids, offsets, ids): the sequences themselves, from pieces
    encoded ``with_ids``. A sequence holds at most its capacity of ids."""
    rows = packed.select("uid", "piece", "doc_id", "sequence_id", "offset").join(
        pieces_.select("uid", "piece", "ids"), ["uid", "piece"])
    return (rows.groupBy("sequence_id").agg(F.array_sort(F.collect_list(F.struct("offset", "doc_id", "ids"))).alias("p"))
            .select("sequence_id", F.aggregate("p", F.lit(0), lambda s, x: s + F.size(x["ids"])).alias("n_tokens"),
                    F.col("p.doc_id").alias("doc_ids"), F.col("p.offset").alias("offsets"), F.flatten("p.ids").alias("ids")))
