"""Encoding with a vocabulary of scored pieces, and decoding: a max-plus parallel scan.

The best segmentation of a text is the path of the highest summed piece score. The public
vocabulary file holds merge ranks as scores; they are taken as they stand, so ids are those
of the best path, not of its own greedy merges; decoding is the same for both. A character
outside the vocabulary is written as its bytes, for a score below every piece.

A text is cut into chunks of CHUNK characters. A chunk's boundary state is how many of its
first characters the previous chunk's last piece has taken (0 to the longest piece less 1), so
a chunk is a matrix T[state in, state out] of best scores in the (max, +) semiring. Matrices
combine associatively into the state at every boundary, and then each chunk traces its own
path back, without the others. Documents of one chunk have known states (0 and 0).

Between characters that stand side by side in no piece the path must cut; such units repeat,
and those a worker meets for the first time are solved together, by length, in arrays.

Defined cases: null text is empty and has no ids; rows that repeat an id or a text each give
a row; null ids stay null; an empty table gives no rows; other columns are not read. Equal
scores: the longest last piece within a chunk, the smallest state between chunks.
"""
from __future__ import annotations

import re
import string
import zlib
from collections.abc import Iterable
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import by_bytes, partitions_for, pieces, ship, store, texts_of
from ledgerlight.llm.crc import crc_of_parts
from ledgerlight.llm.memo import UnitMemo

CHUNK = 16_384
SPACE_MARK = "▁"  # fixed value: how the vocabulary writes a space
_BASE = np.uint64(0x9E3779B97F4A7C15)
MOST_UNITS = 700_000  # remembered by a worker
_LONG = 40  # units up to this length are solved in arrays
NONE = -np.inf


class Vocabulary:
    """Pieces, their scores and ids; a space stands for the vocabulary's mark."""

    def __init__(self, pieces_: dict[str, tuple[int, float]], byte_ids: list[int]):
        self.pieces, self.byte_ids = pieces_, byte_ids
        self.width = max(map(len, pieces_))
        self.unknown = min(s for _, s in pieces_.values()) - 10.0
        self.text_of = {i: p.encode() for p, (i, _) in pieces_.items()} | {i: bytes([b]) for b, i in enumerate(byte_ids)}
        self.score_of = np.zeros(max(self.text_of) + 1)
        for i, score in pieces_.values():
            self.score_of[i] = score
        for b, i in enumerate(byte_ids):  # a character's bytes cost what the character does, at the first
            self.score_of[i] = 0.0 if 0x80 <= b < 0xC0 else self.unknown
        self.unit = self._units()
        self._tables = {}
        for n in range(1, self.width + 1):
            own = [(p, i, s) for p, (i, s) in pieces_.items() if len(p) == n]
            if own:
                codes = np.array([[ord(c) for c in p] for p, _, _ in own], np.uint64)
                h = np.zeros(len(own), np.uint64)
                for k in range(n):
                    h = h * _BASE + codes[:, k]
                order = np.argsort(h)
                self._tables[n] = (h[order], np.array([i for _, i, _ in own])[order],
                                   np.array([s for _, _, s in own])[order])
        self._seen = {n: self._bits(t[0]) for n, t in self._tables.items()}

    def _units(self) -> re.Pattern:
        """What to cut a text into: between units, characters stand side by side in no piece.
        Spaces lead a unit; line ends that are in no longer piece are units; signs part from
        words if no piece joins them (signs grow by what pieces join to them)."""
        joined = [p for p in self.pieces if len(p) > 1]
        if any(" " in p.lstrip(" ") for p in joined):  # a piece spans words: the text is one unit
            return re.compile(r"(?s).+")
        inner = {c for p in joined for c in p}
        alone = [c for c in "\n\t\r" if c not in inner]
        signs, pairs = set(string.punctuation), {(a, b) for p in joined for a, b in zip(p, p[1:]) if a != " "}
        while more := {c for a, b in pairs if (a in signs) != (b in signs) for c in (a, b)} - signs:
            signs |= more
        if any(c.isascii() and c.isalnum() for c in signs):
            signs = set()
        line, sign = ("".join(map(re.escape, sorted(x))) for x in (alone, signs))
        kinds = [f" *[^ {line}{sign}]+", " +"]
        return re.compile("|".join([f" *[{sign}]+"] * bool(sign) + kinds + [f"[{line}]"] * bool(line)))

    @staticmethod
    def _bits(h: np.ndarray) -> np.ndarray:
        out = np.zeros(1 << 18, bool)
        out[(h * _BASE) >> np.uint64(46)] = True
        return out

    @classmethod
    def load(cls, path: str) -> Vocabulary:
        import sentencepiece

        sp = sentencepiece.SentencePieceProcessor(model_file=path)
        found, byte_ids = {}, [0] * 256
        for i in range(sp.get_piece_size()):
            p = sp.id_to_piece(i)
            if sp.is_byte(i):
                byte_ids[int(p[3:-1], 16)] = i
            elif not (sp.is_control(i) or sp.is_unknown(i) or sp.is_unused(i)):
                found[p.replace(SPACE_MARK, " ")] = (i, sp.get_score(i))
        return cls(found, byte_ids)

    def fallback(self, char: str) -> list[int]:
        return [self.byte_ids[b] for b in char.encode()]

    # -- one string ---------------------------------------------------------------------

    def forward(self, s: str, start: int = 0) -> tuple[list[float], list[int]]:
        """Best score from ``start`` to each position, and the length of its last piece."""
        n, get = len(s), self.pieces.get
        best, last = [NONE] * (n + 1), [0] * (n + 1)
        best[start] = 0.0
        for i in range(start, n):
            here = best[i]
            if here == NONE:
                continue
            for k in range(1, min(self.width, n - i) + 1):
                p = get(s[i: i + k])
                if p is None:
                    if k > 1:
                        continue
                    score = here + self.unknown
                else:
                    score = here + p[1]
                if score > best[i + k] or (score == best[i + k] and k > last[i + k]):
                    best[i + k], last[i + k] = score, k
        return best, last

    def trace(self, s: str, last: list[int], start: int, end: int) -> list[int]:
        out = []
        while end > start:
            p = self.pieces.get(s[end - last[end]: end])
            out.append([p[0]] if p else self.fallback(s[end - 1]))
            end -= last[end]
        return [i for part in reversed(out) for i in part]

    # -- many strings -------------------------------------------------------------------

    def solve(self, strings: list[str]) -> list[bytes]:
        """Ids of whole units, as little-endian 32-bit integers."""
        out: list = [None] * len(strings)
        by_length: dict[int, list[int]] = {}
        for k, s in enumerate(strings):
            by_length.setdefault(len(s), []).append(k)
        for n, where in by_length.items():
            for i in range(0, len(where), 8192):
                some = where[i: i + 8192]
                if n > _LONG:
                    got = [self._ids(strings[k]) for k in some]
                else:
                    got = self._solve_equal([strings[k] for k in some], n)
                for k, x in zip(some, got):
                    out[k] = x
        return out

    def _ids(self, s: str) -> bytes:
        return np.array(self.trace(s, self.forward(s)[1], 0, len(s)), "<u4").tobytes()

    def _solve_equal(self, strings: list[str], n: int) -> list[bytes]:
        m, most = len(strings), min(n, self.width)
        codes = np.array(strings, f"<U{n}").view("<u4").reshape(m, n).astype(np.uint64)
        ids = np.full((most + 1, n, m), -1, np.int32)
        best, last = np.full((n + 1, m), NONE), np.zeros((n + 1, m), np.int8)
        best[0] = 0
        score = []
        h = np.zeros((m, n), np.uint64)
        for k in range(1, most + 1):
            h = h[:, : n - k + 1] * _BASE + codes[:, k - 1:]
            score.append(np.full((n - k + 1, m), self.unknown if k == 1 else NONE))
            if k in self._tables:
                keys, own, scores = self._tables[k]
                r, c = np.nonzero(self._seen[k][(h * _BASE) >> np.uint64(46)])
                at = np.minimum(np.searchsorted(keys, h[r, c]), len(keys) - 1)
                hit = keys[at] == h[r, c]
                r, c, at = r[hit], c[hit], at[hit]
                score[-1][c, r], ids[k, c, r] = scores[at], own[at]
        for j in range(1, n + 1):
            for k in range(1, min(j, most) + 1):
                s = best[j - k] + score[k - 1][j - k]
                better = s >= best[j]
                best[j][better], last[j][better] = s[better], k
        # all paths back at once, a piece at a time
        at, row, trail = np.full(m, n), np.arange(m), np.full((m, n), -1, np.int32)
        count, odd = np.zeros(m, np.int64), np.zeros(m, bool)
        for step in range(n):
            go = np.flatnonzero(at > 0)
            if not len(go):
                break
            k = last[at[go], go].astype(np.int64)
            at[go] -= k
            trail[go, step] = ids[k, at[go], go]
            count[go] += 1
            odd[go] |= trail[go, step] < 0
        cols = count[:, None] - 1 - np.arange(n)[None, :]
        flat = trail[row[:, None], cols][cols >= 0].astype("<u4").tobytes()
        edge = (4 * np.concatenate([[0], np.cumsum(count)])).tolist()
        out = [flat[a:b] for a, b in zip(edge, edge[1:])]
        for r in np.flatnonzero(odd).tolist():  # with characters outside the vocabulary
            out[r] = self._ids(strings[r])
        return out

    def decode(self, ids: Iterable[int]) -> bytes:
        return b"".join(map(self.text_of.__getitem__, ids))


class Encoder:
    def __init__(self, path: str):
        self.vocab = Vocabulary.load(path)
        self.cache = UnitMemo(self.vocab.solve, MOST_UNITS)

    def whole(self, texts: list[str]) -> list[bytes]:
        """Ids of whole texts; a space before a text's first word is part of the encoding."""
        return self.cache.ids([self.vocab.unit.findall(" " + t) if t else [] for t in texts])

    def edges(self, chunk: str, left: str, ahead: str) -> tuple[int | None, int | None, int]:
        """First and last forced cut of a chunk (0 to its length), and how far its last piece
        may reach past its end."""
        s, n, cuts = left + chunk + ahead, len(chunk), {0 if not left else -1}
        at = -len(left)
        for u in self.vocab.unit.findall(s):
            at += len(u)
            cuts.add(at)
        if ahead:
            cuts.discard(n + len(ahead))
        inside = [c for c in cuts if 0 <= c <= n]
        reach = min([c - n for c in cuts if c >= n] + [self.vocab.width - 1, len(ahead)])
        return (min(inside), max(inside), reach) if inside else (None, None, reach)

    def ends(self, s: str, n: int, reach: int, start: int) -> list[float]:
        """Best scores from ``start`` to n, n+1, ... n+reach, the last piece starting before n."""
        best, _ = self._stopped(s, n, reach, start)
        return [best[n + b] for b in range(reach + 1)]

    def _stopped(self, s: str, n: int, reach: int, start: int):
        """As forward(), but no piece starts at n or later."""
        best, last = self.vocab.forward(s[:n], start)
        best, last = best + [NONE] * reach, last + [0] * reach
        for b in range(1, reach + 1):
            for k in range(b + 1, min(self.vocab.width, n + b - start) + 1):
                p = self.vocab.pieces.get(s[n + b - k: n + b])
                if p is not None and best[n + b - k] + p[1] >= best[n + b]:
                    best[n + b], last[n + b] = best[n + b - k] + p[1], k
        return best, last

    def middle(self, chunk: str, edges: tuple) -> np.ndarray:
        """Ids between the first and the last forced cut of a chunk: those of every path."""
        first, last_cut, _ = edges
        return np.array([], "<u4") if first is None else self.units(chunk[first:last_cut])

    def transfer(self, chunk: str, left: str, ahead: str, edges: tuple | None = None, ids: np.ndarray | None = None) -> np.ndarray:
        """T[state in, state out] of one chunk; its ``edges`` and the ``ids`` of its middle, if known."""
        w, n = self.vocab.width, len(chunk)
        out = np.full((w, w), NONE)
        first, last_cut, reach = edges or self.edges(chunk, left, ahead)
        if first is None:
            for a in range(min(w, n + reach + 1)):
                if a >= n:
                    out[a, a - n] = 0.0
                else:
                    out[a, : reach + 1] = self.ends(chunk + ahead, n, reach, a)
            return out
        head = np.full(w, NONE)
        for a in range(min(w - 1, first) + 1):
            head[a] = self.vocab.forward(chunk[:first], a)[0][first]
        middle = self.score(self.units(chunk[first:last_cut]) if ids is None else ids)
        tail = np.full(w, NONE)
        s = chunk[last_cut:] + ahead
        if last_cut == n:
            tail[0] = 0.0
        else:
            tail[: reach + 1] = self.ends(s, n - last_cut, reach, 0)
        return head[:, None] + middle + tail[None, :]

    def units(self, text: str) -> np.ndarray:
        """Ids of a stretch between two forced cuts."""
        return np.frombuffer(self.cache.ids([self.vocab.unit.findall(text)])[0], "<u4")

    def score(self, ids: np.ndarray) -> float:
        return float(self.vocab.score_of[ids].sum())

    def between(self, chunk: str, left: str, ahead: str, a: int, b: int, edges: tuple | None = None,
                middle: np.ndarray | None = None) -> np.ndarray:
        """Ids of a chunk from boundary state ``a`` to boundary state ``b``."""
        n, v = len(chunk), self.vocab
        if a >= n:
            return np.array([], "<u4")
        first, last_cut, reach = edges or self.edges(chunk, left, ahead)
        whole = chunk + ahead
        if first is None or first < a:
            _, last = self._stopped(whole, n, reach, a)
            return np.array(v.trace(whole, last, a, n + b), "<u4")
        _, last = v.forward(chunk[:first], a)
        ids = v.trace(chunk, last, a, first)
        if middle is None:
            middle = self.units(chunk[first:last_cut])
        rest = []
        if last_cut < n:
            s = whole[last_cut:]
            _, last = self._stopped(s, n - last_cut, reach, 0)
            rest = v.trace(s, last, 0, n - last_cut + b)
        return np.concatenate([np.array(ids, "<u4"), middle, np.array(rest, "<u4")])


@cache
def encoder(path: str) -> Encoder:
    return Encoder(path)


def max_plus(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Products of two stacks of matrices, (max, +)."""
    out = np.full(np.broadcast_shapes(a.shape, b.shape), NONE)
    for k in range(a.shape[-1]):
        out = np.maximum(out, a[..., :, k, None] + b[..., None, k, :])
    return out


def prefixes(mats: np.ndarray) -> np.ndarray:
    """mats[0] x ... x mats[i] for every i, by doubling: the product is associative."""
    out, step = mats.copy(), 1
    while step < len(out):
        out[step:] = max_plus(out[:-step].copy(), out[step:])
        step *= 2
    return out


def boundary_states(mats: np.ndarray) -> list[int]:
    """States 0, s1, ... 0 at the boundaries of the best path through all chunks."""
    before = prefixes(mats)[:, 0, :]
    states = [0]
    for i in range(len(mats) - 1, 0, -1):
        states.append(int(np.argmax(before[i - 1] + mats[i][:, states[-1]])))
    return [0, *reversed(states)]


OUT = "uid long, doc_id long, chunk int, n_tokens long, ids array<int>, round_trip boolean"


def _rows(uid, doc_id, chunk, ids: list[bytes | np.ndarray], same: list[bool]) -> pa.RecordBatch:
    arrays = [np.frombuffer(x, "<u4") for x in ids]
    n = np.array([len(x) for x in arrays], np.int64)
    flat = np.concatenate(arrays) if arrays else np.array([], np.uint32)
    offsets = pa.array(np.concatenate([[0], np.cumsum(n)]), pa.int32())
    return pa.RecordBatch.from_arrays(
        [uid, doc_id, chunk, pa.array(n), pa.ListArray.from_arrays(offsets, pa.array(flat.astype(np.int32))),
         pa.array(same, pa.bool_())], ["uid", "doc_id", "chunk", "n_tokens", "ids", "round_trip"])


def encode_documents(docs: DataFrame, model_path: str, id_col: str = "doc_id", text_col: str = "text",
                     chunk: int = CHUNK) -> DataFrame:
    """(uid, doc_id, chunk, n_tokens, ids, round_trip): one row for each chunk of a document.
    ``uid`` is null for documents of one chunk, else it names the row of the input.
    ``round_trip``: the chunk's ids decode to the characters they stand for."""
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col)
    small = texts.where(F.length("text") < chunk)
    large = texts.where(F.length("text") >= chunk)

    def encode(batches):
        enc = encoder(model_path)
        for b in (x for y in by_bytes(batches, "text", 2_000_000) for x in pieces([y])):
            texts_ = b.column("text").to_pylist()
            ids = enc.whole(texts_)
            same = [enc.vocab.decode(np.frombuffer(x, "<u4").tolist())[1:] == t.encode() for x, t in zip(ids, texts_)]
            n = b.num_rows
            yield _rows(pa.nulls(n, pa.int64()), b.column("doc_id"), pa.array([0] * n, pa.int32()), ids, same)

    def cut(batches):
        w = encoder(model_path).vocab.width
        for b in pieces(batches, 1):
            for r in b.to_pylist():
                s = " " + r["text"]
                for c, i in enumerate(range(0, len(s), chunk)):
                    yield pa.RecordBatch.from_pylist([{
                        "uid": r["uid"], "doc_id": r["doc_id"], "chunk": c, "lead": s[max(0, i - 1): i],
                        "text": s[i: i + chunk], "ahead": s[i + chunk: i + chunk + w]}],
                        pa.schema([("uid", pa.int64()), ("doc_id", pa.int64()), ("chunk", pa.int32()),
                                   ("lead", pa.string()), ("text", pa.string()), ("ahead", pa.string())]))

    def weigh(batches):
        enc = encoder(model_path)
        for b in pieces(batches, 64):
            rows = b.to_pylist()
            edges = [enc.edges(r["text"], r["lead"], r["ahead"]) for r in rows]
            ids = [enc.middle(r["text"], e) for r, e in zip(rows, edges)]
            m = [enc.transfer(r["text"], r["lead"], r["ahead"], e, x).astype("<f8").tobytes() for r, e, x in zip(rows, edges, ids)]
            yield pa.RecordBatch.from_arrays(
                [*b.columns, *[pa.array(c, pa.int32()) for c in zip(*edges)],
                 pa.array([x.astype("<u4").tobytes() for x in ids], pa.binary()), pa.array(m, pa.binary())],
                [*b.schema.names, "first", "last", "reach", "middle", "matrix"])

    def states(table):
        t = table.sort_by("chunk")
        w = encoder(model_path).vocab.width
        s = boundary_states(np.stack([np.frombuffer(x, "<f8").reshape(w, w) for x in t.column("matrix").to_pylist()]))
        return pa.table({"uid": t.column("uid"), "chunk": t.column("chunk"), "state_in": pa.array(s[:-1], pa.int32()),
                         "state_out": pa.array(s[1:], pa.int32())})

    def trace(batches):
        enc = encoder(model_path)
        for b in pieces(batches, 64):
            rows = b.to_pylist()
            ids = [enc.between(r["text"], r["lead"], r["ahead"], r["state_in"], r["state_out"],
                               (r["first"], r["last"], r["reach"]), np.frombuffer(r["middle"], "<u4")) for r in rows]
            same = [enc.vocab.decode(x.tolist()) == (r["text"] + r["ahead"])[r["state_in"]: len(r["text"]) + r["state_out"]].encode()
                    for x, r in zip(ids, rows)]
            yield _rows(b.column("uid"), b.column("doc_id"), b.column("chunk"), ids, same)

    n = partitions_for(spark)
    chunks = (large.withColumn("uid", F.monotonically_increasing_id())
              .mapInArrow(cut, "uid long, doc_id long, chunk int, lead string, text string, ahead string"))
    weighed = store(chunks.repartition(n, "uid", "chunk").mapInArrow(
        weigh, "uid long, doc_id long, chunk int, lead string, text string, ahead string, first int, last int, reach int, "
               "middle binary, matrix binary"), "spm-chunks")
    # a matrix is a few kilobytes for each CHUNK characters of one document
    path = weighed.select("uid", "chunk", "matrix").groupBy("uid").applyInArrow(
        states, "uid long, chunk int, state_in int, state_out int")
    traced = weighed.drop("matrix").join(path, ["uid", "chunk"]).mapInArrow(trace, OUT)
    return small.mapInArrow(encode, OUT).unionByName(traced)


def digest(encoded: DataFrame) -> DataFrame:
    """One row per document: (doc_id, n_tokens, ids_crc32, round_trip). The ids are those of the
    best path, which need not be the vocabulary file's own merges."""

    @F.pandas_udf("long")
    def crc(ids):
        return ids.map(lambda x: zlib.crc32(np.asarray(x, "<u4").tobytes()))

    @F.pandas_udf("long")
    def whole(parts):
        return parts.map(lambda p: crc_of_parts([(x["crc"], 4 * x["n_tokens"]) for x in p]))

    # written once: both kinds of documents are read from it, so that no text is encoded twice
    rows = store(encoded.select("uid", "doc_id", "chunk", "n_tokens", crc("ids").alias("crc"), "round_trip"), "spm-digest")
    long_ = (rows.where(F.col("uid").isNotNull()).groupBy("uid")
             .agg(F.first("doc_id").alias("doc_id"), F.sum("n_tokens").alias("n_tokens"),
                  F.array_sort(F.collect_list(F.struct("chunk", "n_tokens", "crc"))).alias("parts"),
                  F.bool_and("round_trip").alias("round_trip"))
             .select("doc_id", "n_tokens", whole("parts").alias("ids_crc32"), "round_trip"))
    return (rows.where(F.col("uid").isNull()).select("doc_id", "n_tokens", F.col("crc").alias("ids_crc32"), "round_trip")
            .unionByName(long_))


def decode_documents(encoded: DataFrame, model_path: str) -> DataFrame:
    """(uid, doc_id, text) from ids: chunks of a document join in order."""
    ship(encoded.sparkSession)

    @F.pandas_udf("binary")
    def texts(ids):
        v = encoder(model_path).vocab
        return ids.map(lambda x: v.decode(np.asarray(x).tolist()))

    parts = encoded.select("uid", "doc_id", "chunk", texts("ids").alias("raw"))
    whole = lambda c: F.substring(F.decode(c, "UTF-8"), 2, 2**31 - 1)  # noqa: E731  the leading space goes
    joined = (parts.where(F.col("uid").isNotNull()).groupBy("uid")
              .agg(F.first("doc_id").alias("doc_id"), F.array_sort(F.collect_list(F.struct("chunk", "raw"))).alias("p"))
              .select("uid", "doc_id", F.aggregate("p", F.lit(b"").cast("binary"), lambda s, x: F.concat(s, x["raw"])).alias("raw")))
    return parts.where(F.col("uid").isNull()).select("uid", "doc_id", "raw").unionByName(joined).select(
        "uid", "doc_id", whole(F.col("raw")).alias("text"))
