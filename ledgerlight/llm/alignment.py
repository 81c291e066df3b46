"""Tokens of two tokenizers over the same bytes, aligned by pandas.merge_asof.

Both tokenizers read space + text: A is byte-level, B a vocabulary of pieces that puts the
space there itself. Tokens cover byte ranges without gaps. In a batch every token start of one
side finds the last token of the other side that starts at or before it, keyed by document;
that token covers it. The union of both directions is every pair of tokens whose ranges
overlap. Pairs that also end together are links, and their ends cut the tokens of both sides
into groups that stand for the same bytes.

Tokens that end together are linked ids, of which the bytes of one end with the bytes of the
other. So the two vocabularies alone say which id pairs can be linked, and corpus-wide counts of
pairs have a bound that no corpus changes (``Pairs``): they are summed by task first, by pair
next, and sent back as one array.

Neither tokenizer merges across the edges of the units that texts are cut into here, so a
worker remembers the ids of units it has met; results don't depend on what it remembers.

Defined cases: a text that is null, empty, or whose tokens on either side don't spell
space + text (one with U+2581, say) has no tokens; rows with a null doc_id, and rows that repeat
an id or a text, each give a row; special tokens' strings are plain text; an empty table gives no
rows; other columns are not read.
"""
from __future__ import annotations

import hashlib
import re
from functools import cache
from itertools import accumulate, chain

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm.bitplanes import UNIT
from ledgerlight.llm.common import by_bytes, pieces, ship, store, texts_of
from ledgerlight.llm.memo import ByteLevel, UnitMemo

MOST_UNITS = 400_000  # remembered by a worker, for each side
BATCH_BYTES = 1_000_000
SPACE_MARK = "▁"  # fixed value: how a piece writes a space
_UNIT_B = re.compile(" +[^ ]*")
_BYTE_PIECE = re.compile("<0x([0-9A-F]{2})>")


class Side:
    """One tokenizer: ids of texts, and the bytes of its ids."""

    def __init__(self, spelled: list[bytes], units: re.Pattern, encode):
        self.spelled, self._units, self._encode = spelled, units, encode
        self.length = np.array([len(x) for x in spelled], np.int64)
        self._memo = UnitMemo(self._checked, MOST_UNITS)

    def _checked(self, units: list[str]) -> list[bytes | None]:
        """Ids of units; None where they don't spell the unit."""
        ids, raw = list(self._encode(units)), [u.encode() for u in units]
        flat = np.frombuffer(b"".join(ids), "<u4")
        size = np.cumsum(self.length[flat])[np.cumsum([len(x) // 4 for x in ids]) - 1] if all(ids) else None
        spell = self.spelled.__getitem__
        if size is not None and (size == np.cumsum([len(x) for x in raw])).all() and (
                b"".join(map(spell, flat.tolist())) == b"".join(raw)):
            return ids
        return [x if b"".join(map(spell, np.frombuffer(x, "<u4").tolist())) == r else None for x, r in zip(ids, raw)]

    def ids(self, texts: list[str]) -> list[np.ndarray | None]:
        """Ids of each text (with its leading space); None where they don't spell it."""
        return [None if x is None else np.frombuffer(x, "<u4")
                for x in self._memo.ids([self._units.findall(t) for t in texts])]


@cache
def side_a(path: str) -> Side:
    tok = ByteLevel(path, special_as_text=True)
    return Side(tok.spelled, UNIT, tok.encode)


@cache
def side_b(path: str) -> Side:
    from sentencepiece import SentencePieceProcessor

    m = SentencePieceProcessor(model_file=path)
    names = [m.id_to_piece(k) for k in range(m.get_piece_size())]
    if any(SPACE_MARK in n.lstrip(SPACE_MARK) for n in names):
        raise ValueError("a piece joins words, so texts can't be cut before spaces")
    spelled = [bytes([int(b[1], 16)]) if (b := _BYTE_PIECE.fullmatch(n)) else n.replace(SPACE_MARK, " ").encode() for n in names]
    alone = m.piece_to_id(SPACE_MARK)

    def encode(units):
        # the leading space of a unit is the one that the model puts there; of an empty text it makes none
        found = [ids if u != " " else [alone] for u, ids in zip(units, m.encode([u[1:] for u in units], num_threads=1))]
        raw, edges = np.array(list(chain.from_iterable(found)), "<u4").tobytes(), list(accumulate([4 * len(x) for x in found]))
        return [raw[i:j] for i, j in zip([0, *edges], edges)]

    return Side(spelled, _UNIT_B, encode)


class Pairs:
    """The id pairs that can end together, by number: those where the bytes of one id end with
    the bytes of the other."""

    def __init__(self, a: Side, b: Side):
        ids_a, ids_b = ({} for _ in range(2))
        for ids, side in ((ids_a, a), (ids_b, b)):
            for k, s in enumerate(side.spelled):
                if s:
                    ids.setdefault(s, []).append(k)
        pairs = set()
        for s, own in ids_a.items():
            for i in range(len(s)):
                pairs.update((x, y) for y in ids_b.get(s[i:], ()) for x in own)
        for s, own in ids_b.items():
            for i in range(1, len(s)):
                pairs.update((x, y) for x in ids_a.get(s[i:], ()) for y in own)
        self.code = np.array(sorted(x << 32 | y for x, y in pairs), np.int64)

    def __len__(self) -> int:
        return len(self.code)

    def number(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.code, a.astype(np.int64) << 32 | b.astype(np.int64))

    def best(self, count: np.ndarray) -> np.ndarray:
        """Which pairs have the highest count of their B id."""
        b = self.code & 0xFFFFFFFF
        most = np.zeros(int(b.max(initial=0)) + 1, np.int64)
        np.maximum.at(most, b, count)
        return count == most[b]


@cache
def pairs_of(path_a: str, path_b: str) -> Pairs:
    return Pairs(side_a(path_a), side_b(path_b))


class Aligned:
    """Tokens and overlaps of a batch of documents, document after document."""

    def __init__(self, texts: list[str], a: Side, b: Side):
        spaced = [" " + t if t else "" for t in texts]
        both = [(x, y) if t and x is not None and y is not None else ((), ())
                for t, x, y in zip(spaced, a.ids(spaced), b.ids(spaced))]
        self.n_a, self.n_b = (np.array([len(p[k]) for p in both], np.int64) for k in (0, 1))
        self.a, self.b = (np.concatenate([np.asarray(p[k], np.uint32) for p in both] or [np.zeros(0, np.uint32)]) for k in (0, 1))
        doc = np.arange(len(both))
        left, right = self._side(self.a, a, np.repeat(doc, self.n_a)), self._side(self.b, b, np.repeat(doc, self.n_b))
        self.doc_a, self.start_a, self.end_a = left["doc"].to_numpy(), left["at"].to_numpy(), left.pop("end").to_numpy()
        self.start_b, self.end_b = right["at"].to_numpy(), right.pop("end").to_numpy()
        covers_a = self._covering(left, right)   # by A token: the B token over its start
        covers_b = self._covering(right, left)
        j = np.arange(len(self.b))
        late = self.start_a[covers_b] < self.start_b  # equal starts: the first direction has the pair
        self.i = np.concatenate([np.arange(len(self.a)), covers_b[late]])
        self.j = np.concatenate([covers_a, j[late]])
        self.together = self.end_a[self.i] == self.end_b[self.j]

    @staticmethod
    def _side(ids: np.ndarray, side: Side, doc: np.ndarray) -> pd.DataFrame:
        """Tokens with their documents and places; places run on over the batch, and as both
        sides spell the same bytes, documents start at equal places on both."""
        length = side.length[ids]
        end = np.cumsum(length)
        return pd.DataFrame({"at": end - length, "doc": doc, "end": end})

    @staticmethod
    def _covering(tokens: pd.DataFrame, others: pd.DataFrame) -> np.ndarray:
        return pd.merge_asof(tokens, others.assign(k=np.arange(len(others))), on="at", by="doc")["k"].to_numpy().astype(np.int64)

    def links(self) -> tuple[np.ndarray, np.ndarray]:
        """(A token, B token) of the overlaps that end together, in order of their ends."""
        i, j = self.i[self.together], self.j[self.together]
        order = np.argsort(i, kind="stable")
        return i[order], j[order]


class Spelling:
    """Groups as text: ``a1,a2|b1;a3|b2,b3``."""

    def __init__(self, a: Side, b: Side):
        side = lambda s, last: [f"{k}{c}".encode() for k in range(len(s.spelled)) for c in (",", last)]
        self._base = 2 * len(a.spelled)
        self._parts = np.array(side(a, "|") + side(b, ";"), object)

    def digests(self, x: Aligned, i: np.ndarray, j: np.ndarray) -> list[str]:
        """SHA-256 of every document's groups; '' for one without tokens."""
        last_a, last_b = np.zeros(len(x.a), bool), np.zeros(len(x.b), bool)
        last_a[i] = last_b[j] = True
        group_a, group_b = np.cumsum(last_a) - last_a, np.cumsum(last_b) - last_b
        before_b = np.concatenate([[0], j + 1])  # B tokens in the groups before
        out = np.empty(len(x.a) + len(x.b), np.int64)
        out[np.arange(len(x.a)) + before_b[group_a]] = 2 * x.a.astype(np.int64) + last_a
        out[np.arange(len(x.b)) + i[group_b] + 1] = self._base + 2 * x.b.astype(np.int64) + last_b
        at, found = 0, []
        for n in (x.n_a + x.n_b).tolist():
            found.append(hashlib.sha256(b"".join(self._parts[out[at: at + n]].tolist())[:-1]).hexdigest() if n else "")
            at += n
        return found


@cache
def spelling_of(path_a: str, path_b: str) -> Spelling:
    return Spelling(side_a(path_a), side_b(path_b))


def _batches(batches):
    return (x for y in by_bytes(batches, "text", BATCH_BYTES) for x in pieces([y]))


OVERLAPS = ("doc_id long, row long, a int, a_id int, a_start long, a_end long, b int, b_id int, b_start long, b_end long, "
            "together boolean")


def overlaps(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every pair of overlapping tokens: their numbers in the document, ids and byte ranges of
    space + text, and whether they end together. ``row`` tells rows of one doc_id apart."""
    texts = texts_of(docs, id_col, text_col).withColumn("row", F.monotonically_increasing_id())

    def run(batches):
        for b in _batches(batches):
            x = Aligned(b.column("text").to_pylist(), side_a(path_a), side_b(path_b))
            doc = x.doc_a[x.i]
            first_a, first_b = np.cumsum(x.n_a) - x.n_a, np.cumsum(x.n_b) - x.n_b
            base = np.zeros(len(x.n_a), np.int64)
            base[x.n_a > 0] = x.start_a[first_a[x.n_a > 0]]
            take = pa.array(doc)
            cols = [b.column("doc_id").take(take), b.column("row").take(take),
                    x.i - first_a[doc], x.a[x.i], x.start_a[x.i] - base[doc], x.end_a[x.i] - base[doc],
                    x.j - first_b[doc], x.b[x.j], x.start_b[x.j] - base[doc], x.end_b[x.j] - base[doc], x.together]
            types = [pa.int64(), pa.int64(), *[pa.int32(), pa.int32(), pa.int64(), pa.int64()] * 2, pa.bool_()]
            yield pa.RecordBatch.from_arrays(
                [c if isinstance(c, pa.Array) else pa.array(c).cast(t) for c, t in zip(cols, types)],
                ["doc_id", "row", "a", "a_id", "a_start", "a_end", "b", "b_id", "b_start", "b_end", "together"])

    return texts.mapInArrow(run, OVERLAPS)


LINKED = "doc_id long, n_a long, n_b long, n_groups long, n_links long, groups_sha256 string, pairs array<int>, counts array<int>"


def linked(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: token, group and link counts, the digest of its groups, and how
    often each id pair (by its number in ``Pairs``) is linked in it."""

    def run(batches):
        a, b, number = side_a(path_a), side_b(path_b), pairs_of(path_a, path_b)
        spelling = spelling_of(path_a, path_b)
        for batch in _batches(batches):
            x = Aligned(batch.column("text").to_pylist(), a, b)
            i, j = x.links()
            n = np.bincount(x.doc_a[i], minlength=len(x.n_a))
            # pairs by document: one sort of the batch
            code = x.doc_a[i].astype(np.int64) * len(number) + number.number(x.a[i], x.b[j])
            code, count = np.unique(code, return_counts=True)
            edge = np.searchsorted(code, np.arange(len(x.n_a) + 1) * len(number)).astype(np.int32)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(x.n_a), pa.array(x.n_b), pa.array(n), pa.array(n),
                 pa.array(spelling.digests(x, i, j), pa.string()),
                 pa.ListArray.from_arrays(pa.array(edge), pa.array((code % max(1, len(number))).astype(np.int32))),
                 pa.ListArray.from_arrays(pa.array(edge), pa.array(count.astype(np.int32)))],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "groups_sha256", "pairs", "counts"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, LINKED)


def pair_counts(rows: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(pair, n): corpus-wide links of every id pair. A task sums its own first, so that it sends
    at most one row for each possible pair."""

    def run(batches):
        total = np.zeros(len(pairs_of(path_a, path_b)), np.int64)
        for b in batches:
            p, n = b.column("pairs").flatten().to_numpy(), b.column("counts").flatten().to_numpy()
            total += np.bincount(p, n, minlength=len(total)).astype(np.int64)
        found = np.flatnonzero(total)
        yield pa.RecordBatch.from_arrays([pa.array(found.astype(np.int32)), pa.array(total[found])], ["pair", "n"])

    return rows.select("pairs", "counts").mapInArrow(run, "pair int, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def id_links(spark: SparkSession, counts: DataFrame, path_a: str, path_b: str) -> DataFrame:
    """(a_id, b_id, n, is_best): the id pairs linked anywhere; ``is_best``: no other A id is linked
    with the B id more often. At most as many rows as the vocabularies allow pairs."""
    ship(spark)

    def run(batches):
        code = pairs_of(path_a, path_b).code
        for b in batches:
            c = code[b.column("pair").to_numpy()]
            yield pa.RecordBatch.from_arrays([pa.array((c >> 32).astype(np.int32)), pa.array((c & 0xFFFFFFFF).astype(np.int32)),
                                              b.column("n")], ["a_id", "b_id", "n"])

    found = counts.mapInArrow(run, "a_id int, b_id int, n long")
    most = found.groupBy("b_id").agg(F.max("n").alias("most"))
    return found.join(most, "b_id").select("a_id", "b_id", "n", (F.col("n") == F.col("most")).alias("is_best"))


SCORED = ("doc_id long, n_a long, n_b long, n_groups long, n_links long, n_best long, count_sum long, groups_sha256 string")


def align_documents(docs: DataFrame, path_a: str, path_b: str, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: n_a, n_b, n_groups, n_links, n_best (links whose pair is the
    commonest of its B id), count_sum (corpus-wide counts over its links), groups_sha256."""
    rows = store(linked(docs, path_a, path_b, id_col, text_col), "alignment")
    # at most one row for each pair that the vocabularies allow, whatever the corpus
    found = pair_counts(rows, path_a, path_b).toArrow()
    pairs = pairs_of(path_a, path_b)
    total = np.zeros(len(pairs), np.int64)
    total[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    shared = docs.sparkSession.sparkContext.broadcast((total, pairs.best(total)))

    def run(batches):
        total, best = shared.value
        for b in batches:
            p, n = b.column("pairs"), b.column("counts").flatten().to_numpy().astype(np.int64)
            pair = p.flatten().to_numpy()
            edge = np.concatenate([[0], np.cumsum(np.asarray(pa.compute.list_value_length(p)))])
            over = lambda v: np.diff(np.concatenate([[0], np.cumsum(v)])[edge])
            yield pa.RecordBatch.from_arrays(
                [*[b.column(c) for c in ("doc_id", "n_a", "n_b", "n_groups", "n_links")],
                 pa.array(over(np.where(best[pair], n, 0))), pa.array(over(n * total[pair])), b.column("groups_sha256")],
                ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"])

    return rows.mapInArrow(run, SCORED)
