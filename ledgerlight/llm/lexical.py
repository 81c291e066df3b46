"""Ranked lexical search: the best K documents of every item, exactly.

Documents are indexed in blocks of at most BLOCK_DOCS texts, like lengths together: a block holds its
own vocabulary with postings (document, times). Counts over all documents (N, L, df) come from
the blocks' small columns; an item's term without postings anywhere is dropped. Tasks get texts and
blocks in parts of about WINDOW_BYTES, however long their splits are.

Items meet the blocks in groups of about GROUP_TERMS terms, one group sent out at a time, so that
what a task holds of them has a bound. In a block the documents of an item are grouped by
their presence mask, one bit for each term of the item. A mask's maximum score adds up, for its
bits, the term's highest possible share of a score in the block. Distinct masks are taken by
descending maximum, their documents are scored in full, and a block is finished as soon as the
maximum falls below the K-th best score that the task has seen for the item. Each task keeps K
documents of an item; these are merged by rank.

Terms are maximal runs of ASCII letters, digits and all characters beyond ASCII; only A-Z are
lower-cased. A term's weight is floor(1000 * ln((2N + 2) / (2 df + 1))), in doubles; a document
of n terms has m = 75 + (25 n N) div L, and its score sums weight * ((10^9 tf) div (1000 tf + 12 m))
over the item's terms, repeats included; all in 64-bit integers.

Defined cases: a text that is null or has no term is no document and no item; rows that repeat a
doc_id are documents of their own, a null doc_id comes last among equal scores; rows that repeat an
item_id are items of their own, each with its ranks; scores of 0 are left out; empty tables give no
rows; other columns are not read. Equal scores: ascending doc_id.
"""
from __future__ import annotations

import itertools
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.common import by_bytes, pieces, store, texts_of

K = 20
BLOCK_DOCS = 512
WINDOW_BYTES = 4_000_000   # texts sorted by length before they are cut into blocks; texts or index that a task holds at once
GROUP_TERMS = 500_000
CELLS = 4_000_000          # of a block's table of documents x terms
# Fixed value: every byte that is no ASCII letter or digit and not beyond ASCII is a gap; A-Z become a-z
_FOLD = bytes(c + 32 if 65 <= c <= 90 else c if 48 <= c <= 57 or 97 <= c <= 122 or c >= 128 else 32 for c in range(256))


def terms_of(raw: bytes) -> list[bytes]:
    return raw.translate(_FOLD).split()


# --- index

INDEX = ("n_docs long, n_terms long, doc_id array<long>, n array<long>, terms array<string>, df array<int>, "
         "rows array<int>, tf array<int>")
_INDEX_TYPES = [pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.list_(pa.string()),
                pa.list_(pa.int32()), pa.list_(pa.int32()), pa.list_(pa.int32())]
_INDEX_NAMES = ["n_docs", "n_terms", "doc_id", "n", "terms", "df", "rows", "tf"]


def _block(docs: list[tuple[int, int | None, np.ndarray, np.ndarray]], names: np.ndarray) -> pa.RecordBatch:
    """One index row from (number of terms, doc_id, distinct terms as places in ``names``, times)."""
    term = np.concatenate([t for _, _, t, _ in docs])
    row = np.repeat(np.arange(len(docs)), [len(t) for _, _, t, _ in docs])
    tf = np.concatenate([x for _, _, _, x in docs])
    order = np.argsort(term, kind="stable")
    held, df = np.unique(term, return_counts=True)
    n = [x for x, _, _, _ in docs]
    values = [len(docs), sum(n), [d for _, d, _, _ in docs], n, [t.decode("utf-8", "replace") for t in names[held]],
              df, row[order], tf[order]]
    return pa.RecordBatch.from_arrays([pa.array([v], t) for v, t in zip(values, _INDEX_TYPES)], _INDEX_NAMES)


def index_rows(batches: Iterator[pa.RecordBatch], block_docs: int) -> Iterator[pa.RecordBatch]:
    """The blocks of (doc_id, text); nothing of a window is kept when the next begins."""
    for b in (x for y in by_bytes(batches, "text", WINDOW_BYTES) for x in pieces([y], 4 * block_docs)):
        docs = []
        # A factory that is a method of the dict would make a cycle, which stays until garbage is collected
        number: defaultdict[bytes, int] = defaultdict(itertools.count().__next__)
        for doc_id, raw in zip(b.column("doc_id").to_pylist(), b.column("text").cast(pa.binary()).to_pylist()):
            found = terms_of(raw)
            if found:
                c = Counter(found)
                docs.append((len(found), doc_id, np.fromiter(map(number.__getitem__, c), np.int32, len(c)),
                             np.fromiter(c.values(), np.int32, len(c))))
        names = np.fromiter(number, object, len(number))
        docs.sort(key=lambda d: d[0])
        for i in range(0, len(docs), block_docs):
            yield _block(docs[i: i + block_docs], names)


def build_index(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", block_docs: int = BLOCK_DOCS) -> DataFrame:
    """The index of all texts, written to the shared folder: one row for each block."""

    def run(batches):
        return index_rows(batches, block_docs)

    return store(texts_of(docs, id_col, text_col).mapInArrow(run, INDEX), "lexical-index", WINDOW_BYTES)


def weighted_terms(index: DataFrame, items: DataFrame, n_docs: int, item_col: str = "item_id",
                   text_col: str = "text") -> DataFrame:
    """(uid, item_id, term, times, w) of the items' terms that stand in some document, written to
    the shared folder; ``uid`` names the row of the input."""

    def run(batches):
        for b in pieces(batches):
            cols: list[list] = [[], [], [], []]
            for uid, i, raw in zip(b.column("uid").to_pylist(), b.column("doc_id").to_pylist(),
                                   b.column("text").cast(pa.binary()).to_pylist()):
                for t, n in Counter(terms_of(raw)).items():
                    for c, x in zip(cols, (uid, i, t.decode("utf-8", "replace"), n)):
                        c.append(x)
            yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(cols, (pa.int64(), pa.int64(), pa.string(), pa.int64()))],
                                             ["uid", "item_id", "term", "times"])

    asked = store(texts_of(items, item_col, text_col).withColumn("uid", F.monotonically_increasing_id())
                  .mapInArrow(run, "uid long, item_id long, term string, times long"), "lexical-items", WINDOW_BYTES)
    held = index.select(F.explode(F.arrays_zip("terms", "df")).alias("x")).select(F.col("x.terms").alias("term"), F.col("x.df").alias("df"))
    df = held.join(asked.select("term").distinct(), "term", "left_semi").groupBy("term").agg(F.sum("df").alias("df"))
    weight = F.floor(F.lit(1000.0) * F.log(F.lit(2.0 * n_docs + 2.0) / (2.0 * F.col("df") + 1.0))).cast("long")
    return store(asked.join(df.select("term", weight.alias("w")), "term").select("uid", "item_id", "term", "times", "w"),
                 "lexical-weights")


# --- one block, one item

def share(tf: np.ndarray, m: np.ndarray) -> np.ndarray:
    """A term's part of a score, before its weight: grows with ``tf``, falls with ``m``."""
    return 1_000_000_000 * tf // (1000 * tf + 12 * m)


def by_mask(tf: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct presence masks of the rows of a table (documents x terms), as rows of bits, and
    the mask of every document."""
    bits = np.packbits(tf > 0, axis=1)
    width = -(-bits.shape[1] // 8) * 8
    words = np.zeros((len(bits), width), np.uint8)
    words[:, :bits.shape[1]] = bits
    key = words.view(np.uint64).ravel() if width == 8 else words.view(np.dtype((np.void, width))).ravel()
    _, first, mask = np.unique(key, return_index=True, return_inverse=True)
    return np.unpackbits(bits[first], axis=1, count=tf.shape[1]), mask.ravel()


class Best:
    """The best K documents of one item so far."""

    __slots__ = ("k", "score", "doc", "null")

    def __init__(self, k: int):
        self.k = k
        self.score, self.doc, self.null = np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0, bool)

    @property
    def least(self) -> int:
        """A document scoring less than this is out."""
        return int(self.score[-1]) if len(self.score) == self.k else 1

    def add(self, score: np.ndarray, doc: np.ndarray, null: np.ndarray) -> None:
        keep = score >= self.least
        score, doc, null = (np.concatenate([x, y[keep]]) for x, y in
                            ((self.score, score), (self.doc, doc), (self.null, null)))
        order = np.lexsort((doc, null, -score))[: self.k]
        self.score, self.doc, self.null = score[order], doc[order], null[order]


def search_block(best: Best, tf: np.ndarray, m: np.ndarray, weight: np.ndarray, doc: np.ndarray, null: np.ndarray) -> int:
    """Meet one item with documents: ``tf`` (documents x terms), weights with repeats. Returns how
    many documents were scored."""
    most = weight * share(tf.max(axis=0), m.min())
    if most.sum() < best.least:
        return 0
    bits, mask = by_mask(tf)
    top = bits.astype(np.int64) @ most
    order = np.argsort(-top[mask], kind="stable")  # documents by their mask's maximum
    bound, done, step = top[mask][order], 0, 2 * best.k
    while done < len(order) and bound[done] >= best.least:
        rows = order[done: done + step]
        rows = rows[bound[done: done + step] >= best.least]
        best.add(share(tf[rows], m[rows, None]) @ weight, doc[rows], null[rows])
        done, step = done + step, 2 * step
    return min(done, len(order))


class Group:
    """Items that are searched together: their terms, and which of them each item has."""

    def __init__(self, rows: pa.Table):
        rows = rows.sort_by([("uid", "ascending"), ("term", "ascending")])
        terms = rows.column("term").combine_chunks().dictionary_encode()
        self.terms = terms.dictionary
        self.term = terms.indices.to_numpy()
        uid = rows.column("uid").to_numpy()
        cut = np.concatenate([[0], np.flatnonzero(np.diff(uid)) + 1, [len(uid)]]) if len(uid) else np.zeros(1, np.int64)
        self.items = list(zip(cut[:-1].tolist(), cut[1:].tolist()))
        self.uid = uid[cut[:-1]]
        ids = rows.column("item_id").to_pylist()
        self.item_id = [ids[i] for i in cut[:-1]]
        self.weight = rows.column("w").to_numpy() * rows.column("times").to_numpy()

    def search(self, blocks, n_docs: int, n_terms: int, k: int):
        """The best documents of every item in the given index rows."""
        best = [Best(k) for _ in self.items]
        for b in blocks:
            col = {c: b.column(c).flatten() for c in ("doc_id", "n", "terms", "df", "rows", "tf")}
            n, df = col["n"].to_numpy(), col["df"].to_numpy()
            doc, null = col["doc_id"].fill_null(0).to_numpy(), col["doc_id"].is_null().to_numpy(zero_copy_only=False)
            rows, times = col["rows"].to_numpy(), col["tf"].to_numpy().astype(np.int64)
            m = 75 + 25 * n * n_docs // n_terms
            place = pc.index_in(self.terms, value_set=col["terms"])  # of the group's terms in the block, if there
            place = place.fill_null(-1).to_numpy()
            edge = np.concatenate([[0], np.cumsum(df)])
            for state, (i, j) in zip(best, self.items):
                at = place[self.term[i:j]]
                here = at >= 0
                if not here.any():
                    continue
                at, weight = at[here], self.weight[i:j][here]
                count = df[at]
                take = np.repeat(edge[at], count) + np.arange(count.sum()) - np.repeat(np.cumsum(count) - count, count)
                row, column, tf = rows[take], np.repeat(np.arange(len(at)), count), times[take]
                step = max(1, CELLS // len(at))
                for lo in range(0, len(n), step):
                    part = (row >= lo) & (row < lo + step) if len(n) > step else slice(None)
                    found, local = np.unique(row[part], return_inverse=True)
                    if not len(found):
                        continue
                    table = np.zeros((len(found), len(at)), np.int64)
                    table[local, column[part]] = tf[part]
                    search_block(state, table, m[found], weight, doc[found], null[found])
        return best


FOUND = "uid long, item_id long, doc_id long, score long"


def _search(index: DataFrame, group: DataFrame, n_docs: int, n_terms: int, k: int) -> DataFrame:
    shared = index.sparkSession.sparkContext.broadcast(group.toArrow())  # one group, of bounded size

    def run(batches):
        g = Group(shared.value)
        best = g.search(pieces(batches, 1), n_docs, n_terms, k)
        for i in range(0, len(best), 1024):
            part = best[i: i + 1024]
            n = [len(x.score) for x in part]
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.repeat(g.uid[i: i + 1024], n), pa.int64()),
                 pa.array([x for x, c in zip(g.item_id[i: i + 1024], n) for _ in range(c)], pa.int64()),
                 pa.array(np.concatenate([x.doc for x in part]), pa.int64(), mask=np.concatenate([x.null for x in part])),
                 pa.array(np.concatenate([x.score for x in part]), pa.int64())], ["uid", "item_id", "doc_id", "score"])

    return index.mapInArrow(run, FOUND)


def search(docs: DataFrame, items: DataFrame, k: int = K, id_col: str = "doc_id", text_col: str = "text",
           item_col: str = "item_id", item_text_col: str = "text", group_terms: int = GROUP_TERMS,
           block_docs: int = BLOCK_DOCS) -> DataFrame:
    """(item_id, rank, doc_id, score): the k best documents of every item."""
    index = build_index(docs, id_col, text_col, block_docs)
    total = index.agg(F.coalesce(F.sum("n_docs"), F.lit(0)).alias("d"), F.coalesce(F.sum("n_terms"), F.lit(0)).alias("t")).first()
    asked = weighted_terms(index, items, total.d, item_col, item_text_col)
    n = max(1, -(-asked.count() // group_terms))
    found = None
    for g in range(n):
        group = asked if n == 1 else asked.where(F.pmod(F.xxhash64("uid"), F.lit(n)) == g)
        part = store(_search(index, group, total.d, total.t, k), "lexical-found", WINDOW_BYTES)
        found = part if found is None else found.unionByName(part)
    order = [F.col("score").desc(), F.col("doc_id").asc_nulls_last()]
    salt = F.pmod(F.xxhash64("doc_id", "score"), F.lit(64))  # an item's rows, k for each task, are thinned in 64 parts first
    thin = found.withColumn("salt", salt)
    thin = thin.withColumn("r", F.row_number().over(Window.partitionBy("uid", "salt").orderBy(*order))).where(F.col("r") <= k)
    ranked = thin.withColumn("rank", F.row_number().over(Window.partitionBy("uid").orderBy(*order))).where(F.col("rank") <= k)
    return ranked.select("item_id", "rank", "doc_id", "score")


def oracle_sql(k: int = K) -> str:
    """The same rows in DuckDB, from all documents and items."""
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    terms = (f"unnest(regexp_extract_all(translate(text, '{upper}', '{lower}'), "
             r"'[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term")
    return f"""
WITH tf AS (SELECT doc_id, term, count(*) AS tf FROM (SELECT doc_id, {terms} FROM documents) GROUP BY ALL),
d AS (SELECT doc_id, sum(tf)::BIGINT AS n FROM tf GROUP BY doc_id),
c AS (SELECT count(*) AS nd, sum(n)::BIGINT AS nt FROM d),
m AS (SELECT doc_id, 75 + (25 * n * nd) // nt AS m FROM d, c),
w AS (SELECT term, floor(1000 * ln((2.0::DOUBLE * nd + 2) / (2.0::DOUBLE * count(*) + 1)))::BIGINT AS w
  FROM tf, c GROUP BY term, nd),
q AS (SELECT item_id, term, count(*) AS times FROM (SELECT item_id, {terms} FROM benchmark) GROUP BY ALL),
s AS (SELECT item_id, doc_id, sum(times * w * ((1000000000 * tf) // (1000 * tf + 12 * m)))::BIGINT AS score
  FROM q JOIN w USING (term) JOIN tf USING (term) JOIN m USING (doc_id) GROUP BY item_id, doc_id)
SELECT item_id, rank::INTEGER AS rank, doc_id, score
FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM s WHERE score > 0)
WHERE rank <= {k}"""
