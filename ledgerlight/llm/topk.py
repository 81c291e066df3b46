"""Exact top-k by integer inner product: every query meets every row, term at a time.

Rows are cut into blocks that carry an inverted index (term -> rows of the block with that
term, and their weights). A block of queries meets a block of rows in one task: for each
term the queries' weights are scattered over the term's postings into a dense array of
scores, the best k of the block are selected by partition, and the winners of all blocks
are merged by rank. A task holds QUERY_BLOCK x ROW_BLOCK scores at most, whatever the input. Query blocks
travel in groups of up to GROUP: a cell is one block of rows, shuffled once a group, and the group's query
blocks, which stream past it one after the other.

Defined cases: vectors that are null, empty or hold a null or non-finite component take no
part; vectors of different lengths meet on the terms they share; equal scores rank by
smaller vec_id; a query's own vec_id is no candidate, so rows that repeat an id don't find
each other; repeated rows of one id and vector are one row, rows that repeat an id with other vectors are
candidates of their own (of such an id the smallest vector asks); scores that could pass 64 bits end the job
with an error; an empty table gives no rows.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ledgerlight.llm.common import partitions_for, pieces, ship, store

QUERY_BLOCK = 256
GROUP = 64
ROW_BLOCK = 8192
SCALE = 64.0


def quantized(df: DataFrame, id_col: str, vec_col: str, scale: float) -> DataFrame:
    """(id, w): floor(scale * x) of every component, for the rows that take part."""
    v = F.transform(F.col(f"`{vec_col}`"), lambda x: x.cast("double"))
    ok = F.col(f"`{vec_col}`").isNotNull() & (F.size(F.col(f"`{vec_col}`")) > 0) & F.forall(
        v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return (df.where(F.col(f"`{id_col}`").isNotNull() & ok)
            .select(F.col(f"`{id_col}`").cast("long").alias("id"),
                    F.transform(v, lambda x: F.floor(x * scale).cast("long")).alias("w")))


def _blocks(rows: DataFrame, size: int, name: str) -> tuple[DataFrame, int]:
    """Blocks of about ``size`` rows and their number: (block, ids, dims, w) with the weights row after row. A block
    is a hash slice of ids and vectors, so none depends on the order of the input and a repeated id fills no block."""
    rows = store(rows, f"topk-{name}-rows")
    slices = -(-rows.count() // size)

    def pack(key, table):
        t = table.sort_by("id")
        w = t.column("w").combine_chunks()
        lens = pa.compute.list_value_length(w).to_numpy().astype(np.int32)
        return pa.table({"block": pa.array([key[0].as_py()], pa.int32()),
                         "ids": [t.column("id").to_numpy().astype("<i8").tobytes()],
                         "dims": [lens.astype("<i4").tobytes()],
                         "w": [w.flatten().to_numpy().astype("<i8").tobytes()]},
                        schema=pa.schema([("block", pa.int32()), ("ids", pa.binary()), ("dims", pa.binary()),
                                          ("w", pa.binary())]))

    packed = (rows.withColumn("block", F.pmod(F.xxhash64("id", "w"), F.lit(max(1, slices))).cast("int"))
              .groupBy("block").applyInArrow(pack, "block int, ids binary, dims binary, w binary"))
    return store(packed, f"topk-{name}"), slices


def _matrix(dims: bytes, w: bytes) -> np.ndarray:
    """Rows x terms; missing terms weigh 0."""
    d, flat = np.frombuffer(dims, "<i4"), np.frombuffer(w, "<i8")
    out = np.zeros((len(d), int(d.max(initial=0))), np.int64)
    out[np.repeat(np.arange(len(d)), d), np.arange(len(flat)) - np.repeat(np.cumsum(d) - d, d)] = flat
    return out


def _score_type(q: np.ndarray, c: np.ndarray) -> type:
    most = float(np.abs(q.astype(float)).max(initial=0)) * float(np.abs(c.astype(float)).max(initial=0)) * max(1, q.shape[1])
    if most < 2**31:
        return np.int32
    n = min(q.shape[1], c.shape[1])
    if most >= 2**62 and (np.abs(q[:, :n].astype(float)) @ np.abs(c[:, :n].astype(float)).T).max(initial=0) >= 2**62:
        raise OverflowError("inner products pass 64 bits; use a smaller scale")
    return np.int64


def postings(c: np.ndarray) -> list[tuple[np.ndarray | None, np.ndarray]]:
    """By term: rows that hold it and their weights. A term in most rows of the block keeps
    its weights in row order instead, so that scattering is one sweep."""
    out = []
    for t in range(c.shape[1]):
        rows = np.flatnonzero(c[:, t])
        out.append((None, np.ascontiguousarray(c[:, t])) if len(rows) * 4 > len(c) else (rows, c[rows, t]))
    return out


def accumulate(q: np.ndarray, index: list, n_rows: int, kind: type) -> np.ndarray:
    """Scores of a few queries against a block, one term after the other."""
    acc = np.zeros((len(q), n_rows), kind)
    tmp = np.empty((len(q), n_rows), kind)
    for t in range(min(q.shape[1], len(index))):
        some = np.flatnonzero(q[:, t])
        if not len(some):
            continue
        rows, w = index[t]
        if rows is not None:
            if len(rows):
                acc[np.ix_(some, rows)] += np.multiply.outer(q[some, t].astype(kind), w.astype(kind))
        else:
            np.multiply(q[:, t].astype(kind)[:, None], w.astype(kind)[None, :], out=tmp)
            acc += tmp
    return acc


def best(acc: np.ndarray, k: int) -> np.ndarray:
    """Column numbers of each row's k largest scores, ties to the smaller column."""
    n = acc.shape[1]
    if n <= k:
        return np.tile(np.arange(n), (len(acc), 1))
    out = np.empty((len(acc), k), np.int64)
    kth = np.partition(acc, n - k, axis=1)[:, n - k]
    for i, least in enumerate(kth):
        above = np.flatnonzero(acc[i] > least)
        out[i] = np.concatenate([above, np.flatnonzero(acc[i] == least)[: k - len(above)]])
    return out


STRIPE = 512


def top_k(df: DataFrame, queries: DataFrame, k: int = 20, id_col: str = "vec_id", vec_col: str = "embedding",
          scale: float = SCALE) -> DataFrame:
    """(query_id, rank, vec_id, score): the k best rows of ``df`` for every row of ``queries``."""
    spark = df.sparkSession
    ship(spark)
    rows, n_rows = _blocks(quantized(df, id_col, vec_col, scale).distinct(), ROW_BLOCK, "rows")
    asks, n_asks = _blocks(quantized(queries, id_col, vec_col, scale).groupBy("id").agg(F.min("w").alias("w")),
                           QUERY_BLOCK, "asks")
    least = partitions_for(spark, 12)
    # small inputs go in smaller groups, so that every core has cells
    group = max(1, min(GROUP, n_rows * n_asks // (8 * least)))
    groups = -(-n_asks // group)

    def meet(batches):
        cid = c = parts = None
        for b in pieces(batches, 8):
            for r in b.to_pylist():
                ids, m = np.frombuffer(r["ids"], "<i8"), _matrix(r["dims"], r["w"])
                if not r["asks"]:
                    cid, c = ids, m
                    parts = [postings(c[i: i + STRIPE]) for i in range(0, len(cid), STRIPE)]
                    continue
                kind = _score_type(m, c)
                for j in range(0, len(ids), 64):
                    some = ids[j: j + 64]
                    acc = np.concatenate([accumulate(m[j: j + 64], index, len(cid[i * STRIPE: (i + 1) * STRIPE]), kind)
                                          for i, index in enumerate(parts)], axis=1)
                    first, end = np.searchsorted(cid, some), np.searchsorted(cid, some, "right")
                    for i, (lo, hi) in enumerate(zip(first, end)):
                        acc[i, lo:hi] = np.iinfo(kind).min  # the query itself comes last
                    got_q, got_c, got_s = [], [], []
                    for i, cols in enumerate(best(acc, k)):
                        keep = cols[cid[cols] != some[i]]
                        got_q.append(np.full(len(keep), some[i]))
                        got_c.append(cid[keep])
                        got_s.append(acc[i, keep].astype(np.int64))
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(x) if x else np.array([], np.int64), pa.int64())
                         for x in (got_q, got_c, got_s)], ["query_id", "vec_id", "score"])

    # a cell is a block of rows and a group of query blocks; the rows come first
    upto = lambda n: F.explode(F.sequence(F.lit(0), F.lit(max(1, n) - 1)))
    data = ("ids", "dims", "w")
    cells = (rows.select("block", upto(groups).alias("group"), F.lit(False).alias("asks"), *data)
             .unionByName(asks.select(upto(n_rows).alias("block"), F.floor(F.col("block") / group).cast("int").alias("group"),
                                      F.lit(True).alias("asks"), *data)))
    n = min(max(least, n_rows * groups // 4), 200_000)
    found = (cells.where(F.lit(n_rows > 0 and n_asks > 0)).repartition(n, "block", "group")
             .sortWithinPartitions("block", "group", "asks").mapInArrow(meet, "query_id long, vec_id long, score long"))
    order = Window.partitionBy("query_id").orderBy(F.col("score").desc(), F.col("vec_id"))
    return (found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)
            .select("query_id", "rank", "vec_id", "score"))
