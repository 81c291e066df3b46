"""Token ids on disk as compressed bit planes.

Texts are encoded with a public byte-level BPE, an end id closes every document, and the
ids run on in ascending doc_id order. They are cut into blocks of BLOCK ids; a block is
transposed so that equal bits (or bytes) of all its ids lie together, and every plane is a
zstandard frame. A block's row also holds its chunk index: for every document with ids in
the block the document's id, its number in the part, how many of its ids lie in earlier
blocks, and how many lie here. So each block is read without any other.

Blocks are rows of a Parquet table: Spark's committer makes a part appear whole or not at
all, whichever executor is lost, and the table lies in any store that Spark writes to.

Block: b"BPL1", mode (0 bits, 1 bytes), number of planes, number of ids (u32), the size of
each plane (u32 each), the planes' frames; little-endian, most significant plane first.

Defined cases: null text is empty and has the end id only; rows with a null doc_id come
first; rows that repeat a doc_id each keep their ids, ordered by text; an empty table gives
no blocks; other columns are not read.
"""
from __future__ import annotations

import re
import struct
import zlib
from functools import cache
from itertools import pairwise

import numpy as np
import pyarrow as pa
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerlight.llm.common import by_bytes, partitions_for, pieces, ship, shared_path, texts_of
from ledgerlight.llm.crc import crc_of_parts
from ledgerlight.llm.memo import ByteLevel
from ledgerlight.llm.units import UnitCache

BLOCK = 65_536
END_ID = 0
MOST_UNITS = 900_000  # remembered by a worker
WINDOW_BYTES = 2_000_000  # of texts encoded together
MAGIC = b"BPL1"
# Units one text at a time, for packing and alignment; ``units.py`` cuts whole columns.
# Fixed value: Unicode's White_Space. The tokenizer's pattern never joins a character and the
# white space after it, so a text falls into units there.
SPACE = "\t\n\x0b\x0c\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_LETTER, _SIGN = "A-Za-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff", r"!-&(-/:-@\[-`{-~"  # signs: ASCII but the apostrophe
_LINE = SPACE.replace(" ", "")
# Nor does it join letters, digits and signs to each other, but for an apostrophe and what
# follows, and a run of white space ends before its last character if a word follows.
UNIT = re.compile("|".join((
    rf" ?[{_LETTER}]+(?!\w)", r" ?[0-9]+(?!\w)", rf" ?[{_SIGN}]+(?=[A-Za-z0-9{SPACE}]|\Z)",
    f"[{_LINE}](?=[^{SPACE}])", f"[{SPACE}]+(?=[{SPACE}][^{SPACE}])", f"[{SPACE}]*[^{SPACE}]+", f"[{SPACE}]+")))
COARSE = re.compile(f"[{SPACE}]*[^{SPACE}]+|[{SPACE}]+")  # for texts with what may be a special token


@cache
def _cache(tokenizer_path: str) -> UnitCache:
    return UnitCache(ByteLevel(tokenizer_path, special_as_text=False), MOST_UNITS)


def encode_texts(texts: list[str], tokenizer_path: str) -> list[np.ndarray]:
    """Ids of each text, without an end id."""
    ids, at = _cache(tokenizer_path).ids(pa.array(texts, pa.string()))
    return [ids[i:j] for i, j in pairwise(at.tolist())]


def pack_block(ids: np.ndarray, mode: str = "byte", level: int = 1) -> bytes:
    """One block from at least one id."""
    ids = np.ascontiguousarray(ids, ">u4")
    rows = ids.view(np.uint8).reshape(-1, 4)
    width = max(1, int(ids.max()).bit_length())
    if mode == "bit":
        used = -(-width // 8)
        planes = np.packbits(np.unpackbits(rows[:, 4 - used:], axis=1)[:, used * 8 - width:].T, axis=1)
    else:
        planes = rows[:, 4 - -(-width // 8):].T
    press = zstandard.ZstdCompressor(level=level)
    frames = [press.compress(np.ascontiguousarray(p).tobytes()) for p in planes]
    head = struct.pack("<4sBBI", MAGIC, int(mode == "byte"), len(frames), len(ids))
    return head + struct.pack(f"<{len(frames)}I", *map(len, frames)) + b"".join(frames)


def unpack_block(block: bytes) -> np.ndarray:
    magic, by_byte, n_planes, n = struct.unpack_from("<4sBBI", block)
    if magic != MAGIC:
        raise ValueError("not a block of token ids")
    sizes = struct.unpack_from(f"<{n_planes}I", block, 10)
    at, planes, press = 10 + 4 * n_planes, [], zstandard.ZstdDecompressor()
    for size in sizes:
        planes.append(np.frombuffer(press.decompress(block[at: at + size]), np.uint8))
        at += size
    planes = np.stack(planes)
    out = np.zeros((n, 4), np.uint8)
    if by_byte:
        out[:, 4 - n_planes:] = planes.T
    else:
        bits = np.unpackbits(planes, axis=1, count=n)
        used = -(-n_planes // 8)
        full = np.zeros((n, used * 8), np.uint8)
        full[:, used * 8 - n_planes:] = bits.T
        out[:, 4 - used:] = np.packbits(full, axis=1)
    return out.view(">u4").ravel().astype("<u4")


BLOCK_SCHEMA = ("part int, block int, n_ids int, payload binary, "
                "docs array<struct<doc_id:long,seq:long,before:long,n:int>>")


class _Writer:
    """Collects the ids of one part and gives its blocks away as they fill."""

    def __init__(self, part: int, size: int, mode: str):
        self.part, self.size, self.mode = part, size, mode
        self.block = self.fill = self.seq = 0
        self.held, self.docs = [], []

    def add(self, doc_id: int | None, ids: np.ndarray):
        before = 0
        while before < len(ids):
            take = ids[before: before + self.size - self.fill]
            self.held.append(take)
            self.docs.append({"doc_id": doc_id, "seq": self.seq, "before": before, "n": len(take)})
            self.fill += len(take)
            before += len(take)
            if self.fill == self.size:
                yield self.flush()
        self.seq += 1

    def flush(self) -> dict:
        row = {"part": self.part, "block": self.block, "n_ids": self.fill,
               "payload": pack_block(np.concatenate(self.held), self.mode), "docs": self.docs}
        self.block, self.fill, self.held, self.docs = self.block + 1, 0, [], []
        return row


def _batch(rows: list[dict]) -> pa.RecordBatch:
    doc = pa.struct([("doc_id", pa.int64()), ("seq", pa.int64()), ("before", pa.int64()), ("n", pa.int32())])
    return pa.RecordBatch.from_pylist(rows, pa.schema([
        ("part", pa.int32()), ("block", pa.int32()), ("n_ids", pa.int32()), ("payload", pa.binary()),
        ("docs", pa.list_(doc))]))


def write_ids(docs: DataFrame, path: str, tokenizer_path: str, mode: str = "byte", block: int = BLOCK,
              id_col: str = "doc_id", text_col: str = "text", end_id: int = END_ID) -> None:
    """Encode and write every text; parts hold ascending ranges of doc_id."""
    spark = docs.sparkSession
    texts = texts_of(docs, id_col, text_col)
    end = np.array([end_id], "<u4")

    def run(batches):
        w = _Writer(TaskContext.get().partitionId(), block, mode)
        for b in by_bytes(batches, "text", WINDOW_BYTES):
            out = []
            ids, at = _cache(tokenizer_path).ids(b.column("text"))
            for doc_id, (i, j) in zip(b.column("doc_id").to_pylist(), pairwise(at.tolist())):
                out += w.add(doc_id, np.concatenate([ids[i:j], end]))
            if out:
                yield _batch(out)
        if w.fill:
            yield _batch([w.flush()])

    (texts.repartitionByRange(partitions_for(spark), "doc_id").sortWithinPartitions("doc_id", "text")
     .mapInArrow(run, BLOCK_SCHEMA).write.option("compression", "none").parquet(path))


def read_blocks(spark: SparkSession, path: str) -> DataFrame:
    ship(spark)
    return spark.read.schema(BLOCK_SCHEMA).parquet(path)


PIECE_SCHEMA = "part int, seq long, doc_id long, before long, at long, n int, ids array<int>"


def read_ids(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """One row for each document's ids in each block: (part, seq, doc_id, before, at, n, ids);
    ``at`` counts from the part's first id."""

    def run(batches):
        for b in pieces(batches, 4):
            for r in b.to_pylist():
                ids, n = unpack_block(r["payload"]), [d["n"] for d in r["docs"]]
                edge = np.concatenate([[0], np.cumsum(n)])
                col = lambda k: [d[k] for d in r["docs"]]
                yield pa.RecordBatch.from_arrays([
                    pa.array([r["part"]] * len(n), pa.int32()), pa.array(col("seq"), pa.int64()),
                    pa.array(col("doc_id"), pa.int64()), pa.array(col("before"), pa.int64()),
                    pa.array(edge[:-1] + r["block"] * block, pa.int64()), pa.array(n, pa.int32()),
                    pa.ListArray.from_arrays(pa.array(edge, pa.int32()), pa.array(ids.astype(np.int32)))],
                    ["part", "seq", "doc_id", "before", "at", "n", "ids"])

    return read_blocks(spark, path).mapInArrow(run, PIECE_SCHEMA)


def digests(spark: SparkSession, path: str, block: int = BLOCK) -> DataFrame:
    """(doc_id, start, n_tokens, ids_crc32) of every document, from the files alone."""

    def run(batches):
        for b in pieces(batches, 4):
            for r in b.to_pylist():
                raw, at, rows = memoryview(unpack_block(r["payload"]).tobytes()), 0, []
                for d in r["docs"]:
                    rows.append({"part": r["part"], "seq": d["seq"], "doc_id": d["doc_id"], "before": d["before"],
                                 "at": r["block"] * block + at, "n": d["n"],
                                 "crc": zlib.crc32(raw[4 * at: 4 * (at + d["n"])])})
                    at += d["n"]
                yield pa.RecordBatch.from_pylist(rows, pa.schema([
                    ("part", pa.int32()), ("seq", pa.int64()), ("doc_id", pa.int64()), ("before", pa.int64()),
                    ("at", pa.int64()), ("n", pa.int64()), ("crc", pa.int64())]))

    @F.pandas_udf("long")
    def whole(parts):
        return parts.map(lambda p: p[0]["crc"] if len(p) == 1 else crc_of_parts([(x["crc"], 4 * x["n"]) for x in p]))

    stored = read_blocks(spark, path)
    # one row for each part: as many as the write had tasks
    sizes = stored.groupBy("part").agg(F.sum(F.col("n_ids").cast("long")).alias("ids"))
    base = sizes.select("part", F.coalesce(F.sum("ids").over(
        Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0)).alias("base"))
    pieces_ = stored.mapInArrow(run, "part int, seq long, doc_id long, before long, at long, n long, crc long")
    return (pieces_.groupBy("part", "seq")
            .agg(F.first("doc_id").alias("doc_id"), F.min("at").alias("at"), F.sum("n").alias("n_tokens"),
                 F.array_sort(F.collect_list(F.struct("before", "n", "crc"))).alias("parts"))
            .join(base, "part")
            .select("doc_id", (F.col("base") + F.col("at")).alias("start"), "n_tokens", whole("parts").alias("ids_crc32")))


def encode_and_digest(docs: DataFrame, tokenizer_path: str, mode: str = "byte") -> DataFrame:
    """Write the ids into the shared folder, then read them back."""
    path = shared_path(docs.sparkSession, "token-ids")
    write_ids(docs, path, tokenizer_path, mode)
    return digests(docs.sparkSession, path)
