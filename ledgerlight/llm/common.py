"""Helpers shared by the operators: inputs, row identity, intermediate tables."""
from __future__ import annotations

import itertools
import tempfile
import uuid
import zipfile
from collections.abc import Iterator
from contextlib import contextmanager, nullcontext
from pathlib import Path

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.session import checkpoint_dir, ensure_conf


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Send this package to the executors, once for each application."""
    sc = spark.sparkContext
    if sc.applicationId in _shipped:
        return
    root = Path(__file__).resolve().parents[1]
    out = Path(tempfile.mkdtemp(prefix="package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(out, "w") as z:
        for f in sorted(root.rglob("*.py")):
            z.write(f, f.relative_to(root.parent))
    sc.addPyFile(str(out))
    _shipped.add(sc.applicationId)


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return ensure_conf(spark).read.parquet(f"{sf_dir}/{name}.parquet")


def texts_of(df: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text) only: other columns of any name are left behind, null text is empty."""
    ship(df.sparkSession)
    return df.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"),
                     F.coalesce(F.col(f"`{text_col}`").cast("string"), F.lit("")).alias("text"))


def text_tag(text: Column) -> Column:
    """32 bits of the text: with doc_id it names a row's content, so rows that repeat a
    doc_id with another text keep their own spans."""
    return F.hash(text)


def shared_path(spark: SparkSession, name: str) -> str:
    return f"{checkpoint_dir(spark).rstrip('/')}/llm/{name}-{uuid.uuid4().hex}"


@contextmanager
def batches_of(spark: SparkSession, most: int) -> Iterator[None]:
    """Jobs begun meanwhile hand rows to Python in batches that end at ``most`` bytes (one row at least)."""
    key = "spark.sql.execution.arrow.maxBytesPerBatch"
    was = spark.conf.get(key, None)
    spark.conf.set(key, str(most))
    try:
        yield
    finally:
        if was is None:
            spark.conf.unset(key)
        else:
            spark.conf.set(key, was)


def store(df: DataFrame, name: str, part_bytes: int | None = None) -> DataFrame:
    """Write a table into the shared folder and read it back: lineage is cut and the data
    outlives any executor. For tables of long rows ``part_bytes`` bounds what a task holds of them,
    whatever its share of the table: Python gets batches, and files have row groups, of about so
    many bytes (one row at least)."""
    path = shared_path(df.sparkSession, name)
    out = df.write.option("compression", "zstd")
    if part_bytes:  # a row group's size is looked at after each row, not after 100 first
        out = out.option("parquet.block.size", part_bytes).option("parquet.page.size.row.check.min", 1)
    with batches_of(df.sparkSession, part_bytes) if part_bytes else nullcontext():
        out.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def remove(df: DataFrame) -> None:
    """Delete the files of a stored table that no plan needs any more."""
    spark = df.sparkSession
    jvm = spark.sparkContext._jvm
    conf = spark.sparkContext._jsc.hadoopConfiguration()
    for folder in sorted({f.rsplit("/", 1)[0] for f in df.inputFiles()}):
        path = jvm.org.apache.hadoop.fs.Path(folder)
        path.getFileSystem(conf).delete(path, True)


def pieces(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """Batches cut to at most ``rows`` rows, so that Python objects stay few at a time."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def by_bytes(batches: Iterator[pa.RecordBatch], column: str, limit: int) -> Iterator[pa.RecordBatch]:
    """Batches cut where the texts of ``column`` reach ``limit`` bytes (one row at least)."""
    for b in batches:
        arr = b.column(column)
        if not b.num_rows:
            continue
        size = np.asarray(pa.compute.fill_null(pa.compute.binary_length(arr), 0), dtype=np.int64)
        group = (np.cumsum(size) - size) // limit
        cut = [0, *(np.flatnonzero(np.diff(group)) + 1).tolist(), b.num_rows]
        for i, j in itertools.pairwise(cut):
            yield b.slice(i, j - i)


def partitions_for(spark: SparkSession, least: int = 1) -> int:
    return max(least, int(spark.conf.get("spark.sql.shuffle.partitions")))


_FILTER_BITS = 1 << 23


def likely_in(df: DataFrame, column: str, ids: DataFrame) -> DataFrame:
    """Rows of ``df`` whose ``column`` may be one of ``ids`` (one column): a bitmap of hashes, one
    megabyte whatever the input, spares a following join most rows that it would only shuffle.
    It drops no row that the join needs."""
    hashed = lambda c: F.pmod(F.xxhash64(c), F.lit(_FILTER_BITS))
    place = ids.select(hashed(ids.columns[0]).alias("h"))
    parts = (place.groupBy(F.shiftright("h", 15).alias("part"))
             .agg(F.bitmap_construct_agg(F.col("h").bitwiseAND(32767)).alias("bits")).collect())  # at most 256 rows
    bits = np.zeros((_FILTER_BITS >> 15, 4096), np.uint8)
    for r in parts:
        bits[r.part] = np.frombuffer(r.bits, np.uint8)
    shared = df.sparkSession.sparkContext.broadcast(np.packbits(np.unpackbits(bits, axis=1, bitorder="little")).tobytes())

    def run(batches):
        flags = np.frombuffer(shared.value, np.uint8)
        for b in batches:
            h = b.column("h_").to_numpy()
            yield b.filter(pa.array((flags[h >> 3] >> (7 - (h & 7))) & 1 == 1)).drop_columns(["h_"])

    return df.withColumn("h_", hashed(column)).mapInArrow(run, df.schema)
