"""N-gram Jaccard join with parity sketches.

A text's set holds its distinct shingles of N words. A sketch has cells; every shingle falls into
one by its hash and is XORed into it, so a cell is the parity of its shingles' bits, and
equal sets have equal sketches. A shingle of only one of two sets changes one cell, so the
number of cells that differ (the Hamming distance of sketches) is at most the symmetric
difference. Sets linked at similarity t differ in at most (1-t)/(1+t) (|A|+|B|) shingles.

Pigeonhole: with more cells than that, some cells are equal, so linked sets meet in a join on
(band, cell, value). Bands are by size: the number of cells is a power of two that follows the
size, and a set that may be linked with smaller sets of the band below has cells there too.
Emptier cells say less; a set leaves out the cells with the fewest shingles, as many counts as it can
while more cells remain than can differ. Equal cells hold equally many shingles, so the
stricter of two sets' limits still leaves them one in common.

Cells are packed by bucket before the shuffle; a bucket gives back the cells that more than one
text has. Of a cell's texts, each is compared with the smallest of them first, then, while a cell's
components differ, with the largest, exactly. Links make components; texts of one cell whose components still differ are compared with each other
in blocks by a second sketch (one bit a cell), and what may be linked is verified. So a group
of thousands of near copies costs one comparison a text, and no link between different
components is lost.

Defined cases: texts without words, and null texts, have an empty set, no links, and are a component of
their own; texts of fewer than N words have their whole word sequence as one shingle; rows that
repeat a doc_id each give a row and share a component; rows with a null id get their size and a
null component, and link nothing; an empty table gives no rows; other columns are not read.
"""
from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import by_bytes, likely_in, partitions_for, store, texts_of
from ledgerlight.llm.debruijn import Codes
from ledgerlight.llm.windows import Rolling, mix

SHINGLE = 5
NUM, DEN = 80, 100  # similarity 0.8, in whole numbers
BITS = 2048  # of the second sketch
BLOCK_TEXTS = 512
DEALT = 4096  # rows of shared cells that are dealt out together, cells whole
HELD = 500_000  # cells that a task gathers before it deals them out
_BATCH = 1_000_000
_FOLD = bytes.maketrans(bytes(range(65, 91)), bytes(range(97, 123)))


def differ_at_most(a: int, b: int) -> int:
    """No linked sets of these sizes differ in more shingles."""
    return (a + b) * (DEN - NUM) // (NUM + DEN)


def largest_partner(a: int) -> int:
    return a * DEN // NUM


def cells_for(a: int) -> int:
    """Cells of the band in which a set of size ``a`` meets all sets as large or larger: more than
    can differ, and some to spare so that the emptiest can be left out."""
    least = differ_at_most(a, largest_partner(a)) + 1
    return 1 << (least + max(4, -(-least // 6)) - 1).bit_length()


def bands_of(size: int) -> list[int]:
    """Numbers of cells under which a set of this size can meet a partner: those of its own
    size and of every smaller size it may be linked with. They grow with the size."""
    c, top = cells_for(-(-size * NUM // DEN)), cells_for(size)
    out = []
    while c <= top:
        out.append(c)
        c *= 2
    return out


class Shingles:
    """Shingle sets of texts, as sorted arrays of 64-bit hashes."""

    def __init__(self):
        self._codes = Codes()

    def of(self, raw: list[bytes]) -> list[np.ndarray]:
        words = [t.translate(_FOLD).split() for t in raw]
        lengths = np.array([len(w) for w in words])
        codes = self._codes.of([w for x in words for w in x])
        h = Rolling(codes).grams(SHINGLE)
        out, at = [], 0
        for n in lengths.tolist():
            if n >= SHINGLE:
                out.append(np.unique(h[at: at + n - SHINGLE + 1]))
            else:
                short = np.zeros(1, np.uint64)
                for c in codes[at: at + n]:
                    short = mix(short + c + np.uint64(n))
                out.append(short if n else short[:0])
            at += n
        return out


def linked(a: np.ndarray, b: np.ndarray) -> bool:
    if not len(a) or not len(b):
        return False
    both = len(np.intersect1d(a, b, assume_unique=True))
    return DEN * both >= NUM * (len(a) + len(b) - both)


def cells(shingles: np.ndarray, n: int) -> np.ndarray:
    """Keys of the cells that a set has to show under ``n`` cells."""
    size = len(shingles)
    # sorted hashes lie in the order of their cells
    where = (shingles >> np.uint64(65 - n.bit_length())).astype(np.int64)
    count = np.bincount(where, minlength=n)
    ends = np.cumsum(count)
    x = np.concatenate([np.zeros(1, np.uint64), np.bitwise_xor.accumulate(mix(shingles))])
    value = x[ends] ^ x[ends - count]
    # at least so many cells equal those of any partner; of these, one is left if fewer are dropped
    spare = n - differ_at_most(size, largest_partner(size)) - 1
    below = np.cumsum(np.bincount(count))  # cells with at most so many shingles
    fewest = int(np.searchsorted(below, spare, "right"))
    keep = np.flatnonzero(count >= fewest)
    return mix(value[keep] ^ mix((keep + (n << 32)).astype(np.uint64)))


def bit_sketch(shingles: np.ndarray) -> bytes:
    """Parity of the shingles that fall on each of BITS bits."""
    n = np.bincount((mix(shingles ^ np.uint64(0x5851F42D4C957F2D)) & np.uint64(BITS - 1)).astype(np.int64), minlength=BITS)
    return np.packbits((n & 1).astype(np.uint8)).tobytes()


def wide_sketch(shingles: np.ndarray) -> bytes:
    """A sketch with a bit count that follows the size: four bits for each shingle that may differ."""
    n = max(64, 1 << (4 * differ_at_most(len(shingles), largest_partner(len(shingles)))).bit_length())
    at = np.bincount((mix(shingles ^ np.uint64(0x2545F4914F6CDD1D)) & np.uint64(n - 1)).astype(np.int64), minlength=n)
    return np.packbits((at & 1).astype(np.uint8), bitorder="little").tobytes()


def apart(a: bytes, b: bytes) -> int:
    """Hamming distance of two wide sketches; the longer one is folded to the other's bits."""
    x, y = np.frombuffer(a, np.uint64), np.frombuffer(b, np.uint64)
    while len(x) != len(y):
        if len(x) > len(y):
            x, y = y, x
        y = y[: len(y) // 2] ^ y[len(y) // 2:]
    return int(np.bitwise_count(x ^ y).sum())


SCAN = ("doc_id long, n_shingles long, set1 long, set2 long, bits binary, sketch binary, "
        "bucket int, known boolean, keys binary, docs binary")
_TYPES = pa.schema([("doc_id", pa.int64()), ("n_shingles", pa.int64()), ("set1", pa.int64()), ("set2", pa.int64()),
                    ("bits", pa.binary()), ("sketch", pa.binary()), ("bucket", pa.int32()), ("known", pa.bool_()),
                    ("keys", pa.binary()), ("docs", pa.binary())])


def _rows(**columns) -> pa.RecordBatch:
    n = len(next(iter(columns.values())))
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[f.name], f.type) if f.name in columns else pa.nulls(n, f.type) for f in _TYPES], schema=_TYPES)


def _scanned(texts: DataFrame, buckets: int) -> DataFrame:
    """One pass over the texts, two kinds of rows. For every text: doc_id, size, a 128-bit name
    of its set and two sketches. Of the texts of a task, by bucket: cells and whose they are.
    Texts of equal sets show their cells once. A cell that several texts of the task have goes to
    its bucket once, and with all of them, as known to be shared, to any bucket: no bucket gets
    more of a cell than tasks have blocks."""
    dealt = DEALT

    def flush(held):
        keys = np.concatenate([k for k, _ in held])
        docs = np.repeat(np.array([d for _, d in held], np.int64), [len(k) for k, _ in held])
        order = np.argsort(keys, kind="stable")
        keys, docs = keys[order], docs[order]
        first = np.append(True, keys[1:] != keys[:-1])
        copies = np.diff(np.append(np.flatnonzero(first), len(keys)))
        often = np.repeat(copies > 1, copies)
        several = copies[copies > 1]
        starts = np.repeat(np.cumsum(several) - several, several)  # where each row's cell begins: a cell stays whole
        for known, k, d, to in (
                (True, keys[often], docs[often], starts // dealt * 7919 % buckets),
                (False, keys[first], docs[first], (keys[first] % np.uint64(buckets)).astype(np.int64))):
            order = np.argsort(to, kind="stable")
            edge = np.searchsorted(to[order], np.arange(buckets + 1))
            some = np.flatnonzero(np.diff(edge))
            k, d = k[order], d[order]
            yield _rows(bucket=some.astype(np.int32), known=[known] * len(some),
                        keys=[k[edge[i]: edge[i + 1]].tobytes() for i in some],
                        docs=[d[edge[i]: edge[i + 1]].tobytes() for i in some])

    def run(batches):
        shingles = Shingles()
        held, size, seen = [], 0, set()
        for b in by_bytes(batches, "text", _BATCH):
            sets = shingles.of(b.column("text").cast(pa.binary()).to_pylist())
            ids = b.column("doc_id").to_pylist()
            name = [(int(mix(s).sum(dtype=np.uint64)), int(np.bitwise_xor.reduce(mix(s + np.uint64(97))))) if len(s) else (0, 0)
                    for s in sets]
            both = np.array(name, np.uint64).reshape(-1, 2).view(np.int64)
            yield _rows(doc_id=ids, n_shingles=[len(s) for s in sets], set1=both[:, 0], set2=both[:, 1],
                        bits=[bit_sketch(s) for s in sets], sketch=[wide_sketch(s) for s in sets])
            for doc, s, x in zip(ids, sets, name):
                if doc is None or not len(s) or x in seen:
                    continue
                seen.add(x)
                for n in bands_of(len(s)):
                    held.append((cells(s, n), doc))
                    size += len(held[-1][0])
            if size > HELD:
                yield from flush(held)
                held, size = [], 0
        if held:
            yield from flush(held)
        pa.default_memory_pool().release_unused()

    return texts.mapInArrow(run, SCAN)


def shared_cells(packed: DataFrame) -> DataFrame:
    """(key, doc, pivot) from the packed cells: every cell that several texts have, with each of them, and a smaller
    text of the same cell (or the text itself)."""
    n = partitions_for(packed.sparkSession)

    def stars(keys, docs):
        """The cells that stand there more than once, each with its smallest text as pivot."""
        order = np.lexsort((docs, keys))
        keys, docs = keys[order], docs[order]
        same = keys[1:] == keys[:-1]
        some = np.append(same, False) | np.append(False, same)
        keys, docs = keys[some], docs[some]
        at = np.flatnonzero(np.append(True, keys[1:] != keys[:-1])) if len(keys) else np.zeros(0, int)
        pivot = np.repeat(docs[at], np.diff(np.append(at, len(keys))))
        for i in range(0, len(keys), 100_000):
            yield pa.RecordBatch.from_arrays([pa.array(x[i: i + 100_000]) for x in (keys, docs, pivot)], ["key", "doc", "pivot"])

    def run(batches):
        # buckets come one after the other; one is held at a time, some bytes for each of its cells
        keys, docs, at = [], [], None
        for b in batches:
            for known, bucket, k, d in zip(*(b.column(c).to_pylist() for c in ("known", "bucket", "keys", "docs"))):
                k, d = np.frombuffer(k, "<i8"), np.frombuffer(d, "<i8")
                if known:
                    yield from stars(k, d)
                    continue
                if bucket != at and keys:
                    yield from stars(np.concatenate(keys), np.concatenate(docs))
                    keys, docs = [], []
                at = bucket
                keys.append(k)
                docs.append(d)
        if keys:
            yield from stars(np.concatenate(keys), np.concatenate(docs))
        pa.default_memory_pool().release_unused()

    return packed.repartition(n, "bucket").sortWithinPartitions("bucket").mapInArrow(run, "key long, doc long, pivot long")


def verify(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs (a, b) of doc_ids whose texts are linked."""
    texts = likely_in(texts, "doc_id", pairs.select(F.explode(F.array("a", "b")).alias("id")))
    members = (pairs.select("a", "b").join(texts.select(F.col("doc_id").alias("b"), F.col("text").alias("text_b")), "b")
               .join(texts.select(F.col("doc_id").alias("a"), F.col("text").alias("text_a")), "a"))

    def run(batches):
        shingles = Shingles()
        last, mine = None, None
        for b in by_bytes(batches, "text_b", _BATCH):
            firsts, seconds = b.column("a").to_pylist(), b.column("b").to_pylist()
            sets = shingles.of(b.column("text_b").cast(pa.binary()).to_pylist())
            out = []
            for a, c, s, t in zip(firsts, seconds, sets, b.column("text_a")):
                if (a, t) != last:
                    last, mine = (a, t), shingles.of([t.as_py().encode()])[0]
                if linked(mine, s):
                    out.append((a, c))
            yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in out], pa.int64()), pa.array([x for _, x in out], pa.int64())], ["a", "b"])

    return members.mapInArrow(run, "a long, b long")


def components(links: DataFrame) -> DataFrame:
    """(doc, component) of every doc in a link: the smallest doc it reaches. Large and small stars
    take turns, so paths shorten by halves and no neighbourhood is gathered in a task."""
    edges = store(links.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).where("u <> v").distinct(), "cc")
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        # every larger neighbour of u goes to u's smallest
        large = both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        large = large.where("u <> v").distinct()
        # and u with all its smaller ones to the smallest
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = (large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
                 .unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct())
        after = store(small, "cc")
        state = lambda e: e.agg(F.count("*"), F.bit_xor(F.xxhash64("u", "v"))).first()
        done = state(edges) == state(after)
        edges = after
        if done:
            return edges.select(F.col("u").alias("doc"), F.col("v").alias("component"))


def _across(rows: DataFrame) -> DataFrame:
    """Pairs of texts of one cell, of different components, that sizes and bit sketches let be linked.
    ``rows``: (key, doc, component, n, bits). A cell's texts are dealt to blocks by hash; every two
    blocks meet in a group, are compared in arrays, and only possible links leave."""
    sizes = rows.groupBy("key").agg(F.ceil(F.count("*") / BLOCK_TEXTS).cast("int").alias("blocks"))
    grid = (rows.join(sizes, "key").withColumn("own", F.pmod(F.xxhash64("doc"), F.col("blocks")).cast("int"))
            .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
            .select("key", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"), "own",
                    "doc", "component", "n", "bits"))

    def look(t):
        g, own, doc, comp, n = (t[c] for c in ("group", "own", "doc", "component", "n"))
        bits, within = t["bits"], t["within"]
        out, x, step = [], np.arange(len(g)), 1
        while len(x):
            x = x[x + step < len(g)]
            x = x[g[x] == g[x + step]]
            y = x + step
            total = n[x] + n[y]
            some = ((comp[x] != comp[y]) & (doc[x] != doc[y]) & (within[x] | (own[x] != own[y]))
                    & (NUM * np.maximum(n[x], n[y]) <= DEN * np.minimum(n[x], n[y])))
            a, b = x[some], y[some]
            near = np.bitwise_count(bits[a] ^ bits[b]).sum(axis=1) <= total[some] * (DEN - NUM) // (NUM + DEN)
            a, b = doc[a[near]], doc[b[near]]
            out.append(np.stack([np.minimum(a, b), np.maximum(a, b)], axis=1))
            step += 1
        out = np.unique(np.concatenate(out), axis=0) if out else np.zeros((0, 2), np.int64)
        return pa.RecordBatch.from_arrays([pa.array(out[:, 0], pa.int64()), pa.array(out[:, 1], pa.int64())], ["a", "b"])

    def arrays(table):
        key, i, j = (table.column(c).to_numpy() for c in ("key", "i", "j"))
        new = np.append(True, (key[1:] != key[:-1]) | (i[1:] != i[:-1]) | (j[1:] != j[:-1]))
        bits = np.frombuffer(b"".join(table.column("bits").to_pylist()), np.uint64).reshape(len(key), BITS // 64)
        return {c: table.column(c).to_numpy() for c in ("own", "doc", "component", "n")} | {
            "group": np.cumsum(new), "within": i == j, "bits": bits}

    def run(batches):
        held = None
        for b in batches:
            if not b.num_rows:
                continue
            t = pa.Table.from_batches([b]) if held is None else pa.concat_tables([held, pa.Table.from_batches([b])])
            g = arrays(t)["group"]
            cut = int(np.searchsorted(g, g[-1]))  # the last group may go on
            if cut:
                yield look(arrays(t.slice(0, cut)))
            held = t.slice(cut).combine_chunks()
        if held is not None:
            yield look(arrays(held))

    return (grid.repartition(partitions_for(rows.sparkSession), "key", "i", "j").sortWithinPartitions("key", "i", "j")
            .mapInArrow(run, "a long, b long").distinct())


def near_duplicates(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, n_shingles, component_id) for every row."""
    texts = texts_of(docs, id_col, text_col)
    known = texts.where(F.col("doc_id").isNotNull())
    scanned = store(_scanned(texts, 16 * partitions_for(docs.sparkSession)), "jac-scan")
    sets = scanned.where("bucket IS NULL").select("doc_id", "n_shingles", "set1", "set2", "bits", "sketch")
    named = sets.where("doc_id IS NOT NULL AND n_shingles > 0")
    # equal sets are linked: each with the smallest doc_id that has it
    classes = named.groupBy("set1", "set2").agg(F.min("doc_id").alias("a"))
    equal = named.join(classes, ["set1", "set2"]).where("doc_id > a").select("a", F.col("doc_id").alias("b"))
    info = named.select(F.col("doc_id").alias("doc"), F.col("n_shingles").alias("n"), "bits", "sketch")

    packed = scanned.where("bucket IS NOT NULL").select("bucket", "known", "keys", "docs")
    shared = store(shared_cells(packed), "jac-cells")
    first = shared.where("doc <> pivot").select(F.col("pivot").alias("a"), F.col("doc").alias("b")).distinct()
    pairs = store(_possible(first, info), "jac-pairs")
    links = store(verify(pairs, known).unionByName(equal), "jac-links")

    def by_component(links):
        found = components(links)
        return shared.join(found, "doc", "left").select("key", "doc", F.coalesce("component", "doc").alias("component"))

    # a second star, around each cell's largest text: most of a group's components meet here
    open_ = by_component(links)
    last = open_.groupBy("key").agg(F.max("doc").alias("last"), F.min("component").alias("c1"),
                                    F.max("component").alias("c2")).where("c1 <> c2").select("key", "last")
    far = (open_.join(last, "key").where("doc < last")
           .select(F.col("doc").alias("a"), F.col("last").alias("b")).distinct().join(pairs, ["a", "b"], "left_anti"))
    second = store(_possible(far, info), "jac-second")
    links = store(links.unionByName(verify(second, known)), "jac-links")
    pairs = pairs.unionByName(second)

    open_ = by_component(links)
    several = open_.groupBy("key").agg(F.min("component").alias("c1"), F.max("component").alias("c2")).where("c1 <> c2")
    rows = open_.join(several.select("key"), "key", "left_semi").distinct().join(info.drop("sketch"), "doc")
    more = store(_possible(_across(rows).join(pairs, ["a", "b"], "left_anti"), info), "jac-more")
    found = components(links.unionByName(store(verify(more, known), "jac-links")))

    return sets.join(found.withColumnRenamed("doc", "doc_id"), "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component", "doc_id").alias("component_id"))


def _possible(pairs: DataFrame, info: DataFrame) -> DataFrame:
    """Pairs whose sizes and wide sketches let them be linked."""
    side = lambda c: info.select(F.col("doc").alias(c), F.col("n").alias(f"n_{c}"), F.col("sketch").alias(f"sketch_{c}"))
    both = pairs.join(side("a"), "a").join(side("b"), "b").where(
        F.greatest("n_a", "n_b") * NUM <= F.least("n_a", "n_b") * DEN)

    def run(batches):
        for b in batches:
            n, m = b.column("n_a").to_pylist(), b.column("n_b").to_pylist()
            near = [apart(x, y) <= differ_at_most(i, j) for x, y, i, j in
                    zip(b.column("sketch_a").to_pylist(), b.column("sketch_b").to_pylist(), n, m)]
            yield b.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    return both.mapInArrow(run, "a long, b long").distinct()
