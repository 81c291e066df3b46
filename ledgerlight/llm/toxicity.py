"""Toxicity: a counterfactual-regularised linear classifier.

Features are the distinct words of a text (lower case, hashed to SLOTS), so a text's length
or repeated words carry no weight. Weights minimise the log loss, plus an L1 term that
leaves words without evidence at 0, plus the counterfactual term: every training text
with a neutral identity term is paired with the same text with the term swapped for each
other of its group, and the squared difference of the two scores is penalised. A training text
without such a term gets one after its last word, the terms of all groups in turn, and is paired with
itself with the next term of that group; so every group is compared in every fit. Naming a
group then moves no score, though the words about it may. The groups are a parameter; the
given ones are in English, Spanish, French and German.

The fit uses a bounded sample: the SAMPLE labelled rows with the smallest hash of doc_id; the
driver gets their slot numbers, never a text. Scoring reads every text whole.

Defined cases: null and empty texts have no features and get the score of the intercept;
rows with a null label, and ids that are null, teach nothing; ids labelled twice count once if the labels agree
and not at all if they differ; rows that repeat a doc_id teach as one; without labels of both kinds every score is the share of toxic ones (0
without any); repeated rows each give a row; an empty table gives no rows; other columns are not read.
"""
import re
import zlib
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerlight.llm.common import pieces, ship, texts_of

SLOTS = 1 << 18
SAMPLE = 12_000
LEAST_ROWS = 3  # words in fewer rows get no weight
COMMON = 0.3  # words in a larger share of the rows take shorter steps, so that they slow no other word
LAMBDA_SWAP = 1.0  # of the mean squared change over the pairs found, and over those joined for each group
TERM_STEP = 0.1  # identity terms take shorter steps, so that the penalty slows no other word
LAMBDA_L1 = 1e-4
STEPS = 300
MISS_WEIGHT = 2.0  # a toxic row counts this much in the loss
CUTOFF = 0.3

# Neutral names of groups; terms of one line may stand for each other.
IDENTITY_GROUPS = [
    ("women", "men", "girls", "boys"), ("woman", "man"), ("female", "male"),
    ("gay", "lesbian", "straight", "bisexual", "transgender"),
    ("muslim", "christian", "jewish", "hindu", "buddhist", "atheist"),
    ("muslims", "christians", "jews", "hindus", "buddhists", "atheists"),
    ("black", "white", "asian", "latino", "hispanic"),
    ("african", "american", "european", "mexican", "chinese", "indian"),
    ("immigrant", "refugee", "citizen"), ("immigrants", "refugees", "citizens"),
    ("deaf", "blind", "disabled"), ("old", "young"),
    ("mujeres", "hombres", "niñas", "niños"), ("mujer", "hombre"), ("lesbiana", "heterosexual", "homosexual"),
    ("musulmanes", "cristianos", "judíos", "budistas", "ateos"), ("negros", "blancos", "asiáticos", "latinos"),
    ("inmigrantes", "refugiados", "ciudadanos"), ("sordos", "ciegos", "discapacitados"), ("viejos", "jóvenes"),
    ("femmes", "hommes", "filles", "garçons"), ("femme", "homme"), ("lesbienne", "hétérosexuel", "homosexuel"),
    ("musulmans", "chrétiens", "juifs", "bouddhistes", "athées"), ("noirs", "blancs", "asiatiques"),
    ("immigrés", "réfugiés", "citoyens"), ("sourds", "aveugles", "handicapés"), ("vieux", "jeunes"),
    ("frauen", "männer", "mädchen", "jungen"), ("frau", "mann"), ("lesbisch", "schwul", "heterosexuell"),
    ("muslime", "christen", "juden", "buddhisten", "atheisten"), ("schwarze", "weiße", "asiaten"),
    ("einwanderer", "flüchtlinge", "bürger"), ("gehörlose", "blinde", "behinderte"), ("alte", "junge"),
]
_WORD = re.compile(r"[^\W\d_]+")


def words(text: str) -> set[str]:
    return set(_WORD.findall(text.lower()))


def slot(word: str) -> int:
    return zlib.crc32(word.encode("utf-8", "surrogatepass")) % SLOTS


def slots(found: set[str]) -> np.ndarray:
    return np.unique(np.fromiter(map(slot, found), np.int32, len(found)))


def group_of(groups: Sequence[Sequence[str]]) -> dict[str, tuple[Sequence[str], int]]:
    """Each term's group and its place there; a term of several groups counts for the first."""
    out: dict[str, tuple[Sequence[str], int]] = {}
    for g in groups:
        if len(g) > 1:
            for k, term in enumerate(g):
                out.setdefault(term, (g, k))
    return out


SWAPS = group_of(IDENTITY_GROUPS)


def twins(found: set[str], swaps: dict[str, tuple[Sequence[str], int]]) -> list[set[str]]:
    """The words with every identity term swapped: once for each other term of the largest group met."""
    named = found & swaps.keys()
    turns = max((len(swaps[w][0]) - 1 for w in named), default=0)
    return [(found - named) | {g[(k + 1 + turn % (len(g) - 1)) % len(g)] for g, k in (swaps[w] for w in named)}
            for turn in range(turns)]


@dataclass
class Model:
    weights: np.ndarray  # float32[SLOTS]
    intercept: float
    n_pairs: int = 0  # counterfactual pairs of the fit

    def score(self, text: str) -> float:
        z = self.intercept + float(self.weights[slots(words(text))].sum())
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))


def _log_loss_gradient(z, y):
    return 1 / (1 + np.exp(-np.clip(z, -50, 50))) - y


Pair = tuple[np.ndarray, np.ndarray, float]  # slots that a swap takes away and brings, and its weight in the penalty


def joined_pairs(rows: list[np.ndarray], order: np.ndarray, groups: Sequence[Sequence[str]]) -> list[Pair]:
    """Rows (those of ``order``, in that order) with a term put after them, and the same with the next term of its group.
    Rows and neighbouring terms are dealt out in turn until both are used up; each group weighs 1."""
    swaps = [(i, slot(a), slot(b)) for i, g in enumerate(groups) if len(g) > 1 for a, b in zip(g, [*g[1:], g[0]])]
    if not len(order) or not swaps:
        return []
    dealt = [(rows[order[k % len(order)]], *swaps[k % len(swaps)]) for k in range(max(len(order), len(swaps)))]
    times = np.bincount([i for _, i, _, _ in dealt])
    return [(np.setdiff1d([a], r), np.setdiff1d([b], r), 1.0 / times[i]) for r, i, a, b in dealt]


def fit(rows: list[np.ndarray], labels: np.ndarray, pairs: Sequence[Pair], lambda_swap: float = LAMBDA_SWAP,
        l1: float = LAMBDA_L1, steps: int = STEPS) -> Model:
    """Accelerated proximal gradient over sparse rows. A pair adds ``lambda_swap`` times its weight times the
    squared change of the linear score under its swap."""
    y = labels.astype(float)
    if not len(y) or y.min() == y.max():
        share = float(y.mean()) if len(y) else 0.0
        return Model(np.zeros(SLOTS, np.float32), float(np.log((share + 1e-12) / (1 - share + 1e-12))), len(pairs))
    n, weight = len(rows), np.where(y > 0, MISS_WEIGHT, 1.0)
    seen = np.bincount(np.concatenate(rows), minlength=SLOTS)
    kept = seen >= LEAST_ROWS
    rows = [r[kept[r]] for r in rows]
    # a pair's row holds +1 for a slot it loses and -1 for one it gains
    sides = [x[kept[x]] for lost, gained, _ in pairs for x in (lost, gained)]
    used, flat = np.unique(np.concatenate([*rows, *sides]).astype(np.int64), return_inverse=True)
    sizes = [len(r) for r in [*rows, *sides]]
    owner = np.repeat(np.concatenate([np.arange(n), n + np.arange(len(sides)) // 2]), sizes)
    sign = np.repeat(np.concatenate([np.ones(n), np.tile([1.0, -1.0], len(pairs))]), sizes)
    cost = lambda_swap * np.array([c for _, _, c in pairs], float)
    product = lambda w: np.bincount(owner, w[flat] * sign, n + len(pairs))
    back = lambda g: np.bincount(flat, g[owner] * sign, len(used))
    # steps that descend: the curvature of loss and penalty over scaled words, by power iteration
    common = seen[used] > COMMON * n
    scale = np.where(common, COMMON * n / np.maximum(seen[used], 1) / np.sqrt(max(1, common.sum())), 1.0)
    scale[flat[owner >= n]] = np.minimum(scale[flat[owner >= n]], TERM_STEP)
    curve = np.concatenate([np.full(n, 0.25 * MISS_WEIGHT / n), 4 * cost])
    v = np.ones(len(used))
    for _ in range(12):
        v /= max(np.linalg.norm(v), 1e-300)
        v = np.sqrt(scale) * back(curve * product(np.sqrt(scale) * v))
    step_b = 1.0 / (np.linalg.norm(v) + 0.25 * MISS_WEIGHT)
    step = step_b * scale
    w, b, prior, prior_b, t = np.zeros(len(used)), float(np.log(y.mean() / (1 - y.mean()))), np.zeros(len(used)), None, 1.0
    prior_b = b
    for _ in range(steps):
        t_next = (1 + np.sqrt(1 + 4 * t * t)) / 2
        m = (t - 1) / t_next
        u, ub = w + m * (w - prior), b + m * (b - prior_b)
        s = product(u)
        g = np.concatenate([weight * _log_loss_gradient(s[:n] + ub, y) / n, 2 * cost * s[n:]])
        gb = g[:n].sum()
        z = u - step * back(g)
        prior, prior_b, t = w, b, t_next
        w = np.sign(z) * np.maximum(np.abs(z) - step * l1, 0)
        b = ub - step_b * gb
    out = np.zeros(SLOTS, np.float32)
    out[used] = w
    return Model(out, float(b), len(pairs))


def held_out(doc_id: Column) -> Column:
    """Rows that no fit may see: crc32 of the id as text leaves 2, divided by 4."""
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 4 == 2, F.lit(False))


def train(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
          label_col: str = "toxic", sample: int = SAMPLE, lambda_swap: float = LAMBDA_SWAP,
          groups: Sequence[Sequence[str]] = IDENTITY_GROUPS) -> Model:
    """Fit on at most ``sample`` labelled rows outside the held-out fold; terms of ``groups`` in lower case."""
    swaps = group_of(groups)
    marks = (labels.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{label_col}`").cast("int").alias("y"))
             .where(F.col("doc_id").isNotNull() & F.col("y").isin(0, 1) & ~held_out(F.col("doc_id")))
             .groupBy("doc_id").agg(F.min("y").alias("y"), F.max("y").alias("y2")).where("y = y2").drop("y2"))
    bounded = marks.orderBy(F.xxhash64("doc_id"), "doc_id").limit(sample)

    def features(batches):
        for b in pieces(batches):
            found = [words(t) for t in b.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [b.column("doc_id"), b.column("y"), b.column("h"), pa.array([slots(f) for f in found], pa.list_(pa.int32())),
                 pa.array([[slots(x) for x in twins(f, swaps)] for f in found], pa.list_(pa.list_(pa.int32())))],
                ["doc_id", "y", "h", "slots", "twins"])

    # rows that repeat an id teach as one, of the text with the smallest hash: at most ``sample`` rows
    once = (texts_of(docs, id_col, text_col).join(F.broadcast(bounded), "doc_id")
            .groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text", "y")).alias("m"))
            .select("doc_id", "m.h", "m.text", "m.y"))
    rows = (once.mapInArrow(features, "doc_id long, y int, h long, slots array<int>, twins array<array<int>>")
            .toArrow().sort_by("doc_id"))
    x = [np.asarray(r, np.int32) for r in rows.column("slots").to_pylist()]
    swapped = [[np.asarray(r, np.int32) for r in t] for t in rows.column("twins").to_pylist()]
    found = [(np.setdiff1d(r, r2), np.setdiff1d(r2, r)) for r, t in zip(x, swapped) for r2 in t]
    pairs = [(lost, gained, 1.0 / len(found)) for lost, gained in found]
    nameless = np.array([not t for t in swapped], bool)
    order = np.argsort(rows.column("h").to_numpy(), kind="stable")  # by a hash of the text
    pairs += joined_pairs(x, order[nameless[order]], groups)
    return fit(x, rows.column("y").to_numpy(), pairs, lambda_swap)


def scorer(spark: SparkSession, model: Model) -> Callable[[Column], Column]:
    """A column's texts to their scores; null texts are empty."""
    ship(spark)
    used = np.flatnonzero(model.weights)
    # at most SLOTS weights, few of them not 0
    shared = spark.sparkContext.broadcast((used.astype(np.int32), model.weights[used], model.intercept))
    memo: dict[str, int] = {}

    def score(t: str | None, weights: np.ndarray, intercept: float) -> float:
        hit = set()
        for word in words(t or ""):
            s = memo.get(word)
            if s is None:
                s = memo[word] = slot(word) if weights[slot(word)] else -1
            if s >= 0:
                hit.add(s)
        z = intercept + (float(weights[sorted(hit)].sum(dtype=np.float64)) if hit else 0.0)
        return float(1 / (1 + np.exp(-np.clip(z, -50, 50))))

    @F.pandas_udf("double")
    def scores(batches: Iterator[pd.Series]) -> Iterator[pd.Series]:
        at, w, intercept = shared.value
        weights = np.zeros(SLOTS, np.float32)
        weights[at] = w
        for texts in batches:
            yield pd.Series([score(t, weights, intercept) for t in texts], dtype="float64")
            if len(memo) > 400_000:
                memo.clear()

    return lambda column: scores(column.cast("string"))


def score_documents(docs: DataFrame, model: Model, id_col: str = "doc_id", text_col: str = "text",
                    cutoff: float = CUTOFF) -> DataFrame:
    """(doc_id, held_out, score, predicted) for every row."""
    score = scorer(docs.sparkSession, model)
    return (docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), score(F.col(f"`{text_col}`")).alias("score"))
            .select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score",
                    (F.col("score") >= cutoff).cast("int").alias("predicted")))


def keep_accepted(docs: DataFrame, model: Model, text_col: str = "text", cutoff: float = CUTOFF) -> DataFrame:
    """The rows whose score is under the cutoff, with all their columns."""
    return docs.where(scorer(docs.sparkSession, model)(F.col(f"`{text_col}`")) < cutoff)
