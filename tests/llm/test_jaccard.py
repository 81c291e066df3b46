import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import jaccard
from ledgerlight.llm.windows import mix


def shingles(text):
    w = "".join(c.lower() if c.isascii() else c for c in text or "").encode().split()
    return {tuple(w[i: i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())


def brute(rows):
    sets = [(i, shingles(t)) for i, t in rows]
    root = {i: i for i, _ in rows}

    def top(i):
        while root[i] != i:
            i = root[i]
        return i

    for x, (i, a) in enumerate(sets):
        for j, b in sets[:x]:
            if i is not None and j is not None and a and b and 100 * len(a & b) >= 80 * len(a | b):
                p, q = top(i), top(j)
                root[max(p, q)] = min(p, q)
    return sorted(((i, len(a), None if i is None else top(i)) for i, a in sets), key=str)


def corpus(seed, n=140):
    rng = np.random.default_rng(seed)
    word = lambda: f"w{int(rng.integers(300))}"
    text = lambda n: " ".join(word() for _ in range(n))
    families = [text(int(k)) for k in (6, 12, 40, 90, 200)]
    passage = text(30)
    rows = []
    for i in range(n):
        kind = i % 5
        if kind < 3:  # edits at every strength, so that some pairs sit just under and over 0.8
            w = families[int(rng.integers(len(families)))].split()
            for _ in range(int(rng.integers(0, max(1, len(w) // 25 + 2)))):
                w[int(rng.integers(len(w)))] = word()
            if rng.random() < 0.3:
                w = w[: int(len(w) * rng.uniform(0.7, 1))]
            rows.append((i, " ".join(w)))
        elif kind == 3:
            rows.append((i, passage + " " + text(int(rng.integers(0, 14)))))
        else:
            rows.append((i, text(int(rng.integers(0, 9)))))
    return rows + [(500, None), (501, ""), (502, " \n"), (None, families[1]), (503, families[1].upper()), (504, "one two"),
                   (505, "ONE\ttwo"), (506, "two one"), (7, families[2]), (3, families[4]), (3, families[3])]


@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, docs_of, seed, monkeypatch):
    monkeypatch.setattr(jaccard, "BLOCK_TEXTS", 4 if seed == 1 else 512)
    rows = corpus(seed)
    got = jaccard.near_duplicates(docs_of(rows)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@pytest.mark.parametrize("dealt", [2, 3])
def test_cells_stay_whole_when_they_are_dealt_out(spark, docs_of, dealt, monkeypatch):
    monkeypatch.setattr(jaccard, "DEALT", dealt)
    rng = np.random.default_rng(dealt)
    rows = []
    for i in range(60):  # groups of two to four short texts, which share few cells
        w = [f"g{i}x{k}" for k in range(int(rng.integers(8, 12)))]
        rows += [(len(rows) + j, " ".join(w + [f"own{i}y{j}"] * (j > 0))) for j in range(2 + i % 3)]
    got = jaccard.near_duplicates(docs_of(rows).coalesce(1)).collect()
    assert sorted((tuple(r) for r in got), key=str) == brute(rows)


@settings(max_examples=300, deadline=None)
@given(st.integers(1, 400), st.integers(0, 100), st.integers(0, 100), st.integers(0, 10**6))
def test_linked_sets_show_an_equal_cell(size, less, more, seed):
    h = np.unique(mix(np.arange(seed, seed + size + more, dtype=np.uint64)))
    rng = np.random.default_rng(seed)
    a = np.sort(rng.permutation(h)[: max(1, len(h) - less)])
    b = np.sort(rng.permutation(h)[: max(1, len(h) - more)])
    if jaccard.linked(a, b):
        keys = lambda s: {int(k) for n in jaccard.bands_of(len(s)) for k in jaccard.cells(s, n)}
        assert keys(a) & keys(b)


@given(st.sets(st.integers(0, 2**40), max_size=80), st.sets(st.integers(0, 2**40), max_size=80))
def test_hamming_distance_is_a_lower_bound(a, b):
    bits = lambda s: np.frombuffer(jaccard.bit_sketch(mix(np.array(sorted(s), np.uint64))), np.uint64)
    assert int(np.bitwise_count(bits(a) ^ bits(b)).sum()) <= len(a ^ b)


@given(st.sets(st.integers(0, 2**40), min_size=1, max_size=300), st.sets(st.integers(0, 2**40), min_size=1, max_size=300))
def test_folded_sketches_are_a_lower_bound(a, b):
    wide = lambda s: jaccard.wide_sketch(mix(np.array(sorted(s), np.uint64)))
    assert jaccard.apart(wide(a), wide(b)) == jaccard.apart(wide(b), wide(a)) <= len(a ^ b)


def test_components_of_paths(spark):
    links = [(i, i + 1) for i in range(0, 40) if i % 13] + [(60, 61), (61, 60), (70, 70)]
    got = dict(jaccard.components(spark.createDataFrame(links, "a long, b long")).collect())
    assert got[12] == 1 and got[26] == 14 and got[39] == 27 and got[61] == 60 and 70 not in got


def test_empty_table(docs_of):
    assert jaccard.near_duplicates(docs_of([])).collect() == []
