import hashlib
from collections import Counter

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import debruijn, sais, suffix_dedup, windows


@settings(max_examples=300, deadline=None)
@given(st.lists(st.integers(1, 4), max_size=60))
def test_suffix_array(symbols):
    text = [*symbols, 0]
    assert sais.suffix_array(np.array(text)) == sorted(range(len(text)), key=lambda i: text[i:])


@settings(max_examples=200, deadline=None)
@given(st.lists(st.text("ab", max_size=25), min_size=1, max_size=5), st.integers(1, 8))
def test_repeated_starts(strings, w):
    strings = [s.encode() for s in strings]
    seen = Counter(s[i: i + w] for s in strings for i in range(len(s) - w + 1))
    assert [x.tolist() for x in sais.repeated_starts(strings, w)] == [
        [i for i in range(len(s) - w + 1) if seen[s[i: i + w]] > 1] for s in strings]


@settings(max_examples=200, deadline=None)
@given(st.lists(st.lists(st.integers(0, 2), max_size=25), min_size=1, max_size=4), st.integers(3, 9), st.data())
def test_runs_hold_every_window_once(sequences, w, data):
    k = data.draw(st.integers(1, w))
    lengths = np.array([len(s) for s in sequences])
    codes = windows.mix(np.array(sum(sequences, []), np.uint64) + np.uint64(5))
    r = windows.runs(codes, lengths, w, k, again=True)
    where, anchors = [], {}
    for a, s, n, anchor, again in zip(r.owner, r.start, r.n, r.anchor, r.again):
        own = [tuple(sequences[a][i: i + w]) for i in range(s, s + n)]
        where += [(a, i) for i in range(s, s + n)]
        assert again or len(set(own)) == n
        assert all(anchors.setdefault(x, anchor) == anchor for x in own)
    assert sorted(where) == [(a, i) for a, s in enumerate(sequences) for i in range(len(s) - w + 1)]


def brute_words(rows, w):
    docs = [(i, (t or "").encode().split()) for i, t in rows]
    first = {}
    for i, x in docs:
        if i is not None:
            for k in range(len(x) - w + 1):
                key = tuple(x[k: k + w])
                first[key] = min(first.get(key, i), i)
    out = []
    for i, x in docs:
        gone = np.zeros(len(x), bool)
        for k in range(len(x) - w + 1):
            if i is not None and first[tuple(x[k: k + w])] < i:
                gone[k: k + w] = True
        kept = b" ".join(y for y, g in zip(x, gone) if not g)
        out.append((i, len(x), int(gone.sum()), hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def brute_bytes(rows, w):
    raw = [(i, (t or "").encode()) for i, t in rows]
    seen = Counter(x[k: k + w] for _, x in raw for k in range(len(x) - w + 1))
    out = []
    for i, x in raw:
        gone = np.zeros(len(x) + 1, bool)
        for k in range(len(x) - w + 1):
            if seen[x[k: k + w]] > 1:
                gone[k: k + w] = True
        spans = int((gone[1:] & ~gone[:-1]).sum() + gone[0])
        out.append((i, len(x), int(gone.sum()), spans,
                    hashlib.sha256(bytes(y for y, g in zip(x, gone) if not g)).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    """Copies, near copies, shared passages in other surroundings, periodic and odd texts."""
    rng = np.random.default_rng(seed)
    word = lambda: "".join(rng.choice(list("abcdeé"), int(rng.integers(1, 4))))
    text = lambda n: " ".join(word() for _ in range(n))
    base, passage = text(120), text(30)
    rows = [(0, base), (1, base), (2, base)]
    for i in range(3, 40):
        kind = i % 4
        if kind == 0:
            w = base.split()
            for _ in range(int(rng.integers(1, 4))):
                w[int(rng.integers(len(w)))] = word()
            rows.append((i, " ".join(w)))
        elif kind == 1:
            rows.append((i, text(20) + " " + passage + "\n" + text(20)))
        elif kind == 2:
            rows.append((i, text(40) + " " + passage + " " + passage))
        else:
            rows.append((i, text(int(rng.integers(0, 60)))))
    return rows + [(50, "a " * 90), (51, "a " * 40), (52, None), (53, ""), (54, "ab" * 100), (None, base), (7, base), (1, base),
                   (60, " x".join(["lead"] * 3) + base)]


@pytest.mark.parametrize("seed", [1, 2])
def test_words_against_brute_force(spark, docs_of, seed):
    rows = corpus(seed)
    got = debruijn.drop_repeats(docs_of(rows), window=8, gram=3)
    assert sorted(((r.doc_id, r.n_words, r.n_removed, r.kept_sha256) for r in got.collect()), key=str) == brute_words(rows, 8)


@pytest.mark.parametrize("most", [1, 1024])
def test_bytes_against_brute_force(spark, docs_of, most):
    rows = corpus(3)
    got = suffix_dedup.drop_repeats(docs_of(rows), width=24, gram=7, most_contents=most)
    assert sorted(((r.doc_id, r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got.collect()), key=str) == brute_bytes(rows, 24)


def test_empty_tables(docs_of):
    assert debruijn.drop_repeats(docs_of([])).count() == 0
    assert suffix_dedup.drop_repeats(docs_of([])).count() == 0
