"""Suffix arrays by induced sorting, and permuted common prefixes."""
from __future__ import annotations

import numpy as np


def _classify(s: np.ndarray) -> np.ndarray:
    """True where a suffix is smaller than the next one (S-type). The last symbol is the smallest."""
    step = np.sign(np.diff(s.astype(np.int64), append=-1))  # of the following symbol; the end is L ...
    step[-1] = 0
    at = np.where(step != 0, np.arange(len(s)), len(s) - 1)
    decides = np.minimum.accumulate(at[::-1])[::-1]  # equal symbols go by the next that differs
    small = step[decides] > 0
    small[-1] = True  # ... but for the sentinel
    return small


def _induce(s: list[int], small: list[bool], sa: list[int], sizes: np.ndarray) -> list[int]:
    """Sort all suffixes from the sorted leftmost-smaller ones, in two sweeps over the buckets."""
    ends = np.cumsum(sizes)
    heads = (ends - sizes).tolist()
    for j in sa:  # grows behind the sweep: places are filled before it comes by
        if j > 0 and not small[j - 1]:
            c = s[j - 1]
            sa[heads[c]] = j - 1
            heads[c] += 1
    tails = ends.tolist()
    for k in range(len(sa) - 1, -1, -1):
        j = sa[k]
        if j > 0 and small[j - 1]:
            c = s[j - 1]
            tails[c] -= 1
            sa[tails[c]] = j - 1
    return sa


def _placed(order: list[int], s: list[int], sizes: np.ndarray) -> list[int]:
    """Empty buckets but for the given suffixes, at their ends and in their order."""
    sa, tails = [-1] * len(s), np.cumsum(sizes).tolist()
    for j in reversed(order):
        c = s[j]
        tails[c] -= 1
        sa[tails[c]] = j
    return sa


class _Buckets:
    """Induced sorting where few symbols repeat: a bucket's suffixes induce all at once, as what
    they induce lies in later buckets, or later in their own."""

    def __init__(self, text: np.ndarray, small: np.ndarray, sizes: np.ndarray, unique: int):
        self.s, self.small, self.sizes, self.unique = text, small, sizes, unique
        self.ends = np.cumsum(sizes)
        self.starts = self.ends - sizes
        self.n_small = np.bincount(text[small], minlength=len(sizes))
        self.used = np.flatnonzero(sizes[unique:]) + unique

    def sorted_from(self, order: np.ndarray) -> np.ndarray:
        """All suffixes, from the leftmost-smaller ones in their order. The suffixes that start
        with one of the first ``unique`` symbols are in place from the start: each has its own."""
        s, sa = self.s, np.full(len(self.s), -1, np.int64)
        by = np.argsort(s[order], kind="stable")
        counts = np.bincount(s[order], minlength=len(self.sizes))
        first = np.cumsum(counts) - counts
        c = s[order[by]]
        sa[self.ends[c] - counts[c] + np.arange(len(by)) - first[c]] = order[by]
        alone = np.flatnonzero(s < self.unique)
        sa[s[alone]] = alone
        fixed = sa[: self.unique].copy()
        heads, tails = self.starts.copy(), self.ends.copy()
        self._induce(sa, fixed, False, heads)
        for c in self.used:
            at = self.starts[c]
            while at < heads[c]:
                batch, at = sa[at: heads[c]], heads[c]
                self._induce(sa, batch, False, heads)
            self._induce(sa, sa[self.ends[c] - counts[c]: self.ends[c]], False, heads)
        for c in self.used[::-1]:
            at = self.ends[c]
            while at > tails[c]:
                batch, at = sa[tails[c]: at][::-1], tails[c]
                self._induce(sa, batch, True, tails)
            self._induce(sa, sa[self.starts[c]: self.ends[c] - self.n_small[c]][::-1], True, tails)
        return sa

    def _induce(self, sa: np.ndarray, batch: np.ndarray, small: bool, edge: np.ndarray) -> None:
        j = batch[batch > 0] - 1
        j = j[self.small[j] == small]
        c = self.s[j]
        keep = c >= self.unique
        j, c = j[keep], c[keep]
        if not len(j):
            return
        by = np.argsort(c, kind="stable")
        j, c = j[by], c[by]
        at = np.flatnonzero(np.append(True, c[1:] != c[:-1]))
        n = np.diff(np.append(at, len(c)))
        rank = np.arange(len(c)) - np.repeat(at, n)
        if small:
            sa[edge[c] - 1 - rank] = j
            edge[c[at]] -= n
        else:
            sa[edge[c] + rank] = j
            edge[c[at]] += n


def suffix_array(text: np.ndarray, unique: int = 1) -> list[int]:
    """``text``: integers from 0; the last is 0. The first ``unique`` symbols stand nowhere
    twice, 0 included, and are not repeated side by side in ascending order."""
    n = len(text)
    if n == 1:
        return [0]
    sizes = np.bincount(text)
    small = _classify(text)
    few = len(sizes) - unique <= 256  # symbols that may repeat; names of substrings are more
    if few:
        buckets = _Buckets(text, small, sizes, unique)
        sort = lambda order: buckets.sorted_from(np.asarray(order, np.int64))
    else:
        s_, small_ = text.tolist(), small.tolist()
        sort = lambda order: np.array(_induce(s_, small_, _placed(list(order), s_, sizes), sizes))
    lms = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    # names of the substrings between leftmost-smaller positions, in sorted order
    is_lms = np.zeros(n, bool)
    is_lms[lms] = True
    sa = sort(lms)
    order = sa[is_lms[sa]]
    end = np.zeros(n, np.int64)
    end[lms] = np.append(lms[1:], n - 1)
    names = np.zeros(n, np.int64)
    names[order] = _named(text, order, end)
    if names[order[-1]] + 1 < len(lms):
        order = lms[np.array(suffix_array(names[lms]))]
    return sort(order).tolist()


def _named(text: np.ndarray, order: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Numbers of the substrings text[j : end[j]+1] in their order; equal ones get one number."""
    size = end[order] - order + 1
    new = np.append(True, size[1:] != size[:-1])
    left, live = 0, np.flatnonzero(~new)  # those of equal length are compared symbol by symbol
    while len(live):
        live = live[left < size[live]]
        differs = text[order[live] + left] != text[order[live - 1] + left]
        new[live[differs]] = True
        live, left = live[~differs], left + 1
    return np.cumsum(new) - 1


def common_prefixes(s: list[int], sa: list[int]) -> tuple[list[int], list[int]]:
    """(prior, plcp) by text position: the suffix that sorts before it, and how many symbols
    the two share. Going through the text, the next value is at most one less."""
    n = len(s)
    prior = [-1] * n
    for a, b in zip(sa, sa[1:]):
        prior[b] = a
    plcp, k = [0] * n, 0
    for i, j in enumerate(prior):
        if j < 0:
            k = 0
            continue
        while s[i + k] == s[j + k]:
            k += 1
        plcp[i] = k
        if k:
            k -= 1
    return prior, plcp


def repeated_starts(strings: list[bytes], width: int) -> list[np.ndarray]:
    """For each string: where a stretch of ``width`` bytes starts that also starts at another
    place in any of the strings."""
    m, size = len(strings), sum(map(len, strings)) + len(strings)
    text = np.empty(size, np.int64)
    at = np.zeros(m, np.int64)
    k = 0
    for i, x in enumerate(strings):
        at[i] = k
        text[k: k + len(x)] = np.frombuffer(x, np.uint8).astype(np.int64) + m
        k += len(x) + 1
        text[k - 1] = m - 1 - i  # each string ends in a symbol of its own
    prior, plcp = common_prefixes(text.tolist(), suffix_array(text, m))
    long_ = np.flatnonzero(np.array(plcp) >= width)
    seen = np.zeros(size, bool)
    seen[long_] = True
    seen[np.array(prior)[long_]] = True
    return [np.flatnonzero(seen[a: a + len(x)]) for a, x in zip(at.tolist(), strings)]
