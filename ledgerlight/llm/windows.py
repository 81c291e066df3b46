"""Long windows of a sequence, gathered into runs that share a minimizer.

For windows of W symbols take the smallest hash among the K-grams of each window. Runs of
consecutive windows with the same smallest hash (their anchor) hold all windows of a
sequence, and equal windows anywhere have equal anchors. So windows can be compared anchor
by anchor, and a run whose whole content is equal to another's stands for all its windows at
once: in long copies nothing smaller than a run needs to be looked at.
"""
from __future__ import annotations

from dataclasses import dataclass

import numpy as np

_B = np.uint64(0x9E3779B97F4A7C15)  # odd, so that it has an inverse modulo 2^64
_B_INVERSE = np.uint64(pow(int(_B), -1, 1 << 64))
_powers = {"n": 0}


def _tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """B^0 .. B^(n-1) and their inverses."""
    if _powers["n"] < n:
        size = max(n, 1 << 16)
        p = np.full(size, _B)
        q = np.full(size, _B_INVERSE)
        p[0] = q[0] = 1
        _powers.update(n=size, p=np.multiply.accumulate(p), q=np.multiply.accumulate(q))
    return _powers["p"][:n], _powers["q"][:n]


def mix(h: np.ndarray) -> np.ndarray:
    h = (h ^ (h >> np.uint64(31))) * np.uint64(0x7FB5D329728EA185)
    h = (h ^ (h >> np.uint64(27))) * np.uint64(0x81DADEF4BC2DD44D)
    return h ^ (h >> np.uint64(33))


class Rolling:
    """Hashes of any stretch of a sequence of 64-bit symbol codes."""

    def __init__(self, codes: np.ndarray):
        p, self._q = _tables(len(codes) + 1)
        self._sums = np.zeros(len(codes) + 1, np.uint64)
        np.cumsum(codes * p[:-1], out=self._sums[1:])

    def grams(self, k: int) -> np.ndarray:
        """Hash of the k symbols from each position on."""
        s, n = self._sums, len(self._sums) - k
        return mix((s[k:] - s[:-k]) * self._q[:n]) if n > 0 else np.zeros(0, np.uint64)

    def stretch(self, start: np.ndarray, end: np.ndarray) -> np.ndarray:
        h = (self._sums[end] - self._sums[start]) * self._q[start]
        return mix(h + (end - start).astype(np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F))


def sliding_min(h: np.ndarray, width: int) -> np.ndarray:
    out, done = h, 1
    while done < width:
        step = min(done, width - done)
        out = np.minimum(out[:-step], out[step:])
        done += step
    return out


@dataclass
class Runs:
    owner: np.ndarray   # number of the sequence in the batch
    start: np.ndarray   # of its first window, in the sequence
    n: np.ndarray       # windows in the run
    anchor: np.ndarray
    content: np.ndarray  # hash of all symbols from the first window to the last
    again: np.ndarray   # whether the anchor stands in the run at more than one place


def runs(codes: np.ndarray, lengths: np.ndarray, window: int, k: int, again: bool = False) -> Runs:
    """Runs of all sequences that lie one after the other in ``codes``."""
    empty = Runs(*(np.zeros(0, t) for t in (np.int64, np.int64, np.int64, np.uint64, np.uint64, bool)))
    ends = np.cumsum(lengths)
    has = lengths >= window
    if not has.any():
        return empty
    rolling, width = Rolling(codes), window - k + 1
    h = rolling.grams(k)
    low = sliding_min(h, width)
    # a window is one of a sequence's if it starts at least ``window`` before its end
    first, after = (ends - lengths)[has], (ends - window + 1)[has]
    starts_here = np.zeros(len(low) + 1, bool)
    starts_here[first] = starts_here[np.minimum(after, len(low))] = True
    starts_here[1:-1] |= low[1:] != low[:-1]
    at = np.flatnonzero(starts_here[:-1])
    owner = np.searchsorted(ends, at, "right")
    inside = at < (ends - window + 1)[owner]
    stop = np.append(at[1:], len(low))[inside]
    at, owner = at[inside], owner[inside]
    twice = np.zeros(len(at), bool)
    if again:
        views = np.lib.stride_tricks.sliding_window_view(h, width)
        for i in range(0, len(at), 4096):
            a, e = at[i: i + 4096], stop[i: i + 4096] - 1
            left = a + views[a].argmin(axis=1)
            right = e + width - 1 - views[e][:, ::-1].argmin(axis=1)
            twice[i: i + 4096] = left != right
    return Runs(owner, at - (ends - lengths)[owner], stop - at, low[at],
                rolling.stretch(at, stop - 1 + window), twice)


def merged(start: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Unions of intervals that overlap or touch, in order."""
    if not len(start):
        return start, end
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    new = np.flatnonzero(np.append(True, start[1:] > end[:-1]))
    return start[new], end[np.append(new[1:], len(start)) - 1]
