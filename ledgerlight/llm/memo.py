"""Ids of text units that a worker remembers, and a byte-level tokenizer that encodes many new
units in one call.

Units are stretches of text across whose edges a tokenizer never merges, so a text's ids are its
units' ids one after the other, whatever is remembered."""
from __future__ import annotations

import os
from collections.abc import Callable, Iterable
from itertools import chain

import numpy as np

JOINED = 2048  # units encoded in one call


class UnitMemo:
    """``encode`` gives the ids of new units as little-endian 32-bit integers, or None for a unit
    that its tokens don't spell."""

    def __init__(self, encode: Callable[[list[str]], Iterable[bytes | None]], most: int):
        self._encode, self._most = encode, most
        self._ids: dict[str, bytes] = {}
        self._bad: set[str] = set()

    def ids(self, texts: list[list[str]]) -> list[bytes | None]:
        """The ids of each text, given as its units; None if a unit has none."""
        if len(self._ids) > self._most:
            self._ids, self._bad = {}, set()
        flat = list(chain.from_iterable(texts))
        found = list(map(self._ids.get, flat))
        missing = [k for k, x in enumerate(found) if x is None]
        if missing:
            new = list({flat[k] for k in missing})
            for u, ids in zip(new, self._encode(new)):
                if ids is None:
                    self._bad.add(u)
                self._ids[u] = ids or b""
            for k in missing:
                found[k] = self._ids[flat[k]]
        out, at = [], 0
        for units in texts:
            whole = b"".join(found[at: at + len(units)])
            at += len(units)
            out.append(None if self._bad and not self._bad.isdisjoint(units) else whole)
        return out


def byte_of_char() -> dict[str, int]:
    """Byte-level vocabularies write printable Latin-1 bytes as themselves and the others as the
    characters from U+0100 on, in order."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(0x100 + k): b for k, b in enumerate(others)}


class ByteLevel:
    """A byte-level tokenizer file: the bytes of its ids, and ids of units."""

    def __init__(self, path: str, special_as_text: bool):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        self.tok = Tokenizer.from_file(path)
        self.tok.encode_special_tokens = special_as_text
        at = byte_of_char()
        names = [self.tok.id_to_token(k) or "" for k in range(self.tok.get_vocab_size())]
        self.spelled = [bytes(at[c] for c in s) if all(c in at for c in s) else s.encode() for s in names]
        self.length = np.array([len(x) for x in self.spelled], np.int64)

    def _alone(self, units: list[str]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for e in self.tok.encode_batch_fast(units, add_special_tokens=False)]

    def _joined(self, units: list[str]) -> list[bytes]:
        """Units that begin with the only white space they have: the tokenizer cuts before each."""
        ids = np.array(self.tok.encode_batch_fast(["".join(units)], add_special_tokens=False)[0].ids, "<u4")
        ends = np.cumsum(self.length[ids])
        want = np.cumsum([len(u.encode()) for u in units])
        cut = np.searchsorted(ends, want)
        if cut[-1] >= len(ends) or (ends[cut] != want).any():
            return self._alone(units)
        raw, edges = ids.tobytes(), (4 * (cut + 1)).tolist()
        return [raw[i:j] for i, j in zip([0, *edges], edges)]

    def encode(self, units: list[str]):
        """The ids of every unit, in order."""
        plain = [len(u) > 1 and u[0] == " " and "<" not in u and not u[1].isspace() for u in units]
        out: list[bytes] = [b""] * len(units)
        for joined, run in ((True, self._joined), (False, self._alone)):
            where = [k for k, p in enumerate(plain) if p is joined]
            for i in range(0, len(where), JOINED):
                part = where[i: i + JOINED]
                for k, ids in zip(part, run([units[k] for k in part])):
                    out[k] = ids
        return out
