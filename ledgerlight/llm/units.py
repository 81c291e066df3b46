"""Token ids of whole columns of texts, by way of a bounded memo of encoded units.

Units are stretches of UTF-8 bytes across whose edges a byte-level tokenizer never merges, so a
text's ids are its units' ids one after the other. Edges are found for all bytes of a column at
once. Units repeat, so a worker looks each distinct one of a column up once, keeps the ids of
those it has met and clears the memo when it is full; results don't depend on what it holds.

Edges lie (the tokenizer's pattern: contractions, then runs of letters, digits or other signs,
each with a space before it or not, then white space):
 1. between a character and the white space after it;
 2. between ASCII or Latin-1 letters, ASCII digits and ASCII signs but the apostrophe;
 3. before the last character of a run of white space, if a word follows it;
 4. between white space that is no plain space and the word after it.
A text with what may be a special token has those of 1 only."""
from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

from ledgerlight.llm.memo import ByteLevel

MOST_UNITS = 400_000
MOST_BYTES = 64_000_000  # of remembered units and ids
JOINED, CALL = 512, 16  # units joined to a text, texts encoded in one call
STEP = 1 << 20  # units looked up together

_OTHER, _LETTER, _DIGIT, _SIGN, _BLANK, _LINE, _WIDE = range(7)  # from _BLANK on: white space, _WIDE of several bytes


def _kind(byte: int) -> int:
    c = chr(byte)
    if byte >= 0x80 or byte < 0x09 or 0x0D < byte < 0x20 or byte == 0x7F or c == "'":
        return _OTHER
    return _BLANK if c == " " else _LINE if byte < 0x20 else _LETTER if c.isalpha() else _DIGIT if c.isdigit() else _SIGN


# Unicode's White_Space of three bytes in UTF-8, and flags of pairs of kinds.
_WIDE_3 = np.array([int.from_bytes(chr(c).encode(), "big") for c in (
    0x1680, *range(0x2000, 0x200B), 0x2028, 0x2029, 0x202F, 0x205F, 0x3000)], np.uint32)
_KINDS = bytes(map(_kind, range(256)))
_SPACED, _SPLIT, _INNER, _LAST = 1, 2, 4, 8


def _flags(a: int, b: int) -> int:
    """What a pair of neighbours of kinds a and b may be: an edge by 1, by 2 or 4, or half of one by 3."""
    return (_SPACED * (a < _BLANK <= b) | _SPLIT * (a != b and _LETTER <= a <= _SIGN and _LETTER <= b <= _SIGN)
            | _SPLIT * (a == _LINE and b < _BLANK) | _INNER * (a >= _BLANK and b in (_BLANK, _LINE))
            | _LAST * (a in (_BLANK, _LINE) and b < _BLANK))


_PAIRS = bytes(_flags(k >> 3, k & 7) if k < 64 else 0 for k in range(256))


def _kinds(data: bytes) -> np.ndarray:
    raw, out = np.frombuffer(data, np.uint8), np.frombuffer(bytearray(data.translate(_KINDS)), np.uint8)
    for lead in (0xC2, 0xC3):
        at = np.flatnonzero(raw[:-1] == lead)
        second = raw[at + 1]
        # U+0085 and U+00A0 are white space; U+00C0 to U+00FF are letters but the signs of times and division
        at = at[(second == 0x85) | (second == 0xA0) if lead == 0xC2 else (second != 0x97) & (second != 0xB7)]
        out[at] = out[at + 1] = _WIDE if lead == 0xC2 else _LETTER
    at = np.flatnonzero((raw[:-2] >= 0xE1) & (raw[:-2] <= 0xE3))
    code = raw[at].astype(np.uint32) << 16 | raw[at + 1].astype(np.uint32) << 8 | raw[at + 2]
    at = at[np.isin(code, _WIDE_3)]
    for k in range(3):
        out[at + k] = _WIDE
    return out


def unit_edges(data: bytes, edges: np.ndarray) -> np.ndarray:
    """Where units begin, and the end of all; ``edges``: the same of texts, which are never joined."""
    n = len(data)
    cut = np.zeros(n + 1, bool)
    if n > 1:
        kinds = _kinds(data)
        flags = np.frombuffer((kinds[:-1] << 3 | kinds[1:]).tobytes().translate(_PAIRS), np.uint8)
        fine = flags & _SPLIT != 0
        last = flags[1:] & _LAST != 0
        ends = edges[(edges >= 2) & (edges < n)]
        last[ends - 2] = False  # what follows is another text's
        fine[:-1] |= (flags[:-1] & _INNER != 0) & last
        if b"<|" in data:
            raw = np.frombuffer(data, np.uint8)
            special = np.zeros(len(edges) - 1, bool)
            special[np.searchsorted(edges, np.flatnonzero((raw[:-1] == 0x3C) & (raw[1:] == 0x7C)), "right") - 1] = True
            fine &= ~np.repeat(special, np.diff(edges))[1:]
        cut[1:n] = fine | (flags & _SPACED != 0)
    cut[edges] = True
    return np.flatnonzero(cut)


def _binary(data: pa.Buffer, edges: np.ndarray) -> pa.Array:
    return pa.Array.from_buffers(pa.binary(), len(edges) - 1, [None, pa.py_buffer(edges.astype(np.int32)), data])


def _edges(arr: pa.Array) -> np.ndarray:
    """Offsets of an array of strings or bytes into its data."""
    return np.frombuffer(arr.buffers()[1], np.int32)[arr.offset: arr.offset + len(arr) + 1].astype(np.int64)


def _objects(arr: pa.Array) -> list[bytes]:
    return arr.to_numpy(zero_copy_only=False).tolist()


class UnitCache:
    def __init__(self, tokenizer: ByteLevel, most: int = MOST_UNITS, most_bytes: int = MOST_BYTES):
        self._tokenizer, self._most, self._most_bytes = tokenizer, most, most_bytes
        self._ids: dict[bytes, bytes] = {}  # little-endian 32-bit integers
        self._bytes = 0

    def _alone(self, units: list[bytes]) -> list[bytes]:
        return [np.array(e.ids, "<u4").tobytes() for i in range(0, len(units), 4096) for e in
                self._tokenizer.tok.encode_batch_fast([u.decode() for u in units[i: i + 4096]], add_special_tokens=False)]

    def _joined(self, units: list[bytes]) -> list[bytes]:
        """Units that begin with the only white space they have: the tokenizer cuts before each."""
        texts = (b"".join(part).decode() for part in itertools.batched(units, JOINED))
        ids = np.concatenate([np.array(e.ids, "<u4") for call in itertools.batched(texts, CALL) for e in
                              self._tokenizer.tok.encode_batch_fast(list(call), add_special_tokens=False)])
        ends = np.cumsum(self._tokenizer.length[ids])
        want = np.cumsum(np.fromiter(map(len, units), np.int64, len(units)))
        at = np.searchsorted(ends, want)
        if at[-1] >= len(ends) or (ends[at] != want).any():
            return self._alone(units)
        raw, cuts = ids.tobytes(), (4 * (at + 1)).tolist()
        return [raw[i:j] for i, j in zip([0, *cuts], cuts)]

    def _encode(self, units: pa.Array) -> None:
        edges, kinds = _edges(units), _kinds(units.buffers()[2].to_pybytes())
        first = edges[:-1]
        joins = (np.diff(edges) > 1) & (kinds[first] == _BLANK)
        joins[joins] = kinds[first[joins] + 1] < _BLANK
        joins &= ~pc.match_substring(units, "<").to_numpy(zero_copy_only=False)
        for run, where in ((self._joined, joins), (self._alone, ~joins)):
            part = _objects(units.filter(pa.array(where)))
            if part:
                ids = run(part)
                self._ids.update(zip(part, ids))
                self._bytes += sum(map(len, part)) + sum(map(len, ids))

    def _look_up(self, units: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all units, one unit after the other, and how many each has."""
        if len(self._ids) > self._most or self._bytes > self._most_bytes:
            self._ids, self._bytes = {}, 0
        units = units.dictionary_encode()
        distinct, which = _objects(units.dictionary), units.indices.to_numpy()
        found = list(map(self._ids.get, distinct))
        missing = [k for k, x in enumerate(found) if x is None]
        if missing:
            self._encode(units.dictionary.take(pa.array(missing, pa.int64())))
            for k in missing:
                found[k] = self._ids[distinct[k]]
        flat = np.frombuffer(b"".join(found), "<u4")
        n = np.fromiter(map(len, found), np.int64, len(found)) // 4
        start, n = (np.cumsum(n) - n)[which], n[which]
        at = np.repeat(start - np.cumsum(n) + n, n)
        at += np.arange(len(at))
        return flat[at], n

    def ids(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts (no nulls), one text after the other, and where each begins, with the end of all."""
        if not len(texts):
            return np.zeros(0, "<u4"), np.zeros(1, np.int64)
        texts = texts.cast(pa.string())
        ends = _edges(texts)
        if ends[-1] == ends[0]:
            return np.zeros(0, "<u4"), np.zeros(len(texts) + 1, np.int64)
        data = texts.buffers()[2].slice(ends[0], ends[-1] - ends[0])
        ends -= ends[0]
        edges = unit_edges(data.to_pybytes(), ends)
        parts = [self._look_up(_binary(data, edges[i: i + STEP + 1])) for i in range(0, len(edges) - 1, STEP)]
        at = np.concatenate([[0], np.cumsum(np.concatenate([n for _, n in parts]))])
        return np.concatenate([ids for ids, _ in parts]), at[np.searchsorted(edges, ends)]
