"""Secret scan: one Aho-Corasick pass finds keywords, anchored patterns run only at the
hits, and tokens that embed a checksum are validated by it.

Defined cases: null text is empty and has no spans; every row of the input gives one row
(repeated rows and null ids included); other columns are not read; texts of any length are
scanned whole.
"""
from __future__ import annotations

import hashlib
import re
import zlib
from functools import cache
from itertools import product

import ahocorasick
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ledgerlight.llm.common import pieces, ship, texts_of

# The kinds of the result contract, in the order that breaks ties, then ours.
BASE_KINDS = ("assign", "access", "hex")
CHECKED_KINDS = ("github", "npm")
KINDS = BASE_KINDS + CHECKED_KINDS
MIN_VALUE, MIN_ACCESS, MIN_HEX = 6, 20, 24
ASSIGN_WORDS = ("password", "passwd", "secret", "token", "apikey", "api_key")
ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""",
                    re.ASCII | re.IGNORECASE)
ACCESS = re.compile(r"AKIA[A-Z0-9]+")
HEX = re.compile(r"[0-9a-f]+")
HEX_DIGITS = "0123456789abcdef"
CHECKED_PREFIXES = {"ghp_": "github", "gho_": "github", "ghu_": "github", "ghs_": "github", "ghr_": "github",
                    "npm_": "npm"}
CHECKED = re.compile(r"(?:gh[pousr]|npm)_([A-Za-z0-9]{30})([A-Za-z0-9]{6})(?![A-Za-z0-9])")
BASE62 = "0123456789ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz"

_HEX_GRAM = 4


def base62(n: int, width: int) -> str:
    out = ""
    while n:
        n, r = divmod(n, 62)
        out = BASE62[r] + out
    return out.rjust(width, "0")


def checksum_ok(body: str, check: str) -> bool:
    """The last six characters are the CRC-32 of the thirty before them, in base 62."""
    return base62(zlib.crc32(body.encode()), 6) == check


@cache
def _automaton() -> ahocorasick.Automaton:
    a = ahocorasick.Automaton()
    for gram in product(HEX_DIGITS, repeat=_HEX_GRAM):
        a.add_word("".join(gram), ("hex", _HEX_GRAM))
    for w in ASSIGN_WORDS:
        a.add_word(w, ("assign", len(w)))
    a.add_word("akia", ("access", 4))
    for p, kind in CHECKED_PREFIXES.items():
        a.add_word(p, (kind, len(p)))
    a.make_automaton()
    return a


def ascii_lower(text: str) -> str:
    """A-Z to a-z only, so that positions stay those of the text."""
    return text.lower() if text.isascii() else text.encode("utf-8", "surrogatepass").lower().decode("utf-8", "surrogatepass")


def scan(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of every span, by start, then kind as listed in KINDS."""
    done = dict.fromkeys(KINDS, 0)
    spans = []
    for last, (kind, width) in _automaton().iter(ascii_lower(text)):
        at = last - width + 1
        if at < done[kind]:
            continue
        if kind == "hex":
            m = HEX.match(text, at)  # the automaton also sees A-F
            if m:
                done[kind] = m.end()
                if m.end() - at >= MIN_HEX:
                    spans.append((at, m.end(), kind))
        elif kind == "assign":
            m = ASSIGN.match(text, at)
            if m:
                done[kind] = m.end()
                if len(m[2]) >= MIN_VALUE:
                    spans.append((at, m.end(), kind))
        elif kind == "access":
            m = ACCESS.match(text, at)
            if m:
                done[kind] = m.end()
                if m.end() - at >= MIN_ACCESS:
                    spans.append((at, m.end(), kind))
        else:
            m = CHECKED.match(text, at)
            if m and not (at and text[at - 1].isalnum()) and checksum_ok(m[1], m[2]):
                done[kind] = m.end()
                spans.append((at, m.end(), kind))
    spans.sort(key=lambda s: (s[0], KINDS.index(s[2])))
    return spans


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{s}:{e}" for s, e, k in spans)


def redact(text: str, spans: list[tuple[int, int, str]], mask: str = "[secret]") -> str:
    out, at = [], 0
    for s, e, _ in sorted(spans):
        if s >= at:
            out += [text[at:s], mask]
        at = max(at, e)
    return "".join(out) + text[at:]


SCHEMA = ("doc_id long, n_assign long, n_access long, n_hex long, n_checked long, base_sha256 string, "
          "spans string")


def scan_secrets(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per input row: counts by kind, digest of the base spans, all spans."""

    def run(batches):
        for b in pieces(batches):
            found = [scan(t) for t in b.column("text").to_pylist()]
            base = [[s for s in f if s[2] in BASE_KINDS] for f in found]
            count = [[sum(s[2] == k for s in f) for f in base] for k in BASE_KINDS]
            yield pa.RecordBatch.from_arrays([
                b.column("doc_id"), *(pa.array(c, pa.int64()) for c in count),
                pa.array([len(f) - len(x) for f, x in zip(found, base)], pa.int64()),
                pa.array([hashlib.sha256(joined(x).encode()).hexdigest() for x in base]),
                pa.array([joined(f) for f in found], pa.string())],
                ["doc_id", "n_assign", "n_access", "n_hex", "n_checked", "base_sha256", "spans"])

    return texts_of(docs, id_col, text_col).mapInArrow(run, SCHEMA)


def redact_column(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """The same rows and columns with every span of a text replaced by a mask; null stays null."""

    @F.pandas_udf("string")
    def clean(texts):
        return texts.map(lambda t: t if t is None else redact(t, scan(t)))

    ship(docs.sparkSession)
    return docs.withColumn(text_col, clean(F.col(f"`{text_col}`")))
