import zlib

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlight.llm import bitplanes
from ledgerlight.llm.crc import crc_of_parts
from ledgerlight.llm.memo import ByteLevel
from ledgerlight.llm.units import UnitCache

PATH = public_tokenizers.path("byte_bpe_50k.json")
TEXTS = ["", "Hello  world\n\n x", None, " a", "naïve café <|endoftext|> z ", "tab\t end ", "word " * 3000]


@given(st.lists(st.binary(max_size=40), max_size=5))
def test_crc_of_parts(parts):
    assert crc_of_parts([(zlib.crc32(p), len(p)) for p in parts]) == zlib.crc32(b"".join(parts))


@given(st.lists(st.integers(0, 2**32 - 1), min_size=1, max_size=300), st.sampled_from(["bit", "byte"]))
def test_block_round_trip(ids, mode):
    block = bitplanes.pack_block(np.array(ids, "<u4"), mode)
    assert bitplanes.unpack_block(block).tolist() == ids


@settings(max_examples=200, deadline=None)
@given(st.text(st.sampled_from("ab'st 1.\n\t\r  \x1c\x85é<|>")))
def test_units_change_no_ids(text):
    want = Tokenizer.from_file(PATH).encode(text, add_special_tokens=False).ids
    assert bitplanes.encode_texts([text], PATH)[0].tolist() == want


@pytest.mark.parametrize("mode", ["bit", "byte"])
def test_write_and_read(spark, docs_of, mode):
    rows = [(i, t) for i, t in enumerate(TEXTS)] + [(2, "again"), (None, "no id")]
    path = bitplanes.shared_path(spark, "test-ids")
    bitplanes.write_ids(docs_of(rows), path, PATH, mode, block=64)
    tok = Tokenizer.from_file(PATH)
    order = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] or ""))
    want, at = [], 0
    for i, t in order:
        ids = np.array(tok.encode(t or "", add_special_tokens=False).ids + [0], "<u4")
        want.append((i, at, len(ids), zlib.crc32(ids.tobytes())))
        at += len(ids)
    got = [tuple(r) for r in bitplanes.digests(spark, path, block=64).collect()]
    assert sorted(got, key=lambda r: r[1]) == want
    pieces = bitplanes.read_ids(spark, path, block=64).orderBy("part", "seq", "before").collect()
    assert sum(len(p.ids) for p in pieces) == at


def test_empty_table(spark, docs_of):
    assert bitplanes.encode_and_digest(docs_of([]), PATH).collect() == []


class Counted:
    """A tokenizer that counts the texts it is given."""

    def __init__(self, tok):
        self.tok, self.texts = tok, 0

    def encode_batch_fast(self, texts, **how):
        self.texts += len(texts)
        return self.tok.encode_batch_fast(texts, **how)


def test_new_words_are_encoded_together():
    words = [f" w{'abcdefghij'[i % 10]}{'klmnopqrst'[i // 10 % 10]}{'uvwxyzaeio'[i // 100]}" for i in range(1000)]
    tokenizer = ByteLevel(PATH, special_as_text=False)
    want = [tokenizer.tok.encode(t, add_special_tokens=False).ids for t in ("x" + "".join(words), "".join(words[::-1]))]
    tokenizer.tok = Counted(tokenizer.tok)
    cache = UnitCache(tokenizer)
    for _ in range(2):
        ids, at = cache.ids(pa.array(["x" + "".join(words), "", "".join(words[::-1])]))
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == [want[0], [], want[1]]
    assert tokenizer.tok.texts == 3  # the words in two calls, the "x"


PARTS = [*"ab'strev 1.\n\t<|", "  ", "\x1c", "\x85", "\xa0", "\u2003", "\u3000", "\u200b", "é", "×", "ж", "日", "\u0301", "²",
         "<|endoftext|>", " the"]
COLUMN = st.lists(st.lists(st.sampled_from(PARTS)).map("".join), max_size=6)
TOKENIZER = ByteLevel(PATH, special_as_text=False)


@settings(max_examples=300, deadline=None)
@given(COLUMN, st.sampled_from([0, 1000]), st.integers(0, 3))
def test_columns_change_no_ids(texts, most, skip):
    want = [TOKENIZER.tok.encode(t, add_special_tokens=False).ids for t in texts]
    cache = UnitCache(TOKENIZER, most)
    for start in (0, min(skip, len(texts))):  # a slice has its offsets in the data of the whole
        ids, at = cache.ids(pa.array(texts, pa.string()).slice(start))
        assert [ids[i:j].tolist() for i, j in zip(at, at[1:])] == want[start:]
