import zlib

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import spm

PATH = public_tokenizers.path("piece_bpe_32k.model")
ENC = spm.encoder(PATH)
ALPHABET = st.text(st.sampled_from("the an  ing\n▁é梦\U0001f600x"), max_size=30)


def score_of(ids):
    by_id = {i: s for i, s in ENC.vocab.pieces.values()}
    out, bytes_ = 0.0, b""
    for i in ids:
        if i in by_id:
            out += by_id[i]
        else:
            bytes_ += ENC.vocab.text_of[i]
    return out + len(bytes_.decode()) * ENC.vocab.unknown


def in_chunks(text, size):
    s, w = " " + text, ENC.vocab.width
    parts = [(s[i: i + size], s[max(0, i - 1): i], s[i + size: i + size + w]) for i in range(0, len(s), size)]
    states = spm.boundary_states(np.stack([ENC.transfer(*p) for p in parts]))
    return [i for p, a, b in zip(parts, states, states[1:]) for i in ENC.between(*p, a, b).tolist()]


@settings(max_examples=300, deadline=None)
@given(ALPHABET.filter(bool), st.integers(1, 12))
def test_chunks_find_a_best_path(text, size):
    best = ENC.vocab.forward(" " + text)[0][-1]
    whole = np.frombuffer(ENC.whole([text])[0], "<u4").tolist()
    split = in_chunks(text, size)
    assert score_of(whole) == score_of(split) == best
    assert ENC.vocab.decode(split) == ENC.vocab.decode(whole) == (" " + text).encode()


def test_brute_force_of_short_strings():
    def best(s):
        if not s:
            return 0.0
        return max((p[1] if p else ENC.vocab.unknown) + best(s[k:])
                   for k in range(1, min(len(s), ENC.vocab.width) + 1)
                   if (p := ENC.vocab.pieces.get(s[:k])) or k == 1)
    for s in (" the", " them", "▁a", " hello", " \n é"):
        assert ENC.vocab.forward(s)[0][-1] == best(s)


def test_decodes_like_the_library():
    sp = sentencepiece.SentencePieceProcessor(model_file=PATH)
    for text in ("Hello world", "two  spaces", "é梦 x"):
        ids = np.frombuffer(ENC.whole([text])[0], "<u4").tolist()
        assert sp.decode(ids) == text
        assert ENC.vocab.decode(sp.encode(text))[1:].decode() == text


def test_associative():
    rng = np.random.default_rng(1)
    m = rng.integers(-50, 0, (7, 4, 4)).astype(float)
    left = m[0]
    for x in m[1:]:
        left = spm.max_plus(left, x)
    assert (spm.prefixes(m)[-1] == left).all()


@pytest.mark.parametrize("chunk", [7, 64, 16384])
def test_documents(spark, docs_of, chunk):
    rows = [(1, "Hello  world\nof pieces"), (2, ""), (3, None), (3, "again ▁ and again"), (None, "x" * 50),
            (5, "wörter " * 40), (5, "wörter " * 40)]
    enc = spm.encode_documents(docs_of(rows), PATH, chunk=chunk)
    got = spm.digest(enc).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    back = spm.decode_documents(spm.encode_documents(docs_of(rows), PATH, chunk=chunk), PATH).collect()
    key = lambda r: (r[0] or 0, r[1])
    assert sorted(((r.doc_id, r.text) for r in back), key=key) == sorted(((i, t or "") for i, t in rows), key=key)


def test_query_gives_the_ids_of_the_best_path(spark, docs_of):
    """Whole texts by one forward pass against the registered path, with texts of several chunks of
    the production size."""
    rows = [(1, "Hello  world\nof pieces"), (2, None), (3, "wörter und ▁ mehr " * 2500), (3, "x" * 40_000), (None, "a  b " * 4000)]

    def ids(text):
        if not text:
            return np.array([], "<u4")
        s = " " + text
        _, last = ENC.vocab.forward(s)
        return np.array(ENC.vocab.trace(s, last, 0, len(s)), "<u4")

    want = [(i, len(x), zlib.crc32(x.tobytes()), True) for i, x in ((i, ids(t)) for i, t in rows)]
    got = [tuple(r) for r in spm.digest(spm.encode_documents(docs_of(rows), PATH)).collect()]
    assert sorted(got, key=str) == sorted(want, key=str)


def test_empty_table(docs_of):
    assert spm.digest(spm.encode_documents(docs_of([]), PATH)).collect() == []
