import hashlib
from collections import Counter

import numpy as np
import public_tokenizers
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from ledgerlight.llm import alignment
from ledgerlight.llm.memo import ByteLevel, byte_of_char

A, B = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
TOK = Tokenizer.from_file(A)
TOK.encode_special_tokens = True
SPM = sentencepiece.SentencePieceProcessor(model_file=B)
TEXTS = ["Hello  world\n\n x", None, "", " ", "  ", " a ", "naïve café <|endoftext|> <s> <0x41> z ", "tab\t end ", "word " * 700,
         "a▁b", "▁", "日本語のテキスト 🎉🎉", "\r\n\x00\x1c", "Hello  world\n\n x", "x" * 300]


def tokens(text):
    """Ids and bytes of both sides of the whole text, or nothing."""
    want = (" " + text).encode() if text else b""
    if not text:
        return [], [], [], []
    at = byte_of_char()
    a = TOK.encode(" " + text, add_special_tokens=False).ids
    b = SPM.encode(text)
    bytes_a = [bytes(at[c] for c in TOK.id_to_token(k)) for k in a]
    bytes_b = []
    for k in b:
        p = SPM.id_to_piece(k)
        bytes_b.append(bytes([int(p[3:5], 16)]) if SPM.is_byte(k) else p.replace("▁", " ").encode())
    if b"".join(bytes_a) != want or b"".join(bytes_b) != want:
        return [], [], [], []
    return a, b, bytes_a, bytes_b


def ranges(parts):
    out, at = [], 0
    for p in parts:
        out.append((at, at + len(p)))
        at += len(p)
    return out


def brute(texts):
    """Rows without doc_id, and all overlaps by comparing every token with every other."""
    rows, counts, all_overlaps = [], Counter(), []
    for t in texts:
        a, b, ba, bb = tokens(t)
        ra, rb = ranges(ba), ranges(bb)
        over = [(i, j) for i, x in enumerate(ra) for j, y in enumerate(rb) if x[0] < y[1] and y[0] < x[1]]
        links = [(i, j) for i, j in over if ra[i][1] == rb[j][1]]
        ends = sorted({e for _, e in ra} & {e for _, e in rb})
        groups, lo = [], 0
        for e in ends:
            left = ",".join(str(k) for k, (s, f) in zip(a, ra) if lo <= s and f <= e)
            groups.append(left + "|" + ",".join(str(k) for k, (s, f) in zip(b, rb) if lo <= s and f <= e))
            lo = e
        counts.update((a[i], b[j]) for i, j in links)
        all_overlaps.append({(i, j, ra[i][1] == rb[j][1]) for i, j in over})
        rows.append((len(a), len(b), len(ends), [(a[i], b[j]) for i, j in links],
                     hashlib.sha256(";".join(groups).encode()).hexdigest() if a else ""))
    most = {}
    for (_, y), n in counts.items():
        most[y] = max(most.get(y, 0), n)
    out = [(na, nb, ng, len(links), sum(counts[p] == most[p[1]] for p in links), sum(counts[p] for p in links), sha)
           for na, nb, ng, links, sha in rows]
    return out, all_overlaps, counts, most


@settings(max_examples=150, deadline=None)
@given(st.text(st.sampled_from("ab'sT 1.  \n\t\r▁é<|>日🎉\x1c"), max_size=60))
def test_units_change_no_ids(text):
    spaced = " " + text
    a, b, _, _ = tokens(text)
    got_a, got_b = alignment.side_a(A).ids([spaced])[0], alignment.side_b(B).ids([spaced])[0]
    if a:
        assert (got_a.tolist(), got_b.tolist()) == (a, b)
    elif text:
        assert got_a is None or got_b is None


TOGETHER = ByteLevel(A, True)


@settings(max_examples=100, deadline=None)
@given(st.lists(st.text(st.sampled_from("ab'sT1.é日\u0301<|\x1c\x85 "), max_size=6).map(lambda s: " " + s), max_size=40))
def test_units_encoded_together(units):
    assert [np.frombuffer(x, "<u4").tolist() for x in TOGETHER.encode(units)] == [
        TOK.encode(u, add_special_tokens=False).ids for u in units]


def columns(r):
    return (r.n_a, r.n_b, r.n_groups, r.n_links, r.n_best, r.count_sum, r.groups_sha256)


def test_documents_against_brute_force(spark, docs_of):
    rows = [*enumerate(TEXTS), (2, "again"), (2, "again"), (None, "no id"), (None, None)]
    want, over, counts, most = brute([t for _, t in rows])
    got = alignment.align_documents(docs_of(rows), A, B).collect()
    assert sorted((str(r.doc_id), *columns(r)) for r in got) == sorted((str(i), *w) for (i, _), w in zip(rows, want))
    pairs = {}
    for r in alignment.overlaps(docs_of(rows), A, B).collect():
        pairs.setdefault((r.doc_id, r.row), set()).add((r.a, r.b, r.together))
    assert sorted(map(sorted, pairs.values())) == sorted(sorted(o) for o in over if o)
    stored = alignment.linked(docs_of(rows), A, B)
    ids = alignment.id_links(spark, alignment.pair_counts(stored, A, B), A, B).collect()
    assert {(r.a_id, r.b_id): r.n for r in ids} == dict(counts)
    assert {(r.a_id, r.b_id) for r in ids if r.is_best} == {p for p, n in counts.items() if n == most[p[1]]}


def test_whole_table_against_brute_force(spark):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet").where("n_chars < 1500")
    rows = docs.select("doc_id", "text").collect()
    want, _, _, _ = brute([r.text for r in rows])
    got = {r.doc_id: columns(r) for r in alignment.align_documents(docs, A, B).collect()}
    assert got == {r.doc_id: w for r, w in zip(rows, want)}


def test_empty_table(spark, docs_of):
    assert alignment.align_documents(docs_of([]), A, B).collect() == []
    assert alignment.overlaps(docs_of([(1, None)]), A, B).collect() == []
