import hashlib
import re
import zlib

from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerlight.llm import secrets

ASSIGN = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)


def base(text):
    out = [(m.start(), m.end(), "assign") for m in ASSIGN.finditer(text) if len(m[2]) >= 6]
    out += [(m.start(), m.end(), "access") for m in re.finditer(r"AKIA[A-Z0-9]+", text) if len(m[0]) >= 20]
    out += [(m.start(), m.end(), "hex") for m in re.finditer(r"[0-9a-f]+", text) if len(m[0]) >= 24]
    return sorted(out, key=lambda s: (s[0], secrets.KINDS.index(s[2])))


PART = st.sampled_from(["password", "PassWd", "token", "api_key", "APIKEY", "secret", " = ", ":", "'", '"', "=", "abc", "AKIA", "Z" * 16,
                        "deadbeef" * 3, "0123456789abcdef", "DEADBEEF", "ſ", "İ", "\n", " ", "é", "K", "x" * 6, "face", "akia"])


@settings(max_examples=1500, deadline=None)
@given(st.lists(PART, max_size=14).map("".join))
def test_base_spans_are_those_of_plain_search(text):
    assert [s for s in secrets.scan(text) if s[2] in secrets.BASE_KINDS] == base(text)


def github(body="A1b2C3d4E5f6G7h8I9j0K1l2M3n4O5", good=True):
    check = secrets.base62(zlib.crc32(body.encode()), 6)
    return "ghp_" + body + (check if good else check[::-1] + "")


def test_checksums():
    good, bad = github(), github()[:-1] + ("0" if github()[-1] != "0" else "1")
    assert [s[2] for s in secrets.scan("x " + good + " y")] == ["github"]
    assert secrets.scan("x " + bad + " y") == []
    assert secrets.scan("x" + good) == []
    assert [s[2] for s in secrets.scan(good.replace("ghp_", "npm_"))] == ["npm"]


def test_whole_table(spark, docs_of):
    rows = [(1, "token = 'abcdef12'"), (2, None), (3, ""), (None, "AKIA" + "Z9" * 8), (1, "x" * 70000 + "0123456789abcdef" * 2),
            (1, "x" * 70000 + "0123456789abcdef" * 2), (4, github())]
    got = secrets.scan_secrets(docs_of(rows)).collect()
    assert len(got) == len(rows)
    want = sorted((str(i), hashlib.sha256(secrets.joined(base(t or "")).encode()).hexdigest()) for i, t in rows)
    assert sorted((str(r.doc_id), r.base_sha256) for r in got) == want
    assert secrets.scan_secrets(docs_of([])).count() == 0
    masked = {r.text for r in secrets.redact_column(docs_of(rows)).collect()}
    assert "[secret]" in masked and None in masked and not any("AKIA" in (t or "") for t in masked)
