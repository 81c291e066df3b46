"""DuckDB SQL of the three deduplications, by plain comparison of every window or shingle set.

It takes doc_id as unique and not null, as it is in the given tables. Nothing here shares a step with the operators:
windows are whole strings under md5, links come from counting common shingles, components from reachability.
"""
from __future__ import annotations

_WORD = r"[^\x20\x09-\x0D]+"


def substring_sql(window: int = 50, block: int = 100) -> str:
    """Words covered by a window that also starts in a document with a smaller id."""
    return f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{_WORD}') AS w FROM documents),
b AS (SELECT doc_id, w, unnest(range(0, len(w), {block})) AS b FROM d),
s AS (SELECT doc_id, b, w[b + 1:b + {block + window - 1}] AS s FROM b),
h AS (SELECT doc_id, b, s[1:{block}] AS w, list_transform(range(1, least(len(s) - {window}, {block} - 1) + 2),
    lambda i: md5(array_to_string(s[i:i + {window - 1}], ' '))) AS h FROM s),
p AS (SELECT doc_id, unnest(w) AS word, unnest(h) AS h, unnest(range(b + 1, b + len(w) + 1)) AS pos FROM h),
f AS (SELECT h, min(doc_id) AS first_id FROM p WHERE h IS NOT NULL GROUP BY h),
c AS (SELECT p.doc_id, p.pos, p.word, coalesce(max(CASE WHEN f.first_id < p.doc_id THEN 1 ELSE 0 END) OVER (
    PARTITION BY p.doc_id ORDER BY p.pos ROWS BETWEEN {window - 1} PRECEDING AND CURRENT ROW), 0) AS gone
  FROM p LEFT JOIN f ON p.h = f.h),
k AS (SELECT doc_id, count(*) AS n_words, sum(gone) AS n_removed,
    string_agg(word, ' ' ORDER BY pos) FILTER (WHERE gone = 0) AS kept FROM c GROUP BY doc_id)
SELECT d.doc_id, coalesce(k.n_words, 0)::BIGINT AS n_words, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  sha256(coalesce(k.kept, '')) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""


def bytes_sql(width: int = 200, block: int = 200) -> str:
    """Bytes covered by a string of ``width`` bytes that starts at two places; texts go as hexadecimal digits, and
    windows are cut from blocks, so that no substring is sought through a whole long text."""
    return f"""
WITH d AS (SELECT doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
b AS (SELECT doc_id, length(x) // 2 AS n, x, unnest(range(0, (length(x) // 2 + {block - 1}) // {block})) AS b FROM d),
s AS (SELECT doc_id, n, b, substr(x, {2 * block} * b + 1, {2 * (block + width - 1)}) AS s FROM b),
l AS (SELECT doc_id, b, range(b * {block}, least(n, (b + 1) * {block})) AS pos,
    list_transform(range(0, least(n - b * {block}, {block})), lambda i: substr(s, 2 * i + 1, 2)) AS byte,
    list_transform(range(0, least(n - b * {block} - {width - 1}, {block})),
      lambda i: md5(substr(s, 2 * i + 1, {2 * width}))) AS h FROM s),
p AS (SELECT doc_id, unnest(pos) AS pos, unnest(byte) AS byte, unnest(h) AS h FROM l),
r AS (SELECT h FROM p WHERE h IS NOT NULL GROUP BY h HAVING count(*) > 1),
c AS (SELECT p.doc_id, p.pos, p.byte, max(CASE WHEN r.h IS NOT NULL THEN 1 ELSE 0 END) OVER (
    PARTITION BY p.doc_id ORDER BY p.pos ROWS BETWEEN {width - 1} PRECEDING AND CURRENT ROW) AS gone
  FROM p LEFT JOIN r ON p.h = r.h),
e AS (SELECT *, lag(gone, 1, 0) OVER (PARTITION BY doc_id ORDER BY pos) AS before FROM c),
k AS (SELECT doc_id, sum(gone) AS n_removed, sum(CASE WHEN gone = 1 AND before = 0 THEN 1 ELSE 0 END) AS n_spans,
    string_agg(byte, '' ORDER BY pos) FILTER (WHERE gone = 0) AS kept FROM e GROUP BY doc_id)
SELECT d.doc_id, (length(d.x) // 2)::BIGINT AS n_bytes, coalesce(k.n_removed, 0)::BIGINT AS n_removed,
  coalesce(k.n_spans, 0)::BIGINT AS n_spans, sha256(unhex(coalesce(k.kept, ''))) AS kept_sha256
FROM d LEFT JOIN k ON d.doc_id = k.doc_id"""


def jaccard_sql(shingle: int = 5, percent: int = 80, block: int = 100) -> str:
    """Components of the links between shingle sets; documents with the same set are one class."""
    return f"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''),
    'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '{_WORD}') AS w FROM documents),
b AS (SELECT doc_id, w, unnest(range(0, greatest(len(w) - {shingle - 1}, least(len(w), 1)), {block})) AS b FROM w),
p AS (SELECT doc_id, w[b + 1:b + {block + shingle - 1}] AS s FROM b),
g AS (SELECT DISTINCT doc_id, unnest(list_transform(range(1, greatest(len(s) - {shingle - 1}, 1) + 1),
    lambda i: array_to_string(s[i:i + {shingle - 1}], ' '))) AS s FROM p),
d AS (SELECT doc_id, count(*) AS n, md5(string_agg(s, chr(10) ORDER BY s)) AS k FROM g GROUP BY doc_id),
class AS (SELECT min(doc_id) AS c, k, any_value(n) AS n FROM d GROUP BY k),
e AS (SELECT c, n, s FROM class JOIN g ON g.doc_id = class.c),
shared AS (SELECT list(struct_pack(c := c, n := n)) AS l FROM e GROUP BY s HAVING count(*) > 1),
left_side AS (SELECT l, unnest(l) AS a FROM shared),
pair AS (SELECT a, unnest(list_filter(l, lambda x: x.c > a.c AND 100 * least(a.n, x.n) >= {percent} * greatest(a.n, x.n))) AS b
  FROM left_side),
common AS (SELECT a.c AS a, b.c AS b, a.n AS na, b.n AS nb, count(*) AS i FROM pair GROUP BY ALL),
link AS (SELECT a, b FROM common WHERE 100 * i >= {percent} * (na + nb - i)),
step AS (SELECT a, b FROM link UNION ALL SELECT b, a FROM link),
reach AS (SELECT c AS root, c AS node FROM class UNION SELECT reach.root, step.b FROM reach JOIN step ON step.a = reach.node),
root AS (SELECT root, min(node) AS component_id FROM reach GROUP BY root)
SELECT w.doc_id, coalesce(d.n, 0)::BIGINT AS n_shingles, coalesce(root.component_id, w.doc_id) AS component_id
FROM w LEFT JOIN d ON w.doc_id = d.doc_id LEFT JOIN class ON d.k = class.k LEFT JOIN root ON root.root = class.c"""
