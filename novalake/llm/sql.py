"""The results of two operators in SQL, for comparison."""

from __future__ import annotations

import string

_LOWER = "translate(coalesce(text, ''), '{0}', '{1}')".format(string.ascii_uppercase, string.ascii_lowercase)


def _words(pattern: str) -> str:
    return f"regexp_extract_all({_LOWER}, '{pattern}')"


_WORD = _words(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")

DECONTAMINATION = rf"""WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORD} AS w FROM documents),
b AS (SELECT CAST(item_id AS VARCHAR) AS id, {_WORD} AS w FROM benchmark),
bw AS (SELECT DISTINCT id, w[i : least(i + 12, len(w))] AS win
  FROM (SELECT id, w, unnest(range(1, greatest(2, len(w) - 11))) AS i FROM b WHERE len(w) > 0)),
sizes AS (SELECT DISTINCT len(win) AS n FROM bw),
dw AS (SELECT r, i, n, w[i : i + n - 1] AS win
  FROM (SELECT r, w, n, unnest(range(1, len(w) - n + 2)) AS i FROM d, sizes WHERE len(w) >= n)),
hits AS (SELECT r, i, n, id FROM dw JOIN bw ON dw.win = bw.win),
places AS (SELECT r, unnest(range(i, i + n)) AS p FROM (SELECT DISTINCT r, i, n FROM hits)),
hit AS (SELECT r, count(DISTINCT p) AS n_hit FROM places GROUP BY r),
found AS (SELECT r, count(*) AS n_items, string_agg(id, ',' ORDER BY id) AS ids
  FROM (SELECT DISTINCT r, id FROM hits) GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, coalesce(n_hit, 0) AS n_hit, coalesce(n_items, 0) AS n_items,
  sha256(coalesce(ids, '')) AS items_sha256,
  coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN hit ON d.r = hit.r LEFT JOIN found ON d.r = found.r"""

_TOKEN = _words(r"[^\x20\x09-\x0D]+")

JACCARD_JOIN = rf"""WITH RECURSIVE d AS (SELECT doc_id, {_TOKEN} AS w FROM documents),
s AS (SELECT DISTINCT doc_id, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM (SELECT doc_id, w, unnest(range(1, greatest(2, len(w) - 3))) AS i FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
pairs AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s x JOIN s y ON x.shingle = y.shingle
  WHERE x.doc_id <> y.doc_id GROUP BY x.doc_id, y.doc_id),
links AS (SELECT a, b FROM pairs JOIN n na ON a = na.doc_id JOIN n nb ON b = nb.doc_id
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (SELECT doc_id, doc_id AS m FROM d UNION SELECT reach.doc_id, b FROM reach JOIN links ON m = a)
SELECT d.doc_id, coalesce(any_value(n.n), 0) AS n_shingles, min(m) AS component_id
FROM d JOIN reach ON d.doc_id = reach.doc_id LEFT JOIN n ON d.doc_id = n.doc_id GROUP BY d.doc_id"""

TOP_SCORES = """WITH v AS (SELECT row_number() OVER () AS r, vec_id,
    list_transform(embedding, lambda x: floor(64 * CAST(x AS DOUBLE))) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.r, q.vec_id AS query_id, c.vec_id, CAST(list_inner_product(q.e, c.e) AS BIGINT) AS score,
    row_number() OVER (PARTITION BY q.r ORDER BY list_inner_product(q.e, c.e) DESC, c.vec_id) AS rank
  FROM v q JOIN v c ON q.r <> c.r WHERE q.vec_id % 20 = 0)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM s WHERE rank <= 20"""

_TERM = _words(r"[^\x00-\x40\x5B-\x60\x7B-\x7F]+")

SOURCE_DIVERGENCE = rf"""WITH d AS (SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
    {_TERM} AS w FROM documents),
t AS (SELECT r, lang, source, unnest(w) AS term FROM d),
kept AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (SELECT t.lang, source, term, count(*) AS n FROM t JOIN kept USING (lang, term) GROUP BY t.lang, source, term),
full_c AS (SELECT g.lang, g.source, kept.term, coalesce(c.n, 0) AS n
  FROM g JOIN kept ON g.lang = kept.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = kept.term),
p AS (SELECT lang, source, term, n, 1 + CAST(1000000000 AS HUGEINT) * (n + 2)
    // (sum(n) OVER (PARTITION BY lang, source) + 2 * v) AS p FROM full_c JOIN v USING (lang)),
l AS (SELECT lang, term, 1 + CAST(1000000000 AS HUGEINT) * (sum(n) + 2)
    // (sum(sum(n)) OVER (PARTITION BY lang) + 2 * any_value(v)) AS q FROM full_c JOIN v USING (lang) GROUP BY lang, term),
sums AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY a.lang, a.source, b.source),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source
  LEFT JOIN sums s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
terms AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value
  FROM p JOIN l USING (lang, term) WHERE n > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS rank
  FROM (SELECT * FROM pairs UNION ALL SELECT * FROM terms))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM ranked WHERE part = 'pair' OR rank <= 10"""

_CRC = "SELECT range AS i, range AS v FROM range(256)"
for _ in range(8):
    _CRC = f"SELECT i, CASE WHEN v & 1 = 1 THEN xor(v >> 1, 3988292384) ELSE v >> 1 END AS v FROM ({_CRC})"

PREFIX_TRIE = f"""WITH RECURSIVE crc AS ({_CRC}),
o AS (SELECT conv_id AS c, role, text, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) - 1 AS pos
  FROM (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations)
  WHERE conv_id IS NOT NULL),
step AS (SELECT DISTINCT c, CAST(c AS VARCHAR) AS s, 0 AS k, CAST(4294967295 AS BIGINT) AS r FROM o
  UNION ALL SELECT c, s, k + 1, xor(r >> 8, v) FROM step JOIN crc ON i = xor(r, CAST(ascii(s[k + 1]) AS BIGINT)) & 255
  WHERE k < length(s)),
h AS (SELECT c, c - c % 5 AS b, CASE WHEN c % 5 = 0 THEN 0 ELSE xor(r, 4294967295) % 9 END AS h FROM step WHERE k = length(s)),
heads AS (SELECT h.c, o.pos AS j, role, text FROM h JOIN o ON o.c = h.b AND o.pos < h.h),
m AS (SELECT h.c, h.h, count(heads.j) AS m FROM h LEFT JOIN heads ON h.c = heads.c GROUP BY h.c, h.h),
re AS (SELECT * FROM heads UNION ALL
  SELECT o.c, m + pos - h, role, text FROM o JOIN m ON o.c = m.c WHERE pos >= h),
r AS (SELECT c, j + 1 AS depth, strlen(text) AS bytes, sha256(string_agg(concat(length(role), ':', length(text), ':', role, text), '')
    OVER (PARTITION BY c ORDER BY j)) AS node FROM re
  UNION ALL SELECT c, 0, 0, 'root' FROM h),
ends AS (SELECT c, max(depth) AS depth FROM r GROUP BY c),
n AS (SELECT r.depth, node, min(r.c) AS conv_id, count(*) AS n_convs, any_value(bytes) AS bytes,
    string_agg(CAST(ends.c AS VARCHAR), ',' ORDER BY ends.c) AS ids
  FROM r LEFT JOIN ends ON ends.c = r.c AND ends.depth = r.depth GROUP BY r.depth, node),
p AS (SELECT n.*, up.node AS parent FROM n LEFT JOIN r up ON up.c = n.conv_id AND up.depth = n.depth - 1),
kids AS (SELECT parent, depth - 1 AS depth, count(*) AS n FROM p WHERE parent IS NOT NULL GROUP BY parent, depth),
q AS (SELECT p.*, coalesce(kids.n, 0) AS n_children, up.conv_id AS parent_conv_id FROM p
  LEFT JOIN kids ON kids.parent = p.node AND kids.depth = p.depth
  LEFT JOIN n up ON up.node = p.parent AND up.depth = p.depth - 1),
below AS (SELECT r.node, r.depth, count_if(n_children = 0) AS n_leaves, sum((n_convs - 1) * q.bytes) AS saved
  FROM q JOIN r ON r.c = q.conv_id AND r.depth <= q.depth GROUP BY r.node, r.depth)
SELECT conv_id, depth, parent_conv_id, n_convs, n_children, CAST(n_leaves AS BIGINT) AS n_leaves,
  CAST(saved AS BIGINT) AS saved_tokens, sha256(coalesce(ids, '')) AS ends_sha256
FROM q JOIN below USING (node, depth)"""
