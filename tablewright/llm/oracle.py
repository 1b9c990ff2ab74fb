"""DuckDB SQL for the queries that SQL can express."""

from __future__ import annotations

ORACLE: dict[str, str] = {}

ORACLE["op9_benchmark_decontamination"] = r"""
WITH b AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark),
bl AS (SELECT item_id, w, least(len(w), 10) AS l FROM b WHERE len(w) > 0),
bw AS (SELECT DISTINCT item_id, l, array_to_string(w[i + 1:i + l], ' ') AS k
  FROM (SELECT item_id, w, l, unnest(range(0, len(w) - l + 1)) AS i FROM bl)),
d AS (
  SELECT row_number() OVER () AS rid, doc_id,
    regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents),
dl AS (SELECT rid, w, l FROM d, (SELECT DISTINCT l FROM bw) WHERE len(w) >= l),
dw AS (SELECT rid, i, l, array_to_string(w[i + 1:i + l], ' ') AS k
  FROM (SELECT rid, w, l, unnest(range(0, len(w) - l + 1)) AS i FROM dl)),
h AS (SELECT dw.rid, dw.i, dw.l, bw.item_id FROM dw JOIN bw ON dw.l = bw.l AND dw.k = bw.k),
p AS (SELECT rid, count(DISTINCT pos) AS n_hit FROM (SELECT rid, unnest(range(i, i + l)) AS pos FROM h) GROUP BY rid),
t AS (SELECT rid, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS items
  FROM (SELECT DISTINCT rid, CAST(item_id AS VARCHAR) AS item FROM h WHERE item_id IS NOT NULL) GROUP BY rid),
g AS (SELECT rid, pos, pos - row_number() OVER (PARTITION BY rid ORDER BY pos) AS run
  FROM (SELECT DISTINCT rid, unnest(range(i, i + l)) AS pos FROM h)),
r AS (SELECT rid, string_agg(CAST(a AS VARCHAR) || ',' || CAST(z AS VARCHAR), ',' ORDER BY a) AS spans
  FROM (SELECT rid, run, min(pos) AS a, max(pos) + 1 AS z FROM g GROUP BY rid, run) GROUP BY rid)
SELECT d.doc_id, CAST(len(d.w) AS BIGINT) AS n_words, coalesce(p.n_hit, 0) AS n_hit, coalesce(t.n_items, 0) AS n_items,
  sha256(coalesce(t.items, '')) AS items_sha256, coalesce(p.n_hit, 0) > 0 AS contaminated,
  coalesce(r.spans, '') AS hit_spans
FROM d LEFT JOIN p USING (rid) LEFT JOIN t USING (rid) LEFT JOIN r USING (rid)
"""

# the tree of sharding.layout: 3 regions of 4 racks of 2 shards, and shard 24 in a region of its own
ORACLE["op1_sharding"] = r"""
WITH RECURSIVE leaf(n, region, rack, shard) AS (
  SELECT n, CASE WHEN s < 24 THEN s // 8 ELSE 3 + s - 24 END, CASE WHEN s < 24 THEN s // 2 % 4 ELSE 0 END, s
  FROM (VALUES (24), (25)) v(n), range(25) r(s) WHERE s < n),
node AS (
  SELECT n, '' AS parent, region::VARCHAR AS name, count(*)::DOUBLE AS weight FROM leaf GROUP BY n, region
  UNION ALL SELECT n, region::VARCHAR, region || '/' || rack, count(*)::DOUBLE FROM leaf GROUP BY n, region, rack
  UNION ALL SELECT n, region || '/' || rack, region || '/' || rack || '/' || shard, 1.0 FROM leaf),
doc AS (
  SELECT row_number() OVER () AS rid, doc_id, coalesce(text, '') AS body, coalesce(doc_id::VARCHAR, '') AS key FROM documents),
keys AS (SELECT DISTINCT key FROM doc),
score AS (
  SELECT key, n, parent, name,
    -ln((('0x' || substr(md5(key || '|' || name), 1, 8))::BIGINT + 0.5) / 4294967296.0) / weight AS score FROM keys, node),
pick AS (
  SELECT key, n, parent, arg_min(name, score) AS name FROM score GROUP BY key, n, parent),
place AS (
  SELECT a.key, a.n, c.name AS path FROM pick a JOIN pick b ON b.key = a.key AND b.n = a.n AND b.parent = a.name
  JOIN pick c ON c.key = a.key AND c.n = a.n AND c.parent = b.name WHERE a.parent = ''),
crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
crc AS (
  SELECT rid, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(body)), '..'),
    lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) AS text_crc32
  FROM doc, crc_table),
r AS (
  SELECT doc.doc_id, doc.key, octet_length(encode(body)) + 8 AS size, text_crc32, string_split(p.path, '/') AS p,
    string_split(g.path, '/') AS g
  FROM doc JOIN crc USING (rid) JOIN place p ON p.key = doc.key AND p.n = 24 JOIN place g ON g.key = doc.key AND g.n = 25)
SELECT doc_id, size, text_crc32, 'key' AS law, p[1]::INTEGER AS region, p[2]::INTEGER AS rack, p[3]::INTEGER AS shard,
  g[3]::INTEGER AS grown_shard,
  row_number() OVER (PARTITION BY p[3] ORDER BY md5(key || '|' || text_crc32 || '|' || size),
    doc_id, text_crc32, size) - 1 AS slot
FROM r
"""

ORACLE["op12_source_divergence"] = r"""
WITH d AS (
  SELECT row_number() OVER () AS rid, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text
  FROM documents),
w AS (
  SELECT rid, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
    'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY lang, term HAVING count(DISTINCT rid) >= 3),
c AS (SELECT lang, source, term, count(*) AS n FROM w JOIN kept USING (lang, term) GROUP BY lang, source, term),
g AS (SELECT DISTINCT lang, source FROM d),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
t AS (
  SELECT g.lang, g.source, coalesce(sum(c.n), 0) AS n_group, coalesce(any_value(v.v), 0) AS v
  FROM g LEFT JOIN c ON c.lang = g.lang AND c.source = g.source LEFT JOIN v ON v.lang = g.lang GROUP BY g.lang, g.source),
full_p AS (
  SELECT t.lang, t.source, kept.term, coalesce(c.n, 0) AS n,
    CAST(1 + 1000000000::HUGEINT * (coalesce(c.n, 0) + 1) // (t.n_group + t.v) AS BIGINT) AS p
  FROM t JOIN kept ON kept.lang = t.lang
  LEFT JOIN c ON c.lang = t.lang AND c.source = t.source AND c.term = kept.term),
lang_p AS (
  SELECT lang, term, CAST(1 + 1000000000::HUGEINT * (n + 1) // (total + v) AS BIGINT) AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term)
  JOIN (SELECT lang, sum(n_group) AS total, any_value(v) AS v FROM t GROUP BY lang) USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, coalesce(sum((x.p - y.p) * (x.p - y.p) // y.p), 0) AS value
  FROM g a JOIN g b ON b.lang = a.lang AND b.source <> a.source
  LEFT JOIN full_p x ON x.lang = a.lang AND x.source = a.source
  LEFT JOIN full_p y ON y.lang = b.lang AND y.source = b.source AND y.term = x.term
  GROUP BY a.lang, a.source, b.source),
term AS (
  SELECT x.lang, x.source, x.term AS item, (x.p - q) * (x.p - q) // q AS value
  FROM full_p x JOIN lang_p USING (lang, term) WHERE x.n > 0 AND x.p > q),
r AS (
  SELECT lang, source, 'pair' AS part, item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM pair
  UNION ALL
  SELECT lang, source, 'term', item, value,
    row_number() OVER (PARTITION BY lang, source ORDER BY value DESC, item) AS rank FROM term)
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank
FROM r WHERE part = 'pair' OR rank <= 200
"""


def _least(*paths: str) -> str:
    """The first of paths {cost, audit, rows} by cost and audit."""
    return f"list_min([{', '.join(paths)}])"


def _edit(path: str, cost: str, letter: str, role: str | None = None) -> str:
    rows = f"{path}.r" if role is None else f"{path}.r || chr(10) || {role}"
    return f"{{'c': {path}.c + {cost}, 'a': {path}.a || '{letter}', 'r': {rows}}}"


_NOWHERE = "{'c': 1000000000::BIGINT, 'a': '', 'r': ''}"
_USER, _ASSISTANT = "'user:' || x", "'assistant:' || x"


def _when(condition: str, path: str) -> str:
    return f"CASE WHEN {condition} THEN {path} ELSE {_NOWHERE} END"


# one step over a row: paths z (nothing yet), s, u, a by the last role's initial; stay: neither blank nor duplicate
_TO_USER = [
    _when(c, _edit(p, f"{cost} + extra", letter, role)) for p in "zsa"
    for c, cost, letter, role in (("stay AND initial = 'u'", 0, "K", "role || ':' || x"), ("stay", 3, "R", _USER))
]
_TO_ASSISTANT = [
    _when("stay AND initial = 'a'", _edit("u", "extra", "K", "role || ':' || x")),
    _when("stay", _edit("u", "3 + extra", "R", _ASSISTANT)),
]

ORACLE["op11_conversation_repair"] = rf"""
WITH RECURSIVE crc_table AS (
  SELECT list(c ORDER BY i) AS t FROM (
    SELECT i, list_reduce(list_prepend(i, [0, 0, 0, 0, 0, 0, 0, 0]::BIGINT[]),
      lambda c, z: CASE WHEN c % 2 = 1 THEN xor(c // 2, 3988292384) ELSE c // 2 END) AS c FROM range(256) r(i))),
k AS (SELECT DISTINCT coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS key FROM conversations),
h AS (
  SELECT key, xor(list_reduce(list_prepend(4294967295, list_transform(regexp_extract_all(hex(encode(key)), '..'),
    lambda x: ('0x' || x)::BIGINT)), lambda c, b: xor(c // 256, t[xor(c % 256, b) + 1])), 4294967295) % 20 AS kind
  FROM k, crc_table),
d AS (
  SELECT conv_id, turn, CASE WHEN kind = 4 THEN 'user' ELSE coalesce(role, ' ') END AS role,
    CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(coalesce(text, ' '), '[.!?]', '', 'g')
      ELSE coalesce(text, ' ') END AS x,
    unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM conversations JOIN h ON key = coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ')),
g AS (SELECT conv_id, row_number() OVER () AS g FROM (SELECT DISTINCT conv_id FROM conversations)),
o AS (
  SELECT g.g, d.turn, d.role, d.x, row_number() OVER (PARTITION BY g.g ORDER BY d.turn NULLS FIRST, d.role, d.x) AS i
  FROM d JOIN g ON g.conv_id IS NOT DISTINCT FROM d.conv_id),
f AS (
  SELECT *, rtrim(x, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS bare,
    row_number() OVER (PARTITION BY g, role, x ORDER BY i) > 1 AS again, substr(role, 1, 1) AS initial,
    lag(substr(role, 1, 1)) OVER (PARTITION BY g ORDER BY i) AS before FROM o),
m AS (
  SELECT g, i, turn, role, x, initial, before, bare = '' AS blank, bare <> '' AND again AS duplicate,
    bare <> '' AND NOT again AND right(bare, 1) NOT IN ('.', '!', '?') AS truncated,
    bare <> '' AND NOT again AS stay FROM f),
e AS (SELECT *, CASE WHEN truncated THEN 3 ELSE 0 END AS extra FROM m),
s0 AS (SELECT {{'c': 0::BIGINT, 'a': '', 'r': ''}} AS z),
walk(g, i, z, s, u, a) AS (
  SELECT g, 0::BIGINT, z, {_NOWHERE}, {_edit("z", "3", "I", "'user:'")},
    {{'c': 6::BIGINT, 'a': 'II', 'r': chr(10) || 'user:' || chr(10) || 'assistant:'}} FROM g, s0
  UNION ALL
  SELECT g, i, z, s, u, {_least("a", _edit("u", "3", "I", "'assistant:'"))} FROM (
    SELECT g, i, z, s, a, {_least("u", *(_edit(p, "3", "I", "'user:'") for p in "zsa"))} AS u FROM (
      SELECT walk.g, e.i, {_edit("z", "4", "D")} AS z,
        {_least(_edit("s", "4", "D"), _when("stay AND initial = 's'", _edit("z", "extra", "K", "role || ':' || x")))} AS s,
        {_least(_edit("u", "4", "D"), *_TO_USER)} AS u, {_least(_edit("a", "4", "D"), *_TO_ASSISTANT)} AS a
      FROM walk JOIN e ON e.g = walk.g AND e.i = walk.i + 1))),
n AS (
  SELECT g, max(i) AS i, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (blank) AS blank,
    count(*) FILTER (duplicate) AS duplicate, count(*) FILTER (truncated) AS truncated,
    count(*) FILTER (before IS NOT NULL AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM e GROUP BY g),
best AS (SELECT walk.g, {_least("z", "a")} AS b FROM walk LEFT JOIN n USING (g) WHERE walk.i = coalesce(n.i, 0))
SELECT g.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
  coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, b.c AS cost, b.a AS audit,
  sha256(substr(b.r, 2)) AS repaired_sha256
FROM g JOIN best USING (g) LEFT JOIN n USING (g)
"""
