"""DuckDB SQL for the queries that SQL can express, over the driver's views."""

from __future__ import annotations

OP5 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM documents),
i AS (
  SELECT item_id, regexp_extract_all(
    translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS ws
  FROM benchmark),
ip AS (
  SELECT item_id, ws, least(13, len(ws)) AS size, unnest(range(0, len(ws) - least(13, len(ws)) + 1)) AS s
  FROM i WHERE len(ws) > 0),
w AS (SELECT DISTINCT item_id, size, array_to_string(ws[s + 1 : s + size], ' ') AS win FROM ip),
sizes AS (SELECT DISTINCT size FROM w),
dp AS (
  SELECT doc_id, ws, size, unnest(range(0, len(ws) - size + 1)) AS s FROM d, sizes WHERE len(ws) >= size),
g AS (SELECT doc_id, size, s, array_to_string(ws[s + 1 : s + size], ' ') AS win FROM dp),
h AS (SELECT DISTINCT doc_id, s, size, item_id FROM g JOIN w USING (size, win)),
p AS (SELECT DISTINCT doc_id, unnest(range(s, s + size)) AS pos FROM h),
n AS (SELECT doc_id, count(*) AS n_hit FROM p GROUP BY doc_id),
x AS (
  SELECT doc_id, list_sort(list(DISTINCT CAST(item_id AS VARCHAR))) AS items
  FROM h WHERE item_id IS NOT NULL GROUP BY doc_id)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words, coalesce(n.n_hit, 0) AS n_hit,
  CAST(coalesce(len(x.items), 0) AS BIGINT) AS n_items,
  sha256(coalesce(array_to_string(x.items, ','), '')) AS items_sha256,
  coalesce(n.n_hit, 0) > 0 AND 20 * coalesce(n.n_hit, 0) >= len(d.ws) AS contaminated
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN x USING (doc_id)
"""

# A hex digit as four bits, five bits as a base32 letter.
OP7 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, sha1(coalesce(html, '')) AS hex FROM pages),
b AS (
  SELECT *, array_to_string(list_transform(range(1, 41), lambda i:
    substr('0000000100100011010001010110011110001001101010111100110111101111',
           (strpos('0123456789abcdef', substr(hex, i, 1)) - 1) * 4 + 1, 4)), '') AS bits
  FROM p),
c AS (
  SELECT page_id, octet_length(encode(html)) AS payload_bytes, hex,
    array_to_string(list_transform(range(0, 32), lambda i: substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
      1 + 16 * CAST(substr(bits, i * 5 + 1, 1) AS INT) + 8 * CAST(substr(bits, i * 5 + 2, 1) AS INT)
        + 4 * CAST(substr(bits, i * 5 + 3, 1) AS INT) + 2 * CAST(substr(bits, i * 5 + 4, 1) AS INT)
        + CAST(substr(bits, i * 5 + 5, 1) AS INT), 1)), '') AS payload_digest,
    max(page_id) OVER (PARTITION BY hex) AS largest
  FROM b)
SELECT page_id, CAST(payload_bytes AS BIGINT) AS payload_bytes, payload_digest,
  CASE WHEN page_id = largest THEN 'response' ELSE 'revisit' END AS record_type,
  CASE WHEN page_id <> largest THEN largest END AS refers_to
FROM c
"""

# Per round: nearest entries (distance and number in one integer, so that ties
# go to the lower number), then floored means of the parts of an entry.
def _op11() -> str:
    def nearest(k: int) -> str:
        return f"""
a{k} AS (
  SELECT rn, p, any_value(x) AS x, min(list_sum(list_transform(range(1, len(x) + 1), lambda i: (x[i] - c[i]) * (x[i] - c[i]))) * 64 + e) AS m
  FROM parts JOIN b{k} USING (p) GROUP BY rn, p),"""

    def means(k: int) -> str:
        return f"""
s{k} AS (
  SELECT p, e, i, CAST(sum(v) AS BIGINT) AS s, count(*) AS n
  FROM (SELECT p, m % 64 AS e, unnest(range(1, len(x) + 1)) AS i, unnest(x) AS v FROM a{k - 1}) GROUP BY p, e, i),
m{k} AS (SELECT p, e, list((s - ((s % n) + n) % n) // n ORDER BY i) AS c FROM s{k} GROUP BY p, e),
b{k} AS (SELECT p, e, coalesce(m{k}.c, b{k - 1}.c) AS c FROM b{k - 1} LEFT JOIN m{k} USING (p, e)),"""

    return f"""
WITH k AS (
  SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
  FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
r AS (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS rn, len(v) // 16 AS w FROM k),
parts AS (SELECT rn, p, v[p * w + 1 : (p + 1) * w] AS x FROM r, range(16) AS t(p)),
b0 AS (SELECT p, rn - 1 AS e, x AS c FROM parts WHERE rn <= 64),{nearest(0)}{means(1)}{nearest(1)}{means(2)}{nearest(2)}
coded AS (
  SELECT rn, string_agg(lower(printf('%02x', m % 64)), '' ORDER BY p) AS code, CAST(sum(m // 64) AS BIGINT) AS error
  FROM a2 GROUP BY rn),
book AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS codebooks_sha256 FROM b2)
SELECT vec_id, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, codebooks_sha256
FROM r JOIN coded USING (rn), book
"""


# crc32 bit by bit; the trees level by level, and a leaf's run on each level
# from its place; the fold along the runs' other nodes.
OP12 = """
WITH RECURSIVE d AS (
  SELECT doc_id, source, lang, n_chars, text,
    xor(list_reduce(list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda c: CAST(ascii(c) AS BIGINT)),
      lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0],
        lambda x, y: xor(x >> 1, 3988292384 * (x & 1))), 4294967295), 4294967295) % 3 = 0 AS chosen
  FROM documents),
v AS (
  SELECT doc_id, lang, chosen,
    coalesce(strlen(CAST(doc_id AS VARCHAR)) || ':' || CAST(doc_id AS VARCHAR), '-')
      || coalesce(strlen(source) || ':' || source, '-') || coalesce(strlen(lang) || ':' || lang, '-')
      || coalesce(strlen(CAST(n_chars AS VARCHAR)) || ':' || CAST(n_chars AS VARCHAR), '-') AS head,
    coalesce(strlen(text) || ':' || text, '-') AS tail,
    coalesce(strlen(text) || ':' || translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '-') AS low
  FROM d),
l AS (
  SELECT doc_id, lang, sha256(head || tail) AS leaf, CASE WHEN chosen THEN sha256(head || low) END AS tampered FROM v),
leaves AS (
  SELECT *, row_number() OVER (PARTITION BY lang ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx,
    count(*) OVER (PARTITION BY lang) AS n FROM l),
tree AS (
  SELECT lang, 0 AS lvl, idx, leaf AS node, n FROM leaves
  UNION ALL
  SELECT lang, lvl + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (n + 7) // 8
  FROM tree WHERE n > 1 GROUP BY lang, lvl, idx // 8, n),
subs AS (
  SELECT lang, node AS subroot, row_number() OVER (ORDER BY lang NULLS FIRST) - 1 AS idx, count(*) OVER () AS n
  FROM tree WHERE n = 1),
top AS (
  SELECT 0 AS lvl, idx, subroot AS node, n FROM subs
  UNION ALL
  SELECT lvl + 1, idx // 8, sha256(string_agg(node, '' ORDER BY idx)), (n + 7) // 8
  FROM top WHERE n > 1 GROUP BY lvl, idx // 8, n),
runs AS (
  SELECT lang, lvl, idx // 8 AS run, list(node ORDER BY idx) AS nodes FROM tree WHERE n > 1 GROUP BY lang, lvl, idx // 8),
top_runs AS (SELECT lvl, idx // 8 AS run, list(node ORDER BY idx) AS nodes FROM top WHERE n > 1 GROUP BY lvl, idx // 8),
steps AS (
  SELECT e.lang, e.idx, r.lvl, r.nodes, CAST((e.idx // CAST(pow(8, r.lvl) AS BIGINT)) % 8 AS INT) AS pos
  FROM leaves e JOIN runs r ON r.lang IS NOT DISTINCT FROM e.lang AND r.run = e.idx // CAST(pow(8, r.lvl + 1) AS BIGINT)
  UNION ALL
  SELECT e.lang, e.idx, 1000 + r.lvl, r.nodes, CAST((s.idx // CAST(pow(8, r.lvl) AS BIGINT)) % 8 AS INT)
  FROM leaves e JOIN subs s ON s.lang IS NOT DISTINCT FROM e.lang
  JOIN top_runs r ON r.run = s.idx // CAST(pow(8, r.lvl + 1) AS BIGINT)),
paths AS (
  SELECT lang, idx, list([array_to_string(nodes[1:pos], ''), array_to_string(nodes[pos + 2:], '')] ORDER BY lvl) AS path
  FROM steps GROUP BY lang, idx),
f AS (
  SELECT e.doc_id, e.leaf, s.subroot, (SELECT node FROM top WHERE n = 1) AS root,
    sha256(array_to_string(flatten(coalesce(p.path, [])), '')) AS proof_sha256,
    list_reduce(list_transform(coalesce(p.path, []), lambda x: x[1] || '-' || x[2]),
      lambda acc, x: sha256(split_part(x, '-', 1) || acc || split_part(x, '-', 2)),
      coalesce(e.tampered, e.leaf)) AS folded_root
  FROM leaves e JOIN subs s ON s.lang IS NOT DISTINCT FROM e.lang
  LEFT JOIN paths p ON p.lang IS NOT DISTINCT FROM e.lang AND p.idx = e.idx)
SELECT *, folded_root = root AS verified FROM f
"""

ORACLE = {"op5_decontaminate": OP5, "op7_warc": OP7, "op11_codes": _op11(), "op12_merkle": OP12}
