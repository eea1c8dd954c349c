"""DuckDB SQL of the corpus queries that SQL can express."""

from __future__ import annotations

WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

# ids of word windows are the windows' own text: exact, if slow
OP7 = f"""
WITH w AS (SELECT doc_id, {WORDS} AS ws FROM documents),
win AS (
  SELECT doc_id, i, md5(array_to_string(ws[i:i + 49], ' ')) AS h
  FROM (SELECT doc_id, ws, unnest(range(1, len(ws) - 48)) AS i FROM w WHERE len(ws) >= 50)),
low AS (SELECT h, min(doc_id) AS lo FROM win GROUP BY h HAVING min(doc_id) < max(doc_id)),
cov AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS p
  FROM win JOIN low USING (h) WHERE doc_id > lo),
pos AS (SELECT doc_id, ws, unnest(range(1, len(ws) + 1)) AS p FROM w),
kept AS (
  SELECT pos.doc_id, count(cov.p) AS n_removed,
         coalesce(string_agg(pos.ws[pos.p], ' ' ORDER BY pos.p) FILTER (cov.p IS NULL), '') AS t
  FROM pos LEFT JOIN cov ON cov.doc_id = pos.doc_id AND cov.p = pos.p GROUP BY pos.doc_id)
SELECT w.doc_id, CAST(len(ws) AS BIGINT) AS n_words,
       CAST(coalesce(n_removed, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t, '')) AS kept_sha256
FROM w LEFT JOIN kept ON kept.doc_id = w.doc_id
"""

OP1 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
         'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents),
s AS (
  SELECT DISTINCT doc_id, md5(array_to_string(ws[i:i + 4], ' ')) AS x
  FROM (SELECT doc_id, ws, unnest(range(1, greatest(len(ws) - 3, 2))) AS i
        FROM w WHERE len(ws) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
links AS (
  SELECT a, b FROM (
    SELECT s.doc_id AS a, t.doc_id AS b, count(*) AS c
    FROM s JOIN s t ON s.x = t.x AND s.doc_id <> t.doc_id GROUP BY ALL) o
  JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b
  WHERE 100 * c >= 80 * (na.n + nb.n - c)),
reach AS (
  SELECT a AS doc_id, b AS other FROM links
  UNION SELECT reach.doc_id, links.b FROM reach JOIN links ON links.a = reach.other)
SELECT w.doc_id, CAST(coalesce(n.n, 0) AS BIGINT) AS n_shingles,
       least(w.doc_id, coalesce(r.m, w.doc_id)) AS component_id
FROM w LEFT JOIN n ON n.doc_id = w.doc_id
LEFT JOIN (SELECT doc_id, min(other) AS m FROM reach GROUP BY doc_id) r ON r.doc_id = w.doc_id
"""

# crc32 of the decimal id, bit by bit; only its lowest bit is needed
OP12 = r"""
WITH RECURSIVE raw AS (
  SELECT doc_id, source, coalesce('+' || source, '') AS tree, text,
    CASE WHEN doc_id IS NULL THEN '-' ELSE strlen(CAST(doc_id AS VARCHAR)) || ':' || doc_id END
    || CASE WHEN source IS NULL THEN '-' ELSE strlen(source) || ':' || source END
    || CASE WHEN lang IS NULL THEN '-' ELSE strlen(lang) || ':' || lang END
    || CASE WHEN n_chars IS NULL THEN '-'
       ELSE strlen(CAST(n_chars AS VARCHAR)) || ':' || n_chars END AS head,
    list_reduce(list_prepend(CAST(4294967295 AS BIGINT),
        list_transform(string_split(CAST(doc_id AS VARCHAR), ''),
                       lambda c: CAST(ascii(c) AS BIGINT))),
      lambda a, b: list_reduce(list_prepend(xor(a, b), range(8)),
        lambda v, k: CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END)) AS crc
  FROM documents),
leaf AS (
  SELECT *, sha256(head || CASE WHEN text IS NULL THEN '-'
                           ELSE strlen(text) || ':' || text END) AS h,
    CASE WHEN crc % 2 = 1 AND text IS NOT NULL THEN  -- the final inversion flips the bit
      sha256(head || strlen(replace(text, chr(10), '')) || ':' || replace(text, chr(10), ''))
    END AS changed FROM raw),
node AS (
  SELECT tree, 0 AS lv, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1
    AS i, h, count(*) OVER (PARTITION BY tree) AS n FROM leaf
  UNION ALL
  SELECT tree, lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
  FROM node WHERE n > 1 GROUP BY tree, lv, i // 3),
sub AS (SELECT tree, h FROM node WHERE n = 1),
top AS (
  SELECT 0 AS lv, row_number() OVER (ORDER BY tree) - 1 AS i, h, count(*) OVER () AS n FROM sub
  UNION ALL
  SELECT lv + 1, i // 3, sha256(string_agg(h, '' ORDER BY i)), any_value((n + 2) // 3)
  FROM top WHERE n > 1 GROUP BY lv, i // 3),
root AS (SELECT h AS root FROM top WHERE n = 1),
place AS (
  SELECT *, row_number() OVER (PARTITION BY tree ORDER BY doc_id NULLS FIRST, h) - 1 AS i
  FROM leaf),
rank AS (SELECT tree, row_number() OVER (ORDER BY tree) - 1 AS i FROM sub),
low AS (SELECT tree, lv, i // 3 AS run, list(h ORDER BY i) AS hs, any_value(n) AS n
        FROM node GROUP BY tree, lv, i // 3),
high AS (SELECT lv, i // 3 AS run, list(h ORDER BY i) AS hs, any_value(n) AS n
         FROM top GROUP BY lv, i // 3),
fold AS (
  SELECT p.tree, p.doc_id, p.h AS leaf, 0 AS part, 0 AS lv, p.i, coalesce(p.changed, p.h) AS cur,
         '' AS proof FROM place p
  UNION ALL
  SELECT f.tree, f.doc_id, f.leaf, s.part, s.lv, s.i, s.cur, s.proof
  FROM fold f LEFT JOIN low ON f.part = 0 AND low.tree = f.tree AND low.lv = f.lv
       AND low.run = f.i // 3
  LEFT JOIN rank ON f.part = 0 AND rank.tree = f.tree
  LEFT JOIN high ON f.part = 1 AND high.lv = f.lv AND high.run = f.i // 3,
  LATERAL (
    SELECT 0 AS part, f.lv + 1 AS lv, f.i // 3 AS i,
      sha256(array_to_string(low.hs[:f.i % 3] || [f.cur] || low.hs[f.i % 3 + 2:], '')) AS cur,
      f.proof || array_to_string(low.hs[:f.i % 3] || low.hs[f.i % 3 + 2:], '') AS proof
    WHERE f.part = 0 AND low.n > 1
    UNION ALL SELECT 1, 0, rank.i, f.cur, f.proof WHERE f.part = 0 AND low.n = 1
    UNION ALL SELECT 1, f.lv + 1, f.i // 3,
      sha256(array_to_string(high.hs[:f.i % 3] || [f.cur] || high.hs[f.i % 3 + 2:], '')),
      f.proof || array_to_string(high.hs[:f.i % 3] || high.hs[f.i % 3 + 2:], '')
    WHERE f.part = 1 AND high.n > 1
    UNION ALL SELECT 2, 0, 0, f.cur, f.proof WHERE f.part = 1 AND high.n = 1) s)
SELECT f.doc_id, f.leaf, sub.h AS subroot, root, sha256(proof) AS proof_sha256,
       cur AS folded_root, cur = root AS verified
FROM fold f JOIN sub ON sub.tree = f.tree, root WHERE f.part = 2
"""


def _op13() -> str:
    """Three rounds and the last assignment, spelled out."""
    sql = ["""
WITH v AS (
  SELECT row_number() OVER () AS r, vec_id,
         list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS x
  FROM embeddings WHERE len(embedding) = 64
  AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
c0 AS (
  SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), x) - 1 AS c, x FROM v
  WHERE vec_id IS NOT NULL ORDER BY c LIMIT 16)"""]
    for n in range(4):
        sql.append(f"""
a{n} AS (
  SELECT r, d[1] AS distance, d[2] AS c FROM (
    SELECT r, min([list_sum(list_transform(list_zip(v.x, c.x),
             lambda z: (z[1] - z[2]) * (z[1] - z[2]))), c.c]) AS d
    FROM v, c{n} c GROUP BY r))""")
        if n < 3:
            sql.append(f"""
s{n} AS (
  SELECT c, d, sum(x) AS s, count(*) AS k FROM (
    SELECT a.c, unnest(v.x) AS x, unnest(range(64)) AS d FROM v JOIN a{n} a USING (r))
  GROUP BY c, d),
c{n + 1} AS (
  SELECT c.c, coalesce(m.x, c.x) AS x FROM c{n} c LEFT JOIN (
    SELECT c, list(CAST((s - ((s % k) + k) % k) // k AS BIGINT) ORDER BY d) AS x
    FROM s{n} GROUP BY c) m ON m.c = c.c)""")
    return ",".join(sql) + """
SELECT v.vec_id, CAST(a.c AS INTEGER) AS cluster, CAST(a.distance AS BIGINT) AS distance,
       CAST(sum(a.distance) OVER (PARTITION BY a.c) AS BIGINT) AS cluster_inertia,
       CAST(sum(a.distance) OVER () AS BIGINT) AS inertia,
       sha256(array_to_string(c.x, ',')) AS centroid_sha256
FROM v JOIN a3 a USING (r) JOIN c3 c ON c.c = a.c
"""


ORACLES = {"op1_ngram_jaccard_join": OP1, "op7_substring_dedup": OP7,
           "op12_merkle_manifest": OP12, "op13_centroid_clustering": _op13()}
