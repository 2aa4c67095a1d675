"""DuckDB SQL of the queries that SQL can express, over the raw tables."""

from __future__ import annotations

OP2 = r"""
WITH d AS (
  SELECT doc_id, source, CAST(coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0) AS BIGINT) AS size,
         md5('2020:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS digest
  FROM documents),
s AS (
  SELECT source, CAST(sum(size) AS DOUBLE) AS source_size,
         CAST([3, 1, 2][(row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1] AS DOUBLE) AS w
  FROM d GROUP BY source),
l AS (
  SELECT *, (sum(source_size) OVER () * 1.5::DOUBLE - coalesce(sum(2 * source_size) OVER b, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level,
         row_number() OVER (ORDER BY 2 * source_size / w, source NULLS LAST) AS place
  FROM s WINDOW b AS (ORDER BY 2 * source_size / w, source NULLS LAST
                      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (
  SELECT source, source_size, w, CASE w WHEN 3 THEN -0.5::DOUBLE WHEN 1 THEN 0.5::DOUBLE ELSE 0::DOUBLE END AS slope,
         CASE WHEN place < coalesce((SELECT min(place) FROM l WHERE 2 * source_size > level * w), place + 1)
              THEN 2 * source_size
              ELSE w * (SELECT arg_min(level, place) FROM l WHERE 2 * source_size > level * w) END AS target
  FROM l),
c AS (
  SELECT d.doc_id, d.size, t.source_size, t.w, t.slope, t.target,
         coalesce(sum(d.size) OVER (PARTITION BY d.source ORDER BY digest, doc_id NULLS FIRST, size
                                    ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM d JOIN t ON d.source IS NOT DISTINCT FROM t.source),
p AS (
  SELECT *, greatest(least(floor(target) - before, size), 0) AS part0,
         greatest(least(floor(target) - before - source_size, size), 0) AS part1,
         before / target * w AS a0, (source_size + before) / target * w AS a1,
         w * (1 - slope) AS w0, w * (1 + slope) - w * (1 - slope) AS m
  FROM c)
SELECT doc_id, size, CAST(source_size AS BIGINT) AS source_size, target, CAST(part0 + part1 AS BIGINT) AS taken,
       CASE WHEN part0 > 0 THEN round(CASE WHEN a0 > 0 THEN 2 * a0 / (w0 + sqrt(greatest(w0 * w0 + 2 * m * a0, 0))) ELSE 0 END, 9) END AS position,
       CASE WHEN part1 > 0 THEN round(CASE WHEN a1 > 0 THEN 2 * a1 / (w0 + sqrt(greatest(w0 * w0 + 2 * m * a1, 0))) ELSE 0 END, 9) END AS repeat_position
FROM p
"""

OP4 = r"""
WITH v AS (
  SELECT DISTINCT vec_id, list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS x
  FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT q.vec_id AS query_id, c.vec_id, CAST(list_dot_product(q.x, c.x) AS BIGINT) AS score
  FROM v q JOIN v c ON q.vec_id != c.vec_id
  WHERE q.vec_id % 50 = 0),
r AS (
  SELECT query_id, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank, vec_id, score FROM s)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

OP3 = r"""
WITH d AS (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents),
n AS (SELECT doc_id, unnest(range(len(l))) AS place, unnest(l) AS line FROM d WHERE l IS NOT NULL),
k AS (
  SELECT doc_id, place, s, len(regexp_extract_all(s, '[^\x20\x09-\x0D]+')) AS w,
         row_number() OVER (PARTITION BY doc_id ORDER BY place) AS i
  FROM (SELECT doc_id, place, trim(line, e' \t\n\r\x0b\x0c') AS s FROM n) WHERE s <> ''),
-- runs of 50 words or 3 lines, of at most 3 lines: longer ones consist of them
w AS (
  SELECT doc_id, i, place, w, s, lead(place, 1) OVER o AS p1, lead(s, 1) OVER o AS s1, lead(w, 1) OVER o AS w1,
         lead(place, 2) OVER o AS p2, lead(s, 2) OVER o AS s2
  FROM k WINDOW o AS (PARTITION BY doc_id ORDER BY i)),
b AS (
  SELECT doc_id, i, [place] AS places, s AS block FROM w WHERE w >= 50
  UNION ALL SELECT doc_id, i, [place, p1], s || chr(10) || s1 FROM w WHERE w + w1 >= 50
  UNION ALL SELECT doc_id, i, [place, p1, p2], s || chr(10) || s1 || chr(10) || s2 FROM w WHERE s2 IS NOT NULL),
f AS (SELECT *, row_number() OVER (PARTITION BY block ORDER BY doc_id NULLS LAST, i) AS occurrence FROM b),
r AS (SELECT DISTINCT doc_id, unnest(places) AS place FROM f WHERE occurrence > 1),
t AS (
  SELECT n.doc_id, count(r.place) AS gone,
         string_agg(n.line, chr(10) ORDER BY n.place) FILTER (WHERE r.place IS NULL) AS kept
  FROM n LEFT JOIN r ON r.doc_id = n.doc_id AND r.place = n.place GROUP BY n.doc_id)
SELECT d.doc_id, CAST(coalesce(len(d.l), 0) AS BIGINT) AS n_lines, CAST(coalesce(t.gone, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(t.kept, '')) AS kept_sha256
FROM d LEFT JOIN t ON t.doc_id = d.doc_id
"""

OP6 = r"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, hex(encode(coalesce(text, ''))) AS x FROM documents),
w AS (
  SELECT r, p, count(*) OVER (PARTITION BY h) AS c
  FROM (SELECT r, p, md5(x[2 * p + 1:2 * p + 400]) AS h
        FROM (SELECT r, x, unnest(range(len(x) // 2 - 199)) AS p FROM d WHERE len(x) >= 400))),
-- windows that start before or where the one before ends are one span
s AS (SELECT r, p, sum(CASE WHEN p <= q + 200 THEN 0 ELSE 1 END) OVER (PARTITION BY r ORDER BY p) AS span
      FROM (SELECT r, p, coalesce(lag(p) OVER (PARTITION BY r ORDER BY p), -1000) AS q FROM w WHERE c > 1)),
v AS (SELECT r, min(p) AS a, max(p) + 200 AS z FROM s GROUP BY r, span),
g AS (SELECT r, coalesce(lag(z) OVER (PARTITION BY r ORDER BY a), 0) AS a, a AS z FROM v
      UNION ALL SELECT r, max(z), 1000000000 FROM v GROUP BY r),
k AS (SELECT g.r, string_agg(d.x[2 * g.a + 1:2 * g.z], '' ORDER BY g.a) AS kept FROM g JOIN d USING (r) GROUP BY g.r),
c AS (SELECT r, sum(z - a) AS gone, count(*) AS spans FROM v GROUP BY r)
SELECT d.doc_id, CAST(len(d.x) // 2 AS BIGINT) AS n_bytes, CAST(coalesce(c.gone, 0) AS BIGINT) AS n_removed,
       CAST(coalesce(c.spans, 0) AS BIGINT) AS n_spans, sha256(unhex(coalesce(k.kept, d.x))) AS kept_sha256
FROM d LEFT JOIN c USING (r) LEFT JOIN k USING (r)
"""

OP11 = r"""
WITH c AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL SELECT -7, unnest([0, 1]), unnest(['user', 'assistant']), '\### Assistant: </turn> ok'),
e AS (
  SELECT *, length(replace(replace(replace(role, '\', '\\'), '<', '\l'), '>', '\g'))
            + length(text) + length(regexp_replace(text, '[^\\]', '', 'g'))
            + len(regexp_extract_all(text, '</?turn')) + 16 AS chars
  FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn NULLS FIRST, role, text)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (role = 'assistant'), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn NULLS FIRST, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       CAST(sum(chars) AS BIGINT) AS formatted_chars
FROM e GROUP BY conv_id
"""

# The cheapest edits row by row: the least (cost, audit) for each place of the wanted form.
OP12 = r"""
WITH RECURSIVE z AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k
  FROM conversations),
y AS (
  SELECT *, xor(list_reduce(list_prepend(4294967295::BIGINT, list_transform(range(1, length(k) + 1), lambda i: CAST(ascii(substr(k, i, 1)) AS BIGINT))),
      lambda c, b: list_reduce(list_prepend(xor(c, b), range(8)),
                               lambda x, i: CASE WHEN x % 2 = 1 THEN xor(x // 2, 3988292384::BIGINT) ELSE x // 2 END)), 4294967295::BIGINT) % 20 AS kind
  FROM z),
d AS (
  SELECT conv_id, turn, CASE kind WHEN 4 THEN 'user' ELSE role END AS role,
         CASE kind WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE kind WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy
  FROM y),
n AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY i) AS seen, substr(role, 1, 1) AS t
  FROM (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS i FROM d)),
f AS (
  SELECT *, CASE WHEN NOT regexp_matches(text, '[^\x20\x09-\x0D]') THEN 'blank' WHEN seen > 1 THEN 'duplicate'
                 WHEN NOT regexp_matches(text, '[.!?][\x20\x09-\x0D]*$') THEN 'truncated' ELSE '' END AS fault,
         lag(t) OVER (PARTITION BY conv_id ORDER BY i) || t AS two
  FROM n),
step(p, q, t) AS (VALUES ('b', 's', 's'), ('b', 'u', 'u'), ('s', 'u', 'u'), ('f', 'u', 'u'), ('u', 'f', 'a')),
ins(p, q, lines) AS (
  SELECT p, p, [] FROM (VALUES ('b'), ('s'), ('u'), ('f')) x(p)
  UNION ALL SELECT p, q, [CASE t WHEN 'u' THEN 'user:' ELSE 'assistant:' END] FROM step WHERE t != 's'
  UNION ALL SELECT p, 'f', ['user:', 'assistant:'] FROM step WHERE t = 'u' AND p != 'f'),
edit AS (
  SELECT conv_id, i, p, p AS q, 2 AS cost, 'D' AS audit, []::VARCHAR[] AS lines FROM f, (VALUES ('b'), ('s'), ('u'), ('f')) x(p)
  UNION ALL
  SELECT conv_id, i, p, q, CASE WHEN f.t = step.t THEN 0 ELSE 1 END + CASE fault WHEN 'truncated' THEN 5 ELSE 0 END,
         CASE WHEN f.t = step.t THEN 'K' ELSE 'R' END,
         [CASE WHEN f.t = step.t THEN role WHEN step.t = 'u' THEN 'user' ELSE 'assistant' END || ':' || text]
  FROM f JOIN step ON f.t = step.t OR step.t != 's'
  WHERE fault NOT IN ('blank', 'duplicate')),
best(conv_id, i, q, b) AS (
  SELECT conv_id, 0::BIGINT, ins.q, {'cost': 5 * len(lines), 'audit': repeat('I', len(lines)), 'lines': lines::VARCHAR[]}
  FROM (SELECT DISTINCT conv_id FROM f) c, ins WHERE ins.p = 'b'
  UNION ALL
  SELECT e.conv_id, e.i, ins.q, min({'cost': best.b.cost + e.cost + 5 * len(ins.lines), 'audit': best.b.audit || e.audit || repeat('I', len(ins.lines)),
                                     'lines': best.b.lines || e.lines || ins.lines::VARCHAR[]})
  FROM best JOIN edit e ON e.conv_id IS NOT DISTINCT FROM best.conv_id AND e.i = best.i + 1 AND e.p = best.q JOIN ins ON ins.p = e.q
  GROUP BY e.conv_id, e.i, ins.q),
r AS (
  SELECT conv_id, max(turn) - min(turn) + 1 - count(DISTINCT turn) AS gaps, count(*) FILTER (fault = 'blank') AS blank,
         count(*) FILTER (fault = 'duplicate') AS duplicate, count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (two NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n
  FROM f GROUP BY conv_id),
w AS (
  SELECT r.conv_id, min(best.b) AS b FROM r JOIN best ON best.conv_id IS NOT DISTINCT FROM r.conv_id AND best.i = r.n
  WHERE best.q IN ('b', 'f') GROUP BY r.conv_id)
SELECT o.conv_id, CAST(coalesce(gaps, 0) AS BIGINT) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(coalesce(b.cost, 0) AS BIGINT) AS cost,
       coalesce(b.audit, '') AS audit, sha256(coalesce(array_to_string(b.lines, chr(10)), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o
LEFT JOIN r ON r.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN w ON w.conv_id IS NOT DISTINCT FROM o.conv_id
"""

OP13 = r"""
WITH d AS (
  SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
t AS (
  SELECT r, lang, source, translate(term, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS term
  FROM (SELECT r, lang, source, unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d)),
k AS (SELECT lang, term FROM t GROUP BY lang, term HAVING count(DISTINCT r) >= 3),
v AS (SELECT lang, count(*) AS v FROM k GROUP BY lang),
g AS (SELECT DISTINCT lang, source FROM d),
c AS (
  SELECT g.lang, g.source, k.term, coalesce(x.n, 0)::HUGEINT AS n
  FROM g JOIN k USING (lang) LEFT JOIN (SELECT lang, source, term, count(*) AS n FROM t GROUP BY ALL) x USING (lang, source, term)),
p AS (
  SELECT lang, source, term, n, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang, source) + v.v)::HUGEINT AS p
  FROM c JOIN v USING (lang)),
l AS (
  SELECT lang, term, 1 + 1000000000::HUGEINT * (n + 1) // (sum(n) OVER (PARTITION BY lang) + v.v)::HUGEINT AS q
  FROM (SELECT lang, term, sum(n) AS n FROM c GROUP BY lang, term) JOIN v USING (lang)),
pair AS (
  SELECT a.lang, a.source, b.source AS item, CAST(coalesce(s.value, 0) AS BIGINT) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source != b.source
  LEFT JOIN (SELECT x.lang, x.source, y.source AS item, sum((x.p - y.p) * (x.p - y.p) // y.p) AS value
             FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source != y.source GROUP BY ALL) s
    ON s.lang = a.lang AND s.source = a.source AND s.item = b.source),
term AS (
  SELECT p.lang, p.source, p.term AS item, CAST((p - q) * (p - q) // q AS BIGINT) AS value
  FROM p JOIN l ON p.lang = l.lang AND p.term = l.term WHERE n > 0 AND p > q),
u AS (SELECT lang, source, 'pair' AS part, item, value FROM pair UNION ALL SELECT lang, source, 'term', item, value FROM term)
SELECT * FROM (
  SELECT *, CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS INTEGER) AS rank FROM u)
WHERE part = 'pair' OR rank <= 200
"""

ORACLE = {"op2_source_mix": OP2, "op3_line_dedup": OP3, "op4_exact_topk": OP4, "op6_suffix_dedup": OP6,
          "op11_chat_format": OP11, "op12_structure_repair": OP12, "op13_source_divergence": OP13}
