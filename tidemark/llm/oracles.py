"""DuckDB SQL of the training-data queries whose whole result SQL can state."""

from __future__ import annotations

OP11 = r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, 0, 'user', '<|im_end|><|im_start|>assistant ok'
           UNION ALL SELECT -1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok'),
t AS (SELECT *, role = 'assistant' AS reply, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text) AS k,
             -- start mark, role, line end, text, end mark, line end
             12 + length(regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\\\1|', 'g')) + 1
             + length(regexp_replace(text, '<(\\*)\|', '<\\\1|', 'g')) + 10 + 1 AS chars
      FROM c),
e AS (SELECT *, count(*) FILTER (reply) OVER (PARTITION BY conv_id ORDER BY k DESC) AS replies_from_here,
             last_value(reply) OVER (PARTITION BY conv_id ORDER BY k ROWS BETWEEN UNBOUNDED PRECEDING AND UNBOUNDED FOLLOWING) AS ends_in_reply
      FROM t)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY k)) AS turns_sha256,
       CAST(coalesce(sum(length(text)) FILTER (reply), 0) AS BIGINT) AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY k) FILTER (reply), '')) AS loss_sha256,
       CAST(sum(chars * (replies_from_here + CASE WHEN ends_in_reply THEN 0 ELSE 1 END)) AS BIGINT) AS formatted_chars,
       count(*) FILTER (reply) + CASE WHEN bool_and(ends_in_reply) THEN 0 ELSE 1 END AS n_examples
FROM e GROUP BY conv_id
"""

OP12 = r"""
WITH d AS (SELECT row_number() OVER () AS k, coalesce(lang, '') AS lang, coalesce(source, '') AS source, coalesce(text, '') AS text FROM documents),
w AS (SELECT k, lang, source, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                        '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
kept AS (SELECT lang, term FROM w GROUP BY ALL HAVING count(DISTINCT k) >= 10),
v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
grp AS (SELECT g.lang, g.source, coalesce(v.v, 0) AS v FROM (SELECT DISTINCT lang, source FROM d) g LEFT JOIN v USING (lang)),
cnt AS (SELECT lang, source, term, count(*) AS c FROM w SEMI JOIN kept USING (lang, term) GROUP BY ALL),
tot AS (SELECT g.lang, g.source, g.v, coalesce(sum(c.c), 0) AS n FROM grp g LEFT JOIN cnt c USING (lang, source) GROUP BY ALL),
p AS (SELECT t.lang, t.source, k.term, coalesce(c.c, 0) AS c, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (t.n + 2 * t.v) AS p
      FROM tot t JOIN kept k USING (lang) LEFT JOIN cnt c USING (lang, source, term)),
q AS (SELECT k.lang, k.term, 1 + (1000000000::HUGEINT * (coalesce(c.c, 0) + 2)) // (a.n + 2 * v.v) AS q
      FROM kept k JOIN v USING (lang) JOIN (SELECT lang, sum(n) AS n FROM tot GROUP BY lang) a USING (lang)
      LEFT JOIN (SELECT lang, term, sum(c) AS c FROM cnt GROUP BY ALL) c USING (lang, term)),
pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
         FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
pairs AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(x.value, 0) AS value
          FROM grp a JOIN grp b ON a.lang = b.lang AND a.source <> b.source
          LEFT JOIN pair x ON x.lang = a.lang AND x.source = a.source AND x.item = b.source),
term AS (SELECT lang, source, 'term' AS part, term AS item, (p - q) * (p - q) // (p + q) AS value FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q),
ranked AS (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS rank
           FROM (SELECT * FROM pairs UNION ALL SELECT * FROM term))
SELECT lang, source, part, item, CAST(value AS BIGINT) AS value, CAST(rank AS INTEGER) AS rank FROM ranked WHERE part = 'pair' OR rank <= 10
"""

OP13 = """
WITH e AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
                  list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
           FROM embeddings
           WHERE label IS NOT NULL AND embedding IS NOT NULL
             AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT a.vec_id AS anchor_id, b.vec_id, a.label = b.label AS same,
             CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda z: z[1] * z[2])) AS BIGINT) AS score
      FROM e a JOIN e b ON a.vec_id % 100 = 0 AND a.vec_id <> b.vec_id),
pos AS (SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM s WHERE same
        QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= 5),
neg AS (SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
               row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id) AS rank
        FROM pos p JOIN s ON s.anchor_id = p.anchor_id AND NOT s.same
        WHERE 30 * p.positive_score <= 100 * s.score AND 100 * s.score <= 90 * p.positive_score)
SELECT anchor_id, positive_id, CAST(rank AS INTEGER) AS rank, negative_id, positive_score, negative_score FROM neg WHERE rank <= 10
"""
