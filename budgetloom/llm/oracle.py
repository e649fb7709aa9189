"""SQL for those queries of the operators that SQL can express on whole tables."""

from __future__ import annotations

_SHINGLES = """words AS (SELECT doc_id, min(split) AS split, any_value(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS w FROM pool WHERE text IS NOT NULL GROUP BY doc_id),
long AS (SELECT * FROM words WHERE len(w) >= 20),
s AS (SELECT DISTINCT doc_id, hash(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM (SELECT doc_id, w, unnest(range(1, len(w) - 1)) AS i FROM long)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
df AS (SELECT g, count(*) AS d FROM s GROUP BY g),
ranked AS (SELECT s.doc_id, s.g, row_number() OVER (PARTITION BY s.doc_id ORDER BY d, s.g) AS k FROM s JOIN df ON s.g = df.g),
prefix AS (SELECT r.doc_id, g FROM ranked r JOIN size z ON r.doc_id = z.doc_id WHERE k <= n - ceil(0.7 * n) + 1),
cand AS (SELECT DISTINCT a.doc_id AS a, b.doc_id AS b FROM prefix a JOIN prefix b ON a.g = b.g AND a.doc_id < b.doc_id),
both_ AS (SELECT a, b, count(*) AS m FROM cand JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b AND y.g = x.g GROUP BY a, b),
links AS (SELECT a, b FROM both_ JOIN size x ON x.doc_id = a JOIN size y ON y.doc_id = b WHERE m >= 0.7 * (x.n + y.n - m))"""

_CONTAINED = """words AS (SELECT doc_id, min(split) AS split, any_value(regexp_extract_all(lower(text), '[\\p{L}\\p{N}]+')) AS w FROM pool WHERE text IS NOT NULL AND split IN ('train', 'valid', 'test') GROUP BY doc_id),
s AS (SELECT DISTINCT doc_id, split = 'train' AS t, hash(w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) AS g FROM (SELECT doc_id, split, w, unnest(range(1, len(w) - 1)) AS i FROM words WHERE len(w) >= 20)),
size AS (SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id),
met AS (SELECT e.doc_id AS eval_id, t.doc_id AS train_id, count(*) AS m FROM s e JOIN s t ON e.g = t.g AND NOT e.t AND t.t GROUP BY ALL),
inside AS (SELECT eval_id, train_id, m, x.n AS ne, y.n AS nt FROM met JOIN size x ON x.doc_id = eval_id JOIN size y ON y.doc_id = train_id WHERE m / x.n >= 0.7)"""

SQL = {
    "p1_found": """WITH u AS (SELECT doc_id, min(t.topic) AS topic, min(tok) AS tok FROM pool p JOIN topic_targets t ON lower(regexp_replace(p.topic, '^\\s+|\\s+$', '', 'g')) = lower(trim(t.topic)) WHERE tok > 0 GROUP BY doc_id),
by_topic AS (SELECT topic, sum(tok) AS s, count(*) AS n FROM u GROUP BY topic)
SELECT t.topic FROM topic_targets t LEFT JOIN by_topic x ON x.topic = t.topic WHERE coalesce(x.s, 0) < t.target_share * (SELECT sum(tok) FROM u) / 5 OR coalesce(x.n, 0) < t.min_docs""",
    "p2_found": f"""WITH {_SHINGLES}
SELECT l.a AS doc_id_a, l.b AS doc_id_b FROM links l JOIN long x ON x.doc_id = l.a JOIN long y ON y.doc_id = l.b WHERE (x.split = 'train' AND y.split IN ('valid', 'test')) OR (y.split = 'train' AND x.split IN ('valid', 'test'))""",
    "p3_found": f"""WITH RECURSIVE {_SHINGLES},
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a)
SELECT DISTINCT a AS doc_id_a, b AS doc_id_b FROM reach WHERE a < b""",
    "p3_groups": f"""WITH RECURSIVE {_SHINGLES},
sets AS (SELECT doc_id, list_sort(list(g)) AS g FROM s GROUP BY doc_id),
classes AS (SELECT doc_id, min(doc_id) OVER (PARTITION BY g) AS class_id FROM sets),
both_ways AS (SELECT a, b FROM links UNION SELECT b, a FROM links),
reach AS (SELECT a, b FROM both_ways UNION SELECT r.a, w.b FROM reach r JOIN both_ways w ON r.b = w.a)
SELECT c.doc_id, class_id, least(c.doc_id, coalesce(m, c.doc_id)) AS group_id FROM classes c LEFT JOIN (SELECT a, min(b) AS m FROM reach GROUP BY a) r ON r.a = c.doc_id""",
    "p2_containment": f"""WITH {_CONTAINED}
SELECT eval_id, train_id, round(m / ne, 6) AS containment, round(m / (ne + nt - m), 6) AS likeness FROM inside""",
    "p2_report": f"""WITH {_CONTAINED}
SELECT r.split, r.source, count(*) AS n_records, count(n) AS n_found, count(CASE WHEN best >= 1 THEN 1 END) AS n_copies, CAST(coalesce(sum(n), 0) AS BIGINT) AS n_pairs
FROM (SELECT doc_id, min(split) AS split, coalesce(min(source), '(none)') AS source FROM pool WHERE split IN ('valid', 'test') GROUP BY doc_id) r
LEFT JOIN (SELECT eval_id, count(*) AS n, max(m / (ne + nt - m)) AS best FROM inside GROUP BY eval_id) f ON f.eval_id = r.doc_id GROUP BY r.split, r.source""",
    "p6_found": """WITH words AS (SELECT rewrite_id, any_value(regexp_extract_all(lower(rewritten), '[\\p{L}\\p{N}]+')) AS w FROM rewritten WHERE rewritten IS NOT NULL GROUP BY rewrite_id),
grams AS (SELECT rewrite_id, i, array_to_string(w[i:i + 5], ' ') AS g FROM (SELECT rewrite_id, w, unnest(range(1, len(w) - 4)) AS i FROM words WHERE len(w) >= 6)),
later AS (SELECT rewrite_id, i FROM (SELECT rewrite_id, i, row_number() OVER (PARTITION BY rewrite_id, g ORDER BY i) AS k FROM grams) WHERE k > 1),
covered AS (SELECT DISTINCT rewrite_id, i + o AS place FROM later, range(0, 6) t(o))
SELECT rewrite_id FROM (SELECT c.rewrite_id, count(*) AS n, any_value(len(w)) AS total FROM covered c JOIN words x ON x.rewrite_id = c.rewrite_id GROUP BY c.rewrite_id) WHERE n >= 0.3 * total""",
}
