"""DuckDB SQL for the queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
KEPT = """SELECT vec_id, label, list_transform(embedding, lambda x: CAST(floor({scale} * CAST(x AS DOUBLE)) AS BIGINT)) AS q FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0"""
WORDS = "list_filter(regexp_split_to_array({}, '[\\x20\\x09-\\x0D]+'), lambda x: x <> '')"


def vector_codes() -> str:
    """The rounds written out: a<i> assigns all parts to the entries e<i>, whose means are e<i + 1>."""
    rounds = ""
    for i in range(7):
        rounds += f"""
a{i} AS MATERIALIZED (SELECT r, p, v, min({{'d': d, 'e': e}}) AS best FROM (
  SELECT r, parts.p, v, e, CAST(list_sum(list_transform(list_zip(v, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS BIGINT) AS d FROM parts JOIN e{i} ON parts.p = e{i}.p) GROUP BY r, p, v),"""
        if i < 6:
            rounds += f"""
s{i} AS (SELECT p, best.e AS e, j, sum(v[j]) AS s, count(*) AS n FROM (SELECT p, v, best, unnest(range(1, len(v) + 1)) AS j FROM a{i}) GROUP BY ALL),
m{i} AS (SELECT p, e, list(CAST((s - (s % n + n) % n) // n AS BIGINT) ORDER BY j) AS c FROM s{i} GROUP BY p, e),
e{i + 1} AS MATERIALIZED (SELECT o.p, o.e, coalesce(m.c, o.c) AS c FROM e{i} o LEFT JOIN m{i} m ON o.p = m.p AND o.e = m.e),"""
    return f"""
WITH kept AS MATERIALIZED (SELECT row_number() OVER (ORDER BY vec_id NULLS LAST, q) AS r, vec_id, label, q FROM ({KEPT.format(scale=4096)})),
parts AS MATERIALIZED (SELECT r, p, q[p * len(q) // 8 + 1 : (p + 1) * len(q) // 8] AS v FROM kept, range(8) t(p)),
e0 AS (SELECT p, r - 1 AS e, v AS c FROM parts WHERE r <= 16),{rounds}
codes AS (SELECT r, string_agg(format('{{:02x}}', best.e), '' ORDER BY p) AS code, CAST(sum(best.d) AS BIGINT) AS error FROM a6 GROUP BY r),
books AS (SELECT sha256(string_agg(array_to_string(c, ','), ',' ORDER BY p, e)) AS h FROM e6)
SELECT vec_id, label, code, error, CAST(sum(error) OVER (PARTITION BY label) AS BIGINT) AS label_error, (SELECT h FROM books) AS codebooks_sha256 FROM kept JOIN codes USING (r)
"""


SQL = {
    "op1_ngram_jaccard_join": f"""
WITH RECURSIVE words AS (SELECT doc_id, {WORDS.format(LOWER)} AS w FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN []::VARCHAR[] WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i+4], ' ')) END) AS s FROM words),
flat AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
links AS (
  SELECT a.doc_id AS a, b.doc_id AS b FROM flat a JOIN flat b ON a.g = b.g AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))),
reach AS (SELECT doc_id AS d, doc_id AS r FROM sets UNION SELECT reach.d, links.b FROM reach JOIN links ON reach.r = links.a)
SELECT sets.doc_id, CAST(len(s) AS BIGINT) AS n_shingles, (SELECT min(r) FROM reach WHERE reach.d = sets.doc_id) AS component_id FROM sets
""",
    # Windows of the lines with a word; a window of 20 words or more that has an earlier copy goes. A longer window is the
    # union of windows of up to 20 lines: each line has a word, so 20 lines have 20 words, and parts of copies are copies.
    "op2_line_dedup": """
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS l FROM documents),
numbered AS (SELECT doc_id, unnest(range(1, len(l) + 1)) AS line_no, unnest(l) AS line FROM split),
worded AS (
  SELECT doc_id, line_no, line, row_number() OVER (PARTITION BY doc_id ORDER BY line_no) AS pos,
    len(list_filter(regexp_split_to_array(line, '[\x20\x09-\x0D]+'), lambda x: x <> '')) AS w
  FROM numbered WHERE regexp_matches(line, '[^\x20\x09-\x0D]')),
docs AS (SELECT doc_id, list(md5(line) ORDER BY pos) AS h, list(w ORDER BY pos) AS ws FROM worded GROUP BY doc_id),
levels AS (SELECT doc_id, h, ws, size FROM docs, range(1, 21) t(size) WHERE size <= len(h)),
windows AS (SELECT doc_id, h, ws, size, unnest(range(1, len(h) - size + 2)) AS pos FROM levels),
named AS (SELECT doc_id, pos, size, md5(array_to_string(h[pos:pos+size-1], ' ')) AS name, list_sum(ws[pos:pos+size-1]) AS words FROM windows),
firsts AS (SELECT size AS s, name AS n, min((doc_id, pos)) AS first FROM named GROUP BY ALL),
later AS (SELECT doc_id, pos, size FROM named JOIN firsts ON size = s AND name = n WHERE words >= 20 AND (doc_id, pos) <> first),
gone AS (SELECT DISTINCT w.doc_id, w.line_no FROM worded w JOIN later t ON w.doc_id = t.doc_id AND w.pos >= t.pos AND w.pos < t.pos + t.size),
left_over AS (
  SELECT n.doc_id, coalesce(string_agg(line, chr(10) ORDER BY n.line_no), '') AS text
  FROM numbered n WHERE NOT EXISTS (SELECT 1 FROM gone g WHERE g.doc_id = n.doc_id AND g.line_no = n.line_no) GROUP BY n.doc_id)
SELECT s.doc_id, (SELECT count(*) FROM worded w WHERE w.doc_id = s.doc_id) AS n_lines,
  (SELECT count(*) FROM gone g WHERE g.doc_id = s.doc_id) AS n_removed,
  CAST(length(coalesce(text, '')) AS BIGINT) AS n_chars_left, md5(coalesce(text, '')) AS text_md5
FROM split s LEFT JOIN left_over o ON o.doc_id = s.doc_id
""",
    "op11_vector_codes": vector_codes(),
    "op13_hard_negatives": f"""
WITH kept AS (SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (CAST(label AS BIGINT) + 1) % 10 ELSE label END AS label, q FROM ({KEPT.format(scale=256)}) WHERE vec_id IS NOT NULL AND label IS NOT NULL),
pairs AS MATERIALIZED (SELECT a.vec_id AS anchor_id, c.vec_id AS id, a.label = c.label AS same, CAST(list_sum(list_transform(list_zip(a.q, c.q), lambda z: z[1] * z[2])) AS BIGINT) AS score
  FROM kept a JOIN kept c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positives AS (SELECT * FROM pairs WHERE same QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) <= 5)
SELECT p.anchor_id, p.id AS positive_id, CAST(row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) AS INTEGER) AS rank, n.id AS negative_id, p.score AS positive_score, n.score AS negative_score
FROM positives p JOIN pairs n ON p.anchor_id = n.anchor_id AND NOT n.same AND 30 * p.score <= 100 * n.score AND 100 * n.score <= 90 * p.score
QUALIFY row_number() OVER (PARTITION BY p.anchor_id, p.id ORDER BY n.score DESC, n.id) <= 10
""",
    "op12_substring_dedup": f"""
WITH words AS (SELECT doc_id, {WORDS.format("coalesce(text, '')")} AS w FROM documents),
windows AS (SELECT doc_id, unnest(range(1, len(w) - 33)) AS pos, w FROM words),
named AS (SELECT doc_id, pos, md5(array_to_string(w[pos:pos + 34], ' ')) AS name FROM windows),
repeated AS (SELECT doc_id, pos FROM named QUALIFY count(*) OVER (PARTITION BY name) > 1),
gone AS (SELECT DISTINCT doc_id, pos + k AS pos FROM repeated, range(35) t(k)),
each AS (SELECT doc_id, unnest(range(1, len(w) + 1)) AS pos, unnest(w) AS word FROM words),
kept AS (SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY pos) AS text FROM each ANTI JOIN gone USING (doc_id, pos) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256 FROM words LEFT JOIN kept USING (doc_id)
""",
}
