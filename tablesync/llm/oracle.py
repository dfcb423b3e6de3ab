"""DuckDB SQL for the registered operators that SQL can express."""

from __future__ import annotations

OP4 = r"""
WITH n AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS norm
  FROM documents
), g AS (
  SELECT norm, count(*) AS group_size, arg_max(doc_id, {'n': length(t), 'i': -doc_id}) AS keep_id
  FROM n GROUP BY norm
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AS kept, sha256(norm) AS text_sha256
FROM n JOIN g USING (norm)
"""

# Spans from the matches: they are found one after another, so the texts between them give their places.
OP5_KIND = r"""
{kind}_m AS (
  SELECT doc_id, i, len(hit) AS n, {judged} AS judged,
    sum(len(before) + len(hit)) OVER (PARTITION BY doc_id ORDER BY i) AS stop
  FROM (
    SELECT doc_id, unnest(range(1, len(hits) + 1)) AS i, unnest(hits) AS hit, unnest(judged) AS part,
      unnest(parts[:len(hits)]) AS before
    FROM (
      SELECT doc_id, regexp_extract_all(t, '{pattern}') AS hits, regexp_extract_all(t, '{pattern}', {group}) AS judged,
        regexp_split_to_array(t, '{pattern}') AS parts
      FROM d
    )
  )
), {kind}_s AS (
  SELECT doc_id, '{kind}' AS kind, {order} AS ord, stop - n AS start, stop FROM {kind}_m WHERE judged >= {least}
)"""


def _op5() -> str:
    # The patterns of the contract, with quotes doubled for SQL.
    assign = r"""(?i:(?:password|passwd|secret|token|api_?key))["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)"""
    kinds = [("assign", assign, 1, 8), ("access", r"AKIA[A-Z0-9]+", 0, 16), ("hex", r"[0-9a-f]+", 0, 32)]
    parts = [
        OP5_KIND.format(kind=k, pattern=p, group=g, least=n, order=i, judged="len(part)")
        for i, (k, p, g, n) in enumerate(kinds)
    ]
    return (
        "WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents),"
        + ",".join(parts)
        + r""",
s AS (SELECT * FROM assign_s UNION ALL SELECT * FROM access_s UNION ALL SELECT * FROM hex_s),
g AS (
  SELECT doc_id, count(*) FILTER (kind = 'assign') AS a, count(*) FILTER (kind = 'access') AS c,
    count(*) FILTER (kind = 'hex') AS h,
    string_agg(kind || ':' || CAST(start AS VARCHAR) || ':' || CAST(stop AS VARCHAR), ',' ORDER BY start, ord) AS spans
  FROM s GROUP BY doc_id
)
SELECT d.doc_id, coalesce(a, 0) AS n_assign, coalesce(c, 0) AS n_access, coalesce(h, 0) AS n_hex,
  sha256(coalesce(spans, '')) AS base_sha256, coalesce(spans, '') AS spans
FROM d LEFT JOIN g ON d.doc_id = g.doc_id
"""
    )


OP7 = r"""
WITH l AS (
  SELECT doc_id, unnest(string_split(t, chr(10))) AS line, unnest(range(len(string_split(t, chr(10))))) AS pos
  FROM (SELECT doc_id, coalesce(text, '') AS t FROM documents)
), k AS (
  SELECT doc_id, pos, line,
    translate(regexp_replace(regexp_replace(line, '^[\x20\x09-\x0D]+', ''), '[\x20\x09-\x0D]+$', ''),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key
  FROM l
), s AS (
  SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3
), m AS (
  SELECT k.doc_id, pos, line, s.key IS NOT NULL AND k.doc_id <> keeper AS gone FROM k LEFT JOIN s ON k.key = s.key
)
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT gone), '')) AS kept_sha256
FROM m GROUP BY doc_id
"""

OP8 = """
WITH v AS (
  SELECT vec_id, [CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), c AS (
  SELECT vec_id, unnest(v) AS x, unnest(range(len(v))) AS i FROM v
), s AS (
  SELECT a.vec_id AS query_id, b.vec_id, CAST(sum(a.x * b.x) AS BIGINT) AS score
  FROM c a JOIN c b ON a.i = b.i AND a.vec_id <> b.vec_id WHERE a.vec_id % 50 = 0 GROUP BY ALL
  UNION ALL SELECT a.vec_id, b.vec_id, 0 FROM v a JOIN v b ON len(a.v) = len(b.v) AND len(a.v) = 0 AND a.vec_id <> b.vec_id
  WHERE a.vec_id % 50 = 0
), r AS (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM r WHERE rank <= 5
"""

# All pairs of documents with a common shingle are counted, which is for small tables.
OP9 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
    '[^\x20\x09-\x0D]+') AS ws FROM documents
), s AS MATERIALIZED (
  SELECT DISTINCT doc_id, hash(shingle) AS h, shingle FROM (
    SELECT doc_id, unnest(CASE WHEN len(ws) = 1 THEN ws ELSE [ws[i] || ' ' || ws[i + 1] FOR i IN range(1, len(ws))] END) AS shingle
    FROM w
  )
), n AS (
  SELECT w.doc_id, count(s.doc_id) AS n FROM w LEFT JOIN s ON s.doc_id = w.doc_id GROUP BY w.doc_id
), p AS (
  SELECT a.doc_id AS x, b.doc_id AS y, count(*) AS c FROM s a JOIN s b ON a.h = b.h AND a.shingle = b.shingle AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id
), e AS MATERIALIZED (
  SELECT x, y FROM p JOIN n nx ON nx.doc_id = x JOIN n ny ON ny.doc_id = y WHERE 100 * c >= 80 * (nx.n + ny.n - c)
), r AS (
  SELECT doc_id AS a, doc_id AS b FROM n
  UNION SELECT r.a, f.y FROM r JOIN (SELECT x, y FROM e UNION ALL SELECT y, x FROM e) f ON r.b = f.x
), g AS (
  SELECT a AS doc_id, min(b) AS component_id FROM r GROUP BY a
)
SELECT n.doc_id, n.n AS n_shingles, component_id, n.doc_id = component_id AS kept FROM n JOIN g ON g.doc_id = n.doc_id
"""

# Schedules and weights are those of the operator, for the sources by turns. Equal rows are interchangeable.
OP10 = r"""
WITH d AS (
  SELECT doc_id, source IS NULL AS none, coalesce(source, '') AS source,
    CAST(len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')) AS BIGINT) AS size,
    CAST('0x' || substr(md5(concat(coalesce(CAST(doc_id AS VARCHAR), ''), ':', coalesce(text, ''))), 1, 15) AS BIGINT) AS place
  FROM documents
), s AS (
  SELECT none, source, CAST(sum(size) AS BIGINT) AS source_size, row_number() OVER (ORDER BY none, source) - 1 AS turn
  FROM d GROUP BY none, source
), w AS (
  SELECT *, [5.0::DOUBLE, 2, 1][turn % 3 + 1] AS weight, 2.0::DOUBLE * source_size AS cap,
    [1.5::DOUBLE, 1.0, 0.5][turn % 3 + 1] AS a, [0.5::DOUBLE, 1.0, 1.5][turn % 3 + 1] AS b FROM s
), f AS (
  SELECT *, (1.5::DOUBLE * sum(source_size) OVER () -
      coalesce(sum(cap) OVER (ORDER BY cap / weight, turn ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)) /
    sum(weight) OVER (ORDER BY cap / weight, turn ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS level
  FROM w
), l AS (
  SELECT arg_min(level, {'q': cap / weight, 't': turn}) FILTER (cap > 0 AND level <= cap / weight) AS level FROM f
), t AS (
  SELECT f.* EXCLUDE (level), least(cap, coalesce(l.level * weight, cap)) AS target FROM f, l
), p AS (
  SELECT d.doc_id, d.size, t.source_size, t.target, t.a, t.b,
    coalesce(sum(d.size) OVER (PARTITION BY d.none, d.source ORDER BY d.place, d.doc_id NULLS FIRST, d.size
      ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS pos
  FROM d JOIN t ON d.none = t.none AND d.source = t.source
), u AS (
  SELECT *, greatest(0, least(size, floor(target) - pos)) AS one, greatest(0, least(size, floor(target) - pos - source_size)) AS two,
    CASE WHEN target > 0 THEN least(1.0::DOUBLE, CAST(pos AS DOUBLE) / target) END AS share
  FROM p
)
SELECT doc_id, size, source_size, target, CAST(one + two AS BIGINT) AS taken,
  CASE WHEN one > 0 THEN 2 * share / (a + sqrt(a * a + 2 * (b - a) * share)) END AS first_time
FROM u
"""

# The CRC-32 of a list of bytes, by a table of 256 remainders; op11 and op12 choose by it.
CRC = """crc AS MATERIALIZED (
  SELECT list(list_reduce(range(8), lambda c, i: CASE WHEN c & 1 = 1 THEN xor(c >> 1, 3988292384) ELSE c >> 1 END, b) ORDER BY b) AS t
  FROM (SELECT unnest(range(256)) AS b)
)"""
CRC_OF = "xor(list_reduce({data}, lambda c, b: xor(c >> 8, t[xor(c & 255, b) + 1]), 4294967295::BIGINT), 4294967295)"
BYTES_OF = (
    "flatten(list_transform(string_split({text}, ''), lambda c: CASE WHEN c = '' THEN []::BIGINT[] "
    "WHEN unicode(c) < 128 THEN [unicode(c)::BIGINT] ELSE [195::BIGINT, unicode(c)::BIGINT - 64] END))"
)

OP11 = f"""
WITH {CRC}, r AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST,
      sha256(concat(CAST(length(coalesce(role, '')) AS VARCHAR), ':', coalesce(role, ''), coalesce(text, '')))) AS pos,
    {{'r': coalesce(role, ''), 't': coalesce(text, '')}} AS u
  FROM conversations WHERE conv_id IS NOT NULL
), c AS (
  SELECT conv_id, list(u ORDER BY pos) AS own FROM r GROUP BY conv_id
), h AS (
  SELECT conv_id, own, {CRC_OF.format(data=BYTES_OF.format(text="CAST(conv_id AS VARCHAR)"))} % 6 AS h FROM c, crc
), n AS (
  SELECT h.conv_id, list_concat(coalesce(b.own[:h], []), h.own[h + 1:]) AS turns
  FROM h LEFT JOIN c b ON b.conv_id = h.conv_id - h.conv_id % 100
), m AS (
  SELECT conv_id, d AS depth, turns[:d] AS prefix, d = len(turns) AS ends
  FROM (SELECT conv_id, turns, unnest(range(len(turns) + 1)) AS d FROM n)
), g AS (
  SELECT prefix, depth, min(conv_id) AS conv_id, count(*) AS n_convs,
    sha256(coalesce(string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (ends), '')) AS ends_sha256,
    CASE WHEN depth > 0 THEN (count(*) - 1) * length(prefix[depth].t) ELSE 0 END AS own
  FROM m GROUP BY prefix, depth
), k AS (
  SELECT prefix[:depth - 1] AS prefix, depth - 1 AS depth, count(*) AS n_children FROM g WHERE depth > 0 GROUP BY ALL
), f AS (
  SELECT g.*, coalesce(n_children, 0) AS n_children FROM g LEFT JOIN k USING (prefix, depth)
), s AS (
  SELECT prefix[:d] AS prefix, d AS depth, count(*) FILTER (n_children = 0) AS n_leaves, sum(own) AS saved_tokens
  FROM (SELECT prefix, depth, own, n_children, unnest(range(depth + 1)) AS d FROM f) GROUP BY ALL
)
SELECT f.conv_id, f.depth, p.conv_id AS parent_conv_id, f.n_convs, f.n_children, s.n_leaves,
  CAST(s.saved_tokens AS BIGINT) AS saved_tokens, f.ends_sha256
FROM f JOIN s USING (prefix, depth) LEFT JOIN g p ON f.depth > 0 AND p.depth = f.depth - 1 AND p.prefix = f.prefix[:f.depth - 1]
"""

OP12 = f"""
WITH RECURSIVE {CRC}, r AS (
  SELECT doc_id, run, count(*) AS times FROM (
    SELECT doc_id, translate(unnest(regexp_extract_all(text, '[A-Za-z\u00C0-\u00FF]+')),
      'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS run
    FROM documents
  ) GROUP BY ALL
), h AS (
  SELECT run, times, {CRC_OF.format(data=BYTES_OF.format(text="concat(CAST(doc_id AS VARCHAR), ':', run)"))} AS h FROM r, crc
), v AS (
  SELECT word, CAST(sum(times) AS BIGINT) AS n FROM (
    SELECT times, CASE WHEN h % 199 = 0
      THEN concat(substring(run, 1, h % length(run)), substring(run, h % length(run) + 2)) ELSE run END AS word
    FROM h
  ) GROUP BY word HAVING length(word) >= 6 AND n >= 5
), d AS (
  SELECT word, n, i, concat(substring(word, 1, i - 1), substring(word, i + 1)) AS rest
  FROM (SELECT word, n, unnest(range(1, length(word) + 1)) AS i FROM v)
), p AS (
  SELECT a.word, a.n, b.word AS other, b.n AS other_n FROM d a JOIN d b ON a.i = b.i AND a.rest = b.rest AND a.word <> b.word
  UNION SELECT d.word, d.n, v.word, v.n FROM d JOIN v ON d.rest = v.word
  UNION SELECT v.word, v.n, d.word, d.n FROM d JOIN v ON d.rest = v.word
), b AS (
  SELECT word, n, count(*) AS n_near, min({{'m': -other_n, 'w': other}}) AS best FROM p GROUP BY word, n
), f AS (
  SELECT v.word, v.n, coalesce(n_near, 0) AS n_near,
    CASE WHEN -best.m >= 5 * v.n THEN best.w END AS form, CASE WHEN -best.m >= 5 * v.n THEN -best.m END AS form_n
  FROM v LEFT JOIN b USING (word)
), t AS (
  SELECT word, word AS root, form AS next FROM f
  UNION ALL SELECT t.word, f.word, f.form FROM t JOIN f ON f.word = t.next
)
SELECT f.word, f.form, t.root, f.n, f.n_near, f.form_n FROM f JOIN t USING (word) WHERE t.next IS NULL
"""

ORACLE = {"op4_exact_dedup": OP4, "op5_secret_scan": _op5(), "op7_line_dedup": OP7, "op8_kd_search": OP8}
ORACLE |= {"op9_near_dedup": OP9, "op10_curriculum_mix": OP10, "op11_prefix_trie": OP11, "op12_spelling_variants": OP12}
