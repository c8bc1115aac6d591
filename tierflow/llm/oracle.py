"""DuckDB SQL for the llm queries that SQL can express."""

OP9 = r"""
WITH d AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS ws FROM documents
), starts AS (
  SELECT doc_id, ws, unnest(range(1, len(ws) - 18)) AS s FROM d WHERE len(ws) >= 20
), dup AS (
  SELECT doc_id, s FROM (
    SELECT doc_id, s, row_number() OVER (
      PARTITION BY array_to_string(ws[s:s + 19], ' ') ORDER BY doc_id, s) AS r FROM starts)
  WHERE r > 1
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(s, s + 20)) AS i FROM dup
), word AS (
  SELECT doc_id, unnest(ws) AS w, unnest(range(1, len(ws) + 1)) AS i FROM d
), kept AS (
  SELECT w.doc_id, string_agg(w.w, ' ' ORDER BY w.i) AS t, count(*) AS n
  FROM word w ANTI JOIN gone g ON w.doc_id = g.doc_id AND w.i = g.i GROUP BY w.doc_id
)
SELECT d.doc_id, CAST(len(d.ws) AS BIGINT) AS n_words,
       CAST(len(d.ws) - coalesce(k.n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(k.t, '')) AS kept_sha256
FROM d LEFT JOIN kept k ON d.doc_id = k.doc_id
"""

OP1 = """
WITH e AS (
  SELECT vec_id, [floor(256 * CAST(x AS DOUBLE)) FOR x IN embedding] AS v
  FROM embeddings
  WHERE embedding IS NOT NULL
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0
), scored AS (
  SELECT q.vec_id AS query_id, c.vec_id AS vec_id,
         CAST(list_inner_product(q.v, c.v) AS BIGINT) AS score
  FROM e q JOIN e c ON q.vec_id <> c.vec_id WHERE q.vec_id % 50 = 0
)
SELECT query_id, CAST(rank AS INTEGER) AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM scored)
WHERE rank <= 5
"""

OP7 = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages
), m AS (
  SELECT *, max(page_id) OVER (PARTITION BY html) AS keeper FROM p
)
SELECT page_id, n AS payload_bytes, sha1(html) AS payload_digest,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN n >= 1000 AND page_id <> keeper THEN keeper END AS refers_to
FROM m
"""

OP12 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS text,
         regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]') AS us,
         sha256('1:' || coalesce(CAST(doc_id AS VARCHAR), '')) AS h FROM documents
), drawn AS (
  SELECT *, CAST(len(us) AS BIGINT) AS n, CAST('0x' || h[1:8] AS BIGINT) AS h1, CAST('0x' || h[9:16] AS BIGINT) AS h2,
         CAST('0x' || h[17:24] AS BIGINT) AS h3, CAST('0x' || h[25:32] AS BIGINT) AS h4 FROM d
), formed AS (
  SELECT *, least(h1 % (n + 1), h2 % (n + 1)) AS a, greatest(h1 % (n + 1), h2 % (n + 1)) AS b,
         CASE WHEN text = '' OR regexp_matches(text, '<[PSM]>') OR h3 % 100 >= 90 THEN 'plain'
              WHEN h4 % 100 < 20 THEN 'spm' ELSE 'psm' END AS form FROM drawn
), parts AS (
  SELECT *, array_to_string(us[1:a], '') AS p, array_to_string(us[a + 1:b], '') AS m,
         array_to_string(us[b + 1:], '') AS s FROM formed
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END AS prefix_chars,
       CASE WHEN form <> 'plain' THEN length(m) END AS middle_chars,
       sha256(CASE form WHEN 'plain' THEN text WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m
              ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
       sha256(text) AS restored_sha256
FROM parts
"""

#: The edits' automaton (state: last role written; 0 none, 1 system, 2 user, 3
#: assistant) row by row, the best (cost, audit) of each state kept.
OP11 = r"""
WITH RECURSIVE crc_bits(i, k, v) AS (
  SELECT i, 0, i FROM range(256) t(i)
  UNION ALL
  SELECT i, k + 1, CASE WHEN v % 2 = 1 THEN xor(v // 2, 3988292384) ELSE v // 2 END FROM crc_bits WHERE k < 8
), crc_table AS (
  SELECT list(v ORDER BY i) AS t FROM crc_bits WHERE k = 8
), keyed AS (
  SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text,
         coalesce(CAST(conv_id AS VARCHAR), ' ') || ':' || coalesce(CAST(turn AS VARCHAR), ' ') AS k FROM conversations
), hashed AS (
  SELECT conv_id, turn, role, text, xor(4294967295, list_reduce(
           list_transform(range(1, length(k) + 1), lambda i: CAST(ord(k[i]) AS BIGINT)),
           lambda c, b: xor(c // 256, t[xor(c, b) % 256 + 1]), CAST(4294967295 AS BIGINT))) % 20 AS h
  FROM keyed, crc_table
), damaged AS (
  SELECT conv_id, turn, CASE h WHEN 4 THEN 'user' ELSE role END AS role,
         CASE h WHEN 1 THEN '' WHEN 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
         unnest(range(CASE h WHEN 0 THEN 0 WHEN 3 THEN 2 ELSE 1 END)) AS copy FROM hashed
), placed AS (
  SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i,
         rtrim(text, E' \t\n\x0b\x0c\r') AS shown, role[1] AS initial,
         row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) AS again FROM damaged
), faulty AS (
  SELECT *, CASE WHEN shown = '' THEN 'blank' WHEN again > 1 THEN 'duplicate'
                 WHEN shown[-1] NOT IN ('.', '!', '?') THEN 'truncated' END AS fault,
         lag(initial) OVER (PARTITION BY conv_id ORDER BY i) AS before FROM placed
), counted AS (
  SELECT conv_id, coalesce(max(turn) - min(turn) + 1 - count(DISTINCT turn), 0) AS gaps,
         count(*) FILTER (fault = 'blank') AS blank, count(*) FILTER (fault = 'duplicate') AS duplicate,
         count(*) FILTER (fault = 'truncated') AS truncated,
         count(*) FILTER (i > 1 AND before || initial NOT IN ('su', 'ua', 'au')) AS illegal FROM faulty GROUP BY conv_id
), convs AS (
  SELECT c.conv_id, coalesce(n, 0) AS n FROM (SELECT DISTINCT conv_id FROM conversations) c
  LEFT JOIN (SELECT conv_id, max(i) AS n FROM faulty GROUP BY conv_id) f ON c.conv_id IS NOT DISTINCT FROM f.conv_id
), moves(letter, q, to_q, role, cost) AS (
  VALUES ('I', 0, 2, 'user', 2), ('I', 1, 2, 'user', 2), ('I', 2, 3, 'assistant', 2), ('I', 3, 2, 'user', 2)
), starts(conv_id, n, i, q, cost, audit, body) AS (
  SELECT conv_id, n, 0, q, cost, audit, body FROM convs,
    (VALUES (0, 0, '', ''), (2, 2, 'I', 'user:'), (3, 4, 'II', E'user:\nassistant:')) s(q, cost, audit, body)
), paths AS (
  SELECT * FROM starts
  UNION ALL
  SELECT conv_id, n, i, q, cost, audit, body FROM (
    SELECT *, row_number() OVER (PARTITION BY conv_id, q ORDER BY cost, audit) AS best FROM (
      SELECT r.conv_id, r.n, r.i, e.q, r.cost + 2 * e.k AS cost, r.audit || e.tail AS audit, r.body || CASE
               WHEN e.k = 0 THEN '' ELSE CASE WHEN r.body = '' THEN '' ELSE E'\n' END || e.said END AS body
      FROM (
        SELECT p.conv_id, p.n, p.i + 1 AS i, m.q, p.cost + m.cost AS cost, p.audit || m.letter AS audit,
               CASE WHEN m.letter = 'D' THEN p.body ELSE p.body || CASE WHEN p.body = '' THEN '' ELSE E'\n' END
                 || m.role || ':' || f.text END AS body
        FROM paths p JOIN faulty f ON f.conv_id IS NOT DISTINCT FROM p.conv_id AND f.i = p.i + 1,
        LATERAL (
          SELECT 'D' AS letter, p.q AS q, 3 AS cost, '' AS role
          UNION ALL
          SELECT 'R', to_q, 2 + CAST(f.fault IS NOT NULL AS INT), moves.role FROM moves
          WHERE moves.q = p.q AND (f.fault IS NULL OR f.fault = 'truncated')
          UNION ALL
          SELECT 'K', k.to_q, CAST(f.fault IS NOT NULL AS INT), f.role
          FROM (VALUES (0, 's', 1), (0, 'u', 2), (1, 'u', 2), (2, 'a', 3), (3, 'u', 2)) k(q, initial, to_q)
          WHERE k.q = p.q AND k.initial = f.initial AND (f.fault IS NULL OR f.fault = 'truncated')
        ) m
      ) r JOIN (VALUES (0, 0, 0, '', ''), (1, 1, 0, '', ''), (2, 2, 0, '', ''), (3, 3, 0, '', ''),
                       (0, 2, 1, 'I', 'user:'), (1, 2, 1, 'I', 'user:'), (3, 2, 1, 'I', 'user:'),
                       (2, 3, 1, 'I', 'assistant:'), (0, 3, 2, 'II', E'user:\nassistant:'),
                       (1, 3, 2, 'II', E'user:\nassistant:')) e(from_q, q, k, tail, said) ON e.from_q = r.q
    )
  ) WHERE best = 1
), ended AS (
  SELECT conv_id, arg_min(struct_pack(cost := cost, audit := audit, body := body), (cost, audit)) AS x
  FROM paths WHERE i = n AND q IN (0, 3) GROUP BY conv_id
)
SELECT e.conv_id, coalesce(gaps, 0) AS gaps, coalesce(blank, 0) AS blank, coalesce(duplicate, 0) AS duplicate,
       coalesce(truncated, 0) AS truncated, coalesce(illegal, 0) AS illegal, CAST(x.cost AS BIGINT) AS cost,
       x.audit AS audit, sha256(x.body) AS repaired_sha256
FROM ended e LEFT JOIN counted c ON e.conv_id IS NOT DISTINCT FROM c.conv_id
"""

OP13 = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ',
                                              'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS ws FROM documents
), shingle AS (
  SELECT DISTINCT doc_id, CASE WHEN len(ws) < 3 THEN array_to_string(ws, ' ')
                               ELSE array_to_string(ws[i:i + 2], ' ') END AS g, len(ws) < 3 AS short
  FROM w, LATERAL (SELECT unnest(range(1, greatest(len(ws) - 1, 2))) AS i) WHERE len(ws) > 0
), size AS (
  SELECT doc_id, count(*) AS n FROM shingle GROUP BY doc_id
), link AS (
  SELECT p.a, p.b FROM (
    SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS shared FROM shingle x
    JOIN shingle y ON x.g = y.g AND x.short = y.short AND x.doc_id <> y.doc_id GROUP BY ALL) p
  JOIN size sa ON sa.doc_id = p.a JOIN size sb ON sb.doc_id = p.b
  WHERE 100 * shared >= 90 * (sa.n + sb.n - shared)
), reach AS (
  SELECT doc_id, doc_id AS r FROM w
  UNION
  SELECT reach.doc_id, link.b FROM reach JOIN link ON reach.r = link.a
)
SELECT w.doc_id, coalesce(max(size.n), 0) AS n_shingles, min(r) AS component_id
FROM w JOIN reach ON reach.doc_id = w.doc_id LEFT JOIN size ON size.doc_id = w.doc_id GROUP BY w.doc_id
"""

SQL: dict[str, str] = {
    "op1_topk_maxscore": OP1,
    "op7_warc": OP7,
    "op9_substring_dedup": OP9,
    "op11_repair_turns": OP11,
    "op12_fim_chunks": OP12,
    "op13_jaccard_skip": OP13,
}
