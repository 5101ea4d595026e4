"""Plain SQL of the registered queries that SQL can express."""

from __future__ import annotations

_WORDS = r"list_filter(string_split_regex(coalesce({text}, ''), '[ \t\n\x0b\f\r]+'), lambda x: x <> '')"

OP2 = f"""
WITH words AS (SELECT doc_id, {_WORDS.format(text="text")} AS w FROM documents),
starts AS (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS p FROM words WHERE len(w) >= 50),
windows AS (SELECT doc_id, p, md5(array_to_string(w[p:p + 49], ' ')) AS h FROM starts),
firsts AS (SELECT h, min(doc_id) AS f FROM windows GROUP BY h),
later AS (SELECT doc_id, p FROM windows JOIN firsts USING (h) WHERE f < doc_id),
gone AS (SELECT doc_id, list(DISTINCT p + o) AS g FROM later, (SELECT unnest(range(50)) AS o) GROUP BY doc_id)
SELECT doc_id, len(w)::BIGINT AS n_words, coalesce(len(g), 0)::BIGINT AS n_removed,
  sha256(coalesce(array_to_string(CASE WHEN g IS NULL THEN w ELSE list_filter(w, lambda x, i: NOT list_contains(g, i)) END, ' '), '')) AS kept_sha256
FROM words LEFT JOIN gone USING (doc_id)
"""

_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
OP5 = f"""
WITH RECURSIVE words AS (SELECT doc_id, {_WORDS.format(text=f"translate(text, '{_UPPER}', '{_LOWER}')")} AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct([array_to_string(w[i:i + 4], ' ') FOR i IN range(1, len(w) - 3)])
    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END AS s FROM words
),
items AS (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM sets),
pairs AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM items a JOIN items b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))
),
links AS (SELECT x, y FROM pairs UNION ALL SELECT y, x FROM pairs),
reach AS (SELECT DISTINCT x AS a, x AS b FROM links UNION SELECT r.a, l.y FROM reach r JOIN links l ON r.b = l.x),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, coalesce(m, doc_id) AS component_id FROM sets LEFT JOIN least ON a = doc_id
"""

OP7 = f"""
WITH RECURSIVE calls AS (
  SELECT conv_id, turn, text, len({_WORDS.format(text="text")}) AS words, 'call-' || conv_id || '-' || turn AS call_id FROM conversations WHERE role = 'user'
),
results AS (SELECT conv_id, turn AS result_turn, text AS content, 'call-' || conv_id || '-' || (turn - 1) AS call_id FROM conversations WHERE role = 'assistant'),
late AS (SELECT a.conv_id, a.turn FROM calls a JOIN calls b ON a.conv_id = b.conv_id AND b.turn = a.turn + 2 WHERE a.conv_id % 7 = 0),
places AS (
  SELECT conv_id, turn, turn AS place, 0::BIGINT AS step FROM calls ANTI JOIN late USING (conv_id, turn)
  UNION ALL
  SELECT l.conv_id, l.turn, p.place, p.step + 1 FROM late l JOIN places p ON l.conv_id = p.conv_id AND p.turn = l.turn + 2
),
rows AS (
  SELECT coalesce(c.conv_id, r.conv_id) AS conv_id, coalesce(c.call_id, r.call_id) AS call_id, c.turn, c.text, c.words, r.result_turn,
    '{{"content":' || to_json(r.content) || ',"turn":' || r.result_turn || '}}' AS result
  FROM calls c FULL JOIN results r ON c.conv_id = r.conv_id AND c.call_id = r.call_id
)
SELECT conv_id, call_id, coalesce(turn, result_turn) AS turn, coalesce(place, result_turn) AS place, coalesce(step, 0)::BIGINT AS step,
  turn IS NOT NULL AND result_turn IS NOT NULL AS linked, (turn IS NOT NULL)::BIGINT AS n_calls, (result_turn IS NOT NULL)::BIGINT AS n_results,
  CASE WHEN turn IS NOT NULL THEN words BETWEEN 1 AND 40 END AS valid, false AS cyclic,
  CASE WHEN turn IS NULL THEN '{{"id":"' || call_id || '","result":' || result || ',"type":"result"}}'
    ELSE '{{"arguments":{{"question":' || to_json(text) || ',"turn":' || turn || ',"words":' || words || '}},"id":"' || call_id || '","name":"ask","result":'
      || coalesce(result, 'null') || ',"turn":' || turn || ',"type":"call"}}' END AS json
FROM rows LEFT JOIN places USING (conv_id, turn)
UNION ALL SELECT conv_id, NULL, turn, turn, 0, false, 0, 0, NULL, false,
  '{{"content":' || coalesce(to_json(text)::VARCHAR, 'null') || ',"role":' || coalesce(to_json(role)::VARCHAR, 'null') || ',"turn":' || coalesce(turn::VARCHAR, 'null') || ',"type":"message"}}'
FROM conversations WHERE coalesce(role, '') NOT IN ('user', 'assistant')
"""

OP8 = """
WITH RECURSIVE vectors AS (
  SELECT vec_id, embedding::DOUBLE[] AS v FROM embeddings
  WHERE len(embedding) > 0 AND len(list_filter(embedding, lambda x: x IS NULL OR isnan(x) OR isinf(x))) = 0 AND len(list_filter(embedding, lambda x: x <> 0)) > 0
),
links AS (SELECT a.vec_id AS x, b.vec_id AS y FROM vectors a JOIN vectors b ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.v, b.v) >= 0.9),
reach AS (SELECT DISTINCT x AS a, x AS b FROM links UNION SELECT r.a, l.y FROM reach r JOIN links l ON r.b = l.x),
least AS (SELECT a, min(b) AS m FROM reach GROUP BY a),
counts AS (SELECT x, count(*) AS n FROM links GROUP BY x)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, coalesce(m, vec_id) AS component_id, coalesce(m, vec_id) = vec_id AS kept
FROM embeddings LEFT JOIN least ON a = vec_id LEFT JOIN counts ON x = vec_id
"""

OP11 = """
WITH units AS (
  SELECT doc_id, coalesce(text, '') AS t, regexp_extract_all(coalesce(text, ''), '[A-Za-z]+|[^A-Za-z]', 0, 's') AS u, sha256('1:' || coalesce(doc_id::VARCHAR, '')) AS h
  FROM documents
),
draws AS (SELECT *, len(u)::BIGINT AS n, list_transform(range(4), lambda i: ('0x' || h[8 * i + 1:8 * i + 8])::BIGINT) AS r FROM units),
cuts AS (
  SELECT *, least(r[1] % (n + 1), r[2] % (n + 1)) AS a, greatest(r[1] % (n + 1), r[2] % (n + 1)) AS b,
    CASE WHEN t = '' OR contains(t, '<P>') OR contains(t, '<S>') OR contains(t, '<M>') OR r[3] % 100 >= 90 THEN 'plain' WHEN r[4] % 100 < 20 THEN 'spm' ELSE 'psm' END AS form
  FROM draws
),
parts AS (
  SELECT *, coalesce(array_to_string(u[1:a], ''), '') AS p, coalesce(array_to_string(u[a + 1:b], ''), '') AS m, coalesce(array_to_string(u[b + 1:], ''), '') AS s FROM cuts
)
SELECT doc_id, n, form, CASE WHEN form <> 'plain' THEN length(p) END::BIGINT AS prefix_chars, CASE WHEN form <> 'plain' THEN length(m) END::BIGINT AS middle_chars,
  sha256(CASE form WHEN 'plain' THEN t WHEN 'psm' THEN '<P>' || p || '<S>' || s || '<M>' || m ELSE '<S>' || s || '<P>' || p || '<M>' || m END) AS output_sha256,
  sha256(t) AS restored_sha256
FROM parts
"""

OP13 = fr"""
WITH docs AS (
  SELECT row_number() OVER () AS row, doc_id, regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w FROM documents
),
held AS (SELECT row, doc_id, w, len(w)::BIGINT AS n FROM docs WHERE len(w) > 0),
sums AS (SELECT count(*)::BIGINT AS big_n, sum(n)::BIGINT AS big_l FROM held),
counts AS (SELECT row, doc_id, n, term, count(*)::BIGINT AS tf FROM (SELECT row, doc_id, n, unnest(w) AS term FROM held) GROUP BY ALL),
weights AS (SELECT term, floor(1000 * ln((2 * any_value(big_n) + 2) / (2 * count(*) + 1)))::BIGINT AS weight FROM counts, sums GROUP BY term),
asked AS (
  SELECT item, item_id, term, count(*)::BIGINT AS times FROM (
    SELECT row_number() OVER () AS item, item_id, unnest(regexp_extract_all(translate(text, '{_UPPER}', '{_LOWER}'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
  ) GROUP BY ALL
),
scores AS (
  SELECT item, item_id, row, doc_id, sum(times * weight * ((1000000000 * tf) // (1000 * tf + 8 * (25 + (75 * n * big_n) // big_l))))::BIGINT AS score
  FROM asked JOIN counts USING (term) JOIN weights USING (term), sums GROUP BY ALL
)
SELECT item_id, (row_number() OVER (PARTITION BY item ORDER BY score DESC, doc_id NULLS LAST))::INTEGER AS rank, doc_id, score
FROM scores WHERE score > 0 QUALIFY rank <= 10
"""

LLM_ORACLE = {
    "op2_substring_dedup": OP2, "op5_ngram_jaccard_join": OP5, "op7_chat_formatting": OP7, "op8_embedding_near_dedup": OP8,
    "op11_fill_in_middle": OP11, "op13_ranked_search": OP13,
}
