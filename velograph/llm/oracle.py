"""DuckDB SQL of the corpus queries that SQL can express."""

LOWER = "translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
SPACED = r"[^\x20\x09-\x0D]+"
ALNUM = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
#: crc32 of the id as text, bit by bit.
CRC = ("xor(4294967295, list_reduce(list_concat([CAST(4294967295 AS BIGINT)], list_transform(string_split(CAST(doc_id AS VARCHAR), ''), lambda x: CAST(ascii(x) AS BIGINT))), "
       "lambda c, b: list_reduce([xor(c, b), 0, 0, 0, 0, 0, 0, 0, 0], lambda r, i: xor(r >> 1, 3988292384 * (r & 1)))))")
LEAF = "sha256(" + " || ".join(f"coalesce(strlen(CAST({c} AS VARCHAR)) || ':' || CAST({c} AS VARCHAR), '-')"
                               for c in ("doc_id", "source", "lang", "n_chars", "TEXT")) + ")"

SQL = {
    "op8_wu_manber": f"""
WITH d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM documents),
b AS (SELECT item_id, regexp_extract_all({LOWER}, '{ALNUM}') AS w FROM benchmark),
bp AS (SELECT item_id, w, least(13, len(w)) AS k FROM b WHERE len(w) > 0),
pat AS (SELECT DISTINCT item_id, k, array_to_string(list_slice(w, i, i + k - 1), ' ') AS p
        FROM (SELECT item_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM bp)),
ks AS (SELECT DISTINCT k FROM pat),
win AS (SELECT doc_id, k, i, array_to_string(list_slice(w, i, i + k - 1), ' ') AS p
        FROM (SELECT doc_id, w, k, unnest(generate_series(1, len(w) - k + 1)) AS i FROM d, ks WHERE len(w) >= k)),
hit AS (SELECT win.doc_id, win.i, win.k, pat.item_id FROM win JOIN pat ON win.k = pat.k AND win.p = pat.p),
pos AS (SELECT doc_id, count(DISTINCT x) AS n_hit FROM (SELECT doc_id, unnest(generate_series(i, i + k - 1)) AS x FROM hit) GROUP BY doc_id),
it AS (SELECT doc_id, count(*) AS n_items, string_agg(s, ',' ORDER BY s) AS ids
       FROM (SELECT DISTINCT doc_id, CAST(item_id AS VARCHAR) AS s FROM hit) GROUP BY doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n_hit, 0) AS BIGINT) AS n_hit,
       CAST(coalesce(n_items, 0) AS BIGINT) AS n_items, sha256(coalesce(ids, '')) AS items_sha256,
       coalesce(n_hit, 0) > 0 AND 20 * coalesce(n_hit, 0) >= len(w) AS contaminated
FROM d LEFT JOIN pos USING (doc_id) LEFT JOIN it USING (doc_id)""",
    "op10_line_dedup": r"""
WITH l AS (SELECT doc_id, unnest(x) AS line, generate_subscripts(x, 1) AS i
           FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS x FROM documents)),
k AS (SELECT *, translate(trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
                          'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM l),
r AS (SELECT key, max(doc_id) AS keeper FROM k WHERE length(key) >= 20 GROUP BY key HAVING count(DISTINCT doc_id) >= 3),
j AS (SELECT doc_id, i, line, r.key IS NOT NULL AND doc_id < keeper AS gone FROM k LEFT JOIN r ON k.key = r.key)
SELECT doc_id, count(*) AS n_lines, CAST(count(*) FILTER (gone) AS BIGINT) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY i) FILTER (NOT gone), '')) AS kept_sha256
FROM j GROUP BY doc_id""",
    "op4_substring_dedup": f"""
WITH d AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '{SPACED}') AS w FROM documents),
win AS (SELECT doc_id, i, sha256(array_to_string(list_slice(w, i, i + 49), ' ')) AS h
        FROM (SELECT doc_id, w, unnest(generate_series(1, len(w) - 49)) AS i FROM d WHERE len(w) >= 50)),
low AS (SELECT h, min(doc_id) AS low FROM win GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(generate_series(i, i + 49)) AS i FROM win JOIN low USING (h) WHERE doc_id > low),
x AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS i FROM d),
k AS (SELECT x.doc_id, string_agg(word, ' ' ORDER BY x.i) AS kept, count(*) AS n
      FROM x ANTI JOIN gone ON x.doc_id = gone.doc_id AND x.i = gone.i GROUP BY x.doc_id)
SELECT d.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(len(w) - coalesce(n, 0) AS BIGINT) AS n_removed,
       sha256(coalesce(kept, '')) AS kept_sha256
FROM d LEFT JOIN k USING (doc_id)""",
    "op1_ngram_join": f"""
WITH RECURSIVE d AS (SELECT doc_id, regexp_extract_all({LOWER}, '{SPACED}') AS w FROM documents),
g AS (SELECT DISTINCT doc_id, array_to_string(list_slice(w, i, i + k - 1), ' ') AS g
      FROM (SELECT doc_id, w, least(3, len(w)) AS k, unnest(generate_series(1, len(w) - least(3, len(w)) + 1)) AS i
            FROM d WHERE len(w) > 0)),
n AS (SELECT doc_id, count(*) AS n FROM g GROUP BY doc_id),
c AS (SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM g x JOIN g y ON x.g = y.g AND x.doc_id <> y.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM c JOIN n na ON na.doc_id = a JOIN n nb ON nb.doc_id = b WHERE 100 * c >= 90 * (na.n + nb.n - c)),
r AS (SELECT doc_id, doc_id AS m FROM n UNION SELECT l.b, r.m FROM r JOIN l ON l.a = r.doc_id)
SELECT d.doc_id, CAST(coalesce(any_value(n.n), 0) AS BIGINT) AS n_shingles, coalesce(min(r.m), d.doc_id) AS component_id
FROM d LEFT JOIN n USING (doc_id) LEFT JOIN r USING (doc_id) GROUP BY d.doc_id""",
    "op9_chat_tree": r"""
WITH c AS (SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
           UNION ALL SELECT -1, t, r, '<|im_end|><|im_start|>assistant ok' FROM (VALUES (0, 'user'), (1, 'assistant')) v(t, r)),
x AS (SELECT *, CASE WHEN role = 'assistant' THEN text ELSE '' END AS loss,
             length('<|im_start|>' || replace(replace(replace(role, '\', '\\'), '<|', '<\|'), chr(10), '\n') || chr(10)
                    || replace(replace(text, '\', '\\'), '<|', '<\|') || '<|im_end|>' || chr(10)) AS f FROM c)
SELECT conv_id, count(*) AS n_turns,
       sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       CAST(sum(length(loss)) AS BIGINT) AS loss_chars, sha256(string_agg(loss, '' ORDER BY turn, role, text)) AS loss_sha256,
       CAST(sum(f) AS BIGINT) AS formatted_chars
FROM x GROUP BY conv_id""",
    "op11_merkle": f"""
WITH RECURSIVE f AS (SELECT *, {CRC} AS crc FROM documents),
x AS (SELECT *, {LEAF.replace('TEXT', 'text')} AS leaf, {LEAF.replace('TEXT', "replace(text, chr(10), '')")} AS changed FROM f),
b AS (SELECT doc_id, leaf, CASE WHEN crc % 2 = 0 THEN changed ELSE leaf END AS start, dense_rank() OVER (ORDER BY source NULLS FIRST) - 1 AS g,
             row_number() OVER (PARTITION BY source ORDER BY doc_id NULLS FIRST, leaf) - 1 AS idx, count(*) OVER (PARTITION BY source) AS n FROM x),
up AS (SELECT 0 AS lv, g, idx, n, leaf AS d FROM b
       UNION ALL SELECT lv + 1, g, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM up WHERE n > 1 GROUP BY lv, g, idx // 3, n),
sub AS (SELECT g, d FROM up WHERE n = 1),
top AS (SELECT 0 AS lv, g AS idx, (SELECT count(*) FROM sub) AS n, d FROM sub
        UNION ALL SELECT lv + 1, idx // 3, (n + 2) // 3, sha256(string_agg(d, '' ORDER BY idx)) FROM top WHERE n > 1 GROUP BY lv, idx // 3, n),
steps AS (SELECT lv, g, idx, n, d FROM up UNION ALL SELECT lv, -1, idx, n, d FROM top),
sib AS (SELECT a.lv, a.g, a.idx, coalesce(string_agg(o.d, '' ORDER BY o.idx) FILTER (o.idx < a.idx), '') AS l,
               coalesce(string_agg(o.d, '' ORDER BY o.idx) FILTER (o.idx > a.idx), '') AS r
        FROM steps a JOIN steps o ON a.lv = o.lv AND a.g = o.g AND a.idx // 3 = o.idx // 3 WHERE a.n > 1 GROUP BY ALL),
w AS (SELECT 0 AS lv, doc_id, leaf, g, idx, start AS acc, '' AS proof FROM b
      UNION ALL SELECT w.lv + 1, doc_id, leaf, w.g, w.idx // 3, sha256(l || acc || r), proof || l || r FROM w JOIN sib USING (lv, g, idx)),
v AS (SELECT 0 AS lv, doc_id, leaf, sub.d AS subroot, -1 AS g, w.g AS idx, acc, proof
      FROM w JOIN sub USING (g) ANTI JOIN sib ON w.lv = sib.lv AND w.g = sib.g AND w.idx = sib.idx
      UNION ALL SELECT v.lv + 1, doc_id, leaf, subroot, -1, v.idx // 3, sha256(l || acc || r), proof || l || r FROM v JOIN sib USING (lv, g, idx))
SELECT doc_id, leaf, subroot, t.d AS root, sha256(proof) AS proof_sha256, acc AS folded_root, acc = t.d AS verified
FROM v ANTI JOIN sib ON v.lv = sib.lv AND v.g = sib.g AND v.idx = sib.idx JOIN top t ON t.n = 1""",
}
