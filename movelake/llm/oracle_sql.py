"""DuckDB SQL for the queries that SQL can express."""

#: Queries that SQL cannot express, or not on whole tables; tests/llm compares them with brute force or the library.
WITHOUT_SQL = {"op4_packing", "op6_toxicity", "op8_bpe", "op9_token_counts", "op10_simhash", "pipeline"}
WORDS = r"regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+')"

ORACLE = {
    "op1_substring_dedup": rf"""
WITH d AS (SELECT doc_id, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 19], ' ') AS s FROM d, unnest(range(1, len(w) - 18)) AS t(i)),
dup AS (SELECT doc_id, i FROM (SELECT doc_id, i, row_number() OVER (PARTITION BY s ORDER BY doc_id, i) AS r FROM win) WHERE r > 1),
gone AS (SELECT DISTINCT doc_id, i + j AS i FROM dup, unnest(range(0, 20)) AS t(j)),
word AS (SELECT doc_id, i, w[i] AS x FROM d, unnest(range(1, len(w) + 1)) AS t(i)),
kept AS (SELECT word.doc_id, string_agg(x, ' ' ORDER BY word.i) AS k, count(*) AS n FROM word ANTI JOIN gone ON word.doc_id = gone.doc_id AND word.i = gone.i GROUP BY ALL)
SELECT d.doc_id, len(w)::BIGINT AS n_words, (len(w) - coalesce(n, 0))::BIGINT AS n_removed, sha256(coalesce(k, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)""",
    "op2_warc": """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
f AS (SELECT page_id, h, min(page_id) OVER (PARTITION BY h) AS first FROM p),
r AS (SELECT *, strlen(h) >= 100 AND page_id > first AS again FROM f)
SELECT page_id, strlen(h)::BIGINT AS payload_bytes, sha256(h) AS payload_digest,
  CASE WHEN again THEN 'revisit' ELSE 'response' END AS record_type, CASE WHEN again THEN first END AS refers_to FROM r""",
    "op3_exact_dedup": """
WITH d AS (SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents)
SELECT doc_id, max(doc_id) OVER g AS keep_id, count(*) OVER g AS group_size, doc_id = max(doc_id) OVER g AS kept, sha256(t) AS text_sha256
FROM d WINDOW g AS (PARTITION BY t)""",
    "op5_url_filter": r"""
WITH RECURSIVE part AS (SELECT '(?s)^(.*?)://([^/?#]*)([^?#]*)' AS p),
link AS (SELECT url AS a, unnest(list_concat(
    regexp_extract_all(html, '(?is)<link\b[^>]*\brel\s*=\s*["'']?canonical\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)', 1),
    regexp_extract_all(html, '(?is)<link\b[^>]*?\bhref\s*=\s*["'']?([^"''\s>]+)[^>]*\brel\s*=\s*["'']?canonical\b', 1),
    regexp_extract_all(html, '(?is)<meta\b[^>]*\bhttp-equiv\s*=\s*["'']?refresh\b[^>]*?\burl\s*=\s*["'']?([^"''\s>]+)', 1))) AS t FROM pages),
edge AS (SELECT a, CASE
    WHEN regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*://') THEN t
    WHEN a NOT LIKE '%://%' OR regexp_matches(t, '^[A-Za-z][A-Za-z0-9+.\-]*:|^[#?]|^$') THEN NULL
    WHEN t LIKE '//%' THEN regexp_extract(a, p, 1) || ':' || t
    WHEN t LIKE '/%' THEN regexp_extract(a, p, 1) || '://' || regexp_extract(a, p, 2) || t
    ELSE regexp_extract(a, p, 1) || '://' || regexp_extract(a, p, 2) || coalesce(nullif(regexp_extract(regexp_extract(a, p, 3), '(?s)^(.*/)', 1), ''), '/') || t
  END AS b FROM link, part),
both_ways AS (SELECT a, b FROM edge WHERE b IS NOT NULL UNION SELECT b, a FROM edge WHERE b IS NOT NULL),
reach(a, b) AS (SELECT a, b FROM both_ways UNION SELECT r.a, e.b FROM reach r JOIN both_ways e ON r.b = e.a),
url AS (SELECT url AS u FROM pages WHERE url IS NOT NULL UNION SELECT a FROM reach),
split AS (SELECT u, translate(regexp_extract(u, p, 2), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS h, regexp_extract(u, p, 3) AS path FROM url, part),
rules(rule, v) AS (VALUES ('net/', 'block'), ('example.net/en/', 'allow'), ('example.com/de/', 'block'), ('org/fr/', 'allow')),
own AS (SELECT u, arg_max(rule, length(rule)) AS rule, arg_max(v, length(rule)) AS v FROM split JOIN rules
  ON (h = split_part(rule, '/', 1) OR h LIKE '%.' || split_part(rule, '/', 1)) AND starts_with(path, substr(rule, instr(rule, '/'))) GROUP BY u),
passed AS (SELECT r.a AS u, bool_or(o.v = 'allow') AS ok FROM reach r JOIN own o ON o.u = r.b GROUP BY r.a)
SELECT page_id, coalesce(h, '') AS host, coalesce(path, '') AS path, rule, coalesce(v, CASE WHEN NOT ok THEN 'block' ELSE 'allow' END) AS verdict
FROM pages LEFT JOIN split ON url = split.u LEFT JOIN own ON url = own.u LEFT JOIN passed ON url = passed.u""",
    "op7_quality_rules": rf"""
WITH d AS (SELECT doc_id, coalesce(text, '') AS t, {WORDS} AS w FROM documents),
win AS (SELECT doc_id, i, array_to_string(w[i:i + 7], ' ') AS s FROM d, unnest(range(1, len(w) - 6)) AS x(i)),
rep AS (SELECT doc_id, i FROM (SELECT doc_id, i, count(*) OVER (PARTITION BY doc_id, s) AS c FROM win) WHERE c > 1),
cov AS (SELECT doc_id, count(DISTINCT i + j) AS n FROM rep, unnest(range(0, 8)) AS x(j) GROUP BY doc_id),
m AS (SELECT d.doc_id, len(w)::BIGINT AS n_words, length(array_to_string(w, ''))::BIGINT AS word_chars,
    len(regexp_extract_all(t, '[#*$%&|<>]'))::BIGINT AS n_symbols, len(regexp_extract_all(t, '!'))::BIGINT AS n_shouts,
    list_filter(string_split(t, chr(10)), lambda x: regexp_matches(x, '[^\x20\x09-\x0D]')) AS lines, coalesce(n, 0)::BIGINT AS n_repeat_words
  FROM d LEFT JOIN cov USING (doc_id)),
c AS (SELECT *, (len(lines) - len(list_distinct(lines)))::BIGINT AS n_dup_lines, n_words < 20 OR 100 * n_repeat_words > 30 * n_words AS base_failed FROM m)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed,
  NOT base_failed AND 100 * n_symbols <= 25 * n_words AND 100 * n_dup_lines <= 10 * n_words AND 100 * n_shouts <= 50 * n_words
  AND word_chars >= 2 * n_words AND word_chars <= 30 * n_words AS kept FROM c""",
    "op11_embedding_dedup": """
WITH RECURSIVE v AS (SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
ok AS (SELECT * FROM v WHERE len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0 AND len(list_filter(e, lambda x: x != 0)) > 0),
link AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b ON a.vec_id != b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.95),
reach(a, b) AS (SELECT a, b FROM link UNION SELECT r.a, l.b FROM reach r JOIN link l ON r.b = l.a),
low AS (SELECT a, min(b) AS m FROM reach GROUP BY a), n AS (SELECT a, count(*) AS n FROM link GROUP BY a)
SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, least(vec_id, coalesce(m, vec_id)) AS component_id, vec_id <= coalesce(m, vec_id) AS kept
FROM v LEFT JOIN low ON low.a = vec_id LEFT JOIN n ON n.a = vec_id""",
    "op12_ranked_search": r"""
WITH word AS (SELECT 'd' AS kind, doc_id AS id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS t FROM documents
  UNION ALL SELECT 'q', item_id, unnest(regexp_extract_all(text, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) FROM benchmark),
term AS (SELECT kind, id, translate(t, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t, count(*) AS tf FROM word GROUP BY ALL),
doc AS (SELECT id, sum(tf)::BIGINT AS n FROM term WHERE kind = 'd' GROUP BY id),
whole AS (SELECT count(*) AS c, sum(n)::BIGINT AS l FROM doc),
weight AS (SELECT t, floor(1000 * ln((2 * c + 2)::DOUBLE / (2 * df + 1)))::BIGINT AS w FROM (SELECT t, count(*) AS df FROM term WHERE kind = 'd' GROUP BY t), whole),
impact AS (SELECT term.id, t, (1000000000 * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * c) // l)) AS i FROM term JOIN doc ON term.id = doc.id, whole WHERE kind = 'd'),
found AS (SELECT q.id AS item_id, i.id AS doc_id, sum(w * i.i)::BIGINT AS score FROM term q JOIN weight USING (t) JOIN impact i USING (t) WHERE q.kind = 'q' GROUP BY ALL HAVING sum(w * i.i) > 0)
SELECT item_id, rank::INTEGER AS rank, doc_id, score FROM (SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS rank FROM found) WHERE rank <= 10""",
    "op13_filter_audit": rf"""
WITH d AS (SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS x, {WORDS} AS w FROM documents),
m AS (SELECT part, [len(w) < 200, 100 * len(list_distinct(w)) < 50 * len(w), 100 * len(regexp_extract_all(x, '[A-Z]')) > 3 * length(x),
    regexp_matches(x, '[#$%&*|]'), doc_id > min(doc_id) OVER (PARTITION BY x)] AS f, quality, toxic FROM d LEFT JOIN labels USING (doc_id)),
c AS (SELECT part, f, count(*) AS n, count(*) FILTER (quality = 1) AS g, count(*) FILTER (toxic = 1) AS t FROM m GROUP BY ALL),
letter AS (SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS l),
perm AS (SELECT a.l || b.l || c.l || d.l || e.l AS filter_order FROM letter a, letter b, letter c, letter d, letter e
  WHERE len(list_distinct([a.l, b.l, c.l, d.l, e.l])) = 5),
ord AS (SELECT filter_order, list_transform(range(1, 6), lambda i: strpos('ABCDE', substr(filter_order, i, 1))) AS o FROM perm),
z AS (SELECT part, filter_order, o, f, n, g, t, list_position(list_transform(o, lambda k: f[k]), true) AS first FROM c, ord),
s AS (SELECT part, filter_order, i::INTEGER AS step, substr(filter_order, i::INTEGER, 1) AS l, f[o[i]] AS bad, len(list_filter(f, lambda x: x)) AS k, n, g, t, first FROM z, unnest(range(1, 6)) AS u(i)),
r AS (SELECT part, filter_order, step, l, coalesce(sum(n) FILTER (first IS NULL OR first > step), 0)::BIGINT AS kept, coalesce(sum(n) FILTER (first = step), 0)::BIGINT AS removed,
  coalesce(sum(n) FILTER (bad AND first < step), 0)::BIGINT AS redundant, coalesce(sum(n) FILTER (bad AND k = 1), 0)::BIGINT AS unique_fails,
  coalesce(sum(g) FILTER (first = step), 0)::BIGINT AS good_lost, coalesce(sum(t) FILTER (first = step), 0)::BIGINT AS toxic_lost FROM s GROUP BY ALL)
SELECT part, filter_order, step, kept, removed, redundant, unique_fails, good_lost, toxic_lost, (sum(removed) OVER (PARTITION BY part, l))::BIGINT AS shapley FROM r""",
}
