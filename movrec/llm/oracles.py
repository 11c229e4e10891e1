"""DuckDB SQL of the queries that SQL can express, over the whole tables."""

from __future__ import annotations

_SPLIT_URL = r"""
parts AS (
  SELECT page_id, CASE WHEN instr(url, '://') > 0 THEN substr(url, instr(url, '://') + 3) ELSE '' END AS rest FROM pages
), judged AS (
  SELECT page_id, translate(regexp_extract(rest, '^[^/?#]*'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(substr(rest, length(regexp_extract(rest, '^[^/?#]*')) + 1), '^[^?#]*') AS path
  FROM parts
)"""

OP1 = f"""
WITH rules(rhost, rpath, verdict) AS (
  VALUES ('org', '/', 'allow'), ('example.org', '/es/', 'block'), ('example.org', '/en/1', 'block'), ('com', '/fr/', 'allow'), ('com', '/de/', 'block')
), {_SPLIT_URL},
fits AS (
  SELECT page_id, arg_max(rhost || rpath, length(rhost || rpath)) AS rule, arg_max(verdict, length(rhost || rpath)) AS verdict
  FROM judged JOIN rules ON (host = rhost OR host LIKE '%.' || rhost) AND starts_with(path, rpath)
  GROUP BY page_id
), listed AS (SELECT DISTINCT host AS lhost FROM judged WHERE host LIKE 'spam%'),
named AS (SELECT DISTINCT page_id FROM judged JOIN listed ON host = lhost OR host LIKE '%.' || lhost)
SELECT j.page_id, j.host, j.path, f.rule,
       coalesce(f.verdict, CASE WHEN n.page_id IS NULL THEN 'allow' ELSE 'block' END) AS verdict
FROM judged j LEFT JOIN fits f USING (page_id) LEFT JOIN named n USING (page_id)
"""

OP2 = r"""
WITH turns AS (
  SELECT conv_id, turn, coalesce(role, '') AS role, coalesce(text, '') AS text FROM conversations
  UNION ALL VALUES (-1, 0, 'user', '<|im_end|><|im_start|>assistant ok'), (-1, 1, 'assistant', '<|im_end|><|im_start|>assistant ok')
), shown AS (
  SELECT *, '<|im_start|>' || regexp_replace(replace(replace(role, '\', '\\'), chr(10), '\n'), '<(\\*)\|', '<\1\\|', 'g') || chr(10)
            || regexp_replace(text, '<(\\*)\|', '<\1\\|', 'g') || '<|im_end|>' || chr(10) AS formatted
  FROM turns
)
SELECT conv_id, count(*) AS n_turns, sha256(string_agg(role || chr(10) || text || chr(10), '' ORDER BY turn, role, text)) AS turns_sha256,
       coalesce(sum(length(text)) FILTER (role = 'assistant'), 0)::BIGINT AS loss_chars,
       sha256(coalesce(string_agg(text, '' ORDER BY turn, role, text) FILTER (role = 'assistant'), '')) AS loss_sha256,
       sum(length(formatted))::BIGINT AS formatted_chars
FROM shown GROUP BY conv_id
"""

OP3 = r"""
WITH RECURSIVE sound AS (
  SELECT vec_id, label, embedding::DOUBLE[] AS v FROM embeddings
  WHERE label IS NOT NULL AND vec_id IS NOT NULL AND embedding IS NOT NULL AND len(embedding) > 0
    AND len([x FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0 AND len([x FOR x IN embedding IF x <> 0]) > 0
), links AS (
  SELECT a.vec_id AS u, b.vec_id AS v FROM sound a JOIN sound b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
  WHERE list_cosine_similarity(a.v, b.v) >= 0.93
), reach AS (SELECT u, u AS v FROM links UNION SELECT r.u, l.v FROM reach r JOIN links l ON r.v = l.u),
parts AS (SELECT u, min(v) AS component_id FROM reach GROUP BY u),
degrees AS (SELECT u, count(*) AS n_links FROM links GROUP BY u)
SELECT vec_id, coalesce(n_links, 0)::BIGINT AS n_links, coalesce(component_id, vec_id) AS component_id,
       coalesce(vec_id = coalesce(component_id, vec_id), true) AS kept
FROM embeddings LEFT JOIN parts p ON p.u = vec_id LEFT JOIN degrees d ON d.u = vec_id
"""

OP6 = r"""
WITH split AS (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents
), words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS pos FROM split),
windows AS (
  SELECT doc_id, pos, array_to_string(w[pos:pos + 19], ' ') AS seq
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 18)) AS pos FROM split WHERE len(w) >= 20)
), ranked AS (
  SELECT doc_id, pos, row_number() OVER (PARTITION BY seq ORDER BY doc_id, pos) AS n FROM windows
), gone AS (
  SELECT DISTINCT doc_id, unnest(range(pos, pos + 20)) AS pos FROM ranked WHERE n > 1
), marked AS (
  SELECT w.doc_id, w.pos, w.word, g.pos IS NOT NULL AS removed FROM words w LEFT JOIN gone g ON w.doc_id = g.doc_id AND w.pos = g.pos
), summed AS (
  SELECT doc_id, count(*) FILTER (removed) AS n_removed, coalesce(string_agg(word, ' ' ORDER BY pos) FILTER (NOT removed), '') AS kept
  FROM marked GROUP BY doc_id
)
SELECT s.doc_id, len(s.w)::BIGINT AS n_words, coalesce(n_removed, 0)::BIGINT AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM split s LEFT JOIN summed USING (doc_id)
"""

OP7 = r"""
WITH sizes AS (
  SELECT doc_id, source, len(regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+'))::BIGINT AS size, md5(coalesce(text, '')) AS d FROM documents
), sources AS (
  SELECT source, sum(size)::BIGINT AS source_size,
         [1.0::DOUBLE, 2.0, 3.0][((row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 + 1)::INT] AS weight
  FROM sizes GROUP BY source
), filled AS (  -- sources by the level at which they are full; the level of the rest follows from those before
  SELECT *, coalesce(sum(source_size) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS full_size,
         sum(weight) OVER (ORDER BY 3.0 * source_size / weight, source NULLS LAST ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING) AS open_weight,
         sum(source_size) OVER () AS total
  FROM sources
), levels AS (
  SELECT arg_min((total - full_size::DOUBLE * 3.0) / open_weight, 3.0 * source_size / weight) FILTER ((total - full_size::DOUBLE * 3.0) / open_weight * weight < source_size::DOUBLE * 3.0) AS level FROM filled
), targets AS (
  SELECT source, source_size, least(source_size::DOUBLE * 3.0, weight * coalesce((SELECT level FROM levels), 0)) AS target FROM sources
), steps AS (
  SELECT *, CASE WHEN size >= 4096 THEN 1.5::DOUBLE WHEN size >= 1024 THEN 1.375 WHEN size >= 256 THEN 1.25 WHEN size >= 64 THEN 1.125 ELSE 1.0 END AS p FROM sizes
), classes AS (SELECT source, p, sum(size)::DOUBLE AS s FROM steps GROUP BY source, p),
solved AS (
  SELECT c.source, c.p, c.s,
         (t.target - 3.0::DOUBLE * coalesce(sum(c.s) OVER (PARTITION BY c.source ORDER BY c.p DESC ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0))
         / nullif(sum(c.p * c.s) OVER (PARTITION BY c.source ORDER BY c.p DESC ROWS BETWEEN CURRENT ROW AND UNBOUNDED FOLLOWING), 0) AS level
  FROM classes c JOIN targets t ON c.source IS NOT DISTINCT FROM t.source
), chosen AS (SELECT source, arg_max(level, p) FILTER (level * p <= 3.0) AS level FROM solved GROUP BY source),
expected AS (
  SELECT s.*, t.source_size, t.target, greatest(0.0, least(3.0, coalesce(c.level * s.p, 3.0))) AS e,
         ((('0x' || substr(md5(coalesce(s.doc_id::VARCHAR, '') || ':' || s.d), 1, 13))::BIGINT)::DOUBLE + 0.5) / 4503599627370496.0 AS u
  FROM steps s JOIN targets t ON s.source IS NOT DISTINCT FROM t.source JOIN chosen c ON s.source IS NOT DISTINCT FROM c.source
), parted AS (
  SELECT *, floor(e)::BIGINT AS whole, e - floor(e)::BIGINT AS f FROM expected
), ranked AS (
  SELECT *, CASE WHEN f > 0 THEN u / (1 - u) / (f / (1 - f)) END AS q, sum(whole * size) OVER (PARTITION BY source) AS certain FROM parted
), ordered AS (
  SELECT *, coalesce(sum(CASE WHEN f > 0 THEN size ELSE 0 END) OVER (
    PARTITION BY source ORDER BY q NULLS LAST, doc_id, d ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS before
  FROM ranked
)
SELECT doc_id, size, source_size, target,
       (whole + CASE WHEN f > 0 AND before + size / 2 <= target - certain THEN 1 ELSE 0 END) * size AS taken
FROM ordered
"""

OP10 = r"""
WITH docs AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM documents
), items AS (
  SELECT item_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w FROM benchmark
), keys AS (
  SELECT DISTINCT item_id, least(len(w), 10) AS n, array_to_string(w[pos:pos + 9], ' ') AS seq
  FROM (SELECT item_id, w, unnest(range(1, greatest(len(w) - 9, 1) + 1)) AS pos FROM items WHERE len(w) > 0)
), lengths AS (SELECT DISTINCT n FROM keys),
windows AS (
  SELECT doc_id, n, pos, array_to_string(w[pos:pos + n - 1], ' ') AS seq
  FROM (SELECT doc_id, w, n, unnest(range(1, len(w) - n + 2)) AS pos FROM docs, lengths WHERE len(w) >= n)
), hits AS (SELECT doc_id, item_id, pos, w.n FROM windows w JOIN keys k ON w.seq = k.seq AND w.n = k.n),
hit_words AS (SELECT doc_id, count(DISTINCT pos) AS n_hit FROM (SELECT doc_id, unnest(range(pos, pos + n)) AS pos FROM hits) GROUP BY doc_id),
hit_items AS (
  SELECT doc_id, count(*) AS n_items, string_agg(item, ',' ORDER BY item) AS ids FROM (SELECT DISTINCT doc_id, item_id::VARCHAR AS item FROM hits) GROUP BY doc_id
)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(n_hit, 0)::BIGINT AS n_hit, coalesce(n_items, 0)::BIGINT AS n_items,
       sha256(coalesce(ids, '')) AS items_sha256, coalesce(n_hit, 0) > 0 AS contaminated
FROM docs d LEFT JOIN hit_words USING (doc_id) LEFT JOIN hit_items USING (doc_id)
"""

OP11 = r"""
WITH docs AS (
  SELECT row_number() OVER () AS d, doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS t FROM documents
), terms AS (
  SELECT d, doc_id, unnest(regexp_extract_all(t, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM docs
), lengths AS (SELECT d, count(*) AS n FROM terms GROUP BY d),
corpus AS (SELECT count(*)::BIGINT AS docs, sum(n)::BIGINT AS total FROM lengths),
asked AS (
  SELECT DISTINCT item_id, unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                                     '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM benchmark
), counts AS (
  SELECT d, doc_id, term, count(*)::BIGINT AS tf FROM terms WHERE term IN (SELECT term FROM asked) GROUP BY d, doc_id, term
), weights AS (SELECT term, floor(1000 * ln((2 * docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM counts, corpus GROUP BY term, docs),
scores AS (
  SELECT item_id, d, doc_id, sum(w * ((1000000000::BIGINT * tf) // (1000 * tf + 8 * (100 - 90 + (90 * n * docs) // total))))::BIGINT AS score
  FROM asked JOIN weights USING (term) JOIN counts USING (term) JOIN lengths USING (d), corpus GROUP BY item_id, d, doc_id
), ranked AS (
  SELECT item_id, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST)::INT AS rank, doc_id, score FROM scores WHERE score > 0
)
SELECT * FROM ranked WHERE rank <= 10
"""

ORACLE_SQL = {
    "op1_url_filter": OP1,
    "op2_chat_format": OP2,
    "op3_embedding_near_dedup": OP3,
    "op6_substring_dedup": OP6,
    "op7_source_mixing": OP7,
    "op10_benchmark_decontamination": OP10,
    "op11_ranked_search": OP11,
}
