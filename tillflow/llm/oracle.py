"""The queries in DuckDB's SQL, where SQL can express them."""

from __future__ import annotations

OP1 = r"""
WITH texts AS (
  SELECT 'd' AS kind, doc_id AS id, text FROM documents
  UNION ALL
  SELECT 'b', item_id, text FROM benchmark
), words AS (
  SELECT kind, id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda w: w <> '') AS w
  FROM texts
), shingles AS (
  SELECT DISTINCT kind, id, len(w) AS n, array_to_string(w[i : i + 4], ' ') AS shingle
  FROM words, LATERAL (SELECT unnest(range(1, len(w) - 3)) AS i)
  WHERE len(w) >= 5
), items AS (
  SELECT id, shingle, count(*) OVER (PARTITION BY id) AS n_item FROM shingles WHERE kind = 'b'
)
SELECT d.id AS doc_id, i.id AS item_id, count(*) AS n_shared, any_value(n_item) AS n_item
FROM items AS i JOIN shingles AS d ON d.kind = 'd' AND d.shingle = i.shingle
GROUP BY d.id, i.id HAVING 100 * count(*) >= 80 * any_value(n_item)
"""

REPEATS = r"""
WITH d AS (
  SELECT doc_id, list_filter(string_split_regex(coalesce(text, ''), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w FROM documents
), windows AS (
  SELECT doc_id, i, md5(array_to_string(w[i : i + 49], ' ')) AS k
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM d WHERE len(w) >= 50)
), firsts AS (
  SELECT k, min(doc_id) AS low FROM windows GROUP BY k
), covered AS (
  SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS place FROM windows JOIN firsts USING (k) WHERE low < doc_id
), kept AS (
  SELECT doc_id, count(*) AS n, string_agg(word, ' ' ORDER BY place) AS text
  FROM (SELECT doc_id, unnest(w) AS word, unnest(range(1, len(w) + 1)) AS place FROM d) ANTI JOIN covered USING (doc_id, place)
  GROUP BY doc_id
)
SELECT doc_id, len(w) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(text, '')) AS kept_sha256
FROM d LEFT JOIN kept USING (doc_id)
"""

OP4 = r"""
WITH p AS (SELECT page_id, url, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS n FROM pages),
g AS (SELECT html, max(page_id) AS last FROM p WHERE n >= 1000 GROUP BY html)
SELECT page_id, n AS payload_bytes, sha1(p.html) AS payload_digest,
       CASE WHEN page_id < last THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN page_id < last THEN last END AS refers_to, url
FROM p LEFT JOIN g ON p.html = g.html
"""

OP5 = r"""
WITH d AS (
  SELECT doc_id, coalesce(text, '') AS t, length(coalesce(text, '')) AS n,
         sha256(regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g')) AS sha
  FROM documents
), g AS (
  SELECT sha, arg_min(doc_id, (-n, doc_id)) AS keep_id, max(n) AS most, count(*) AS group_size FROM d GROUP BY sha
)
SELECT doc_id, keep_id, group_size, doc_id = keep_id AND n = most AS kept, sha AS text_sha256 FROM d JOIN g USING (sha)
"""

OP8 = r"""
WITH RECURSIVE d AS (
  SELECT doc_id, list_filter(string_split_regex(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
  FROM documents
), s AS (
  SELECT DISTINCT doc_id, unnest(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i : i + 4], ' '))
                                      WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS shingle
  FROM d
), n AS (
  SELECT doc_id, count(*) AS n FROM s GROUP BY doc_id
), shared AS (
  SELECT x.doc_id AS a, y.doc_id AS b, count(*) AS c FROM s AS x JOIN s AS y USING (shingle) WHERE x.doc_id <> y.doc_id GROUP BY ALL
), links AS (
  SELECT a, b FROM shared JOIN n AS x ON x.doc_id = a JOIN n AS y ON y.doc_id = b WHERE 100 * c >= 80 * (x.n + y.n - c)
), reached(doc_id, root) AS (
  SELECT doc_id, doc_id FROM d UNION SELECT reached.doc_id, b FROM reached JOIN links ON root = a
)
SELECT doc_id, coalesce(any_value(n), 0) AS n_shingles, min(root) AS component_id FROM reached LEFT JOIN n USING (doc_id) GROUP BY doc_id
"""

OP13 = r"""
WITH d AS (
  SELECT doc_id, coalesce(lang, '') AS part, coalesce(text, '') AS t,
         regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w
  FROM documents
), l AS (
  SELECT doc_id, max(quality) = 1 AS good, max(toxic) = 1 AS toxic FROM labels GROUP BY doc_id
), failing AS (
  SELECT part, coalesce(good, false) AS good, coalesce(toxic, false) AS toxic, {
    'A': len(w) < 200,
    'B': 100 * len(list_distinct(w)) < 50 * len(w),
    'C': 100 * length(regexp_replace(t, '[^A-Z]', '', 'g')) > 3 * length(t),
    'D': regexp_matches(t, '[#$%&*|]'),
    'E': doc_id > min(doc_id) OVER (PARTITION BY t)
  } AS fails
  FROM d LEFT JOIN l USING (doc_id)
), masks AS (
  SELECT part, list_filter(['A', 'B', 'C', 'D', 'E'], lambda f: CASE f WHEN 'A' THEN fails.A WHEN 'B' THEN fails.B WHEN 'C' THEN fails.C WHEN 'D' THEN fails.D ELSE fails.E END) AS mask,
         count(*) AS n, count(*) FILTER (WHERE good) AS good, count(*) FILTER (WHERE toxic) AS toxic
  FROM failing GROUP BY ALL
), letters AS (
  SELECT unnest(['A', 'B', 'C', 'D', 'E']) AS f
), orders AS (
  SELECT [a.f, b.f, c.f, d.f, e.f] AS o
  FROM letters a, letters b, letters c, letters d, letters e
  WHERE len(list_distinct([a.f, b.f, c.f, d.f, e.f])) = 5
), steps AS (
  SELECT o, unnest([1, 2, 3, 4, 5]) AS step FROM orders
), placed AS (
  SELECT part, array_to_string(o, '') AS filter_order, step, o[step] AS f,
         sum(n) FILTER (WHERE NOT list_has_any(mask, o[1 : step])) AS kept,
         sum(n) FILTER (WHERE list_contains(mask, o[step]) AND NOT list_has_any(mask, o[1 : step - 1])) AS removed,
         sum(n) FILTER (WHERE list_contains(mask, o[step]) AND list_has_any(mask, o[1 : step - 1])) AS redundant,
         sum(n) FILTER (WHERE mask = [o[step]]) AS unique_fails,
         sum(good) FILTER (WHERE list_contains(mask, o[step]) AND NOT list_has_any(mask, o[1 : step - 1])) AS good_lost,
         sum(toxic) FILTER (WHERE list_contains(mask, o[step]) AND NOT list_has_any(mask, o[1 : step - 1])) AS toxic_lost
  FROM masks, steps GROUP BY ALL
)
SELECT part, filter_order, step::INTEGER AS step, coalesce(kept, 0)::BIGINT AS kept, coalesce(removed, 0)::BIGINT AS removed,
       coalesce(redundant, 0)::BIGINT AS redundant, coalesce(unique_fails, 0)::BIGINT AS unique_fails, coalesce(good_lost, 0)::BIGINT AS good_lost,
       coalesce(toxic_lost, 0)::BIGINT AS toxic_lost, coalesce(sum(removed) OVER (PARTITION BY part, f), 0)::BIGINT AS shapley
FROM placed
"""


def op12(rounds: int = 10) -> str:
    """Plain k-means, a pair of tables for each round."""
    tables = [r"""kept AS MATERIALIZED (
  SELECT row_number() OVER () AS r, vec_id, list_transform(embedding, lambda x: floor(1024 * x::DOUBLE)::BIGINT) AS v, sha256('3:' || vec_id) AS h
  FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NOT NULL AND isfinite(x))) = 64
)""", """c0 AS MATERIALIZED (SELECT row_number() OVER (ORDER BY h, v) - 1 AS c, v FROM kept ORDER BY h, v LIMIT 8)"""]
    for i in range(rounds + 1):
        tables.append(f"""a{i} AS MATERIALIZED (
  SELECT r, arg_min(c, (d, c)) AS c, min(d) AS d
  FROM (SELECT r, c, list_sum(list_transform(list_zip(kept.v, c{i}.v), lambda p: (p[1] - p[2]) * (p[1] - p[2])))::BIGINT AS d FROM kept, c{i}) GROUP BY r
)""")
        if i < rounds:
            tables.append(f"""c{i + 1} AS MATERIALIZED (
  SELECT c, list(m ORDER BY j) AS v FROM (
    SELECT c, j, ((sum(x) - ((sum(x) % count(*)) + count(*)) % count(*)) // count(*))::BIGINT AS m
    FROM (SELECT c, unnest(v) AS x, unnest(range(64)) AS j FROM a{i} JOIN kept USING (r)) GROUP BY c, j
  ) GROUP BY c
  UNION ALL SELECT c, v FROM c{i} WHERE c NOT IN (SELECT c FROM a{i})
)""")
    return f"""WITH {", ".join(tables)}
SELECT vec_id, c::INTEGER AS cluster, d AS distance, (sum(d) OVER (PARTITION BY c))::BIGINT AS cluster_inertia, (sum(d) OVER ())::BIGINT AS inertia,
       sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256
FROM a{rounds} JOIN kept USING (r) JOIN c{rounds} USING (c)"""


def build() -> dict[str, str]:
    return {"op1_decontamination": OP1, "op3_recompression_dedup": REPEATS, "op4_warc": OP4, "op5_exact_dedup": OP5, "op8_jaccard_join": OP8, "op10_sparse_suffixes": f"SELECT * FROM ({REPEATS}) WHERE n_removed > 0", "op12_clustering": op12(), "op13_filter_audit": OP13}
