"""SQL that must give the rows of the queries, where SQL can."""

_WORDS = r"regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+')"

_BACKOFF = f"""
WITH d AS (SELECT row_number() OVER () AS k, doc_id, {_WORDS} AS w FROM documents),
t AS (SELECT k, i, w[i] AS w3, CASE WHEN i > 1 THEN w[i - 1] END AS w2,
             CASE WHEN i > 2 THEN w[i - 2] END AS w1
      FROM (SELECT k, w, unnest(range(1, len(w) + 1)) AS i FROM d)),
n AS (SELECT count(*) AS n FROM t),
a1 AS (SELECT w3 AS x, count(*) AS c FROM t GROUP BY ALL),
a2 AS (SELECT w2 AS x, w3 AS y, count(*) AS c FROM t WHERE i > 1 GROUP BY ALL),
a3 AS (SELECT w1 AS x, w2 AS y, w3 AS z, count(*) AS c FROM t WHERE i > 2 GROUP BY ALL),
o1 AS (SELECT k, w3 AS x, count(*) AS c FROM t GROUP BY ALL),
o2 AS (SELECT k, w2 AS x, w3 AS y, count(*) AS c FROM t WHERE i > 1 GROUP BY ALL),
o3 AS (SELECT k, w1 AS x, w2 AS y, w3 AS z, count(*) AS c FROM t WHERE i > 2 GROUP BY ALL),
e1 AS (SELECT o1.k, o1.x, a1.c - o1.c AS c FROM o1 JOIN a1 USING (x)),
e2 AS (SELECT o2.k, o2.x, o2.y, a2.c - o2.c AS c FROM o2 JOIN a2 USING (x, y)),
e3 AS (SELECT o3.k, o3.x, o3.y, o3.z, a3.c - o3.c AS c FROM o3 JOIN a3 USING (x, y, z)),
s AS (SELECT t.k, t.i, len(d.w) AS m, u.c AS c1, coalesce(b.c, 0) AS c2, coalesce(g.c, 0) AS c3,
             coalesce(u2.c, 0) AS h1, coalesce(b2.c, 0) AS h2
      FROM t JOIN d ON d.k = t.k
      JOIN e1 u ON u.k = t.k AND u.x = t.w3
      LEFT JOIN e2 b ON b.k = t.k AND b.x = t.w2 AND b.y = t.w3
      LEFT JOIN e3 g ON g.k = t.k AND g.x = t.w1 AND g.y = t.w2 AND g.z = t.w3
      LEFT JOIN e1 u2 ON u2.k = t.k AND u2.x = t.w2
      LEFT JOIN e2 b2 ON b2.k = t.k AND b2.x = t.w1 AND b2.y = t.w2),
v AS (SELECT k, CASE WHEN c3 > 0 THEN 3 WHEN c2 > 0 THEN 2 WHEN c1 > 0 THEN 1 ELSE 0 END AS level,
             log10(CASE WHEN c3 > 0 THEN c3 / greatest(h2, 1)
                        WHEN c2 > 0 THEN c2 / greatest(h1, 1) * CASE WHEN i > 2 THEN 0.4 ELSE 1.0 END
                        ELSE greatest(c1, 1) / greatest((SELECT n FROM n) - m, 1)
                             * CASE WHEN i > 2 THEN 0.4 * 0.4 WHEN i > 1 THEN 0.4 ELSE 1.0 END
                   END::DOUBLE) AS l FROM s),
p AS (SELECT k, sum(l) AS l, count(*) FILTER (level = 3) AS t3, count(*) FILTER (level = 2) AS t2,
             count(*) FILTER (level = 1) AS t1, count(*) FILTER (level = 0) AS t0 FROM v GROUP BY k)
SELECT d.doc_id, len(d.w)::BIGINT AS n_words, coalesce(t3, 0)::BIGINT AS n_trigram,
       coalesce(t2, 0)::BIGINT AS n_bigram, coalesce(t1, 0)::BIGINT AS n_unigram,
       coalesce(t0, 0)::BIGINT AS n_unseen, round(l / len(d.w), 6) AS mean_log10
FROM d LEFT JOIN p USING (k)
"""

_WARC = """
WITH p AS (SELECT page_id, coalesce(html, '') AS h FROM pages),
x AS (SELECT page_id, octet_length(encode(h))::BIGINT AS payload_bytes,
             list_transform(range(8), lambda g: ('0x' || sha1(h)[5 * g + 1:5 * g + 5])::INTEGER) AS v FROM p),
b AS (SELECT page_id, payload_bytes, array_to_string(list_transform(v, lambda n: array_to_string(
             list_transform([32768, 1024, 32, 1], lambda q: 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567'[(n // q) % 32 + 1]), '')), '')
             AS payload_digest FROM x),
f AS (SELECT *, min(page_id) OVER (PARTITION BY payload_digest) AS m FROM b)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM m OR m IS NULL THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS DISTINCT FROM m THEN m END AS refers_to
FROM f
"""

_PREFERENCE = """
WITH r AS (SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
                  row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''),
                                     coalesce(text, '')) AS i FROM conversations),
l AS (SELECT conv_id, max(i) AS n, max(i) FILTER (role = 'assistant') AS last FROM r GROUP BY conv_id),
a AS (SELECT l.conv_id - 1 AS conv_id, r.text AS answer FROM l JOIN r ON r.conv_id = l.conv_id AND r.i = l.last),
w AS (SELECT r.conv_id, r.i, r.role, CASE WHEN r.i = l.last THEN coalesce(a.answer, '') ELSE r.text END AS text
      FROM r JOIN l USING (conv_id) LEFT JOIN a ON a.conv_id = r.conv_id
      WHERE l.last IS NULL OR r.i <= l.last),
m AS (SELECT l.conv_id, least(l.n, coalesce(l.last, l.n)) AS both_n,
             min(r.i) FILTER (r.text <> w.text) AS first
      FROM l JOIN r USING (conv_id) JOIN w ON w.conv_id = r.conv_id AND w.i = r.i GROUP BY ALL),
k AS (SELECT conv_id, coalesce(first - 1, both_n) AS n_common FROM m),
s AS (SELECT *, '<|' || role || '|>' || chr(10) AS head FROM
      (SELECT 'c' AS side, * FROM r UNION ALL SELECT 'r', conv_id, role, text, i FROM w)),
t AS (SELECT s.*, n_common, head || text || '<|end|>' || chr(10) AS shown FROM s JOIN k USING (conv_id)),
o AS (SELECT *, sum(length(shown)) OVER (PARTITION BY conv_id, side, i > n_common ORDER BY i) AS stop FROM t),
q AS (SELECT conv_id, side, n_common,
             coalesce(string_agg(shown, '' ORDER BY i) FILTER (i <= n_common), '') AS prompt,
             coalesce(string_agg(shown, '' ORDER BY i) FILTER (i > n_common), '') AS tail,
             coalesce(string_agg((stop - length(shown) + length(head))::BIGINT || '-' || (stop - 0)::BIGINT, ',' ORDER BY i)
                      FILTER (i > n_common AND role = 'assistant'), '') AS mask
      FROM o GROUP BY ALL)
SELECT c.conv_id, c.n_common::INTEGER AS n_common, c.prompt, c.tail AS chosen, c.mask AS chosen_mask,
       coalesce(x.tail, '') AS rejected, coalesce(x.mask, '') AS rejected_mask
FROM q c LEFT JOIN q x ON x.conv_id = c.conv_id AND x.side = 'r' WHERE c.side = 'c'
"""

SQL: dict[str, str] = {"op6_backoff": _BACKOFF, "op7_warc": _WARC, "op10_preference": _PREFERENCE}


def _centroids(rounds: int = 3, k: int = 16) -> str:
    """Every distance spelled out, round by round."""
    parts = [
        "kept AS (SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(64 * CAST(x AS DOUBLE)) AS BIGINT)) AS v "
        "FROM embeddings WHERE len(embedding) = 64 AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0)",
        f"c0 AS (SELECT row_number() OVER (ORDER BY sha256('1:' || vec_id), v) - 1 AS n, v FROM kept "
        f"QUALIFY n < {k})"]
    for i in range(rounds + 1):
        parts.append(
            f"a{i} AS (SELECT vec_id, kept.v AS v, min({{'d': list_sum(list_transform(list_zip(kept.v, c{i}.v), "
            f"lambda p: (p[1] - p[2]) * (p[1] - p[2]))), 'n': n}}) AS b FROM kept, c{i} GROUP BY vec_id, kept.v)")
        if i < rounds:
            parts.append(
                f"m{i} AS (SELECT n, list(x ORDER BY place) AS v FROM (SELECT b.n AS n, place, "
                f"CAST(floor(CAST(sum(v[place]) AS DOUBLE) / count(*)) AS BIGINT) AS x "
                f"FROM a{i}, (SELECT unnest(range(1, 65)) AS place) GROUP BY b.n, place) GROUP BY n)")
            parts.append(f"c{i + 1} AS (SELECT c{i}.n AS n, coalesce(m{i}.v, c{i}.v) AS v FROM c{i} LEFT JOIN m{i} ON c{i}.n = m{i}.n)")
    return "WITH " + ", ".join(parts) + (
        f" SELECT vec_id, CAST(b.n AS INTEGER) AS cluster, CAST(b.d AS BIGINT) AS distance, "
        f"CAST(sum(b.d) OVER (PARTITION BY b.n) AS BIGINT) AS cluster_inertia, CAST(sum(b.d) OVER () AS BIGINT) AS inertia, "
        f"sha256(array_to_string(c{rounds}.v, ',')) AS centroid_sha256 FROM a{rounds} JOIN c{rounds} ON b.n = c{rounds}.n")


SQL["op11_centroids"] = _centroids()
