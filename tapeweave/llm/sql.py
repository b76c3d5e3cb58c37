"""DuckDB SQL for the queries that SQL can express."""

_TRIM = "' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)"
_AZ = "'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'"

_TERMS = f"regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+')"

SQL = {
    "op1_line_dedup": f"""WITH l AS (
        SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
               generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS pos FROM documents),
      k AS (SELECT *, translate(trim(line, {_TRIM}), {_AZ}) AS key FROM l),
      m AS (SELECT *, length(key) >= 10 AND doc_id > min(doc_id) OVER (PARTITION BY key) AS dropped FROM k)
      SELECT doc_id, count(*) AS n_lines, count(*) FILTER (dropped) AS n_dropped,
             sha256(coalesce(string_agg(line, chr(10) ORDER BY pos) FILTER (NOT dropped), '')) AS kept_sha256
      FROM m GROUP BY doc_id""",
    "op2_jaccard_join": f"""WITH RECURSIVE w AS (
        SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), {_AZ}), '[^ \\t\\n\\x0B\\f\\r]+') AS w FROM documents),
      s AS (SELECT doc_id, list_distinct(list_transform(range(1, CASE WHEN len(w) = 0 THEN 1
              ELSE greatest(len(w) - 3, 1) + 1 END), lambda i: array_to_string(w[i:i + 3], ' '))) AS s FROM w),
      g AS (SELECT doc_id, unnest(s) AS g FROM s),
      c AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM g a JOIN g b ON a.g = b.g AND a.doc_id <> b.doc_id
            GROUP BY a.doc_id, b.doc_id),
      l AS (SELECT c.a, c.b FROM c JOIN s x ON x.doc_id = c.a JOIN s y ON y.doc_id = c.b
            WHERE 100 * c.n >= 85 * (len(x.s) + len(y.s) - c.n)),
      r AS (SELECT doc_id, doc_id AS c FROM s UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.doc_id)
      SELECT s.doc_id, len(any_value(s.s)) AS n_shingles, min(r.c) AS component_id
      FROM s JOIN r USING (doc_id) GROUP BY s.doc_id""",
    "op4_embedding_forest": """WITH RECURSIVE v AS (
        SELECT vec_id, embedding::DOUBLE[] AS e FROM embeddings),
      ok AS (SELECT * FROM v WHERE e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0
             AND len(list_filter(e, lambda x: x <> 0)) > 0),
      l AS (SELECT a.vec_id AS a, b.vec_id AS b FROM ok a JOIN ok b
            ON a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
      r AS (SELECT vec_id, vec_id AS c FROM v UNION SELECT l.b, r.c FROM r JOIN l ON l.a = r.vec_id),
      n AS (SELECT a AS vec_id, count(*) AS n FROM l GROUP BY a)
      SELECT v.vec_id, coalesce(any_value(n.n), 0) AS n_links, min(r.c) AS component_id, v.vec_id = min(r.c) AS kept
      FROM v JOIN r USING (vec_id) LEFT JOIN n USING (vec_id) GROUP BY v.vec_id""",
    "op10_warc": """WITH p AS (SELECT page_id, encode(coalesce(html, '')) AS payload FROM pages),
      d AS (SELECT page_id, octet_length(payload) AS payload_bytes, sha1(payload) AS sha FROM p),
      b AS (SELECT *, CAST(unhex(sha) AS BIT)::VARCHAR AS bits FROM d),
      e AS (SELECT page_id, payload_bytes, sha, array_to_string(list_transform(range(0, 32), lambda i:
              substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567', CAST(1
                + 16 * CAST(substr(bits, i * 5 + 1, 1) AS INT) + 8 * CAST(substr(bits, i * 5 + 2, 1) AS INT)
                + 4 * CAST(substr(bits, i * 5 + 3, 1) AS INT) + 2 * CAST(substr(bits, i * 5 + 4, 1) AS INT)
                + CAST(substr(bits, i * 5 + 5, 1) AS INT) AS INT), 1)), '') AS payload_digest FROM b),
      m AS (SELECT *, max(page_id) OVER (PARTITION BY sha, payload_bytes) AS top FROM e)
      SELECT page_id, payload_bytes, payload_digest, CASE WHEN page_id = top THEN 'response' ELSE 'revisit' END AS record_type,
             CASE WHEN page_id <> top THEN top END AS refers_to FROM m""",
    "op11_hard_negatives": """WITH v AS (
        SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label, embedding::DOUBLE[] AS e
        FROM embeddings),
      p AS (SELECT vec_id, label, list_transform(e, lambda x: floor(256 * x)) AS q FROM v WHERE label IS NOT NULL
            AND e IS NOT NULL AND len(list_filter(e, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
      s AS (SELECT a.vec_id AS a, b.vec_id AS b, a.label = b.label AS same, CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
            FROM p a JOIN p b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id),
      pos AS (SELECT * FROM s WHERE same QUALIFY row_number() OVER (PARTITION BY a ORDER BY score DESC, b) <= 5)
      SELECT pos.a AS anchor_id, pos.b AS positive_id,
             CAST(row_number() OVER (PARTITION BY pos.a, pos.b ORDER BY s.score DESC, s.b) AS INTEGER) AS rank,
             s.b AS negative_id, pos.score AS positive_score, s.score AS negative_score
      FROM pos JOIN s ON s.a = pos.a AND NOT s.same AND 50 * pos.score <= 100 * s.score AND 100 * s.score <= 95 * pos.score
      QUALIFY rank <= 3""",
    "op12_exact_dedup": """WITH d AS (SELECT doc_id, coalesce(text, '') AS t FROM documents)
      SELECT doc_id, max(doc_id) OVER (PARTITION BY t) AS keep_id, count(*) OVER (PARTITION BY t) AS group_size,
             doc_id = max(doc_id) OVER (PARTITION BY t) AS kept, sha256(t) AS text_sha256 FROM d""",
    "op13_lexical_search": f"""WITH d AS (SELECT doc_id, {_TERMS} AS w FROM documents),
      s AS (SELECT count(*) FILTER (len(w) > 0) AS n, CAST(sum(len(w)) AS BIGINT) AS l FROM d),
      i AS (SELECT item_id, unnest(list_distinct({_TERMS})) AS t FROM benchmark),
      o AS (SELECT doc_id, len(w) AS n, unnest(w) AS t FROM d),
      p AS (SELECT doc_id, t, any_value(n) AS n, count(*) AS tf FROM o WHERE t IN (SELECT t FROM i) GROUP BY doc_id, t),
      f AS (SELECT t, CAST(floor(1000 * ln((2 * s.n + 2) / (2 * count(*) + 1))) AS BIGINT) AS w FROM p, s GROUP BY t, s.n),
      q AS (SELECT p.doc_id, p.t, f.w * ((1000000000 * p.tf) // (1000 * p.tf + 8 * (10 + (90 * p.n * s.n) // s.l))) AS v
            FROM p JOIN f USING (t), s),
      r AS (SELECT i.item_id, q.doc_id, CAST(sum(q.v) AS BIGINT) AS score FROM i JOIN q USING (t) GROUP BY i.item_id, q.doc_id)
      SELECT item_id, CAST(row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id) AS INTEGER) AS rank,
             doc_id, score FROM r WHERE score > 0 QUALIFY rank <= 10""",
}
