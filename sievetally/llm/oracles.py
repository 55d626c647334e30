"""The queries that SQL can express, as DuckDB SQL over the given tables."""

from __future__ import annotations

# Places in a text are sums of the lengths of finds and of what stands between them.
_FINDS = """
            SELECT r, {place} AS place, '{name}' AS kind, unnest(list_transform(range(1, len(h) + 1), lambda i: {{
                'start': coalesce(list_sum(list_transform(g[1:i], lambda x: length(x))), 0) + coalesce(list_sum(list_transform(h[1:i - 1], lambda x: length(x))), 0),
                'find': h[i], 'value': v[i]}})) AS f
            FROM (SELECT r, regexp_extract_all(x, '{pattern}') AS h, regexp_split_to_array(x, '{pattern}') AS g, regexp_extract_all(x, '{pattern}', {group}) AS v FROM d)
            WHERE len(h) > 0"""
_WORDS = "[Pp][Aa][Ss][Ss][Ww][Oo][Rr][Dd]|[Pp][Aa][Ss][Ss][Ww][Dd]|[Ss][Ee][Cc][Rr][Ee][Tt]|[Tt][Oo][Kk][Ee][Nn]|[Aa][Pp][Ii]_?[Kk][Ee][Yy]"
_RULES = [
    ("assign", rf"""({_WORDS})["'']?\x20*[:=]\x20*["'']?([A-Za-z0-9+/_.=-]+)""", 2, 8),
    ("access", r"AKIA[A-Z0-9]+", 0, 16),
    ("hex", r"[0-9a-f]{32,}", 0, 32),
    ("private_key", r"-----BEGIN ([A-Z]+ ){0,3}PRIVATE KEY-----", 0, 1),
    ("web_token", r"eyJ[A-Za-z0-9_-]{8,}\.eyJ[A-Za-z0-9_-]{8,}\.[A-Za-z0-9_-]{8,}", 0, 1),
]
SECRETS = f"""
        WITH d AS MATERIALIZED (SELECT row_number() OVER () AS r, doc_id, coalesce(text, '') AS x FROM documents),
        s AS ({" UNION ALL ".join(f"SELECT * FROM ({_FINDS.format(place=k, name=name, pattern=pattern, group=group)}) WHERE length(f.value) >= {least}" for k, (name, pattern, group, least) in enumerate(_RULES))}),
        j AS (
            SELECT r, count_if(place = 0) AS n_assign, count_if(place = 1) AS n_access, count_if(place = 2) AS n_hex,
                   string_agg(kind || ':' || f.start || ':' || (f.start + length(f.find)), ',' ORDER BY f.start, place) FILTER (WHERE place < 3) AS base,
                   string_agg(kind || ':' || f.start || ':' || (f.start + length(f.find)), ',' ORDER BY f.start, place) AS spans
            FROM s GROUP BY r
        )
        SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access, coalesce(n_hex, 0)::BIGINT AS n_hex,
               sha256(coalesce(base, '')) AS base_sha256, coalesce(spans, '') AS spans
        FROM d LEFT JOIN j USING (r)
    """

ORACLES = {
    "op2_topk": """
        WITH q AS (
            SELECT vec_id, list_transform(embedding, lambda x: CAST(floor(256 * CAST(x AS DOUBLE)) AS BIGINT)) AS v
            FROM embeddings
            WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
        ), scored AS (
            SELECT a.vec_id AS query_id, b.vec_id,
                   CAST(list_sum(list_transform(list_zip(a.v, b.v), lambda p: p[1] * p[2])) AS BIGINT) AS score
            FROM q a JOIN q b ON a.vec_id % 50 = 0 AND a.vec_id <> b.vec_id
        )
        SELECT query_id, CAST(row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS INT) AS rank, vec_id, score
        FROM scored QUALIFY rank <= 5
    """,
    "op4_near_vectors": """
        WITH RECURSIVE v AS (
            SELECT vec_id, label, list_transform(embedding, lambda x: CAST(x AS DOUBLE)) AS v
            FROM embeddings
            WHERE label IS NOT NULL AND embedding IS NOT NULL
              AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(embedding, lambda x: x <> 0)) > 0
        ), links AS MATERIALIZED (
            SELECT a.vec_id AS a, b.vec_id AS b
            FROM v a JOIN v b ON a.label = b.label AND a.vec_id <> b.vec_id AND len(a.v) = len(b.v)
            WHERE list_cosine_similarity(a.v, b.v) >= 0.98
        ), reach(a, b) AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a),
        n AS (SELECT a, count(*) AS n_links FROM links GROUP BY a)
        SELECT vec_id, coalesce(n_links, 0) AS n_links, coalesce(component_id, vec_id) AS component_id,
               coalesce(component_id, vec_id) = vec_id AS kept
        FROM embeddings e LEFT JOIN n ON n.a = e.vec_id LEFT JOIN least ON least.a = e.vec_id
    """,
    "op9_warc": """
        WITH p AS (
            SELECT page_id, octet_length(encode(coalesce(html, ''))) AS payload_bytes, sha1(coalesce(html, '')) AS hex
            FROM pages
        ), d AS (
            SELECT page_id, payload_bytes, min(page_id) OVER (PARTITION BY hex) AS first,
                   list_aggregate(list_transform(range(8), lambda g: list_aggregate(list_transform(range(4), lambda i:
                       substr('ABCDEFGHIJKLMNOPQRSTUVWXYZ234567',
                              1 + ((CAST('0x' || substr(hex, CAST(5 * g + 1 AS INT), 5) AS BIGINT) >> CAST(15 - 5 * i AS INT)) & 31)::INT, 1)),
                       'string_agg', '')), 'string_agg', '') AS payload_digest
            FROM p
        )
        SELECT page_id, payload_bytes, payload_digest, if(page_id = first, 'response', 'revisit') AS record_type,
               if(page_id = first, NULL, first) AS refers_to
        FROM d
    """,
    "op10_jaccard": r"""
        WITH RECURSIVE w AS (
            SELECT doc_id, list_filter(regexp_split_to_array(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[\x20\x09-\x0D]+'), lambda x: x <> '') AS w
            FROM documents
        ), s AS MATERIALIZED (
            SELECT doc_id, list_distinct(CASE
                WHEN len(w) = 0 THEN []
                WHEN len(w) < 5 THEN [array_to_string(w, ' ')]
                ELSE list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')) END) AS s
            FROM w
        ), u AS MATERIALIZED (SELECT doc_id, len(s) AS n, hash(x) AS x FROM (SELECT doc_id, s, unnest(s) AS x FROM s)),
        links AS MATERIALIZED (
            SELECT a.doc_id AS a, b.doc_id AS b
            FROM u a JOIN u b ON a.x = b.x AND a.doc_id <> b.doc_id AND 4 * least(a.n, b.n) >= 3 * greatest(a.n, b.n)
            GROUP BY a.doc_id, b.doc_id, a.n, b.n
            HAVING 100 * count(*) >= 75 * (a.n + b.n - count(*))
        ), reach(a, b) AS (
            SELECT a, b FROM links
            UNION
            SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
        ), least AS (SELECT a, least(a, min(b)) AS component_id FROM reach GROUP BY a)
        SELECT doc_id, len(s) AS n_shingles, coalesce(component_id, doc_id) AS component_id
        FROM s LEFT JOIN least ON a = doc_id
    """,
    "op11_ranking": r"""
        WITH d AS MATERIALIZED (
            SELECT row_number() OVER () AS r, doc_id, regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents WHERE text IS NOT NULL
        ), size AS (SELECT count(*) AS n_docs, sum(len(w))::BIGINT AS n_terms FROM d WHERE len(w) > 0),
        t AS MATERIALIZED (
            SELECT r, doc_id, n, term, count(*) AS tf FROM (SELECT r, doc_id, len(w) AS n, unnest(w) AS term FROM d) GROUP BY ALL
        ), i AS (
            SELECT DISTINCT row, item_id, term FROM (
                SELECT row_number() OVER () AS row, item_id, unnest(regexp_extract_all(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')) AS term
                FROM benchmark)
        ), w AS (
            SELECT term, floor(1000 * ln((2 * n_docs + 2)::DOUBLE / (2 * count(*) + 1)::DOUBLE))::BIGINT AS w FROM t, size GROUP BY term, n_docs
        ), scored AS (
            SELECT row, item_id, r, doc_id, sum(w * ((1000000000 * tf) // (1000 * tf + 8 * (10 + (90 * n * n_docs) // n_terms))))::BIGINT AS score
            FROM i JOIN w USING (term) JOIN t USING (term), size
            GROUP BY row, item_id, r, doc_id
        )
        SELECT item_id, CAST(row_number() OVER (PARTITION BY row ORDER BY score DESC, doc_id) AS INT) AS rank, doc_id, score
        FROM scored WHERE score > 0 QUALIFY rank <= 10
    """,
    "op12_sources": r"""
        WITH d AS (
            SELECT row_number() OVER () AS r, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                   regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x00-\x40\x5B-\x60\x7B-\x7F]+') AS w
            FROM documents
        ), t AS MATERIALIZED (SELECT r, lang, source, unnest(w) AS term FROM d),
        kept AS MATERIALIZED (SELECT lang, term, count(*) AS n FROM t GROUP BY ALL HAVING count(DISTINCT r) >= 10),
        v AS (SELECT lang, count(*)::HUGEINT AS v, sum(n)::HUGEINT AS n FROM kept GROUP BY lang),
        c AS MATERIALIZED (SELECT lang, source, term, count(*) AS n FROM t SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        g AS (SELECT lang, source, coalesce(n, 0)::HUGEINT AS n FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT lang, source, sum(n) AS n FROM c GROUP BY ALL) USING (lang, source)),
        p AS MATERIALIZED (
            SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS count,
                   1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.n + 2 * v.v) AS p,
                   1 + (1000000000::HUGEINT * (k.n + 2)) // (v.n + 2 * v.v) AS q
            FROM g JOIN v USING (lang) JOIN kept k USING (lang) LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
        ), pairs AS (
            SELECT a.lang, a.source, b.source AS item, coalesce(value, 0) AS value
            FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN (
                SELECT x.lang AS l, x.source AS s, y.source AS o, sum(((x.p - y.p) * (x.p - y.p)) // (x.p + y.p)) AS value
                FROM p x JOIN p y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
            ) ON l = a.lang AND s = a.source AND o = b.source
        ), items AS (
            SELECT lang, source, 'pair' AS part, item, value FROM pairs
            UNION ALL SELECT lang, source, 'term', term, ((p - q) * (p - q)) // (p + q) FROM p WHERE count > 0 AND p > q
        )
        SELECT lang, source, part, item, CAST(value AS BIGINT) AS value,
               CAST(row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item)) AS INT) AS rank
        FROM items QUALIFY part = 'pair' OR rank <= 10
    """,
    "op13_secrets": SECRETS,
}
