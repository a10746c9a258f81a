"""DuckDB SQL for the queries of this subpackage that SQL can express."""

LLM_ORACLE_SQL: dict[str, str] = {
    # the same frequencies over whole tables: pages are distinct (source, text)
    "op5_line_dedup": r"""
        WITH d AS (SELECT doc_id, source, text, coalesce(text, '') AS body FROM documents),
        page AS (SELECT DISTINCT source, body FROM d),
        total AS (SELECT source, count(*) AS total FROM page GROUP BY source),
        part AS (SELECT source, body, unnest(string_split(body, chr(10))) AS line FROM page),
        uses AS (SELECT DISTINCT source, body, trim(line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) AS k FROM part),
        freq AS (SELECT u.source, u.k, count(*) AS pages FROM uses u WHERE u.k <> '' GROUP BY u.source, u.k),
        boil AS (SELECT f.source, f.k FROM freq f JOIN total t ON f.source IS NOT DISTINCT FROM t.source
                 WHERE f.pages > 0.02 * t.total AND f.pages >= 3),
        numbered AS (SELECT source, body, unnest(string_split(body, chr(10))) AS line,
                            generate_subscripts(string_split(body, chr(10)), 1) AS pos FROM page),
        marked AS (SELECT n.*, b.k IS NOT NULL AS gone,
                          trim(n.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) <> '' AS filled
                   FROM numbered n LEFT JOIN boil b ON n.source IS NOT DISTINCT FROM b.source
                    AND trim(n.line, ' ' || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)) = b.k),
        rebuilt AS (SELECT source, body, count(*) AS n_lines,
                           count(*) FILTER (WHERE gone) AS gone,
                           bool_or(filled AND NOT gone) AS stays,
                           string_agg(line, chr(10) ORDER BY pos) FILTER (WHERE NOT gone) AS text
                    FROM marked GROUP BY source, body)
        SELECT d.doc_id,
               CASE WHEN d.text IS NULL THEN 0 ELSE r.n_lines END AS n_lines,
               CASE WHEN r.stays THEN r.gone ELSE 0 END AS n_dropped,
               md5(CASE WHEN r.stays AND r.gone > 0 THEN r.text ELSE d.text END) AS text_md5
        FROM d JOIN rebuilt r ON d.source IS NOT DISTINCT FROM r.source AND d.body = r.body""",
    # plain comparisons of every url with every rule
    "op11_url_filter": r"""
        WITH rules(rh, rp, verdict) AS (VALUES ('com', '/', 'allow'), ('example.com', '/en/', 'block'),
                 ('www.example.com', '/en/', 'allow'), ('net', '/es/', 'block'), ('net', '/fr/', 'block')),
        rest AS (SELECT page_id, CASE WHEN strpos(url, '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS r
                 FROM pages),
        bare AS (SELECT page_id, string_split(string_split(r, '?')[1], '#')[1] AS r FROM rest),
        urls AS (SELECT page_id,
                        translate(string_split(r, '/')[1], 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
                        CASE WHEN strpos(r, '/') > 0 THEN substr(r, strpos(r, '/')) ELSE '' END AS path FROM bare),
        best AS (SELECT u.page_id, u.host, u.path, arg_max(k.rh || k.rp, length(k.rh || k.rp)) AS rule,
                        arg_max(k.verdict, length(k.rh || k.rp)) AS verdict
                 FROM (SELECT DISTINCT page_id, host, path FROM urls) u
                 JOIN rules k ON (u.host = k.rh OR ends_with(u.host, '.' || k.rh)) AND starts_with(u.path, k.rp)
                 GROUP BY ALL)
        SELECT u.page_id, u.host, u.path, b.rule, coalesce(b.verdict, 'allow') AS verdict
        FROM urls u LEFT JOIN best b USING (page_id, host, path)""",
    # dense: every source, or language, with every kept term
    "op13_source_divergence": r"""
        WITH d AS (SELECT row_number() OVER () AS row_id, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
                          translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
                   FROM documents),
        word AS (SELECT row_id, lang, source,
                        unnest(regexp_extract_all(text, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d),
        kept AS (SELECT lang, term FROM word GROUP BY lang, term HAVING count(DISTINCT row_id) >= 3),
        v AS (SELECT lang, count(*) AS v FROM kept GROUP BY lang),
        src AS (SELECT DISTINCT lang, source FROM d),
        cnt AS (SELECT lang, source, term, count(*) AS c FROM word SEMI JOIN kept USING (lang, term) GROUP BY ALL),
        dense AS (SELECT s.lang, s.source, k.term, coalesce(c.c, 0)::HUGEINT AS c
                  FROM src s JOIN kept k USING (lang) LEFT JOIN cnt c USING (lang, source, term)),
        p AS (SELECT lang, source, term, c, 1 + (1000000000::HUGEINT * (c + 1)) //
                     (sum(c) OVER (PARTITION BY lang, source) + v)::HUGEINT AS p FROM dense JOIN v USING (lang)),
        whole AS (SELECT lang, term, sum(c)::HUGEINT AS c FROM dense GROUP BY ALL),
        q AS (SELECT lang, term, 1 + (1000000000::HUGEINT * (c + 1)) //
                     (sum(c) OVER (PARTITION BY lang) + v)::HUGEINT AS q FROM whole JOIN v USING (lang)),
        f AS (SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // b.p) AS value
              FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL),
        pair AS (SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(f.value, 0)::BIGINT AS value
                 FROM src a JOIN src b ON a.lang = b.lang AND a.source <> b.source
                 LEFT JOIN f ON f.lang = a.lang AND f.source = a.source AND f.item = b.source),
        term AS (SELECT lang, source, 'term' AS part, term AS item, ((p - q) * (p - q) // q)::BIGINT AS value
                 FROM p JOIN q USING (lang, term) WHERE c > 0 AND p > q)
        SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item)::INT AS rank
                       FROM (SELECT * FROM pair UNION ALL SELECT * FROM term))
        WHERE part = 'pair' OR rank <= 200""",
    # every prefix of every conversation, joined with all its ancestors
    "op12_conversation_trie": r"""
        WITH said AS (SELECT conv_id, md5(length(r) || ':' || r || t) AS u, strlen(t) AS b,
                             row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k
                      FROM (SELECT conv_id, turn, coalesce(role, '') AS r, coalesce(text, '') AS t
                            FROM conversations WHERE conv_id IS NOT NULL)),
        -- CRC-32 (reflected, polynomial 0xEDB88320) of the id's digits
        c AS (SELECT conv_id, xor(4294967295, list_reduce(
                         list_prepend(4294967295::BIGINT, list_transform(string_split(conv_id::VARCHAR, ''), lambda x: ord(x)::BIGINT)),
                         lambda crc, x: list_reduce(list_prepend(xor(crc, x), [0::BIGINT, 0, 0, 0, 0, 0, 0, 0]),
                             lambda y, z: CASE WHEN y % 2 = 1 THEN xor(y // 2, 3988292384) ELSE y // 2 END))) % 9 AS h
              FROM (SELECT DISTINCT conv_id FROM said)),
        rebuilt AS (SELECT c.conv_id, s.k, s.u, s.b FROM c JOIN said s ON s.conv_id = c.conv_id - c.conv_id % 5 AND s.k <= c.h
                    UNION ALL SELECT c.conv_id, s.k, s.u, s.b FROM c JOIN said s ON s.conv_id = c.conv_id AND s.k > c.h),
        member AS (SELECT conv_id, row_number() OVER w AS depth, string_agg(u, '') OVER w AS key, b
                   FROM rebuilt WINDOW w AS (PARTITION BY conv_id ORDER BY k)
                   UNION ALL SELECT conv_id, 0, '', 0 FROM c),
        node AS (SELECT key, depth, min(conv_id) AS conv_id, count(*) AS n_convs, min(b) AS b FROM member GROUP BY key, depth),
        up AS (SELECT left(key, 32 * (depth - 1)) AS key, count(*) AS n_children FROM node WHERE depth > 0 GROUP BY 1),
        own AS (SELECT n.*, coalesce(u.n_children, 0) AS n_children FROM node n LEFT JOIN up u USING (key)),
        under AS (SELECT left(key, 32 * j) AS key, sum((n_children = 0)::INT) AS n_leaves, sum((n_convs - 1) * b) AS saved_tokens
                  FROM (SELECT *, unnest(range(0, depth + 1)) AS j FROM own) GROUP BY 1),
        ends AS (SELECT key, sha256(string_agg(conv_id::VARCHAR, ',' ORDER BY conv_id)) AS ends_sha256
                 FROM (SELECT conv_id, arg_max(key, depth) AS key FROM member GROUP BY conv_id) GROUP BY key)
        SELECT o.conv_id, o.depth::BIGINT AS depth, p.conv_id AS parent_conv_id, o.n_convs, o.n_children,
               s.n_leaves::BIGINT AS n_leaves, s.saved_tokens::BIGINT AS saved_tokens, coalesce(e.ends_sha256, sha256('')) AS ends_sha256
        FROM own o JOIN under s USING (key) LEFT JOIN ends e USING (key)
        LEFT JOIN own p ON o.depth > 0 AND p.key = left(o.key, 32 * (o.depth - 1))""",
}
