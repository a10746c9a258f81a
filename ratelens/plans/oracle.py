"""Independent SQL for each stand-in query, runnable by DuckDB on the same
parquet tables (views ``pages``, ``orders``, ``lineitem`` ...).

Column names and types are spelled out to match the Spark side exactly:
positions and list sizes are INTEGER, counts BIGINT, prices DECIMAL(12,2).
"""

from __future__ import annotations

_DECODED = ("trim(replace(replace(replace(replace(v, '&lt;', '<'), '&gt;', '>'), '&quot;', chr(34)), "
            "'&amp;', '&'))")
_NAMES = (
    "list_filter(list_transform(regexp_extract_all(html, '<li><a href=\"[^\"]*\">([^<]*)</a></li>', 1), "
    f"lambda v: {_DECODED}), lambda v: v <> '')"
)
# the article cut at its paragraphs' start tags, as text: no pattern is shared with the rules
_SECTIONS = ("list_transform(list_transform(string_split(split_part(substr(html, strpos(html, '<article>')), "
             "'</article>', 1), '<p>')[2:], lambda s: regexp_replace(split_part(s, '</p>', 1), '<[^>]*>', '', 'g')), "
             f"lambda v: {_DECODED})")
_PRICES = f"list_filter({_SECTIONS}, lambda v: v <> '')"

_PAGES = f"""
x AS (
  SELECT page_id, url, html,
    {_NAMES} AS n,
    {_PRICES} AS p,
    CASE WHEN html IS NOT NULL THEN coalesce(regexp_matches(html, '<article><h1>[^<]*[*]{{3}}'), false) END AS na,
    CASE WHEN html IS NOT NULL THEN coalesce(regexp_matches(url, 'utm_source'), false) END AS ct,
    CASE WHEN html IS NOT NULL THEN coalesce(regexp_matches(html, '<b>'), false) END AS lst
  FROM pages),
c AS (
  SELECT *,
    CASE WHEN html IS NULL OR length(html) = 0 THEN 'broken'
         WHEN na THEN 'not_available'
         WHEN ct THEN 'contact'
         WHEN len(p) >= len(n) THEN 'offers'
         ELSE 'broken' END AS status
  FROM x)
"""

# text as a browser shows it: spaces folded, lines trimmed, blank lines left out
_SHOWN = ("trim(regexp_replace(regexp_replace(replace(replace(replace(replace(replace(v, '&lt;', '<'), '&gt;', '>'), "
          "'&quot;', chr(34)), '&middot;', chr(183)), '&amp;', '&'), '[ \\t\\r\\f\\v\u00a0]+', ' ', 'g'), "
          "' ?\\n[ \\n]*', chr(10), 'g'), ' ' || chr(10))")
# pages cut at their tags as text
_CUT = f"""
cut AS (
  SELECT page_id, html,
    string_split(split_part(substr(html, strpos(html, '<nav>')), '</nav>', 1), '</a>') AS links,
    string_split(split_part(substr(html, strpos(html, '<article>')), '</article>', 1), '<p>')[2:] AS paragraphs
  FROM pages),
shown AS (
  SELECT page_id, html, list_transform(paragraphs, lambda s: replace(split_part(s, '</p>', 1), '<br>', chr(10))) AS raw,
    list_transform(list_filter(links, lambda s: contains(s, '<a ')),
      lambda s: substr(split_part(s, '<a ', 2), strpos(split_part(s, '<a ', 2), '>') + 1)) AS labels
  FROM cut),
texts AS (
  SELECT page_id, html, raw,
    list_transform(labels, lambda v: {_SHOWN}) AS labels,
    list_transform(list_transform(raw, lambda s: replace(s, '<b>', '')), lambda v: {_SHOWN}) AS whole,
    list_transform(list_transform(raw, lambda s: split_part(s, '<b>', 2)), lambda v: {_SHOWN}) AS bold
  FROM shown)
"""

_ORDER = ("l_linenumber NULLS FIRST, l_partkey NULLS FIRST, l_suppkey NULLS FIRST, "
          "l_extendedprice NULLS FIRST, l_quantity NULLS FIRST")

_REQUESTS = """
requests AS (
  SELECT o_orderkey AS request_id, o_custkey AS hotel_id,
    replace(strip_accents(c_name), 'ß', 'ss') AS hotel,
    n_name AS city,
    CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS check_in,
    CAST(CAST(o_orderdate AS DATE) + TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS VARCHAR) AS check_out,
    CAST(TRY_CAST(substr(o_orderpriority, 1, 1) AS INTEGER) AS VARCHAR) AS nights,
    CAST(o_totalprice AS DECIMAL(12,2)) AS listed_base_price
  FROM orders
  LEFT JOIN customer ON o_custkey = c_custkey
  LEFT JOIN nation ON c_nationkey = n_nationkey)
"""

_OFFER_LINES = f"""
ol AS (
  SELECT l_orderkey AS request_id, s_name AS agent,
    CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) AS INTEGER) AS scrape_position,
    CAST(l_extendedprice AS DECIMAL(12,2)) AS scrape_base_price_num
  FROM lineitem LEFT JOIN supplier ON l_suppkey = s_suppkey)
"""

_NO_OFFERS = "NOT EXISTS (SELECT 1 FROM lineitem WHERE l_orderkey = r.request_id)"

_NA_ROWS = f"""
na_rows AS (
  SELECT request_id, hotel_id, hotel, check_in, check_out, nights, listed_base_price,
    CAST(NULL AS INTEGER) AS scrape_position, CAST(NULL AS VARCHAR) AS agent,
    CAST(NULL AS VARCHAR) AS scrape_base_price, DATE '2024-01-15' AS scrape_date,
    'not_available' AS status
  FROM requests r WHERE {_NO_OFFERS})
"""

_PRICE_TEXT = "replace(replace('$' || format('{:,.2f}', l_extendedprice), '$', ''), ',', '')"

_PAGE_RUN = f"""WITH {_PAGES},
r AS (
  SELECT *, CAST(page_id AS VARCHAR) AS request_id,
    replace(strip_accents(regexp_extract_all(html, '<title>([^<]*)</title>', 1)[1]), 'ß', 'ss') AS hotel
  FROM c)
"""
_NULLS = ("CAST(NULL AS VARCHAR) AS check_in, CAST(NULL AS VARCHAR) AS check_out, "
          "CAST(NULL AS VARCHAR) AS check_in_search, CAST(NULL AS VARCHAR) AS check_out_search, "
          "CAST(NULL AS VARCHAR) AS listed_base_price, CAST(NULL AS VARCHAR) AS nights")
_CLEAN = "replace(replace(p[i], '$', ''), ',', '')"

ORACLE_SQL: dict[str, str] = {
    "offers": f"""WITH {_PAGES}
SELECT page_id, CAST(i AS INTEGER) AS scrape_position, n[i] AS agent, p[i] AS scrape_base_price
FROM c, unnest(range(1, len(n) + 1)) AS t(i) WHERE status = 'offers'""",

    "page_names": f"""WITH {_PAGES}
SELECT page_id, CAST(i AS INTEGER) AS pos, n[i] AS name
FROM x, unnest(range(1, len(n) + 1)) AS t(i)""",

    "page_outcome": f"""WITH {_PAGES}
SELECT page_id, status,
  CASE WHEN status = 'broken' THEN
    CASE WHEN html IS NULL THEN 'html_missing'
         WHEN length(html) = 0 THEN 'html_empty'
         WHEN len(p) < len(n) THEN 'too_few_prices' END
    WHEN status = 'offers' AND len(n) = 0 THEN 'no_sellers' END AS reason,
  CAST(CASE WHEN status = 'offers' THEN len(n) ELSE 0 END AS INTEGER) AS n_offers
FROM c""",

    "list_sizes": f"""WITH {_PAGES}
SELECT page_id, CAST(len(n) AS INTEGER) AS n_names, CAST(len(p) AS INTEGER) AS n_prices FROM x""",

    "distinct_names": f"""WITH {_PAGES}
SELECT page_id, CAST(len(n) AS INTEGER) AS n_names,
  CAST(len(list_distinct(n)) AS INTEGER) AS n_distinct FROM x""",

    "page_scoped_items": """
SELECT page_id, CAST(i AS INTEGER) AS pos, a[i] AS href
FROM (SELECT page_id,
        regexp_extract_all(regexp_extract(html, '<nav>(.*?)</nav>', 1), 'href="([^"]*)"', 1) AS a
      FROM pages), unnest(range(1, len(a) + 1)) AS t(i)""",

    "nth_section": f"""
SELECT page_id, ({_SECTIONS})[5] AS section FROM pages""",

    "page_layout": f"""WITH {_PAGES}
SELECT page_id, lst AS is_listing, ct AS contact, na AS not_available FROM x""",

    "layout_fallback": f"""
SELECT page_id, layout, CAST(len(pr) AS INTEGER) AS n_prices, pr[1] AS first_price
FROM (
  SELECT page_id,
    CASE WHEN html IS NULL THEN NULL
         WHEN contains(html, '<p>') THEN 1
         WHEN regexp_matches(html, '<h1>[^<]*</h1>') THEN 2 END AS layout,
    CASE WHEN html IS NULL THEN NULL
         WHEN contains(html, '<p>') THEN {_PRICES}
         WHEN regexp_matches(html, '<h1>[^<]*</h1>')
           THEN list_filter(list_transform(regexp_extract_all(html, '<h1>([^<]*)</h1>', 1), lambda v: {_DECODED}), lambda v: v <> '')
    END AS pr
  FROM pages)""",

    "attr_match": """
SELECT page_id, ['en', 'de', 'fr', 'es'][page_id % 4 + 1] AS lang,
  contains(html, '<html lang="' || ['en', 'de', 'fr', 'es'][page_id % 4 + 1] || '">') AS present
FROM pages""",

    "searched_dates": """
SELECT page_id,
  coalesce(regexp_extract_all(url, '[?&]page=([0-9]+)', 1)[1], '1') AS searched,
  regexp_extract_all(url, '[?&]page=([0-9]+)', 1)[1] IS NOT NULL AS from_page
FROM pages""",

    # the shown day is known before it is written as text
    "searched_stay": """
WITH d AS (
  SELECT o_orderkey, CAST(o_orderdate AS DATE) AS check_in,
    CAST(o_orderdate AS DATE) + CAST((o_custkey % 5 - 2) * 40 AS INTEGER) AS day FROM orders)
SELECT o_orderkey, check_in,
  CASE o_orderkey % 3 WHEN 0 THEN strftime(day, '%a, %b %-d') WHEN 1 THEN strftime(day, '%-d %B')
    ELSE strftime(day, '%A, %B %-d, %Y') END AS shown,
  CAST(day AS DATE) AS searched, day = check_in AS as_requested
FROM d""",

    "drop_blanks": """
SELECT page_id, CAST(i AS INTEGER) AS i, a[i] AS l
FROM (SELECT page_id, list_filter(regexp_extract_all(html, '>([^<]*)<', 1), lambda v: v <> '') AS a
      FROM pages), unnest(range(1, len(a) + 1)) AS t(i)""",

    "newline_fold": """
SELECT conv_id, turn, replace(text, chr(10), ' ') AS text FROM conversations""",

    "transliterate": """
SELECT doc_id, replace(strip_accents(text), 'ß', 'ss') AS t FROM documents""",

    "search_key": """
SELECT c_custkey, replace(strip_accents(c_name), 'ß', 'ss') || ' ' || n_name AS search_key
FROM customer LEFT JOIN nation ON c_nationkey = n_nationkey""",

    "price_clean": f"""
SELECT l_orderkey, l_linenumber, l_partkey, {_PRICE_TEXT} AS price_text,
  TRY_CAST({_PRICE_TEXT} AS DECIMAL(12,2)) AS price
FROM lineitem""",

    "manifest_project": f"""WITH {_REQUESTS}
SELECT request_id, hotel_id, hotel, city, check_in, listed_base_price FROM requests""",

    "manifest_sample": """
SELECT o_orderkey, o_custkey FROM orders ORDER BY o_orderkey LIMIT 14""",

    "chunk_id": """
SELECT o_orderkey,
  CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 50) + 1 AS INTEGER) AS chunk_id
FROM orders""",

    "offer_position": f"""
SELECT l_orderkey, l_partkey, l_suppkey,
  CAST(row_number() OVER (PARTITION BY l_orderkey ORDER BY {_ORDER}) AS INTEGER) AS scrape_position
FROM lineitem""",

    "request_offers": f"""WITH {_OFFER_LINES}
SELECT o_orderkey AS request_id, ol.agent, ol.scrape_position, ol.scrape_base_price_num,
  o_custkey AS hotel_id
FROM orders LEFT JOIN ol ON ol.request_id = o_orderkey""",

    "reattempt": f"""WITH {_REQUESTS}
SELECT request_id, hotel_id, hotel, check_in, check_out, city, listed_base_price, nights,
  'no_offers' AS reason
FROM requests r WHERE {_NO_OFFERS}""",

    "sentinel_rows": f"""WITH {_REQUESTS}
SELECT request_id, CAST(hotel_id AS VARCHAR) AS hotel_id, hotel,
  'Not Available' AS agents, 'Not Available' AS scrape_position, '2024-01-15' AS scrape_date,
  check_in, check_out, 'Not Available' AS check_in_search, 'Not Available' AS check_out_search,
  CAST(listed_base_price AS VARCHAR) AS hoken_base_price, 'Not Available' AS scrape_base_price,
  nights
FROM requests r WHERE {_NO_OFFERS}""",

    "merge_outcomes": f"""WITH {_REQUESTS}, {_OFFER_LINES}, {_NA_ROWS},
offer_rows AS (
  SELECT ol.request_id, r.hotel_id, r.hotel, ol.agent, ol.scrape_position,
    DATE '2024-01-15' AS scrape_date, r.check_in, r.check_out, r.nights, r.listed_base_price,
    ol.scrape_base_price_num, CAST(ol.scrape_base_price_num AS VARCHAR) AS scrape_base_price,
    'offers' AS status
  FROM ol JOIN requests r ON r.request_id = ol.request_id)
SELECT * FROM offer_rows UNION ALL BY NAME SELECT * FROM na_rows""",

    "run_summary": """
SELECT status, COUNT(*) AS requests, CAST(SUM(n_offers) AS BIGINT) AS offers
FROM (
  SELECT CASE WHEN c.n IS NOT NULL THEN 'offers' ELSE 'not_available' END AS status,
    coalesce(c.n, 0) AS n_offers
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) c
    ON c.l_orderkey = o.o_orderkey)
GROUP BY status""",

    "page_rate_shop": f"""{_PAGE_RUN}
SELECT request_id, request_id AS hotel_id, hotel, n[i] AS agent,
  CAST(i AS INTEGER) AS scrape_position, DATE '2024-01-15' AS scrape_date, {_NULLS},
  {_CLEAN} AS scrape_base_price, TRY_CAST({_CLEAN} AS DECIMAL(12,2)) AS scrape_base_price_num,
  status
FROM r, unnest(range(1, len(n) + 1)) AS t(i) WHERE status = 'offers'
UNION ALL
SELECT request_id, request_id AS hotel_id, hotel, CAST(NULL AS VARCHAR) AS agent,
  CAST(NULL AS INTEGER) AS scrape_position, DATE '2024-01-15' AS scrape_date, {_NULLS},
  CAST(NULL AS VARCHAR) AS scrape_base_price, CAST(NULL AS DECIMAL(12,2)) AS scrape_base_price_num,
  status
FROM r WHERE status IN ('not_available', 'contact')""",

    # paragraphs cut out of the article as text, tags dropped: no rule is shared with the parser
    "page_rate_shop_parsed": f"""WITH cut AS (
  SELECT page_id, html, string_split(split_part(substr(html, strpos(html, '<article>')), '</article>', 1), '<p>') AS parts
  FROM pages),
r AS (
  SELECT CAST(page_id AS VARCHAR) AS request_id, 'offers' AS status,
    replace(strip_accents(regexp_extract_all(html, '<title>([^<]*)</title>', 1)[1]), 'ß', 'ss') AS hotel,
    list_filter(list_transform(regexp_extract_all(html, '<a href=[^>]*>([^<]*)</a>', 1), lambda v: {_DECODED}), lambda v: v <> '') AS n,
    list_filter(list_transform(list_transform(parts[2:], lambda s: regexp_replace(split_part(s, '</p>', 1), '<[^>]*>', '', 'g')),
      lambda v: {_DECODED}), lambda v: v <> '') AS p
  FROM cut)
SELECT request_id, request_id AS hotel_id, hotel, n[i] AS agent,
  CAST(i AS INTEGER) AS scrape_position, DATE '2024-01-15' AS scrape_date, {_NULLS},
  {_CLEAN} AS scrape_base_price, TRY_CAST({_CLEAN} AS DECIMAL(12,2)) AS scrape_base_price_num,
  status
FROM r, unnest(range(1, len(n) + 1)) AS t(i) WHERE len(p) >= len(n)""",

    "page_legacy_rows": f"""{_PAGE_RUN},
rows AS (
  SELECT request_id, status, n[i] AS agent, CAST(i AS INTEGER) AS pos, {_CLEAN} AS price
  FROM r, unnest(range(1, len(n) + 1)) AS t(i) WHERE status = 'offers'
  UNION ALL
  SELECT request_id, status, NULL, NULL, NULL FROM r WHERE status IN ('not_available', 'contact'))
SELECT rows.request_id, rows.status, rows.request_id AS hotel_id, r.hotel AS hotel,
  CASE WHEN rows.status = 'not_available' THEN 'Not Available' ELSE agent END AS agents,
  CASE WHEN rows.status = 'not_available' THEN 'Not Available' ELSE CAST(pos AS VARCHAR) END
    AS scrape_position,
  '2024-01-15' AS scrape_date, CAST(NULL AS VARCHAR) AS check_in, CAST(NULL AS VARCHAR) AS check_out,
  CASE WHEN rows.status = 'not_available' THEN 'Not Available'
       WHEN rows.status = 'contact' THEN 'Contact this property' END AS check_in_search,
  CASE WHEN rows.status = 'not_available' THEN 'Not Available'
       WHEN rows.status = 'contact' THEN 'Contact this property' END AS check_out_search,
  CAST(NULL AS VARCHAR) AS hoken_base_price,
  CASE WHEN rows.status = 'not_available' THEN 'Not Available'
       WHEN rows.status = 'contact' THEN 'Contact this property' ELSE price END AS scrape_base_price,
  CAST(NULL AS VARCHAR) AS nights
FROM rows JOIN r ON r.request_id = rows.request_id""",

    "chunk_summary": """
SELECT chunk_id, COUNT(*) AS requests, COUNT(n) AS successes,
  CAST(coalesce(SUM(n), 0) AS BIGINT) AS offers
FROM (
  SELECT CAST(floor((row_number() OVER (ORDER BY o_orderkey) - 1) / 50) + 1 AS INTEGER) AS chunk_id,
    c.n
  FROM orders o
  LEFT JOIN (SELECT l_orderkey, COUNT(*) AS n FROM lineitem GROUP BY l_orderkey) c
    ON c.l_orderkey = o.o_orderkey)
GROUP BY chunk_id""",

    "page_rate_shop_summary": f"""WITH {_PAGES}
SELECT status, COUNT(*) AS requests,
  CAST(SUM(CASE WHEN status = 'offers' THEN len(n) ELSE 0 END) AS BIGINT) AS offers,
  COUNT(*) FILTER (WHERE status = 'offers' AND len(n) = 0) AS no_sellers
FROM c GROUP BY status""",

    "element_scope": f"""WITH {_CUT},
kept AS (
  SELECT page_id, 'nav' AS scope, list_filter(labels, lambda v: v <> '') AS t FROM texts
  UNION ALL SELECT page_id, 'article', list_filter(whole, lambda v: v <> '') FROM texts)
SELECT page_id, scope, CAST(i AS INTEGER) AS pos, t[i] AS text FROM kept, unnest(range(1, len(t) + 1)) AS u(i)""",

    "place_flags": f"""WITH {_CUT}
SELECT page_id,
  coalesce(len(string_split(split_part(substr(html, strpos(html, '<nav>')), '</nav>', 1), '<li>')) > 6
    OR len(raw) >= 30, false) AS not_available,
  coalesce(contains(html, 'class="ad"') OR starts_with(raw[2], '<b>'), false) AS contact
FROM texts""",

    "block_fields": f"""WITH {_CUT}
SELECT page_id, CAST(i AS INTEGER) AS block, nullif(bold[i], '') AS bold, nullif(whole[i], '') AS whole
FROM texts, unnest(range(1, len(raw) + 1)) AS u(i)""",

    "rule_winner": f"""WITH {_CUT},
body AS (
  SELECT *, substr(html, strpos(html, '<body>')) AS b FROM texts),
tried AS (
  SELECT page_id, 'name' AS field, 1 AS priority, 'class' AS kind, 'ad' AS key,
    len(string_split(b, '<div class="ad">')) - 1 AS n,
    split_part(split_part(b, '<div class="ad">', 2), '</div>', 1) AS v FROM body
  UNION ALL SELECT page_id, 'name', 2, 'tag', 'h1', len(string_split(b, '<h1>')) - 1,
    split_part(split_part(b, '<h1>', 2), '</h1>', 1) FROM body
  UNION ALL SELECT page_id, 'price', 1, 'tag', 'b', len(string_split(b, '<b>')) - 1,
    list_filter(raw, lambda s: contains(s, '<b>'))[1] FROM body
  UNION ALL SELECT page_id, 'price', 2, 'tag', 'p', len(string_split(b, '<p>')) - 1, replace(raw[1], '<b>', '') FROM body),
won AS (
  SELECT * FROM tried WHERE n > 0 QUALIFY row_number() OVER (PARTITION BY page_id, field ORDER BY priority) = 1)
SELECT page_id, field, CAST(priority AS INTEGER) AS priority, kind, key, CAST(n AS BIGINT) AS n_elements,
  {_SHOWN.replace("(v,", "(replace(v, '<b>', ''),")} AS first_text
FROM won""",
}

# the same rules on element intervals
ORACLE_SQL["page_rate_shop_elements"] = ORACLE_SQL["page_rate_shop_parsed"]
