"""What each registered query must give, in SQL over the same tables.

Where a query reads something rendered from a table (a grid, a page, a file
name), the SQL states the expected rows from the table itself.
"""

from __future__ import annotations

from pricegrid.sources.pages import SEEDS

_NOISE = r"(?is)<script\b.*?</script>|<style\b.*?</style>|<!--.*?-->"
_DECODED = "replace(replace(replace(replace({}, '&quot;', '\"'), '&copy;', '©'), '&middot;', '·'), '&amp;', '&')"

_LINKS = rf"""
navs AS (
  SELECT page_id, url, array_to_string(regexp_extract_all(
    regexp_replace(html, '{_NOISE}', '', 'g'), '(?is)<nav\b[^>]*>(.*?)</nav\s*>', 1), ' ') AS nav
  FROM pages),
lists AS (
  SELECT page_id, url, regexp_extract_all(nav, '(?is)<a\b[^>]*?\shref\s*=\s*["'']([^"'']*)["'']', 1) AS hrefs
  FROM navs),
links AS (
  SELECT page_id, url AS page_url, CAST(generate_subscripts(hrefs, 1) - 1 AS INTEGER) AS pos,
         unnest(hrefs) AS href
  FROM lists)"""

_MONTHS = (
    "['enero','febrero','marzo','abril','mayo','junio','julio','agosto','septiembre',"
    "'octubre','noviembre','diciembre']"
)

_PLACES = """
places AS (
  SELECT s_suppkey, s_name, n_name, r_name FROM supplier
  JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

_PRICES = f"""{_PLACES},
prices AS (
  SELECT p_name, p_brand, p_type, s_name, r_name, CAST(l_extendedprice AS DECIMAL(12,2)) AS price,
         CAST(l_quantity AS DECIMAL(12,2)) AS quantity, CAST(l_shipdate AS DATE) AS price_date, l_orderkey
  FROM lineitem JOIN part ON l_partkey = p_partkey JOIN places ON l_suppkey = s_suppkey)"""

_GRID = f"""{_PLACES},
lows AS (
  SELECT l_partkey, r_name, min(CAST(l_extendedprice AS DECIMAL(12,2))) AS low,
         max(CAST(l_extendedprice AS DECIMAL(12,2))) AS top
  FROM lineitem JOIN places ON l_suppkey = s_suppkey GROUP BY ALL),
starts AS (
  SELECT part.*, CAST(p_partkey // 400 AS INTEGER) AS file_no,
         CAST(DATE '2020-01-01' + CAST(p_partkey // 400 % 300 AS INTEGER) AS DATE) AS start_date
  FROM part),
placed AS (
  SELECT *, CAST(start_date + 6 AS DATE) AS end_date,
         p_partkey % 400 // 40 AS page_no, p_partkey % 40 + 3 AS row_no,
         'sondeo-' || translate(CAST(file_no AS VARCHAR), '0123456789', 'abcdefghij') || '-del-'
         || strftime(start_date, '%d') || '-' || ({_MONTHS})[month(start_date)] || '-al-'
         || strftime(start_date + 6, '%d') || '-' || ({_MONTHS})[month(start_date + 6)] || '-2020' AS file_id
  FROM starts),
seen AS (SELECT * FROM placed JOIN lows ON p_partkey = l_partkey)"""



def _id(*parts: str) -> str:
    """The id of SQL expressions: each with its length, or a dash."""
    told = [f"coalesce(length(CAST({p} AS VARCHAR)) || ':' || {p}, '-')" for p in parts]
    return f"md5({" || ',' || ".join(told)})"


def _obs_id(dataset: str, variant: str, gcol: str) -> str:
    return _id(dataset, "('https://example.org/files/' || file_id || '.pdf')", variant, "page_no", "row_no", gcol)



_BASKETS = f"""{_GRID},
columns_of(r_name, gcol, raw, vendor) AS (VALUES
  ('AFRICA', 2, 'Super AFRICA --', 'Super AFRICA'), ('AMERICA', 3, 'Super AMERICA --', 'Super AMERICA'),
  ('ASIA', 4, 'Super ASIA --', 'Super ASIA'), ('EUROPE', 5, ' EUROPE --', 'EUROPE'),
  ('MIDDLE EAST', 6, 'Super MIDDLE EAST --', 'Super MIDDLE EAST'),
  ('AFRICA', 8, 'Super AFRICA --.1', 'Super AFRICA')),
baskets AS (
  SELECT {_obs_id("'basic_baskets'", "'single'", "gcol")} AS id, 'basic_baskets' AS dataset, file_id,
         p_name AS description, p_type AS unit, vendor, raw AS vendor_raw, page_no, row_no, gcol,
         CAST(CASE WHEN gcol = 8 THEN top ELSE low END AS DECIMAL(18,4)) AS price, false AS price_too_large, 'DOP' AS currency,
         start_date, end_date, false AS date_error, false AS range_inverted
  FROM seen JOIN columns_of USING (r_name))"""

_MEDICINES = """
regions(r_name, i) AS (VALUES ('AFRICA', 0), ('AMERICA', 1), ('ASIA', 2), ('EUROPE', 3), ('MIDDLE EAST', 4)),
halves AS (
  SELECT *, 'generic' AS variant, p_name AS medication_name, p_type AS dosage, p_type AS maker,
         p_brand AS unit, 7 + i AS gcol FROM seen JOIN regions USING (r_name) WHERE page_no % 2 = 0
  UNION ALL
  SELECT *, 'commercial', p_brand, p_name, p_type, p_brand, 7 + i
  FROM seen JOIN regions USING (r_name) WHERE page_no % 2 = 0
  UNION ALL
  SELECT *, 'single', p_name, p_type, p_brand, CAST(p_size AS VARCHAR), 4 + i
  FROM seen JOIN regions USING (r_name) WHERE page_no % 2 = 1),
medicines AS (
  SELECT {id} AS id, 'medicines' AS dataset, variant, file_id, medication_name, dosage, maker, unit,
         r_name AS vendor, r_name || '  ' AS vendor_raw, CAST(low AS DECIMAL(18,4)) AS price,
         false AS price_too_large, 'DOP' AS currency, start_date, end_date, false AS date_error, false AS range_inverted
  FROM halves)""".format(id=_obs_id("'medicines'", "variant", "gcol"))

_FLOWERS = """
SELECT p_name AS description, CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END AS unit,
       p_brand || ' & Co' AS vendor, 'RD$' || {text} AS {column}, 'DOP' AS currency,
       '03/01/2020' AS last_published_at, DATE '2020-01-15' AS last_updated_at
FROM part"""
# thousands grouped by hand, so that the text does not depend on a formatter
_GROUPED = (
    "regexp_replace(CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS VARCHAR), '^([0-9]+)([0-9]{3}[.])', '\\1,\\2')"
)

_STEPS = f"""{_PRICES},
daily AS (
  SELECT p_brand AS product, r_name AS vendor, price_date, min(quantity) AS price FROM prices GROUP BY ALL),
marked AS (
  SELECT *, lag(price) OVER (PARTITION BY product, vendor ORDER BY price_date) AS before FROM daily),
steps AS (
  SELECT product, vendor, price, price_date AS valid_from,
         lead(price_date) OVER (PARTITION BY product, vendor ORDER BY price_date) AS valid_to
  FROM marked WHERE before IS NULL OR before <> price)"""

_ORDERS = """
old AS (
  SELECT o_orderkey AS id, o_orderstatus AS dataset,
         CAST(date_trunc('quarter', o_orderdate) AS DATE) AS start_date,
         CAST(o_totalprice AS DECIMAL(12,2)) AS price
  FROM orders),
reloaded AS (
  SELECT * FROM old WHERE start_date NOT BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'
  UNION ALL
  SELECT id, dataset, start_date, CAST(price * 2 AS DECIMAL(12,2)) FROM old
  WHERE start_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31' AND dataset <> 'P')"""

_COUNTED = """
raw AS (SELECT id, {dataset} AS dataset, start_date, price FROM old),
processed AS (
  SELECT id, dataset, start_date, CAST(price + CASE WHEN id % 17 = 3 THEN 1 ELSE 0 END AS DECIMAL(12,2)) AS price
  FROM (SELECT *, unnest(range(CASE WHEN id % 13 = 2 THEN 3 ELSE 1 END)) FROM raw) WHERE id % 11 <> 5),
counted AS (
  SELECT id, dataset, start_date, price, CAST(sum(l) AS BIGINT) AS n_left, CAST(sum(r) AS BIGINT) AS n_right
  FROM (SELECT *, 1 AS l, 0 AS r FROM raw UNION ALL SELECT *, 0, 1 FROM processed) GROUP BY ALL)"""
# in folders an empty dataset is none
_PROCESSED = _COUNTED.format(dataset="CASE WHEN id % 7 > 1 THEN dataset END")
_PROCESSED_BLANK = _COUNTED.format(dataset="CASE WHEN id % 7 = 1 THEN '' WHEN id % 7 > 1 THEN dataset END")

_STORED = r"""
named AS (
  SELECT page_id, regexp_extract(url, '[^/]*$') AS base FROM pages),
files AS (
  SELECT page_id, regexp_replace(base, '\.[^.]*$', '') AS file_id, contains(base, '.html') AS known FROM named)"""

_SPELLED = """
spelled AS (
  SELECT p_partkey AS id, p_partkey % 5 AS kind,
         CASE p_partkey % 5 WHEN 1 THEN 'ŁÓDŹ ' || p_name WHEN 2 THEN 'Молоко, ' || p_type WHEN 3 THEN '米 ' || p_brand
              WHEN 4 THEN '** ' || repeat('*', p_partkey % 3) ELSE p_name END AS name,
         CASE p_partkey % 5 WHEN 4 THEN '' ELSE list_aggregate(list_sort(
           CASE p_partkey % 5 WHEN 1 THEN list_append(string_split(p_name, ' '), 'lodz')
                WHEN 2 THEN ['молоко', lower(p_type)] WHEN 3 THEN ['米', 'brand', split_part(p_brand, '#', 2)]
                ELSE string_split(p_name, ' ') END), 'string_agg', ' ') END AS fingerprint
  FROM part)"""

ORACLES: dict[str, str] = {
    "seed_pages": f"""
WITH listed(i, url, dataset, active) AS (VALUES {", ".join(f"({i}, '{u}', '{d}', {a})" for i, (d, u, a) in enumerate(SEEDS))})
SELECT page_id, listed.url, dataset FROM pages JOIN listed ON page_id % {len(SEEDS)} = i WHERE active""",
    "link_markup": """
SELECT page_id, url AS page_url, i - 1 AS pos,
       ['it''s-' || page_id || '.pdf', 'plain-' || page_id || '.pdf', 'say "so"-' || page_id || '.pdf',
        'año-áé&lt;-' || page_id || '.pdf', 'last-' || page_id || '.pdf'][i] AS file_url
FROM pages, (SELECT unnest([1, 2, 3, 4, 5]) AS i)""",
    "link_extract": f"WITH {_LINKS} SELECT page_id, page_url, pos, {_DECODED.format('href')} AS file_url FROM links",
    "page_first_text": rf"""
SELECT page_id, nullif(trim({_DECODED.format(
        f"regexp_extract(regexp_replace(html, '{_NOISE}', '', 'g'), '(?is)<h1[^>]*>([^<]+)', 1)")}), '') AS title
FROM pages""",
    "stored_file_name": f"""
WITH {_STORED}
SELECT page_id, file_id || CASE WHEN known THEN '.html' ELSE '' END AS file_name, file_id,
       'store/' || file_id || '-generic.csv' AS output FROM files""",
    "url_decode_twice": """
SELECT page_id, regexp_extract(url, '[^/]*$') || '+a b c%' AS name FROM pages""",
    "html_table_rows": f"""
SELECT CAST(p_partkey // 50 AS BIGINT) AS page_id, CAST(p_partkey % 50 + 1 AS INTEGER) AS row_no,
       p_brand || ' & Co|' || p_name || '|' || CASE WHEN p_type = 'PROMO' THEN '' ELSE p_type END
       || '|RD$' || {_GROUPED} AS cells
FROM part""",
    "flowers_feed": f"""
SELECT * EXCLUDE (p_retailprice), false AS price_too_large, CAST(CAST(p_retailprice AS DECIMAL(12,2)) AS DECIMAL(18,4)) AS price
FROM ({_FLOWERS.format(text=_GROUPED, column="price_text, p_retailprice")})""",
    "transport_feed": """
SELECT r_name AS province, n_name AS town, 'Ruta ' || c_custkey AS route, c_mktsegment AS company,
       '809-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0') AS phone_number, c_name AS representative,
       n_name || ' centro' AS stop, 'L' || c_custkey AS line,
       CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(18,4)) AS cost, 'DOP' AS currency,
       'Enero 2020' AS last_published_at, DATE '2020-01-15' AS last_updated_at,
       CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) AS VARCHAR) AS cost_text, false AS cost_too_large
FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey""",
    "report_date_range": """
WITH dated AS (
  SELECT o_orderkey, o_orderpriority AS p, o_orderstatus = 'F' AND o_orderpriority = '5-LOW' AS date_error,
         CAST(o_orderdate AS DATE) AS d, CAST(CAST(o_orderdate AS DATE) + 7 AS DATE) AS e FROM orders),
ranges AS (
  SELECT o_orderkey, date_error,
    CASE WHEN date_error THEN NULL WHEN p = '4-NOT SPECIFIED' THEN CAST(date_trunc('month', d) AS DATE)
         ELSE d END AS start_date,
    CASE WHEN date_error THEN NULL
         WHEN p = '2-HIGH' THEN make_date(year(d), month(e), day(e))
         WHEN p = '3-MEDIUM' THEN e
         WHEN p = '4-NOT SPECIFIED' THEN CAST(date_trunc('month', d) AS DATE)
         ELSE make_date(year(d), month(d), day(e)) END AS end_date
  FROM dated)
SELECT o_orderkey, start_date, end_date, date_error, coalesce(end_date < start_date, false) AS range_inverted
FROM ranges""",
    "new_reports_only": """
SELECT o_orderkey, 'basic_baskets' AS dataset, 'r' || o_orderkey || '.pdf' AS file_name, 'r' || o_orderkey AS file_id
FROM orders WHERE o_orderstatus <> 'F'
UNION ALL
SELECT o_orderkey, 'dairy_products', 'r' || o_orderkey || '.pdf', 'r' || o_orderkey
FROM orders WHERE o_orderkey NOT IN (SELECT l_orderkey FROM lineitem WHERE l_returnflag = 'R')""",
    "failed_download_pairing": f"""
WITH {_LINKS}, arrived AS (
  SELECT page_id, pos, regexp_replace(regexp_extract({_DECODED.format('href')}, '[^/]*$'), '(.)[.][^.]*$', '\\1') AS stem
  FROM links WHERE NOT regexp_matches({_DECODED.format('href')}, '[,.]$'))
SELECT page_id AS item_id, CAST(count(*) AS INTEGER) AS n_files,
       string_agg(pos || '=/store/' || stem, '|' ORDER BY pos) AS files
FROM arrived GROUP BY page_id""",
    "last_written": f"""
WITH {_LINKS}, named AS (
  SELECT 'basic_baskets' AS dataset, page_id, pos, {_DECODED.format('href')} AS file_url,
         regexp_replace(regexp_extract({_DECODED.format('href')}, '[^/]*$'), '(.)[.][^.]*$', '\\1') AS file_name
  FROM links)
SELECT dataset, file_name, page_id, pos, file_url FROM (
  SELECT *, row_number() OVER (PARTITION BY dataset, file_name ORDER BY page_id DESC, pos DESC) AS i FROM named)
WHERE i = 1""",
    "grid_to_long": f"WITH {_BASKETS} SELECT * EXCLUDE (page_no, row_no, gcol) FROM baskets",
    "grid_guards": f"""
WITH {_BASKETS}
SELECT baskets.* EXCLUDE (page_no, row_no, gcol) REPLACE (large AS price_too_large, CASE WHEN NOT large THEN price END AS price) FROM baskets JOIN (
  SELECT {_obs_id("'basic_baskets'", "'single'", "gcol")} AS id, gcol = 3 AND p_size <= 2 AS large
  FROM seen JOIN columns_of USING (r_name) WHERE page_no % 5 <> 4) USING (id) WHERE unit <> 'PROMO'""",
    "medicine_split": f"WITH {_GRID}, {_MEDICINES} SELECT * FROM medicines",
    "medicine_variants": f"WITH {_GRID}, {_MEDICINES} SELECT DISTINCT dataset, file_id, variant FROM medicines",
    "observation_union": f"""
WITH {_BASKETS}, {_MEDICINES}
SELECT dataset, NULL::VARCHAR AS variant, description AS product, unit, vendor, price FROM baskets
UNION ALL
SELECT dataset, variant, medication_name, unit, vendor, price FROM medicines""",
    "price_parse": """
SELECT l_orderkey, l_linenumber,
       CAST(CASE WHEN l_linenumber % 5 = 4 THEN floor(CAST(l_extendedprice AS DECIMAL(12,2)))
                 ELSE CAST(l_extendedprice AS DECIMAL(12,2)) END AS DECIMAL(18,4)) AS price
FROM lineitem""",
    "merchant_breakdown": f"""
WITH {_PRICES}
SELECT p_name AS product, s_name AS vendor, count(*) AS n_prices, min(price) AS min_price,
       max(price) AS max_price, 
       -- rounded half up in whole numbers
       CAST((2 * sum(CAST(price * 100 AS HUGEINT)) * 10000 + count(*)) // (2 * count(*)) / 1e6 AS DECIMAL(16,6)) AS avg_price,
       (list(price ORDER BY price_date DESC, price))[1] AS latest_price
FROM prices GROUP BY ALL""",
    "merchant_rank": f"""
WITH {_PRICES}, offers AS (
  SELECT p_name AS product, s_name AS vendor, min(price) AS price FROM prices GROUP BY ALL)
SELECT product, vendor, price, rank() OVER (PARTITION BY product ORDER BY price) AS price_rank,
       price - min(price) OVER (PARTITION BY product) AS gap,
       row_number() OVER (PARTITION BY product ORDER BY price, vendor) = 1 AS is_cheapest
FROM offers""",
    "cheapest_merchant": f"""
WITH {_PRICES}, offers AS (
  SELECT p_name AS product, s_name AS vendor, min(price) AS price FROM prices GROUP BY ALL)
SELECT product, vendor, price, n_vendors FROM (
  SELECT *, row_number() OVER (PARTITION BY product ORDER BY price, vendor) AS i,
         count(*) OVER (PARTITION BY product) AS n_vendors FROM offers) WHERE i = 1""",
    "merchant_matrix": f"""
WITH {_PRICES}
SELECT p_name AS product,
       {", ".join(f"min(price) FILTER (WHERE r_name = '{r}') AS {r.replace(' ', '_')}"
                  for r in ("AFRICA", "AMERICA", "ASIA", "EUROPE", "MIDDLE EAST"))}
FROM prices GROUP BY ALL""",
    "price_history": f"WITH {_STEPS} SELECT * FROM steps",
    "price_on_days": f"""
WITH {_STEPS}, days AS (SELECT DISTINCT CAST(date_trunc('month', o_orderdate) AS DATE) AS day FROM orders)
SELECT product, vendor, day, price FROM steps
JOIN days ON day >= valid_from AND (valid_to IS NULL OR day < valid_to)""",
    "price_asof": f"""
WITH {_PRICES}, daily AS (
  SELECT p_brand AS product, r_name AS vendor, price_date, min(price) AS price FROM prices GROUP BY ALL),
probes AS (
  SELECT l_orderkey, p_brand AS product, r_name AS vendor, CAST(o_orderdate AS DATE) AS day
  FROM prices JOIN orders ON l_orderkey = o_orderkey)
SELECT l_orderkey, p.product, p.vendor, p.day, CAST(d.price AS DECIMAL(18,4)) AS price
FROM probes p ASOF LEFT JOIN daily d
  ON p.product = d.product AND p.vendor = d.vendor AND p.day >= d.price_date""",
    "price_stats": """
WITH prices AS (
  SELECT p_brand, p_type, CAST(l_extendedprice AS DECIMAL(12,2)) AS price
  FROM lineitem JOIN part ON l_partkey = p_partkey),
grains AS (
  SELECT 'product' AS grain, p_brand AS key, price FROM prices
  UNION ALL SELECT 'dataset', p_type, price FROM prices
  UNION ALL SELECT 'all', '*', price FROM prices),
modes AS (
  SELECT grain, key, price AS mode_price FROM (
    SELECT *, row_number() OVER (PARTITION BY grain, key ORDER BY n DESC, price) AS i
    FROM (SELECT grain, key, price, count(*) AS n FROM grains GROUP BY ALL)) WHERE i = 1)
SELECT grain, key, count(*) AS n, min(price) AS min_price, max(price) AS max_price,
       round(avg(price::DOUBLE), 2) AS avg_price, round(stddev_samp(price::DOUBLE), 2) AS stddev_price,
       any_value(mode_price) AS mode_price, round(median(price::DOUBLE), 3) AS median_price
FROM grains JOIN modes USING (grain, key) GROUP BY grain, key""",
    "price_stats_large": """
WITH prices AS (
  SELECT p_brand, p_type, CAST(l_quantity AS DECIMAL(12,2)) / 100 AS part FROM lineitem JOIN part ON l_partkey = p_partkey),
grains AS (
  SELECT 'product' AS grain, p_brand AS key, part FROM prices
  UNION ALL SELECT 'dataset', p_type, part FROM prices
  UNION ALL SELECT 'all', '*', part FROM prices),
modes AS (
  SELECT grain, key, part AS mode FROM (
    SELECT *, row_number() OVER (PARTITION BY grain, key ORDER BY n DESC, part) AS i
    FROM (SELECT grain, key, part, count(*) AS n FROM grains GROUP BY ALL)) WHERE i = 1)
SELECT grain, key, count(*) AS n, CAST(1000000000 + any_value(CAST(mode AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS mode_price,
       round(stddev_samp(part), 8) AS stddev_price
FROM grains JOIN modes USING (grain, key) GROUP BY grain, key""",
    "product_search_scripts": f"""
WITH {_SPELLED}
SELECT id, name, 1 AS score FROM spelled WHERE kind IN (1, 2, 3) ORDER BY score DESC, name, id LIMIT 20""",
    "name_cluster_scripts": f"""
WITH {_SPELLED},
counted AS (SELECT name, fingerprint, count(*) AS n FROM spelled GROUP BY ALL),
keyed AS (SELECT *, CASE WHEN fingerprint = '' THEN name ELSE ' ' || fingerprint END AS cluster FROM counted)
SELECT name, fingerprint, first_value(name) OVER (PARTITION BY cluster ORDER BY n DESC, name) AS canonical, n,
       CAST(sum(n) OVER (PARTITION BY cluster) AS BIGINT) AS cluster_n
FROM keyed""",
    "product_search": """
SELECT p_partkey AS id, p_name AS name,
       CAST(list_contains(w, 'small') AS INTEGER) + CAST(list_contains(w, 'red') AS INTEGER)
       + CAST(list_contains(w, 'widget') AS INTEGER) AS score
FROM (SELECT *, string_split(p_name, ' ') AS w FROM part)
WHERE score > 0 ORDER BY score DESC, name, id LIMIT 20""",
    "product_category": r"""
SELECT p_partkey AS id, p_name AS name,
       CASE WHEN regexp_matches(p_name, '\bring\b') THEN 'jewelry'
            WHEN regexp_matches(p_name, '\b(bolt|rod|plate)\b') THEN 'hardware'
            WHEN regexp_matches(p_name, '^(hot|cold)\b') THEN 'seasonal'
            WHEN regexp_matches(p_name, '\b(gear|gizmo|widget)\b') THEN 'machinery'
            ELSE 'other' END AS category
FROM part""",
    # what the patterns say, without patterns
    "product_category_rules": """
WITH parts AS (
  SELECT p_partkey AS id, p_name || ' ' || p_brand || ' no. ' || p_partkey AS name, split_part(p_name, ' ', 1) AS a,
         split_part(p_name, ' ', 2) AS b, CAST(split_part(p_brand, '#', 2) AS INTEGER) AS brand FROM part),
rules AS (
  SELECT c_custkey AS k, c_mktsegment || '-' || c_custkey AS category,
         CASE WHEN k % 4 = 0 THEN k WHEN k % 4 = 2 THEN 1000000000 + k WHEN k % 500 = 499 THEN 3000000000 + k ELSE 2000000000 + k END AS rule_no
  FROM customer),
hits AS (
  SELECT id, rule_no, category FROM parts JOIN rules ON
    CASE WHEN k % 500 = 499 THEN len(a) = 3 AND len(b) IN (3, 4)
         WHEN k % 4 = 0 THEN id = k
         WHEN k % 4 = 1 THEN a IN ('hot', 'cold') AND brand = k % 25 + 1
         WHEN k % 4 = 2 THEN b IN ('bolt', 'rod') AND brand = k % 25 + 1 AND id % 10 = k % 10
         ELSE a IN ('large', 'small') AND brand = k % 25 + 1 END),
best AS (SELECT id, arg_min(category, rule_no) AS category FROM hits GROUP BY id)
SELECT id, name, coalesce(category, 'other') AS category FROM parts LEFT JOIN best USING (id)""",
    "period_overlaps": f"""
WITH {_STEPS}, periods AS (
  SELECT DISTINCT CAST(o_orderdate AS DATE) AS first, CAST(CAST(o_orderdate AS DATE) + 6 AS DATE) AS last
  FROM orders WHERE o_orderstatus = 'P'),
reports AS (
  SELECT DISTINCT p_brand AS product, first, last FROM periods
  JOIN part ON CAST(split_part(p_brand, '#', 2) AS INTEGER) = date_diff('day', DATE '1970-01-01', first) % 25 + 1)
SELECT product, first, last, vendor, price, valid_from,
       CAST(date_diff('day', greatest(first, valid_from), least(last, coalesce(CAST(valid_to - 1 AS DATE), last))) + 1 AS INTEGER) AS days
FROM reports JOIN steps USING (product) WHERE valid_from <= last AND (valid_to IS NULL OR valid_to > first)""",
    "name_cluster": """
WITH spelled AS (
  SELECT list_aggregate(list_sort(string_split(p_name, ' ')), 'string_agg', ' ') AS fingerprint,
         CASE p_type WHEN 'PROMO' THEN upper(p_name)
                     WHEN 'LARGE' THEN split_part(p_name, ' ', 2) || ', ' || split_part(p_name, ' ', 1)
                     WHEN 'SMALL' THEN '* ' || p_name || ' *' ELSE p_name END AS name
  FROM part),
counted AS (SELECT name, fingerprint, count(*) AS n FROM spelled GROUP BY ALL)
SELECT name, fingerprint,
       first_value(name) OVER (PARTITION BY fingerprint ORDER BY n DESC, name) AS canonical, n,
       CAST(sum(n) OVER (PARTITION BY fingerprint) AS BIGINT) AS cluster_n
FROM counted""",
    "feed_dedup": """
SELECT user_id, event_type, day, event_id, value FROM (
  SELECT *, CAST(ts AS DATE) AS day,
         row_number() OVER (PARTITION BY user_id, event_type, CAST(ts AS DATE) ORDER BY event_id) AS i
  FROM events) WHERE i = 1""",
    "feed_dedup_stream": "SELECT DISTINCT user_id, event_type, CAST(ts AS DATE) AS day FROM events",
    "incremental_load": f"""
SELECT {_id("event_id", "event_type")} AS id, event_type AS dataset, CAST(ts AS DATE) AS start_date,
       user_id, CAST(value AS DECIMAL(18,4)) AS price FROM events""",
    "replace_range": f"WITH {_ORDERS} SELECT * FROM reloaded",
    # an empty dataset and none share a folder
    "archive_reload": f"""
WITH {_ORDERS}
SELECT id, CASE WHEN id % 7 > 1 THEN dataset END AS dataset, start_date, price FROM reloaded
WHERE start_date <> DATE '1996-07-01'""",
    "archive_range": f"WITH {_ORDERS} SELECT * FROM old WHERE start_date BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'",
    "archive_differences": f"""
WITH {_ORDERS}, {_PROCESSED}
SELECT id, dataset, start_date, price, greatest(n_left - n_right, 0) AS n_lost, greatest(n_right - n_left, 0) AS n_extra
FROM counted WHERE n_left <> n_right""",
    "archive_reconciled": f"""
WITH {_ORDERS}, {_PROCESSED_BLANK}
SELECT dataset, start_date, CAST(sum(n_left) AS BIGINT) AS n_left, CAST(sum(n_right) AS BIGINT) AS n_right,
       CAST(sum(least(n_left, n_right)) AS BIGINT) AS n_same, CAST(sum(greatest(n_left - n_right, 0)) AS BIGINT) AS n_lost,
       CAST(sum(greatest(n_right - n_left, 0)) AS BIGINT) AS n_extra
FROM counted GROUP BY ALL""",
    "archive_common": f"""
WITH {_ORDERS}
SELECT id, dataset, start_date, price FROM (SELECT *, unnest(range(CASE WHEN id % 13 = 2 THEN 2 ELSE 1 END)) FROM old)
WHERE id % 11 <> 5 AND id % 17 <> 3""",
    "event_fields": """
WITH texts AS (
  SELECT event_id, CASE event_id % 10 WHEN 1 THEN props[1:-2] WHEN 2 THEN '{"k": "x"}' WHEN 3 THEN '{"k": null}' WHEN 4 THEN NULL
         WHEN 5 THEN '{"d": {"x": [0, ' || event_id || ']}}' ELSE props END AS props, props AS whole
  FROM events)
SELECT event_id, props, event_id % 10 = 1 AS props_broken,
       CASE WHEN event_id % 10 NOT IN (1, 2, 3, 4, 5) THEN CAST(regexp_extract(whole, '[0-9]+') AS INTEGER) END AS k,
       CASE WHEN event_id % 10 = 5 THEN event_id END AS x, event_id % 10 = 2 AS k_mistyped, false AS x_mistyped
FROM texts""",
    "price_stats_range": """
SELECT p_brand, p_type, count(*) AS n, CAST(min(price) AS DECIMAL(18,4)) AS min_price, CAST(max(price) AS DECIMAL(18,4)) AS max_price,
       -- rounded half up in whole numbers
       CAST((2 * sum(CAST(price * 100 AS HUGEINT)) + count(*)) // (2 * count(*)) AS DOUBLE) / 100 AS avg_price, round(stddev_samp(price::DOUBLE), 2) AS stddev_price
FROM (SELECT p_brand, p_type, CAST(l_extendedprice AS DECIMAL(12,2)) AS price FROM lineitem JOIN part ON l_partkey = p_partkey
      WHERE CAST(l_shipdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31')
GROUP BY p_brand, p_type""",
    # a day is written as soon as a row a day past its end has come
    "daily_price_stream": """
WITH days AS (
  SELECT CAST(ts AS DATE) AS day, event_type AS dataset, 'v' || user_id % 5 AS vendor, count(*) AS n,
         CAST(min(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS min_price, CAST(max(CAST(value AS DECIMAL(18,4))) AS DECIMAL(18,4)) AS max_price,
         CAST(sum(CAST(value AS DECIMAL(18,4))) AS DECIMAL(28,4)) AS total
  FROM events GROUP BY ALL)
SELECT *, day + 2 > (SELECT max(ts) FROM events) AS is_open FROM days""",
    "report_csv_export": f"""
WITH {_BASKETS}
SELECT id, d.dataset, file_id, description, unit, vendor, price, currency, start_date, end_date
FROM baskets, (VALUES ('basic_baskets'), ('dairy_products')) d(dataset)""",
    "medicine_csv_export": f"""
WITH {_GRID}, {_MEDICINES}
SELECT id, variant, file_id, medication_name, dosage, maker, unit, vendor, price, currency, start_date, end_date
FROM medicines""",
    "feed_csv": _FLOWERS.format(text=_GROUPED, column="price"),
    "survey_end_to_end": f"""
WITH {_BASKETS}
SELECT {_obs_id("d.dataset", "'single'", "gcol")} AS id, d.dataset, file_id, description, unit, vendor, price, currency, start_date, end_date
FROM baskets, (VALUES ('hardware_products'), ('dairy_products')) d(dataset)
WHERE d.dataset <> 'hardware_products' OR file_id NOT IN (
  SELECT file_id FROM placed WHERE p_type = 'PROMO' AND p_brand = 'Brand#5' AND p_size <= 5)""",
    "medicine_survey": f"""
WITH {_GRID},
medicines AS (
  SELECT {_obs_id("'medicines'", "'single'", "4")} AS id, 'single' AS variant, file_id, p_name AS medication_name, p_type AS dosage,
         p_brand AS maker, CAST(p_size AS VARCHAR) AS unit, r_name AS vendor, CAST(low AS DECIMAL(18,4)) AS price,
         'DOP' AS currency, start_date, end_date
  FROM seen WHERE page_no % 2 = 1 AND r_name = 'AFRICA')
SELECT * FROM medicines WHERE file_id NOT IN (
  SELECT file_id FROM placed WHERE p_type = 'PROMO' AND p_brand = 'Brand#5' AND p_size <= 5)""",
    "feed_cleanup": """
WITH tidy AS (
  SELECT c_custkey, c_name || ' S.A.' AS vendor, CAST(c_acctbal AS DECIMAL(12,2)) AS balance,
         CASE WHEN c_mktsegment NOT IN ('BUILDING', 'MACHINERY') THEN c_mktsegment END AS unit
  FROM customer)
SELECT c_custkey, vendor, unit, lower(vendor) AS vendor_folded, lower(unit) AS unit_folded,
       CAST(CASE WHEN balance >= 0 THEN balance END AS DECIMAL(18,4)) AS price,
       CASE WHEN balance < 0 THEN '--' ELSE 'RD$ ' || balance END AS price_text,
       false AS price_too_large, balance < 0 AS price_missing
FROM tidy""",
    "daily_feed_load": f"""
SELECT {_id("('809-' || lpad(CAST(c_custkey AS VARCHAR), 7, '0'))", "('L' || c_custkey)", "'2020-01-15'")} AS id,
       'transportation_fees' AS dataset, DATE '2020-01-15' AS start_date, c_name AS representative,
       n_name || ' centro' AS stop, CAST(abs(CAST(c_acctbal AS DECIMAL(12,2))) AS DECIMAL(18,4)) AS cost
FROM customer JOIN nation ON c_nationkey = n_nationkey""",
}
ORACLES["link_markup_parsed"] = ORACLES["link_markup"]
ORACLES["link_extract_parsed"] = ORACLES["link_extract"]
ORACLES["page_first_text_parsed"] = ORACLES["page_first_text"]
ORACLES["archive_reload_in_place"] = ORACLES["archive_reload"]
ORACLES["product_search_indexed"] = ORACLES["product_search"]
ORACLES["product_search_indexed_scripts"] = ORACLES["product_search_scripts"]
ORACLES["grid_to_long_laid_out"] = ORACLES["grid_to_long"]
