"""The same results in plain SQL, computed by another engine from the same tables."""

from shelftrace.functions.text import WHITESPACE
from shelftrace.plans.feeds import EVENT_FEED, LEGACY_TABLE, ORDER_MOMENTS, RAW_FEED, SITE_STEPS


# Texts for a missing cell, written out apart from the code that is checked.
_TOKENS = (
    "'', '<NA>', 'N/A', 'NA', 'n/a', 'NULL', 'null', 'None', 'NaN', 'nan', '-NaN', '-nan',"
    " '#NA', '#N/A', '#N/A N/A', '1.#IND', '1.#QNAN', '-1.#IND', '-1.#QNAN'"
)


def _select(columns, table):
    listed = ",\n    ".join(f"{text.replace('TS', 'timestamp ')} AS {name}" for name, text in columns.items())
    return f"SELECT\n    {listed}\n  FROM {table}"


def _trim(c):
    return f"trim({c}, '{WHITESPACE}')"


_DECIMAL = r"([0-9]+([.][0-9]*)?|[.][0-9]+)"


def _price(c):
    text = f"replace({_trim(c)}, '_', '')"
    return (
        f"CASE WHEN regexp_matches({text}, '^[+-]?{_DECIMAL}([eE][+-]?[0-9]+)?$')"
        f" AND CAST({text} AS double) >= 0 THEN CAST({text} AS double) END"
    )


def _lenient(text, data_type):
    return (
        f"CASE WHEN regexp_matches({text}, '^ *[+-]?{_DECIMAL} *$')"
        f" THEN try_cast({text} AS {data_type}) END"
    )


def _price_reason(c):
    return (
        f"CASE WHEN {c} IS NULL THEN '{c}: Value error, Price is required'"
        f" WHEN ({_price(c)}) IS NULL"
        f" THEN '{c}: Value error, Price must be an integer or decimal number' END"
    )


_RAW = f"feed AS (\n  {_select(RAW_FEED, 'orders')}\n)"

def _present(columns):
    return ", ".join(f"CASE WHEN {c} NOT IN ({_TOKENS}) THEN {c} END AS {c}" for c in columns)


_SHEET = [c for c in RAW_FEED if c not in ("row_no", "batch_no")]

_CLASSIFIED = f"""{_RAW},
present AS (SELECT row_no, batch_no, {_present(_SHEET)} FROM feed),
judged AS (
  SELECT *, nullif(concat_ws(' | ',
      CASE WHEN sku IS NULL OR {_trim('sku')} = '' THEN 'sku: Value error, SKU is required' END,
      {_price_reason('current_price')},
      {_price_reason('old_price')}), '') AS validation_errors
  FROM present
)"""

_CLEANED = f"""{_CLASSIFIED},
cleaned AS (
  SELECT row_no, batch_no,
    {_trim('sku')} AS sku,
    {_trim('product_name')} AS product_name,
    {_trim('image_url')} AS image_url,
    {_trim('product_url')} AS product_url,
    {_price('current_price')} AS current_price,
    {_price('old_price')} AS old_price,
    CASE WHEN {_trim('discount')} = '' THEN NULL
         WHEN {_trim('discount')} LIKE '%\\%' ESCAPE '\\' THEN {_trim('discount')}
         ELSE {_trim('discount')} || '%' END AS discount,
    coalesce(nullif({_trim('rating')}, ''), 'no rating yet') AS rating,
    coalesce(nullif({_trim('reviews_count')}, ''), 'no reviews yet') AS reviews_count
  FROM judged WHERE validation_errors IS NULL
)"""


def _typed(source, name="typed", batch="batch_no"):
    percent = _lenient("replace(discount, '%', '')", "decimal(8,2)")
    count = _lenient("replace(reviews_count, ',', '')", "decimal(18,2)")
    cells = "current_price", "old_price", "discount_percent", "rating", "reviews_count"
    rest = " || '|' || ".join(f"coalesce(CAST({c} AS varchar), '')" for c in cells)
    return f"""{name}_0 AS (
  SELECT {batch} AS batch_no, row_no AS stage_id, sku, product_name, image_url, product_url,
    CAST(current_price AS decimal(18,2)) AS current_price,
    CAST(old_price AS decimal(18,2)) AS old_price,
    {percent} AS discount_percent,
    {_lenient('rating', 'decimal(4,2)')} AS rating,
    try_cast(trunc({count}) AS integer) AS reviews_count
  FROM {source}
  WHERE sku IS NOT NULL AND trim(sku) <> '' AND current_price IS NOT NULL AND old_price IS NOT NULL
),
{name} AS (
  SELECT *, sha256(coalesce(product_name, '') || '|' || coalesce(image_url, '') || '|'
      || coalesce(product_url, '') || '|' || {rest}) AS row_hash
  FROM {name}_0
)"""


def _versions(typed):
    return f"""latest AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY batch_no, sku ORDER BY stage_id DESC) AS rn
    FROM {typed}) WHERE rn = 1
),
compared AS (
  SELECT *, lag(row_hash) OVER (PARTITION BY sku ORDER BY batch_no) AS before FROM latest
),
versions AS (
  SELECT *, make_timestamp(batch_no, 1, 1, 0, 0, 0.0) AS st_date,
    lead(make_timestamp(batch_no, 1, 1, 0, 0, 0.0))
      OVER (PARTITION BY sku ORDER BY batch_no) AS end_date
  FROM compared WHERE before IS NULL OR before <> row_hash
)"""


_DOUBLES = {"current_price", "old_price", "discount_percent", "rating"}


def _doubles(*names):
    return ", ".join(f"CAST({n} AS double) AS {n}" if n in _DOUBLES else n for n in names)


_VERSION_ATTRIBUTES = _doubles(
    "sku", "product_name", "image_url", "product_url", "current_price", "old_price",
    "discount_percent", "rating", "reviews_count",
)
_VERSION_SELECT = f"""SELECT {_VERSION_ATTRIBUTES}, st_date, end_date,
  CAST(end_date IS NULL AS integer) AS iscurrent, row_hash
FROM versions"""

_HISTORY = f"WITH {_CLEANED},\n{_typed('cleaned')},\n{_versions('typed')}\n"

_LUMPED = "CASE WHEN batch_no <= 1998 THEN batch_no ELSE 2001 END"
_LUMPED_HISTORY = f"WITH {_CLEANED},\n{_typed('cleaned', batch=_LUMPED)},\n{_versions('typed')}\n"

# Dimension and incoming batch apart, for the two halves of the merge.
_TWO_LOADS = f"""WITH {_CLEANED},
{_typed('cleaned', batch=_LUMPED)},
{_versions("(SELECT * FROM typed WHERE batch_no <= 1998)")},
source AS (
  SELECT * FROM (
    SELECT *, row_number() OVER (PARTITION BY sku ORDER BY stage_id DESC) AS rn
    FROM typed WHERE batch_no = 2001) WHERE rn = 1
)
"""

_MIGRATED = f"""legacy AS (
  {_select(LEGACY_TABLE, 'customer')}
),
migrated AS (
  SELECT * EXCLUDE (effective_from, effective_to, iscurrent),
    CASE WHEN iscurrent IS NULL THEN coalesce(effective_from, created_at)
         ELSE effective_from END AS st_date,
    CASE WHEN iscurrent IS NULL THEN NULL ELSE effective_to END AS end_date,
    coalesce(iscurrent, 1) AS iscurrent
  FROM legacy
)"""


def _paged(number):
    return f"SELECT page_id, url, {number} AS page_no FROM pages"


# The query is cut into parameters; the first `page` with a value counts.
_PAGE_NO = (
    "coalesce(try_cast(url_decode(substr(list_filter(string_split(split_part("
    "split_part(url, '#', 1), '?', 2), '&'), lambda part: part LIKE 'page=_%')[1], 6))"
    " AS bigint), 1)"
)

_ORIGIN = r"regexp_extract(url, '^https?://[^/?#]*')"
_PATH = r"regexp_extract(url, '^https?://[^/?#]*([^?#]*)', 1)"
_FOLDER = rf"regexp_extract({_PATH}, '^.*/')"
_PARENT = rf"CASE WHEN {_FOLDER} = '/' THEN '/' ELSE regexp_replace({_FOLDER}, '[^/]*/$', '') END"

# Cards as they were put on the listing pages, and the records expected from them.
_CARDS = r"""numbered AS (
  SELECT c_custkey AS page_id, c_custkey + 1 AS page_no, CAST(i AS integer) AS position, c_custkey * 5 + i AS g
  FROM customer, unnest([0, 1, 2, 3, 4]) AS five(i)
),
products AS (SELECT *, g + 7 - (g * g) % 7 AS p FROM numbered),
records AS (
  SELECT page_id, page_no, position,
    CASE WHEN p % 11 <> 0 THEN 'P-' || p WHEN g % 13 <> 5 THEN 'G-' || p END AS sku,
    CASE WHEN p % 17 <> 3 THEN 'Item ' || p || ' & Co' END AS product_name,
    CASE g % 4 WHEN 0 THEN NULL WHEN 1 THEN '/i/' || p || '.jpg'
         ELSE 'https://shop.example.com/i/' || p || '.png' END AS image_url,
    CASE WHEN g % 13 <> 5 THEN 'https://shop.example.com/item-' || p || '.html' END AS product_url,
    CASE WHEN p % 19 <> 0 THEN CAST((p % 9 + 1) * 1000 + p % 1000 + 0.5 AS double) END AS current_price,
    CASE WHEN g % 3 <> 0 THEN CAST(9000 + p % 1000 AS double) END AS old_price,
    CASE WHEN g % 3 <> 0 THEN CAST(p % 90 AS double) END AS discount,
    CASE WHEN p % 6 <> 0 THEN CAST(p % 5 + 0.5 AS double) END AS rating,
    CASE WHEN p % 6 <> 0 AND p % 4 <> 0 THEN p % 700 END AS reviews_count
  FROM products
),
keyed AS (
  SELECT *, coalesce(sku, product_url, product_name) AS identity
  FROM records WHERE coalesce(sku, product_url, product_name) IS NOT NULL
)"""


def _rank_one(select, keys, order, table):
    return (
        f"SELECT {select} FROM (SELECT *, row_number() OVER"
        f" (PARTITION BY {keys} ORDER BY {order}) AS rn FROM {table}) WHERE rn = 1"
    )


# Crawls one page after another, with the pages seen so far.
_CRAWLS = f"""steps AS (
  {_select(SITE_STEPS, 'customer')}
),
walk AS (
  SELECT page AS start, page, 1 AS pages, [page] AS seen FROM steps
  WHERE CAST(substr(page, 2) AS bigint) % 50 = 0
  UNION ALL
  SELECT w.start, n.page, w.pages + 1, list_append(w.seen, n.page)
  FROM walk w JOIN steps s ON s.page = w.page JOIN steps n ON n.page = s.next
  WHERE NOT list_contains(w.seen, n.page) AND w.pages < <cap>
),
ends AS (
  SELECT * FROM (SELECT *, row_number() OVER (PARTITION BY start ORDER BY pages DESC) AS rn FROM walk)
  WHERE rn = 1
)
SELECT e.start, CAST(e.pages AS bigint) AS pages, e.page AS last_page, s.next AS next_page,
  CASE WHEN e.pages >= <cap> THEN 'page cap' WHEN s.next IS NULL THEN 'no next link'
       WHEN n.page IS NULL THEN 'page not stored' ELSE 'cycle' END AS outcome
FROM ends e JOIN steps s ON s.page = e.page LEFT JOIN steps n ON n.page = s.next"""

_LISTING_URL = "'https://shop.example.com/ar/all/?page=' ||"

_WS_CLASS = (
    r"[\x{0009}-\x{000d}\x{001c}-\x{0020}\x{0085}\x{00a0}\x{1680}"
    r"\x{2000}-\x{200a}\x{2028}\x{2029}\x{202f}\x{205f}\x{3000}]"
)
_PROFILED = (
    "sku", "product_name", "image_url", "product_url", "discount", "rating", "reviews_count",
)
_PHRASE = """'Rated ' || CAST(l_quantity AS varchar)
    || CASE WHEN l_returnflag = 'N' THEN ' of 5 (' ELSE '  Out of 5 (' END
    || CASE WHEN l_linenumber = 3 THEN '1,' ELSE '' END
    || CAST(l_suppkey * l_linenumber AS varchar) || ')'"""

SQL = {
    "csv_feed": f"WITH {_RAW}\nSELECT {_present(_SHEET)} FROM feed",
    "validate_feed": f"""WITH {_CLASSIFIED}
SELECT row_no, validation_errors IS NULL AS is_valid, validation_errors, {_trim('sku')} AS sku,
  {_price('current_price')} AS current_price, {_price('old_price')} AS old_price
FROM judged""",
    "error_summary": f"""WITH {_CLASSIFIED}
SELECT validation_errors, count(*) AS row_count FROM judged GROUP BY validation_errors""",
    "route_counts": f"""WITH {_CLASSIFIED}
SELECT validation_errors IS NULL AS is_valid, count(*) AS row_count FROM judged GROUP BY 1""",
    "quarantine_split": f"""WITH {_CLASSIFIED}
SELECT row_no, {_trim('sku')} AS sku, printf('%.2f', {_price('current_price')}) AS current_price,
  printf('%.2f', {_price('old_price')}) AS old_price, validation_errors
FROM judged WHERE validation_errors IS NULL
UNION ALL
SELECT row_no, sku, current_price, old_price, validation_errors
FROM judged WHERE validation_errors IS NOT NULL""",
    "clean_feed": f"WITH {_CLEANED}\nSELECT * FROM cleaned",
    "cleaned_table": f"WITH {_CLEANED}\nSELECT * FROM cleaned",
    "distinct_profile": f"""WITH {_CLEANED}
SELECT count(DISTINCT rating) AS distinct_rating,
  count(DISTINCT reviews_count) AS distinct_reviews_count FROM cleaned""",
    "column_profile": f"WITH {_CLEANED}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(least(greatest(length('{c}'),"
        f" coalesce(max(length({c})), 0)) + 2, 50) AS integer) AS display_width FROM cleaned"
        for c in _PROFILED
    ),
    "stage_batch": f"""WITH {_CLEANED}
SELECT row_no AS stage_id, 'orders.parquet' AS source_file, sku, product_name, image_url,
  product_url, current_price, old_price, discount, rating, reviews_count,
  CAST(batch_no AS varchar) AS load_batch_id
FROM cleaned""",
    "batch_counts": f"""WITH {_CLEANED}
SELECT CAST(batch_no AS varchar) AS load_batch_id, count(*) AS rows_staged,
  max(row_no) AS last_stage_id FROM cleaned GROUP BY batch_no""",
    "typed_feed": f"WITH {_CLEANED},\n{_typed('cleaned')}\nSELECT batch_no, stage_id, "
    f"{_VERSION_ATTRIBUTES} FROM typed",
    "row_fingerprint": f"WITH {_CLEANED},\n{_typed('cleaned')}\n"
    "SELECT stage_id, sku, row_hash FROM typed",
    "latest_per_key": f"WITH {_CLEANED}\n"
    + _rank_one(
        "batch_no, sku, row_no AS stage_id, product_name, current_price, old_price",
        "batch_no, sku", "row_no DESC", "cleaned",
    ),
    "first_per_key": f"""WITH {_RAW},
keyed AS (
  SELECT row_no, product_name, product_url,
    coalesce(nullif({_trim('sku')}, ''), nullif(image_url, ''), nullif(product_name, '')) AS identity
  FROM feed
)
"""
    + _rank_one(
        "identity, row_no, product_name, product_url", "identity", "row_no",
        "(SELECT * FROM keyed WHERE identity IS NOT NULL)",
    ),
    "changed_rows": f"""{_TWO_LOADS}
{_VERSION_SELECT} WHERE end_date IS NULL AND EXISTS (
  SELECT 1 FROM source WHERE source.sku = versions.sku AND source.row_hash <> versions.row_hash)""",
    "new_keys": f"""{_TWO_LOADS}
SELECT source.sku, source.stage_id, source.row_hash
FROM source LEFT JOIN (SELECT * FROM versions WHERE end_date IS NULL) AS now
  ON now.sku = source.sku
WHERE now.sku IS NULL OR now.row_hash <> source.row_hash""",
    "scd2_merge": f"{_LUMPED_HISTORY}{_VERSION_SELECT}",
    "scd2_history": f"{_HISTORY}{_VERSION_SELECT}",
    "scd2_current": f"{_HISTORY}{_VERSION_SELECT} WHERE end_date IS NULL",
    "scd2_as_of": f"{_HISTORY}{_VERSION_SELECT} WHERE st_date <= TIMESTAMP '1998-07-01'"
    " AND (end_date IS NULL OR end_date > TIMESTAMP '1998-07-01')",
    "merge_counts": f"{_HISTORY}SELECT st_date, count(*) AS rows_inserted FROM versions GROUP BY st_date",
    "scd2_incremental": f"{_HISTORY}{_VERSION_SELECT}",
    "scd2_events": f"""WITH event_feed AS (
  {_select(EVENT_FEED, 'events')}
),
latest AS (
  SELECT *, CAST(batch_date AS timestamp) AS st_date,
    sha256(coalesce(event_type, '') || '|' || coalesce(CAST(level AS varchar), '')) AS row_hash
  FROM (SELECT *, row_number() OVER (PARTITION BY sku, batch_date ORDER BY stage_id DESC) AS rn
        FROM event_feed) WHERE rn = 1
),
compared AS (
  SELECT *, lag(row_hash) OVER (PARTITION BY sku ORDER BY st_date) AS before FROM latest
),
versions AS (
  SELECT *, lead(st_date) OVER (PARTITION BY sku ORDER BY st_date) AS end_date
  FROM compared WHERE before IS NULL OR before <> row_hash
)
SELECT sku, event_type, level, st_date, end_date,
  CAST(end_date IS NULL AS integer) AS iscurrent, row_hash FROM versions""",
    "scd2_bootstrap": f"""WITH {_MIGRATED}
SELECT product_id, sku, created_at, st_date, end_date, iscurrent FROM migrated""",
    "hash_backfill": f"""WITH {_MIGRATED}
SELECT product_id, sku, coalesce(row_hash, sha256(coalesce(product_name, '') || '|'
  || coalesce(image_url, '') || '|' || coalesce(product_url, '') || '|'
  || coalesce(CAST(current_price AS varchar), '') || '|'
  || coalesce(CAST(old_price AS varchar), '') || '|'
  || coalesce(CAST(discount_percent AS varchar), '') || '|'
  || coalesce(CAST(rating AS varchar), '') || '|'
  || coalesce(CAST(reviews_count AS varchar), ''))) AS row_hash
FROM migrated""",
    "current_export": f"""WITH {_MIGRATED}
SELECT product_id, {_VERSION_ATTRIBUTES},
  strftime(st_date, '%Y-%m-%d %H:%M:%S') AS st_date,
  strftime(end_date, '%Y-%m-%d %H:%M:%S') AS end_date, iscurrent
FROM migrated WHERE iscurrent = 1 ORDER BY product_id""",
    "export_profile": f"WITH {_MIGRATED}\n"
    + "\nUNION ALL ".join(
        f"SELECT '{c}' AS column_name, CAST(least(greatest(length('{c}'),"
        f" coalesce(max(length(CAST({c} AS varchar))), 0)) + 2, 50) AS integer) AS display_width"
        " FROM migrated WHERE iscurrent = 1"
        for c in ("product_id", "sku", "product_name", "product_url", "reviews_count")
    )
    + "\nUNION ALL SELECT 'st_date', 22 UNION ALL SELECT 'end_date', 22",
    "page_number": _paged(_PAGE_NO),
    "page_sequence_check": f"""SELECT page_id, {_PAGE_NO} AS actual_page,
  page_id % 10 + 1 AS expected_page
FROM pages WHERE {_PAGE_NO} <> page_id % 10 + 1""",
    "first_pages": """SELECT c_custkey AS page_id, c_custkey + 1 AS page_no
FROM customer WHERE c_custkey + 1 BETWEEN 1 AND 10""",
    "page_links": f"""WITH found AS (
  SELECT page_id, url, regexp_extract_all(html, '<a href="([^"]*)"', 1) AS refs FROM pages
),
listed AS (
  SELECT page_id, url, CAST(unnest(range(len(refs))) AS integer) AS position, unnest(refs) AS href
  FROM found
)
SELECT page_id, position, href, {_ORIGIN} || href AS link FROM listed""",
    "next_page": """SELECT c_custkey AS page_id,
  'https://shop.example.com/ar/all/?page=' || (c_custkey + 1) AS url,
  CASE WHEN (c_custkey + 1) % 10 <> 0 THEN '?page=' || (c_custkey + 2) || '&sort=a' END AS next_href,
  CASE WHEN (c_custkey + 1) % 10 <> 0
       THEN 'https://shop.example.com/ar/all/?page=' || (c_custkey + 2) || '&sort=a' END AS next_url
FROM customer""",
    "missing_next_page": """SELECT c_custkey AS page_id,
  'https://shop.example.com/ar/all/?page=' || (c_custkey + 1) AS url
FROM customer WHERE (c_custkey + 1) % 10 = 0""",
    "link_resolve": "\nUNION ALL ".join(
        f"SELECT page_id, url, {ref} AS ref, {link} AS link FROM pages"
        for ref, link in [
            ("'/p' || page_id || '.html'", f"{_ORIGIN} || '/p' || page_id || '.html'"),
            ("'q' || page_id || '.html'", f"{_ORIGIN} || {_FOLDER} || 'q' || page_id || '.html'"),
            ("'?page=' || page_id", f"{_ORIGIN} || {_PATH} || '?page=' || page_id"),
            ("'#a' || page_id", "regexp_replace(url, '#.*$', '') || '#a' || page_id"),
            ("'//c.example/z' || page_id",
             "regexp_extract(url, '^https?:') || '//c.example/z' || page_id"),
            ("'../u' || page_id", f"{_ORIGIN} || ({_PARENT}) || 'u' || page_id"),
        ]
    ),
    "unique_by_page": f"""WITH {_RAW},
rows AS (
  SELECT CAST(floor(row_no / 100) AS bigint) + 1 AS page_no, nullif({_trim('sku')}, '') AS sku FROM feed
),
pages_of AS (SELECT page_no, count(DISTINCT sku) AS unique_on_page FROM rows
  WHERE sku IS NOT NULL GROUP BY page_no),
firsts AS (SELECT page_no, count(*) AS new_products FROM
  (SELECT sku, min(page_no) AS page_no FROM rows WHERE sku IS NOT NULL GROUP BY sku)
  GROUP BY page_no)
SELECT page_no, unique_on_page, coalesce(new_products, 0) AS new_products,
  CAST(sum(coalesce(new_products, 0)) OVER (ORDER BY page_no) AS bigint) AS total_unique
FROM pages_of LEFT JOIN firsts USING (page_no)""",
    "text_normalise": f"""SELECT doc_id,
  CASE WHEN text <> '' THEN {_trim(f"regexp_replace(text, '{_WS_CLASS}+', ' ', 'g')")} END AS collapsed,
  {_trim('text')} AS stripped
FROM documents""",
    "load_counts": f"""{_HISTORY},
judged_by AS (
  SELECT batch_no, count(*) FILTER (validation_errors IS NULL) AS valid,
    count(*) FILTER (validation_errors IS NOT NULL) AS invalid FROM judged GROUP BY batch_no
),
opened_by AS (SELECT batch_no, count(*) AS inserted FROM versions GROUP BY batch_no)
SELECT CAST(batch_no AS varchar) AS batch_id, valid, invalid, valid AS staged,
  coalesce(inserted, 0) AS inserted
FROM judged_by LEFT JOIN opened_by USING (batch_no)""",
    "product_ids": f"""{_HISTORY},
opened_by AS (SELECT st_date, count(*) AS products FROM versions GROUP BY st_date)
SELECT st_date, products, products AS distinct_ids,
  CAST(sum(products) OVER (ORDER BY st_date) - products + 1 AS bigint) AS first_id,
  CAST(sum(products) OVER (ORDER BY st_date) AS bigint) AS last_id
FROM opened_by""",
    "landing_load": f"{_HISTORY}{_VERSION_SELECT}",
    "export_file": f"""WITH {_MIGRATED}
SELECT row_number() OVER (ORDER BY product_id) AS place, product_id, {_VERSION_ATTRIBUTES},
  st_date, end_date, iscurrent
FROM migrated WHERE iscurrent = 1""",
    "extract_counts": """SELECT c_custkey AS page_id, 5 AS cards, 0 AS failures
FROM customer""",
    "first_number": """SELECT doc_id, CAST(nullif(regexp_extract(replace(text, ',', ''),
  '[0-9]+(?:[.][0-9]+)?'), '') AS double) AS number
FROM documents""",
    "phrase_extract": f"""WITH phrases AS (
  SELECT l_orderkey, l_linenumber, {_PHRASE} AS phrase FROM lineitem
)
SELECT l_orderkey, l_linenumber,
  CAST(nullif(regexp_extract(phrase, '(?i)([0-9]+(?:[.][0-9]+)?)\\s*out of\\s*5', 1), '') AS double)
    AS rating,
  CAST(nullif(regexp_extract(phrase, '\\(([0-9]+)\\)', 1), '') AS bigint) AS reviews
FROM phrases""",
    "card_extract": f"WITH {_CARDS}\nSELECT * FROM records",
    "page_catalogue": f"WITH {_CARDS}\n"
    + _rank_one("* EXCLUDE (rn)", "page_id, identity", "position", "keyed"),
    "card_catalogue": f"WITH {_CARDS}\n"
    + _rank_one("* EXCLUDE (rn)", "identity", "page_no, page_id, position", "keyed"),
    "migrated_table": f"""WITH legacy AS (
  {_select(LEGACY_TABLE, 'customer')}
)
SELECT product_id, sku, CAST(current_price AS double) AS current_price, created_at,
  effective_from AS st_date, effective_to AS end_date, CAST(NULL AS integer) AS iscurrent
FROM legacy""",
    "untidy_headers": f"WITH {_RAW}\nSELECT * EXCLUDE (row_no, batch_no) FROM feed",
    "partial_clean": f"WITH {_CLEANED}\nSELECT * EXCLUDE (rating, discount) FROM cleaned",
    "distinct_sketches": f"""WITH {_CLEANED}
SELECT batch_no, count(DISTINCT discount) AS distinct_discount,
  count(DISTINCT rating) AS distinct_rating, count(DISTINCT reviews_count) AS distinct_reviews_count
FROM cleaned GROUP BY GROUPING SETS ((batch_no), ())""",
    "price_at_order": f"""{_HISTORY},
moments AS (
  {_select(ORDER_MOMENTS, 'orders').replace('timestamp_ntz', 'timestamp')}
)
SELECT m.row_no, m.sku, m.moment, v.st_date, CAST(v.current_price AS double) AS current_price, v.row_hash
FROM moments m LEFT JOIN versions v ON v.sku = m.sku AND v.st_date <= m.moment
  AND (v.end_date IS NULL OR m.moment < v.end_date)""",
    "stream_changes": f"""{_HISTORY}SELECT sku, st_date AS change_time, stage_id, row_hash,
  'opened' AS kind FROM versions""",
    "landing_files": f"""WITH {_CLEANED}
SELECT count(*) AS rows_staged, count(*) AS rows_named, CAST(1 AS bigint) AS batches FROM cleaned""",
    "page_runs": f"""WITH numbered AS (
  SELECT regexp_extract(url, '^https?://([^/?#]*)', 1) AS host, {_PAGE_NO} AS page FROM pages
),
counted AS (SELECT host, page, count(*) AS times FROM numbered GROUP BY host, page),
islands AS (
  SELECT *, page - row_number() OVER (PARTITION BY host ORDER BY page) AS island FROM counted
),
runs AS (
  SELECT host, min(page) AS first_page, max(page) AS last_page, count(*) AS pages,
    CAST(sum(times - 1) AS bigint) AS repeated FROM islands GROUP BY host, island
)
SELECT *, first_page - coalesce(lag(last_page) OVER (PARTITION BY host ORDER BY first_page), 0) - 1
  AS missing_before FROM runs""",
    "crawl_order": f"""SELECT {_LISTING_URL} (c_custkey - c_custkey % 10 + 1) AS start,
  c_custkey % 10 AS position, {_LISTING_URL} (c_custkey + 1) AS page FROM customer""",
    "crawl_report": "WITH RECURSIVE " + _CRAWLS.replace("<cap>", "1000000000"),
    "crawl_report_capped": "WITH RECURSIVE " + _CRAWLS.replace("<cap>", "30"),
    "crawl_catalogue": f"WITH {_CARDS}\n"
    + _rank_one(
        f"{_LISTING_URL} (page_id - page_id % 10 + 1) AS start, identity, page_id % 10 AS crawl_position,"
        " page_id, position, product_name, current_price",
        "page_id - page_id % 10, identity", "page_id, position", "keyed",
    ),
    "card_quarantine": f"""WITH {_CARDS}
SELECT page_id, position, CASE WHEN g % 29 <> 7 THEN sku END AS sku,
  CASE WHEN g % 29 <> 7 THEN product_name END AS product_name,
  CASE WHEN g % 29 = 7 THEN 'ValueError' END AS error
FROM records JOIN (SELECT page_id, position, g FROM numbered) USING (page_id, position)""",
    "sql_rules": f"""WITH {_RAW}
SELECT row_no, {_trim('sku')} AS sku, {_price('current_price')} AS current_price,
  CAST({_lenient("replace(discount, '%', '')", 'decimal(8,2)')} AS double) AS discount,
  CAST({_lenient('rating', 'decimal(4,2)')} AS double) AS rating,
  try_cast(trunc({_lenient("replace(reviews_count, ',', '')", 'decimal(18,2)')}) AS integer) AS reviews_count,
  CAST(nullif(regexp_extract(replace(product_url, ',', ''), '[0-9]+(?:[.][0-9]+)?'), '') AS double) AS number
FROM feed""",
    "sql_cards": f"""WITH {_CARDS}
SELECT page_id, count(*) AS cards, count(*) FILTER (p % 11 <> 0) AS with_sku,
  count(*) FILTER (g % 13 <> 5) AS with_link, max(position) AS last_position
FROM products GROUP BY page_id""",
}
