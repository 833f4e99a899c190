"""Checking SQL for the registered queries, written for DuckDB over the same given tables.

Where it can, the SQL states the expected answer from the way the input was built (a page's number tells
which link was put into it) and never looks at the derived text.
"""

from __future__ import annotations

from wavetrawl.functions.language import STOP_WORDS
from wavetrawl.plans import fixtures

SQL: dict[str, str] = {}

_P, _L, _R = f"({fixtures.PAGES}) p", f"({fixtures.LINKS}) l", f"({fixtures.RECORDS}) r"
_I, _S, _A = f"({fixtures.ITEMS}) i", f"({fixtures.SNAPSHOTS}) s", f"({fixtures.ARCHIVE_PATHS}) a"

_JAPANESE = "language IN ('ja', 'ja_JP', 'ja-jp', 'ja-JP')"
_FILLED = "audio_url IS NOT NULL AND audio_url <> ''"

# Snapshots and archives

_DATED = f"""
SELECT *, cast(strptime(y || '-01-04', '%Y-%m-%d') AS date) AS jan4 FROM (
  SELECT row_id, id, split_part(id, '-', 3) AS y, try_cast(split_part(id, '-', 4) AS int) AS w
  FROM {_S} WHERE len(string_split(id, '-')) = 4)"""
_RANGE = f"""
SELECT row_id, id, y || '-' || lpad(cast(w AS varchar), 2, '0') AS snapshot_id, cast(monday AS varchar) AS monday
FROM (SELECT *, cast(date_trunc('week', jan4) AS date) + 7 * (w - 1) AS monday FROM ({_DATED})
  WHERE w BETWEEN 1 AND 53 AND cast(y AS int) >= 2013)
WHERE isoyear(monday) = cast(y AS int) AND monday BETWEEN DATE '2013-03-04' AND DATE '2022-07-25'"""

SQL["snapshot_scan"] = f"SELECT DISTINCT id FROM {_S}"
SQL["snapshot_range"] = _RANGE
SQL["snapshot_paths"] = f"""
SELECT DISTINCT snapshot_id,
  'https://data.commoncrawl.org/crawl-data/CC-MAIN-' || snapshot_id || '/warc.paths.gz' AS url FROM ({_RANGE})"""
SQL["path_list_scan"] = f"SELECT snapshot_id, 'https://data.commoncrawl.org/' || path AS url FROM {_A}"
SQL["path_list_roundtrip"] = SQL["path_list_scan"]
SQL["path_list_split"] = f"""{SQL["path_list_scan"]} UNION ALL
SELECT snapshot_id, 'https://data.commoncrawl.org/' || path || '.idx' FROM {_A}"""
_NAME = "'CC-MAIN-' || lpad(cast(row_id AS varchar), 10, '0')"
SQL["archive_names"] = f"""
SELECT row_id, {_NAME} || '.warc.gz' AS archive, {_NAME} || '.jsonl' AS output_name, {_NAME} AS output_dir FROM {_A}"""
SQL["first_n_archives"] = f"SELECT snapshot_id, path FROM {_A} ORDER BY path LIMIT 100"
SQL["pending_archives"] = f"""
SELECT row_id, snapshot_id, {_NAME} || '.warc.gz' AS archive FROM {_A} WHERE state <> 'F'"""
SQL["crawl_records_scan"] = f"""
SELECT rec_type, target_uri, coalesce(content_type, '') AS content_type, cast(strlen(body) AS bigint) AS n_bytes,
  md5(body) AS digest FROM {_R} WHERE rec_type = 'response'"""

SQL["header_texts"] = f"""
SELECT source, record_id, coalesce(content_type || CASE WHEN record_id % 3 = 0 THEN '�' ELSE '' END, '') AS content_type
FROM {_R}"""
SQL["html_records_scan"] = f"""
SELECT rec_type, target_uri, content_type FROM {_R} WHERE rec_type = 'response' AND content_type LIKE '%html%'"""
SQL["range_archives"] = f"""
SELECT snapshot_id, path FROM {_A} WHERE snapshot_id BETWEEN '2014-01' AND '2018-30'"""

# Link tables in files

_PUBLISHED = f"SELECT audio_url, title, description, language, page_url FROM {_L}"
SQL["jsonl_roundtrip"] = _PUBLISHED
SQL["compact_links"] = _PUBLISHED
SQL["compact_report"] = f"""
SELECT 'packed' AS outcome, CAST(NULL AS VARCHAR) AS file, count(*) AS n FROM {_L}
UNION ALL SELECT 'broken', NULL, count(*) FROM {_L} WHERE link_pos % 41 = 2
UNION ALL SELECT 'damaged', 'cut.json.gz', 1"""
SQL["publish_links"] = _PUBLISHED
SQL["language_counts_scan"] = f"SELECT language, count(*) AS count FROM {_L} GROUP BY 1"
_FIRSTS = f"""
SELECT link_pos, archive, audio_url, title, description, language, page_url FROM {_L} WHERE {_FILLED}
QUALIFY row_number() OVER (PARTITION BY audio_url ORDER BY archive, link_pos) = 1"""
SQL["incremental_links"] = _FIRSTS
SQL["global_link_dedup"] = _FIRSTS

# Records and pages

SQL["html_responses"] = f"""
SELECT source, record_id, target_uri, content_type FROM {_R}
WHERE rec_type = 'response' AND content_type LIKE '%html%'"""
_SCRIPTS = fixtures.SCRIPTS.replace("octet_length(text)", "strlen(text)")
SQL["decode_pages"] = rf"""
SELECT doc_id, md5(t) AS digest, cast(length(t) AS bigint) AS n_chars FROM (SELECT doc_id, CASE
  WHEN charset IS NULL AND doc_id % 3 > 0 AND NOT regexp_matches(text, '[^\x00-\x{{ff}}]')
    THEN '<meta charset="iso-8859-1">' || text ELSE text END AS t FROM ({_SCRIPTS}))"""
SQL["pages_by_lang_attr"] = "SELECT page_id, url FROM pages WHERE page_id % 5 = 0"
SQL["feed_records"] = f"""
SELECT source, record_id, target_uri FROM {_R}
WHERE content_type LIKE '%xml%' OR regexp_matches(body, '^\\s*(<\\?xml|<rss|<feed)')""".replace("\\\\", "\\")

# What may stand in a tag: anything but ">", which only a value in quotes may hold.
_INSIDE = r"(?:[^>=]|=\s*\x22[^\x22]*\x22|=\s*\x27[^\x27]*\x27|=)*"
_TAG = f"</?[a-zA-Z]{_INSIDE}>"
_ANY_TOKEN = "|".join(
    (r"(?is)<script\b.*?</script\s*>", r"<style\b.*?</style\s*>", "<!--.*?-->", _TAG, "<[!?][^>]*>", "[^<]+", "<")
)
_TOKENS = f"""
SELECT page_id, pos - 1 AS pos, tokens[pos] AS token FROM (
  SELECT page_id, tokens, unnest(generate_series(1, len(tokens))) AS pos FROM (
    SELECT page_id, regexp_extract_all(html, '{_ANY_TOKEN}') AS tokens FROM {_P}))"""
SQL["page_tokens"] = f"""
SELECT page_id, pos, CASE
    WHEN token ILIKE '<script%' THEN 'script' WHEN token ILIKE '<style%' THEN 'style'
    WHEN token LIKE '<!--%' THEN 'comment' WHEN token LIKE '<!%' OR token LIKE '<?%' THEN 'declaration'
    WHEN regexp_matches(token, '^</[a-zA-Z]') THEN 'close' WHEN regexp_matches(token, '^<[a-zA-Z]') THEN 'open'
    ELSE 'text' END AS kind,
  CASE WHEN regexp_matches(token, '^</?[a-zA-Z]') AND token NOT ILIKE '<script%' AND token NOT ILIKE '<style%'
    THEN lower(regexp_extract(token, '^</?([a-zA-Z][^ />]*)', 1)) ELSE '' END AS name, token
FROM ({_TOKENS})"""


def _decoded(text: str) -> str:
    for name, char in (("copy", "©"), ("middot", "·"), ("quot", '"'), ("amp", "&")):
        text = rf"regexp_replace({text}, '&{name}(;|\b)', '{char}', 'g')"
    return text


_FLAT = r"trim(regexp_replace({}, '\s+', ' ', 'g'))"
SQL["page_titles"] = rf"""
SELECT page_id, CASE WHEN len(h) = 1 AND h[1] <> '' THEN h[1] ELSE t END AS title FROM (
  SELECT page_id, {_FLAT.format(_decoded("regexp_extract(html, '<title>([^<]*)</title>', 1)"))} AS t,
    list_transform(regexp_extract_all(html, '(?s)<h1>(.*?)</h1>', 1),
      lambda x: {_FLAT.format(_decoded(f"regexp_replace(x, '{_TAG}', '', 'g')"))}) AS h
  FROM {_P})"""

_GONE = "|".join(
    rf"<{tag}\b.*?</{tag}\s*>"
    for tag in ("script", "style", "nav", "footer", "aside", "table", "noscript", "form", "title")
)
_BLOCK_CUT = (
    r"(?i)</?(?:address|article|blockquote|body|br|dd|div|dl|dt|figcaption|figure|h[1-6]|head|header|hr|html|li|main"
    rf"|ol|p|pre|section|title|ul)(?:[\s/]{_INSIDE})?>"
)
_RAW_BLOCKS = rf"""
SELECT page_id, string_split(regexp_replace(regexp_replace(html, '(?is)<!--.*?-->|{_GONE}', chr(1), 'g'),
  '{_BLOCK_CUT}', chr(1), 'g'), chr(1)) AS raw FROM {_P}"""
_BARE_BLOCK = _FLAT.format(_decoded(f"regexp_replace(b, '{_TAG}', '', 'g')"))
_LINK_TEXTS = rf"array_to_string(regexp_extract_all(b, '(?is)<a(?:\s{_INSIDE})?>(.*?)</a>', 1), '')"
_LINKED = _FLAT.format(_decoded(f"regexp_replace({_LINK_TEXTS}, '{_TAG}', '', 'g')"))
_JUDGED = rf"""
SELECT *, linked <= length(block) * 0.3 AS clean, linked <= length(block) * 0.3 AND (
    length(block) + 2 * length(regexp_replace(block, '[^\x{{3040}}-\x{{30ff}}\x{{3400}}-\x{{9fff}}\x{{ac00}}-\x{{d7af}}]', '', 'g')) >= 25
    OR regexp_matches(block, '[.!?…。．！？][\])"\x27”’»」』）]*$')) AS counts
FROM (SELECT page_id, i, {_BARE_BLOCK} AS block, length({_LINKED}) AS linked
  FROM (SELECT page_id, unnest(raw) AS b, generate_subscripts(raw, 1) AS i FROM ({_RAW_BLOCKS})))
WHERE block <> ''"""
_BLOCKS = f"""
SELECT page_id, i, block FROM (
  SELECT *, lag(counts, 1, false) OVER w AND lead(counts, 1, false) OVER w AS inside FROM ({_JUDGED})
  WINDOW w AS (PARTITION BY page_id ORDER BY i))
WHERE counts OR (clean AND inside)
QUALIFY row_number() OVER (PARTITION BY page_id, block ORDER BY i) = 1"""
SQL["page_main_text"] = f"""
SELECT p.page_id, coalesce(t.text, '') AS text FROM pages p LEFT JOIN (
  SELECT page_id, string_agg(block, chr(10) ORDER BY i) AS text FROM ({_BLOCKS}) GROUP BY 1) t USING (page_id)"""
SQL["repeated_blocks"] = f"""
SELECT page_id, row_number() OVER (PARTITION BY page_id ORDER BY i) - 1 AS pos, block FROM ({_BLOCKS})
QUALIFY count(*) OVER (PARTITION BY block) <= 1"""
_VOTES = ", ".join(
    f"len(list_filter(w, lambda x: x IN ({', '.join(repr(s) for s in words)}))) AS {lang}"
    for lang, words in sorted(STOP_WORDS.items())
)


def _with_language(rows: str) -> str:
    """The rows of a query with a column ``text``, and ``detected``."""
    return rf"""
SELECT * EXCLUDE (w, kana, letters, de, en, es, fr), CASE WHEN kana > 0 AND kana >= letters * 0.1 THEN 'ja'
  WHEN greatest(de, en, es, fr) = 0 THEN NULL WHEN de = greatest(de, en, es, fr) THEN 'de'
  WHEN en = greatest(de, en, es, fr) THEN 'en' WHEN es = greatest(de, en, es, fr) THEN 'es' ELSE 'fr' END AS detected
FROM (SELECT *, {_VOTES} FROM (
  SELECT *, regexp_split_to_array(lower(text), '[^\p{{L}}]+') AS w,
    length(regexp_replace(text, '[^ぁ-ゖァ-ヺ]', '', 'g')) AS kana,
    length(regexp_replace(text, '\P{{L}}', '', 'g')) AS letters FROM ({rows})))"""


SQL["detect_language"] = f"SELECT doc_id, detected FROM ({_with_language(fixtures.DOCUMENTS)})"
_GOOD_PAGES = f"""
SELECT page_id, title, url, text FROM ({_with_language(SQL["page_main_text"])}) JOIN ({SQL["page_titles"]}) USING (page_id)
JOIN pages USING (page_id) WHERE detected = 'en' AND text <> '' AND title <> ''"""
SQL["good_page_texts"] = _GOOD_PAGES

# Links of pages, stated from the page number

_ORIGIN = "regexp_extract(url, '^(https?://[^/?#]+)', 1)"
_DIR = "regexp_replace(regexp_replace(url, '[?#].*$', ''), '[^/]*$', '')"
_N = "cast(page_id AS varchar)"
_TAIL_TEXT = _decoded("trim(regexp_extract(html, '([^<>]+)(?:<[^<>]*>)*</article>', 1))")
_FOOT_TEXT = _decoded("trim(regexp_extract(html, '<footer>([^<]*)', 1))")
_CANDIDATES = f"""
SELECT page_id, url, 1 AS pass, {_ORIGIN} || '/ep/' || {_N} || '.mp3' AS audio_url, 'Episode ' || {_N} AS description,
  '' AS license FROM pages WHERE page_id % 6 = 0
UNION ALL SELECT page_id, url, unnest([1, 2]), {_DIR} || 'a' || {_N} || '.ogg', 'Show end', 'CC-BY'
  FROM pages WHERE page_id % 6 = 1
UNION ALL SELECT page_id, url, 2, 'https://cdn.example.org/f/' || {_N} || '.MP3?dl=1', 'Get the file', ''
  FROM pages WHERE page_id % 6 = 2
UNION ALL SELECT page_id, url, 2, split_part(url, ':', 1) || '://cdn.example.org/x/../' || {_N} || '.wav',
  unnest(['Twice one', 'two']), '' FROM pages WHERE page_id % 6 = 3
UNION ALL SELECT page_id, url, 2, {_ORIGIN} || '/l/' || {_N} || '.flac',
  substring(trim({_TAIL_TEXT} || ' ' || {_FOOT_TEXT}), 1, 100), '' FROM pages WHERE page_id % 6 = 4"""
_PAGE_LINKS = f"""
SELECT page_id, url, audio_url, description, license FROM ({_CANDIDATES}) WHERE description <> 'two'
QUALIFY row_number() OVER (PARTITION BY page_id, audio_url ORDER BY pass) = 1"""
SQL["extract_audio_links"] = _PAGE_LINKS
SQL["page_route_links"] = f"""
SELECT l.url, title, audio_url, description, license FROM ({_PAGE_LINKS}) l JOIN ({_GOOD_PAGES}) USING (page_id)
JOIN pages p USING (page_id)
WHERE page_id % 5 <> 0 AND page_id % 7 <> 0 AND page_id % 4 IN (0, 1) AND p.html LIKE '%<html lang="en%'"""
SQL["audio_tag_links"] = f"SELECT page_id, audio_url FROM ({_CANDIDATES}) WHERE pass = 1"
SQL["general_tag_links"] = f"SELECT page_id, audio_url FROM ({_CANDIDATES}) WHERE pass = 2"
SQL["page_link_dedup"] = f"SELECT page_id, audio_url, description, license FROM ({_PAGE_LINKS})"
SQL["link_context"] = f"SELECT page_id, cast(pass AS bigint) AS pass, audio_url, description FROM ({_CANDIDATES})"
SQL["link_license"] = f"SELECT page_id, audio_url, license FROM ({_CANDIDATES}) WHERE license <> ''"

# Links of feeds, stated from the order key

_SHAPES = """
SELECT o_orderkey AS k, o_orderpriority AS prio, lower(n_name) AS lang,
  CASE WHEN o_orderkey % 11 = 3 THEN 'rdf' WHEN o_orderkey % 13 = 4 THEN 'cut' WHEN o_orderkey % 17 = 5 THEN 'junk'
    WHEN o_orderkey % 19 = 6 THEN 'atom' WHEN o_orderkey % 23 = 7 THEN 'stray' WHEN o_orderkey % 29 = 8 THEN 'deep'
    WHEN o_orderkey % 31 = 9 THEN 'late' ELSE 'rss' END AS shape
FROM orders JOIN customer ON o_custkey = c_custkey JOIN nation ON c_nationkey = n_nationkey"""
_FEED_ITEMS = f"""
SELECT k, lang, prio, 0 AS item_pos, k % 4 AS kind FROM ({_SHAPES}) WHERE shape NOT IN ('junk', 'atom')
UNION ALL SELECT k, lang, prio, 1, (k + 1) % 4 FROM ({_SHAPES}) WHERE shape NOT IN ('junk', 'atom', 'cut')"""
_ITEM_TEXTS = """CASE kind WHEN 0 THEN 'Order ' || k || ' & more' WHEN 3 THEN '' ELSE 'Order ' || k END AS title,
  CASE kind WHEN 0 THEN prio ELSE '' END AS description, lang AS language"""
SQL["feed_items"] = f"""
SELECT 'https://feeds.example.org/' || k AS page_url,
  'https://a.example.com/' || k || CASE kind WHEN 0 THEN '.mp3' ELSE '.m4a' END AS audio_url, {_ITEM_TEXTS}
FROM ({_FEED_ITEMS}) WHERE kind IN (0, 1)"""
SQL["feed_route"] = SQL["feed_items"]
SQL["clean_feed_text"] = f"""
SELECT k AS feed_id, cast(item_pos AS bigint) AS item_pos, {_ITEM_TEXTS} FROM ({_FEED_ITEMS})"""
SQL["feed_rejects"] = f"""
SELECT k AS feed_id, CASE WHEN shape = 'cut' THEN 'recovered' WHEN shape = 'junk' THEN 'rejected'
  WHEN shape = 'stray' AND k % 4 <> 3 THEN 'recovered' WHEN shape = 'atom' THEN 'no_item' ELSE 'parsed' END AS outcome
FROM ({_SHAPES})"""
SQL["all_links"] = f"""
SELECT 'page' AS link_source, audio_url, description, license, cast(NULL AS varchar) AS title,
  cast(NULL AS varchar) AS language, url AS page_url FROM ({_PAGE_LINKS})
UNION ALL SELECT 'feed', audio_url, description, NULL, title, language, page_url FROM ({SQL["feed_items"]})"""

# URLs, stated from the way each reference was built

_BARE = "regexp_replace(url, '[?#].*$', '')"
_UP = f"{_ORIGIN} || '/up/' || {_N} || '.mp3'"
SQL["resolve_urls"] = f"""
SELECT page_id, 'rooted' AS kind, {_ORIGIN} || '/ep//' || {_N} || '.mp3' AS resolved FROM pages
UNION ALL SELECT page_id, 'sibling', {_DIR} || 'a' || {_N} || '.ogg' FROM pages
UNION ALL SELECT page_id, 'up', {_UP} FROM pages
UNION ALL SELECT page_id, 'inner', {_DIR} || 'x/' || {_N} || '.wav' FROM pages
UNION ALL SELECT page_id, 'host', split_part(url, ':', 1) || '://cdn.example.org/x/../' || {_N} || '.wav?q=1' FROM pages
UNION ALL SELECT page_id, 'absolute', 'https://cdn.example.org/a/../' || {_N} || '.MP3' FROM pages
UNION ALL SELECT page_id, 'query', {_BARE} || '?z=' || {_N} FROM pages
UNION ALL SELECT page_id, 'fragment', regexp_replace(url, '#.*$', '') || '#t' || {_N} FROM pages
UNION ALL SELECT page_id, 'empty', url FROM pages
UNION ALL SELECT page_id, 'scheme', 'mailto:' || {_N} || '@example.org' FROM pages
UNION ALL SELECT page_id, 'spaced', {_ORIGIN} || '/sp/' || {_N} || '.mp3' FROM pages
UNION ALL SELECT page_id, 'broken', NULL FROM pages"""
SQL["valid_urls"] = """
SELECT page_id, kind, kind NOT IN ('query', 'fragment', 'empty', 'broken') AS valid FROM pages, (SELECT unnest([
  'rooted', 'sibling', 'up', 'inner', 'host', 'absolute', 'query', 'fragment', 'empty', 'scheme', 'spaced', 'broken'
]) AS kind)"""
SQL["page_audio_urls"] = f"""
SELECT link_pos, audio_url FROM {_I}
WHERE link_pos % 7 IN (0, 1, 2, 3, 5) OR (link_pos % 7 = 6 AND {_FILLED})"""
SQL["feed_audio_urls"] = f"""
SELECT link_pos, audio_url FROM {_I}
WHERE link_pos % 7 IN (2, 3, 4, 5) OR (link_pos % 7 = 6 AND {_FILLED})"""
_DOMAIN = """CASE o_custkey % 10
  WHEN 0 THEN 'example.com' WHEN 1 THEN 'example.co.jp' WHEN 2 THEN 'example.co.uk' WHEN 3 THEN '192.0.2.1'
  WHEN 4 THEN 'example.org' WHEN 5 THEN 'podcast.com.au' WHEN 6 THEN 'localhost' WHEN 7 THEN 'city.kawasaki.jp'
  WHEN 8 THEN 'shop.foo.ck' WHEN 9 THEN CASE WHEN o_orderkey % 2 = 0 THEN 'pod.xyz' ELSE 'example.com' END
  ELSE 'example.com' END"""
_RULE = """CASE WHEN audio_url = '' THEN 'none' WHEN o_custkey % 10 = 3 THEN 'address'
  WHEN o_custkey % 10 = 6 OR (o_custkey % 10 = 9 AND o_orderkey % 2 = 0) THEN 'unlisted' ELSE 'listed' END"""
_DOMAINS = f"""
SELECT link_pos, audio_url, language, CASE WHEN audio_url = '' THEN '' ELSE {_DOMAIN} END AS domain, {_RULE} AS rule
FROM {_L} JOIN orders ON o_orderkey = link_pos WHERE audio_url IS NOT NULL"""
SQL["registered_domain"] = f"SELECT link_pos, audio_url, domain, rule FROM ({_DOMAINS})"
SQL["truthy_links"] = f"""
SELECT link_pos, audio_url, substring(title, 1, 5) AS short_title FROM {_L} WHERE {_FILLED} AND description <> ''"""

# Statistics


def _top(key: str, rows: str, k: int) -> str:
    return f"""
SELECT {key}, n, cast(n AS double) / sum(n) OVER () * 100.0 AS pct
FROM (SELECT {key}, count(*) AS n FROM ({rows}) GROUP BY 1) ORDER BY n DESC, {key} LIMIT {k}"""


def _top_domains(rows: str) -> str:
    unlisted = f"cast(sum(cast(rule = 'unlisted' AS int)) AS double) / count(*) * 100.0 AS unlisted_pct FROM ({rows})"
    return f"SELECT d.*, u.unlisted_pct FROM ({_top('domain', rows, 20)}) d, (SELECT {unlisted}) u"


SQL["top_domains"] = _top_domains(f"SELECT domain, rule FROM ({_DOMAINS}) WHERE domain <> ''")
SQL["top_domains_for_language"] = _top_domains(
    f"SELECT domain, rule FROM ({_DOMAINS}) WHERE domain <> '' AND {_JAPANESE}"
)
SQL["top_languages"] = _top("language", f"SELECT language FROM {_L}", 15)
SQL["links_by_language"] = f"SELECT link_pos, language FROM {_L} WHERE {_JAPANESE}"
SQL["url_uniqueness"] = f"SELECT count(*) AS total, count(DISTINCT audio_url) AS distinct_urls FROM {_L}"
SQL["language_rollup"] = f"""
SELECT base, raw, cast(grouping(base, raw) AS bigint) AS level, count(*) AS n
FROM (SELECT lower(regexp_extract(language, '^[^-_]*')) AS base, language AS raw FROM {_L})
GROUP BY ROLLUP (base, raw)"""
_SAMPLED = """
SELECT event_type, count(*) AS n FROM events
WHERE cast('0x' || substring(md5(cast(event_id AS varchar)), 1, 8) AS bigint) % 10 = 0 GROUP BY 1"""
SQL["class_ratio_sampled"] = f"""
WITH c AS ({_SAMPLED}), r AS (SELECT *, row_number() OVER (ORDER BY n DESC, event_type) AS place FROM c)
SELECT event_type, n, cast(n AS double) / (SELECT sum(n) FROM c) * 100.0 AS pct FROM r WHERE place <= 3
UNION ALL SELECT 'Others', cast(sum(n) AS bigint), cast(sum(n) AS double) / (SELECT sum(n) FROM c) * 100.0
FROM r WHERE place > 3"""
SQL["rows_per_archive"] = f"SELECT archive, count(*) AS n FROM {_L} GROUP BY 1"
_HOST = "regexp_replace(regexp_extract(audio_url, '^https://([^/]+)', 1), '^[^@]*@|:[0-9]+$', '', 'g')"
_SLOTS = """
SELECT host, audio_url, row_number() OVER (PARTITION BY host ORDER BY audio_url, link_pos) AS slot,
  row_number() OVER (ORDER BY host, audio_url, link_pos) - 1 AS no
FROM (SELECT *, {host} AS host FROM ({rows}))"""
SQL["fetch_plan"] = f"""
WITH p AS ({_SLOTS.format(host=_HOST, rows=_FIRSTS)}), s AS (SELECT greatest(max(slot), (count(*) + 15) // 16) AS span FROM p)
SELECT host, audio_url, slot, no // span AS lane, cast(no % span AS double) AS start_second FROM p, s"""
SQL["fetch_schedule"] = f"""
SELECT cast(sum(n) AS bigint) AS requests, count(*) AS hosts, max(n) AS longest,
  cast(greatest(max(n), (sum(n) + 15) // 16) AS double) AS finish_second
FROM (SELECT {_HOST} AS host, count(*) AS n FROM {_L} WHERE {_FILLED} GROUP BY 1)"""
SQL["fetch_bounds"] = f"""
SELECT {_HOST} AS host, count(*) AS requests, cast(count(*) AS double) AS finish_second
FROM {_L} WHERE {_FILLED} GROUP BY 1"""

# Audio as tables

_SAMPLES = """
SELECT event_type AS recording_id, CASE WHEN event_type = 'signup' THEN 0 ELSE cast(user_id % 2 AS int) END AS channel,
  cast(floor(epoch(ts)) AS bigint) - (SELECT cast(floor(epoch(min(ts))) AS bigint) FROM events) AS t, round(value * 100) AS value FROM events"""
SQL["downmix"] = f"SELECT recording_id, t, avg(value) AS value FROM ({_SAMPLES}) GROUP BY 1, 2"
_POINTS = f"SELECT recording_id, channel, t, avg(value) AS value FROM ({_SAMPLES}) GROUP BY 1, 2, 3"
_GRID = f"""
SELECT recording_id, channel, unnest(generate_series(
  cast(ceil(min(t) / 1800.0) AS bigint) * 1800, cast(floor(max(t) / 1800.0) AS bigint) * 1800, 1800)) AS t
FROM ({_POINTS}) GROUP BY 1, 2"""
SQL["resample_series"] = f"""
WITH points AS ({_POINTS}), grid AS ({_GRID})
SELECT recording_id, channel, t // 3600 * 3600 AS t, avg(value) AS value, 'mean' AS method
FROM ({_SAMPLES}) GROUP BY 1, 2, 3
UNION ALL
SELECT g.recording_id, g.channel, g.t,
  CASE WHEN a.t = b.t THEN a.value ELSE a.value + (b.value - a.value) * (g.t - a.t) / (b.t - a.t) END, 'linear'
FROM grid g
ASOF JOIN points a ON g.recording_id = a.recording_id AND g.channel = a.channel AND g.t >= a.t
ASOF JOIN points b ON g.recording_id = b.recording_id AND g.channel = b.channel AND g.t <= b.t"""
_STEREO = f"""
SELECT recording_id, c AS channel, t, value FROM (SELECT *, unnest(CASE WHEN recording_id = 'signup' THEN [0, 1]
  ELSE [channel] END) AS c FROM ({_SAMPLES}))"""
SQL["channel_ops"] = f"""
SELECT *, 'all' AS taken FROM ({_STEREO}) UNION ALL SELECT *, 'first' FROM ({_STEREO}) WHERE channel = 0"""


def _facts(rows: str) -> str:
    return f"""
SELECT recording_id, max(n) AS num_samples, max(n) / 16.0 AS duration,
  string_agg(cast(channel AS varchar), ',' ORDER BY channel) AS channel_ids,
  CASE WHEN count(*) = 1 THEN 'mono' ELSE 'multi' END AS kind
FROM (SELECT recording_id, channel, count(*) AS n FROM ({rows}) GROUP BY 1, 2) GROUP BY 1"""


SQL["recording_facts"] = f"""
SELECT recording_id, num_samples, cast(duration AS double) AS duration, channel_ids, kind FROM ({_facts(_SAMPLES)})"""
_BY_USER = "SELECT user_id AS recording_id, event_id % 2 AS channel FROM events"
SQL["build_cuts"] = f"""
SELECT cast(recording_id AS varchar) AS id, cast(duration AS double) AS duration, kind,
  CASE kind WHEN 'mono' THEN '0' ELSE channel_ids END AS channel, channel_ids, num_samples,
  coalesce(audio_url, '') AS audio_url, language
FROM ({_facts(_BY_USER)}) JOIN {_L} ON link_pos = recording_id"""
SQL["first_cut"] = f"SELECT * FROM ({SQL['build_cuts']}) ORDER BY id LIMIT 1"
_NUMBERED = f"""
SELECT *, row_number() OVER (ORDER BY archive, link_pos) - 1 AS idx FROM {_L} WHERE {_FILLED}"""
_ID = "'audio_' || lpad(cast(idx AS varchar), 8, '0')"
SQL["shard_manifest"] = f"""
SELECT {_ID} AS id, idx // 2000 AS shard, link_pos * 160 / 16000.0 AS duration, title FROM ({_NUMBERED})"""
SQL["manifest_scan"] = f"""
SELECT {_ID} AS id, cast(link_pos * 160 / 16000.0 AS double) AS duration, 'mono' AS kind, '0' AS channel, '0' AS channel_ids,
  link_pos * 160 AS num_samples, audio_url, language FROM ({_NUMBERED})"""
SQL["shard_manifest"] = SQL["shard_manifest"].replace("link_pos * 160 / 16000.0", "cast(link_pos * 160 / 16000.0 AS double)")
SQL["manifest_orphans"] = f"""
SELECT 'audio_' || lpad(cast(link_pos AS varchar), 8, '0') AS id,
  CASE link_pos % 50 WHEN 2 THEN 'recording' ELSE 'cut' END AS missing FROM {_L} WHERE link_pos % 50 IN (1, 2)"""
_FORMAT = """CASE WHEN link_pos % 9 IN (0, 1) THEN 'mp3' WHEN link_pos % 9 IN (2, 3) THEN 'wav' WHEN link_pos % 9 = 4 THEN 'flac'
  WHEN link_pos % 9 = 6 THEN 'ogg' WHEN link_pos % 7 = 0 THEN 'wav' WHEN link_pos % 7 = 1 THEN 'm4a'
  WHEN link_pos % 7 = 3 THEN 'flac' WHEN link_pos % 7 = 5 THEN 'ogg' ELSE 'mp3' END"""
_STATUS = """CASE WHEN link_pos % 31 = 3 THEN 'failed' WHEN link_pos % 29 IN (4, 5) THEN 'empty' ELSE 'ok' END"""
SQL["item_outcomes"] = f"SELECT link_pos, {_STATUS} AS status, {_FORMAT} AS format FROM {_L}"
SQL["item_rejects"] = f"SELECT status, count(*) AS n FROM (SELECT {_STATUS} AS status FROM {_L}) WHERE status <> 'ok' GROUP BY 1"
SQL["audio_formats"] = f"SELECT link_pos, {_FORMAT} AS format FROM {_L}"
