"""The same results in SQL, one statement per query."""

_STAMP = "TIMESTAMP '2024-06-01 08:30:00'"
_STAMP2 = "TIMESTAMP '2024-06-02 09:45:10.000250'"
_ISO = "'2024-06-01T08:30:00'"


def _author_rows(key, name, nation, people, faculty):
    return f"""
    SELECT 'A' || ({key} % 1000) AS id,
           CASE WHEN {key} % 17 <> 0 THEN {name} END AS display_name,
           CASE WHEN {key} % 3 = 0 THEN '0000-' || {key} END AS orcid,
           CAST({key} % 97 AS BIGINT) AS works_count,
           CAST({key} % 389 AS BIGINT) AS cited_by_count,
           CASE WHEN {key} % 11 <> 0 THEN n_name END AS institution_name,
           r_name AS university, {faculty} AS faculty
    FROM {people} JOIN nation ON {nation} = n_nationkey JOIN region ON n_regionkey = r_regionkey"""


_AUTHORS = _author_rows("c_custkey", "c_name", "c_nationkey", "customer", "c_mktsegment")
_LATER_AUTHORS = _author_rows(
    "s_suppkey", "s_name", "s_nationkey", "supplier",
    "(['AUTOMOBILE','BUILDING','FURNITURE','HOUSEHOLD','MACHINERY'])[CAST(s_suppkey % 5 AS INTEGER) + 1]",
)


def _profiles(authors, stamp):
    return f"""
    SELECT id AS author_id, display_name AS full_name, orcid, works_count, cited_by_count,
           institution_name, university, faculty, 'openalex_api' AS source_system,
           md5(id || '_' || faculty) AS record_id, {stamp} AS business_timestamp,
           false AS is_deleted, 'en' AS language
    FROM ({authors})
    WHERE display_name IS NOT NULL
    QUALIFY row_number() OVER (
        PARTITION BY university, faculty, id
        ORDER BY works_count DESC, display_name, cited_by_count DESC) = 1"""


_PROFILES = _profiles(_AUTHORS, _STAMP)
_LATER_PROFILES = _profiles(_LATER_AUTHORS, _STAMP2)

_URL_OF_DOC = """CASE doc_id % 8
        WHEN 0 THEN 'https://h/formation/Filiere_' || doc_id || '.pdf'
        WHEN 1 THEN 'https://h/docs/Filières_' || doc_id || '.pdf'
        WHEN 2 THEN 'https://h/cursus/' || doc_id || '.pdf'
        WHEN 3 THEN 'https://h/docs/filiere_' || doc_id || '.pdf'
        WHEN 4 THEN 'https://h/programme.PDF'
        WHEN 5 THEN 'https://h/programme.pdf?x=' || doc_id
        WHEN 6 THEN 'https://h/news/' || doc_id || '.pdf' END"""

_EXTRACTED = "1 + doc_id % 28 AS extracted, md5(CAST(doc_id AS VARCHAR)) AS checksum"
_PAYLOADS = f"SELECT {_URL_OF_DOC} AS url, text, source AS university, lang AS faculty, {_EXTRACTED} FROM documents"
_LATER_PAYLOADS = f"""
    SELECT {_URL_OF_DOC} AS url, 'label ' || quality || ' ' || toxic AS text,
           source AS university, lang AS faculty, {_EXTRACTED}
    FROM documents JOIN labels USING (doc_id)"""

_IS_COURSE = "regexp_matches(lower(url), 'formation|filiere|filière|programme|cursus')"


def _courses(payloads, stamp):
    return f"""
    SELECT CASE WHEN trim(tail) <> '' THEN tail ELSE stem END AS course_name, stem AS raw_filename,
           url AS source_path, text AS text_content, university, faculty,
           'file_extraction' AS source_system, md5(stem || '_' || faculty) AS record_id,
           {stamp} AS business_timestamp, false AS is_deleted, 'fr' AS language
    FROM (SELECT *, regexp_extract(stem, '(?:Fili[eè]re[s]?_?)(.*)', 1) AS tail
          FROM (SELECT *, regexp_extract(url, '([^/]+)\\.pdf$', 1) AS stem
                FROM ({payloads}) WHERE {_IS_COURSE}))
    QUALIFY row_number() OVER (
        PARTITION BY university, faculty, stem ORDER BY url, extracted DESC, checksum) = 1"""


_COURSES = _courses(_PAYLOADS, _STAMP)
_LATER_COURSES = _courses(_LATER_PAYLOADS, _STAMP2)
_LEVELLED = f"SELECT *, nullif(regexp_extract(raw_filename, '([0-9])$', 1), '') AS level FROM ({_COURSES})"


def _upserted(first, second, key="record_id"):
    return f"""
    WITH a AS ({first}), b AS ({second})
    SELECT * FROM b
    UNION ALL BY NAME
    SELECT * FROM a WHERE NOT EXISTS (
        SELECT 1 FROM b WHERE b.{key} = a.{key} AND b.university = a.university AND b.faculty = a.faculty)"""


_WORKS = """
    SELECT 'https://h/W' || o_orderkey AS id, 'Work ' || o_orderkey AS display_name,
           CAST(year(o_orderdate) AS INTEGER) AS publication_year,
           CASE WHEN o_orderkey % 7 <> 0 THEN o_orderkey % 1000 ELSE 0 END AS cited_by_count,
           o_orderpriority AS type,
           CASE WHEN o_orderkey % 4 <> 0 THEN '10.1/' || o_orderkey END AS doi,
           o_orderkey % 5 <> 0 AND o_orderkey % 2 = 0 AS open_access,
           o_orderstatus AS university, 'F' || (o_custkey % 10) AS faculty
    FROM orders"""

_PUBLICATIONS = """
    SELECT id AS work_id, display_name AS title, university, faculty, publication_year,
           CAST(cited_by_count AS BIGINT) AS cited_by_count, type, doi, open_access,
           '2024-06-01 08:30:00' AS retrieved_at"""

_CRAWLED = """
    SELECT *, CASE
        WHEN ending = '.pdf' THEN 'pdf' WHEN ending = '.PDF?x=1' THEN 'pdf'
        WHEN ending IN ('.jpg', '.webp') THEN 'image' WHEN ending IN ('.json', '.csv') THEN 'json'
        WHEN ending IN ('.docx', '.zip') THEN 'document' WHEN ending IN ('.css', '.woff2') THEN 'skip'
        ELSE 'html' END AS file_type
    FROM (SELECT 'https://h/' || p_partkey || ending AS url, *
          FROM (SELECT p_partkey, p_brand AS university, p_type AS faculty,
                       CAST(p_size % 4 AS INTEGER) AS depth_level,
                       CASE WHEN p_partkey % 25 = 0 THEN '' ELSE p_name END AS content,
                       (['.pdf','.PDF?x=1','.jpg','.webp','.json','.csv','.docx','.zip','.css',
                         '.woff2','.html',''])[CAST(p_partkey % 12 AS INTEGER) + 1] AS ending
                FROM part))"""

_BUCKET = """CASE file_type WHEN 'pdf' THEN 'raw-documents' WHEN 'document' THEN 'raw-documents'
        WHEN 'image' THEN 'raw-images' WHEN 'json' THEN 'raw-json' ELSE 'raw-web-html' END"""

_MANIFEST = f"""
    SELECT url AS source_url, university, faculty, depth_level, file_type,
           {_ISO} AS crawl_timestamp, md5(content) AS content_checksum,
           's3://' || {_BUCKET} || '/university=' || university || '/faculty=' || faculty
               || '/year=2024/month=06/day=01/' || md5(url) || '.' || file_type AS storage_path
    FROM ({_CRAWLED}) WHERE file_type <> 'skip' AND content <> ''"""

_PAGE_PARTS = """
    SELECT page_id, html, origin, host, path, folder, regexp_replace(folder, '[^/]+/$', '') AS parent
    FROM (SELECT *, regexp_replace(path, '[^/]*$', '') AS folder
          FROM (SELECT page_id, html, regexp_extract(url, '^[a-z]+://[^/?#]*') AS origin,
                       regexp_extract(url, '^[a-z]+:(//[^/?#]*)', 1) AS host,
                       regexp_extract(url, '^[a-z]+://[^/?#]*([^?#]*)', 1) AS path
                FROM pages))"""

_NAV = """regexp_replace(replace(unnest(regexp_extract_all(html, '<a href="(/[^"]*)"', 1)), '&amp;', '&'),
        '#.*$', '')"""

_LINKS = f"""
    SELECT DISTINCT page_id, link FROM (
        SELECT page_id, origin || {_NAV} AS link FROM p
        UNION ALL SELECT page_id, 'http://cdn.example.edu/' || page_id || '.JPG?s=1' FROM p
        UNION ALL SELECT page_id, origin || parent || 'x' || page_id FROM p
        UNION ALL SELECT page_id, origin || '/./y/../z' FROM p
        UNION ALL SELECT page_id, origin || path || '?p=1&q=2' FROM p
        UNION ALL SELECT page_id, origin || folder || 'w' FROM p
        UNION ALL SELECT page_id, origin || folder || 'plain' || page_id FROM p
        UNION ALL SELECT page_id, origin || '/img/' || page_id || '.png#f' FROM p)"""

_REACH = """
    WITH RECURSIVE node AS (
        SELECT o_orderkey AS k, 'https://h/order/' || o_orderkey AS url,
               'https://h/customer/' || o_custkey || CASE WHEN o_custkey % 13 = 0 THEN '.pdf' ELSE '' END AS up
        FROM orders
        UNION ALL
        SELECT c_custkey, 'https://h/customer/' || c_custkey || CASE WHEN c_custkey % 13 = 0 THEN '.pdf' ELSE '' END,
               'https://h/nation/' || c_nationkey FROM customer
        UNION ALL
        SELECT n_nationkey, 'https://h/nation/' || n_nationkey, 'https://h/region/' || n_regionkey FROM nation),
    edge AS (SELECT up AS src, url AS dst FROM node UNION ALL SELECT url, up FROM node),
    walk AS (
        SELECT r_name AS university, 'https://h/region/' || r_regionkey AS url, 0 AS depth FROM region
        UNION
        SELECT university, dst, depth + 1 FROM walk JOIN edge ON url = src
        WHERE depth < 3 AND url NOT LIKE '%.pdf')
    SELECT university, url, CAST(min(depth) AS INTEGER) AS depth FROM walk GROUP BY university, url"""

_WALK = f"""
    WITH RECURSIVE link AS (
        SELECT DISTINCT page_id, 'https://h' || {_NAV} AS dst FROM pages
        UNION ALL SELECT page_id, 'https://h/p/' || (page_id * 2 + 1) || '.html' FROM pages
        UNION ALL SELECT page_id, 'https://h/p/' || (page_id * 2 + 2) || '.html' FROM pages
        UNION ALL SELECT page_id, 'https://h/i/' || (page_id * 2 + 1) || '.png' FROM pages
        UNION ALL SELECT page_id, 'https://h/d/' || (page_id * 2 + 2) || '.css' FROM pages),
    edge AS (SELECT 'https://h/p/' || page_id || '.html' AS src, dst FROM link),
    walk AS (
        SELECT r_name AS university, 'https://h/p/' || r_regionkey || '.html' AS url, 0 AS depth FROM region
        UNION
        SELECT university, dst, depth + 1 FROM walk JOIN edge ON url = src WHERE depth < 3),
    seen AS (
        SELECT DISTINCT university, walk.url, page_id IS NOT NULL AS stored,
               CASE WHEN walk.url LIKE '%.png' THEN 'image' WHEN walk.url LIKE '%.css' THEN 'skip'
                    ELSE 'html' END AS kind
        FROM walk LEFT JOIN pages ON walk.url = 'https://h/p/' || page_id || '.html')
    SELECT university, 'web' AS faculty,
           count(*) FILTER (kind = 'html' AND stored) AS html,
           CAST(0 AS BIGINT) AS pdf, count(*) FILTER (kind = 'image' AND stored) AS image,
           CAST(0 AS BIGINT) AS json, CAST(0 AS BIGINT) AS document,
           count(*) FILTER (kind = 'skip') AS skip,
           count(*) FILTER (kind <> 'skip' AND NOT stored) AS errors,
           count(*) AS visited
    FROM seen GROUP BY university"""

_DOCUMENTS = """
    SELECT doc_id, lang, source,
           'university=' || source || '/faculty=' || lang || '/' || md5(CAST(doc_id AS VARCHAR)) AS stem,
           (['.pdf', '.docx', '.doc', '.document'])[CAST(doc_id % 4 AS INTEGER) + 1] AS ending,
           CASE WHEN doc_id % 9 = 0 THEN '' WHEN doc_id % 25 <> 0 THEN text END AS text
    FROM documents"""

_PAYLOAD_ROWS = f"""
    SELECT 'raw-documents' AS source_bucket, stem || ending AS source_path,
           CASE WHEN doc_id % 6 = 0 THEN '' ELSE 'https://h/doc/' || doc_id END AS source_url,
           CASE WHEN doc_id % 6 = 0 THEN '' ELSE source END AS university,
           CASE WHEN doc_id % 6 = 0 THEN '' ELSE lang END AS faculty,
           'text_extraction' AS extraction_type,
           CASE WHEN doc_id % 6 = 0 THEN '' ELSE '2024-05-31T07:00:00' END AS crawl_timestamp,
           '2024-06-02T09:45:10.000250' AS extract_timestamp, md5(text) AS content_checksum,
           's3://raw-json/' || stem || '.json' AS storage_path, text, source, lang
    FROM ({_DOCUMENTS}) WHERE ending <> '.document' AND text <> ''"""

_STRIPPED = r"regexp_replace(text, '^\s+|\s+$', '', 'g')"

_LOG = """
    SELECT strftime(ts, '%Y-%m-%dT%H:%M:%S') ||
               CASE WHEN microsecond(ts) % 1000000 = 0 THEN '' ELSE strftime(ts, '.%f') END AS timestamp,
           CASE event_type WHEN 'error' THEN 'ERROR' WHEN 'purchase' THEN 'WARNING' ELSE 'INFO' END AS level,
           props AS message, 'u' || (user_id % 2) AS university, event_type AS faculty,
           CASE WHEN user_id % 7 <> 0 THEN 'from_' || event_type ELSE 'unknown' END AS source, ts
    FROM events"""


def _documents(pages, url, html, stamp):
    return f"""
    SELECT md5(name) AS record_id, CAST(NULL AS VARCHAR) AS title, body AS content,
           university, faculty, 'html' AS file_type, CAST(NULL AS VARCHAR) AS language,
           CAST(NULL AS VARCHAR) AS source_url, CAST(NULL AS INTEGER) AS depth_level,
           {stamp} AS crawl_timestamp, CAST(NULL AS VARCHAR) AS content_checksum,
           's3://raw-web-html/' || name AS storage_path
    FROM (SELECT *, 'university=' || university || '/faculty=' || faculty ||
                    '/year=2024/month=06/day=01/' || md5({url}) || '.html' AS name
          FROM (SELECT url, {html} AS body, regexp_extract(url, '^[a-z]+://[^/?#]*[.]([a-z]+)/', 1) AS university,
                       regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS faculty
                FROM {pages}))"""


_SEARCH = _documents("pages", "url", "html", _STAMP)
# pages that differ in their fragment only share a name now; the first content is kept
_LATER_SEARCH = _documents("pages", "regexp_replace(url, '#.*$', '')", "'<!-- v2 -->' || html", _STAMP2) + """
    QUALIFY row_number() OVER (PARTITION BY university, faculty, name ORDER BY content) = 1"""

_RESOLVE = """
    WITH stored AS (
        SELECT DISTINCT 'F' || (s_suppkey % 40) AS faculty, CASE n_nationkey % 5
            WHEN 0 THEN 'hassan_2' WHEN 1 THEN 'Hassan II' WHEN 2 THEN 'Cadi Ayyad'
            WHEN 3 THEN 'kaddi_ayad' ELSE replace(lower(r_name), ' ', '_') END AS university
        FROM supplier JOIN nation ON s_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    asked AS (
        SELECT DISTINCT 'F' || (c_custkey % 50) AS faculty, CASE c_custkey % 4
            WHEN 0 THEN 'hassan2' WHEN 1 THEN 'cadi_ayyad' WHEN 2 THEN r_name ELSE 'Nowhere' END AS hint
        FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey),
    alias(hint, name, pos) AS (VALUES
        ('hassan2', 'hassan2', 0), ('hassan2', 'hassan_ii', 1), ('hassan2', 'Hassan II', 2),
        ('hassan2', 'hassan_2', 3), ('cadi_ayyad', 'cadi_ayyad', 0), ('cadi_ayyad', 'Cadi Ayyad', 1),
        ('cadi_ayyad', 'cadiayyad', 2), ('cadi_ayyad', 'caddi_ayad', 3), ('cadi_ayyad', 'kaddi_ayad', 4)),
    tried AS (
        SELECT hint, faculty, name, pos FROM asked JOIN alias USING (hint)
        UNION ALL SELECT hint, faculty, hint, 10 FROM asked
        UNION ALL SELECT hint, faculty, lower(hint), 11 FROM asked
        UNION ALL SELECT hint, faculty, replace(lower(hint), ' ', '_'), 12 FROM asked),
    hit AS (
        SELECT hint, tried.faculty, arg_min(name, pos) AS name
        FROM tried JOIN stored ON name = university AND tried.faculty = stored.faculty
        GROUP BY hint, tried.faculty)
    SELECT asked.hint, asked.faculty, coalesce(name, asked.hint) AS university, name IS NOT NULL AS found
    FROM asked LEFT JOIN hit ON asked.hint = hit.hint AND asked.faculty = hit.faculty"""

_SITE_DAY = """
    SELECT university, faculty, block, 'https://h/' || university || '/' || faculty || '/' || block AS url, body,
           {day} AS day
    FROM (SELECT university, faculty, block, string_agg(html, chr(10) ORDER BY page_id) AS body
          FROM (SELECT page_id, html, page_id % 16 AS block,
                       regexp_extract(url, '^[a-z]+://[^/?#]*[.]([a-z]+)/', 1) AS university,
                       regexp_extract(url, '^[a-z]+://[^/]+/([a-z]+)/', 1) AS faculty
                FROM pages)
          GROUP BY university, faculty, block)"""

_SITE = f"""
    SELECT *, 'university=' || university || '/faculty=' || faculty || '/year=2024/month=06/day=0' || day || '/' ||
              md5(url) || '.html' AS name
    FROM ({_SITE_DAY.format(day=1)}
          UNION ALL SELECT * REPLACE ('<!-- v2 -->' || body AS body) FROM ({_SITE_DAY.format(day=2)}) WHERE block % 3 = 0)"""

_LINES = """
    SELECT CASE c_custkey % 10 WHEN 3 THEN line[1:20] WHEN 7 THEN 'not json ' || c_custkey ELSE line END AS record, *
    FROM (SELECT c_custkey, c_name, replace(lower(r_name), ' ', '_') AS university, c_mktsegment AS faculty,
                 '{"id":"A' || c_custkey || '","display_name":"' || c_name || '","works_count":' ||
                     CASE WHEN c_custkey % 10 = 5 THEN '"many"' ELSE CAST(c_custkey % 97 AS VARCHAR) END || '}' AS line
          FROM customer JOIN nation ON c_nationkey = n_nationkey JOIN region ON n_regionkey = r_regionkey)"""

ORACLES = {
    "author_normalize": _PROFILES,
    "report_staff_per_faculty": f"SELECT faculty, count(*) AS nb_profs FROM ({_PROFILES}) GROUP BY faculty",
    "report_courses_per_level": f"SELECT level, count(*) AS nb_cours FROM ({_LEVELLED}) GROUP BY level",
    "report_staff_per_university": f"SELECT university, count(*) AS nb_profs FROM ({_PROFILES}) GROUP BY university",
    "report_publications_per_university": f"""
        SELECT university, CAST(sum(works_count) AS BIGINT) AS total_publications
        FROM ({_PROFILES}) GROUP BY university""",
    "course_keyword_filter": f"""
        SELECT url AS source_path, text AS text_content, university, faculty
        FROM ({_PAYLOADS}) WHERE {_IS_COURSE}""",
    "course_catalog": _COURSES,
    "job_counts": f"""
        SELECT 'faculty_profiles' AS job, (SELECT count(*) FROM ({_AUTHORS})) AS raw_rows,
               (SELECT count(*) FROM ({_PROFILES})) AS clean_rows, (SELECT count(*) FROM ({_PROFILES})) AS stored_rows
        UNION ALL
        SELECT 'course_catalog', (SELECT count(*) FROM documents), (SELECT count(*) FROM ({_COURSES})),
               (SELECT count(*) FROM ({_COURSES}))""",
    "job_profiles": f"SELECT * REPLACE (replace(lower(university), ' ', '_') AS university) FROM ({_PROFILES})",
    "job_courses": _COURSES,
    "job_landing": f"""
        SELECT 'openalex' AS source, university, faculty, 'authors' AS data_type,
               {_ISO} AS crawl_timestamp, count(*) AS records_count
        FROM ({_AUTHORS}) GROUP BY university, faculty
        UNION ALL
        SELECT 'openalex', university, faculty, 'publications', {_ISO}, count(*)
        FROM ({_WORKS}) GROUP BY university, faculty""",
    "job_payloads": f"""
        SELECT source_path, source_url, {_STRIPPED} AS text, source AS university, lang AS faculty
        FROM ({_PAYLOAD_ROWS}) WHERE {_STRIPPED} <> ''""",
    "job_crawl": f"""
        SELECT *, html + pdf + image + json + document AS manifest_rows FROM ({_WALK})""",
    "landing_rerun": f"{_PUBLICATIONS} FROM ({_WORKS})",
    "manifest_rerun": _MANIFEST,
    "payload_reextract": f"""
        SELECT source_path, md5(text || ' changed') AS content_checksum, text || ' changed' AS text
        FROM ({_PAYLOAD_ROWS})""",
    "log_sidecars": f"""
        SELECT 'university=' || university || '/faculty=' || faculty ||
                   strftime(ts, '/year=%Y/month=%m/day=%d/log_') || md5(body)[1:8] || '.json' AS object_path,
               source, university, faculty, timestamp AS log_timestamp, level
        FROM (SELECT *, '{{"timestamp": "' || timestamp || '", "level": "' || level || '", "message": "' ||
                     replace(message, '"', '\\"') || '", "university": "' || university ||
                     '", "faculty": "' || faculty || '", "source": "' || source || '"}}' AS body
              FROM ({_LOG}))""",
    "preview_topn": f"""
        SELECT full_name, works_count, cited_by_count, faculty FROM ({_PROFILES})
        ORDER BY full_name, faculty, works_count, cited_by_count LIMIT 10""",
    "preview_courses": f"""
        SELECT course_name, raw_filename, faculty FROM ({_COURSES})
        ORDER BY course_name, raw_filename, faculty LIMIT 20""",
    "publication_enrich": f"{_PUBLICATIONS}, regexp_extract(id, '[^/]*$') AS work_code FROM ({_WORKS})",
    "cap_per_faculty": f"""
        SELECT university, faculty, id, display_name FROM ({_WORKS})
        QUALIFY row_number() OVER (PARTITION BY university, faculty ORDER BY id, display_name) <= 500""",
    "batch_record_counts": f"""
        SELECT 'openalex' AS source, university, faculty, 'publications' AS data_type,
               {_ISO} AS crawl_timestamp, count(*) AS records_count
        FROM ({_WORKS}) GROUP BY university, faculty""",
    "landing_roundtrip": f"""
        {_PUBLICATIONS}, 'type=publications/year=2024/month=06/day=01/batch=20240601_083000' AS folder FROM ({_WORKS})""",
    "author_scan_roundtrip": f"""
        SELECT id, display_name, orcid, works_count, cited_by_count, institution_name,
               replace(lower(university), ' ', '_') AS university, faculty,
               '2024' AS year, '06' AS month, '01' AS day, '20240601_083000' AS batch, 'authors' AS type
        FROM ({_AUTHORS})""",
    "file_type_route": f"""
        SELECT url, file_type, {_BUCKET} AS bucket, file_type <> 'skip' AS is_fetched FROM ({_CRAWLED})""",
    "crawl_manifest": _MANIFEST,
    "manifest_roundtrip": _MANIFEST,
    "crawl_stats": f"""
        SELECT university, faculty,
               count(*) FILTER (file_type = 'html' AND content <> '') AS html,
               count(*) FILTER (file_type = 'pdf' AND content <> '') AS pdf,
               count(*) FILTER (file_type = 'image' AND content <> '') AS image,
               count(*) FILTER (file_type = 'json' AND content <> '') AS json,
               count(*) FILTER (file_type = 'document' AND content <> '') AS document,
               count(*) FILTER (file_type = 'skip') AS skip,
               count(*) FILTER (file_type <> 'skip' AND content = '') AS errors,
               count(*) AS visited
        FROM ({_CRAWLED}) GROUP BY university, faculty""",
    "dynamic_pages": """
        SELECT page_id, url,
               regexp_matches(html || (['callWS', 'getTabs', 'getPage', 'angular', 'react', 'vue',
                   '$(document).ready', 'CALLWS', ''])[CAST(page_id % 9 AS INTEGER) + 1],
                   'callWS|getTabs|getPage|angular|react|vue|\\$\\(document\\)\\.ready') AS is_dynamic
        FROM pages""",
    "page_links": f"""
        WITH p AS ({_PAGE_PARTS})
        SELECT page_id, link,
               CASE WHEN regexp_matches(link, '\\.(JPG|png)[?#]') THEN 'image' ELSE 'html' END AS file_type
        FROM ({_LINKS})""",
    "links_per_page": f"""
        WITH p AS ({_PAGE_PARTS})
        SELECT page_id, count(*) AS n_links FROM ({_LINKS}) GROUP BY page_id""",
    "bounded_reach": _REACH,
    "crawl_walk": _WALK,
    "text_concat": """
        SELECT conv_id,
               regexp_replace(coalesce(string_agg(text, chr(10) ORDER BY turn) FILTER (text <> ''), ''),
                              '^\\s+|\\s+$', '', 'g') AS text
        FROM conversations GROUP BY conv_id""",
    "extraction_payload": f"SELECT * EXCLUDE (source, lang) FROM ({_PAYLOAD_ROWS})",
    "extraction_stats": f"""
        SELECT count(*) FILTER (ending = '.pdf' AND text <> '') AS pdf,
               count(*) FILTER (ending IN ('.docx', '.doc') AND text <> '') AS docx,
               count(*) FILTER (text IS NOT NULL AND (ending = '.document' OR text = '')) AS skipped,
               count(*) FILTER (text IS NULL) AS errors
        FROM ({_DOCUMENTS})""",
    "payload_scan_roundtrip": f"""
        SELECT source_path, source_url, content_checksum, text, source AS university, lang AS faculty
        FROM ({_PAYLOAD_ROWS})""",
    "payload_folders": f"""
        SELECT DISTINCT source AS university, lang AS faculty,
               'university=' || source || '/faculty=' || lang || '/batch=20240602_094510000250' AS folder
        FROM ({_PAYLOAD_ROWS})""",
    "object_listing": f"SELECT name AS path, CAST(strlen(body) + 1 AS BIGINT) AS length, university, faculty FROM ({_SITE})",
    "object_catalogue": f"""
        SELECT university, faculty, name AS path, CAST(strlen(body) + 1 AS BIGINT) AS length FROM ({_SITE}) s
        WHERE faculty <> 'en' AND EXISTS (
            SELECT 1 FROM ({_SITE}) d WHERE d.day = 2 AND d.university = s.university AND d.faculty = s.faculty)""",
    "html_scan": f"""
        SELECT university, faculty, name AS object_name, length(body) + 1 AS n_chars, md5(body || chr(10)) AS checksum
        FROM ({_SITE})""",
    "sidecar_scan": f"""
        SELECT name AS object_path, url AS source_url, university, faculty, CAST(block AS INTEGER) AS depth_level,
               'html' AS file_type, '2024-06-0' || day || 'T08:30:00' AS crawl_timestamp,
               md5(body) AS content_checksum, 's3://raw-web-html/' || name AS storage_path
        FROM ({_SITE}) WHERE (block % 3 <> 1 OR faculty <> 'es')""",
    "stored_pages": f"""
        SELECT url, md5(body || chr(10)) AS checksum FROM ({_SITE}) WHERE (block % 3 <> 1 OR faculty <> 'es')
        QUALIFY row_number() OVER (PARTITION BY url ORDER BY day DESC) = 1""",
    "job_search": f"""
        SELECT md5(name) AS record_id, body || chr(10) AS content, university, faculty, 'html' AS file_type,
               's3://raw-web-html/' || name AS storage_path
        FROM ({_SITE})""",
    "search_preview": f"SELECT md5(name) AS record_id, body[1:10000] AS preview, length(body) AS n_chars FROM ({_SITE}) WHERE day = 1",
    "scan_quarantine": f"""
        SELECT record, CASE c_custkey % 10 WHEN 5 THEN 'partly read' ELSE 'unreadable' END AS reason, university, faculty
        FROM ({_LINES}) WHERE c_custkey % 10 IN (3, 5, 7)""",
    "scan_readable": f"""
        SELECT 'A' || c_custkey AS id, c_name AS display_name,
               CASE WHEN c_custkey % 10 <> 5 THEN CAST(c_custkey % 97 AS BIGINT) END AS works_count, university, faculty
        FROM ({_LINES}) WHERE c_custkey % 10 NOT IN (3, 7)""",
    "job_empty": """
        SELECT job, CAST(0 AS BIGINT) AS raw_rows, CAST(0 AS BIGINT) AS clean_rows, CAST(0 AS BIGINT) AS stored_rows
        FROM (VALUES ('faculty_profiles'), ('course_catalog')) t(job)""",
    "reports_from_tables": f"""
        WITH p AS ({_upserted(_PROFILES, _LATER_PROFILES)})
        SELECT 'staff_per_faculty' AS report, faculty AS name, count(*) AS value FROM p GROUP BY faculty
        UNION ALL SELECT 'courses_per_level', NULL, count(*) FROM ({_COURSES})
        UNION ALL SELECT 'staff_per_university', university, count(*) FROM p GROUP BY university
        UNION ALL SELECT 'publications_per_university', university, CAST(sum(works_count) AS BIGINT) FROM p GROUP BY university""",
    "log_rows": f"""
        SELECT * EXCLUDE (ts, body), 'university=' || university || '/faculty=' || faculty ||
                   strftime(ts, '/year=%Y/month=%m/day=%d/log_') || md5(body)[1:8] || '.json' AS object_path
        FROM (SELECT *, '{{"timestamp": "' || timestamp || '", "level": "' || level || '", "message": "' ||
                     replace(message, '"', '\\"') || '", "university": "' || university ||
                     '", "faculty": "' || faculty || '", "source": "' || source || '"}}' AS body
              FROM ({_LOG}))""",
    "log_roundtrip": f"SELECT * EXCLUDE (ts) FROM ({_LOG})",
    "log_compaction": f"SELECT * EXCLUDE (ts) FROM ({_LOG})",
    "search_docs": _SEARCH,
    "lossy_decode": """
        SELECT doc_id, length(full_text) AS n_chars, md5(full_text) AS checksum
        FROM (SELECT doc_id, CASE WHEN doc_id % 2 = 0 THEN text || 'é' || chr(65533) || 'z' ELSE text END AS full_text
              FROM documents)""",
    "resolve_university": _RESOLVE,
    "precombine_latest": """
        SELECT user_id, event_id, ts, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) = 1""",
    "upsert_profiles": _upserted(_PROFILES, _LATER_PROFILES),
    "upsert_courses": _upserted(_COURSES, _LATER_COURSES),
    "upsert_search_docs": _upserted(_SEARCH, _LATER_SEARCH),
    "tables_roundtrip": f"""
        SELECT 'faculty_profiles' AS table_name, university, count(*) AS n_rows FROM ({_PROFILES}) GROUP BY university
        UNION ALL
        SELECT 'course_catalog', university, count(*) FROM ({_COURSES}) GROUP BY university
        UNION ALL
        SELECT 'university_content', university, count(*) FROM ({_SEARCH}) GROUP BY university""",
}
