"""The same queries in DuckDB SQL."""

from checks.tables import postings_sql
from hirelake import vocab

_POSTINGS = f"postings AS ({postings_sql()})"


def _trim(c: str) -> str:
    return rf"regexp_replace({c}, '^\s+|\s+$', '', 'g')"


def _quoted(words: list[str]) -> str:
    return ", ".join("'" + w.replace("'", "''") + "'" for w in words)


# --- words ------------------------------------------------------------------

_STOP = _quoted(vocab.STOP_WORDS)


def _tokens(source: str, key: str, text: str, keep: str = "") -> str:
    """CTE ``tokens``: distinct (kept columns, key, word)."""
    return rf"""tokens AS (
      SELECT DISTINCT {keep} {key} AS id, word FROM (
        SELECT {keep} {key},
          unnest(string_split(lower(regexp_replace({text}, '[^a-zA-Z0-9 \t\n\f\r]', '', 'g')), ' ')) AS word
        FROM {source} WHERE {key} IS NOT NULL)
      WHERE word <> '')"""


def _top_words(source: str, key: str, text: str, top: int = 300, stop: str = _STOP) -> str:
    return f"""WITH {_tokens(source, key, text)}
      SELECT word, count(DISTINCT id) AS frequency FROM tokens WHERE word NOT IN ({stop})
      GROUP BY word ORDER BY frequency DESC, word LIMIT {top}"""


_SEMI_JOIN = f"""WITH {_tokens('documents', 'doc_id', 'text')},
  filtered AS (SELECT word FROM tokens WHERE word NOT IN ({_STOP}))
  SELECT word, count(DISTINCT id) AS frequency FROM tokens
  WHERE word IN (SELECT word FROM filtered)
  GROUP BY word ORDER BY frequency DESC, word LIMIT 300"""


def _ranked_words(source: str, key: str, text: str, group: str, top: int) -> str:
    return f"""SELECT {group}, word, frequency FROM (
      SELECT *, row_number() OVER (PARTITION BY {group} ORDER BY frequency DESC, word) AS place FROM (
        SELECT {group}, word, count(DISTINCT id) AS frequency
        FROM ({_with(_tokens(source, key, text, group + ','), 'SELECT * FROM tokens')})
        WHERE word NOT IN ({_STOP}) GROUP BY {group}, word))
      WHERE place <= {top}"""


def _with(*parts: str) -> str:
    *ctes, body = parts
    return f"WITH {', '.join(ctes)} {body}"


# --- silver -----------------------------------------------------------------


def _salary(pattern: str, c: str = "salary") -> str:
    return rf"""TRY_CAST(regexp_extract(regexp_replace(lower({c}), '[^0-9–-]+', '', 'g'),
      '{pattern}', 1) AS DECIMAL(38, 9))"""


_MIN, _MAX = _salary(r"^(\d+)"), _salary(r"[–-](\d+)$")
_ROLE = """CASE WHEN lower(role) LIKE '%data engineer%'
  THEN regexp_replace(role, 'data engineer', 'Data Engineer', 'gi') ELSE role END"""
_WORK = f"""CASE WHEN lower(work_type) LIKE '%kontrak%' AND lower(work_type) LIKE '%full%'
  THEN '{vocab.CONTRACT_WORK_TYPE}'
  WHEN work_type IS NULL OR work_type = '' THEN '{vocab.NO_WORK_TYPE}' ELSE work_type END"""
_NO_COMPANY = vocab.NO_COMPANY.replace("'", "''")


def _clean(source: str, by: str = "") -> str:
    """CTE ``clean``: silver without its dense key."""
    return f"""clean AS (
      SELECT * REPLACE ({_ROLE} AS role, {_WORK} AS work_type),
        {_MIN} AS salary_min_cleaned, {_MAX} AS salary_max_cleaned
      FROM (
        SELECT {by} Job_ID AS raw_id, {_trim('Job_ID')} AS job_id_platform, {_trim('Role')} AS role,
          coalesce({_trim('Company')}, '{_NO_COMPANY}') AS company, {_trim('Location')} AS location,
          strptime({_trim('Publish_Time')}, '%Y-%m-%d %H:%M:%S') AS posted_time,
          {_trim('URL')} AS url, {_trim('job_desc')} AS job_desc, {_trim('salary')} AS salary,
          {_trim('work_type')} AS work_type, {_trim('country')} AS country
        FROM (SELECT *, row_number() OVER (PARTITION BY {by} Job_ID ORDER BY Publish_Time, URL) AS dup
              FROM {source} WHERE Job_ID IS NOT NULL AND Role IS NOT NULL
                AND URL IS NOT NULL AND Publish_Time IS NOT NULL)
        WHERE dup = 1))"""


def _silver(source: str, by: str = "") -> str:
    over = f"PARTITION BY {by[:-1]} " if by else ""
    return f"""SELECT row_number() OVER ({over}ORDER BY job_id_platform DESC, raw_id) AS job_id,
      * EXCLUDE (raw_id) FROM clean"""


_CLEAN = _with(_POSTINGS, _clean("postings"), "{}")

# --- raw files and layers ---------------------------------------------------

_RAW = """Job_ID, Role, Company, Location, Publish_Time, URL, country, job_desc, salary,
  {work} AS work_type, source, CAST(day AS DATE) AS table_date"""
_JSON_RAW = _RAW.format(work="work_type")
_CSV_RAW = _RAW.format(work="nullif(work_type, '')")
_STAGED = f"""staged AS (
  SELECT Job_ID, Role, Company, Location, min(Publish_Time) AS Publish_Time, URL, country, job_desc,
    salary, work_type, source, CAST(day AS DATE) AS table_date
  FROM postings GROUP BY ALL)"""
# What is left of the first day after it has been loaded again.
_HALF = "half AS (SELECT * FROM staged WHERE table_date = DATE '2025-07-19' OR length(URL) % 2 = 0)"
_HALF = f"{_STAGED}, {_HALF}"


def _percentiles(by: list[str], shares: tuple[float, ...]) -> str:
    """The salary at rank ceil(share * n) of each group's salaries."""
    over = f"PARTITION BY {', '.join(by)}" if by else ""
    keys = "".join(f"{c}, " for c in by)
    return f"""SELECT {keys}share, value, postings FROM (
      SELECT {keys}salary_min_cleaned AS value, row_number() OVER ({over} ORDER BY salary_min_cleaned) AS place,
        count(*) OVER ({over}) AS postings FROM clean WHERE salary_min_cleaned IS NOT NULL),
      (SELECT unnest([{', '.join(f'CAST({s} AS DOUBLE)' for s in shares)}]) AS share)
      WHERE place = greatest(1, CAST(ceil(share * postings) AS BIGINT))"""


_SECOND = "table_date = DATE '2025-07-19' AND source = 'board_north'"

_DEDUP_KEYS = "Role, Location, country, salary, work_type"

# --- pages ------------------------------------------------------------------

_UNITS = "CASE o_orderkey % 3 WHEN 0 THEN 'm' WHEN 1 THEN 'h' ELSE 'd' END"
_TERM = """CASE o_orderkey % 4 WHEN 0 THEN 'Data Engineer' WHEN 1 THEN 'ETL Developer'
  WHEN 2 THEN 'Big Data Engineer' ELSE 'Chef' END"""
# Two keywords or more among the role's words.
_MATCHES = rf"""len(list_intersect(regexp_extract_all(lower(Role), '\w+'),
  [{_quoted([k.lower() for k in vocab.ROLE_KEYWORDS])}])) >= 2"""
_CARDS = f"""cards AS (
  SELECT o_orderkey AS page_id, 0 AS position, {_TERM} AS keyword,
    CAST(o_orderkey AS VARCHAR) AS Job_ID, concat('Data & Engineer ', o_orderpriority) AS Role,
    concat('PT A', o_custkey) AS Company, concat('City', chr(10), o_orderstatus) AS Location,
    strftime(o_orderdate - CASE o_orderkey % 3
        WHEN 0 THEN to_minutes(o_orderkey % 50) WHEN 1 THEN to_hours(o_orderkey % 50)
        ELSE to_days(CAST(o_orderkey % 50 AS INTEGER)) END, '%Y-%m-%d %H:%M:%S') AS Publish_Time
  FROM orders
  UNION ALL
  SELECT o_orderkey, 1, {_TERM}, concat(o_orderkey, 'x'), concat(
    CASE WHEN o_orderkey % 5 = 0 THEN 'Office Manager ' ELSE 'ETL Developer ' END, o_orderstatus),
    NULL, NULL, strftime(o_orderdate, '%Y-%m-%d %H:%M:%S')
  FROM orders)"""
_CARD_DETAILS = """details AS (
  SELECT o_orderkey AS page_id, concat('https://example.com/job/', o_orderkey) AS URL,
    concat('Needs SQL; status ', o_orderstatus, '; R&D; Call ', o_custkey,
      CASE WHEN o_orderkey % 2 = 0 THEN ' more' ELSE '' END) AS job_desc,
    CASE WHEN o_orderkey % 3 = 0 THEN concat('Rp ', o_custkey) ELSE '' END AS salary,
    'Full time; Kontrak' AS work_type
  FROM orders)"""
_ARTICLE = r"regexp_extract(html, '(?s)<article>(.*)</article>', 1)"
_ARTICLE = rf"regexp_replace({_ARTICLE}, '\s+', ' ', 'g')"
_ARTICLE = rf"regexp_replace({_ARTICLE}, ' ?<br> ?', chr(10), 'g')"
_ARTICLE = rf"regexp_replace({_ARTICLE}, '\s*(</?(p|h1|h2|h3|div|ul|li)>\s*)+', chr(10), 'g')"
_ARTICLE = rf"regexp_replace({_ARTICLE}, '<[^>]*>', '', 'g')"
for _name, _char in (("lt", "<"), ("gt", ">"), ("quot", '"'), ("#x27", "''"), ("#39", "''"), ("amp", "&")):
    _ARTICLE = f"replace({_ARTICLE}, '&{_name};', '{_char}')"
_ARTICLE = f"replace({_trim(_ARTICLE)}, chr(10), '; ')"

# --- times ------------------------------------------------------------------

_AGE = """CASE event_id % 7 WHEN 0 THEN ts - to_minutes(event_id % 60)
  WHEN 1 THEN ts - to_hours(event_id % 24) WHEN 2 THEN ts - to_days(CAST(event_id % 40 AS INTEGER))
  WHEN 4 THEN ts - to_hours(event_id % 9) WHEN 5 THEN ts - to_minutes(event_id % 9) ELSE ts END"""
_TIMED = """timed AS (
  SELECT event_id, event_type, strftime(ts, '%Y-%m-%d %H:%M:%S') AS Publish_Time FROM events)"""


def _dimension(column: str) -> str:
    return f"""dim_{column} AS (SELECT {column}, row_number() OVER (ORDER BY {column}) AS {column}_key
      FROM (SELECT DISTINCT {column} FROM clean WHERE {column} IS NOT NULL))"""


ORACLES = {
    "word_frequency": _top_words("documents", "doc_id", "text"),
    "word_frequency_semi_join": _SEMI_JOIN,
    "word_frequency_repeated_keys": _top_words("conversations", "conv_id", "text"),
    "word_frequency_stop_table": _top_words(
        "documents", "doc_id", "text", 50,
        "SELECT lower(n_name) FROM nation UNION ALL SELECT lower(r_name) FROM region",
    ),
    "word_frequency_by_language": _ranked_words("documents", "doc_id", "text", "lang", 20),
    "job_words": _with(
        _tokens("documents", "doc_id", "text"),
        "SELECT id AS doc_id, count(*) AS words, max(word) AS last_word FROM tokens GROUP BY id",
    ),
    "silver_postings": _with(_POSTINGS, _clean("postings"), _silver("clean")),
    "silver_by_source": _with(_POSTINGS, _clean("postings", "source,"), _silver("clean", "source,")),
    "trimmed_text": _with(
        _POSTINGS,
        "SELECT URL, " + ", ".join(f"{_trim(c)} AS {c}" for c in ("Job_ID", "Role", "work_type"))
        + " FROM postings",
    ),
    "role_casing": _with(_POSTINGS, f"SELECT URL, {_ROLE} AS role FROM postings"),
    "work_type_normalised": _with(_POSTINGS, f"SELECT URL, {_WORK} AS work_type FROM postings"),
    "salary_bounds": _with(
        _POSTINGS, f"SELECT URL, salary, {_MIN} AS salary_min, {_MAX} AS salary_max FROM postings"
    ),
    "role_keyword_match": _with(
        _POSTINGS,
        rf"""SELECT URL, Role FROM postings WHERE len(list_intersect(
          regexp_extract_all(lower(Role), '\w+'), [{_quoted([k.lower() for k in vocab.ROLE_KEYWORDS])}])) >= 2""",
    ),
    "required_fields": _with(
        _POSTINGS,
        """SELECT Job_ID, Role, URL, Publish_Time FROM postings WHERE Job_ID IS NOT NULL
          AND Role IS NOT NULL AND URL IS NOT NULL AND Publish_Time IS NOT NULL""",
    ),
    "dedup_ignoring_time": _with(
        _POSTINGS,
        f"""SELECT * EXCLUDE (place) FROM (
          SELECT {_DEDUP_KEYS}, Publish_Time, count(*) OVER (PARTITION BY {_DEDUP_KEYS}) AS copies,
            row_number() OVER (PARTITION BY {_DEDUP_KEYS} ORDER BY Publish_Time NULLS LAST) AS place
          FROM postings) WHERE place = 1""",
    ),
    "dedup_report": _with(
        _POSTINGS,
        f"""SELECT a AS rows_before, b AS rows_after, a - b AS rows_removed FROM (
          SELECT (SELECT count(*) FROM postings) AS a,
            (SELECT count(*) FROM (SELECT DISTINCT {_DEDUP_KEYS} FROM postings)) AS b)""",
    ),
    "first_per_key": """SELECT * EXCLUDE (place) FROM (SELECT *,
        row_number() OVER (PARTITION BY user_id ORDER BY ts, event_id) AS place FROM events)
      WHERE place = 1""",
    "dense_id": """SELECT key, row_number() OVER (ORDER BY key DESC) AS id
      FROM (SELECT CAST(o_orderkey AS VARCHAR) AS key FROM orders)""",
    "dense_id_by_group": """SELECT event_type, event_id, ts,
      row_number() OVER (PARTITION BY event_type ORDER BY ts DESC, event_id) AS id FROM events""",
    "quality_nulls": _with(
        _POSTINGS,
        """SELECT count(*) AS null_count FROM postings WHERE Job_ID IS NULL OR Role IS NULL
          OR Company IS NULL OR Publish_Time IS NULL OR URL IS NULL""",
    ),
    "quality_duplicates": _CLEAN.format(
        "SELECT job_id_platform FROM clean GROUP BY job_id_platform HAVING count(*) > 1"
    ),
    "quality_report": _with(
        _POSTINGS,
        """SELECT (SELECT count(*) FROM postings WHERE Job_ID IS NULL OR Role IS NULL
            OR Company IS NULL OR Publish_Time IS NULL OR URL IS NULL) AS null_count,
          (SELECT count(*) FROM (SELECT 1 FROM postings GROUP BY Job_ID
            HAVING count(*) > 1)) AS dup_count""",
    ),
    "publish_time_from_age": f"""SELECT event_id,
      strftime({_AGE}, '%Y-%m-%d %H:%M:%S') AS publish_time FROM events""",
    "parse_time_lenient": """SELECT event_id, parsed,
        strftime(parsed, '%Y-%m-%d %H:%M:%S') AS rendered
      FROM (SELECT event_id, CASE event_id % 5 WHEN 0 THEN date_trunc('second', ts)
        WHEN 1 THEN date_trunc('second', ts) - to_hours(7)
        WHEN 3 THEN CAST(date_trunc('day', ts) AS TIMESTAMP) END AS parsed FROM events)""",
    "high_water_mark": _with(_TIMED, "SELECT max(Publish_Time) AS max_time FROM timed"),
    "high_water_mark_by_group": _with(
        _TIMED, "SELECT event_type, max(Publish_Time) AS max_time FROM timed GROUP BY event_type"
    ),
    "newer_than": _with(
        _TIMED,
        """SELECT * FROM timed WHERE Publish_Time >
          (SELECT max(Publish_Time) FROM timed WHERE event_type = 'error')""",
    ),
    "newer_than_pushed": "SELECT event_id, ts FROM events WHERE ts > TIMESTAMP '2024-01-10 00:00:00'",
    "page_links": f"""SELECT page_id, CAST(i - 1 AS INTEGER) AS position,
        regexp_extract(links[i], 'href="([^"]*)"', 1) AS href,
        {_trim("regexp_replace(links[i], '<[^>]*>', '', 'g')")} AS label
      FROM (SELECT page_id, links, unnest(range(1, len(links) + 1)) AS i FROM (
        SELECT page_id, regexp_extract_all(html, '(?is)<a [^>]*href[^>]*>.*?</a>') AS links FROM pages))""",
    "page_details": f"SELECT page_id, {_ARTICLE} AS article FROM pages",
    "page_cards": _with(
        _CARDS,
        """SELECT *, concat('https://example.com/job/', Job_ID) AS URL, 'indonesia' AS country
          FROM cards""",
    ),
    "page_cards_matching": _with(_CARDS, f"SELECT Job_ID, Role FROM cards WHERE {_MATCHES}"),
    "page_job_details": _with(_CARD_DETAILS, "SELECT * FROM details"),
    "attach_details": """SELECT URL, Role, coalesce(job_desc, '') AS job_desc,
        coalesce(salary, '') AS salary, coalesce(work_type, '') AS work_type
      FROM (SELECT concat('https://example.com/job/', o_orderkey) AS URL, o_orderpriority AS Role FROM orders)
      LEFT JOIN (SELECT * FROM (
        SELECT concat('https://example.com/job/', l_orderkey) AS URL, concat('part ', l_partkey) AS job_desc,
          l_returnflag AS salary, l_linestatus AS work_type, row_number() OVER (PARTITION BY l_orderkey
            ORDER BY l_partkey, l_returnflag, l_linestatus) AS place
        FROM lineitem) WHERE place = 1) USING (URL)""",
    "collected_postings": _with(
        _CARDS,
        _CARD_DETAILS,
        """SELECT Job_ID, Role, Company, Location, Publish_Time, URL, 'indonesia' AS country,
            coalesce(job_desc, '') AS job_desc, coalesce(salary, '') AS salary,
            coalesce(work_type, '') AS work_type, 'board_north' AS source,
            DATE '2025-07-18' AS table_date
          FROM (SELECT *, concat('https://example.com/job/', Job_ID) AS URL FROM cards
            WHERE """ + _MATCHES + f""" AND keyword IN ({_quoted(vocab.SEARCH_TERMS)})
              AND Publish_Time > '1994-06-30 00:00:00')
          LEFT JOIN (SELECT * EXCLUDE (page_id) FROM details) USING (URL)""",
    ),
    "csv_round_trip": _with(_POSTINGS, f"SELECT {_CSV_RAW} FROM postings"),
    "json_round_trip": _with(_POSTINGS, f"SELECT {_JSON_RAW} FROM postings"),
    "files_of_one_day": _with(_POSTINGS, f"SELECT {_CSV_RAW} FROM postings WHERE day = '2025-07-18'"),
    "union_by_name": _with(
        _POSTINGS,
        """SELECT Job_ID, Role, Company, Location, Publish_Time, URL, country, job_desc, salary, work_type
          FROM postings WHERE day = '2025-07-19'
          UNION ALL BY NAME
          SELECT Job_ID, Role, Company, Location, Publish_Time, URL FROM postings WHERE day = '2025-07-18'""",
    ),
    "staging_pruned": _with(
        _POSTINGS,
        _STAGED,
        "SELECT * FROM staged WHERE source = 'board_north' AND table_date = DATE '2025-07-18'",
    ),
    "load_full": _with(
        _POSTINGS,
        _STAGED,
        f"""SELECT * FROM staged WHERE {_SECOND}
          OR (table_date = DATE '2025-07-18' AND source = 'board_south')""",
    ),
    "load_incremental": _with(
        _POSTINGS,
        _STAGED,
        "SELECT * FROM staged",
    ),
    "stream_ingest": _with(_POSTINGS, f"SELECT {_CSV_RAW} FROM postings"),
    "csv_columns_by_name": _with(
        _POSTINGS, "SELECT URL, Job_ID, Role, Company, Location, Publish_Time FROM postings"
    ),
    "stream_by_header": _with(
        _POSTINGS, "SELECT URL, Job_ID, Role, Company, Location, Publish_Time FROM postings"
    ),
    "stream_compacted": _with(
        _POSTINGS, "SELECT URL, Job_ID, Role, Company, Location, Publish_Time FROM postings"
    ),
    "load_day_twice": _with(_POSTINGS, _STAGED, "SELECT * FROM staged"),
    "high_water_mark_maintained": _with(
        _POSTINGS,
        _STAGED,
        "SELECT source, max(Publish_Time) AS max_mark, CAST(count(*) AS BIGINT) AS rows FROM staged GROUP BY source",
    ),
    "incremental_silver": _with(_POSTINGS, _HALF, _clean("half", "source,"), _silver("clean", "source,")),
    "incremental_gold": _with(
        _POSTINGS,
        _HALF,
        _clean("half", "source,"),
        _ranked_words("clean", "raw_id", "job_desc", "source", 300),
    ),
    "last_processed_time": _with(
        _POSTINGS,
        "SELECT source, '' AS first_run, max(Publish_Time) AS mark FROM postings GROUP BY source",
    ),
    "daily_run_silver": _with(_POSTINGS, _clean("postings", "source,"), _silver("clean", "source,")),
    "daily_run_gold": _with(
        _POSTINGS,
        _clean("postings", "source,"),
        _ranked_words("clean", "raw_id", "job_desc", "source", 300),
    ),
    "jobs_by_role_location": _CLEAN.format(
        "SELECT role, location, count(*) AS postings FROM clean GROUP BY role, location"
    ),
    "jobs_by_role_location_totals": _CLEAN.format(
        """SELECT role, location, CAST(grouping(role, location) AS INTEGER) AS level, count(*) AS postings
          FROM clean GROUP BY ROLLUP (role, location)"""
    ),
    "salary_percentiles": _CLEAN.format(_percentiles([], (0.25, 0.5, 0.75))),
    "salary_percentiles_by_company": _CLEAN.format(_percentiles(["company"], (0.1, 0.5, 0.9))),
    "keyword_trend": _with(
        _POSTINGS,
        _clean("postings"),
        "dated AS (SELECT *, CAST(date_trunc('month', posted_time) AS TIMESTAMP) AS period FROM clean)",
        _tokens("dated", "raw_id", "job_desc", "period,"),
        f"""SELECT period, word, frequency, place FROM (
          SELECT *, row_number() OVER (PARTITION BY period ORDER BY frequency DESC, word) AS place FROM (
            SELECT period, word, count(DISTINCT id) AS frequency FROM tokens
            WHERE word NOT IN ({_STOP}) GROUP BY period, word))
          WHERE place <= 10""",
    ),
    "newest_jobs": _CLEAN.format(
        """SELECT job_id_platform, role, company, posted_time, url FROM clean
          ORDER BY posted_time DESC, job_id_platform, url LIMIT 100"""
    ),
    "salary_distribution": _CLEAN.format(
        """SELECT CAST(floor(salary_min_cleaned / 100000000) * 100000000 AS DECIMAL(38, 0)) AS salary_from,
            count(*) AS postings, min(salary_min_cleaned) AS lowest_min, max(salary_max_cleaned) AS highest_max,
            quantile_disc(salary_min_cleaned, 0.5) AS median_min
          FROM clean GROUP BY 1"""
    ),
    "postings_fact": _with(
        _POSTINGS,
        _clean("postings"),
        *[_dimension(c) for c in ("company", "location", "role")],
        """SELECT raw_id, company_key, location_key, role_key, posted_time FROM clean
          LEFT JOIN dim_company USING (company) LEFT JOIN dim_location USING (location)
          LEFT JOIN dim_role USING (role)""",
    ),
    "company_dimension": _with(
        _POSTINGS, _clean("postings"), _dimension("company"), "SELECT * FROM dim_company"
    ),
}
