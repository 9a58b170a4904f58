"""The registered queries again, as plain SQL over the given tables.

Written from the rules, not from the Spark plans: matching is a substring join,
ranking a window over the whole board.
"""

from __future__ import annotations

from tallyboard.plans.inputs import CATEGORY_DOCUMENTS, RAW_ANSWERS
from tallyboard.schemas import VALID_LABELS, WORK_CATEGORIES, ZERO_ID


def _quoted(text: str) -> str:
    escaped = text.replace("'", "''").replace("\n", "' || chr(10) || '").replace("\t", "' || chr(9) || '")
    return f"('{escaped}')"


def _list(values) -> str:
    return "[" + ", ".join(_quoted(v) for v in values) + "]::VARCHAR[]"


def _in(values) -> str:
    return "(" + ", ".join(_quoted(v) for v in values) + ")"


def _hex_id(number: str) -> str:
    return f"lpad(lower(to_hex(CAST({number} AS BIGINT))), 24, '0')"


MESSAGES = f"""
counted AS (SELECT count(*) AS n FROM pages),
messages AS (
  SELECT e.event_id AS seq,
         CAST(e.user_id AS VARCHAR) AS user_id,
         CASE WHEN e.event_id % 97 = 0 THEN 'bad-id' ELSE {_hex_id("e.event_id")} END AS usage_log_id,
         {_hex_id('''p.page_id * 10 + CASE e.event_type WHEN 'error' THEN 0 WHEN 'view' THEN 1
                  WHEN 'click' THEN 2 WHEN 'signup' THEN 3 ELSE 4 END''')} AS categorized_data_id,
         CASE e.event_type WHEN 'error' THEN 'Terminal' WHEN 'view' THEN 'YouTube'
              WHEN 'click' THEN 'Chrome' WHEN 'signup' THEN 'Safari' ELSE 'Figma' END AS app,
         p.url AS url,
         'Page ' || CAST(p.page_id AS VARCHAR) AS title,
         CAST(1 + hour(e.ts) // 6 AS BIGINT) AS session_no,
         CAST(25 AS BIGINT) AS session_minutes,
         CAST(e.ts AS DATE) AS session_date,
         e.value AS duration,
         epoch(e.ts) AS ts_epoch,
         e.event_id % 10 = 0 AS is_end,
         p.page_id AS page_id
  FROM (SELECT events.*, events.event_id % counted.n AS at_page FROM events, counted) e
  JOIN pages p ON p.page_id = e.at_page)"""

# Text fields with the same oddities as the raw input, then parsed by the stated rules.
NORMALIZED = f"""{MESSAGES},
raw AS (
  SELECT seq, user_id, usage_log_id, categorized_data_id, app, url, title,
         CASE seq % 50 WHEN 1 THEN '5.7' WHEN 7 THEN ' 5 ' ELSE CAST(session_no AS VARCHAR) END AS session_text,
         CAST(session_minutes AS VARCHAR) AS minutes_text,
         CASE seq % 50 WHEN 4 THEN '2024-1-5'
              WHEN 5 THEN strftime(session_date, '%Y-%m-%d') || 'T23:30:00+09:00'
              ELSE strftime(session_date, '%Y-%m-%d') END AS date_text,
         CASE WHEN seq % 50 <> 0 THEN CAST(duration AS VARCHAR) END AS duration_text,
         CASE WHEN seq % 50 <> 6 THEN CAST(ts_epoch AS VARCHAR) END AS ts_text,
         CASE seq % 50 WHEN 2 THEN 'yes' WHEN 3 THEN 'T' ELSE CAST(is_end AS VARCHAR) END AS end_text
  FROM messages),
normalized AS (
  SELECT seq, user_id, usage_log_id, categorized_data_id, app, url, title,
         coalesce(CASE WHEN regexp_full_match(session_text, '[+-]?[0-9]+')
                       THEN TRY_CAST(session_text AS BIGINT) END, 0) AS session_no,
         coalesce(CASE WHEN regexp_full_match(minutes_text, '[+-]?[0-9]+')
                       THEN TRY_CAST(minutes_text AS BIGINT) END, 0) AS session_minutes,
         CASE WHEN regexp_full_match(date_text, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}(T.*)?')
              THEN CAST(substring(date_text, 1, 10) AS DATE) ELSE DATE '0001-01-01' END AS session_date,
         coalesce(TRY_CAST(duration_text AS DOUBLE), 0) AS duration,
         coalesce(TRY_CAST(ts_text AS DOUBLE), 0) AS ts_epoch,
         coalesce(end_text IN ('1', 't', 'T', 'TRUE', 'true', 'True'), false) AS is_end
  FROM raw)"""

_DOCUMENTS = ", ".join(
    f"({_hex_id(str(ord_))}, {_quoted(category)}, {_list(apps)}, {_list(urls)}, {ord_})"
    for ord_, category, apps, urls in CATEGORY_DOCUMENTS
)
PATTERNS = f"""
patterns AS (
  SELECT * FROM (VALUES {_DOCUMENTS}) AS t(category_id, category, app_patterns, domain_patterns, ord))"""

SITES = f"""
patterns AS (
  SELECT {_hex_id("1000 + page_id")} AS category_id,
         CASE WHEN page_id % 23 = 0 THEN '' ELSE ({_list(VALID_LABELS)})[page_id % {len(VALID_LABELS)} + 1]
         END AS category,
         [site, upper(substring(site, 1, 1)) || substring(site, 2)] AS app_patterns,
         [site, path] AS domain_patterns,
         page_id AS ord
  FROM (SELECT page_id,
               regexp_extract(url, '^[a-z]+://(?:m\\.|blog\\.|www\\.)?([a-z0-9-]+)', 1) AS site,
               regexp_extract(url, '(/[a-z]+/[0-9]+)', 1) AS path
        FROM pages))"""

DICTIONARY = """
dictionary AS (
  SELECT category_id, category, 'app' AS kind, ord, CAST(i - 1 AS INTEGER) AS pos, app_patterns[i] AS pattern
  FROM patterns, range(1, 3) AS r(i) WHERE i <= len(app_patterns)
  UNION ALL
  SELECT category_id, category, 'url', ord, CAST(i - 1 AS INTEGER), domain_patterns[i]
  FROM patterns, range(1, 3) AS r(i) WHERE i <= len(domain_patterns)),
rules AS (
  SELECT kind, pattern, category FROM (
    SELECT *, row_number() OVER (PARTITION BY kind, pattern ORDER BY ord DESC, pos DESC) AS back
    FROM dictionary WHERE kind = 'app' OR pattern <> '')
  WHERE back = 1 AND category <> '')"""

URL_HITS = """
url_hits AS (
  SELECT url, category AS url_category FROM (
    SELECT u.url, r.category,
           row_number() OVER (PARTITION BY u.url ORDER BY strpos(u.url, r.pattern) + length(r.pattern),
                              length(r.pattern) DESC) AS place
    FROM (SELECT DISTINCT url FROM messages) u
    JOIN rules r ON r.kind = 'url' AND contains(u.url, r.pattern))
  WHERE place = 1)"""

LABELS = """
labels_by_query AS (
  SELECT 'app: ' || app || ', title: Page ' || CAST(page_id AS VARCHAR) || ', url: ' || url AS query,
         CASE WHEN page_id % 3 = 0 THEN 'Finance' ELSE 'Uncategorized' END AS label_category
  FROM pages, (SELECT unnest(['chrome', 'safari', 'figma']) AS app)
  WHERE page_id % 3 <> 2)"""

_QUERY_KEY = "'app: ' || lower(m.app) || ', title: ' || m.title || ', url: ' || m.url"


def _cascade(source: str = "messages", labels: bool = False, patterns: str = PATTERNS) -> str:
    label = "l.label_category" if labels else "CAST(NULL AS VARCHAR)"
    join = f"LEFT JOIN labels_by_query l ON l.query = {_QUERY_KEY}" if labels else ""
    return f"""{patterns},{DICTIONARY},{URL_HITS},{LABELS},
classified AS (
  SELECT m.*,
         coalesce(a.category, h.url_category, {label}, 'Uncategorized') AS category,
         CASE WHEN a.category IS NOT NULL THEN 'app' WHEN h.url_category IS NOT NULL THEN 'url'
              WHEN {label} IS NOT NULL THEN 'label' ELSE 'none' END AS method,
         a.category IS NULL AND h.url_category IS NULL AS is_llm
  FROM {source} m
  LEFT JOIN rules a ON a.kind = 'app' AND a.pattern = lower(m.app)
  LEFT JOIN url_hits h ON h.url = m.url
  {join})"""


CLASSIFIED = f"{MESSAGES},{_cascade()}"
CLASSIFIED_LABELS = f"{MESSAGES},{_cascade(labels=True)}"
CLASSIFIED_STREAM = f"{NORMALIZED},{_cascade('normalized', labels=True)}"

WITH_ID = f"""
with_id AS (
  SELECT c.*, coalesce(p.category_id, '{ZERO_ID}') AS category_id
  FROM classified c LEFT JOIN patterns p ON p.category = c.category)"""

_EXACT = "CAST(sum(CAST(duration AS DECIMAL(18, 2))) AS DOUBLE)"
_LOCAL_DAY = """CAST(make_timestamp(CAST(trunc({0}) AS BIGINT) * 1000000) + INTERVAL 9 HOUR AS DATE)"""


def _week(day: str) -> str:
    return f"CAST(isoyear({day}) AS VARCHAR) || '-W' || CAST(weekofyear({day}) AS VARCHAR)"


def _month(day: str) -> str:
    return f"CAST(year({day}) AS VARCHAR) || '-M' || CAST(month({day}) AS VARCHAR)"


DAILY = f"""
dated AS (SELECT *, {_LOCAL_DAY.format("ts_epoch")} AS day FROM classified),
boards AS (
  SELECT category AS board, category, user_id, day, duration FROM dated
  UNION ALL
  SELECT 'work', category, user_id, day, duration FROM dated WHERE category IN {_in(WORK_CATEGORIES)}),
fanned AS (
  SELECT board, category, 'day' AS period_kind, strftime(day, '%Y-%m-%d') AS period, user_id, day, duration
  FROM boards
  UNION ALL SELECT board, category, 'week', {_week("day")}, user_id, day, duration FROM boards
  UNION ALL SELECT board, category, 'month', {_month("day")}, user_id, day, duration FROM boards)"""

BOARD = f"""{DAILY},
leaderboard AS (
  SELECT board, period_kind, period, 'leaderboard:' || board || ':' || period AS key, user_id, {_EXACT} AS score
  FROM fanned GROUP BY board, period_kind, period, user_id)"""

CATEGORIZED = f"""
stored AS (
  SELECT DISTINCT categorized_data_id, app, url, title, '{ZERO_ID}' AS category_id, false AS is_llm_based
  FROM messages WHERE page_id % 4 <> 3)"""

LOGS = f"""
logs AS (
  SELECT usage_log_id, user_id, categorized_data_id, '{ZERO_ID}' AS category_id, session_no, session_minutes,
         session_date, ts_epoch, duration
  FROM messages WHERE usage_log_id <> 'bad-id' AND seq % 53 <> 0)"""

_LOG_KEY = (
    "user_id || chr(1) || categorized_data_id || chr(1) || strftime(session_date, '%Y-%m-%d') || chr(1) || "
    "CAST(session_no AS VARCHAR) || chr(1) || CAST(seq AS VARCHAR)"
)
_LOG_COLUMNS = (
    f"user_id, categorized_data_id, '{ZERO_ID}' AS category_id, session_no, session_minutes, session_date, "
    "ts_epoch, duration"
)
_NATURAL_ID = "substring(sha256(app || chr(1) || url || chr(1) || title), 1, 24)"

_ANSWERS = ", ".join([_quoted(a) for a in RAW_ANSWERS] + ["NULL"])


def _sql(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select.strip()}"


_LEADERBOARD_COLUMNS = "SELECT board, period_kind, period, key, user_id, score FROM leaderboard"
_RANKED = """
  SELECT key, user_id, score, row_number() OVER (PARTITION BY key ORDER BY score DESC, user_id DESC) AS rank
  FROM leaderboard"""
_NORMALIZED_COLUMNS = """
  SELECT seq, user_id, usage_log_id, categorized_data_id, app, url, title, session_no, session_minutes,
         session_date, duration, ts_epoch, is_end FROM normalized"""
_SCORES = "SELECT user_id, strftime(session_date, '%Y-%m-%d') AS session_date, session_no FROM {0} WHERE is_end"
_URL_CATEGORY = "SELECT m.seq, m.url, h.url_category FROM messages m LEFT JOIN url_hits h ON h.url = m.url"
_LOGS_UPDATED = """
  SELECT g.usage_log_id, g.user_id, g.categorized_data_id, coalesce(w.category_id, g.category_id) AS category_id,
         g.session_no, g.session_minutes, g.session_date, g.ts_epoch, g.duration
  FROM logs g LEFT JOIN with_id w ON w.usage_log_id = g.usage_log_id"""

_OPEN_KEY = """'app: ' || lower(app) || ', title: ' || title || ', url: ' || url AS query,
       'Application: ' || lower(app) || chr(10) || 'Title: ' || title || chr(10) || 'URL: ' || url AS prompt"""

_SITE_CASCADE = f"{MESSAGES},{_cascade(labels=True, patterns=SITES)}"
_CLASSIFIED_COLUMNS = "SELECT seq, app, url, title, category, method, is_llm FROM classified"

# The first message of each shared id, batch by batch; all without an id.
_FIRST_SEEN = f"""{NORMALIZED},
once AS (
  SELECT * EXCLUDE (nth) FROM (
    SELECT *, row_number() OVER (PARTITION BY seq // 3, usage_log_id = 'bad-id' ORDER BY seq % 2, seq) AS nth
    FROM normalized)
  WHERE nth = 1 OR usage_log_id = 'bad-id')"""

_SITE_RULES = f"{MESSAGES},{SITES},{DICTIONARY},{URL_HITS}"
_SITES_ONLY = f"{SITES},{DICTIONARY}"

_ADDITIONS = f"""
offers AS (
  SELECT {_hex_id("1000 + page_id // 2")} AS category_id, page_id,
         regexp_extract(url, '^[a-z]+://(?:m\\.|blog\\.|www\\.)?([a-z0-9-]+)', 1) AS site,
         regexp_extract(url, '^[a-z]+://([^/]+)', 1) AS host
  FROM pages),
additions AS (
  SELECT category_id, kind, pattern, min(seq) AS seq FROM (
    SELECT category_id, 'app' AS kind, site AS pattern, page_id * 10 AS seq FROM offers
    UNION ALL SELECT category_id, 'url', site, page_id * 10 + 1 FROM offers
    UNION ALL SELECT category_id, 'url', host, page_id * 10 + 2 FROM offers)
  GROUP BY category_id, kind, pattern),
positions AS (
  SELECT category_id, kind, pattern, CAST(pos AS BIGINT) - 100 AS place FROM dictionary
  UNION ALL
  SELECT a.category_id, a.kind, a.pattern, a.seq FROM additions a
  WHERE NOT EXISTS (SELECT 1 FROM dictionary d WHERE d.category_id = a.category_id AND d.kind = a.kind
                    AND d.pattern = a.pattern))"""


_KEYS_UPDATED = """SELECT s.categorized_data_id, s.app, s.url, s.title, coalesce(w.category_id, s.category_id) AS category_id,
       s.is_llm_based
FROM stored s LEFT JOIN (
  SELECT categorized_data_id, arg_max(category_id, seq) AS category_id FROM with_id GROUP BY categorized_data_id) w
ON w.categorized_data_id = s.categorized_data_id"""


def all_oracles() -> dict[str, str]:
    return {
        "normalize_messages": _sql(NORMALIZED, _NORMALIZED_COLUMNS),
        "stream_ingest": _sql(NORMALIZED, _NORMALIZED_COLUMNS),
        "session_score_events": _sql(MESSAGES, _SCORES.format("messages")),
        "period_keys": _sql(
            f"""{MESSAGES},
moved AS (SELECT seq, {_LOCAL_DAY.format("(ts_epoch - (seq % 3650) * 86400)")} AS day FROM messages)""",
            f"""SELECT seq, 'leaderboard:Design:' || strftime(day, '%Y-%m-%d') AS day_key,
       'leaderboard:Design:' || {_week("day")} AS week_key,
       'leaderboard:Design:' || {_month("day")} AS month_key FROM moved""",
        ),
        "pattern_dictionary": _sql(
            _SITES_ONLY, "SELECT category_id, category, kind, ord, pos, pattern FROM dictionary"
        ),
        "pattern_dedup": _sql(_SITES_ONLY, "SELECT kind, pattern, category FROM rules"),
        "pattern_unmatchable": _sql(
            _SITES_ONLY,
            """SELECT category_id, kind, pos, pattern,
       CASE WHEN kind = 'app' THEN 'upper case app' ELSE 'empty url pattern' END AS reason
FROM dictionary
WHERE (kind = 'app' AND lower(pattern) <> pattern) OR (kind = 'url' AND pattern = '')""",
        ),
        "pattern_add": _sql(
            f"{_SITES_ONLY},{_ADDITIONS}",
            """SELECT category_id,
       string_agg(pattern, '|' ORDER BY place) FILTER (WHERE kind = 'app') AS app_patterns,
       string_agg(pattern, '|' ORDER BY place) FILTER (WHERE kind = 'url') AS domain_patterns
FROM positions GROUP BY category_id""",
        ),
        "dictionary_counters": _sql(
            _SITES_ONLY,
            """SELECT (SELECT count(*) FROM patterns) AS documents,
       (SELECT count(DISTINCT category) FROM patterns) AS categories,
       (SELECT count(*) FROM dictionary) AS patterns,
       (SELECT count(*) FROM rules) AS effective_patterns,
       (SELECT count(*) FROM dictionary WHERE (kind = 'app' AND lower(pattern) <> pattern)
        OR (kind = 'url' AND pattern = '')) AS unmatchable_patterns""",
        ),
        "list_categories": _sql(SITES, "SELECT category FROM patterns"),
        "category_to_id": _sql(
            SITES, "SELECT category, arg_max(category_id, ord) AS category_id FROM patterns GROUP BY category"
        ),
        "id_to_category": _sql(SITES, "SELECT category_id, category FROM patterns"),
        "classify_app": _sql(
            f"{MESSAGES},{PATTERNS},{DICTIONARY}",
            """SELECT m.seq, m.app, a.category AS app_category
FROM messages m LEFT JOIN rules a ON a.kind = 'app' AND a.pattern = lower(m.app)""",
        ),
        "classify_url": _sql(f"{MESSAGES},{PATTERNS},{DICTIONARY},{URL_HITS}", _URL_CATEGORY),
        "classify_url_sites": _sql(_SITE_RULES, _URL_CATEGORY),
        "classify_url_sites_join": _sql(_SITE_RULES, _URL_CATEGORY),
        "classify_label_lookup": _sql(
            f"{MESSAGES},{LABELS}",
            f"""SELECT m.seq, l.label_category
FROM messages m LEFT JOIN labels_by_query l ON l.query = {_QUERY_KEY}""",
        ),
        "classification_query_key": _sql(MESSAGES, f"SELECT m.seq, {_QUERY_KEY} AS query FROM messages m"),
        "label_prompt": _sql(
            MESSAGES,
            """SELECT seq, 'Application: ' || lower(app)
       || CASE WHEN seq % 5 = 0 THEN '' ELSE chr(10) || 'Title: ' || title END
       || CASE WHEN seq % 7 = 0 THEN '' ELSE chr(10) || 'URL: ' || url END AS prompt
FROM messages""",
        ),
        "label_validate": f"""SELECT page_id, CASE WHEN answer IS NULL THEN NULL
            WHEN trim(answer, ' ' || chr(9) || chr(10)) IN {_in(VALID_LABELS)}
            THEN trim(answer, ' ' || chr(9) || chr(10)) ELSE 'Uncategorized' END AS label
FROM (SELECT page_id, ([{_ANSWERS}])[page_id % {len(RAW_ANSWERS) + 1} + 1] AS answer FROM pages)""",
        "classify_usage": _sql(
            CLASSIFIED_LABELS, "SELECT seq, app, url, title, category, method, is_llm FROM classified"
        ),
        "classify_usage_sites": _sql(_SITE_CASCADE, _CLASSIFIED_COLUMNS),
        "classify_usage_sites_unbounded": _sql(_SITE_CASCADE, _CLASSIFIED_COLUMNS),
        "classification_method_counts": _sql(
            CLASSIFIED_LABELS,
            """SELECT method, is_llm, category, count(*) AS messages
FROM classified GROUP BY method, is_llm, category""",
        ),
        "unresolved_keys": _sql(
            CLASSIFIED_LABELS,
            f"SELECT DISTINCT {_OPEN_KEY}, lower(app) AS app, title, url FROM classified WHERE method = 'none'",
        ),
        "stream_open_keys": _sql(
            CLASSIFIED_STREAM, f"SELECT DISTINCT {_OPEN_KEY} FROM classified WHERE method = 'none'"
        ),
        "attach_category_id": _sql(
            f"{CLASSIFIED_LABELS},{WITH_ID}", "SELECT seq, category, category_id FROM with_id"
        ),
        "work_usage": _sql(
            CLASSIFIED,
            f"""SELECT category, count(*) AS messages, {_EXACT} AS total_duration
FROM classified WHERE category IN {_in(WORK_CATEGORIES)} GROUP BY category""",
        ),
        "leaderboard": _sql(f"{CLASSIFIED},{BOARD}", _LEADERBOARD_COLUMNS),
        "leaderboard_fanout": _sql(
            f"{CLASSIFIED},{DAILY}",
            f"""SELECT board, period_kind, period, 'leaderboard:' || board || ':' || period AS key, user_id,
       {_EXACT} AS duration
FROM fanned GROUP BY board, period_kind, period, user_id, category, day""",
        ),
        "leaderboard_delta_rollup": _sql(f"{CLASSIFIED},{BOARD}", _LEADERBOARD_COLUMNS),
        "leaderboard_rank": _sql(f"{CLASSIFIED},{BOARD}", _RANKED),
        "leaderboard_topk": _sql(
            f"{CLASSIFIED},{BOARD}", f"SELECT * FROM ({_RANKED}) WHERE rank <= 10"
        ),
        "usage_by_period": _sql(
            f"{CLASSIFIED},{DAILY}",
            f"""SELECT period_kind, period, category, {_EXACT} AS total_duration, count(*) AS messages
FROM fanned WHERE board = category GROUP BY period_kind, period, category""",
        ),
        "usage_log_insert": _sql(
            MESSAGES,
            f"""SELECT CASE WHEN seq % 3 = 0 AND seq > 0 THEN {_hex_id("seq")}
            ELSE substring(sha256({_LOG_KEY}), 1, 24) END AS usage_log_id, {_LOG_COLUMNS}
FROM messages""",
        ),
        "usage_log_construct": _sql(
            MESSAGES, f"SELECT substring(sha256({_LOG_KEY}), 1, 24) AS usage_log_id, {_LOG_COLUMNS} FROM messages"
        ),
        "categorized_insert": _sql(
            MESSAGES,
            f"""SELECT {_NATURAL_ID} AS categorized_data_id, app, url, title, '{ZERO_ID}' AS category_id,
       false AS is_llm_based
FROM (SELECT DISTINCT app, url, title FROM messages)""",
        ),
        "usage_log_by_session": _sql(
            f"{MESSAGES},{LOGS}",
            """SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY user_id, session_date, session_no ORDER BY usage_log_id) AS place
  FROM logs) WHERE place = 1""",
        ),
        "categorized_by_key": _sql(
            f"{MESSAGES},{CATEGORIZED}",
            """SELECT * EXCLUDE (place) FROM (
  SELECT *, row_number() OVER (PARTITION BY app, url, title ORDER BY categorized_data_id) AS place
  FROM stored) WHERE place = 1""",
        ),
        "categorized_find_many": _sql(
            f"{MESSAGES},{CATEGORIZED}",
            """SELECT s.* FROM stored s WHERE EXISTS (
  SELECT 1 FROM messages m WHERE m.app = s.app AND m.url = s.url AND m.title = s.title)""",
        ),
        "categorized_new_keys": _sql(
            f"{MESSAGES},{CATEGORIZED}",
            """SELECT DISTINCT app, url, title FROM messages m WHERE NOT EXISTS (
  SELECT 1 FROM stored s WHERE m.app = s.app AND m.url = s.url AND m.title = s.title)""",
        ),
        "latest_category_per_id": _sql(
            MESSAGES,
            f"""SELECT categorized_data_id AS record_id, {_hex_id("max(seq) % 9 + 1")} AS category_id,
       max(seq) AS seq
FROM messages GROUP BY categorized_data_id""",
        ),
        "usage_log_set_category": _sql(f"{CLASSIFIED},{WITH_ID},{LOGS}", _LOGS_UPDATED),
        "categorized_set_category": _sql(
            f"{CLASSIFIED},{WITH_ID},{CATEGORIZED}",
            _KEYS_UPDATED,
        ),
        "usage_log_set_categorized": _sql(
            f"{MESSAGES},{LOGS}",
            f"""SELECT g.usage_log_id, g.user_id, {_NATURAL_ID} AS categorized_data_id, g.category_id, g.session_no,
       g.session_minutes, g.session_date, g.ts_epoch, g.duration
FROM logs g JOIN messages m ON m.usage_log_id = g.usage_log_id""",
        ),
        "matched_updates": _sql(
            f"{CLASSIFIED},{WITH_ID},{LOGS}",
            """SELECT usage_log_id AS record_id, category_id FROM with_id
WHERE usage_log_id IN (SELECT usage_log_id FROM logs)""",
        ),
        "update_counters": _sql(
            f"{CLASSIFIED},{WITH_ID},{LOGS}",
            f"""SELECT count(*) AS updates, count(g.usage_log_id) AS matched,
       count(*) FILTER (WHERE g.usage_log_id IS NOT NULL AND w.category_id <> '{ZERO_ID}') AS modified,
       count(*) FILTER (WHERE g.usage_log_id IS NULL) AS no_op
FROM with_id w LEFT JOIN logs g ON g.usage_log_id = w.usage_log_id WHERE w.usage_log_id <> 'bad-id'""",
        ),
        "usage_log_set_category_upper": _sql(
            f"{CLASSIFIED},{WITH_ID},{LOGS}", _LOGS_UPDATED.replace("g.usage_log_id,", "upper(g.usage_log_id) AS usage_log_id,", 1)
        ),
        "pattern_add_rows": _sql(
            f"{_SITES_ONLY},{_ADDITIONS}",
            """SELECT category_id, kind, pattern,
       CAST(row_number() OVER (PARTITION BY category_id, kind ORDER BY place) - 1 AS INTEGER) AS pos
FROM positions WHERE category_id IN (SELECT category_id FROM patterns)""",
        ),
        "stream_drop_repeats_bounded": _sql(
            MESSAGES,
            f"""SELECT DISTINCT CASE WHEN usage_log_id = 'bad-id' THEN 'bad-id' ELSE {_hex_id("seq // 3")} END AS usage_log_id,
       CASE WHEN usage_log_id = 'bad-id' THEN seq END AS unnamed_seq
FROM messages""",
        ),
        "stream_usage_by_period": _sql(
            f"{NORMALIZED},{_cascade('normalized')},{DAILY}",
            f"""SELECT period_kind, period, category, {_EXACT} AS total_duration, count(*) AS messages
FROM fanned WHERE board = category GROUP BY period_kind, period, category""",
        ),
        "stream_row_bound": _sql(f"{CLASSIFIED_STREAM},{BOARD}", _LEADERBOARD_COLUMNS),
        "stream_sessions_sent": _sql(
            f"{NORMALIZED},scores AS ({_SCORES.format('normalized')})",
            """SELECT user_id AS key,
       '{"userId":"' || user_id || '","sessionDate":"' || session_date || '","session":"' || session_no || '"}' AS value
FROM scores""",
        ),
        "label_attempts": _sql(
            CLASSIFIED_LABELS,
            f"""SELECT query, CAST(CASE WHEN page % 7 = 3 OR page % 5 = 4 THEN 2 ELSE 1 END AS BIGINT) AS tries,
       CASE WHEN page % 7 = 3 THEN 'failed' WHEN page % 5 = 4 THEN 'no answer' ELSE 'answered' END AS outcome,
       CASE WHEN page % 7 = 3 OR page % 5 = 4 THEN NULL WHEN page % 2 = 1 THEN 'Game' ELSE ' Music ' END AS label
FROM (SELECT DISTINCT {_OPEN_KEY}, CAST(substring(title, 6) AS BIGINT) AS page FROM classified WHERE method = 'none')""",
        ),
        "leaderboard_user_rank": _sql(
            f"{CLASSIFIED},{BOARD}", f"SELECT * FROM ({_RANKED}) WHERE CAST(user_id AS BIGINT) % 100 = 0"
        ),
        "usage_log_publish": _sql(f"{CLASSIFIED},{WITH_ID},{LOGS}", _LOGS_UPDATED),
        "usage_log_append": _sql(
            MESSAGES, f"SELECT substring(sha256({_LOG_KEY}), 1, 24) AS usage_log_id, {_LOG_COLUMNS} FROM messages"
        ),
        "categorized_publish": _sql(f"{CLASSIFIED},{WITH_ID},{CATEGORIZED}", _KEYS_UPDATED),
        "leaderboard_closed_days": _sql(f"{CLASSIFIED_STREAM},{BOARD}", _LEADERBOARD_COLUMNS),
        "stream_after_fold": _sql(f"{CLASSIFIED_STREAM},{BOARD}", _LEADERBOARD_COLUMNS),
        "stream_drop_repeats": _sql(f"{_FIRST_SEEN},{_cascade('once')},{BOARD}", _LEADERBOARD_COLUMNS),
        "stream_end_to_end": _sql(f"{CLASSIFIED_STREAM},{BOARD}", _LEADERBOARD_COLUMNS),
        "stream_usage_logs": _sql(f"{CLASSIFIED_STREAM},{WITH_ID},{LOGS}", _LOGS_UPDATED),
        "stream_session_scores": _sql(NORMALIZED, _SCORES.format("normalized")),
        "batch_metrics": _sql(
            CLASSIFIED_STREAM,
            """SELECT method, count(*) AS messages, CAST(0 AS BIGINT) AS excluded,
       count(*) FILTER (WHERE usage_log_id = 'bad-id') AS invalid_ids,
       count(*) FILTER (WHERE is_end) AS ended
FROM classified GROUP BY method""",
        ),
        "refresh_mapping": _sql(
            f"{CLASSIFIED},{WITH_ID}",
            f"""SELECT usage_log_id AS record_id,
       CASE WHEN seq % 2 = 0 OR category_id = '{ZERO_ID}' THEN category_id
            ELSE {_hex_id("CAST('0x' || ltrim(category_id, '0') AS BIGINT) + 100")} END AS category_id
FROM with_id WHERE usage_log_id <> 'bad-id'""",
        ),
    }
