"""The same results as plain SQL over the provided tables."""

from forumlake_checks.feed import DISCUSSION_SILVER_SQL, EVENT_SILVER_SQL, SILVER_SQL

_TIES = "created_at, item_type, author, parent_id, score, descendants, ingest_date_str, title, url, text_content"
_STAGED = f"""
dated AS (
    SELECT *, strftime(created_at, '%Y-%m-%d') AS ingest_date, strftime(created_at, '%Y-%m-%d') AS ingest_date_str
    FROM silver
),
stg AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY ingest_date DESC NULLS LAST,
            source_file DESC NULLS LAST, {", ".join(f"{c} DESC NULLS LAST" for c in _TIES.split(", "))}) AS rn
        FROM dated
    ) WHERE rn = 1
)"""
_ITEMS = """
dim_items AS (
    SELECT md5(coalesce(CAST(item_id AS VARCHAR), '_dbt_utils_surrogate_key_null_')) AS item_key, item_id, item_type,
           title, text_content, url,
           split_part(split_part(replace(replace(replace(url, 'android-app://', ''), 'http://', ''), 'https://', ''),
                                 '/', 1), '?', 1) AS domain,
           url IS NOT NULL AS has_url, length(text_content) AS text_length
    FROM stg
)"""
_USERS = """
dim_users AS (
    SELECT md5(author) AS user_key, author AS user_name, min(created_at) AS first_post_at_ts,
           max(created_at) AS last_post_at_ts, count(*) AS total_posts_count,
           date_sub('day', min(created_at), max(created_at)) AS author_lifetime_days
    FROM stg WHERE author IS NOT NULL GROUP BY author
    UNION ALL
    SELECT 'unknown_user_key', 'unknown_user_name', NULL, NULL, 0, NULL
)"""
_FACTS = """
replies AS (
    SELECT parent_id, created_at FROM stg
    WHERE item_type = 'comment' AND parent_id IN (SELECT item_id FROM stg WHERE item_type = 'story')
),
first_reply AS (SELECT parent_id AS story_id, min(created_at) AS first_comment_at FROM replies GROUP BY parent_id),
n_replies AS (SELECT parent_id AS story_id, count(*) AS total_comments FROM replies GROUP BY parent_id),
fct AS (
    SELECT i.item_key, u.user_key, CAST(strftime(s.created_at, '%Y%m%d') AS BIGINT) AS created_date_key,
           s.created_at, s.score, n.total_comments,
           date_sub('minute', s.created_at, f.first_comment_at) AS time_to_first_comment_minutes
    FROM stg s
    LEFT JOIN dim_items i ON s.item_id = i.item_id
    LEFT JOIN dim_users u ON coalesce(s.author, 'unknown_user_name') = u.user_name
    LEFT JOIN first_reply f ON s.item_id = f.story_id
    LEFT JOIN n_replies n ON s.item_id = n.story_id
    WHERE s.item_type = 'story'
)"""
_VIEW = """
vw AS (
    SELECT f.item_key, i.item_id, i.title, i.url, coalesce(i.domain, 'N/A') AS story_domain, f.user_key, u.user_name,
           u.author_lifetime_days, u.total_posts_count, f.created_at, CAST(f.created_at AS DATE) AS created_at_date,
           f.score, f.total_comments, f.time_to_first_comment_minutes
    FROM fct f LEFT JOIN dim_items i ON f.item_key = i.item_key LEFT JOIN dim_users u ON f.user_key = u.user_key
)"""


def _with(*parts: str, then: str) -> str:
    return "WITH " + ",".join(parts) + "\n" + then.strip()


def _parsed(then: str) -> str:
    return _with(SILVER_SQL, _STAGED, then=then)


def _fact(then: str) -> str:
    return _with(SILVER_SQL, _STAGED, _ITEMS, _USERS, _FACTS, then=then)


def _view(then: str) -> str:
    return _with(SILVER_SQL, _STAGED, _ITEMS, _USERS, _FACTS, _VIEW, then=then)


def _event_states(then: str) -> str:
    return _with(EVENT_SILVER_SQL, _STAGED, then=then)


_STAGED_COLUMNS = (
    "item_id, parent_id, created_at, ingest_date_str, author, item_type, title, text_content, url, score, "
    "descendants, source_file, ingest_date"
)
_HISTORY_STATES = """
states AS (
    SELECT * EXCLUDE (rn) FROM (
        SELECT item_id, ingest_date, score, descendants, row_number() OVER (PARTITION BY item_id, ingest_date
            ORDER BY source_file DESC, created_at DESC, score DESC NULLS LAST, descendants DESC NULLS LAST) AS rn
        FROM dated
    ) WHERE rn = 1
)"""
_HISTORY = """
SELECT item_id, ingest_date, score, descendants,
       score - lag(score) OVER w AS score_change, descendants - lag(descendants) OVER w AS descendants_change,
       row_number() OVER w AS state_number
FROM states WINDOW w AS (PARTITION BY item_id ORDER BY ingest_date)
"""
_KPIS = """
SELECT count(DISTINCT item_id) AS total_stories, count(DISTINCT user_key) AS active_authors,
       round(avg(total_comments), 6) AS avg_comments_per_story,
       round(avg(time_to_first_comment_minutes), 6) AS avg_minutes_to_first_comment
FROM vw
"""
_ENGAGEMENT = """
count(*) AS stories, count(first_comment_at) AS commented_stories,
count(*) FILTER (first_comment_at <= s.created_at + INTERVAL 7 DAY) AS engaged_stories,
round(100.0 * CAST(count(*) FILTER (first_comment_at <= s.created_at + INTERVAL 7 DAY) AS DOUBLE) / count(*), 6)
    AS engaged_pct
FROM stg s LEFT JOIN (
    SELECT parent_id, min(created_at) AS first_comment_at FROM stg WHERE item_type = 'comment' GROUP BY parent_id
) c ON s.item_id = c.parent_id
WHERE s.item_type = 'story'
"""
_RATE = """
count(*) FILTER (item_type = 'comment') AS comments, count(*) FILTER (item_type = 'story') AS stories,
round(CAST(count(*) FILTER (item_type = 'comment') AS DOUBLE) / nullif(count(*) FILTER (item_type = 'story'), 0), 6)
    AS comments_per_story
FROM stg
"""
_COARSE = _with(
    EVENT_SILVER_SQL, _STAGED.replace("FROM silver", "FROM (SELECT * REPLACE (descendants // 50 AS score, descendants // 34 AS descendants) FROM silver)"),
    _HISTORY_STATES, """
runs AS (
    SELECT *, sum(changed) OVER (PARTITION BY item_id ORDER BY ingest_date) AS run FROM (
        SELECT *, CASE WHEN lag(ingest_date) OVER w IS NULL OR score IS DISTINCT FROM lag(score) OVER w
                       OR descendants IS DISTINCT FROM lag(descendants) OVER w THEN 1 ELSE 0 END AS changed
        FROM states WINDOW w AS (PARTITION BY item_id ORDER BY ingest_date))
),
intervals AS (
    SELECT item_id, score, descendants, min(ingest_date) AS first_day, max(ingest_date) AS last_day, count(*) AS n_days,
           lead(min(ingest_date)) OVER (PARTITION BY item_id ORDER BY run) AS next_day
    FROM runs GROUP BY item_id, run, score, descendants
)""", then="")
_RELEASE = """
SELECT 'stg_items' AS model, count(*) AS n_rows, CAST(sum(score) AS BIGINT) AS total FROM stg
UNION ALL SELECT 'dim_items', count(*), CAST(sum(text_length) AS BIGINT) FROM dim_items
UNION ALL SELECT 'dim_users', count(*), CAST(sum(total_posts_count) AS BIGINT) FROM dim_users
UNION ALL SELECT 'fct_stories', count(*), CAST(sum(created_date_key + coalesce(total_comments, 0)) AS BIGINT) FROM fct
UNION ALL SELECT 'daily_story_metrics', count(*), CAST(sum(n * median) AS BIGINT)
    FROM (SELECT count(*) AS n, quantile_disc(score, 0.5) AS median FROM fct GROUP BY CAST(created_at AS DATE))
UNION ALL SELECT 'daily_active_authors', count(*), CAST(sum(n) AS BIGINT)
    FROM (SELECT count(DISTINCT user_key) AS n FROM fct GROUP BY CAST(created_at AS DATE))
UNION ALL SELECT 'story_analytics', count(*), CAST(sum(length(story_domain) + score) AS BIGINT) FROM vw"""
_PART = _STAGED.replace("FROM silver", "FROM silver WHERE source_file <> 'documents'")
_DAY = "strftime(ts, '%Y-%m-%d')"
_TOTALS = f"""
totals AS (
    SELECT {_DAY} AS ingest_date, count(*) AS file_count, CAST(sum(CAST(round(value * 100) AS BIGINT)) AS BIGINT) AS total_bytes
    FROM events GROUP BY 1
)"""
_EVENT_ROW = f"""event_id AS item_id, 'user' || user_id AS author, date_trunc('second', ts) AS created_at,
       CAST(json_extract_string(props, '$.k') AS BIGINT) AS score, {_DAY} AS ingest_date"""


def _threads(items: str) -> str:
    return f"""
WITH RECURSIVE items AS ({items}),
tree AS (
    SELECT item_id AS root_id, item_id, CAST(0 AS BIGINT) AS depth FROM items WHERE item_type = 'story'
    UNION ALL
    SELECT t.root_id, i.item_id, t.depth + 1 FROM tree t JOIN items i ON i.parent_id = t.item_id
)
SELECT * FROM tree"""


def _failures(model: str, column: str, check: str, sql: str) -> str:
    return f"""SELECT '{model}' AS model, '{column}' AS "column", '{check}' AS "check", ({sql}) AS failures"""


def _not_null(model: str, table: str, column: str) -> str:
    return _failures(model, column, "not_null", f"SELECT count(*) FROM {table} WHERE {column} IS NULL")


def _unique(model: str, table: str, column: str) -> str:
    inner = f"SELECT {column} FROM {table} WHERE {column} IS NOT NULL GROUP BY 1 HAVING count(*) > 1"
    return _failures(model, column, "unique", f"SELECT count(*) FROM ({inner})")


def _in(model: str, table: str, column: str, parent: str, parent_column: str) -> str:
    values = f"SELECT count(DISTINCT {column}) FROM {table}"
    return _failures(
        model, column, "relationships", f"{values} WHERE {column} NOT IN (SELECT {parent_column} FROM {parent})"
    )


def _accepted(model: str, table: str, column: str, values: str) -> str:
    return _failures(
        model, column, "accepted_values", f"SELECT count(*) FROM {table} WHERE {column} NOT IN ({values})"
    )


_CALENDAR = """(SELECT CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key FROM (
    SELECT unnest(generate_series(TIMESTAMP '2006-01-01', TIMESTAMP '2026-12-30', INTERVAL 1 DAY)) AS d))"""
_STORY_DAYS = "(SELECT DISTINCT CAST(created_at AS DATE) AS story_date FROM fct)"
def _scoped(check, column: str, where: str, *of: str) -> str:
    sql = check("parsed_items", f"(SELECT * FROM dated WHERE {where})", column, *of)
    name = {_unique: "unique", _not_null: "not_null", _in: "relationships"}[check]
    return sql.replace(f"'{name}'", "'" + f"{name} where {where}".replace("'", "''") + "'", 1)


_REPORT = "\nUNION ALL\n".join(
    [
        _not_null("stg_items", "stg", "item_id"), _unique("stg_items", "stg", "item_id"),
        _not_null("stg_items", "stg", "created_at"),
        _accepted("stg_items", "stg", "item_type", "'story', 'comment', 'job', 'poll', 'pollopt'"),
        _not_null("dim_users", "dim_users", "user_key"), _unique("dim_users", "dim_users", "user_key"),
        _not_null("dim_users", "dim_users", "user_name"), _unique("dim_users", "dim_users", "user_name"),
        _not_null("dim_items", "dim_items", "item_key"), _unique("dim_items", "dim_items", "item_key"),
        _not_null("dim_items", "dim_items", "item_id"), _unique("dim_items", "dim_items", "item_id"),
        _not_null("fct_stories", "fct", "item_key"), _unique("fct_stories", "fct", "item_key"),
        _in("fct_stories", "fct", "item_key", "dim_items", "item_key"),
        _not_null("fct_stories", "fct", "user_key"), _in("fct_stories", "fct", "user_key", "dim_users", "user_key"),
        _not_null("fct_stories", "fct", "created_date_key"), _not_null("fct_stories", "fct", "created_at"),
        _in("fct_stories", "fct", "created_date_key", _CALENDAR, "date_key"),
        _not_null("daily_story_metrics", _STORY_DAYS, "story_date"),
        _not_null("daily_active_authors", _STORY_DAYS, "story_date"),
        _not_null("story_analytics", "vw", "item_key"), _unique("story_analytics", "vw", "item_key"),
        _not_null("story_analytics", "vw", "item_id"), _unique("story_analytics", "vw", "item_id"),
        _not_null("parsed_items", "dated", "item_id"), _unique("parsed_items", "dated", "item_id"),
        _not_null("parsed_items", "dated", "author"),
        _in("parsed_items", "dated", "author", "dim_users", "user_name"),
        _accepted("parsed_items", "dated", "item_type", "'story'"),
        _scoped(_unique, "item_id", "ingest_date = '1996-03-13'"),
        _scoped(_not_null, "author", "item_type = 'job'"),
        _scoped(_in, "author", "item_type = 'comment'", "(SELECT CAST(item_id AS VARCHAR) AS item_id FROM dim_items)", "item_id"),
    ]
)

_EVENT_TREE = """
        SELECT event_id AS item_id, CASE WHEN event_id - 1 - k >= 0 THEN event_id - 1 - k END AS parent_id,
               CASE WHEN event_id - 1 - k >= 0 THEN 'comment' WHEN k > 60 THEN 'poll' ELSE 'story' END AS item_type
        FROM (SELECT event_id, CAST(json_extract_string(props, '$.k') AS BIGINT) AS k FROM events)"""

ORACLE: dict[str, str] = {
    "staged_items": _parsed(f"SELECT {_STAGED_COLUMNS} FROM stg"),
    "staged_event_states": _event_states(f"SELECT {_STAGED_COLUMNS} FROM stg"),
    "latest_event_per_user": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (
            PARTITION BY user_id, event_type ORDER BY ts DESC, event_id DESC) AS rn FROM events) WHERE rn = 1""",
    "latest_lineitem": """
        SELECT * EXCLUDE (rn) FROM (SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber
            ORDER BY l_shipdate DESC, l_partkey DESC, l_suppkey DESC, l_quantity DESC, l_extendedprice DESC,
            l_discount DESC, l_tax DESC, l_returnflag DESC, l_linestatus DESC) AS rn FROM lineitem) WHERE rn = 1""",
    "item_history": _with(SILVER_SQL, _STAGED, _HISTORY_STATES, then=_HISTORY),
    "event_state_history": _with(EVENT_SILVER_SQL, _STAGED, _HISTORY_STATES, then=_HISTORY),
    "item_state_intervals": _COARSE + "SELECT * FROM intervals",
    "intervals_by_delivery": _COARSE + "SELECT * FROM intervals",
    "states_as_of": _COARSE + """
        SELECT * FROM intervals WHERE first_day <= '2024-01-15' AND (next_day IS NULL OR next_day > '2024-01-15')""",
    "events_with_state_before": _COARSE + """
        SELECT e.source_file, e.item_id, e.asked_day, i.score, i.descendants, i.first_day
        FROM (SELECT source_file, item_id, strftime(CAST(ingest_date AS DATE) - 3, '%Y-%m-%d') AS asked_day FROM dated) e
        LEFT JOIN intervals i ON e.item_id = i.item_id AND i.first_day <= e.asked_day
            AND (i.next_day IS NULL OR i.next_day > e.asked_day)""",
    "comments_on_stories": _parsed("""
        , typed AS MATERIALIZED (SELECT item_id, item_type, parent_id, author, created_at, score FROM stg),
        stories AS MATERIALIZED (SELECT DISTINCT item_id AS story_id FROM typed WHERE item_type = 'story')
        SELECT c.item_id, c.parent_id, c.author, c.created_at, c.score
        FROM typed c JOIN stories s ON c.parent_id = s.story_id WHERE c.item_type = 'comment'"""),
    "dim_items": _with(SILVER_SQL, _STAGED, _ITEMS, then="SELECT * FROM dim_items"),
    "dim_users": _with(SILVER_SQL, _STAGED, _USERS, then="SELECT * FROM dim_users"),
    "dim_dates": _with(SILVER_SQL, then="""
        SELECT CAST(d AS DATE) AS date_day, CAST(strftime(d, '%Y%m%d') AS BIGINT) AS date_key
        FROM (SELECT unnest(generate_series(date_trunc('day', min(created_at)), date_trunc('day', max(created_at)),
                                            INTERVAL 1 DAY)) AS d FROM silver)"""),
    "fct_stories": _fact("SELECT * FROM fct"),
    "fct_stories_joined": _fact("SELECT * FROM fct"),
    "daily_story_metrics": _fact("""
        SELECT CAST(created_at AS DATE) AS story_date, count(item_key) AS stories_per_day,
               round(avg(total_comments), 6) AS avg_comments_per_story, quantile_disc(score, 0.5) AS median_story_score
        FROM fct GROUP BY 1"""),
    "daily_active_authors": _fact("""
        SELECT CAST(created_at AS DATE) AS story_date, count(DISTINCT user_key) AS active_authors_per_day
        FROM fct GROUP BY 1"""),
    "daily_median_score": _fact("""
        SELECT CAST(created_at AS DATE) AS story_date, quantile_disc(score, 0.5) AS median_story_score
        FROM fct GROUP BY 1"""),
    "story_analytics": _view("SELECT * FROM vw"),
    "kpi_tiles": _view(_KPIS),
    "kpi_tiles_1997": _view(_KPIS + " WHERE created_at_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"),
    "kpi_tiles_from_days": _view("""
        SELECT r.name AS range, count(DISTINCT item_id) AS total_stories, count(DISTINCT user_key) AS active_authors,
               TRUE AS stories_within, TRUE AS authors_within, round(avg(total_comments), 6) AS avg_comments_per_story,
               round(avg(time_to_first_comment_minutes), 6) AS avg_minutes_to_first_comment
        FROM vw JOIN (VALUES ('all', FALSE), ('1997', TRUE)) AS r(name, one_year)
            ON NOT r.one_year OR created_at_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
        GROUP BY r.name"""),
    "authors_of_two_years": _view("""
        , per_author AS (
            SELECT user_key, bool_or(year(created_at_date) = 1996) AS a, bool_or(year(created_at_date) = 1997) AS b
            FROM vw GROUP BY 1
        )
        SELECT count(*) FILTER (a) AS first_authors, count(*) FILTER (b) AS second_authors,
               count(*) FILTER (a AND b) AS both_authors, count(*) FILTER (a AND NOT b) AS first_only_authors,
               TRUE AS within
        FROM per_author"""),
    "quantiles_from_days": _view("""
        SELECT 'score' AS value, count(score) AS n, TRUE AS median_within, TRUE AS p90_within
        FROM vw WHERE created_at_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'
        UNION ALL
        SELECT 'time_to_first_comment_minutes', count(time_to_first_comment_minutes), TRUE, TRUE
        FROM vw WHERE created_at_date BETWEEN DATE '1997-01-01' AND DATE '1997-12-31'"""),
    "activity_trend": _view("""
        SELECT created_at_date, count(DISTINCT item_id) AS stories, count(DISTINCT user_key) AS authors
        FROM vw GROUP BY 1"""),
    "top_domains": _view("""
        SELECT story_domain, count(item_id) AS stories FROM vw GROUP BY 1 ORDER BY stories DESC, story_domain LIMIT 10"""),
    "top_stories": _view("""
        SELECT title, user_name, CAST(sum(score) AS BIGINT) AS score, CAST(sum(total_comments) AS BIGINT) AS total_comments
        FROM vw GROUP BY 1, 2 ORDER BY score DESC NULLS LAST, title, user_name LIMIT 10"""),
    "top_authors": _view("""
        SELECT user_name, author_lifetime_days, total_posts_count, CAST(sum(score) AS BIGINT) AS score
        FROM vw GROUP BY 1, 2, 3 ORDER BY score DESC NULLS LAST, user_name LIMIT 10"""),
    "drill_down": _parsed("""
        SELECT item_id, author, created_at, score FROM stg
        WHERE CAST(created_at AS DATE) = DATE '1997-01-03' AND item_type = 'story' AND author = 'src1'"""),
    "drill_down_laid_out": _parsed("""
        SELECT item_id, author, created_at, score FROM stg
        WHERE CAST(created_at AS DATE) = DATE '1997-01-03' AND item_type = 'story' AND author = 'src1'"""),
    "author_scores": _fact("""
        SELECT user_key, CAST(sum(score) AS BIGINT) AS total_score, count(*) AS stories,
               rank() OVER (ORDER BY sum(score) DESC NULLS LAST) AS rank
        FROM fct GROUP BY 1"""),
    "story_with_author_score": _fact("""
        SELECT item_key, user_key, score, CAST(sum(score) OVER (PARTITION BY user_key) AS BIGINT) AS author_score FROM fct"""),
    "author_lifetimes": _with(SILVER_SQL, _STAGED, _USERS, then="""
        SELECT user_name, first_post_at_ts, last_post_at_ts, author_lifetime_days, total_posts_count
        FROM dim_users WHERE user_key <> 'unknown_user_key'"""),
    "minutes_to_first_comment": _fact("""
        SELECT round(avg(time_to_first_comment_minutes), 6) AS avg_minutes,
               count(time_to_first_comment_minutes) AS stories FROM fct"""),
    "first_comment_distribution": _fact("""
        SELECT quantile_disc(time_to_first_comment_minutes, 0.5) AS median_minutes,
               quantile_disc(time_to_first_comment_minutes, 0.9) AS p90_minutes,
               quantile_disc(time_to_first_comment_minutes, 0.99) AS p99_minutes FROM fct"""),
    "engagement_7d": _parsed(f"SELECT {_ENGAGEMENT}"),
    "comments_by_hour": _parsed("""
        SELECT s.item_id AS story_id, date_sub('hour', s.created_at, c.created_at) AS age, count(*) AS comments
        FROM stg s JOIN stg c ON c.parent_id = s.item_id AND c.item_type = 'comment'
        WHERE s.item_type = 'story' AND c.created_at BETWEEN s.created_at AND s.created_at + INTERVAL 7 DAY
        GROUP BY 1, 2"""),
    "engagement_funnel": _parsed(f"""
        SELECT CAST(date_trunc('month', s.created_at) AS DATE) AS period, {_ENGAGEMENT} GROUP BY 1"""),
    "comment_rate": _parsed(f"SELECT {_RATE}"),
    "comment_rate_per_day": _parsed(f"SELECT CAST(created_at AS DATE) AS period, {_RATE} GROUP BY 1"),
    "peak_hours": _parsed("SELECT hour(created_at) AS hour, item_type, count(*) AS items FROM stg GROUP BY 1, 2"),
    "comment_velocity": _parsed("""
        SELECT item_id, score, total_comments, hours, round(CAST(total_comments AS DOUBLE) / hours, 6) AS comments_per_hour
        FROM (SELECT s.item_id, s.score, c.total_comments,
                     greatest(date_sub('hour', s.created_at, (SELECT max(created_at) FROM stg)), 1) AS hours
              FROM stg s JOIN (SELECT parent_id, count(*) AS total_comments FROM stg WHERE item_type = 'comment'
                               GROUP BY 1) c ON s.item_id = c.parent_id
              WHERE s.item_type = 'story')
        ORDER BY CAST(total_comments AS DOUBLE) / hours DESC, score DESC, item_id LIMIT 10"""),
    "lifetime_curve": _parsed("""
        SELECT age, comments, CAST(sum(comments) OVER (ORDER BY age) AS BIGINT) AS comments_so_far
        FROM (SELECT date_sub('day', s.created_at, c.created_at) AS age, count(*) AS comments
              FROM stg c JOIN stg s ON c.parent_id = s.item_id
              WHERE c.item_type = 'comment' AND s.item_type = 'story' GROUP BY 1)"""),
    "author_cohorts": _parsed("""
        SELECT cohort_month, active_month, count(DISTINCT author) AS authors, count(*) AS posts
        FROM (SELECT author, CAST(date_trunc('month', created_at) AS DATE) AS active_month,
                     CAST(date_trunc('month', min(created_at) OVER (PARTITION BY author)) AS DATE) AS cohort_month
              FROM stg WHERE author IS NOT NULL) GROUP BY 1, 2"""),
    "author_features": _parsed("""
        SELECT author, count(*) AS posts, count(*) FILTER (item_type = 'story') AS stories,
               count(*) FILTER (item_type = 'comment') AS comments,
               CAST(sum(score) FILTER (item_type = 'story') AS BIGINT) AS story_score,
               max(score) FILTER (item_type = 'story') AS best_score,
               CAST(coalesce(sum(n), 0) AS BIGINT) AS replies_received,
               min(created_at) AS first_post_at, max(created_at) AS last_post_at
        FROM stg LEFT JOIN (SELECT parent_id AS replied_id, count(*) AS n FROM stg WHERE item_type = 'comment' GROUP BY 1)
             ON item_id = replied_id
        WHERE author IS NOT NULL GROUP BY 1"""),
    "dq_not_null": _parsed("SELECT item_id, item_type, created_at FROM stg WHERE author IS NULL"),
    "dq_unique": _with(SILVER_SQL, then="""
        SELECT item_id AS value, count(*) AS n_rows FROM silver WHERE item_id IS NOT NULL GROUP BY 1 HAVING count(*) > 1"""),
    "dq_unique_one_day": _event_states("""
        SELECT item_id AS value, count(*) AS n_rows FROM dated
        WHERE ingest_date = '2024-01-05' GROUP BY 1 HAVING count(*) > 1"""),
    "dq_accepted_values": _parsed("""
        SELECT item_type AS value, count(*) AS n_rows FROM stg WHERE item_type NOT IN ('story', 'comment') GROUP BY 1"""),
    "dq_relationships": _parsed("""
        SELECT parent_id AS value, count(*) AS n_rows FROM stg
        WHERE parent_id IS NOT NULL AND parent_id NOT IN (SELECT item_id FROM stg WHERE item_type = 'story') GROUP BY 1"""),
    "dq_report": _view(_REPORT),
    "dq_missing_rates": _parsed("""
        SELECT ingest_date, count(*) AS n_rows,
               round(avg(CAST(item_id IS NULL AS INT)), 6) AS item_id_missing_rate,
               round(avg(CAST(created_at IS NULL AS INT)), 6) AS created_at_missing_rate,
               round(avg(CAST(author IS NULL AS INT)), 6) AS author_missing_rate
        FROM dated GROUP BY 1"""),
    "dq_missing_days": _with(SILVER_SQL, then="""
        SELECT CAST(d AS DATE) AS date_day
        FROM (SELECT unnest(generate_series(date_trunc('day', min(created_at)), date_trunc('day', max(created_at)),
                                            INTERVAL 1 DAY)) AS d FROM silver)
        WHERE CAST(d AS DATE) NOT IN (SELECT CAST(created_at AS DATE) FROM silver WHERE item_type = 'job')"""),
    "dq_latency": f"""
        SELECT {_DAY} AS ingest_date, max(ts) AS last_written_at,
               date_sub('second', max(ts), (SELECT max(ts) FROM events)) AS latency_seconds
        FROM events GROUP BY 1""",
    "dq_volumes": _parsed("""
        SELECT ingest_date, count(*) AS n_rows, count(DISTINCT source_file) AS n_files,
               count(*) FILTER (item_id IS NULL) AS n_without_id
        FROM dated GROUP BY 1"""),
    "id_chunks": """
        WITH bounds AS (SELECT count(*) FILTER (o_orderstatus = 'F') + 1 AS lo, max(o_orderkey) AS hi FROM orders),
        ids AS (SELECT unnest(generate_series(lo, hi)) AS id, lo FROM bounds)
        SELECT (id - lo) // 1000 AS chunk, min(id) AS start_id, max(id) AS end_id FROM ids GROUP BY 1""",
    "run_ids_with_landed_lines": """
        SELECT id AS item_id, event_id IS NOT NULL AS landed, '[' || event_type || '] § {x}' AS title
        FROM (SELECT unnest(generate_series(0, max(o_orderkey))) AS id FROM orders) LEFT JOIN events ON id = event_id""",
    "missing_ids": """
        SELECT id AS doc_id FROM (SELECT unnest(generate_series(0, max(doc_id))) AS id FROM documents)
        WHERE id NOT IN (SELECT doc_id FROM labels)""",
    "parse_lines": f"""
        SELECT event_id AS item_id, 'story' AS item_type, 'user' || user_id AS author,
               date_trunc('second', ts) AS created_at, '[' || event_type || '] § {{x}}' AS title,
               CAST(NULL AS VARCHAR) AS text_content, CAST(NULL AS VARCHAR) AS url, CAST(NULL AS BIGINT) AS parent_id,
               CAST(json_extract_string(props, '$.k') AS BIGINT) AS score, CAST(floor(value) AS BIGINT) AS descendants,
               {_DAY} AS ingest_date_str, 'events' AS source_file, {_DAY} AS ingest_date
        FROM events
        UNION ALL
        SELECT NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, NULL, '1997-01-01', 'documents-' || doc_id,
               '1997-01-01'
        FROM documents""",
    "landing_roundtrip": f"SELECT {_EVENT_ROW} FROM events",
    "landed_manifest": f"""
        SELECT {_DAY} AS ingest_date, count(*) AS item_count, min(event_id) AS start_id, max(event_id) AS end_id
        FROM events GROUP BY 1""",
    "landed_days": f"SELECT DISTINCT {_DAY} AS ingest_date FROM events",
    "changed_days": f"""
        WITH files AS (
            SELECT {_DAY} AS ingest_date, event_id AS n, CAST(event_id AS VARCHAR) AS path,
                   CAST(round(value * 100) AS BIGINT) AS length
            FROM events),
        known AS (
            SELECT ingest_date, path,
                   length + CASE WHEN ingest_date < '2024-01-06' AND n % 7 = 1 THEN 5000 ELSE 0 END AS old_length
            FROM files WHERE ingest_date < '2024-01-26' AND NOT (ingest_date < '2024-01-06' AND n % 7 = 0)
            UNION ALL
            SELECT ingest_date, 'gone-' || path, length FROM files
            WHERE ingest_date >= '2024-01-16' AND ingest_date < '2024-01-26' AND n % 5 = 0),
        counts AS (
            SELECT ingest_date, count(old_length) AS known_files, count(*) FILTER (old_length IS NULL) AS new_files,
                   count(*) FILTER (length <> old_length) AS changed_files, count(*) FILTER (length IS NULL) AS lost_files
            FROM files FULL JOIN known USING (ingest_date, path) GROUP BY 1)
        SELECT *, CASE WHEN known_files = 0 THEN 'new' WHEN new_files + changed_files > 0 THEN 'changed'
                       WHEN lost_files > 0 THEN 'shrunk' ELSE 'unchanged' END AS status FROM counts""",
    "landed_backlog": """
        WITH n AS (SELECT 2 * count(*) AS newest FROM lineitem),
        ids AS (SELECT unnest(generate_series(1, newest)) AS id, newest FROM n)
        SELECT id // 1000 AS thousand, count(*) AS n_lines, count(*) AS n_ids, max(newest) AS mark FROM ids GROUP BY 1""",
    "high_water_mark": "SELECT max(o_orderkey) AS last_id FROM orders",
    "landed_without_empty": f"""
        SELECT {_DAY} AS ingest_date, count(*) AS n_lines FROM events WHERE event_id % 10 >= 5 GROUP BY 1""",
    "built_models": _view("""
        SELECT 'stg_items' AS model, count(*) AS n_rows FROM stg
        UNION ALL SELECT 'dim_items', count(*) FROM dim_items
        UNION ALL SELECT 'dim_users', count(*) FROM dim_users
        UNION ALL SELECT 'fct_stories', count(*) FROM fct
        UNION ALL SELECT 'daily_story_metrics', count(DISTINCT CAST(created_at AS DATE)) FROM fct
        UNION ALL SELECT 'daily_active_authors', count(DISTINCT CAST(created_at AS DATE)) FROM fct
        UNION ALL SELECT 'story_analytics', count(*) FROM vw"""),
    "published_models": f"""
        SELECT step, model, n_rows, total FROM (VALUES ('second build'), ('third build died')) a(step), ({_view(_RELEASE)})
        UNION ALL
        SELECT step, model, n_rows, total FROM (VALUES ('first build'), ('went back')) b(step),
            ({_with(SILVER_SQL, _PART, _ITEMS, _USERS, _FACTS, _VIEW, then=_RELEASE)})""",
    "replaced_days": f"""
        SELECT {_DAY} AS ingest_date, count(*) AS n_rows,
               CAST(sum(floor(value) + CASE WHEN ts >= '2024-01-10' AND ts < '2024-01-20' THEN 1000 ELSE 0 END) AS BIGINT)
                   AS score
        FROM events GROUP BY 1""",
    "raw_to_daily_metrics": """
        SELECT CAST(ts AS DATE) AS story_date, count(*) AS stories_per_day,
               CAST(NULL AS DOUBLE) AS avg_comments_per_story,
               quantile_disc(CAST(json_extract_string(props, '$.k') AS BIGINT), 0.5) AS median_story_score
        FROM events GROUP BY 1""",
    "incremental_marts": _with(DISCUSSION_SILVER_SQL, _STAGED, _ITEMS, _USERS, _FACTS, then="""
        SELECT CAST(created_at AS DATE) AS story_date, count(item_key) AS stories_per_day,
               round(avg(total_comments), 6) AS avg_comments_per_story,
               quantile_disc(score, 0.5) AS median_story_score, count(DISTINCT user_key) AS active_authors_per_day
        FROM fct GROUP BY 1"""),
    "day_state": _with(_TOTALS, then="""
        SELECT ingest_date, file_count + CASE WHEN ingest_date >= '2024-01-16' THEN 1 ELSE 0 END AS file_count, total_bytes,
               CAST(CASE WHEN ingest_date >= '2024-01-16' THEN 2 ELSE 1 END AS BIGINT) AS run_id
        FROM totals"""),
    "conversation_threads": _threads("""
        SELECT DISTINCT conv_id * 1000 + turn AS item_id,
               CASE WHEN turn > 0 THEN conv_id * 1000 + turn - 1 END AS parent_id,
               CASE WHEN turn = 0 THEN 'story' ELSE 'comment' END AS item_type
        FROM conversations"""),
    "event_threads": _threads(_EVENT_TREE),
    "threads_by_delivery": _threads(_EVENT_TREE),
    "stream_landed_to_silver": f"SELECT {_EVENT_ROW} FROM events",
    "stream_unique_deliveries": _with(EVENT_SILVER_SQL, then="SELECT item_id, created_at, score, source_file FROM silver"),
    "stream_late_days": f"""
        SELECT {_DAY} AS ingest_date, count(*) AS n_rows,
               CAST(sum(CAST(json_extract_string(props, '$.k') AS BIGINT)) AS BIGINT) AS score
        FROM events GROUP BY 1""",
    "stream_current_items": _event_states("SELECT item_id, author, created_at, score, ingest_date FROM stg"),
    "stream_daily_metrics": _fact("""
        SELECT CAST(created_at AS DATE) AS story_date, count(*) AS stories_per_day,
               round(avg(total_comments), 6) AS avg_comments_per_story, count(DISTINCT user_key) AS active_authors
        FROM fct GROUP BY 1"""),
}
