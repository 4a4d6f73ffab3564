"""Plain SQL for the queries in ``workloads``, to compare their results with."""

from __future__ import annotations

_SONGS = """songs AS (
  SELECT concat(CASE WHEN p_size <= 5 THEN 'unplayed-' ELSE '' END, CAST(p_partkey AS STRING)) AS track_id,
         p_type AS track_genre,
         CAST(ROUND(p_retailprice * 100) AS BIGINT) AS duration_ms, p_name AS track_name, p_brand AS artists
  FROM part)"""

_EVENT_PLAYS = """streams AS (
  SELECT event_id, user_id, regexp_extract(props, '([0-9]+)', 1) AS track_id, ts AS listen_time FROM events)"""

_ORDER_PLAYS = """streams AS (
  SELECT l_orderkey AS event_id, o_custkey AS user_id, CAST(l_partkey AS STRING) AS track_id,
         l_shipdate AS listen_time
  FROM lineitem JOIN orders ON l_orderkey = o_orderkey)"""

_ENRICHED = """enriched AS (
  SELECT s.event_id, s.user_id, s.track_id, s.listen_time, g.track_genre, g.duration_ms, g.track_name, g.artists,
         CAST(s.listen_time AS DATE) AS date
  FROM streams s JOIN songs g ON s.track_id = g.track_id
  WHERE s.listen_time IS NOT NULL AND g.track_genre IS NOT NULL AND g.duration_ms IS NOT NULL)"""


def _kpis(name: str, source: str, genre: str = "track_genre") -> str:
    return f"""{name} AS (
  SELECT {genre} AS genre, date, COUNT(*) AS listen_count, COUNT(DISTINCT user_id) AS unique_listeners,
         CAST(SUM(duration_ms) AS BIGINT) AS total_listening_time_ms,
         CAST(FLOOR(SUM(duration_ms) / NULLIF(COUNT(DISTINCT user_id), 0)) AS BIGINT)
           AS avg_listening_time_per_user_ms
  FROM {source} GROUP BY {genre}, date)"""


def _genre_ranks(name: str, source: str, order: str = "listen_count DESC, genre DESC") -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT date, CAST(RANK() OVER (PARTITION BY date ORDER BY {order}) AS INT) AS rank,
      genre, listen_count FROM {source}) t WHERE rank <= 5)"""


def _song_ranks(name: str, order: str, columns: str) -> str:
    return f"""{name} AS (
  SELECT * FROM (SELECT concat_ws('#', track_genre, CAST(date AS STRING)) AS genre_date,
      CAST(RANK() OVER (PARTITION BY track_genre, date ORDER BY {order}) AS INT) AS rank,
      {columns} FROM plays) t WHERE rank <= 3)"""


_RESULTS = ",\n".join(
    [
        _ENRICHED,
        _kpis("kpis", "enriched"),
        """plays AS (
  SELECT track_genre, date, track_id, track_name, artists, COUNT(*) AS play_count
  FROM enriched GROUP BY track_genre, date, track_id, track_name, artists)""",
        _song_ranks(
            "top_songs",
            "play_count DESC, track_id DESC",
            "track_id, track_name, artists, play_count",
        ),
        _song_ranks("tied_songs", "play_count DESC", "track_name, artists, play_count"),
        _genre_ranks("top_genres", "kpis"),
        _genre_ranks("tied_genres", "kpis", "listen_count DESC"),
    ]
)

_EVENTS = f"WITH {_EVENT_PLAYS},\n{_SONGS},\n{_RESULTS}"
_ORDERS = f"WITH {_ORDER_PLAYS},\n{_SONGS},\n{_RESULTS}"


_DAY_FILES = """files AS (
  SELECT event_id, concat('raw/streams/', CAST(CAST(ts AS DATE) AS STRING), '.csv') AS source_key,
    CASE WHEN event_id % 10 = 0 AND user_id < 75
              AND CAST(ts AS DATE) NOT IN (DATE '2024-01-07', DATE '2024-01-09', DATE '2024-01-11')
         THEN NULL ELSE user_id END AS user_id,
    CASE WHEN CAST(ts AS DATE) = DATE '2024-01-07' THEN '5'
         WHEN CAST(ts AS DATE) = DATE '2024-01-11' AND event_id % 3 = 0 THEN NULL
         ELSE regexp_extract(props, '([0-9]+)', 1) END AS track_id,
    CASE WHEN CAST(ts AS DATE) = DATE '2024-01-09' AND event_id % 50 = 0 THEN 'not-a-time'
         ELSE CAST(ts AS STRING) END AS listen_time
  FROM events)"""

_YEAR_FILES = """files AS (
  SELECT o_orderkey AS event_id, concat('raw/streams/', CAST(year(o_orderdate) AS STRING), '.csv') AS source_key,
    o_custkey AS user_id, CAST(o_orderkey % 97 AS STRING) AS track_id,
    CASE WHEN o_orderkey % 50 = 0 AND (year(o_orderdate) = 1996 OR (year(o_orderdate) = 1995
              AND o_orderkey > (SELECT MAX(o_orderkey) // 2 FROM orders))) THEN 'not-a-time'
         ELSE CAST(o_orderdate AS STRING) END AS listen_time
  FROM orders)"""


def _checked_files(sample_rows: int | None, files: str = _DAY_FILES) -> str:
    in_sample = "TRUE" if sample_rows is None else f"nn <= {sample_rows}"
    return f"""{files},
sampled AS (
  SELECT *, SUM(CASE WHEN listen_time IS NULL THEN 0 ELSE 1 END)
              OVER (PARTITION BY source_key ORDER BY event_id) AS nn FROM files),
prof AS (
  SELECT source_key, COUNT(*) AS row_count,
    CAST(COUNT(*) - COUNT(user_id) AS DOUBLE) / COUNT(*) AS user_id_null_rate,
    CAST(COUNT(*) - COUNT(track_id) AS DOUBLE) / COUNT(*) AS track_id_null_rate,
    COUNT(listen_time) AS listen_time_non_null,
    COUNT(CASE WHEN {in_sample} AND listen_time IS NOT NULL AND TRY_CAST(listen_time AS TIMESTAMP) IS NULL
               THEN 1 END) AS listen_time_bad,
    COUNT(DISTINCT track_id) AS track_id_distinct, MIN(track_id) AS track_id_any
  FROM sampled GROUP BY source_key),
verdict AS (
  SELECT source_key, CASE
    WHEN row_count < 1 THEN printf('File contains %d rows — must have at least 1', row_count)
    WHEN user_id_null_rate > 0.05
      THEN printf('Column ''user_id'' has %.1f%% null values (threshold 5%%)', user_id_null_rate * 100)
    WHEN track_id_null_rate > 0.05
      THEN printf('Column ''track_id'' has %.1f%% null values (threshold 5%%)', track_id_null_rate * 100)
    WHEN listen_time_non_null = 0 THEN 'Column ''listen_time'' has no non-null values to parse'
    WHEN listen_time_bad > 0 THEN 'Column ''listen_time'' is not parseable as timestamps'
    WHEN track_id_distinct = 1
      THEN concat('Column ''track_id'' contains only a single distinct value (''', track_id_any,
                  ''') — likely corrupt file')
    ELSE '' END AS reason FROM prof)"""


_FILES = f"WITH {_checked_files(None)}"
_PASSED_PLAYS = """streams AS (
  SELECT f.event_id, f.user_id, f.track_id, TRY_CAST(f.listen_time AS TIMESTAMP) AS listen_time
  FROM files f JOIN verdict v ON f.source_key = v.source_key WHERE v.reason = '')"""
_PASSED = f"{_FILES},\n{_PASSED_PLAYS},\n{_SONGS},\n{_RESULTS}"
_VERDICTS = """SELECT source_key, CASE WHEN reason = '' THEN 'PASSED' ELSE 'FAILED' END AS status, reason
FROM verdict"""

_FIRST_EXPORT = "listen_time < TIMESTAMP '2024-01-20 12:00:00'"
_SECOND_EXPORT = "listen_time >= TIMESTAMP '2024-01-15 06:00:00'"
_TWO_EXPORTS = ",\n".join(
    [
        _EVENTS,
        f"first_plays AS (SELECT * FROM enriched WHERE {_FIRST_EXPORT})",
        f"second_plays AS (SELECT * FROM enriched WHERE {_SECOND_EXPORT})",
        f"""fewer_plays AS (
  SELECT * FROM second_plays WHERE track_genre NOT IN ('ECONOMY', 'LARGE', 'SMALL'))""",
        _kpis("first_kpis", "first_plays"),
        _kpis("second_kpis", "second_plays"),
        _kpis("fewer_kpis", "fewer_plays"),
        _genre_ranks("first_ranks", "first_kpis"),
        _genre_ranks("fewer_ranks", "fewer_kpis"),
    ]
)

_NULL_USERS = "WITH e AS (" + (
    "SELECT event_type AS track_genre, CAST(ts AS DATE) AS date,"
    " CASE WHEN event_type = 'view' OR event_id % 20 = 0 THEN NULL ELSE user_id END AS user_id,"
    " CAST(ROUND(value * 1000) AS BIGINT) AS duration_ms FROM events),\n"
) + _kpis("kpis", "e")

_FOUR_KPI_COLUMNS = "SELECT genre, date, listen_count, unique_listeners FROM kpis"

ORACLE_SQL: dict[str, str] = {
    "enrich_streams": f"{_EVENTS}\nSELECT * FROM enriched",
    "daily_genre_kpis": f"{_EVENTS}\nSELECT * FROM kpis",
    "song_play_counts": f"{_EVENTS}\nSELECT * FROM plays",
    "top_songs_per_genre": f"{_EVENTS}\nSELECT * FROM top_songs",
    "top_songs_per_genre_ties": f"{_EVENTS}\nSELECT * FROM tied_songs",
    "top_genres_per_day": f"{_EVENTS}\nSELECT * FROM top_genres",
    "top_genres_per_day_ties": f"{_EVENTS}\nSELECT * FROM tied_genres",
    "star_daily_genre_kpis": f"{_ORDERS}\nSELECT * FROM kpis",
    "star_song_play_counts": f"{_ORDERS}\nSELECT * FROM plays",
    "star_top_songs_per_genre": f"{_ORDERS}\nSELECT * FROM top_songs",
    "star_top_songs_per_genre_ties": f"{_ORDERS}\nSELECT * FROM tied_songs",
    "star_top_genres_per_day": f"{_ORDERS}\nSELECT * FROM top_genres",
    "kpis_null_users": f"{_NULL_USERS}\nSELECT * FROM kpis",
    "duration_try_cast": """WITH written AS (
  SELECT p_type AS track_genre, CASE p_size % 7 WHEN 0 THEN 'oops' WHEN 1 THEN concat(p_partkey, '.0')
    WHEN 2 THEN concat(p_partkey, '.75') WHEN 3 THEN CAST(p_partkey + 9007199254740993 AS STRING)
    WHEN 4 THEN concat(' ', p_partkey, ' ') ELSE CAST(p_partkey AS STRING) END AS text FROM part),
parsed AS (SELECT track_genre, CAST(trunc(TRY_CAST(trim(text) AS DECIMAL(38, 9))) AS BIGINT) AS ms FROM written)
SELECT track_genre, COUNT(*) AS n_songs, COUNT(ms) AS n_parsed, CAST(SUM(ms % 1000003) AS BIGINT) AS total_rest,
  MAX(ms) AS longest_ms
FROM parsed GROUP BY track_genre""",
    "genre_day_lookup": f"""{_EVENTS}
SELECT * FROM kpis WHERE genre = 'ECONOMY' AND date = DATE '2024-01-15'""",
    "genre_date_top_songs_lookup": f"""{_EVENTS}
SELECT * FROM top_songs WHERE genre_date = 'ECONOMY#2024-01-15' ORDER BY rank""",
    "date_top_genres_lookup": f"""{_EVENTS}
SELECT * FROM top_genres WHERE date = DATE '2024-01-15' ORDER BY rank""",
    "genre_dates_lookup": f"""{_EVENTS}
SELECT date, listen_count FROM kpis WHERE genre = 'ECONOMY' ORDER BY date""",
    "kpis_by_listen_count": f"""{_EVENTS}
SELECT * FROM kpis ORDER BY listen_count DESC, genre, date LIMIT 10""",
    "first_top_songs": f"""{_EVENTS}
SELECT * FROM tied_songs ORDER BY genre_date, rank, track_name, artists LIMIT 15""",
    "first_top_genres": f"""{_EVENTS}
SELECT * FROM tied_genres ORDER BY date, rank, genre LIMIT 20""",
    "run_row_counts": f"""{_EVENTS}
SELECT (SELECT COUNT(*) FROM streams) AS streams_rows, (SELECT COUNT(*) FROM songs) AS songs_rows,
       (SELECT COUNT(*) FROM enriched) AS enriched_rows""",
    "upsert_kpis": f"""{_TWO_EXPORTS}
SELECT * FROM second_kpis
UNION ALL
SELECT a.* FROM first_kpis a LEFT JOIN second_kpis b ON a.genre = b.genre AND a.date = b.date
WHERE b.genre IS NULL""",
    "upsert_top_genres_stale_ranks": f"""{_TWO_EXPORTS}
SELECT * FROM fewer_ranks
UNION ALL
SELECT a.* FROM first_ranks a LEFT JOIN fewer_ranks b ON a.date = b.date AND a.rank = b.rank
WHERE b.date IS NULL""",
    "upsert_top_genres_whole_days": f"""{_TWO_EXPORTS}
SELECT * FROM fewer_ranks
UNION ALL
SELECT * FROM first_ranks WHERE date NOT IN (SELECT date FROM fewer_ranks)""",
    "kpi_items": f"""{_EVENTS}
SELECT genre, CAST(date AS STRING) AS date, listen_count, unique_listeners, total_listening_time_ms,
       avg_listening_time_per_user_ms FROM kpis""",
    "kpi_documents": f"""{_NULL_USERS}
SELECT concat('{{"genre":"', genre, '","date":"', CAST(date AS STRING), '","listen_count":', listen_count,
  ',"unique_listeners":', unique_listeners, ',"total_listening_time_ms":', total_listening_time_ms,
  CASE WHEN avg_listening_time_per_user_ms IS NULL THEN ''
       ELSE concat(',"avg_listening_time_per_user_ms":', avg_listening_time_per_user_ms) END, '}}') AS document
FROM kpis""",
    "event_items": """SELECT event_id,
  CASE WHEN microsecond(ts) % 1000000 = 0 THEN strftime(ts, '%Y-%m-%dT%H:%M:%S')
       ELSE strftime(ts, '%Y-%m-%dT%H:%M:%S.%f') END AS ts,
  CASE WHEN event_id % 100 <> 0 THEN CAST(CAST(value AS DECIMAL(38,6)) AS DOUBLE) END AS value FROM events""",
    "union_part_files": """SELECT event_id, user_id, CAST(NULL AS STRING) AS event_type
FROM events WHERE event_type = 'click'
UNION ALL
SELECT event_id, CAST(NULL AS BIGINT), event_type FROM events WHERE event_type <> 'click'""",
    "union_parts_of_other_types": """SELECT CAST(event_id AS DOUBLE) AS event_id,
  CASE WHEN event_type IN ('click', 'view', 'purchase') THEN CAST(user_id AS VARCHAR) END AS user_id FROM events""",
    "file_quality_profile": f"""{_FILES}
SELECT source_key, row_count, user_id_null_rate, track_id_null_rate, listen_time_non_null, listen_time_bad,
       track_id_distinct FROM prof""",
    "validate_files": f"{_FILES}\n{_VERDICTS}",
    "validate_files_all_times": f"WITH {_checked_files(None, _YEAR_FILES)}\n{_VERDICTS}",
    "validate_files_first_1000": f"WITH {_checked_files(1000, _YEAR_FILES)}\n{_VERDICTS}",
    "route_files": f"""{_FILES}
SELECT source_key, concat('tmp/validation/', source_key, '.result.json') AS result_key,
  concat('processed/kpis/', source_key) AS output_prefix,
  concat(CASE WHEN reason = '' THEN 'processed/streams/' ELSE 'quarantine/streams/' END,
         split_part(source_key, '/', 3)) AS target_key FROM verdict""",
    "passed_files_daily_kpis": f"{_PASSED}\n{_FOUR_KPI_COLUMNS}",
    "csv_enrich_streams": f"{_EVENTS}\nSELECT * FROM enriched",
    "csv_daily_genre_kpis": f"{_EVENTS}\nSELECT * FROM kpis",
    "csv_kpis_decimal_durations": f"{_EVENTS}\nSELECT * FROM kpis",
    "csv_line_breaks": """WITH ended AS (SELECT *, CASE event_id % 3 WHEN 0 THEN concat(chr(10), chr(10), ',"')
    WHEN 1 THEN chr(10) ELSE ';' END AS ends FROM events)
SELECT event_id, user_id, regexp_extract(props, '([0-9]+)', 1) AS track_id, ts AS listen_time,
  concat(event_type, ends, props, ends, event_id) AS note FROM ended""",
    "csv_time_layouts": """SELECT concat('raw/streams/type=', event_type) AS source_key,
  CASE WHEN event_type = 'error' AND event_id % 10 = 0 THEN NULL ELSE CAST(ts AS DATE) END AS date,
  COUNT(*) AS plays, CASE event_type WHEN 'error' THEN 'FAILED' ELSE 'PASSED' END AS status,
  CASE event_type WHEN 'error' THEN 'Column ''listen_time'' is not parseable as timestamps' ELSE '' END AS reason
FROM events GROUP BY ALL""",
    "csv_file_verdicts": """SELECT concat('raw/streams/type=', event_type) AS source_key,
  CASE WHEN event_type IN ('click', 'purchase') THEN 'FAILED' ELSE 'PASSED' END AS status,
  CASE event_type WHEN 'click' THEN 'Missing required columns: [''listen_time'']'
                  WHEN 'purchase' THEN 'Could not read file: a row has more fields than the header'
                  ELSE '' END AS reason
FROM events GROUP BY event_type
UNION ALL
SELECT concat('raw/streams/type=', kind), 'FAILED', reason
FROM (VALUES ('header_only', 'File contains 0 rows — must have at least 1'),
  ('untimed', 'Column ''listen_time'' has no non-null values to parse'),
  ('latin', 'Could not read file: not valid UTF-8'),
  ('empty', 'Could not read file: No columns to parse from file')) t(kind, reason)""",
    "run_verdicts": f"{_FILES}\n{_VERDICTS}",
    "run_daily_genre_kpis": f"{_PASSED}\nSELECT * FROM kpis",
    "run_top_songs_per_genre": f"{_PASSED}\nSELECT * FROM top_songs",
    "run_top_genres_per_day": f"{_PASSED}\nSELECT * FROM top_genres",
    "run_result_objects": f"""{_FILES}
SELECT source_key, CASE WHEN reason = '' THEN 'PASSED' ELSE 'FAILED' END AS status, reason,
  concat('tmp/validation/', source_key, '.result.json') AS result_key FROM verdict""",
    "run_replace_group": f"""{_EVENTS},
first_plays AS (SELECT * FROM enriched WHERE day(date) <= 20),
second_plays AS (SELECT * FROM enriched WHERE day(date) >= 15 AND event_id % 40 = 0),
{_kpis("first_kpis", "first_plays")},
{_kpis("second_kpis", "second_plays")},
{_genre_ranks("first_ranks", "first_kpis")},
{_genre_ranks("second_ranks", "second_kpis")}
SELECT * FROM second_ranks
UNION ALL
SELECT * FROM first_ranks WHERE date NOT IN (SELECT date FROM second_ranks)""",
    "run_duplicate_ranks": f"""WITH {_EVENT_PLAYS},
{_SONGS.replace("songs AS", "listed AS", 1)},
songs AS (
  SELECT * FROM listed
  UNION ALL
  SELECT track_id, track_genre, duration_ms, concat(track_name, ' (live)'), artists FROM listed WHERE track_id = '7'),
{_RESULTS},
twice AS (
  SELECT split_part(genre_date, '#', 2) AS day, genre_date, rank FROM top_songs
  GROUP BY genre_date, rank HAVING COUNT(*) > 1),
failed AS (
  SELECT day, MIN(concat('table=top_songs_per_genre, genre_date=', genre_date, ', rank=', rank)) AS key
  FROM twice GROUP BY day)
SELECT concat('raw/streams/', d.day, '.csv') AS source_key,
  CASE WHEN key IS NULL THEN 'PASSED' ELSE 'FAILED' END AS status,
  CASE WHEN key IS NULL THEN '' ELSE concat('Results hold a key more than once: ', key) END AS reason
FROM (SELECT DISTINCT CAST(CAST(ts AS DATE) AS STRING) AS day FROM events) d LEFT JOIN failed USING (day)""",
    "stream_daily_kpis": f"{_EVENTS}\nSELECT * FROM kpis",
    "stream_passed_files": f"{_PASSED}\n{_FOUR_KPI_COLUMNS}",
    "stream_resent_file": f"""{_EVENTS},
resent AS (SELECT * FROM enriched WHERE day(date) BETWEEN 10 AND 15 AND event_id % 2 = 0),
{_kpis("later", "resent")}
SELECT genre, date, listen_count, unique_listeners FROM later
UNION ALL
SELECT genre, date, listen_count, unique_listeners FROM kpis
WHERE (genre, date) NOT IN (SELECT (genre, date) FROM later)""",
}
