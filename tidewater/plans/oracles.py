"""Independent SQL answers (DuckDB dialect) for the registered queries.

They compute every result straight from the driver tables (``orders``,
``region``, ``events``) with the fixture's arithmetic and share no code
with the Spark path, which goes through landed JSON, variant parsing and
the DataFrame operators.  NULL order is always spelled out.
"""

from __future__ import annotations

# v_matches computed directly from orders (same arithmetic as the landing fixture)
_SNAP = """
o AS (
  SELECT o_orderkey AS k, o_custkey, o_orderstatus, o_totalprice, o_orderdate,
         o_orderkey // 3 AS match_id, CAST(o_orderkey % 3 AS INTEGER) AS snap_no
  FROM orders
),
o2 AS (
  SELECT *, match_id % 5 AS comp, (match_id // 5) % 20 AS h, o_orderstatus = 'F' AS finished,
         DATE '2024-01-01' + snap_no AS dt, (match_id // 5) // 2000 AS shard
  FROM o
),
o3 AS (
  SELECT *, (h + 1 + (match_id // 100) % 19) % 20 AS a,
         ['PL','SA','BL1','PD','FL1'][comp + 1] AS code,
         CASE WHEN finished THEN o_custkey % 5 END AS hg,
         CASE WHEN finished THEN CAST(floor(o_totalprice) AS BIGINT) % 4 END AS ag,
         '0' || comp || '-' || snap_no || '-' || shard AS run_id
  FROM o2
),
v_matches AS (
  SELECT
    'endpoint=matches/competition=' || code || '/dateFrom=' || strftime(dt - 1, '%Y-%m-%d')
      || '/dateTo=' || strftime(dt + 7, '%Y-%m-%d') || '/dt=' || strftime(dt, '%Y-%m-%d')
      || '/run_id=' || run_id || '.json' AS file_key,
    code AS competition_code,
    CAST(dt - 1 AS DATE) AS date_from,
    CAST(dt + 7 AS DATE) AS date_to,
    run_id,
    CAST(dt AS DATE) AS dt,
    TIMESTAMP '2024-01-01 02:00:00' + to_days(snap_no) AS loaded_at,
    match_id,
    CASE WHEN k % 173 <> 5 THEN CAST(o_orderdate AS TIMESTAMP) + to_seconds(k % 86400) END AS utc_date,
    CASE WHEN match_id % 211 = 17 THEN 'ABANDONED'
         WHEN o_orderstatus = 'F' THEN 'FINISHED'
         WHEN o_orderstatus = 'O' THEN 'SCHEDULED'
         WHEN o_orderstatus = 'P' THEN 'IN_PLAY' END AS status,
    'REGULAR_SEASON' AS stage,
    CAST(NULL AS VARCHAR) AS match_group,
    match_id % 38 + 1 AS matchday,
    TIMESTAMP '2024-01-01 00:00:00' + to_seconds(k) AS last_updated,
    comp + 2000 AS competition_id,
    code AS competition_code_in_payload,
    'Competition ' || comp AS competition_name,
    'LEAGUE' AS competition_type,
    comp * 10 + 1 + (match_id // 250) % 2 AS season_id,
    DATE '1995-01-01' AS season_start_date,
    DATE '2004-12-31' AS season_end_date,
    CAST(NULL AS BIGINT) AS season_current_matchday,
    CASE WHEN match_id % 331 <> 29 THEN comp * 100 + h END AS home_team_id,
    CASE WHEN match_id % 331 <> 29 THEN 'Team ' || (comp * 100 + h) END AS home_team_name,
    CASE WHEN match_id % 331 <> 29 THEN 'T' || (comp * 100 + h) END AS home_team_short_name,
    CAST(NULL AS VARCHAR) AS home_team_tla,
    CAST(NULL AS VARCHAR) AS home_team_crest,
    comp * 100 + a AS away_team_id,
    'Team ' || (comp * 100 + a) AS away_team_name,
    'T' || (comp * 100 + a) AS away_team_short_name,
    CAST(NULL AS VARCHAR) AS away_team_tla,
    CAST(NULL AS VARCHAR) AS away_team_crest,
    CASE WHEN NOT finished OR match_id % 50 = 7 THEN NULL
         WHEN hg > ag THEN 'HOME_TEAM' WHEN hg = ag THEN 'DRAW' ELSE 'AWAY_TEAM' END AS winner,
    'REGULAR' AS duration,
    hg AS ft_home_goals,
    ag AS ft_away_goals,
    hg // 2 AS ht_home_goals,
    ag // 2 AS ht_away_goals
  FROM o3
),
matches_latest AS (
  SELECT
    match_id, utc_date, status, stage, match_group, matchday, last_updated,
    competition_id, competition_code_in_payload AS competition_code, competition_name, competition_type,
    season_id, season_start_date, season_end_date, season_current_matchday,
    home_team_id, home_team_name, home_team_short_name, home_team_tla, home_team_crest,
    away_team_id, away_team_name, away_team_short_name, away_team_tla, away_team_crest,
    winner, duration, ft_home_goals, ft_away_goals, ht_home_goals, ht_away_goals,
    file_key, competition_code AS competition_code_from_run, date_from, date_to, run_id, dt, loaded_at
  FROM v_matches
  QUALIFY row_number() OVER (PARTITION BY match_id
      ORDER BY loaded_at DESC NULLS FIRST, last_updated DESC NULLS FIRST, file_key DESC NULLS FIRST) = 1
),
team_results_long AS (
  SELECT match_id, competition_code, season_id, utc_date, 0 AS side,
         home_team_id AS team_id, home_team_name AS team_name,
         ft_home_goals AS gf, ft_away_goals AS ga,
         CASE WHEN winner = 'HOME_TEAM' THEN 'W' WHEN winner = 'DRAW' THEN 'D' WHEN winner = 'AWAY_TEAM' THEN 'L' END AS result,
         CASE WHEN winner = 'HOME_TEAM' THEN 3 WHEN winner = 'DRAW' THEN 1 ELSE 0 END AS pts,
         CASE WHEN winner = 'HOME_TEAM' THEN 1 ELSE 0 END AS w,
         CASE WHEN winner = 'DRAW' THEN 1 ELSE 0 END AS d,
         CASE WHEN winner = 'AWAY_TEAM' THEN 1 ELSE 0 END AS l
  FROM matches_latest WHERE status = 'FINISHED' AND home_team_id IS NOT NULL
  UNION ALL
  SELECT match_id, competition_code, season_id, utc_date, 1 AS side,
         away_team_id, away_team_name, ft_away_goals, ft_home_goals,
         CASE WHEN winner = 'AWAY_TEAM' THEN 'W' WHEN winner = 'DRAW' THEN 'D' WHEN winner = 'HOME_TEAM' THEN 'L' END,
         CASE WHEN winner = 'AWAY_TEAM' THEN 3 WHEN winner = 'DRAW' THEN 1 ELSE 0 END,
         CASE WHEN winner = 'AWAY_TEAM' THEN 1 ELSE 0 END,
         CASE WHEN winner = 'DRAW' THEN 1 ELSE 0 END,
         CASE WHEN winner = 'HOME_TEAM' THEN 1 ELSE 0 END
  FROM matches_latest WHERE status = 'FINISHED' AND away_team_id IS NOT NULL
)"""

FX = "WITH " + _SNAP.strip()

KEY_DATE = "'%Y-%m-%d'"
MANIFEST_OF = r"regexp_replace(file_key, '\.json$', '.manifest.json')"

_LATEST_COLS = """
    match_id, utc_date, status, stage, match_group, matchday, last_updated,
    competition_id, competition_code_in_payload AS competition_code, competition_name, competition_type,
    season_id, season_start_date, season_end_date, season_current_matchday,
    home_team_id, home_team_name, home_team_short_name, home_team_tla, home_team_crest,
    away_team_id, away_team_name, away_team_short_name, away_team_tla, away_team_crest,
    winner, duration, ft_home_goals, ft_away_goals, ht_home_goals, ht_away_goals,
    file_key, competition_code AS competition_code_from_run, date_from, date_to, run_id, dt, loaded_at"""


def _latest_sql(where: str = "TRUE") -> str:
    return f"""SELECT {_LATEST_COLS}
  FROM v_matches WHERE {where}
  QUALIFY row_number() OVER (PARTITION BY match_id
      ORDER BY loaded_at DESC NULLS FIRST, last_updated DESC NULLS FIRST, file_key DESC NULLS FIRST) = 1"""


def _teams_sql(src: str) -> str:
    return f"""SELECT team_id, name, short_name, tla, crest, competition_code, season_id, utc_date AS last_seen_utc_date
  FROM (
    SELECT match_id, competition_code, season_id, utc_date, 0 AS side, home_team_id AS team_id,
           home_team_name AS name, home_team_short_name AS short_name, home_team_tla AS tla, home_team_crest AS crest
    FROM {src} WHERE home_team_id IS NOT NULL
    UNION ALL
    SELECT match_id, competition_code, season_id, utc_date, 1, away_team_id,
           away_team_name, away_team_short_name, away_team_tla, away_team_crest
    FROM {src} WHERE away_team_id IS NOT NULL
  ) sides
  QUALIFY row_number() OVER (PARTITION BY team_id
      ORDER BY utc_date DESC NULLS FIRST, match_id DESC NULLS FIRST, side ASC) = 1"""


_LEAGUE_AGG = """SELECT competition_code, season_id, team_id,
         max(team_name) AS team_name,
         CAST(count(*) AS BIGINT) AS played,
         CAST(sum(w) AS BIGINT) AS wins,
         CAST(sum(d) AS BIGINT) AS draws,
         CAST(sum(l) AS BIGINT) AS losses,
         CAST(sum(gf) AS BIGINT) AS goals_for,
         CAST(sum(ga) AS BIGINT) AS goals_against,
         CAST(sum(gf) - sum(ga) AS BIGINT) AS goal_diff,
         CAST(sum(pts) AS BIGINT) AS points,
         max(utc_date) AS as_of_utc
  FROM team_results_long
  GROUP BY competition_code, season_id, team_id"""

_LEAGUE_RANK = """SELECT *, CAST(row_number() OVER (PARTITION BY competition_code, season_id
    ORDER BY points DESC NULLS FIRST, goal_diff DESC NULLS FIRST, goals_for DESC NULLS FIRST,
             team_name ASC NULLS LAST, team_id ASC NULLS LAST) AS BIGINT) AS rank
FROM agg"""

_FORM = """SELECT competition_code, team_id,
       max(team_name) AS team_name,
       CAST(count(*) AS BIGINT) AS games_played_last5,
       CAST(sum(CASE WHEN result = 'W' THEN 1 ELSE 0 END) AS BIGINT) AS wins_last5,
       CAST(sum(CASE WHEN result = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS draws_last5,
       CAST(sum(CASE WHEN result = 'L' THEN 1 ELSE 0 END) AS BIGINT) AS losses_last5,
       CAST(sum(gf) AS BIGINT) AS goals_for_last5,
       CAST(sum(ga) AS BIGINT) AS goals_against_last5,
       CAST(sum(gf) - sum(ga) AS BIGINT) AS goal_diff_last5,
       CAST(sum(CASE WHEN result = 'W' THEN 3 WHEN result = 'D' THEN 1 ELSE 0 END) AS BIGINT) AS points_last5,
       max(utc_date) AS last_match_utc
FROM (
  SELECT * FROM team_results_long
  QUALIFY row_number() OVER (PARTITION BY competition_code, team_id
      ORDER BY utc_date DESC NULLS FIRST, match_id DESC NULLS FIRST) <= 5
) last5
GROUP BY competition_code, team_id"""

LEAGUE_TABLE = FX + f"\n, agg AS (\n  {_LEAGUE_AGG}\n)\n{_LEAGUE_RANK}\n"
TEAM_FORM = FX + "\n" + _FORM + "\n"
MATCHES_FLATTEN = FX + "\nSELECT * FROM v_matches\n"
MATCHES_LATEST = FX + "\nSELECT * FROM matches_latest\n"
TEAM_RESULTS_LONG = FX + """
SELECT match_id, competition_code, season_id, utc_date, side, team_id, team_name, gf, ga, result,
       pts, w, d, l
FROM team_results_long
"""
TEAMS_DIM = FX + "\n" + _teams_sql("matches_latest") + "\n"

_FILES = """, files AS (
  SELECT file_key, competition_code, date_from, date_to, run_id, dt, loaded_at, CAST(count(*) AS BIGINT) AS n_matches
  FROM v_matches GROUP BY ALL
)"""

LANDING_SCAN = FX + _FILES + "\nSELECT file_key, n_matches FROM files\n"

OBJECT_CLASSIFY = FX + _FILES + """
SELECT competition_code AS competition, 'data' AS kind, CAST(count(*) AS BIGINT) AS n_objects FROM files GROUP BY 1
UNION ALL
SELECT competition_code, 'manifest', CAST(count(*) AS BIGINT) FROM files WHERE competition_code <> 'FL1' GROUP BY 1
"""

KEY_PARSE = FX + _FILES + f"""
, k AS (
  SELECT file_key, run_id, strftime(dt, {KEY_DATE}) AS dt, competition_code AS competition,
         strftime(date_from, {KEY_DATE}) AS date_from, strftime(date_to, {KEY_DATE}) AS date_to
  FROM files
)
SELECT * FROM k
UNION ALL
SELECT {MANIFEST_OF}, run_id, dt, competition, date_from, date_to FROM k WHERE competition <> 'FL1'
"""

LATEST_OBJECT = FX + "\nSELECT max(file_key) AS latest_key FROM v_matches\n"

_COMP_DAYS = """(SELECT CAST(range AS INTEGER) AS d FROM range(3)) days"""
COMPETITIONS_FLATTEN = f"""
SELECT 'endpoint=competitions/dt=' || strftime(DATE '2024-01-01' + d, {KEY_DATE}) || '/run_id=0c-' || d || '-'
         || (r_regionkey // 2000) || '.json' AS file_key,
       '0c-' || d || '-' || (r_regionkey // 2000) AS run_id,
       CAST(DATE '2024-01-01' + d AS DATE) AS dt,
       CAST(r_regionkey AS BIGINT) + 2000 AS competition_id,
       upper(substr(r_name, 1, 3)) AS code,
       r_name AS name
FROM region CROSS JOIN {_COMP_DAYS}
"""

RAW_COMPETITIONS_UPSERT = f"""
SELECT 'endpoint=competitions/dt=' || strftime(DATE '2024-01-01' + d, {KEY_DATE}) || '/run_id=0c-' || d || '-'
         || shard || '.json' AS file_key,
       '0c-' || d || '-' || shard AS run_id,
       CAST(DATE '2024-01-01' + d AS DATE) AS dt,
       n_competitions
FROM {_COMP_DAYS}
CROSS JOIN (SELECT r_regionkey // 2000 AS shard, CAST(count(*) AS BIGINT) AS n_competitions FROM region GROUP BY 1) s
"""

# what a document says of its matches, by id
_DIGESTS = """, digests AS (
  SELECT file_key, md5(string_agg(
      match_id || '|' || coalesce(strftime(utc_date, '%Y-%m-%dT%H:%M:%SZ'), '-') || '|' || coalesce(status, '-') || '|'
      || strftime(last_updated, '%Y-%m-%dT%H:%M:%SZ') || '|' || coalesce(CAST(home_team_id AS VARCHAR), '-') || '|'
      || coalesce(CAST(away_team_id AS VARCHAR), '-') || '|' || coalesce(winner, '-') || '|'
      || coalesce(CAST(ft_home_goals AS VARCHAR), '-') || '|' || coalesce(CAST(ft_away_goals AS VARCHAR), '-'),
      chr(10) ORDER BY match_id)) AS digest
  FROM v_matches GROUP BY file_key
)"""

LANDING_WRITE = FX + _FILES + _DIGESTS + f"""
SELECT competition_code AS competition, strftime(date_from, {KEY_DATE}) AS date_from,
       strftime(date_to, {KEY_DATE}) AS date_to, strftime(dt, {KEY_DATE}) AS dt, run_id,
       CAST(count(*) AS BIGINT) AS n_documents, CAST(sum(n_matches) AS BIGINT) AS n_matches, min(digest) AS digest
FROM files JOIN digests USING (file_key) GROUP BY ALL
"""

# the JSON of a document's manifest
MANIFEST_TEXT = f"""'{{"run_id":"' || run_id || '","endpoint":"matches","competition":"' || competition_code
         || '","params":{{"dateFrom":"' || strftime(date_from, {KEY_DATE}) || '","dateTo":"' || strftime(date_to, {KEY_DATE})
         || '"}},"dt_partition":"' || strftime(dt, {KEY_DATE}) || '","fetched_at_utc":"' || strftime(dt, {KEY_DATE})
         || 'T01:00:00+00:00","record_count":' || n_matches || ',"bucket":"bronze","data_key":"' || file_key || '"}}'"""

LANDING_PAIR_WRITE = FX + _FILES + _DIGESTS + f"""
SELECT file_key, n_matches, NULL AS manifest, digest FROM files JOIN digests USING (file_key)
UNION ALL
SELECT {MANIFEST_OF}, n_matches, {MANIFEST_TEXT}, NULL FROM files
"""

MANIFEST_BUILD = FX + _FILES + f"""
SELECT file_key AS data_key, run_id, 'matches' AS endpoint, competition_code AS competition,
       strftime(date_from, {KEY_DATE}) AS date_from, strftime(date_to, {KEY_DATE}) AS date_to,
       strftime(dt, {KEY_DATE}) AS dt_partition, n_matches AS record_count, 'bronze' AS bucket,
       strftime(dt, {KEY_DATE}) || 'T01:00:00+00:00' AS fetched_at_utc,
       {MANIFEST_OF} AS manifest_key,
       {MANIFEST_TEXT} AS manifest
FROM files
"""

MANIFEST_PAIRING = FX + _FILES + f"""
SELECT file_key AS data_key, {MANIFEST_OF} AS manifest_key, competition_code <> 'FL1' AS manifest_found FROM files
"""

MANIFEST_RECONCILE = FX + _FILES + f"""
SELECT file_key AS data_key, {MANIFEST_OF} AS manifest_key,
       CASE WHEN competition_code = 'FL1' THEN NULL ELSE n_matches + 1 END AS manifest_count, n_matches AS payload_count
FROM files WHERE (competition_code = 'PD' AND dt = DATE '2024-01-03') OR competition_code = 'FL1'
"""

RAW_MATCHES_UPSERT = FX + _FILES + """
SELECT file_key, competition_code, date_from, date_to, run_id, dt,
       TIMESTAMP '2024-01-04 02:00:00' AS loaded_at, n_matches
FROM files
"""

RAW_MANIFESTS_UPSERT = FX + _FILES + f"""
SELECT {MANIFEST_OF} AS file_key, 'matches' AS endpoint, run_id, dt,
       n_matches + CASE WHEN competition_code = 'PD' AND dt = DATE '2024-01-03' THEN 1 ELSE 0 END AS record_count
FROM files WHERE competition_code <> 'FL1'
"""

LOAD_STATE_PENDING = FX + _FILES + "\nSELECT file_key FROM files WHERE dt > DATE '2024-01-01'\n"

LOAD_STATE_MARK = FX + _FILES + f"""
SELECT file_key, 'matches_incremental' AS endpoint FROM files
UNION ALL
SELECT {MANIFEST_OF}, 'matches_incremental_manifest' FROM files WHERE competition_code <> 'FL1'
"""

_BACKFILLED = """replace(file_key, 'endpoint=matches/', 'endpoint=matches_backfill/') AS file_key,
       TIMESTAMP '2024-01-04 02:00:00' AS loaded_at"""

BACKFILL_LOAD = FX + _FILES + f"""
SELECT competition_code, date_from, date_to, run_id, dt, n_matches, 'matches_backfill' AS endpoint, {_BACKFILLED}
FROM files
"""

BACKFILL_LATEST = FX + f"""
SELECT * EXCLUDE (file_key, loaded_at), {_BACKFILLED} FROM matches_latest
"""

_LOADER = """SELECT 'endpoint=matches/' AS prefix,
       CAST(count(*) AS BIGINT) AS files_discovered,
       CAST(count(*) FILTER (WHERE dt > DATE '2024-01-01') AS BIGINT) AS files_to_load,
       CAST(count(*) FILTER (WHERE dt > DATE '2024-01-01') AS BIGINT) AS data_files_loaded,
       CAST(count(*) FILTER (WHERE dt > DATE '2024-01-01' AND competition_code <> 'FL1') AS BIGINT) AS manifests_loaded
FROM files"""
LOADER_METRICS = FX + _FILES + "\n" + _LOADER + "\n"

_MERGE = f""", tgt AS (
  {_latest_sql("loaded_at < TIMESTAMP '2024-01-03 02:00:00'")}
), src AS (
  {_latest_sql("loaded_at = TIMESTAMP '2024-01-03 02:00:00'")}
)"""

MATCHES_LATEST_MERGE = FX + _MERGE + """
SELECT * FROM tgt WHERE NOT EXISTS (SELECT 1 FROM src WHERE src.match_id = tgt.match_id)
UNION ALL
SELECT * FROM src
"""

TEAMS_MERGE = FX + _MERGE + f"""
, t_tgt AS ({_teams_sql("tgt")}), t_src AS ({_teams_sql("src")})
SELECT * FROM t_tgt WHERE NOT EXISTS (SELECT 1 FROM t_src WHERE t_src.team_id = t_tgt.team_id)
UNION ALL
SELECT * FROM t_src
"""

_MODELS = f""", teams AS ({_teams_sql("matches_latest")}),
form AS ({_FORM}),
agg AS ({_LEAGUE_AGG}),
league AS ({_LEAGUE_RANK})"""


def _nn(model: str, table: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'not_null' AS test, "
            f"CAST(count(*) FILTER (WHERE {col} IS NULL) AS BIGINT) AS failures FROM {table}")


def _uq(model: str, table: str, col: str) -> str:
    return (f"SELECT '{model}' AS model, '{col}' AS column_name, 'unique' AS test, CAST(count(*) AS BIGINT) AS failures "
            f"FROM (SELECT {col} FROM {table} WHERE {col} IS NOT NULL GROUP BY {col} HAVING count(*) > 1) dup")


_STATUSES = "'SCHEDULED', 'TIMED', 'IN_PLAY', 'PAUSED', 'FINISHED', 'POSTPONED', 'SUSPENDED', 'CANCELLED'"
_AV = ("SELECT 'matches_latest' AS model, 'status' AS column_name, 'accepted_values' AS test, "
       f"CAST(count(DISTINCT status) FILTER (WHERE status NOT IN ({_STATUSES})) AS BIGINT) AS failures FROM matches_latest")

_NOT_NULL = "\nUNION ALL\n".join([
    _nn("v_matches", "v_matches", "match_id"),
    _nn("matches_latest", "matches_latest", "match_id"),
    _nn("matches_latest", "matches_latest", "utc_date"),
    _nn("matches_latest", "matches_latest", "status"),
    _nn("teams", "teams", "team_id"),
    _nn("teams", "teams", "name"),
    _nn("team_form_last5", "form", "competition_code"),
    _nn("team_form_last5", "form", "team_id"),
    _nn("team_form_last5", "form", "games_played_last5"),
    _nn("league_table_snapshot", "league", "competition_code"),
    _nn("league_table_snapshot", "league", "season_id"),
    _nn("league_table_snapshot", "league", "team_id"),
    _nn("league_table_snapshot", "league", "points"),
    _nn("league_table_snapshot", "league", "rank"),
])
_UNIQUE = _uq("matches_latest", "matches_latest", "match_id") + "\nUNION ALL\n" + _uq("teams", "teams", "team_id")
_REPORT = f"""report AS (
  SELECT *, CASE WHEN failures > 0 THEN 'fail' ELSE 'pass' END AS state FROM (
    {_NOT_NULL}
    UNION ALL
    {_UNIQUE}
    UNION ALL
    {_AV}
  ) r
)"""

DQ_NOT_NULL = FX + _MODELS + "\n" + _NOT_NULL + "\n"
DQ_UNIQUE = FX + _MODELS + "\n" + _UNIQUE + "\n"
DQ_ACCEPTED_VALUES = FX + _MODELS + "\n" + _AV + "\n"
DQ_REPORT = FX + _MODELS + ",\n" + _REPORT + "\nSELECT * FROM report\n"

PIPELINE_RUN_METRICS = FX + _MODELS + ",\n" + _REPORT + _FILES + f"""
, loader AS ({_LOADER})
SELECT 'daily_pipeline' AS dag_id, TIMESTAMP '2024-01-03 02:00:00' AS execution_date,
       prefix AS loader_prefix, files_discovered, files_to_load, data_files_loaded, manifests_loaded,
       CASE WHEN (SELECT count(*) FROM report WHERE state = 'fail') > 0 THEN 'failed' ELSE 'success' END AS dbt_test_state,
       TRUE AS timed
FROM loader
"""

ROLLING_WINDOW_FILTER = """
SELECT event_id, ts, user_id, event_type, value, DATE '2024-01-14' AS window_from, DATE '2024-01-22' AS window_to
FROM events
WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-14' AND DATE '2024-01-22'
  AND event_type IN ('click', 'view', 'purchase')
"""

BACKFILL_CHUNK_ASSIGN = """
SELECT event_id, user_id, ts, chunk_no,
       CAST(DATE '2024-01-03' + chunk_no * 7 AS DATE) AS date_from,
       least(CAST(DATE '2024-01-03' + chunk_no * 7 + 6 AS DATE), DATE '2024-01-27') AS date_to
FROM (
  SELECT *, CAST(floor(date_diff('day', DATE '2024-01-03', CAST(ts AS DATE)) / 7) AS INTEGER) AS chunk_no
  FROM events
  WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-03' AND DATE '2024-01-27'
) e
"""

# day by day: a day is covered if any loaded window holds it
BACKFILL_COVERAGE_GAPS = """
WITH days AS (
  SELECT user_id, CAST(d AS DATE) AS day FROM (SELECT DISTINCT user_id FROM events)
  CROSS JOIN generate_series(DATE '2024-01-01', DATE '2024-01-30', INTERVAL 1 DAY) AS g(d)
),
loaded AS (
  SELECT DISTINCT user_id, n, CAST(DATE '2024-01-01' + CAST(floor(date_diff('day', DATE '2024-01-01', CAST(ts AS DATE)) / n) AS INTEGER) * n AS DATE) AS date_from
  FROM (SELECT *, CASE WHEN event_id % 2 = 1 THEN 3 ELSE 2 END AS n FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-01' AND DATE '2024-01-30')
),
missing AS (
  SELECT user_id, day, CAST(DATE '2024-01-01' + CAST(floor(date_diff('day', DATE '2024-01-01', day) / 2) AS INTEGER) * 2 AS DATE) AS date_from
  FROM days AS d
  WHERE NOT EXISTS (SELECT 1 FROM loaded l WHERE l.user_id = d.user_id AND d.day BETWEEN l.date_from AND l.date_from + CAST(n - 1 AS INTEGER))
),
runs AS (
  SELECT user_id, date_from, day, date_diff('day', DATE '2024-01-01', day) - row_number() OVER (PARTITION BY user_id, date_from ORDER BY day) AS r FROM missing
)
SELECT user_id, date_from, CAST(least(date_from + 1, DATE '2024-01-30') AS DATE) AS date_to, min(day) AS missing_from, max(day) AS missing_to
FROM runs GROUP BY user_id, date_from, r
"""

LATEST_EVENT_PER_USER = """
SELECT * FROM events
QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY ts DESC NULLS FIRST, event_id DESC) = 1
"""

TOP5_EVENTS_PER_USER = """
SELECT event_id, user_id, event_type, value,
       CAST(row_number() OVER (PARTITION BY user_id ORDER BY value DESC NULLS FIRST, event_id DESC) AS BIGINT) AS rn
FROM events
QUALIFY rn <= 5
"""

EVENTS_PROPS_EXTRACT = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k FROM events
"""

STREAM_BRONZE_INGEST = FX + _FILES + """
SELECT file_key, competition_code, date_from, date_to, run_id, dt, loaded_at, n_matches FROM files
"""


def oracle_sql() -> dict[str, str]:
    return {
        "landing_scan": LANDING_SCAN,
        "object_classify": OBJECT_CLASSIFY,
        "key_parse": KEY_PARSE,
        "latest_object": LATEST_OBJECT,
        "competitions_flatten": COMPETITIONS_FLATTEN,
        "landing_write": LANDING_WRITE,
        "landing_pair_write": LANDING_PAIR_WRITE,
        "manifest_build": MANIFEST_BUILD,
        "manifest_pairing": MANIFEST_PAIRING,
        "manifest_reconcile": MANIFEST_RECONCILE,
        "raw_competitions_upsert": RAW_COMPETITIONS_UPSERT,
        "raw_matches_upsert": RAW_MATCHES_UPSERT,
        "raw_manifests_upsert": RAW_MANIFESTS_UPSERT,
        "load_state_pending": LOAD_STATE_PENDING,
        "load_state_mark": LOAD_STATE_MARK,
        "loader_metrics": LOADER_METRICS,
        "matches_flatten": MATCHES_FLATTEN,
        "matches_latest": MATCHES_LATEST,
        "matches_latest_merge": MATCHES_LATEST_MERGE,
        "daily_refresh_incremental": MATCHES_LATEST,
        "backfill_load": BACKFILL_LOAD,
        "backfill_latest": BACKFILL_LATEST,
        "teams_stored": TEAMS_DIM,
        "team_form_stored": TEAM_FORM,
        "league_table_stored": LEAGUE_TABLE,
        "teams_dim": TEAMS_DIM,
        "teams_merge": TEAMS_MERGE,
        "team_results_long": TEAM_RESULTS_LONG,
        "team_form_last5": TEAM_FORM,
        "league_table_snapshot": LEAGUE_TABLE,
        "dq_not_null": DQ_NOT_NULL,
        "dq_unique": DQ_UNIQUE,
        "dq_accepted_values": DQ_ACCEPTED_VALUES,
        "dq_report": DQ_REPORT,
        "pipeline_run_metrics": PIPELINE_RUN_METRICS,
        "rolling_window_filter": ROLLING_WINDOW_FILTER,
        "backfill_chunk_assign": BACKFILL_CHUNK_ASSIGN,
        "backfill_coverage_gaps": BACKFILL_COVERAGE_GAPS,
        "latest_event_per_user": LATEST_EVENT_PER_USER,
        "top5_events_per_user": TOP5_EVENTS_PER_USER,
        "events_props_extract": EVENTS_PROPS_EXTRACT,
        "stream_bronze_ingest": STREAM_BRONZE_INGEST,
        "stream_matches_latest": MATCHES_LATEST,
    }
