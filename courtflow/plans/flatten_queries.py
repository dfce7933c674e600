"""Registered queries that flatten documents, each with SQL on the base tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.functions.seasons import season_page_dates
from courtflow.operators import discovery, game_pages, player_pages, schedules, standings
from courtflow.plans import document_fixtures
from courtflow.plans.fixtures import table
from courtflow.schemas import RecordType
from courtflow.sources.documents import parse_documents

AS_OF = dt.date(2025, 2, 1)


def _time(name: str) -> F.Column:
    return F.date_format(name, "yyyy-MM-dd HH:mm:ss").alias(name)


def _schedules(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(document_fixtures.schedules(spark, sf_dir), RecordType.SCHEDULE)


def _standings(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = document_fixtures.standings(spark, sf_dir)
    return standings.standings_content(parse_documents(documents, RecordType.STANDINGS), AS_OF)


def _games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(document_fixtures.games(spark, sf_dir), RecordType.GAME)


def _players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return parse_documents(document_fixtures.players(spark, sf_dir), RecordType.PLAYER)


EVENTS_SQL = """
ev AS (
  SELECT *, o_orderkey*2+j AS n FROM orders CROSS JOIN (VALUES (0),(1)) v(j)),
schedule AS (
  SELECT CASE WHEN n%101=0 THEN NULL ELSE n END AS id,
    o_orderdate + to_hours(CAST(n%24 AS INT)) AS datetime,
    o_orderstatus='P' AS tbd, n%360 AS home_id, (n*7+1)%360 AS away_id,
    n%3 AS home_mascot, n%5 AS away_mascot,
    CASE WHEN n%4<>3 THEN o_custkey END AS venue_id, o_orderpriority AS priority,
    CAST(CASE o_orderstatus WHEN 'O' THEN 1 WHEN 'P' THEN 2 ELSE 3 END AS BIGINT) AS status_id,
    CASE o_orderstatus WHEN 'O' THEN 'pre' WHEN 'P' THEN 'in' ELSE 'post' END AS state,
    CASE WHEN o_orderstatus='F' THEN 'Final' ELSE o_orderpriority END AS detail
  FROM ev)"""


def schedule_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedules.schedule_events(_schedules(spark, sf_dir)).select(
        "id", _time("datetime"), "tbd", F.size("teams").cast("bigint").alias("n_teams"),
        F.col("venue").isNotNull().alias("has_venue"), F.col("status.state").alias("state"),
    )


SCHEDULE_EVENTS = f"""WITH {EVENTS_SQL}
SELECT id, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, tbd,
  CAST(2 AS BIGINT) AS n_teams, venue_id IS NOT NULL AS has_venue, state FROM schedule"""


def venues(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedules.venues(_schedules(spark, sf_dir))


VENUES = f"""WITH {EVENTS_SQL}
SELECT venue_id AS id, 'Arena '||venue_id AS name,
  CASE WHEN venue_id%5<>0 THEN 'Town '||(venue_id%40) END AS city,
  CASE WHEN venue_id%5<>0 THEN priority END AS state
FROM schedule WHERE venue_id IS NOT NULL"""


def statuses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedules.game_statuses(_schedules(spark, sf_dir))


STATUSES = f"""WITH {EVENTS_SQL}
SELECT DISTINCT status_id AS id, state, detail FROM schedule"""


def schedule_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedules.schedule_teams(_schedules(spark, sf_dir))


SCHEDULE_TEAMS = f"""WITH {EVENTS_SQL}
SELECT id, 'City '||id AS location, 'Mascot '||min(m) AS mascot, 'T'||id AS abbrev,
  CASE WHEN id%2=0 THEN lpad(id::VARCHAR, 6, '0') END AS color,
  CASE WHEN id%2=0 THEN 'ffffff' END AS alt_color
FROM (SELECT home_id AS id, home_mascot AS m FROM schedule
      UNION ALL SELECT away_id, away_mascot FROM schedule) GROUP BY id"""


def schedule_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return schedules.games(_schedules(spark, sf_dir)).withColumn("datetime", _time("datetime"))


SCHEDULE_GAMES = f"""WITH {EVENTS_SQL}
SELECT id, strftime(datetime, '%Y-%m-%d %H:%M:%S') AS datetime, home_id, away_id,
  venue_id, status_id, tbd, NULL::BOOLEAN AS complete_record FROM schedule"""


def discover_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.discover_game_keys(_schedules(spark, sf_dir))


DISCOVER_GAMES = f"""WITH {EVENTS_SQL}
SELECT DISTINCT id::VARCHAR AS document_key, 'game' AS record_type
FROM schedule WHERE id IS NOT NULL"""


def season_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    dates = season_page_dates(_schedules(spark, sf_dir))
    return dates.select("document_key", _text("rep_date"))


def _text(name: str) -> F.Column:
    return F.col(name).cast("string").alias(name)


SEASON_PAGES = """
SELECT o_orderkey::VARCHAR AS document_key,
  strftime(o_orderdate + to_days(CAST(i AS INT)), '%Y-%m-%d') AS rep_date
FROM orders, LATERAL (SELECT unnest(generate_series(0, o_custkey%12)) AS i)
WHERE i%3=1 OR i=o_custkey%12"""


STANDINGS_SQL = """
entries AS (
  SELECT s.*, n.*, 2022+(s_suppkey//20)%30 AS season, s_suppkey//20 AS block
  FROM supplier s JOIN nation n ON s_nationkey=n_nationkey
  WHERE 2022+(s_suppkey//20)%30 BETWEEN 2003 AND 2025 AND s_nationkey%7<>3)"""


def conferences(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standings.conferences(_standings(spark, sf_dir))


CONFERENCES = f"""WITH {STANDINGS_SQL}
SELECT n_nationkey::BIGINT AS id, n_name AS name, 'N'||n_nationkey||'-R'||n_regionkey AS abbrev
FROM (SELECT DISTINCT block, n_nationkey, n_name, n_regionkey FROM entries)"""


def standings_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standings.standings_teams(_standings(spark, sf_dir))


STANDINGS_TEAMS = f"""WITH {STANDINGS_SQL}
SELECT CASE WHEN s_suppkey%13<>5 THEN s_suppkey END AS id, s_name AS location,
  'Mascot '||(s_suppkey%9) AS mascot, 'S'||s_suppkey AS abbrev FROM entries"""


def alignments(spark: SparkSession, sf_dir: str) -> DataFrame:
    return standings.conference_alignments(_standings(spark, sf_dir))


ALIGNMENTS = f"""WITH {STANDINGS_SQL}
SELECT n_nationkey::BIGINT AS conference_id,
  CASE WHEN s_suppkey%13<>5 THEN s_suppkey END AS team_id, season FROM entries"""


GAME_SQL = """
e AS (
  SELECT *, event_id AS n, event_id//200 AS game_id, event_id%200 AS k,
    CASE WHEN event_id%200<100 THEN 1200-(event_id%50)*24 ELSE 300-(event_id%50)*6 END AS left_s,
    100+user_id%2 AS team_id, 1+user_id%16 AS player_id,
    event_type='purchase' AS purchase,
    CASE WHEN event_type='purchase' THEN 1+(event_id%200)%3 ELSE 0 END AS points,
    event_type='purchase' AND value<20 AS scored
  FROM events),
g AS (SELECT game_id, date_trunc('minute', min(ts)) AS began,
        CASE WHEN game_id%11<>5 THEN min(ts) END AS known,
        CASE WHEN game_id%4<>0 THEN 1000+game_id END AS attendance
      FROM e GROUP BY game_id),
flat AS (
  SELECT game_id, CASE WHEN n%97<>0 THEN n END AS sequence_id, props AS text,
    event_type AS description,
    CAST(CASE event_type WHEN 'signup' THEN 584 WHEN 'click' THEN 1 WHEN 'view' THEN 2
         WHEN 'error' THEN 3 ELSE 4 END AS BIGINT) AS play_type_id,
    CASE WHEN k%5=0 THEN upper(event_type) ELSE event_type END AS play_type_text,
    purchase AS is_shot, CAST(points AS BIGINT) AS points_attempted, scored AS is_score,
    CASE WHEN n%31<>0 THEN team_id END AS team_id,
    CASE WHEN n%29<>0 THEN player_id END AS player_id,
    CASE WHEN n%29<>0 AND purchase THEN 1+(player_id+1)%16 END AS assist_id,
    1+k//50 AS period, 'P'||(1+k//50) AS period_display, left_s//60 AS clock_minutes,
    CASE WHEN n%53<>0 THEN left_s%60 END AS clock_seconds, k//5 AS away_score,
    k//4 AS home_score, CASE WHEN purchase THEN k%50 END AS x_coord,
    CASE WHEN purchase THEN k%30 END AS y_coord,
    CASE WHEN n%7<>0 THEN strftime(ts, '%Y-%m-%d %H:%M:%S') END AS timestamp
  FROM e),
lines AS (
  SELECT game_id, team_id, player_id, count(*) AS minutes,
    count(*) FILTER (scored) AS fg_made, count(*) FILTER (purchase) AS fg_attempted,
    count(*) FILTER (event_type='view') AS off_rebounds,
    count(*) FILTER (event_type='click') AS def_rebounds,
    count(*) FILTER (event_type='error') AS steals,
    count(*) FILTER (event_type='signup') AS turnovers,
    CAST(sum(CASE WHEN scored THEN points ELSE 0 END) AS BIGINT) AS points
  FROM e GROUP BY game_id, team_id, player_id),
named AS (
  SELECT *, CASE WHEN player_id%8<>0 THEN 'Last'||player_id END AS last_name,
    CASE WHEN player_id%8<>0 THEN 'First' END AS first_name,
    CASE WHEN player_id%3=0 THEN 'G' ELSE 'F' END AS position,
    player_id<=10 AS started, TRUE AS played, points>5 AS ejected,
    CASE WHEN player_id%2=0 THEN player_id+20 END AS jersey
  FROM lines WHERE player_id<>13)"""


def game_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = game_pages.game_updates(_games(spark, sf_dir))
    return rows.withColumn("datetime", _time("datetime"))


GAME_UPDATES = f"""WITH {GAME_SQL}
SELECT game_id AS id, game_id%2=0 AS is_neutral_site,
  CASE WHEN game_id%3<>0 THEN game_id%5=0 END AS is_conference, TRUE AS has_shot_chart,
  attendance, strftime(began, '%Y-%m-%d %H:%M:%S') AS datetime,
  attendance IS NOT NULL AS complete_record
FROM g WHERE known IS NOT NULL"""


def plays_flat(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = game_pages.plays_flat(_games(spark, sf_dir))
    return rows.withColumn("timestamp", _time("timestamp"))


PLAYS_FLAT = f"WITH {GAME_SQL} SELECT * FROM flat"


def game_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = game_pages.plays(_games(spark, sf_dir))
    return rows.withColumn("timestamp", _time("timestamp"))


GAME_PLAYS = f"""WITH {GAME_SQL}
SELECT game_id, sequence_id, play_type_id, points_attempted, is_score, team_id, player_id,
  assist_id, period, clock_minutes, clock_seconds, home_score, away_score, x_coord, y_coord,
  timestamp FROM flat"""


def play_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_pages.play_types(_games(spark, sf_dir))


PLAY_TYPES = f"""WITH {GAME_SQL}
SELECT play_type_id AS id, min(play_type_text) AS description, play_type_id=4 AS is_shot
FROM flat GROUP BY play_type_id"""


def box_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = game_pages.box_rows(_games(spark, sf_dir))
    return rows.select(
        "game_id", "team_id", "season", "is_totals", "player_id", "first_name", "last_name",
        "position", "started", "played", "ejected", "jersey", "stats.points", "stats.assists",
    )


BOX_ROWS = f"""WITH {GAME_SQL}
SELECT game_id, team_id, year(known)+CASE WHEN month(known)>7 THEN 1 ELSE 0 END AS season,
  FALSE AS is_totals, player_id, first_name, last_name, position, started, played, ejected,
  jersey, CASE WHEN player_id%5<>0 THEN points END AS points,
  CASE WHEN player_id%5<>0 THEN 1::BIGINT END AS assists
FROM named JOIN g USING (game_id)
UNION ALL BY NAME
SELECT game_id, team_id, any_value(year(known)+CASE WHEN month(known)>7 THEN 1 ELSE 0 END) AS season,
  TRUE AS is_totals, CAST(sum(points) AS BIGINT) AS points
FROM lines JOIN g USING (game_id) GROUP BY game_id, team_id"""


def players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_pages.players(_games(spark, sf_dir))


PLAYERS = f"""WITH {GAME_SQL}
SELECT player_id AS id, first_name, last_name, position, NULL::BOOLEAN AS complete_record
FROM named"""


def player_seasons(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_pages.player_seasons(_games(spark, sf_dir))


PLAYER_SEASONS = f"""WITH {GAME_SQL}
SELECT player_id, team_id, year(known)+CASE WHEN month(known)>7 THEN 1 ELSE 0 END AS season,
  jersey FROM named JOIN g USING (game_id)"""


def game_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_pages.game_logs(_games(spark, sf_dir))


GAME_LOGS = f"""WITH {GAME_SQL}
SELECT player_id, game_id, played, started, ejected FROM named"""


def player_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_pages.player_box_scores(_games(spark, sf_dir))


PLAYER_BOX = f"""WITH {GAME_SQL}
SELECT player_id, game_id, minutes, CASE WHEN player_id%5<>0 THEN points END AS points,
  fg_made, fg_attempted, NULL::BIGINT AS fg3_made, NULL::BIGINT AS fg3_attempted,
  off_rebounds, def_rebounds, CASE WHEN player_id%5<>0 THEN 1::BIGINT END AS assists,
  turnovers, steals, 0::BIGINT AS personal_fouls FROM named"""


def team_box(spark: SparkSession, sf_dir: str) -> DataFrame:
    return game_pages.team_box_scores(_games(spark, sf_dir))


TEAM_BOX = f"""WITH {GAME_SQL}
SELECT team_id, game_id, sum(minutes)::BIGINT AS minutes, sum(points)::BIGINT AS points,
  sum(fg_made)::BIGINT AS fg_made, sum(fg_attempted)::BIGINT AS fg_attempted,
  NULL::BIGINT AS fg3_made, NULL::BIGINT AS fg3_attempted,
  sum(off_rebounds)::BIGINT AS off_rebounds, sum(def_rebounds)::BIGINT AS def_rebounds,
  NULL::BIGINT AS assists, sum(turnovers)::BIGINT AS turnovers,
  sum(steals)::BIGINT AS steals, 0::BIGINT AS personal_fouls
FROM lines GROUP BY team_id, game_id"""


def discover_players(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.discover_player_keys(_games(spark, sf_dir))


DISCOVER_PLAYERS = f"""WITH {GAME_SQL}
SELECT DISTINCT player_id::VARCHAR AS document_key, 'player' AS record_type FROM named"""


def player_updates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return player_pages.player_updates(_players(spark, sf_dir))


PLAYER_UPDATES = """
SELECT p_partkey AS id, CASE WHEN p_partkey%10<>0 THEN p_brand END AS birth_city,
  CASE WHEN p_partkey%10<>0 THEN
    CASE WHEN p_partkey%6<>0 THEN p_type WHEN p_partkey%4=0 THEN 'USA' END END AS birth_state,
  CASE WHEN p_partkey%9<>0 THEN 5+p_size%3 END::BIGINT AS height_ft,
  CASE WHEN p_partkey%9<>0 THEN p_size%12 END::BIGINT AS height_in,
  CASE WHEN p_partkey%9<>0 THEN 150+p_size END::BIGINT AS weight, TRUE AS complete_record
FROM part WHERE p_partkey%17<>0"""

def stat_texts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Line items as box score texts: pairs, dashes for missing values, and a column that is not there."""
    q, n = F.col("l_quantity").cast("bigint"), F.col("l_linenumber").cast("bigint")
    missing = F.col("l_orderkey") % 7 == 0
    pair = lambda made, tried: F.concat_ws("-", made.cast("string"), tried.cast("string"))
    names = F.when(F.col("l_orderkey") % 5 == 0, F.array(*map(F.lit, ("PTS", "FG", "MIN")))).otherwise(
        F.array(*map(F.lit, ("PTS", "FG", "3PT", "MIN", "PF"))))
    texts = (F.when(missing, F.lit("--")).otherwise(q.cast("string")), pair(n, n + q))
    stats = F.when(F.col("l_orderkey") % 5 == 0, F.array(*texts, n.cast("string"))).otherwise(
        F.array(*texts, F.when(missing, F.lit("x-1")).otherwise(pair(n, q)), n.cast("string"), F.lit("0")))
    cast = game_pages.cast_stats(F.col("names"), F.col("stats"))
    rows = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", names.alias("names"), stats.alias("stats"))
    return rows.select("l_orderkey", "l_linenumber", cast.alias("cast")).select("l_orderkey", "l_linenumber", "cast.*")


STAT_TEXTS = """
SELECT l_orderkey, l_linenumber, l_linenumber::BIGINT AS minutes,
  CASE WHEN l_orderkey%7<>0 THEN l_quantity::BIGINT END AS points,
  NULL::BIGINT AS off_rebounds, NULL::BIGINT AS def_rebounds, NULL::BIGINT AS assists, NULL::BIGINT AS turnovers,
  NULL::BIGINT AS steals, CASE WHEN l_orderkey%5<>0 THEN 0::BIGINT END AS personal_fouls,
  l_linenumber::BIGINT AS fg_made, (l_linenumber+l_quantity)::BIGINT AS fg_attempted,
  CASE WHEN l_orderkey%5<>0 AND l_orderkey%7<>0 THEN l_linenumber::BIGINT END AS fg3_made,
  CASE WHEN l_orderkey%5<>0 THEN CASE WHEN l_orderkey%7<>0 THEN l_quantity::BIGINT ELSE 1 END END AS fg3_attempted
FROM lineitem"""

QUERIES = {
    "cast_stats": (stat_texts, STAT_TEXTS),
    "schedule_events": (schedule_events, SCHEDULE_EVENTS),
    "schedule_venues": (venues, VENUES),
    "schedule_statuses": (statuses, STATUSES),
    "schedule_teams": (schedule_teams, SCHEDULE_TEAMS),
    "schedule_games": (schedule_games, SCHEDULE_GAMES),
    "season_pages": (season_pages, SEASON_PAGES),
    "standings_conferences": (conferences, CONFERENCES),
    "standings_teams": (standings_teams, STANDINGS_TEAMS),
    "standings_alignments": (alignments, ALIGNMENTS),
    "game_updates": (game_updates, GAME_UPDATES),
    "game_plays_flat": (plays_flat, PLAYS_FLAT),
    "game_plays": (game_plays, GAME_PLAYS),
    "game_play_types": (play_types, PLAY_TYPES),
    "game_box_rows": (box_rows, BOX_ROWS),
    "game_players": (players, PLAYERS),
    "game_player_seasons": (player_seasons, PLAYER_SEASONS),
    "game_game_logs": (game_logs, GAME_LOGS),
    "game_player_box": (player_box, PLAYER_BOX),
    "game_team_box": (team_box, TEAM_BOX),
    "player_updates": (player_updates, PLAYER_UPDATES),
    "discover_games": (discover_games, DISCOVER_GAMES),
    "discover_players": (discover_players, DISCOVER_PLAYERS),
}
