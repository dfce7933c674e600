"""Registered queries of the write operators and of the whole transform job."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.operators import writes
from courtflow.operators.records import complete_records
from courtflow.operators.writes import WriteAction
from courtflow.plans import document_fixtures, fixtures
from courtflow.plans.fixtures import table
from courtflow.plans.flatten_queries import (
    AS_OF,
    EVENTS_SQL,
    GAME_SQL,
    PLAYER_UPDATES,
    STANDINGS_SQL,
)
from courtflow.plans.transform import transform_all
from courtflow.schemas import PLAYERS, PLAYS, TABLES, TEAMS
from courtflow.session import scratch_path
from courtflow.sources.documents import DocumentStore
from courtflow.sources.warehouse import Warehouse


def _customer_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS location", "c_mktsegment AS mascot",
        "concat('C', c_nationkey) AS abbrev", "cast(null as string) AS color",
        "cast(null as string) AS alt_color",
    )


def _supplier_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "supplier").selectExpr(
        "s_suppkey AS id", "s_name AS location",
        "CASE WHEN s_acctbal > 5000 THEN 'rich' END AS mascot",
        "concat('S', s_nationkey) AS abbrev", "cast(null as string) AS color",
        "'ffffff' AS alt_color",
    )


def _order_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many rows per id."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey AS id", "o_orderstatus AS location", "o_orderpriority AS mascot"
    )


def drop_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "orders").selectExpr(
        "CASE WHEN o_orderstatus <> 'P' THEN o_orderkey END AS game_id",
        "CASE WHEN o_orderpriority <> '5-LOW' THEN o_custkey END AS sequence_id",
    )
    return writes.drop_null_keys(rows, PLAYS)


DROP_NULL_KEYS = """
SELECT o_orderkey AS game_id, o_custkey AS sequence_id FROM orders
WHERE o_orderstatus<>'P' AND o_orderpriority<>'5-LOW'"""


def insert_ignore(spark: SparkSession, sf_dir: str) -> DataFrame:
    return writes.insert_ignore(
        _supplier_teams(spark, sf_dir), _order_teams(spark, sf_dir), TEAMS
    )


INSERT_IGNORE = """
SELECT s_suppkey AS id, s_name AS location, CASE WHEN s_acctbal>5000 THEN 'rich' END AS mascot,
  'S'||s_nationkey AS abbrev, NULL::VARCHAR AS color, 'ffffff' AS alt_color FROM supplier
UNION ALL
SELECT o_custkey, o_orderstatus, o_orderpriority, NULL, NULL, NULL
FROM (SELECT * FROM orders WHERE NOT EXISTS (SELECT 1 FROM supplier WHERE s_suppkey=o_custkey))
QUALIFY row_number() OVER (PARTITION BY o_custkey ORDER BY o_orderstatus, o_orderpriority)=1"""


def _player_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id", "c_name AS first_name", "c_mktsegment AS last_name",
        "cast(null as string) AS position", "cast(null as bigint) AS height_ft",
        "cast(null as bigint) AS height_in", "cast(c_nationkey as bigint) AS weight",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_mktsegment END AS birth_city",
        "cast(null as string) AS birth_state", "cast(null as boolean) AS complete_record",
    )


def _player_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Several rows per player, and players that are not in the table."""
    return table(spark, sf_dir, "orders").selectExpr(
        "o_custkey + 10 AS id", "o_orderpriority AS birth_city",
        "CASE WHEN o_orderstatus <> 'F' THEN 300 + o_orderkey % 7 END AS weight",
        "true AS complete_record",
    )


_PLAYERS_SQL = """
t AS (
  SELECT c_custkey AS id, c_name AS first_name, c_mktsegment AS last_name,
    NULL::VARCHAR AS position, NULL::BIGINT AS height_ft, NULL::BIGINT AS height_in,
    c_nationkey::BIGINT AS weight,
    CASE WHEN c_mktsegment<>'BUILDING' THEN c_mktsegment END AS birth_city,
    NULL::VARCHAR AS birth_state, NULL::BOOLEAN AS complete_record FROM customer),
s AS (
  SELECT o_custkey+10 AS id, o_orderpriority AS birth_city,
    CASE WHEN o_orderstatus<>'F' THEN 300+o_orderkey%7 END AS weight FROM orders
  QUALIFY row_number() OVER (PARTITION BY id ORDER BY birth_city, weight NULLS LAST)=1)"""


def fill_update(spark: SparkSession, sf_dir: str) -> DataFrame:
    target, rows = _player_rows(spark, sf_dir), _player_changes(spark, sf_dir)
    return writes.fill_update(target, rows, PLAYERS)


FILL_UPDATE = f"""WITH {_PLAYERS_SQL}
SELECT t.* REPLACE (
  CASE WHEN s.id IS NOT NULL AND t.birth_city IS NULL THEN s.birth_city ELSE t.birth_city END AS birth_city,
  CASE WHEN s.id IS NOT NULL AND t.birth_city IS NULL THEN s.weight ELSE t.weight END AS weight,
  CASE WHEN s.id IS NOT NULL AND t.birth_city IS NULL THEN TRUE END AS complete_record)
FROM t LEFT JOIN s ON s.id=t.id"""


def fill_update_guarded(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Guarded by another column; nulls leave stored values alone."""
    target, rows = _player_rows(spark, sf_dir), _player_changes(spark, sf_dir)
    return writes.fill_update(
        target, rows, PLAYERS, guard="complete_record",
        columns=["birth_city", "weight"], null_overwrites=False,
    )


FILL_UPDATE_GUARDED = f"""WITH {_PLAYERS_SQL}
SELECT t.* REPLACE (coalesce(s.birth_city, t.birth_city) AS birth_city,
  coalesce(s.weight, t.weight) AS weight)
FROM t LEFT JOIN s ON s.id=t.id"""


def upsert(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = _supplier_teams(spark, sf_dir).drop("color", "abbrev")
    rows = rows.withColumn("id", F.col("id") * 20)
    return writes.upsert(_customer_teams(spark, sf_dir), rows, TEAMS)


UPSERT = """
SELECT coalesce(c_custkey, s_suppkey*20) AS id,
  CASE WHEN s_suppkey IS NOT NULL THEN s_name ELSE c_name END AS location,
  CASE WHEN s_suppkey IS NOT NULL THEN CASE WHEN s_acctbal>5000 THEN 'rich' END
       ELSE c_mktsegment END AS mascot,
  CASE WHEN c_custkey IS NOT NULL THEN 'C'||c_nationkey END AS abbrev, NULL::VARCHAR AS color,
  CASE WHEN s_suppkey IS NOT NULL THEN 'ffffff' END AS alt_color
FROM customer FULL JOIN supplier ON c_custkey=s_suppkey*20"""


def _faulty_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    k = F.col("sequence_id") % 9
    return (
        fixtures.plays(spark, sf_dir)
        .withColumn("game_id", F.when(k != 1, F.col("game_id")))
        .withColumn("is_score", F.when(k != 2, F.col("is_score")))
        .withColumn("clock_seconds", F.when(k == 3, F.lit(-1)).when(k != 4, F.col("clock_seconds")))
        .withColumn("home_score", F.when(k == 3, F.lit(-5)).otherwise(F.col("home_score")))
    )


def constraint_check(spark: SparkSession, sf_dir: str) -> DataFrame:
    valid, bad = writes.constraint_check(_faulty_plays(spark, sf_dir), PLAYS)
    shown = ("sequence_id", "reject_reason")
    return valid.withColumn("reject_reason", F.lit("")).select(*shown).unionByName(
        bad.select(*shown)
    )


CONSTRAINT_CHECK = """
SELECT event_id AS sequence_id, CASE event_id%9 WHEN 1 THEN 'game_id is null in key'
  WHEN 2 THEN 'is_score is null' WHEN 3 THEN 'clock_seconds is negative' ELSE '' END
  AS reject_reason FROM events"""


def write_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Three batches into one warehouse; what the tables hold in the end."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse")).create_tables()
    suppliers = _supplier_teams(spark, sf_dir)
    insert = [
        ("Teams", WriteAction.INSERT, suppliers),
        ("Teams", WriteAction.INSERT, _customer_teams(spark, sf_dir).drop("color")),
        ("Players", WriteAction.INSERT, _player_rows(spark, sf_dir)),
    ]
    warehouse.write_batch(insert)
    warehouse.write_batch(insert)
    warehouse.write_batch(
        [
            ("Players", WriteAction.UPDATE, _player_changes(spark, sf_dir)),
            ("Teams", WriteAction.UPSERT, suppliers.select("id", "mascot")),
        ]
    )
    teams = warehouse.read_table("Teams").select(
        F.lit("Teams").alias("name"), "id", F.col("location").alias("a"), F.col("mascot").alias("b"),
    )
    players = warehouse.read_table("Players").select(
        F.lit("Players").alias("name"), "id", F.col("birth_city").alias("a"),
        F.col("weight").cast("string").alias("b"),
    )
    return teams.unionByName(players)


WRITE_BATCH = f"""WITH {_PLAYERS_SQL}
SELECT 'Teams' AS name, c_custkey AS id, least(c_name, s_name) AS a,
  CASE WHEN s_suppkey IS NOT NULL THEN CASE WHEN s_acctbal>5000 THEN 'rich' END
       ELSE c_mktsegment END AS b
FROM customer LEFT JOIN supplier ON c_custkey=s_suppkey
UNION ALL
SELECT 'Players', t.id,
  CASE WHEN s.id IS NOT NULL AND t.birth_city IS NULL THEN s.birth_city ELSE t.birth_city END,
  (CASE WHEN s.id IS NOT NULL AND t.birth_city IS NULL THEN s.weight ELSE t.weight END)::VARCHAR
FROM t LEFT JOIN s ON s.id=t.id"""


def _transformed(spark: SparkSession, sf_dir: str) -> Warehouse:
    """All documents of the fixtures, stored and transformed."""
    store = DocumentStore(spark, scratch_path(spark, "store")).create()
    for build in (
        document_fixtures.standings,
        document_fixtures.schedules,
        document_fixtures.games,
        document_fixtures.players,
    ):
        documents = build(spark, sf_dir)
        # pages of odd keys first, so that of schedules the even ones are newer
        for parity in (1, 0):
            part = documents.filter(F.col("document_key").cast("bigint") % 2 == parity)
            store.append_documents(complete_records(part, AS_OF))
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse")).create_tables()
    transform_all(store, warehouse, AS_OF)
    return warehouse


def transform_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per table after the job."""
    warehouse = _transformed(spark, sf_dir)
    counts = [
        warehouse.read_table(name).agg(F.count(F.lit(1)).alias("n")).select(F.lit(name).alias("name"), "n")
        for name in TABLES
    ]
    return writes.union_rows(counts)


def transform_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games from schedules, completed by game documents."""
    games = _transformed(spark, sf_dir).read_table("Games")
    return games.withColumn("datetime", F.date_format("datetime", "yyyy-MM-dd HH:mm:ss"))


TRANSFORM_GAMES = f"""WITH {EVENTS_SQL}, {GAME_SQL}
SELECT s.id, strftime(coalesce(CASE WHEN g.known IS NOT NULL THEN g.began END, s.datetime),
    '%Y-%m-%d %H:%M:%S') AS datetime,
  home_id, away_id, venue_id, status_id, tbd,
  CASE WHEN g.known IS NOT NULL THEN g.game_id%2=0 END AS is_neutral_site,
  CASE WHEN g.known IS NOT NULL AND g.game_id%3<>0 THEN g.game_id%5=0 END AS is_conference,
  CASE WHEN g.known IS NOT NULL THEN TRUE END AS has_shot_chart,
  CASE WHEN g.known IS NOT NULL THEN g.attendance END AS attendance,
  CASE WHEN g.known IS NOT NULL THEN g.attendance IS NOT NULL END AS complete_record
FROM schedule s LEFT JOIN g ON g.game_id=s.id WHERE s.id IS NOT NULL"""



def transform_teams(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Teams from standings, others as the newest schedule page names them."""
    return _transformed(spark, sf_dir).read_table("Teams")


TRANSFORM_TEAMS = f"""WITH {EVENTS_SQL}, {STANDINGS_SQL},
standing AS (
  SELECT DISTINCT s_suppkey AS id, s_name AS location, 'Mascot '||(s_suppkey%9) AS mascot,
    'S'||s_suppkey AS abbrev, NULL::VARCHAR AS color, NULL::VARCHAR AS alt_color
  FROM entries WHERE s_suppkey%13<>5),
sides AS (
  SELECT n%360 AS id, 'Mascot '||(n%3) AS mascot, o_orderkey%2 AS older FROM ev
  UNION ALL SELECT (n*7+1)%360, 'Mascot '||(n%5), o_orderkey%2 FROM ev)
SELECT * FROM standing
UNION ALL
SELECT id, 'City '||id, mascot, 'T'||id, CASE WHEN id%2=0 THEN lpad(id::VARCHAR, 6, '0') END,
  CASE WHEN id%2=0 THEN 'ffffff' END
FROM sides WHERE id NOT IN (SELECT id FROM standing)
QUALIFY row_number() OVER (PARTITION BY id ORDER BY older, mascot)=1"""


#: Tables shown row by row after the job: keys, then what is shown of the other columns.
_SHOWN = {
    "Players": (["id"], ["first_name", "last_name", "position", "height_ft", "height_in", "weight",
                         "birth_city", "birth_state", "complete_record"]),
    "GameLogs": (["game_id", "player_id"], ["played", "started", "ejected"]),
    "Plays": (["game_id", "sequence_id"], [
        "play_type_id", "points_attempted", "is_score", "team_id", "player_id", "assist_id", "period", "clock_minutes",
        "clock_seconds", "home_score", "away_score", "x_coord", "y_coord", "timestamp"]),
}


def transform_contents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What the job wrote to Players, GameLogs and Plays, one row a row."""
    warehouse = _transformed(spark, sf_dir)
    shown = []
    for name, (keys, columns) in _SHOWN.items():
        rows = warehouse.read_table(name)
        if "timestamp" in columns:
            rows = rows.withColumn("timestamp", F.date_format("timestamp", "yyyy-MM-dd HH:mm:ss"))
        text = [F.coalesce(F.col(c).cast("string"), F.lit("-")) for c in columns]
        first, second = (F.col(k) if k else F.lit(0) for k in (*keys, None)[:2])
        shown.append(rows.select(
            F.lit(name).alias("name"), first.cast("bigint").alias("key"), second.cast("bigint").alias("second_key"),
            F.concat_ws("|", *text).alias("content")))
    return writes.union_rows(shown)


def _shown_sql(name: str) -> str:
    keys, columns = _SHOWN[name]
    text = ", ".join(f"coalesce({c}::VARCHAR, '-')" for c in columns)
    return f"'{name}' AS name, {keys[0]} AS key, {(*keys, 0)[1]}::BIGINT AS second_key, concat_ws('|', {text}) AS content"


TRANSFORM_CONTENTS = f"""WITH {GAME_SQL},
changes AS ({PLAYER_UPDATES}),
known_players AS (SELECT DISTINCT player_id AS id, first_name, last_name, position FROM named),
players AS (SELECT k.*, height_ft, height_in, weight, birth_city, birth_state, complete_record
  FROM known_players k LEFT JOIN changes USING (id))
SELECT {_shown_sql('Players')} FROM players
UNION ALL SELECT {_shown_sql('GameLogs')} FROM named
UNION ALL SELECT {_shown_sql('Plays')} FROM flat WHERE sequence_id IS NOT NULL"""


def write_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Faulty plays written twice; each reject is listed once."""
    warehouse = Warehouse(spark, scratch_path(spark, "warehouse")).create_tables()
    for _ in range(2):
        warehouse.write_batch([("Plays", WriteAction.INSERT, _faulty_plays(spark, sf_dir))])
    return warehouse.rejects("Plays").select("sequence_id", "reject_reason")


WRITE_REJECTS = f"""SELECT * FROM ({CONSTRAINT_CHECK}) WHERE reject_reason<>''"""

TRANSFORM_COUNTS = f"""WITH {EVENTS_SQL}, {GAME_SQL}, {STANDINGS_SQL}
SELECT 'Venues' AS name, count(DISTINCT venue_id) AS n FROM schedule
UNION ALL SELECT 'Teams', count(*) FROM (
  SELECT home_id FROM schedule UNION SELECT away_id FROM schedule
  UNION SELECT s_suppkey FROM entries WHERE s_suppkey%13<>5)
UNION ALL SELECT 'Conferences', count(DISTINCT n_nationkey) FROM entries
UNION ALL SELECT 'ConferenceAlignments', count(*) FROM (
  SELECT DISTINCT season, n_nationkey, s_suppkey FROM entries WHERE s_suppkey%13<>5)
UNION ALL SELECT 'PlayTypes', count(DISTINCT play_type_id) FROM flat
UNION ALL SELECT 'Players', count(DISTINCT player_id) FROM named
UNION ALL SELECT 'PlayerSeasons', count(*) FROM (
  SELECT DISTINCT player_id, team_id, year(known), month(known)>7
  FROM named JOIN g USING (game_id) WHERE known IS NOT NULL)
UNION ALL SELECT 'GameStatuses', count(DISTINCT status_id) FROM schedule
UNION ALL SELECT 'Games', count(DISTINCT id) FROM schedule
UNION ALL SELECT 'Plays', count(DISTINCT (game_id, sequence_id)) FROM flat WHERE sequence_id IS NOT NULL
UNION ALL SELECT 'GameLogs', count(DISTINCT (game_id, player_id)) FROM named
UNION ALL SELECT 'PlayerBoxScores', count(DISTINCT (game_id, player_id)) FROM named
UNION ALL SELECT 'TeamBoxScores', count(DISTINCT (game_id, team_id)) FROM lines"""

QUERIES = {
    "drop_null_keys": (drop_null_keys, DROP_NULL_KEYS),
    "insert_ignore": (insert_ignore, INSERT_IGNORE),
    "fill_update": (fill_update, FILL_UPDATE),
    "fill_update_guarded": (fill_update_guarded, FILL_UPDATE_GUARDED),
    "upsert": (upsert, UPSERT),
    "constraint_check": (constraint_check, CONSTRAINT_CHECK),
    "write_batch": (write_batch, WRITE_BATCH),
    "transform_games": (transform_games, TRANSFORM_GAMES),
    "transform_teams": (transform_teams, TRANSFORM_TEAMS),
    "write_rejects": (write_rejects, WRITE_REJECTS),
    "transform_contents": (transform_contents, TRANSFORM_CONTENTS),
    "transform_counts": (transform_counts, TRANSFORM_COUNTS),
}
