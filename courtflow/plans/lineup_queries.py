"""Registered queries of the lineup analysis, each with its SQL equivalent."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.functions.periods import MENS_RULE, CustomPeriodRule, PeriodRule
from courtflow.operators import lineups, ordering
from courtflow.plans import fixtures

PLAYS_SQL = """
plays AS (
  SELECT g AS game_id, event_id AS sequence_id,
    CASE event_type WHEN 'signup' THEN 584 WHEN 'click' THEN 1 WHEN 'view' THEN 2
                    WHEN 'error' THEN 3 ELSE 4 END AS play_type_id,
    CASE WHEN event_type='purchase' THEN 1+k%3 ELSE 0 END AS points_attempted,
    event_type='purchase' AND value<20 AS is_score,
    100+user_id%2 AS team_id, 1+user_id%16 AS player_id,
    1+k//50 AS period, left_s//60 AS clock_minutes, left_s%60 AS clock_seconds,
    k//4 AS home_score, k//5 AS away_score, ts AS timestamp
  FROM (SELECT *, event_id//200 AS g, event_id%200 AS k,
          CASE WHEN event_id%200<100 THEN 1200-(event_id%50)*24
               ELSE 300-(event_id%50)*6 END AS left_s FROM events) e
)"""

BOOKED_SQL = (
    PLAYS_SQL
    + """,
logs AS (SELECT DISTINCT game_id, player_id FROM plays WHERE player_id<=10),
starts AS (
  SELECT l.game_id, -10*l.player_id AS sequence_id, 584 AS play_type_id, t.team_id,
    l.player_id, 1 AS period, 20 AS clock_minutes, 0 AS clock_seconds
  FROM logs l JOIN (SELECT game_id, player_id, min(team_id) AS team_id FROM plays
                    GROUP BY ALL) t USING (game_id, player_id)),
started_subs AS (
  SELECT game_id, player_id, team_id FROM plays WHERE play_type_id=584
  UNION ALL SELECT game_id, player_id, team_id FROM starts),
finishes AS (
  SELECT f.game_id, -(10*f.player_id+1) AS sequence_id, 584 AS play_type_id, f.team_id,
    f.player_id, g.period, 0 AS clock_minutes, 0 AS clock_seconds
  FROM (SELECT game_id, player_id, max(team_id) AS team_id FROM started_subs
        GROUP BY game_id, player_id HAVING count(*)%2=1) f
  JOIN (SELECT game_id, max(period) AS period FROM plays GROUP BY game_id) g USING (game_id)),
booked AS (
  SELECT * FROM plays
  UNION ALL BY NAME SELECT * FROM starts
  UNION ALL BY NAME SELECT * FROM finishes),
indexed AS (
  SELECT *, row_number() OVER w - 1 AS sub_index,
    lag(period) OVER w AS lp, lag(clock_minutes) OVER w AS lm, lag(clock_seconds) OVER w AS ls
  FROM booked WHERE play_type_id=584
  WINDOW w AS (PARTITION BY game_id, player_id
    ORDER BY period ASC NULLS FIRST, clock_minutes DESC NULLS FIRST,
      clock_seconds DESC NULLS FIRST, home_score ASC NULLS FIRST,
      away_score ASC NULLS FIRST, sequence_id)),
timed AS (
  SELECT *, (20*least(period,2)+5*greatest(period-2,0)) - (20*least(lp,2)+5*greatest(lp-2,0))
    + (lm-clock_minutes) + (ls-clock_seconds)/60.0 AS d, lp IS NULL AS first_row
  FROM indexed)"""
)

_BOOKED_COLUMNS = ("game_id", "sequence_id", "play_type_id", "team_id", "player_id",
                   "period", "clock_minutes", "clock_seconds", "home_score", "away_score")


def _booked(df: DataFrame, *more: str) -> DataFrame:
    return df.select(*[F.col(c).cast("bigint").alias(c) for c in _BOOKED_COLUMNS], *more)


_BOOKED_SELECT = ", ".join(f"CAST({c} AS BIGINT) AS {c}" for c in _BOOKED_COLUMNS)


def sort_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = fixtures.plays(spark, sf_dir)
    return ordering.number_plays(plays).select("game_id", "sequence_id", "place")


SORT_PLAYS = f"""WITH {PLAYS_SQL}
SELECT game_id, sequence_id, row_number() OVER (PARTITION BY game_id
  ORDER BY period ASC NULLS FIRST, clock_minutes DESC NULLS FIRST,
    clock_seconds DESC NULLS FIRST, home_score ASC NULLS FIRST,
    away_score ASC NULLS FIRST, sequence_id) AS place FROM plays"""


def sort_all_plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays = ordering.sorted_positions(fixtures.plays(spark, sf_dir))
    return plays.select("game_id", "sequence_id", "position")


SORT_ALL_PLAYS = f"""WITH {PLAYS_SQL}
SELECT game_id, sequence_id, row_number() OVER (
  ORDER BY game_id, period ASC NULLS FIRST, clock_minutes DESC NULLS FIRST,
    clock_seconds DESC NULLS FIRST, home_score ASC NULLS FIRST,
    away_score ASC NULLS FIRST, sequence_id) AS position FROM plays"""


def _hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A third of the plays are substitutions of one player in one game, without a clock and scores."""
    plays = fixtures.plays(spark, sf_dir)
    hot = F.col("sequence_id") % 3 == 0
    changed = {"game_id": -1, "player_id": 1, "team_id": fixtures.HOME, "play_type_id": lineups.SUB_TYPE_ID, "period": 1}
    nulls = ("clock_minutes", "clock_seconds", "home_score", "away_score")
    return plays.withColumns(
        {c: F.when(hot, F.lit(v)).otherwise(F.col(c)).cast("bigint") for c, v in changed.items()}
        | {c: F.when(~hot, F.col(c)) for c in nulls}
    )


def sub_index_hot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One clock reading of one game with a third of all rows."""
    plays = _hot(spark, sf_dir)
    none = fixtures.game_logs(spark, sf_dir).filter("false")
    return lineups.with_sub_index(plays, none, keyed=True).filter("sequence_id >= 0").select(
        "game_id", "sequence_id", "sub_index"
    )


SUB_INDEX_HOT = f"""WITH {PLAYS_SQL},
h AS (SELECT * REPLACE (
  CASE WHEN sequence_id%3=0 THEN -1 ELSE game_id END AS game_id,
  CASE WHEN sequence_id%3=0 THEN 1 ELSE player_id END AS player_id,
  CASE WHEN sequence_id%3=0 THEN 584 ELSE play_type_id END AS play_type_id,
  CASE WHEN sequence_id%3=0 THEN 1 ELSE period END AS period,
  CASE WHEN sequence_id%3<>0 THEN clock_minutes END AS clock_minutes,
  CASE WHEN sequence_id%3<>0 THEN clock_seconds END AS clock_seconds,
  CASE WHEN sequence_id%3<>0 THEN home_score END AS home_score,
  CASE WHEN sequence_id%3<>0 THEN away_score END AS away_score) FROM plays)
SELECT game_id, sequence_id, row_number() OVER (PARTITION BY game_id, player_id
  ORDER BY period ASC NULLS FIRST, clock_minutes DESC NULLS FIRST,
    clock_seconds DESC NULLS FIRST, home_score ASC NULLS FIRST,
    away_score ASC NULLS FIRST, sequence_id) - 1 AS sub_index FROM h WHERE play_type_id=584
UNION ALL SELECT game_id, sequence_id, -1 FROM h WHERE play_type_id<>584"""


def period_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = F.col("period")
    quarters = PeriodRule(4, 10, 5)
    custom = CustomPeriodRule(quarters.minutes)
    game = F.sequence(F.lit(1).cast("bigint"), p)
    return fixtures.plays(spark, sf_dir).select(
        "sequence_id",
        MENS_RULE.minutes(p).cast("bigint").alias("mens"),
        F.array_join(MENS_RULE.minutes_of_each(game).cast("array<string>"), ",").alias("mens_list"),
        quarters.minutes(p).cast("bigint").alias("quarters"),
        custom.minutes_between(F.lit(0).cast("bigint"), p).cast("bigint").alias("custom_total"),
        MENS_RULE.minutes_between(F.lit(0), p).cast("bigint").alias("mens_total"),
    )


PERIOD_MINUTES = f"""WITH {PLAYS_SQL}
SELECT sequence_id, CAST(CASE WHEN period<=2 THEN 20 ELSE 5 END AS BIGINT) AS mens,
  CASE period WHEN 1 THEN '20' WHEN 2 THEN '20,20' WHEN 3 THEN '20,20,5'
    ELSE '20,20,5,5' END AS mens_list,
  CAST(10 AS BIGINT) AS quarters, 10*period AS custom_total,
  CASE period WHEN 1 THEN 20 WHEN 2 THEN 40 WHEN 3 THEN 45 ELSE 50 END::BIGINT AS mens_total
FROM plays"""


def bookends(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    return _booked(lineups.add_sub_bookends(plays, logs, keyed=True))


BOOKENDS = f"WITH {BOOKED_SQL} SELECT {_BOOKED_SELECT} FROM booked"


def bookends_subs_only(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    return _booked(lineups.add_sub_bookends(plays, logs, keep_non_sub=False, keyed=True))


BOOKENDS_SUBS_ONLY = f"{BOOKENDS} WHERE play_type_id=584"


def bookends_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The plays given twice: one row per (game_id, sequence_id) must remain."""
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    others = plays.filter(lineups.is_other())
    return _booked(lineups.add_sub_bookends(plays.unionByName(others), logs))


def sub_index(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    return _booked(lineups.with_sub_index(plays, logs, keyed=True), "sub_index")


SUB_INDEX = f"""WITH {BOOKED_SQL}
SELECT {_BOOKED_SELECT}, CAST(sub_index AS BIGINT) AS sub_index FROM indexed
UNION ALL
SELECT {_BOOKED_SELECT}, CAST(-1 AS BIGINT) FROM plays WHERE play_type_id<>584"""


def sub_durations(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    timed = lineups.with_sub_durations(plays, logs, keyed=True)
    return timed.select(
        "game_id", "sequence_id", "player_id", "sub_index",
        F.round("sub_duration", 6).alias("sub_duration"),
    )


SUB_DURATIONS = f"""WITH {BOOKED_SQL}
SELECT game_id, CAST(sequence_id AS BIGINT) AS sequence_id, player_id, sub_index,
  round(CAST(d AS DOUBLE), 6) AS sub_duration FROM timed"""


def game_minutes(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    minutes = lineups.game_minutes(plays, logs, keyed=True)
    return minutes.select("game_id", "player_id", F.round("minutes", 6).alias("minutes"))


GAME_MINUTES = f"""WITH {BOOKED_SQL}
SELECT game_id, player_id, round(CAST(sum(d) AS DOUBLE), 6) AS minutes
FROM timed WHERE sub_index%2=1 GROUP BY game_id, player_id"""


def _text(array: str) -> F.Column:
    return F.array_join(F.col(array).cast("array<string>"), ",").alias(array)


def in_play(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    games = fixtures.games(spark, sf_dir)
    return lineups.with_in_play(plays, logs, games, keyed=True).select(
        "game_id", "sequence_id", "play_type_id", "player_id",
        _text("home_in_play"), _text("away_in_play"),
    )


IN_PLAY = f"""WITH RECURSIVE {BOOKED_SQL},
all_rows AS (
  SELECT game_id, sequence_id, play_type_id, player_id, team_id, period, clock_minutes,
    clock_seconds, sub_index FROM indexed
  UNION ALL
  SELECT game_id, sequence_id, play_type_id, player_id, team_id, period, clock_minutes,
    clock_seconds, -1 FROM plays WHERE play_type_id<>584),
ordd AS (
  SELECT *, row_number() OVER (PARTITION BY game_id
    ORDER BY period, clock_minutes DESC, clock_seconds DESC,
      CASE WHEN sequence_id<0 THEN CASE WHEN clock_minutes>0 THEN -1 ELSE 1 END ELSE 0 END,
      sub_index<0, sub_index%2 DESC, team_id, sequence_id) AS n
  FROM all_rows),
f AS (
  SELECT game_id, 0::BIGINT n, NULL::BIGINT sequence_id,
    [-1,-1,-1,-1,-1]::BIGINT[] h, [-1,-1,-1,-1,-1]::BIGINT[] a
  FROM (SELECT DISTINCT game_id FROM ordd)
  UNION ALL
  SELECT o.game_id, o.n, o.sequence_id,
    CASE WHEN o.sub_index>=0 AND o.team_id=100
      THEN list_concat(list_concat(f.h[1:ph-1],[rp]), f.h[ph+1:5]) ELSE f.h END,
    CASE WHEN o.sub_index>=0 AND o.team_id<>100
      THEN list_concat(list_concat(f.a[1:pa-1],[rp]), f.a[pa+1:5]) ELSE f.a END
  FROM f JOIN ordd o ON o.game_id=f.game_id AND o.n=f.n+1
  CROSS JOIN LATERAL (SELECT
    CASE WHEN o.sub_index%2=0 THEN o.player_id ELSE -1 END rp,
    coalesce(nullif(list_position(f.h, CASE WHEN o.sub_index%2=0 THEN -1 ELSE o.player_id END),0),5) ph,
    coalesce(nullif(list_position(f.a, CASE WHEN o.sub_index%2=0 THEN -1 ELSE o.player_id END),0),5) pa))
SELECT p.game_id, p.sequence_id, CAST(p.play_type_id AS BIGINT) AS play_type_id, p.player_id,
  array_to_string(f.h, ',') AS home_in_play, array_to_string(f.a, ',') AS away_in_play
FROM f JOIN plays p ON p.game_id=f.game_id AND p.sequence_id=f.sequence_id"""


def lineup_sets(spark: SparkSession, sf_dir: str) -> DataFrame:
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    games = fixtures.games(spark, sf_dir)
    return lineups.lineup_sets(plays, logs, games, keyed=True).select(
        "game_id", "sequence_id", _text("home_set"), _text("away_set")
    )


LINEUP_SETS = f"""WITH {BOOKED_SQL},
moves AS (SELECT game_id, player_id, team_id, period, clock_minutes, clock_seconds
          FROM indexed WHERE NOT (sequence_id<0 AND clock_minutes=0)),
on_court AS (
  SELECT p.game_id, p.sequence_id, m.player_id, max(m.team_id) AS team_id
  FROM plays p JOIN moves m ON m.game_id=p.game_id
    AND (m.period, -m.clock_minutes, -m.clock_seconds)
     <= (p.period, -p.clock_minutes, -p.clock_seconds)
  GROUP BY p.game_id, p.sequence_id, m.player_id HAVING count(*)%2=1)
SELECT p.game_id, p.sequence_id,
  coalesce(string_agg(o.player_id::VARCHAR, ',' ORDER BY o.player_id) FILTER (o.team_id=100), '') AS home_set,
  coalesce(string_agg(o.player_id::VARCHAR, ',' ORDER BY o.player_id) FILTER (o.team_id<>100), '') AS away_set
FROM plays p LEFT JOIN on_court o USING (game_id, sequence_id)
GROUP BY p.game_id, p.sequence_id"""



def _others_twice(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Plays, those that are no substitutions twice, and game logs.

    Starts and finishes count the substitutions as given, so these stay unique.
    """
    plays = fixtures.plays(spark, sf_dir)
    return plays.unionByName(plays.filter(lineups.is_other())), fixtures.game_logs(spark, sf_dir)


def sub_index_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _booked(lineups.with_sub_index(*_others_twice(spark, sf_dir)), "sub_index")


def sub_durations_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    return lineups.with_sub_durations(*_others_twice(spark, sf_dir)).select(
        "game_id", "sequence_id", "player_id", "sub_index",
        F.round("sub_duration", 6).alias("sub_duration"),
    )


def game_minutes_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    minutes = lineups.game_minutes(*_others_twice(spark, sf_dir))
    return minutes.select("game_id", "player_id", F.round("minutes", 6).alias("minutes"))


def in_play_unkeyed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every play twice: lineups come back for each of the rows given, so for both of a key."""
    plays, logs = fixtures.plays(spark, sf_dir), fixtures.game_logs(spark, sf_dir)
    games = fixtures.games(spark, sf_dir)
    return lineups.with_in_play(plays.unionByName(plays), logs, games).select(
        "game_id", "sequence_id", "play_type_id", "player_id",
        _text("home_in_play"), _text("away_in_play"),
    )


IN_PLAY_UNKEYED = f"SELECT l.* FROM ({IN_PLAY}) l, (VALUES (1), (2)) twice"

QUERIES = {
    "sort_plays": (sort_plays, SORT_PLAYS),
    "sort_all_plays": (sort_all_plays, SORT_ALL_PLAYS),
    "sub_index_hot": (sub_index_hot, SUB_INDEX_HOT),
    "period_minutes": (period_minutes, PERIOD_MINUTES),
    "bookends": (bookends, BOOKENDS),
    "bookends_subs_only": (bookends_subs_only, BOOKENDS_SUBS_ONLY),
    "bookends_unkeyed": (bookends_unkeyed, BOOKENDS),
    "sub_index": (sub_index, SUB_INDEX),
    "sub_durations": (sub_durations, SUB_DURATIONS),
    "game_minutes": (game_minutes, GAME_MINUTES),
    "lineups": (in_play, IN_PLAY),
    "lineup_sets": (lineup_sets, LINEUP_SETS),
    "sub_index_unkeyed": (sub_index_unkeyed, SUB_INDEX),
    "sub_durations_unkeyed": (sub_durations_unkeyed, SUB_DURATIONS),
    "game_minutes_unkeyed": (game_minutes_unkeyed, GAME_MINUTES),
    "lineups_unkeyed": (in_play_unkeyed, IN_PLAY_UNKEYED),
}
