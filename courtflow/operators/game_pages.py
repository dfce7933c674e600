"""Game documents as plays, players, box scores and game updates."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtflow.functions.seasons import season_of
from courtflow.functions.values import matched, part, safe_int, safe_timestamp
from courtflow.operators.keyed import carried, distinct_rows, one_per_key
from courtflow.operators.records import raw_key
from courtflow.schemas import RecordType

# fixed values: names of the box score columns and where they go
WHOLE_STATS = {
    "minutes": "MIN",
    "points": "PTS",
    "off_rebounds": "OREB",
    "def_rebounds": "DREB",
    "assists": "AST",
    "turnovers": "TO",
    "steals": "STL",
    "personal_fouls": "PF",
}
MADE_ATTEMPTED_STATS = {"fg": "FG", "fg3": "3PT"}
# short names read like "J. Doe"
LAST_NAME = r"[A-Za-z]+\. (.+)"
NO_TEAM = -1


def _game_id() -> Column:
    return raw_key(F.col("document_key"), RecordType.GAME)


def game_updates(parsed: DataFrame) -> DataFrame:
    """What the game page adds to a game; complete once attendance is known."""
    attendance = F.col("parsed.gameInfo.attendance")
    age = carried(parsed)
    return parsed.select(
        *age,
        F.explode("parsed.header.competitions").alias("game"),
        attendance.alias("attendance"),
    ).select(
        *age,
        safe_int(F.col("game.id")).alias("id"),
        F.col("game.neutralSite").alias("is_neutral_site"),
        F.col("game.conferenceCompetition").alias("is_conference"),
        F.col("game.shotChartAvailable").alias("has_shot_chart"),
        "attendance",
        safe_timestamp(F.col("game.date")).alias("datetime"),
        F.col("attendance").isNotNull().alias("complete_record"),
    )


def plays_flat(parsed: DataFrame) -> DataFrame:
    """All fields of all plays."""

    def athlete(entry: Column) -> Column:
        return safe_int(entry["athlete"]["id"])

    involved = F.col("play.participants")
    clock = F.col("play.clock.displayValue")
    age = carried(parsed)
    return parsed.select(
        *age, _game_id().alias("game_id"), F.explode("parsed.plays").alias("play")
    ).select(
        *age,
        "game_id",
        safe_int(F.col("play.sequenceNumber")).alias("sequence_id"),
        "play.text",
        F.col("play.shortDescription").alias("description"),
        safe_int(F.col("play.type.id")).alias("play_type_id"),
        F.col("play.type.text").alias("play_type_text"),
        F.col("play.shootingPlay").alias("is_shot"),
        F.col("play.pointsAttempted").alias("points_attempted"),
        F.col("play.scoringPlay").alias("is_score"),
        safe_int(F.col("play.team.id")).alias("team_id"),
        athlete(F.get(involved, F.lit(0))).alias("player_id"),
        # the last one named assists
        F.when(F.size(involved) > 1, athlete(F.element_at(involved, -1))).alias("assist_id"),
        F.col("play.period.number").alias("period"),
        F.col("play.period.displayValue").alias("period_display"),
        safe_int(part(clock, ":", 0)).alias("clock_minutes"),
        safe_int(part(clock, ":", 1)).alias("clock_seconds"),
        F.col("play.awayScore").alias("away_score"),
        F.col("play.homeScore").alias("home_score"),
        F.col("play.coordinate.x").alias("x_coord"),
        F.col("play.coordinate.y").alias("y_coord"),
        safe_timestamp(F.col("play.wallclock")).alias("timestamp"),
    )


def play_types(parsed: DataFrame) -> DataFrame:
    types = plays_flat(parsed).select(
        *carried(parsed),
        F.col("play_type_id").alias("id"),
        F.col("play_type_text").alias("description"),
        "is_shot",
    )
    # few distinct rows remain on the map side
    return one_per_key(distinct_rows(types), ["id"])


def plays(parsed: DataFrame) -> DataFrame:
    return plays_flat(parsed).select(
        *carried(parsed), "game_id", "sequence_id", "play_type_id", "points_attempted", "is_score",
        "team_id", "player_id", "assist_id", "period", "clock_minutes",
        "clock_seconds", "home_score", "away_score", "x_coord", "y_coord", "timestamp",
    )


def cast_stats(names: Column, stats: Column) -> Column:
    """Box score texts, looked up by column name, as a struct of whole numbers."""

    def text(name: str) -> Column:
        return F.get(stats, F.array_position(names, F.lit(name)) - 1)

    whole = [safe_int(text(n)).alias(out) for out, n in WHOLE_STATS.items()]
    pairs = [
        safe_int(part(text(n), "-", i)).alias(f"{out}_{what}")
        for out, n in MADE_ATTEMPTED_STATS.items()
        for i, what in enumerate(("made", "attempted"))
    ]
    return F.struct(*whole, *pairs)


def box_rows(parsed: DataFrame) -> DataFrame:
    """One row per athlete and, per team with athletes, one row of totals."""
    season = season_of(
        safe_timestamp(F.get("parsed.header.competitions", F.lit(0))["date"])
    )
    age = carried(parsed)
    teams = parsed.select(
        *age,
        _game_id().alias("game_id"),
        season.cast("bigint").alias("season"),
        F.explode("parsed.boxscore.players").alias("box"),
    ).select(
        *age,
        "game_id",
        "season",
        F.when(F.col("box.team.id").isNull(), F.lit(NO_TEAM))
        .otherwise(safe_int(F.col("box.team.id")))
        .alias("team_id"),
        F.get("box.statistics", F.lit(0)).alias("table"),
    )
    entry = F.struct(F.col("game_id"), F.col("season"), F.col("team_id"))
    athletes = F.filter("table.athletes", lambda a: a["athlete"]["id"].isNotNull())
    # totals travel as one more entry, so the table is unfolded in one pass
    named = F.transform(
        athletes,
        lambda a: F.struct(
            F.lit(False).alias("is_totals"), a.alias("line"), a["stats"].alias("stats")
        ),
    )
    totals = F.transform(
        F.slice(athletes, 1, 1),
        lambda a: F.struct(
            F.lit(True).alias("is_totals"),
            F.when(F.lit(False), a).alias("line"),
            F.col("table.totals").alias("stats"),
        ),
    )
    last = matched(F.col("line.athlete.shortName"), LAST_NAME)
    full = F.col("line.athlete.displayName")
    first = F.when(
        full.endswith(last), F.left(full, F.length(full) - F.length(last))
    ).when(last.isNotNull(), full)
    return (
        teams.select(
            *age,
            entry.alias("of"),
            F.col("table.names").alias("names"),
            F.explode(F.concat(named, totals)).alias("row"),
        )
        .select(*age, "of.*", "names", "row.*")
        .select(
            *age,
            "game_id",
            "season",
            "team_id",
            "is_totals",
            safe_int(F.col("line.athlete.id")).alias("player_id"),
            F.trim(first).alias("first_name"),
            last.alias("last_name"),
            F.col("line.athlete.position.abbreviation").alias("position"),
            F.col("line.starter").alias("started"),
            (~F.col("line.didNotPlay")).alias("played"),
            F.col("line.ejected").alias("ejected"),
            safe_int(F.col("line.athlete.jersey")).alias("jersey"),
            cast_stats(F.col("names"), F.col("stats")).alias("stats"),
        )
    )


def _athletes(parsed: DataFrame) -> DataFrame:
    return box_rows(parsed).filter(~F.col("is_totals"))


def players(parsed: DataFrame) -> DataFrame:
    """Players; completed later, from the player document."""
    return _athletes(parsed).select(
        *carried(parsed),
        F.col("player_id").alias("id"),
        "first_name",
        "last_name",
        "position",
        F.lit(None).cast("boolean").alias("complete_record"),
    )


def player_seasons(parsed: DataFrame) -> DataFrame:
    return _athletes(parsed).select(
        *carried(parsed), "player_id", "team_id", "season", "jersey"
    )


def game_logs(parsed: DataFrame) -> DataFrame:
    return _athletes(parsed).select("player_id", "game_id", "played", "started", "ejected")


def player_box_scores(parsed: DataFrame) -> DataFrame:
    return _athletes(parsed).select("player_id", "game_id", "stats.*")


def team_box_scores(parsed: DataFrame) -> DataFrame:
    return box_rows(parsed).filter("is_totals").select("team_id", "game_id", "stats.*")
