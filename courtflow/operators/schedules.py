"""Schedule documents as venues, game statuses, teams and games."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtflow.functions.values import safe_int, safe_timestamp
from courtflow.operators.keyed import carried, distinct_rows, one_per_key

# fixed value: details of games that went to overtime read like "Final/2OT"
OVERTIME_DETAIL = r"(.+)/\d*OT$"


def schedule_events(parsed: DataFrame) -> DataFrame:
    """One row per event; events are listed by day."""
    age = carried(parsed)
    days = parsed.select(
        *age, F.explode(F.map_values("parsed.page.content.events")).alias("day")
    )
    return days.select(*age, F.explode("day").alias("event")).select(
        *age,
        safe_int(F.col("event.id")).alias("id"),
        safe_timestamp(F.col("event.date")).alias("datetime"),
        "event.tbd",
        "event.teams",
        "event.venue",
        "event.status",
    )


def venues(parsed: DataFrame) -> DataFrame:
    return (
        schedule_events(parsed)
        .filter("venue IS NOT NULL")
        .select(
            *carried(parsed),
            safe_int(F.col("venue.id")).alias("id"),
            F.col("venue.fullName").alias("name"),
            "venue.address.city",
            "venue.address.state",
        )
    )


def game_statuses(parsed: DataFrame) -> DataFrame:
    """Distinct statuses, with the overtime suffix cut from the detail.

    Insertion order means nothing to a table; sort at output where it matters.
    """
    detail = F.regexp_replace("status.detail", OVERTIME_DETAIL, "$1")
    return distinct_rows(
        schedule_events(parsed).select(
            *carried(parsed),
            safe_int(F.col("status.id")).alias("id"),
            "status.state",
            detail.alias("detail"),
        )
    )


def schedule_teams(parsed: DataFrame) -> DataFrame:
    """One row per team id."""
    age = carried(parsed)
    teams = schedule_events(parsed).select(*age, F.explode("teams").alias("team"))
    rows = teams.select(
        *age,
        "team.id",
        "team.location",
        F.col("team.shortDisplayName").alias("mascot"),
        "team.abbrev",
        F.col("team.teamColor").alias("color"),
        F.col("team.altColor").alias("alt_color"),
    )
    return one_per_key(rows, ["id"]).withColumn("id", safe_int(F.col("id")))


def games(parsed: DataFrame) -> DataFrame:
    """Games; the first team is at home. Completed later, from the game document."""

    def team(position: int) -> F.Column:
        return safe_int(F.get("teams", F.lit(position))["id"])

    return schedule_events(parsed).select(
        *carried(parsed),
        "id",
        "datetime",
        team(0).alias("home_id"),
        team(1).alias("away_id"),
        safe_int(F.col("venue.id")).alias("venue_id"),
        safe_int(F.col("status.id")).alias("status_id"),
        "tbd",
        F.lit(None).cast("boolean").alias("complete_record"),
    )
