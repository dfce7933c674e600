"""Standings documents as conferences, teams and conference alignments.

A document holds both its conferences and its teams, so teams find their conference
inside their own row and nothing is shuffled.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from courtflow.functions.seasons import is_valid_season
from courtflow.functions.values import excluding, safe_int
from courtflow.operators.keyed import carried
from courtflow.operators.records import raw_key
from courtflow.schemas import RecordType

# fixed value: the entry that stands for all conferences together
ALL_CONFERENCES = "NCAA Division I"


def standings_content(parsed: DataFrame, as_of: Column | dt.date) -> DataFrame:
    """Content of the documents of valid seasons."""
    season = raw_key(F.col("document_key"), RecordType.STANDINGS)
    return (
        parsed.withColumn("season", season)
        .withColumn("content", F.col("parsed.page.content"))
        .filter(is_valid_season(F.col("season"), as_of) & F.col("content").isNotNull())
        .select(*carried(parsed), "season", "content")
    )


def conferences(content: DataFrame) -> DataFrame:
    age = carried(content)
    listed = content.select(
        *age, F.explode("content.headerscoreboard.collegeConfs").alias("conf")
    )
    return listed.filter(F.col("conf.name") != ALL_CONFERENCES).select(
        *age,
        safe_int(F.col("conf.groupId")).alias("id"),
        "conf.name",
        F.col("conf.shortName").alias("abbrev"),
    )


def _teams_of(group: Column) -> Column:
    """Teams listed in a group directly and in its divisions."""
    nobody = F.array().cast("array<struct<team:struct<id:string,location:string,"
                            "shortDisplayName:string,abbrev:string>>>")
    divisions = F.transform(
        group["children"], lambda child: F.coalesce(child["standings"], nobody)
    )
    return F.concat(
        F.coalesce(group["standings"], nobody), F.coalesce(F.flatten(divisions), nobody)
    )


def standing_teams(content: DataFrame) -> DataFrame:
    """Teams of all groups, with the group's name and the document's conferences."""
    age = carried(content)
    groups = content.select(
        *age,
        "season",
        F.col("content.headerscoreboard.collegeConfs").alias("confs"),
        F.explode("content.standings.groups.groups").alias("group"),
    )
    return groups.select(
        *age,
        "season",
        F.col("group.name").alias("conference"),
        "confs",
        F.explode(_teams_of(F.col("group"))).alias("entry"),
    ).select(*age, "season", "conference", "confs", "entry.team.*")


def teams_with_conference(content: DataFrame) -> DataFrame:
    """Teams whose group bears the name of a listed conference."""
    named = F.filter(
        "confs",
        lambda c: (c["name"] == F.col("conference")) & (c["name"] != ALL_CONFERENCES),
    )
    return standing_teams(content).select(
        *carried(content),
        "season",
        F.explode(F.transform(named, lambda c: c["groupId"])).alias("conference_id"),
        F.col("id").alias("team_id"),
        "location",
        F.col("shortDisplayName").alias("mascot"),
        "abbrev",
    ).withColumns(
        {c: safe_int(F.col(c)) for c in ("conference_id", "team_id")}
    )


def standings_teams(content: DataFrame) -> DataFrame:
    teams = teams_with_conference(content).drop("season")
    return excluding(teams.withColumn("id", F.col("team_id")), suffix="_id").select(
        *carried(content), "id", "location", "mascot", "abbrev"
    )


def conference_alignments(content: DataFrame) -> DataFrame:
    return teams_with_conference(content).select(
        *carried(content), "conference_id", "team_id", "season"
    )
