"""Stored tables with their keys and constraints, and the payload schemas.

Table, column and payload field names, keys and constraints are fixed values: stored
data and incoming documents use them as they stand.
"""

from __future__ import annotations

from dataclasses import dataclass
from enum import Enum

from pyspark.sql.types import StructType


@dataclass(frozen=True)
class TableSpec:
    """A stored table: columns, primary key, and rules beyond the key."""

    name: str
    ddl: str
    primary_key: tuple[str, ...]
    not_null: tuple[str, ...] = ()
    non_negative: tuple[str, ...] = ()
    #: parts by a hash of the key, of tables that are updated; only parts with given keys are written anew
    parts: int = 1

    @property
    def schema(self) -> StructType:
        return StructType.fromDDL(self.ddl)

    @property
    def cluster_by(self) -> tuple[str, ...]:
        """Rows of one game are stored together, as they are read together."""
        return ("game_id",) if "game_id" in self.primary_key else ()

    @property
    def columns(self) -> list[str]:
        return self.schema.fieldNames()


_BOX_STATS = (
    "minutes BIGINT, points BIGINT, fg_made BIGINT, fg_attempted BIGINT, "
    "fg3_made BIGINT, fg3_attempted BIGINT, off_rebounds BIGINT, def_rebounds BIGINT, "
    "assists BIGINT, turnovers BIGINT, steals BIGINT, personal_fouls BIGINT"
)

VENUES = TableSpec(
    "Venues", "id BIGINT, name STRING, city STRING, state STRING", ("id",), ("name",)
)
TEAMS = TableSpec(
    "Teams",
    "id BIGINT, location STRING, mascot STRING, abbrev STRING, color STRING, "
    "alt_color STRING",
    ("id",),
)
CONFERENCES = TableSpec(
    "Conferences", "id BIGINT, name STRING, abbrev STRING", ("id",), ("name", "abbrev")
)
CONFERENCE_ALIGNMENTS = TableSpec(
    "ConferenceAlignments",
    "team_id BIGINT, conference_id BIGINT, season BIGINT",
    ("team_id", "conference_id", "season"),
)
PLAY_TYPES = TableSpec(
    "PlayTypes", "id BIGINT, description STRING, is_shot BOOLEAN", ("id",)
)
PLAYERS = TableSpec(
    "Players",
    "id BIGINT, first_name STRING, last_name STRING, position STRING, "
    "height_ft BIGINT, height_in BIGINT, weight BIGINT, birth_city STRING, "
    "birth_state STRING, complete_record BOOLEAN",
    ("id",),
    parts=16,
)
PLAYER_SEASONS = TableSpec(
    "PlayerSeasons",
    "player_id BIGINT, team_id BIGINT, season BIGINT, jersey BIGINT",
    ("player_id", "team_id", "season"),
)
GAME_STATUSES = TableSpec(
    "GameStatuses", "id BIGINT, state STRING, detail STRING", ("id",)
)
GAMES = TableSpec(
    "Games",
    "id BIGINT, datetime TIMESTAMP, home_id BIGINT, away_id BIGINT, venue_id BIGINT, "
    "status_id BIGINT, tbd BOOLEAN, is_neutral_site BOOLEAN, is_conference BOOLEAN, "
    "has_shot_chart BOOLEAN, attendance BIGINT, complete_record BOOLEAN",
    ("id",),
    ("home_id", "away_id", "status_id"),
    parts=16,
)
PLAYS = TableSpec(
    "Plays",
    "game_id BIGINT, sequence_id BIGINT, play_type_id BIGINT, points_attempted BIGINT, "
    "is_score BOOLEAN, team_id BIGINT, player_id BIGINT, assist_id BIGINT, "
    "period BIGINT, clock_minutes BIGINT, clock_seconds BIGINT, home_score BIGINT, "
    "away_score BIGINT, x_coord BIGINT, y_coord BIGINT, timestamp TIMESTAMP",
    ("game_id", "sequence_id"),
    ("play_type_id", "points_attempted", "is_score"),
    ("clock_minutes", "clock_seconds", "home_score", "away_score"),
)
GAME_LOGS = TableSpec(
    "GameLogs",
    "player_id BIGINT, game_id BIGINT, played BOOLEAN, started BOOLEAN, "
    "ejected BOOLEAN",
    ("player_id", "game_id"),
    ("played", "started", "ejected"),
)
PLAYER_BOX_SCORES = TableSpec(
    "PlayerBoxScores",
    f"player_id BIGINT, game_id BIGINT, {_BOX_STATS}",
    ("player_id", "game_id"),
)
TEAM_BOX_SCORES = TableSpec(
    "TeamBoxScores",
    f"team_id BIGINT, game_id BIGINT, {_BOX_STATS}",
    ("team_id", "game_id"),
)

TABLES = {
    spec.name: spec
    for spec in (
        VENUES,
        TEAMS,
        CONFERENCES,
        CONFERENCE_ALIGNMENTS,
        PLAY_TYPES,
        PLAYERS,
        PLAYER_SEASONS,
        GAME_STATUSES,
        GAMES,
        PLAYS,
        GAME_LOGS,
        PLAYER_BOX_SCORES,
        TEAM_BOX_SCORES,
    )
}

DOCUMENTS_DDL = (
    "document_key STRING, record_type STRING, document_timestamp TIMESTAMP, "
    "up_to_date BOOLEAN, payload STRING"
)
MANIFEST_DDL = "document_key STRING, record_type STRING"


class RecordType(Enum):
    """The four kinds of document; keys are dates for schedules, else whole numbers."""

    STANDINGS = "standings"
    SCHEDULE = "schedule"
    GAME = "game"
    PLAYER = "player"

    @classmethod
    def labels(cls) -> list[str]:
        return [t.value for t in cls]

    @classmethod
    def from_label(cls, label: str) -> RecordType | None:
        return next((t for t in cls if t.value == label), None)

    @property
    def has_date_key(self) -> bool:
        return self is RecordType.SCHEDULE


# payload keys not worth storing, as paths
CULL_PATHS: dict[RecordType, tuple[tuple[str, ...], ...]] = {
    RecordType.STANDINGS: (),
    RecordType.SCHEDULE: (),
    RecordType.GAME: (("news",), ("videos",), ("standings",)),
    RecordType.PLAYER: (
        ("app",),
        ("ads",),
        ("page", "content", "teams"),
        ("page", "content", "navigation"),
        ("page", "content", "stndngs"),
    ),
}

_TEAM = "id: STRING, location: STRING, shortDisplayName: STRING, abbrev: STRING"

SCHEDULE_PAYLOAD = f"""page STRUCT<content: STRUCT<
  events: MAP<STRING, ARRAY<STRUCT<
    id: STRING, date: STRING, tbd: BOOLEAN,
    teams: ARRAY<STRUCT<{_TEAM}, teamColor: STRING, altColor: STRING>>,
    venue: STRUCT<id: STRING, fullName: STRING,
                  address: STRUCT<city: STRING, state: STRING>>,
    status: STRUCT<id: STRING, state: STRING, detail: STRING>>>>,
  season: STRUCT<startDate: STRING, endDate: STRING>>>"""

_STANDINGS = f"standings: ARRAY<STRUCT<team: STRUCT<{_TEAM}>>>"
STANDINGS_PAYLOAD = f"""page STRUCT<content: STRUCT<
  headerscoreboard: STRUCT<collegeConfs: ARRAY<STRUCT<
    groupId: STRING, name: STRING, shortName: STRING>>>,
  standings: STRUCT<groups: STRUCT<groups: ARRAY<STRUCT<
    name: STRING, {_STANDINGS}, children: ARRAY<STRUCT<{_STANDINGS}>>>>>>>>"""

GAME_PAYLOAD = """
gameInfo STRUCT<attendance: BIGINT>,
header STRUCT<competitions: ARRAY<STRUCT<
  id: STRING, date: STRING, neutralSite: BOOLEAN, conferenceCompetition: BOOLEAN,
  shotChartAvailable: BOOLEAN>>>,
plays ARRAY<STRUCT<
  sequenceNumber: STRING, text: STRING, shortDescription: STRING,
  type: STRUCT<id: STRING, text: STRING>,
  period: STRUCT<number: BIGINT, displayValue: STRING>,
  clock: STRUCT<displayValue: STRING>, team: STRUCT<id: STRING>,
  coordinate: STRUCT<x: BIGINT, y: BIGINT>, wallclock: STRING,
  participants: ARRAY<STRUCT<athlete: STRUCT<id: STRING>>>,
  shootingPlay: BOOLEAN, scoringPlay: BOOLEAN, pointsAttempted: BIGINT,
  homeScore: BIGINT, awayScore: BIGINT>>,
boxscore STRUCT<players: ARRAY<STRUCT<
  team: STRUCT<id: STRING>,
  statistics: ARRAY<STRUCT<names: ARRAY<STRING>, totals: ARRAY<STRING>,
    athletes: ARRAY<STRUCT<
      athlete: STRUCT<id: STRING, shortName: STRING, displayName: STRING,
                      jersey: STRING, position: STRUCT<abbreviation: STRING>>,
      starter: BOOLEAN, didNotPlay: BOOLEAN, ejected: BOOLEAN,
      stats: ARRAY<STRING>>>>>>>>"""

PLAYER_PAYLOAD = """page STRUCT<content: STRUCT<player: STRUCT<
  plyrHdr: STRUCT<ath: STRUCT<htwt: STRING, brthpl: STRING>>>>>"""

PAYLOADS = {
    RecordType.STANDINGS: STANDINGS_PAYLOAD,
    RecordType.SCHEDULE: SCHEDULE_PAYLOAD,
    RecordType.GAME: GAME_PAYLOAD,
    RecordType.PLAYER: PLAYER_PAYLOAD,
}
