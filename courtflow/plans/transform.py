"""The transform job: pending documents of all four types into the tables."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtflow.operators import discovery, game_pages, player_pages, schedules, standings
from courtflow.operators.keyed import DOCUMENT_TIME
from courtflow.operators.writes import WriteAction
from courtflow.schemas import RecordType
from courtflow.session import DOCUMENT_FILES, scratch_path
from courtflow.sources.documents import DocumentStore, latest_documents, parse_documents
from courtflow.sources.warehouse import Warehouse, Write

INSERT, UPDATE = WriteAction.INSERT, WriteAction.UPDATE
# fields that a document lacks leave stored values as they are
KEEP = {"null_overwrites": False}
# tables must hold a game or player before a later document can complete it
ORDER = (RecordType.STANDINGS, RecordType.SCHEDULE, RecordType.GAME, RecordType.PLAYER)
# which table tells that a document of the type needs no more reading
COMPLETED_IN = {RecordType.GAME: "Games", RecordType.PLAYER: "Players"}


def pending(store: DocumentStore, warehouse: Warehouse, record_type: RecordType) -> DataFrame:
    """Newest documents of a type whose table row is not complete.

    The same documents as those of ``discovery.pending_documents``. Keys and times come
    first: the newest time of each key, without the keys that are complete, picks the
    documents whose payloads are read; only versions of one time meet with payloads.
    """
    documents = store.documents().filter(F.col("record_type") == record_type.value)
    table = COMPLETED_IN.get(record_type)
    if table is None:
        return latest_documents(documents, ["document_key"])
    newest = documents.groupBy(F.col("document_key").alias("_key")).agg(
        F.max("document_timestamp").alias("_newest")
    )
    complete = discovery.complete_ids(warehouse.read_table(table))
    wanted = newest.join(complete, newest["_key"] == complete.id, "left_anti")
    at_newest = F.col("document_timestamp").eqNullSafe(F.col("_newest"))
    picked = documents.join(wanted, (F.col("document_key") == F.col("_key")) & at_newest, "left_semi")
    return latest_documents(picked, ["document_key"])


def standings_writes(parsed: DataFrame, as_of: dt.date) -> list[Write]:
    content = standings.standings_content(parsed, as_of)
    return [
        ("Conferences", INSERT, standings.conferences(content)),
        ("Teams", INSERT, standings.standings_teams(content)),
        ("ConferenceAlignments", INSERT, standings.conference_alignments(content)),
    ]


def schedule_writes(parsed: DataFrame) -> list[Write]:
    return [
        ("Venues", INSERT, schedules.venues(parsed)),
        ("Teams", INSERT, schedules.schedule_teams(parsed)),
        ("GameStatuses", INSERT, schedules.game_statuses(parsed)),
        ("Games", INSERT, schedules.games(parsed)),
    ]


def game_writes(parsed: DataFrame) -> list[Write]:
    return [
        ("Games", UPDATE, game_pages.game_updates(parsed), KEEP),
        ("PlayTypes", INSERT, game_pages.play_types(parsed)),
        ("Players", INSERT, game_pages.players(parsed)),
        ("Plays", INSERT, game_pages.plays(parsed)),
        ("PlayerSeasons", INSERT, game_pages.player_seasons(parsed)),
        ("GameLogs", INSERT, game_pages.game_logs(parsed)),
        ("PlayerBoxScores", INSERT, game_pages.player_box_scores(parsed)),
        ("TeamBoxScores", INSERT, game_pages.team_box_scores(parsed)),
    ]


def player_writes(parsed: DataFrame) -> list[Write]:
    return [("Players", UPDATE, player_pages.player_updates(parsed), KEEP)]


def _staged(parsed: DataFrame, record_type: RecordType) -> DataFrame:
    """The parsed documents as a written table in the shared folder.

    JSON is parsed once; every target table then reads only its nested columns, and a
    lost executor costs no second parse. Rows carry their document's time, so that of
    rows with one key the newest document's is written.
    """
    path = scratch_path(parsed.sparkSession, f"parsed-{record_type.value}")
    rows = parsed.select("document_key", DOCUMENT_TIME, "parsed")
    rows.write.options(**DOCUMENT_FILES).parquet(path)
    return parsed.sparkSession.read.parquet(path)


def transform_all(
    store: DocumentStore, warehouse: Warehouse, as_of: dt.date
) -> dict[RecordType, dict]:
    """Flatten all pending documents; returns affected rows per type and table."""
    rows = {}
    for record_type in ORDER:
        parsed = parse_documents(pending(store, warehouse, record_type), record_type)
        parsed = _staged(parsed, record_type)
        if record_type is RecordType.STANDINGS:
            writes = standings_writes(parsed, as_of)
        elif record_type is RecordType.SCHEDULE:
            writes = schedule_writes(parsed)
        elif record_type is RecordType.GAME:
            writes = game_writes(parsed)
        else:
            writes = player_writes(parsed)
        rows[record_type] = warehouse.write_batch(writes)
    return rows
