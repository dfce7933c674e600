"""Which keys documents mention, and which documents are still to be fetched or read.

All are set operations on distinct keys: each side is reduced to keys on the map side
before it is shuffled, so repeated keys cost little.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtflow.functions.values import safe_int
from courtflow.operators.keyed import absent_from
from courtflow.schemas import RecordType


def _as_keys(ids: DataFrame, record_type: RecordType) -> DataFrame:
    return (
        ids.select(safe_int(F.col("id")).alias("id"))
        .dropna()
        .distinct()
        .select(
            F.col("id").cast("string").alias("document_key"),
            F.lit(record_type.value).alias("record_type"),
        )
    )


def discover_game_keys(schedules: DataFrame) -> DataFrame:
    """Ids of all events of parsed schedule documents."""
    days = schedules.select(
        F.explode(F.map_values("parsed.page.content.events")).alias("events")
    )
    return _as_keys(days.select(F.explode("events.id").alias("id")), RecordType.GAME)


def discover_player_keys(games: DataFrame) -> DataFrame:
    """Ids of all athletes of parsed game documents, from the first statistics table."""
    boxes = games.select(F.explode("parsed.boxscore.players").alias("box"))
    athletes = F.get("box.statistics", F.lit(0))["athletes"]["athlete"]["id"]
    return _as_keys(boxes.select(F.explode(athletes).alias("id")), RecordType.PLAYER)


def unseen_keys(keys: DataFrame, manifest: DataFrame) -> DataFrame:
    """Keys the manifest does not hold yet."""
    return absent_from(keys, manifest, ["document_key", "record_type"], few=True)


def existing_keys(documents: DataFrame, record_type: RecordType) -> DataFrame:
    """Keys of the documents of a type that are up to date."""
    return documents.filter(
        (F.col("record_type") == record_type.value)
        & F.coalesce("up_to_date", F.lit(False))
    ).select("document_key")


def discovered_keys(
    manifest: DataFrame, documents: DataFrame, record_type: RecordType
) -> DataFrame:
    """Manifest keys of a type that have no up-to-date document."""
    found = manifest.filter(F.col("record_type") == record_type.value)
    existing = existing_keys(documents, record_type)
    return absent_from(found.select("document_key").distinct(), existing, ["document_key"])


def complete_ids(table: DataFrame) -> DataFrame:
    """Ids, as text, of the rows of a table that are complete."""
    complete = F.coalesce("complete_record", F.lit(False))
    return table.filter(complete).select(F.col("id").cast("string").alias("id"))


def pending_documents(
    documents: DataFrame, complete: DataFrame, record_type: RecordType
) -> DataFrame:
    """Distinct keys of a type whose table row is not complete."""
    keys = documents.filter(F.col("record_type") == record_type.value)
    complete = complete.select(F.col("id").alias("document_key"))
    return absent_from(keys.select("document_key").distinct(), complete, ["document_key"])


def keys_to_fetch(requested: DataFrame, existing: DataFrame) -> DataFrame:
    """Requested keys, each once, without the existing ones."""
    return absent_from(
        requested.select("document_key").distinct(), existing, ["document_key"], few=True
    )
