"""Which documents of a type are still to be fetched, and ingest in stages.

Standings come first, then schedules, games and players, each type reading the keys
that the documents before it brought to light.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.functions.seasons import season_page_dates
from courtflow.operators.discovery import discovered_keys, existing_keys, keys_to_fetch
from courtflow.operators.records import document_key
from courtflow.schemas import RecordType
from courtflow.session import scratch_path
from courtflow.sources.documents import DocumentStore
from courtflow.streaming.ingest import FLUSH_FILES, ingest_stream, landed_records


def standings_to_fetch(seasons: DataFrame, store: DocumentStore) -> DataFrame:
    """Keys of the requested seasons (column ``season``) that can still change."""
    key = document_key(F.col("season"), RecordType.STANDINGS)
    requested = seasons.select(key.alias("document_key"))
    return keys_to_fetch(requested, existing_keys(store.documents(), RecordType.STANDINGS))


def schedules_to_fetch(first_pages: DataFrame, store: DocumentStore) -> DataFrame:
    """Keys of the days that cover the seasons of the parsed first schedule pages."""
    key = document_key(F.col("rep_date"), RecordType.SCHEDULE)
    requested = season_page_dates(first_pages).select(key.alias("document_key"))
    return keys_to_fetch(requested, existing_keys(store.documents(), RecordType.SCHEDULE))


def discovered_to_fetch(store: DocumentStore, record_type: RecordType) -> DataFrame:
    """Games or players that the manifest knows and no up-to-date document covers."""
    return discovered_keys(store.manifest(), store.documents(), record_type)


def ingest_staged(
    spark: SparkSession,
    landing: str,
    store: DocumentStore,
    as_of: dt.date,
    checkpoint: str,
    listed_only: bool = False,
    files: int = FLUSH_FILES,
) -> None:
    """Ingest what has landed in one folder per type, type by type.

    ``listed_only`` takes of games and players those alone that the documents of earlier stages
    brought to light: a stage's work list is written when it begins, and meets the stream
    batch by batch. A run that died is run again with the same checkpoint.
    """
    for record_type in RecordType:
        name = record_type.value
        records = landed_records(spark, f"{landing}/{name}", files)
        if listed_only and record_type in (RecordType.GAME, RecordType.PLAYER):
            path = scratch_path(spark, f"listed-{name}")
            discovered_to_fetch(store, record_type).select("document_key").write.parquet(path)
            records = records.join(spark.read.parquet(path), "document_key", "left_semi")
        ingest_stream(
            records, store, as_of, f"{checkpoint}/{name}", name, available_now=True
        ).awaitTermination()
