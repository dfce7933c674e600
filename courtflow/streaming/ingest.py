"""Ingest: a stream of records into the document store and the manifest."""

from __future__ import annotations

import datetime as dt
import threading

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from courtflow.operators.discovery import discover_game_keys, discover_player_keys
from courtflow.operators.records import complete_records
from courtflow.schemas import RecordType
from courtflow.sources.documents import DocumentStore, cull_documents, parse_documents

RECORDS_DDL = "document_key STRING, record_type STRING, payload STRING"
# fixed values: how many landed files, or how much time, make a batch
FLUSH_FILES = 200
FLUSH_INTERVAL = "120 seconds"


def landed_records(spark: SparkSession, path: str, files: int = FLUSH_FILES) -> DataFrame:
    """Stream of the JSON records that land below a path, so many files a batch."""
    return (
        spark.readStream.schema(RECORDS_DDL)
        .option("maxFilesPerTrigger", files)
        .json(path)
    )


def ingest_batch(
    records: DataFrame, store: DocumentStore, as_of: dt.date, load: str
) -> None:
    """Store the records as documents, and the keys they mention in the manifest.

    The keys are read from the stored documents, so the records are worked out once.
    Both writes replace what an earlier attempt at the same load left behind.
    """
    store.append_documents(complete_records(cull_documents(records), as_of), load)
    stored = store.documents(load)
    games = discover_game_keys(parse_documents(stored, RecordType.SCHEDULE))
    players = discover_player_keys(parse_documents(stored, RecordType.GAME))
    store.load_manifest(games.unionByName(players), load)


def ingest_stream(
    records: DataFrame,
    store: DocumentStore,
    as_of: dt.date,
    checkpoint: str,
    name: str = "ingest",
    available_now: bool = False,
) -> StreamingQuery:
    """Run ``ingest_batch`` on each micro-batch of a stream.

    Seen keys live in the manifest, not in stream state, so a restart loses nothing
    and nothing grows without bound. ``available_now`` ends after what has landed.

    A load is named after the query's id, which the checkpoint keeps over restarts, and the
    batch: a batch that is run again replaces itself, and a stream with a checkpoint of
    its own adds to what others stored.
    """
    started, query_id = threading.Event(), []

    def write(batch: DataFrame, batch_id: int) -> None:
        started.wait()
        ingest_batch(batch, store, as_of, f"{name}-{query_id[0]}-{batch_id}")

    trigger = {"availableNow": True} if available_now else {"processingTime": FLUSH_INTERVAL}
    query = (
        records.writeStream.foreachBatch(write)
        .option("checkpointLocation", checkpoint)
        .trigger(**trigger)
        .start()
    )
    query_id.append(query.id)
    started.set()
    return query
