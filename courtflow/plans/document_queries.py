"""Registered queries on documents, keys, seasons and record completion."""

from __future__ import annotations

import datetime as dt
from contextlib import suppress

from pyspark.errors import StreamingQueryException
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.functions import seasons
from courtflow.functions.payloads import html_to_payload, json_path
from courtflow.functions.values import excluding, with_default_column
from courtflow.operators import discovery, records
from courtflow.plans.fixtures import table
from courtflow.plans.worklist import discovered_to_fetch, ingest_staged
from courtflow.schemas import RecordType
from courtflow.session import scratch_path
from courtflow.sources.documents import (
    DocumentStore,
    cull_documents,
    latest_documents,
    new_manifest_keys,
    parse_payload,
    rejected_documents,
)
from courtflow.streaming.ingest import ingest_batch, ingest_stream, landed_records

AS_OF = dt.date(1998, 7, 1)


def _text(value: Column) -> Column:
    return value.cast("string")


# documents: every event is a version of a user's document of its type


def _versions(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        _text(F.col("user_id")).alias("document_key"),
        F.col("event_type").alias("record_type"),
        F.col("ts").cast("timestamp").alias("document_timestamp"),
        (F.col("value") > 10).alias("up_to_date"),
        F.col("props").alias("payload"),
    )


def latest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_documents(_versions(spark, sf_dir)).withColumn(
        "document_timestamp",
        F.date_format("document_timestamp", "yyyy-MM-dd HH:mm:ss.SSSSSS"),
    )


LATEST = """
SELECT user_id::VARCHAR AS document_key, event_type AS record_type,
  strftime(ts, '%Y-%m-%d %H:%M:%S.%f') AS document_timestamp,
  value>10 AS up_to_date, props AS payload
FROM events QUALIFY row_number() OVER (PARTITION BY user_id, event_type ORDER BY ts DESC)=1"""


def paths(spark: SparkSession, sf_dir: str) -> DataFrame:
    props = F.col("props")
    return table(spark, sf_dir, "events").select(
        "event_id",
        json_path(props, "k", type_="bigint").alias("k"),
        json_path(props, "page", "content", default=F.lit("none")).alias("content"),
        json_path(props, "k", "deeper", type_="bigint", default=F.lit(-1)).alias("deeper"),
    )


PATHS = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, 'none' AS content,
  CAST(-1 AS BIGINT) AS deeper FROM events"""


def parsed(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents = table(spark, sf_dir, "events").withColumnRenamed("props", "payload")
    return parse_payload(documents, "k BIGINT, missing STRING").select(
        "event_id", "parsed.k", "parsed.missing"
    )


PARSED = """
SELECT event_id, CAST(json_extract(props, '$.k') AS BIGINT) AS k, NULL::VARCHAR AS missing
FROM events"""


def culled(spark: SparkSession, sf_dir: str) -> DataFrame:
    status = F.col("o_orderstatus")
    content = F.struct(
        F.col("o_custkey").alias("teams"),
        F.struct(status.alias("deep")).alias("navigation"),
        F.col("o_orderpriority").alias("keep"),
    )
    page = F.struct(content.alias("content"), F.col("o_custkey").alias("other"))
    player = F.to_json(
        F.struct(F.lit(1).alias("app"), F.array(F.lit(2)).alias("ads"), page.alias("page"))
    )
    game = F.to_json(
        F.struct(
            F.struct(F.col("o_custkey").alias("id")).alias("header"),
            status.alias("news"),
            F.lit(None).cast("string").alias("videos"),
        )
    )
    # dealt out by key: the file may be one row group, and then all JSON would be made in one task
    documents = table(spark, sf_dir, "orders").repartition("o_orderkey").select(
        _text(F.col("o_orderkey")).alias("document_key"),
        F.when(status == "F", F.lit("game")).otherwise(F.lit("player")).alias("record_type"),
        F.when(status == "F", game).otherwise(player).alias("payload"),
    )
    return cull_documents(documents)


CULLED = """
SELECT o_orderkey::VARCHAR AS document_key,
  CASE WHEN o_orderstatus='F' THEN 'game' ELSE 'player' END AS record_type,
  CASE WHEN o_orderstatus='F' THEN '{"header":{"id":'||o_custkey||'}}'
    ELSE '{"page":{"content":{"keep":"'||o_orderpriority||'"},"other":'||o_custkey||'}}'
  END AS payload
FROM orders"""


def html(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A script is put into the head of every page, and found again."""
    data = F.to_json(F.struct("page_id", "url", F.lit("a;b").alias("note")))
    script = F.concat(
        F.lit('<head><script>window["app"]={};window["data"]='), data, F.lit(";</script>")
    )
    page = F.replace(F.col("html"), F.lit("<head>"), script)
    payload = html_to_payload(page)
    return table(spark, sf_dir, "pages").repartition("page_id").select(
        "page_id",
        json_path(payload, "page_id", type_="bigint").alias("found_id"),
        json_path(payload, "url").alias("found_url"),
        json_path(payload, "note").alias("note"),
        html_to_payload(F.col("html")).alias("without_script"),
        json_path(html_to_payload(page, strip_all_semicolons=True), "note").alias("stripped"),
    )


HTML = """
SELECT page_id, page_id AS found_id, url AS found_url, 'a;b' AS note,
  '{}' AS without_script, 'ab' AS stripped FROM pages"""


# records: an order becomes a record of a type by its priority


def _records(spark: SparkSession, sf_dir: str) -> DataFrame:
    kind = F.expr(
        "CASE o_orderpriority WHEN '1-URGENT' THEN 'standings' WHEN '2-HIGH' THEN 'schedule' "
        "WHEN '3-MEDIUM' THEN 'game' WHEN '5-LOW' THEN 'player' ELSE 'other' END"
    )
    date = F.col("o_orderdate")
    key = (
        F.when(kind == "standings", records.document_key(F.year(date), RecordType.STANDINGS))
        .when(kind == "schedule", records.document_key(F.to_date(date), RecordType.SCHEDULE))
        .otherwise(records.document_key(F.col("o_orderkey"), RecordType.GAME))
    )
    day = F.when(F.col("o_orderstatus") != "P", F.date_format(date, "yyyy-MM-dd'T'18:30'Z'"))
    header = F.struct(F.array(F.struct(day.alias("date"))).alias("competitions"))
    return table(spark, sf_dir, "orders").repartition("o_orderkey").select(
        "o_orderkey",
        kind.alias("record_type"),
        key.alias("document_key"),
        F.to_json(F.struct(header.alias("header"))).alias("payload"),
    )


_RECORDS_SQL = """
r AS (
  SELECT *, CASE o_orderpriority WHEN '1-URGENT' THEN 'standings' WHEN '2-HIGH' THEN 'schedule'
      WHEN '3-MEDIUM' THEN 'game' WHEN '5-LOW' THEN 'player' ELSE 'other' END AS record_type,
    CASE o_orderpriority WHEN '1-URGENT' THEN year(o_orderdate)::VARCHAR
      WHEN '2-HIGH' THEN strftime(o_orderdate, '%Y-%m-%d')
      ELSE o_orderkey::VARCHAR END AS document_key
  FROM orders)"""


def complete(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.complete_records(_records(spark, sf_dir), AS_OF).drop("payload")


COMPLETE = f"""WITH {_RECORDS_SQL}
SELECT o_orderkey, record_type, document_key,
  CASE record_type WHEN 'standings' THEN year(o_orderdate)<1998
    WHEN 'schedule' THEN o_orderdate<DATE '1998-07-01'
    WHEN 'game' THEN o_orderstatus='P' OR o_orderdate<DATE '1998-07-01'
    ELSE TRUE END AS up_to_date
FROM r WHERE record_type<>'other'"""


def complete_games(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Games whose dates are written in several offsets, with and without seconds, or are no dates.

    The day counts as written in its own offset.
    """
    k = F.col("o_orderkey") % 5
    day = F.date_format("o_orderdate", "yyyy-MM-dd")
    text = (
        F.when(k == 0, F.concat(day, F.lit("T18:30Z")))
        .when(k == 1, F.concat(day, F.lit("T23:30-0500")))
        .when(k == 2, F.concat(day, F.lit("T00:30:00+02:00")))
        .when(k == 3, F.concat(day, F.lit("T23:59:59.5Z")))
        .otherwise(F.lit("to be announced"))
    )
    header = F.struct(F.array(F.struct(text.alias("date"))).alias("competitions"))
    rows = table(spark, sf_dir, "orders").repartition("o_orderkey").select(
        _text(F.col("o_orderkey")).alias("document_key"), F.lit("game").alias("record_type"),
        F.to_json(F.struct(header.alias("header"))).alias("payload"))
    return records.complete_records(rows, AS_OF).drop("payload")


COMPLETE_GAMES = """
SELECT o_orderkey::VARCHAR AS document_key, 'game' AS record_type,
  o_orderkey%5=4 OR o_orderdate<DATE '1998-07-01' AS up_to_date FROM orders"""


def unknown(spark: SparkSession, sf_dir: str) -> DataFrame:
    return records.unknown_records(_records(spark, sf_dir)).drop("payload")


UNKNOWN = f"""WITH {_RECORDS_SQL}
SELECT o_orderkey, record_type, document_key FROM r WHERE record_type='other'"""


def raw_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.col("document_key")
    return _records(spark, sf_dir).select(
        "o_orderkey",
        records.raw_key(key, RecordType.GAME).alias("number"),
        _text(records.raw_key(key, RecordType.SCHEDULE)).alias("day"),
    )


RAW_KEYS = f"""WITH {_RECORDS_SQL}
SELECT o_orderkey, TRY_CAST(document_key AS BIGINT) AS number,
  CASE WHEN record_type='schedule' THEN document_key END AS day FROM r"""


def rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    payload = F.expr(
        "CASE o_orderstatus WHEN 'F' THEN payload WHEN 'O' THEN '{}' ELSE left(payload, 7) END"
    )
    documents = _records(spark, sf_dir).join(
        table(spark, sf_dir, "orders").select("o_orderkey", "o_orderstatus"), "o_orderkey"
    )
    return rejected_documents(documents.withColumn("payload", payload)).select(
        "o_orderkey", "reject_reason"
    )


REJECTED = f"""WITH {_RECORDS_SQL}
SELECT o_orderkey, CASE WHEN record_type='other' THEN 'unknown record type'
  WHEN o_orderstatus='O' THEN 'empty payload' ELSE 'malformed payload' END AS reject_reason
FROM r WHERE record_type='other' OR o_orderstatus<>'F'"""


# keys: orders are documents, customers and suppliers what the manifest holds


def _documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").select(
        _text(F.col("o_custkey")).alias("document_key"),
        F.expr("CASE o_orderstatus WHEN 'F' THEN 'game' WHEN 'O' THEN 'player' ELSE 'schedule' END")
        .alias("record_type"),
        F.expr("CASE o_orderpriority WHEN '1-URGENT' THEN true WHEN '5-LOW' THEN null ELSE false END")
        .alias("up_to_date"),
    )


def _manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    def keys(name: str, column: str, kind: str) -> DataFrame:
        return table(spark, sf_dir, name).select(
            _text(F.col(column)).alias("document_key"), F.lit(kind).alias("record_type")
        )

    customers = keys("customer", "c_custkey", "game")
    return customers.unionByName(keys("supplier", "s_suppkey", "player"))


_KEYS_SQL = """
d AS (
  SELECT o_custkey::VARCHAR AS document_key,
    CASE o_orderstatus WHEN 'F' THEN 'game' WHEN 'O' THEN 'player' ELSE 'schedule' END AS record_type,
    CASE o_orderpriority WHEN '1-URGENT' THEN TRUE WHEN '5-LOW' THEN NULL ELSE FALSE END AS up_to_date
  FROM orders),
m AS (
  SELECT c_custkey::VARCHAR AS document_key, 'game' AS record_type FROM customer
  UNION ALL SELECT s_suppkey::VARCHAR, 'player' FROM supplier),
c AS (
  SELECT c_custkey::VARCHAR AS id FROM customer
  WHERE coalesce(CASE WHEN c_mktsegment<>'BUILDING' THEN c_acctbal>5000 END, FALSE))"""


def existing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return discovery.existing_keys(_documents(spark, sf_dir), RecordType.GAME)


EXISTING = f"""WITH {_KEYS_SQL}
SELECT document_key FROM d WHERE record_type='game' AND coalesce(up_to_date, FALSE)"""


def discovered(spark: SparkSession, sf_dir: str) -> DataFrame:
    manifest, documents = _manifest(spark, sf_dir), _documents(spark, sf_dir)
    return discovery.discovered_keys(manifest, documents, RecordType.GAME)


DISCOVERED = f"""WITH {_KEYS_SQL}
SELECT document_key FROM m WHERE record_type='game'
EXCEPT SELECT document_key FROM d WHERE record_type='game' AND coalesce(up_to_date, FALSE)"""


def _complete_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "CASE WHEN c_mktsegment <> 'BUILDING' THEN c_acctbal > 5000 END AS complete_record",
    )
    return discovery.complete_ids(rows)


COMPLETE_IDS = f"WITH {_KEYS_SQL} SELECT id FROM c"


def pending(spark: SparkSession, sf_dir: str) -> DataFrame:
    documents, ids = _documents(spark, sf_dir), _complete_ids(spark, sf_dir)
    return discovery.pending_documents(documents, ids, RecordType.GAME)


PENDING = f"""WITH {_KEYS_SQL}
SELECT DISTINCT document_key FROM d WHERE record_type='game'
  AND NOT EXISTS (SELECT 1 FROM c WHERE c.id=d.document_key)"""


def to_fetch(spark: SparkSession, sf_dir: str) -> DataFrame:
    requested = table(spark, sf_dir, "lineitem").select(
        _text(F.col("l_partkey")).alias("document_key")
    )
    return discovery.keys_to_fetch(requested, existing(spark, sf_dir))


TO_FETCH = f"""WITH {_KEYS_SQL}
SELECT DISTINCT l_partkey::VARCHAR AS document_key FROM lineitem
EXCEPT SELECT document_key FROM d WHERE record_type='game' AND coalesce(up_to_date, FALSE)"""


def manifest_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = table(spark, sf_dir, "orders").select(
        F.col("o_custkey").alias("document_key"), F.lit("player").alias("record_type")
    )
    return new_manifest_keys(keys, _manifest(spark, sf_dir))


MANIFEST_KEYS = f"""WITH {_KEYS_SQL}
SELECT o_custkey::VARCHAR AS document_key, 'player' AS record_type FROM orders
EXCEPT SELECT document_key, record_type FROM m"""


def unseen(spark: SparkSession, sf_dir: str) -> DataFrame:
    keys = _documents(spark, sf_dir).select("document_key", "record_type").distinct()
    return discovery.unseen_keys(keys, _manifest(spark, sf_dir))


UNSEEN = f"""WITH {_KEYS_SQL}
SELECT document_key, record_type FROM d EXCEPT SELECT document_key, record_type FROM m"""


# seasons


def season_numbers(spark: SparkSession, sf_dir: str) -> DataFrame:
    date, as_of = F.to_date("o_orderdate"), dt.date(2006, 3, 1)
    season = seasons.season_of(date)
    later = season + 6
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        season.cast("bigint").alias("season"),
        seasons.is_valid_season(later, as_of).alias("later_is_valid"),
        _text(seasons.season_start(season)).alias("starts"),
    )


SEASON_NUMBERS = """
SELECT o_orderkey, s AS season, s+6 BETWEEN 2003 AND 2006 AS later_is_valid,
  (s-1)||'-11-01' AS starts
FROM (SELECT *, year(o_orderdate)+CASE WHEN month(o_orderdate)>7 THEN 1 ELSE 0 END AS s
      FROM orders)"""


def season_ranges(spark: SparkSession, sf_dir: str) -> DataFrame:
    as_of = dt.date(2006, 3, 1)
    start, end = F.year("o_orderdate") + 6, F.lit(1997) + F.col("o_custkey") % 12
    return table(spark, sf_dir, "orders").select(
        "o_orderkey",
        F.array_join(_list(seasons.season_range(start, end, as_of)), ",").alias("seasons"),
        F.array_join(_list(seasons.season_range(start, None, as_of)), ",").alias("to_now"),
    )


def _list(array: Column) -> Column:
    return array.cast("array<string>")


SEASON_RANGES = """
WITH e AS (
  SELECT o_orderkey,
    CASE WHEN year(o_orderdate)+6 BETWEEN 2003 AND 2006 THEN year(o_orderdate)+6 ELSE 2003 END AS a,
    CASE WHEN 1997+o_custkey%12 BETWEEN 2003 AND 2006 THEN 1997+o_custkey%12 ELSE 2006 END AS b
  FROM orders)
SELECT o_orderkey, array_to_string(generate_series(least(a,b), greatest(a,b)), ',') AS seasons,
  array_to_string(generate_series(a, 2006), ',') AS to_now FROM e"""


def rep_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    years = (
        table(spark, sf_dir, "orders")
        .groupBy(F.year("o_orderdate").cast("bigint").alias("year"))
        .agg(F.to_date(F.min("o_orderdate")).alias("a"), F.to_date(F.max("o_orderdate")).alias("b"))
    )
    dates = seasons.representative_dates(F.col("a"), F.col("b"))
    return years.select("year", F.explode(dates).alias("day")).withColumn("day", _text(F.col("day")))


REP_DATES = """
SELECT year, strftime(a + to_days(CAST(i AS INT)), '%Y-%m-%d') AS day
FROM (SELECT year(o_orderdate) AS year, min(o_orderdate) AS a, max(o_orderdate) AS b
      FROM orders GROUP BY ALL),
  LATERAL (SELECT unnest(generate_series(0, date_diff('day', a, b))) AS i)
WHERE i%3=1 OR i=date_diff('day', a, b)"""


def columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Columns chosen by name: prefixes left out, a missing one added."""
    kept = excluding(table(spark, sf_dir, "orders"), prefix="o_order")
    kept = excluding(kept.withColumn("helper_id", F.lit(1)), suffix="_id")
    kept = with_default_column(kept, "o_custkey", F.lit(-1))
    return with_default_column(kept, "complete_record", F.lit(False))


COLUMNS = "SELECT o_custkey, o_totalprice, FALSE AS complete_record FROM orders"


# store and stream


def _landed(spark: SparkSession, sf_dir: str, reader) -> DataFrame:
    """The events as records: games with a box score, schedules with an event."""
    schema = spark.read.parquet(f"{sf_dir}/events.parquet").schema
    events = reader.schema(schema).option("pathGlobFilter", "events.parquet").parquet(sf_dir)
    athlete = F.struct(F.col("user_id").cast("string").alias("id"))
    table_ = F.struct(F.array(F.struct(athlete.alias("athlete"))).alias("athletes"))
    box = F.struct(F.array(F.struct(F.array(table_).alias("statistics"))).alias("players"))
    game = F.to_json(F.struct(box.alias("boxscore"), F.col("props").alias("news")))
    listed = F.create_map(
        F.date_format("ts", "yyyyMMdd"),
        F.array(F.struct(F.expr("cast(event_id div 3 as string)").alias("id"))),
    )
    content = F.struct(listed.alias("events"))
    schedule = F.to_json(F.struct(F.struct(content.alias("content")).alias("page")))
    kind = F.expr(
        "CASE event_type WHEN 'signup' THEN 'game' WHEN 'click' THEN 'schedule' "
        "WHEN 'view' THEN 'player' WHEN 'error' THEN 'standings' ELSE 'other' END"
    )
    day = F.to_date("ts")
    return events.select(
        F.when(kind == "schedule", F.date_format(day, "yyyy-MM-dd"))
        .when(kind == "standings", _text(F.year(day)))
        .otherwise(_text(F.col("event_id")))
        .alias("document_key"),
        kind.alias("record_type"),
        F.when(kind == "game", game).when(kind == "schedule", schedule)
        .otherwise(F.col("props")).alias("payload"),
    )


_INGEST_AS_OF = dt.date(2024, 1, 15)

_INGESTED_SQL = """
i AS (
  SELECT *, CASE event_type WHEN 'signup' THEN 'game' WHEN 'click' THEN 'schedule'
      WHEN 'view' THEN 'player' WHEN 'error' THEN 'standings' ELSE 'other' END AS record_type
  FROM events)"""

INGEST_DOCUMENTS = f"""WITH {_INGESTED_SQL}
SELECT CASE record_type WHEN 'schedule' THEN strftime(ts, '%Y-%m-%d')
    WHEN 'standings' THEN '2024' ELSE event_id::VARCHAR END AS document_key, record_type,
  CASE record_type WHEN 'standings' THEN FALSE WHEN 'schedule' THEN ts<TIMESTAMP '2024-01-15'
    ELSE TRUE END AS up_to_date,
  CASE record_type
    WHEN 'game' THEN '{{"boxscore":{{"players":[{{"statistics":[{{"athletes":[{{"athlete":{{"id":"'
      ||user_id||'"}}}}]}}]}}]}}}}'
    WHEN 'schedule' THEN '{{"page":{{"content":{{"events":{{"'||strftime(ts, '%Y%m%d')
      ||'":[{{"id":"'||(event_id//3)||'"}}]}}}}}}}}'
    ELSE replace(props, ' ', '') END AS payload
FROM i WHERE record_type<>'other'"""

INGEST_MANIFEST = f"""WITH {_INGESTED_SQL}
SELECT DISTINCT CASE record_type WHEN 'game' THEN user_id ELSE event_id//3 END::VARCHAR AS document_key,
  CASE record_type WHEN 'game' THEN 'player' ELSE 'game' END AS record_type
FROM i WHERE record_type IN ('game', 'schedule')"""


def _store(spark: SparkSession) -> DocumentStore:
    return DocumentStore(spark, scratch_path(spark, "store")).create()


def _streamed(spark: SparkSession, sf_dir: str) -> DocumentStore:
    store = _store(spark)
    stream = _landed(spark, sf_dir, spark.readStream)
    checkpoint = scratch_path(spark, "stream")
    ingest_stream(stream, store, _INGEST_AS_OF, checkpoint, available_now=True).awaitTermination()
    return store


def _shown(store: DocumentStore) -> DataFrame:
    # player payloads went through the culling, which drops blanks
    payload = F.regexp_replace("payload", " ", "")
    return store.documents().drop("document_timestamp").withColumn("payload", payload)


def stream_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_streamed(spark, sf_dir))


def stream_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _streamed(spark, sf_dir).manifest()


def batch_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same in one batch, run twice under one name: nothing is stored twice."""
    store, landed = _store(spark), _landed(spark, sf_dir, spark.read)
    for _ in range(2):
        ingest_batch(landed, store, _INGEST_AS_OF, "only")
    return _shown(store)


class _DiesOnce(DocumentStore):
    """A store whose second load dies between its documents and its manifest."""

    def load_manifest(self, keys: DataFrame, load: str | None = None) -> str:
        if load and load.endswith("-1"):
            raise RuntimeError("died between two writes")
        return super().load_manifest(keys, load)


def _land(spark: SparkSession, sf_dir: str, files: int) -> str:
    """The records as so many JSON files."""
    path = scratch_path(spark, "landing")
    rows = _landed(spark, sf_dir, spark.read)
    rows.repartition(files, "document_key", "record_type").write.json(path)
    return path


def _in_batches(spark: SparkSession, sf_dir: str) -> DocumentStore:
    """A file a batch; the second batch dies half written, and the stream starts again."""
    landing, checkpoint = _land(spark, sf_dir, 4), scratch_path(spark, "stream")
    store = _store(spark)

    def run(into: DocumentStore) -> None:
        records = landed_records(spark, landing, files=1)
        ingest_stream(records, into, _INGEST_AS_OF, checkpoint, available_now=True).awaitTermination()

    with suppress(StreamingQueryException):
        run(_DiesOnce(spark, store.root))
    run(store)
    return store


def batches_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _shown(_in_batches(spark, sf_dir))


def batches_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_batches(spark, sf_dir).manifest()


def two_streams_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two streams with checkpoints of their own, one for games and one for the rest, into one store."""
    store, landed = _store(spark), _landed(spark, sf_dir, spark.readStream)
    for records in (landed.filter("record_type = 'game'"), landed.filter("record_type <> 'game'")):
        ingest_stream(
            records, store, _INGEST_AS_OF, scratch_path(spark, "stream"), available_now=True
        ).awaitTermination()
    return _shown(store)


def compacted_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Many small loads rewritten as one, then one more load, rewritten again."""
    store, landed = _store(spark), _landed(spark, sf_dir, spark.read)
    part = F.pmod(F.xxhash64("document_key"), F.lit(3))
    for k in range(3):
        ingest_batch(landed.filter(part == k), store, _INGEST_AS_OF, f"load-{k}")
        if k:
            store.compact()
    return _shown(store)


def _staged(spark: SparkSession, sf_dir: str) -> DocumentStore:
    """One stream per type, each taking what the stages before it brought to light."""
    landing, store = scratch_path(spark, "landing"), _store(spark)
    rows = _landed(spark, sf_dir, spark.read).withColumn("kind", F.col("record_type"))
    for record_type in RecordType:
        own = rows.filter(F.col("kind") == record_type.value).drop("kind")
        own.repartition(2, "document_key").write.json(f"{landing}/{record_type.value}")
    checkpoint = scratch_path(spark, "stream")
    ingest_staged(spark, landing, store, _INGEST_AS_OF, checkpoint, listed_only=True, files=1)
    return store


def staged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _staged(spark, sf_dir).documents().groupBy("record_type", "document_key", "up_to_date").count()


_STAGED_SQL = f"""{_INGESTED_SQL},
listed_games AS (SELECT DISTINCT event_id//3 AS id FROM i WHERE record_type='schedule'),
games AS (SELECT * FROM i WHERE record_type='game' AND event_id IN (SELECT id FROM listed_games)),
listed_players AS (SELECT DISTINCT user_id AS id FROM games),
players AS (SELECT * FROM i WHERE record_type='player' AND event_id IN (SELECT id FROM listed_players))"""

STAGED_DOCUMENTS = f"""WITH {_STAGED_SQL}
SELECT record_type, CASE record_type WHEN 'schedule' THEN strftime(ts, '%Y-%m-%d')
    WHEN 'standings' THEN '2024' ELSE event_id::VARCHAR END AS document_key,
  CASE record_type WHEN 'standings' THEN FALSE WHEN 'schedule' THEN ts<TIMESTAMP '2024-01-15'
    ELSE TRUE END AS up_to_date, count(*) AS count
FROM (SELECT * FROM i WHERE record_type IN ('standings', 'schedule')
      UNION ALL SELECT * FROM games UNION ALL SELECT * FROM players) GROUP BY ALL"""


def staged_worklist(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every key of the manifest, and whether it is still to be fetched."""
    store = _staged(spark, sf_dir)
    lists = [
        discovered_to_fetch(store, t).select("document_key", F.lit(t.value).alias("record_type"), F.lit(True).alias("to_fetch"))
        for t in (RecordType.GAME, RecordType.PLAYER)
    ]
    key = ["document_key", "record_type"]
    found = store.manifest().join(lists[0].unionByName(lists[1]), key, "left")
    return found.withColumn("to_fetch", F.coalesce("to_fetch", F.lit(False)))


STAGED_WORKLIST = f"""WITH {_STAGED_SQL}
SELECT id::VARCHAR AS document_key, 'game' AS record_type,
  id NOT IN (SELECT event_id FROM games) AS to_fetch FROM listed_games
UNION ALL
SELECT id::VARCHAR, 'player', id NOT IN (SELECT event_id FROM players) FROM listed_players"""

QUERIES = {
    "latest_documents": (latest, LATEST),
    "json_path": (paths, PATHS),
    "parse_payload": (parsed, PARSED),
    "cull_payload": (culled, CULLED),
    "html_to_payload": (html, HTML),
    "complete_records": (complete, COMPLETE),
    "complete_games": (complete_games, COMPLETE_GAMES),
    "unknown_records": (unknown, UNKNOWN),
    "raw_keys": (raw_keys, RAW_KEYS),
    "rejected_documents": (rejected, REJECTED),
    "existing_keys": (existing, EXISTING),
    "discovered_keys": (discovered, DISCOVERED),
    "complete_ids": (_complete_ids, COMPLETE_IDS),
    "pending_documents": (pending, PENDING),
    "keys_to_fetch": (to_fetch, TO_FETCH),
    "load_manifest": (manifest_keys, MANIFEST_KEYS),
    "unseen_keys": (unseen, UNSEEN),
    "seasons": (season_numbers, SEASON_NUMBERS),
    "season_range": (season_ranges, SEASON_RANGES),
    "rep_dates": (rep_dates, REP_DATES),
    "columns_by_name": (columns, COLUMNS),
    "append_documents": (batch_documents, INGEST_DOCUMENTS),
    "ingest_stream_documents": (stream_documents, INGEST_DOCUMENTS),
    "ingest_stream_manifest": (stream_manifest, INGEST_MANIFEST),
    "ingest_batches_documents": (batches_documents, INGEST_DOCUMENTS),
    "ingest_batches_manifest": (batches_manifest, INGEST_MANIFEST),
    "ingest_two_streams": (two_streams_documents, INGEST_DOCUMENTS),
    "compact_documents": (compacted_documents, INGEST_DOCUMENTS),
    "ingest_staged_documents": (staged_documents, STAGED_DOCUMENTS),
    "ingest_staged_worklist": (staged_worklist, STAGED_WORKLIST),
}
