"""Documents of every type by hand, with optional fields present and absent."""

import datetime as dt
import json
import re

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from courtflow.functions import payloads, seasons, values
from courtflow.operators import discovery, game_pages, player_pages, records, schedules, standings
from courtflow.plans import transform, worklist
from courtflow.plans.transform import transform_all
from courtflow.operators.writes import WriteAction
from courtflow.operators.discovery import pending_documents
from courtflow.plans.transform import pending
from courtflow.schemas import RecordType
from courtflow.sources.documents import (
    DocumentStore,
    latest_documents,
    parse_documents,
    rejected_documents,
)
from courtflow.sources.warehouse import Warehouse
from courtflow.streaming.ingest import ingest_batch, ingest_stream, landed_records

AS_OF = dt.date(2024, 3, 1)
RECORDS = "document_key string, record_type string, payload string"


def team(id_, **more):
    return {"id": id_, "location": f"L{id_}", "shortDisplayName": f"M{id_}", "abbrev": f"A{id_}", **more}


SCHEDULE = {"page": {"content": {
    "events": {
        "20240301": [
            {"id": "11", "date": "2024-03-01T19:30Z", "tbd": False,
             "teams": [team("1", teamColor="aa0000"), team("2")],
             "venue": {"id": "5", "fullName": "Hall", "address": {"city": "C", "state": "S"}},
             "status": {"id": "3", "state": "post", "detail": "Final/2OT"}},
            {"id": "oops", "date": "2024-03-01T20:00Z", "tbd": True, "teams": [team("1"), team("3")],
             "venue": {"id": "6", "fullName": "Gym"},
             "status": {"id": "3", "state": "post", "detail": "Final"}}],
        "20240302": [
            {"id": "12", "date": "2024-03-02T01:00Z", "tbd": False, "teams": [team("4")],
             "status": {"id": "1", "state": "pre", "detail": "Scheduled/OT"}}]},
    "season": {"startDate": "2024-02-28T08:00Z", "endDate": "2024-03-03T07:59Z"}}}}

STANDINGS = {"page": {"content": {
    "headerscoreboard": {"collegeConfs": [
        {"groupId": "50", "name": "NCAA Division I", "shortName": "D-I"},
        {"groupId": "2", "name": "Big", "shortName": "B"},
        {"groupId": "x", "name": "Odd", "shortName": "O"}]},
    "standings": {"groups": {"groups": [
        {"name": "Big", "children": [{"standings": [{"team": team("1")}]}, {},
                                     {"standings": [{"team": team("2")}]}]},
        {"name": "Odd", "standings": [{"team": team("3")}]},
        {"name": "NCAA Division I", "standings": [{"team": team("8")}]},
        {"name": "Unlisted", "standings": [{"team": team("9")}]}]}}}}}


def athlete(id_, short, full, stats, jersey="4", **more):
    who = {"shortName": short, "displayName": full, "position": {"abbreviation": "G"}}
    if id_ is not None:
        who["id"] = id_
    if jersey is not None:
        who["jersey"] = jersey
    return {"athlete": who, "starter": True, "didNotPlay": False, "ejected": False, "stats": stats, **more}


NAMES = ["MIN", "FG", "3PT", "FT", "OREB", "DREB", "AST", "STL", "TO", "PF", "PTS"]
STATS = ["30", "5-9", "1-4", "2-2", "1", "6", "3", "0", "2", "4", "13"]


def play(seq, **more):
    return {"sequenceNumber": seq, "text": "t", "shortDescription": "d", "type": {"id": "584", "text": "Sub"},
            "period": {"number": 1, "displayValue": "1st"}, "clock": {"displayValue": "19:05"},
            "shootingPlay": False, "scoringPlay": False, "pointsAttempted": 0,
            "homeScore": 0, "awayScore": 2, **more}


GAME = {
    "gameInfo": {"attendance": 900}, "news": {"x": 1},
    "header": {"competitions": [{"id": "11", "date": "2024-03-01T19:45Z", "neutralSite": True}]},
    "plays": [
        play("1", team={"id": "1"}, coordinate={"x": 3, "y": 4}, wallclock="2024-03-01T19:46:01Z",
             participants=[{"athlete": {"id": "71"}}, {"athlete": {"id": "72"}}, {"athlete": {"id": "73"}}]),
        play("2", clock={"displayValue": "7"}, participants=[{"athlete": {"id": "71"}}]),
        play("x", participants=[])],
    "boxscore": {"players": [
        {"team": {"id": "2"}, "statistics": [
            {"names": NAMES, "totals": STATS, "athletes": [
                athlete("71", "J. van Doe", "John van Doe", STATS),
                athlete(None, "N. Id", "No Id", STATS),
                athlete("72", "Cher", "Cher", STATS[:4], jersey=None)]}, {"names": ["ignored"]}]},
        {"team": {}, "statistics": [{"names": NAMES, "totals": STATS, "athletes": []}]},
        {"team": {"id": "1"}, "statistics": [
            {"names": NAMES, "totals": ["--"] * 11, "athletes": [
                athlete("73", "A. Roe-Li", "Ann Roe-Li", ["--"] * 11, jersey="00")]}]}]}}

PLAYER = {"app": 1, "page": {"content": {"teams": [1], "player": {"plyrHdr": {
    "ath": {"htwt": "6' 4\", 210 lbs", "brthpl": "Town, State, Land"}}}}}}


def documents(spark, *rows):
    rows = [(k, t, p if isinstance(p, str) or p is None else json.dumps(p)) for k, t, p in rows]
    return spark.createDataFrame(rows, RECORDS)


def parsed(spark, type_, *payloads_):
    rows = [(key, type_.value, p) for key, p in payloads_]
    return parse_documents(documents(spark, *rows), type_)


def tuples(df, *order):
    return [tuple(r) for r in (df.orderBy(*order) if order else df).collect()]


@pytest.fixture(scope="module")
def schedule(spark):
    return parsed(spark, RecordType.SCHEDULE, ("2024-03-01", SCHEDULE), ("2024-03-04", {}))


def test_schedule(schedule):
    assert tuples(schedules.venues(schedule), "id") == [(5, "Hall", "C", "S"), (6, "Gym", None, None)]
    assert tuples(schedules.game_statuses(schedule), "id", "detail") == [
        (1, "pre", "Scheduled"), (3, "post", "Final")]
    teams = tuples(schedules.schedule_teams(schedule), "id")
    assert [t[0] for t in teams] == [1, 2, 3, 4]
    # the row with a color comes before the one without
    assert teams[0] == (1, "L1", "M1", "A1", "aa0000", None)
    at = dt.datetime
    assert tuples(schedules.games(schedule), "datetime") == [
        (11, at(2024, 3, 1, 19, 30), 1, 2, 5, 3, False, None),
        (None, at(2024, 3, 1, 20, 0), 1, 3, 6, 3, True, None),
        (12, at(2024, 3, 2, 1, 0), 4, None, None, 1, False, None)]


def test_standings(spark):
    content = standings.standings_content(
        parsed(spark, RecordType.STANDINGS, ("2024", STANDINGS), ("1999", STANDINGS), ("2023", {})), AS_OF)
    assert tuples(standings.conferences(content), "name") == [(2, "Big", "B"), (None, "Odd", "O")]
    assert tuples(standings.standings_teams(content), "id") == [
        (1, "L1", "M1", "A1"), (2, "L2", "M2", "A2"), (3, "L3", "M3", "A3")]
    assert tuples(standings.conference_alignments(content), "team_id") == [
        (2, 1, 2024), (2, 2, 2024), (None, 3, 2024)]


@pytest.fixture(scope="module")
def game(spark):
    return parsed(spark, RecordType.GAME, ("11", GAME), ("12", {}), ("13", "{bad"))


def test_game(game):
    assert tuples(game_pages.game_updates(game)) == [
        (11, True, None, None, 900, dt.datetime(2024, 3, 1, 19, 45), True)]
    rows = game_pages.plays(game).orderBy(F.col("sequence_id").asc_nulls_last()).collect()
    assert [r.sequence_id for r in rows] == [1, 2, None]
    one, two, _ = rows
    assert (one.player_id, one.assist_id, one.team_id, one.x_coord, one.y_coord) == (71, 73, 1, 3, 4)
    assert (one.clock_minutes, one.clock_seconds) == (19, 5)
    assert one.timestamp == dt.datetime(2024, 3, 1, 19, 46, 1)
    assert (two.player_id, two.assist_id, two.clock_minutes, two.clock_seconds) == (71, None, 7, None)
    assert tuples(game_pages.play_types(game)) == [(584, "Sub", False)]


def test_box_scores(game):
    assert tuples(game_pages.players(game), "id") == [
        (71, "John", "van Doe", "G", None), (72, None, None, "G", None), (73, "Ann", "Roe-Li", "G", None)]
    assert tuples(game_pages.player_seasons(game), "player_id") == [
        (71, 2, 2024, 4), (72, 2, 2024, None), (73, 1, 2024, 0)]
    assert tuples(game_pages.game_logs(game), "player_id") == [
        (p, 11, True, True, False) for p in (71, 72, 73)]
    box = {r.player_id: r for r in game_pages.player_box_scores(game).collect()}
    assert box[71].asDict() == {
        "player_id": 71, "game_id": 11, "minutes": 30, "points": 13, "fg_made": 5, "fg_attempted": 9,
        "fg3_made": 1, "fg3_attempted": 4, "off_rebounds": 1, "def_rebounds": 6, "assists": 3,
        "turnovers": 2, "steals": 0, "personal_fouls": 4}
    assert (box[72].fg_made, box[72].points) == (5, None)
    assert box[73].minutes is None and box[73].fg_made is None
    assert tuples(game_pages.team_box_scores(game).select("team_id", "points"), "team_id") == [(1, None), (2, 13)]


def test_game_without_a_date_loses_only_its_season(spark):
    undated = {k: v for k, v in GAME.items() if k != "header"}
    frame = parsed(spark, RecordType.GAME, ("11", undated))
    assert [r.season for r in game_pages.player_seasons(frame).collect()] == [None] * 3
    assert game_pages.game_logs(frame).count() == 3


def test_player(spark):
    bare = {"page": {"content": {"player": {"plyrHdr": {"ath": {"brthpl": "Town"}}}}}}
    none = {"page": {"content": {"player": {"plyrHdr": {}}}}}
    frame = parsed(spark, RecordType.PLAYER, ("71", PLAYER), ("72", bare), ("73", none))
    assert tuples(player_pages.player_updates(frame), "id") == [
        (71, "Town", "State", 6, 4, 210, True), (72, "Town", None, None, None, None, True)]


def test_discovery(spark, schedule, game):
    assert tuples(discovery.discover_game_keys(schedule), "document_key") == [("11", "game"), ("12", "game")]
    assert tuples(discovery.discover_player_keys(game), "document_key") == [
        (p, "player") for p in ("71", "72", "73")]


def test_records(spark):
    rows = documents(
        spark, ("2023", "standings", {}), ("2024", "standings", {}), ("2024-02-29", "schedule", {}),
        ("2024-03-01", "schedule", {}), ("11", "game", GAME), ("12", "game", {}),
        ("13", "game", {"header": {"competitions": [{"date": "2024-02-29T23:30-0500"}]}}),
        ("71", "player", {}), ("1", "other", {}))
    done = records.complete_records(rows, AS_OF)
    assert {(r.record_type, r.document_key): r.up_to_date for r in done.collect()} == {
        ("standings", "2023"): True, ("standings", "2024"): False, ("schedule", "2024-02-29"): True,
        ("schedule", "2024-03-01"): False, ("game", "11"): False, ("game", "12"): True,
        ("game", "13"): True, ("player", "71"): True}
    assert records.unknown_records(rows).count() == 1
    assert records.of_type(rows, RecordType.GAME).count() == 3
    assert RecordType.from_label("game") is RecordType.GAME and RecordType.from_label("x") is None


def test_rejects(spark):
    rows = documents(spark, ("1", "game", "{bad"), ("2", "game", " {} "), ("3", "game", None),
                     ("4", "x", {"a": 1}), ("5", "game", {"a": 1}))
    assert {r.document_key: r.reject_reason for r in rejected_documents(rows).collect()} == {
        "1": "malformed payload", "2": "empty payload", "3": "empty payload", "4": "unknown record type"}


def test_latest_breaks_ties_and_fills_null_payloads(spark):
    at = dt.datetime(2024, 1, 1)
    rows = [("a", "game", at, True, "{\"v\": 1}"), ("a", "game", at, True, "{\"v\": 2}"),
            ("a", "player", at, True, None), ("a", "game", None, True, "{\"v\": 3}")]
    frame = spark.createDataFrame(
        rows, "document_key string, record_type string, document_timestamp timestamp, "
              "up_to_date boolean, payload string")
    got = {r.record_type: r.payload for r in latest_documents(frame).collect()}
    again = {r.record_type: r.payload for r in latest_documents(frame.orderBy(F.desc("payload"))).collect()}
    assert got == again and got["player"] == "{}" and got["game"] in ("{\"v\": 1}", "{\"v\": 2}")


HTML = '<html><!-- <script>window["a"]=1;window["b"]={"no":1};</script> --><script type="x">window["x"]=1;' \
       'window["y"]={"no":1};</script>%s</html>'


@pytest.mark.parametrize("html, kept, stripped", [
    (HTML % '<script>window["x"]=1;window["y"]={"a":"x;y"};</script>', '{"a":"x;y"}', '{"a":"xy"}'),
    (HTML % '<SCRIPT>window["x"]=1;\nwindow["y"]={"a":1}\n;\n</SCRIPT>', '{"a":1}', '{"a":1}'),
    (HTML % '<script>window["x"]=1;</script><script>window["x"]=1;window["y"]={};</script>', "{}", "{}"),
    (HTML % '<script>window["x"]=1;window["y"]={bad;</script>', None, None),
    (HTML % "", "{}", "{}"), ("", "{}", "{}")])
def test_html(spark, html, kept, stripped):
    page = F.lit(html)
    row = spark.range(1).select(payloads.html_to_payload(page), payloads.html_to_payload(page, True)).first()
    assert (row[0], row[1] and row[1].strip()) == (kept, stripped)


def test_json_path_and_cull(spark):
    deep = F.lit(json.dumps({"a": {"b": 1, "c": [1]}, "d": None, "e": "t"}))
    path = payloads.json_path
    row = spark.range(1).select(
        path(deep, "a", "b", type_="bigint"), path(deep, "a", "x", default=F.lit("z")),
        path(deep, "d", default=F.lit("z")), path(deep, "e", "x", default=F.lit("z")),
        path(F.lit("{bad"), "a", default=F.lit("z")),
        payloads.cull_payload(deep, [("a", "b"), ("a", "x"), ("e", "x"), "d"]),
        payloads.cull_payload(F.lit("[1]"), ["d"])).first()
    assert tuple(row)[:5] == (1, "z", "z", "z", "z")
    assert json.loads(row[5]) == {"a": {"c": [1]}, "e": "t"} and row[6] == "[1]"


def test_seasons(spark):
    d, as_of = dt.date, dt.date(2024, 2, 1)
    s = seasons
    row = spark.range(1).select(
        s.season_of(d(2023, 7, 31)), s.season_of(d(2023, 8, 1)), s.season_start(F.lit(2024)),
        s.season_range(F.lit(2010), F.lit(2008), as_of), s.season_range(F.lit(1990), F.lit(2004), as_of),
        s.season_range(F.lit(2023), F.lit(2050), as_of), s.season_range(F.lit(2023), None, as_of),
        s.representative_dates(d(2024, 1, 1), d(2024, 1, 6)), s.representative_dates(d(2024, 1, 2), d(2024, 1, 1)),
        s.is_valid_season(F.lit(2002), as_of), s.is_valid_season(F.lit(2024), as_of)).first()
    assert tuple(row) == (
        2023, 2024, d(2023, 11, 1), [2008, 2009, 2010], [2003, 2004], [2023, 2024], [2023, 2024],
        [d(2024, 1, 2), d(2024, 1, 5), d(2024, 1, 6)], [], False, True)


def test_columns_by_name(spark):
    df = spark.createDataFrame([(1, 2)], "last_a int, b int")
    assert values.excluding(df, prefix="last_").columns == ["b"]
    assert values.existing(df, "b", "c") == ["b"]
    assert values.with_default_column(df, "c", F.lit(1)).columns == ["last_a", "b", "c"]


@pytest.fixture
def store(spark, tmp_path):
    return DocumentStore(spark, str(tmp_path / "store")).create()


def all_records(spark):
    return documents(
        spark, ("2024", "standings", STANDINGS), ("2024-03-01", "schedule", SCHEDULE), ("11", "game", GAME),
        ("71", "player", PLAYER), ("1", "other", {}))


def test_ingest_twice_equals_once_and_batch_equals_stream(spark, tmp_path, store):
    assert store.documents().count() == 0 and store.manifest().count() == 0
    for _ in range(2):
        ingest_batch(all_records(spark), store, AS_OF, "one")
    manifest = sorted(tuples(store.manifest()))
    assert manifest == [("11", "game"), ("12", "game")] + [(p, "player") for p in ("71", "72", "73")]
    assert "news" not in store.documents().filter("record_type = 'game'").first().payload

    landing = str(tmp_path / "landing")
    all_records(spark).repartition(3).write.json(landing)
    other = DocumentStore(spark, str(tmp_path / "other")).create()

    def run():
        ingest_stream(landed_records(spark, landing), other, AS_OF, str(tmp_path / "cp"),
                      available_now=True).awaitTermination()

    run()
    columns = ("document_key", "record_type", "up_to_date", "payload")
    assert sorted(tuples(other.documents().select(*columns))) == sorted(tuples(store.documents().select(*columns)))
    assert sorted(tuples(other.manifest())) == manifest
    # what lands later is all that a restart adds
    documents(spark, ("12", "game", GAME)).write.mode("append").json(landing)
    run()
    assert other.documents().count() == 5 and sorted(tuples(other.manifest())) == manifest


def test_worklist_and_stages(spark, tmp_path, store):
    wanted = spark.createDataFrame([(2023,), (2024,), (2024,)], "season int")
    assert tuples(worklist.standings_to_fetch(wanted, store), "document_key") == [("2023",), ("2024",)]
    for row in all_records(spark).filter("record_type <> 'other'").collect():
        documents(spark, tuple(row)).write.mode("append").json(f"{tmp_path}/landing/{row.record_type}")
    worklist.ingest_staged(spark, f"{tmp_path}/landing", store, dt.date(2025, 3, 1), f"{tmp_path}/cp")
    assert tuples(worklist.standings_to_fetch(wanted, store)) == [("2023",)]
    assert tuples(worklist.discovered_to_fetch(store, RecordType.GAME)) == [("12",)]
    assert tuples(worklist.discovered_to_fetch(store, RecordType.PLAYER), "document_key") == [("72",), ("73",)]
    first = parsed(spark, RecordType.SCHEDULE, ("2024-03-01", SCHEDULE))
    assert tuples(worklist.schedules_to_fetch(first, store), "document_key") == [("2024-02-29",), ("2024-03-03",)]


def test_transform(spark, tmp_path, store):
    ingest_batch(all_records(spark), store, AS_OF, "one")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse")).create_tables()
    rows = transform_all(store, warehouse, AS_OF)
    update = WriteAction.UPDATE
    assert rows[RecordType.GAME]["Games", update] == 1
    assert rows[RecordType.PLAYER]["Players", update] == 1
    games = {r.id: r for r in warehouse.read_table("Games").collect()}
    # game 12 lacks an away team
    assert set(games) == {11} and games[11].attendance == 900 and games[11].home_id == 1
    assert games[11].datetime == dt.datetime(2024, 3, 1, 19, 45)
    assert {r.reject_reason for r in warehouse.rejects("Games").collect()} == {"id is null in key", "away_id is null"}
    player = {r.id: r for r in warehouse.read_table("Players").collect()}[71]
    assert (player.last_name, player.weight, player.complete_record) == ("van Doe", 210, True)
    before = {t: sorted(map(str, tuples(warehouse.read_table(t)))) for t in ("Games", "Players", "Plays", "Teams")}
    again = transform_all(store, warehouse, AS_OF)
    assert all(n == 0 for per_type in again.values() for n in per_type.values())
    after = {t: sorted(map(str, tuples(warehouse.read_table(t)))) for t in before}
    assert before == after


def test_a_second_stream_adds_to_the_store(spark, tmp_path, store):
    for day, key in (("one", "11"), ("two", "12")):
        landing = str(tmp_path / day)
        documents(spark, (key, "game", GAME)).write.json(landing)
        ingest_stream(landed_records(spark, landing), store, AS_OF, str(tmp_path / f"cp-{day}"),
                      available_now=True).awaitTermination()
    assert sorted(r.document_key for r in store.documents().collect()) == ["11", "12"]


def many_keys(spark, *keys, record_type="game"):
    return spark.createDataFrame([(k, record_type) for k in keys], "document_key string, record_type string")


def plan_of(spark, df, mode="formatted"):
    return spark._jvm.PythonSQLUtils.explainString(df._jdf.queryExecution(), mode)


def test_a_batch_of_few_keys_reads_few_parts_of_the_manifest(spark, store):
    store.load_manifest(many_keys(spark, *map(str, range(500))), "first")
    batch = many_keys(spark, "7", "8", "9999")
    known = store.known_keys(batch)
    [filters] = [line for line in plan_of(spark, known).splitlines() if line.startswith("PartitionFilters")]
    assert re.search(r"part#\d+ (IN|INSET)", filters) and 1 <= known.select("document_key").count() < 500
    assert store.load_manifest(batch, "second") == "second"
    assert sorted(r.document_key for r in store.manifest().collect()) == sorted([*map(str, range(500)), "9999"])


def files_of(store, name):
    return store._read(name, "document_key STRING").inputFiles()


def test_many_small_loads_become_one(spark, store):
    for k in range(5):
        ingest_batch(documents(spark, (str(k), "game", GAME), (f"2024-03-0{k + 1}", "schedule", SCHEDULE)), store, AS_OF, f"l{k}")
    columns = ("document_key", "record_type", "document_timestamp", "up_to_date", "payload")

    def held():
        return sorted(map(tuple, store.documents().select(*columns).collect())), sorted(tuples(store.manifest()))

    before, n_files = held(), len(files_of(store, "documents"))
    named = store.compact()
    assert set(named) == {"documents", "manifest"} and held() == before
    assert len(files_of(store, "documents")) <= 2 < n_files
    # what ran before may run again under its name, and new loads are added
    ingest_batch(documents(spark, ("3", "game", GAME)), store, AS_OF, "l3")
    assert held() == before
    ingest_batch(documents(spark, ("9", "game", GAME)), store, AS_OF, "l9")
    grown = held()
    assert len(grown[0]) == len(before[0]) + 1
    store.compact()
    assert held() == grown and store._loads("documents") != [] and store.compact() == {}


@pytest.mark.parametrize("dies_in", ["_write", "_remove"])
def test_a_rewrite_that_dies_changes_nothing(spark, store, monkeypatch, dies_in):
    for k in range(3):
        ingest_batch(documents(spark, (str(k), "game", GAME)), store, AS_OF, f"l{k}")
    before = sorted(map(tuple, store.documents().collect())), sorted(tuples(store.manifest()))
    real = getattr(DocumentStore, dies_in)

    def dies(self, *args):
        if dies_in == "_write":
            real(self, *args)  # written, not yet named
        elif not args[1]:
            return
        raise RuntimeError("died")

    with monkeypatch.context() as patched:
        patched.setattr(DocumentStore, dies_in, dies)
        with pytest.raises(RuntimeError):
            store.compact()
    assert (sorted(map(tuple, store.documents().collect())), sorted(tuples(store.manifest()))) == before
    store.compact()
    assert (sorted(map(tuple, store.documents().collect())), sorted(tuples(store.manifest()))) == before
    assert len(store._loads("documents")) == 1


def test_pending_reads_the_same_documents_and_no_payload_before_the_anti_join(spark, tmp_path, store):
    ingest_batch(all_records(spark), store, AS_OF, "one")
    ingest_batch(documents(spark, ("11", "game", GAME), ("12", "game", GAME)), store, AS_OF, "two")
    warehouse = Warehouse(spark, str(tmp_path / "warehouse")).create_tables()
    for _ in range(2):
        for record_type, table in ((RecordType.GAME, "Games"), (RecordType.PLAYER, "Players")):
            mine = pending(store, warehouse, record_type)
            complete = discovery.complete_ids(warehouse.read_table(table))
            said = pending_documents(store.documents(), complete, record_type)
            assert sorted(r.document_key for r in mine.collect()) == sorted(r.document_key for r in said.collect())
            plan = mine._jdf.queryExecution().optimizedPlan().toString().splitlines()
            at = next(k for k, line in enumerate(plan) if "LeftAnti" in line)
            # what is read for the anti join: keys and times, no payloads
            below = [line for line in plan[at:] if "Project" in line or "Aggregate" in line]
            assert below and not any("payload" in line for line in below)
        transform_all(store, warehouse, AS_OF)


def test_batches_with_a_death_between_two_writes_equal_one_batch(spark, tmp_path, store):
    landing = str(tmp_path / "landing")
    for row in all_records(spark).collect():
        documents(spark, tuple(row)).write.mode("append").json(landing)

    class Dies(DocumentStore):
        def load_manifest(self, keys, load=None):
            if load.endswith("-1"):
                raise RuntimeError("died between two writes")
            return super().load_manifest(keys, load)

    def run(into):
        ingest_stream(landed_records(spark, landing, 1), into, AS_OF, str(tmp_path / "cp"), available_now=True).awaitTermination()

    with pytest.raises(Exception, match="died between"):
        run(Dies(spark, store.root))
    run(store)
    assert len(store._loads("documents")) >= 5  # a batch a file, empty ones too
    other = DocumentStore(spark, str(tmp_path / "other")).create()
    ingest_batch(all_records(spark), other, AS_OF, "one")
    columns = ("document_key", "record_type", "up_to_date", "payload")
    assert sorted(tuples(store.documents().select(*columns))) == sorted(tuples(other.documents().select(*columns)))
    assert sorted(tuples(store.manifest())) == sorted(tuples(other.manifest()))


def test_stages_take_only_what_earlier_ones_found(spark, tmp_path, store):
    landed = [*all_records(spark).filter("record_type <> 'other'").collect(), ("999", "game", json.dumps(GAME)), ("888", "player", json.dumps(PLAYER))]
    for row in landed:
        documents(spark, tuple(row)).write.mode("append").json(f"{tmp_path}/landing/{tuple(row)[1]}")
    worklist.ingest_staged(spark, f"{tmp_path}/landing", store, AS_OF, f"{tmp_path}/cp", listed_only=True, files=1)
    assert sorted(tuples(store.documents().select("record_type", "document_key"))) == [
        ("game", "11"), ("player", "71"), ("schedule", "2024-03-01"), ("standings", "2024")]


def test_files_of_documents_hold_few_of_them_in_a_row_group(spark, tmp_path):
    """Spark decodes a row group's documents together, up to 4,096 of them, with all their plays."""
    play = lambda k: F.struct(
        (F.col("id") * 200 + k).cast("string").alias("sequenceNumber"), F.sha1(F.concat_ws("-", "id", k)).alias("text"))
    plays = F.transform(F.sequence(F.lit(1), F.lit(200)), play)
    pages = spark.range(0, 1500, 1, 1).select(
        F.col("id").cast("string").alias("document_key"), F.lit("game").alias("record_type"),
        F.lit(True).alias("up_to_date"), F.to_json(F.struct(plays.alias("plays"))).alias("payload"))
    store = DocumentStore(spark, str(tmp_path / "store")).create()
    store.append_documents(pages)
    stored = store.documents()
    staged = transform._staged(parse_documents(stored, RecordType.GAME), RecordType.GAME)
    for files in (stored, staged):
        groups = []
        for name in files.inputFiles():
            held = pq.ParquetFile(re.sub("^file:/*", "/", name)).metadata
            groups += [held.row_group(k).num_rows for k in range(held.num_row_groups)]
        assert sum(groups) == 1500 and max(groups) <= 500
    assert staged.select(F.sum(F.size("parsed.plays"))).first()[0] == 300_000
