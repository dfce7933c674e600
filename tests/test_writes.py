"""Write operators and the warehouse."""

from datetime import date, datetime

import pytest

from courtflow.operators import writes
from courtflow.operators.keyed import one_per_key
from courtflow.operators.writes import WriteAction
from courtflow.plans.transform import transform_all
from courtflow.schemas import GAMES, PLAYERS, PLAYS, TABLES, TEAMS, VENUES
from courtflow.sources.documents import DocumentStore
from courtflow.sources.warehouse import Warehouse

INSERT, UPDATE, UPSERT = WriteAction.INSERT, WriteAction.UPDATE, WriteAction.UPSERT
VENUE = "id bigint, name string, city string, state string"


def rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def venues(spark, *values):
    return spark.createDataFrame([v + (None,) * (4 - len(v)) for v in values], VENUE)


def test_catalogue(spark):
    assert len(TABLES) == 13
    for spec in TABLES.values():
        for column in (*spec.primary_key, *spec.not_null, *spec.non_negative):
            assert column in spec.columns


def test_insert_ignore(spark):
    target = venues(spark, (1, "old"))
    source = venues(spark, (1, "new"), (2, "b"), (2, "a"), (None, "x"), (3, None))
    once = writes.insert_ignore(target, source, VENUES)
    assert rows(once.select("id", "name")) == [(1, "old"), (2, "a"), (3, None)]
    assert rows(writes.insert_ignore(once, source, VENUES)) == rows(once)
    # rows may bring some of the columns, in any order
    partial = spark.createDataFrame([("z", 9)], "name string, id int")
    assert rows(writes.insert_ignore(target, partial, VENUES)) == [(1, "old", None, None), (9, "z", None, None)]


def test_fill_update(spark):
    target = spark.createDataFrame(
        [(1, None, "A", 5), (2, "t", "B", 6), (3, None, "C", 7)],
        "id bigint, birth_city string, first_name string, weight bigint")
    source = spark.createDataFrame(
        [(1, "x", None), (1, "y", 1), (2, "z", 2), (4, "w", 3)], "id bigint, birth_city string, weight bigint")
    filled = writes.fill_update(target, source, PLAYERS)
    assert rows(filled) == [(1, "x", "A", None), (2, "t", "B", 6), (3, None, "C", 7)]
    assert rows(writes.fill_update(filled, source, PLAYERS)) == rows(filled)
    keep = writes.fill_update(target, source, PLAYERS, null_overwrites=False)
    assert rows(keep)[0] == (1, "x", "A", 5)
    only = writes.fill_update(target, source, PLAYERS, columns=["birth_city"])
    assert rows(only)[0] == (1, "x", "A", 5)
    assert rows(writes.fill_update(target, source.select("id"), PLAYERS)) == rows(target)


def test_upsert_overwrites_with_null(spark):
    target = venues(spark, (1, "a", "c", "s"), (2, "b", "c", "s"))
    source = spark.createDataFrame([(1, None), (3, "n")], "id bigint, name string")
    once = writes.upsert(target, source, VENUES)
    assert rows(once) == [(1, None, "c", "s"), (2, "b", "c", "s"), (3, "n", None, None)]
    assert rows(writes.upsert(once, source, VENUES)) == rows(once)


def test_constraints(spark):
    ddl = "game_id bigint, sequence_id bigint, play_type_id bigint, points_attempted bigint, " \
          "is_score boolean, clock_minutes bigint"
    good = (1, 1, 1, 0, True, None)
    frame = spark.createDataFrame(
        [good, (None, 2, 1, 0, True, 1), (1, 3, None, 0, True, 1), (1, 4, 1, 0, True, -1)], ddl)
    valid, bad = writes.constraint_check(frame, PLAYS)
    assert rows(valid) == [good]
    assert {r.reject_reason for r in bad.collect()} == {
        "game_id is null in key", "play_type_id is null", "clock_minutes is negative"}
    assert bad.count() == 3


def test_one_per_key_is_repeatable_for_a_hot_key(spark):
    frame = spark.range(30000).selectExpr("CASE WHEN id % 3 = 0 THEN 1 ELSE id END AS k", "id % 7 AS v", "id AS w")
    a = one_per_key(frame, ["k"]).filter("k = 1").collect()
    b = one_per_key(frame.repartition(5), ["k"]).filter("k = 1").collect()
    assert a == b and len(a) == 1 and a[0].v == 0


@pytest.fixture
def warehouse(spark, tmp_path):
    return Warehouse(spark, str(tmp_path / "w")).create_tables()


def test_batches(spark, warehouse):
    assert warehouse.read_table("Venues").count() == 0
    batch = [
        ("Venues", INSERT, venues(spark, (1, "a"), (2, None))),
        ("Venues", INSERT, spark.createDataFrame([(3, "c")], "id bigint, name string")),
        ("Teams", INSERT, spark.createDataFrame([(7, "L")], "id bigint, location string")),
    ]
    assert warehouse.write_batch(batch) == {("Venues", INSERT): 2, ("Teams", INSERT): 1}
    assert warehouse.write_batch(batch) == {("Venues", INSERT): 0, ("Teams", INSERT): 0}
    assert [r.reject_reason for r in warehouse.rejects("Venues").collect()] == ["name is null"]
    changes = [
        ("Venues", UPSERT, venues(spark, (1, "A", "city"), (4, "d"))),
        ("Teams", UPDATE, spark.createDataFrame([(7, "m"), (8, "n")], "id bigint, mascot string")),
    ]
    done = warehouse.write_batch(changes)
    assert done == {("Venues", UPSERT): 2, ("Teams", UPDATE): 1} and warehouse.total_rows(done) == 3
    assert rows(warehouse.read_table("Venues").select("id", "name", "city")) == [
        (1, "A", "city"), (3, "c", None), (4, "d", None)]
    assert rows(warehouse.read_table("Teams").select("id", "location", "mascot")) == [(7, "L", "m")]


def test_a_failed_batch_leaves_all_tables_alone(spark, warehouse):
    good = venues(spark, (1, "a"))
    broken = spark.range(1).selectExpr("id", "raise_error('lost') AS location")
    with pytest.raises(Exception, match="lost"):
        warehouse.write_batch([("Venues", INSERT, good), ("Teams", INSERT, broken)])
    assert warehouse.read_table("Venues").count() == 0
    warehouse.write_batch([("Venues", INSERT, good)])
    assert warehouse.read_table("Venues").count() == 1


def test_two_writers_cannot_take_one_version(spark, warehouse):
    version, tables = warehouse._current()
    warehouse.write_batch([("Venues", INSERT, venues(spark, (1, "a")))])
    with pytest.raises(Exception, match="already exists"):
        warehouse._commit(version + 1, tables)


def test_erase(spark, warehouse):
    warehouse.write_batch([("Venues", INSERT, venues(spark, (1, "a")))])
    assert warehouse.create_tables().read_table("Venues").count() == 1
    assert warehouse.create_tables(erase=True).read_table("Venues").count() == 0
    assert warehouse.read_table("Venues").schema == VENUES.schema and TEAMS.primary_key == ("id",)


def test_update_keeps_what_its_document_lacked_and_rejects_null_keys(spark, warehouse):
    warehouse.write_batch([("Teams", INSERT, spark.createDataFrame([(7, "L")], "id bigint, location string"))])
    change = spark.createDataFrame(
        [(7, "m", None), (None, "n", "x")], "id bigint, mascot string, location string")
    warehouse.write_batch([("Teams", UPDATE, change, {"null_overwrites": False})])
    assert rows(warehouse.read_table("Teams").select("id", "location", "mascot")) == [(7, "L", "m")]
    assert [r.mascot for r in warehouse.rejects("Teams").collect()] == ["n"]


def test_a_batch_without_new_rows_lists_nothing(spark, warehouse):
    batch = [("Venues", INSERT, venues(spark, (1, "a")))]
    warehouse.write_batch(batch)
    before = warehouse._current()[1]
    warehouse.write_batch(batch)
    assert warehouse._current()[1] == before


def test_rejects_of_a_rerun_or_a_failed_batch_are_not_listed(spark, warehouse):
    bad = ("Venues", INSERT, venues(spark, (1, None), (1, None), (2, None)))
    broken = spark.range(1).selectExpr("id", "raise_error('lost') AS location")
    with pytest.raises(Exception, match="lost"):
        warehouse.write_batch([bad, ("Teams", INSERT, broken)])
    assert warehouse.rejects("Venues").count() == 0
    warehouse.write_batch([bad])
    before = warehouse._current()[1]
    warehouse.write_batch([bad])
    assert warehouse._current()[1] == before
    assert sorted(r.id for r in warehouse.rejects("Venues").collect()) == [1, 2]


def test_the_newest_document_wins(spark, warehouse):
    ddl = "id bigint, name string, document_timestamp timestamp"
    day = [datetime(2025, 1, d) for d in (1, 2, 3)]
    frame = spark.createDataFrame([(1, "a", day[0]), (1, "z", day[1]), (1, "b", None), (2, "y", day[2]), (2, "x", day[2])], ddl)
    assert rows(one_per_key(frame, ["id"]).select("id", "name")) == [(1, "z"), (2, "x")]
    warehouse.write_batch([("Venues", INSERT, frame)])
    assert rows(warehouse.read_table("Venues").select("id", "name")) == [(1, "z"), (2, "x")]
    later = frame.selectExpr("id", "upper(name) AS name", "document_timestamp")
    assert warehouse.write_batch([("Venues", UPSERT, later)]) == {("Venues", UPSERT): 2}
    assert rows(warehouse.read_table("Venues").select("id", "name")) == [(1, "Z"), (2, "X")]


def test_a_team_is_named_as_its_newest_page_does(spark, tmp_path, warehouse):
    store = DocumentStore(spark, str(tmp_path / "store")).create()
    page = '{"page":{"content":{"events":{"d":[{"id":"%d","teams":[{"id":"1","location":"%s"}]}]}}}}'
    for n, name in enumerate(("Aged", "New")):
        store.append_documents(spark.createDataFrame(
            [(f"2025-01-0{n + 1}", "schedule", page % (n, name), True)],
            "document_key string, record_type string, payload string, up_to_date boolean"))
    transform_all(store, warehouse, date(2025, 2, 1))
    assert [r.location for r in warehouse.read_table("Teams").collect()] == ["New"]


def test_no_folder_of_one_machine_on_a_cluster():
    from types import SimpleNamespace

    from courtflow.session import shared_folder

    conf = SimpleNamespace(get=lambda key, default=None: None)
    with pytest.raises(ValueError, match="share"):
        shared_folder(SimpleNamespace(conf=conf, sparkContext=SimpleNamespace(master="spark://host")))


def test_a_change_of_one_game_reads_and_writes_one_part(spark, warehouse):
    ddl = "id bigint, home_id bigint, away_id bigint, status_id bigint"
    games = spark.createDataFrame([(k, 1, 2, 3) for k in range(200)], ddl)
    warehouse.write_batch([("Games", INSERT, games)])
    before = warehouse._current()[1]["Games"]
    assert len(before) == GAMES.parts
    change = spark.createDataFrame([(7, 900)], "id bigint, attendance bigint")
    assert warehouse.write_batch([("Games", UPDATE, change)]) == {("Games", UPDATE): 1}
    after = warehouse._current()[1]["Games"]
    assert len(after) == GAMES.parts and len(set(before) - set(after)) == 1
    [gone], [new] = set(before) - set(after), set(after) - set(before)
    assert gone.rpartition("/")[2] == new.rpartition("/")[2]
    kept = spark.read.parquet(gone).select("id")
    assert rows(spark.read.parquet(new).select("id")) == rows(kept) and kept.filter("id = 7").count() == 1
    table = warehouse.read_table("Games")
    assert table.count() == 200 and table.filter("attendance = 900").count() == 1
    # an update that meets no row, and an upsert of a new one
    nothing = spark.createDataFrame([(999, 900)], "id bigint, attendance bigint")
    assert warehouse.write_batch([("Games", UPDATE, nothing)]) == {("Games", UPDATE): 0}
    assert warehouse._current()[1]["Games"] == after
    more = spark.createDataFrame([(7, 5, 6, 7), (500, 5, 6, 7)], ddl)
    assert warehouse.write_batch([("Games", UPSERT, more)]) == {("Games", UPSERT): 2}
    table = warehouse.read_table("Games")
    assert table.count() == 201 and table.filter("home_id = 5").count() == 2
    assert table.filter("attendance = 900").count() == 1
    assert len(set(after) - set(warehouse._current()[1]["Games"])) <= 2


def test_an_update_of_an_empty_table_with_parts(spark, warehouse):
    change = spark.createDataFrame([(7, 900)], "id bigint, attendance bigint")
    assert warehouse.write_batch([("Games", UPDATE, change)]) == {("Games", UPDATE): 0}
    assert warehouse.read_table("Games").count() == 0
