"""Places without a task that sees a whole group, and lineup steps that lean on them."""

import random

import pytest
from pyspark.sql import functions as F

from courtflow.operators import lineups, ordering
from courtflow.operators.numbering import places, positions

DDL = "g bigint, a bigint, b bigint"


def rows_of(n, hot, seed=4):
    """A share of the rows in one group with one value of a; b is unique."""
    rng = random.Random(seed)
    return [(None if rng.random() < 0.05 else 7, None, b) if rng.random() < hot else (rng.randint(0, 5), rng.choice([None, 1, 2]), b)
            for b in rng.sample(range(10 * n), n)]


def key(row):
    return tuple((v is not None, v or 0) for v in row)


@pytest.mark.parametrize("n, hot", [(0, 0.0), (1, 0.0), (500, 0.3), (3000, 0.9)])
def test_places_and_positions(spark, n, hot):
    data = rows_of(n, hot)
    df = spark.createDataFrame(data, DDL).repartition(3)
    order = [F.col("a").asc_nulls_first(), F.col("b").asc()]
    got = {(r.g, r.a, r.b): r.place for r in places(df, ["g"], order, "place").collect()}
    seen, expected = {}, {}
    for row in sorted(data, key=key):
        expected[row] = seen.setdefault(row[0], 0)
        seen[row[0]] += 1
    assert got == expected
    everywhere = positions(df, [F.col("g").asc_nulls_first(), *order], "place").collect()
    assert {(r.g, r.a, r.b): r.place for r in everywhere} == {row: k for k, row in enumerate(sorted(data, key=key))}


def test_a_hot_reading_lies_in_many_ranges(spark):
    """A third of all rows share one sort key but for the last column."""
    from courtflow.operators.numbering import _in_ranges

    df = spark.range(30_000).selectExpr("CASE WHEN id % 3 = 0 THEN -1 ELSE id END AS g", "CAST(NULL AS BIGINT) AS a", "id AS b")
    ranged = _in_ranges(df, [F.col("g"), F.col("a"), F.col("b")])
    per_task = [r["count"] for r in ranged.groupBy("_part").count().collect()]
    assert len(per_task) == 8 and max(per_task) < 2 * 30_000 / 8
    assert ranged.filter("g = -1").select("_part").distinct().count() > 2


def plays_with_hot_game(spark, n):
    return spark.range(n).selectExpr(
        "CASE WHEN id % 3 = 0 THEN 1 ELSE 2 + id div 50 END AS game_id", "id AS sequence_id",
        "CASE WHEN id % 20 = 0 THEN 584 ELSE 1 END AS play_type_id", "100 + id % 2 AS team_id", "1 + id % 16 AS player_id",
        "1L AS period", "CASE WHEN id % 3 > 0 THEN 19 - id % 7 END AS clock_minutes", "CASE WHEN id % 3 > 0 THEN id % 5 END AS clock_seconds",
        "CAST(NULL AS BIGINT) AS home_score", "CAST(NULL AS BIGINT) AS away_score")


def test_only_substitutions_go_through_the_fold(spark, monkeypatch):
    plays = plays_with_hot_game(spark, 3000)
    games = plays.select(F.col("game_id").alias("id"), F.lit(100).alias("home_id")).distinct()
    logs = spark.createDataFrame([], "game_id bigint, player_id bigint, started boolean")
    folded = []
    real = lineups._fold_slots
    passed = spark.sparkContext.accumulator(0)

    def counting(batches):
        def each():
            for batch in batches:
                passed.add(batch.num_rows)
                yield batch
        return real(each())

    monkeypatch.setattr(lineups, "_fold_slots", counting)
    found = lineups.with_in_play(plays, logs, games, keyed=True)
    folded = found.collect()
    subs = lineups._booked_subs(plays, logs, lineups.MENS_RULE, True).count()
    assert len(folded) == 3000
    # the two uses of the folded rows may each run it
    assert 0 < passed.value <= 2 * subs < 3000


def test_sets_of_a_game_are_bounded_by_its_changes(spark):
    plays = plays_with_hot_game(spark, 3000)
    games = plays.select(F.col("game_id").alias("id"), F.lit(100).alias("home_id")).distinct()
    logs = spark.createDataFrame([], "game_id bigint, player_id bigint, started boolean")
    sets = lineups.lineup_sets(plays, logs, games, keyed=True)
    plan = spark._jvm.PythonSQLUtils.explainString(sets._jdf.queryExecution(), "simple")
    assert plan.count("Exchange ") < 10  # broadcasts too
    assert sets.count() == 3000


def test_number_plays_of_one_game(spark):
    plays = plays_with_hot_game(spark, 900).withColumn("game_id", F.lit(1).cast("bigint"))
    found = sorted((r.place, r.sequence_id) for r in ordering.number_plays(plays).collect())
    assert [p for p, _ in found] == list(range(1, 901))
    in_order = [r.sequence_id for r in ordering.sort_plays(plays).collect()]
    assert [s for _, s in found] == in_order
    positions_ = {r.sequence_id: r.position for r in ordering.sorted_positions(plays).collect()}
    assert [positions_[s] for s in in_order] == list(range(1, 901))
