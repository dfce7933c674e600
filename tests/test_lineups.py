"""Lineups on hand-made games, and on random games against a plain statement."""

import random
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from courtflow.functions.periods import CustomPeriodRule, PeriodRule
from courtflow.operators import lineups, ordering

PLAYS = (
    "game_id bigint, sequence_id bigint, play_type_id bigint, team_id bigint, "
    "player_id bigint, period bigint, clock_minutes bigint, clock_seconds bigint, "
    "home_score bigint, away_score bigint"
)
LOGS = "game_id bigint, player_id bigint, started boolean"
SUB, SHOT = 584, 1
HOME, AWAY = 100, 200


def frames(spark, plays, logs, games):
    return (
        spark.createDataFrame(plays, PLAYS),
        spark.createDataFrame(logs, LOGS),
        spark.createDataFrame(games, "id bigint, home_id bigint"),
    )


def minutes(spark, plays, logs, **kwargs):
    p, g, _ = frames(spark, plays, logs, [(1, HOME)])
    rows = lineups.game_minutes(p, g, **kwargs).collect()
    return {(r.game_id, r.player_id): round(r.minutes, 6) for r in rows}


def play(seq, type_, player, period, m, s, team=HOME, game=1, score=0):
    return (game, seq, type_, team, player, period, m, s, score, score)


def test_starter_who_plays_all(spark):
    plays = [play(1, SHOT, 7, 1, 10, 0), play(2, SHOT, 7, 2, 0, 30)]
    assert minutes(spark, plays, [(1, 7, True)]) == {(1, 7): 40.0}


def test_starter_without_a_play_is_left_out(spark):
    plays = [play(1, SHOT, 7, 2, 10, 0)]
    assert minutes(spark, plays, [(1, 7, True), (1, 8, True)]) == {(1, 7): 40.0}


def test_in_and_out_across_halves_and_overtime(spark):
    plays = [
        play(1, SUB, 8, 1, 5, 30),  # in
        play(2, SUB, 8, 2, 19, 0),  # out: 5.5 + 1
        play(3, SUB, 8, 3, 2, 0),  # in, first overtime
        play(4, SHOT, 9, 3, 1, 0),
    ]
    assert minutes(spark, plays, [(1, 8, False)]) == {(1, 8): 5.5 + 1 + 2}


def test_same_reading_double_substitution(spark):
    plays = [
        play(1, SUB, 7, 1, 15, 0),  # starter goes out: 5
        play(2, SUB, 7, 1, 15, 0),  # and comes back at once
        play(3, SUB, 7, 2, 20, 0),  # out: 15
    ]
    assert minutes(spark, plays, [(1, 7, True)]) == {(1, 7): 20.0}
    p, g, _ = frames(spark, plays, [(1, 7, True)], [])
    durations = lineups.with_sub_durations(p, g).orderBy("sub_index").collect()
    assert [r.sub_duration for r in durations] == [None, 5.0, 0.0, 15.0]


def test_one_rule_reaches_every_step(spark):
    quarters = PeriodRule(4, 10, 5)
    plays = [play(1, SHOT, 7, 4, 3, 0)]
    for rule in (quarters, CustomPeriodRule(quarters.minutes)):
        assert minutes(spark, plays, [(1, 7, True)], rule=rule) == {(1, 7): 40.0}


def test_duplicates_are_dropped_unless_keyed(spark):
    shot = play(1, SHOT, 7, 2, 10, 0)
    p, g, _ = frames(spark, [shot, shot], [(1, 7, True)], [])
    assert lineups.add_sub_bookends(p, g).count() == 3
    assert lineups.add_sub_bookends(p, g, keyed=True).count() == 4


def in_play(spark, plays, logs, games=((1, HOME),)):
    rows = lineups.with_in_play(*frames(spark, plays, logs, list(games))).collect()
    return {(r.game_id, r.sequence_id): (r.home_in_play, r.away_in_play) for r in rows}


def test_sixth_player_takes_the_last_slot(spark):
    logs = [(1, p, True) for p in range(1, 6)]
    plays = [play(p, SHOT, p, 1, 19, 0) for p in range(1, 6)]
    plays += [play(10, SUB, 6, 1, 10, 0), play(11, SHOT, 6, 1, 9, 0)]
    plays += [play(12, SUB, 6, 1, 8, 0), play(13, SHOT, 1, 1, 7, 0)]
    plays += [play(14, SUB, 8, 1, 6, 0), play(15, SHOT, 8, 1, 5, 30)]
    plays += [play(16, SUB, 1, 1, 5, 0), play(17, SHOT, 8, 1, 4, 0)]
    got = in_play(spark, plays, logs)
    # starters enter by their start rows' ids, -50 first
    assert got[1, 1][0] == [5, 4, 3, 2, 1]
    assert got[1, 11][0] == [5, 4, 3, 2, 6]
    assert got[1, 13][0] == [5, 4, 3, 2, -1]
    assert got[1, 15][0] == [5, 4, 3, 2, 8]
    # player 1 is no longer on court, so going out empties the last slot
    assert got[1, 17][0] == [5, 4, 3, 2, -1]


def test_unknown_game_and_missing_team(spark):
    plays = [play(1, SUB, 7, 1, 10, 0, team=None), play(2, SHOT, 7, 1, 9, 0),
             play(1, SHOT, 7, 1, 9, 0, game=2)]
    got = in_play(spark, plays, [])
    assert set(got) == {(1, 1), (1, 2)}
    assert got[1, 2] == ([-1] * 5, [7, -1, -1, -1, -1])


def random_games(seed, sizes):
    rng = random.Random(seed)
    plays, logs, games = [], [], []
    for game, size in enumerate(sizes, start=1):
        games.append((game, HOME))
        roster = {p: HOME if p % 2 else AWAY for p in range(1, 17)}
        logs += [(game, p, p <= 10) for p in roster]
        for seq in range(1, size + 1):
            player = rng.choice([*roster, None]) if rng.random() < 0.1 else rng.choice([*roster])
            clock = rng.choice([(rng.randint(0, 19), rng.randint(0, 3)), (0, 0), (None, None)])
            plays.append(
                (game, seq, rng.choice([SUB, SHOT, SHOT, None]),
                 None if rng.random() < 0.02 else roster.get(player, HOME), player,
                 rng.randint(1, 3), *clock, rng.choice([None, 0, 5]), rng.randint(0, 5))
            )
    return plays, logs, games


FIRST = float("-inf")


def up(v):
    return FIRST if v is None else v


def down(v):
    return FIRST if v is None else -v


def stated(plays, logs, games):
    """The rules, row by row: {(game, seq): (home, away)} and {(game, player): minutes}."""
    names = [c.split()[0] for c in PLAYS.split(", ")]
    by_game = defaultdict(list)
    for row in plays:
        by_game[row[0]].append(dict(zip(names, row, strict=True)))
    home_of, states, totals = dict(games), {}, {}
    for game, rows in by_game.items():
        def sub_row(seq, player, team, period, m):
            return {**dict.fromkeys(names), "game_id": game, "sequence_id": seq,
                    "play_type_id": SUB, "team_id": team, "player_id": player,
                    "period": period, "clock_minutes": m, "clock_seconds": 0}

        teams = defaultdict(list)
        for r in rows:
            if r["player_id"] is not None:
                teams[r["player_id"]].append(r["team_id"])
        known = {p: min((t for t in ts if t is not None), default=None) for p, ts in teams.items()}
        extra = [sub_row(-10 * p, p, known[p], 1, 20)
                 for g, p, started in logs if g == game and started and p in known]
        subs = [r for r in rows if r["play_type_id"] == SUB]
        last = max(r["period"] for r in rows)
        for p in known:
            own = [r for r in subs + extra if r["player_id"] == p]
            if len(own) % 2:
                team = max((r["team_id"] for r in own if r["team_id"] is not None), default=None)
                extra.append(sub_row(-10 * p - 1, p, team, last, 0))
        subs += extra
        subs.sort(key=lambda r: (up(r["period"]), down(r["clock_minutes"]), down(r["clock_seconds"]),
                                 up(r["home_score"]), up(r["away_score"]), r["sequence_id"]))
        seen, before = defaultdict(int), {}
        for r in subs:
            r["sub_index"] = seen[r["player_id"]]
            seen[r["player_id"]] += 1
            if r["sub_index"] % 2:
                b = before[r["player_id"]]
                if None not in (r["clock_minutes"], b["clock_minutes"]):
                    passed = sum(20 if q <= 2 else 5 for q in range(b["period"] + 1, r["period"] + 1))
                    d = (passed + b["clock_minutes"] - r["clock_minutes"]
                         + (b["clock_seconds"] - r["clock_seconds"]) / 60)
                else:
                    d = 0.0
                key = game, r["player_id"]
                totals[key] = totals.get(key, 0.0) + d
            before[r["player_id"]] = r
        everything = subs + [r for r in rows if r["play_type_id"] != SUB]

        def place(r):
            index = r.get("sub_index", -1)
            mark = 0 if r["sequence_id"] >= 0 else (-1 if r["clock_minutes"] > 0 else 1)
            return (up(r["period"]), down(r["clock_minutes"]), down(r["clock_seconds"]), mark,
                    index < 0, -(index % 2), up(r["team_id"]), r["sequence_id"])

        court = {True: [-1] * 5, False: [-1] * 5}
        for r in sorted(everything, key=place):
            if "sub_index" in r:
                team = -1 if r["team_id"] is None else r["team_id"]
                player = -1 if r["player_id"] is None else r["player_id"]
                slots = court[team == home_of[game]]
                leaves, enters = (player, -1) if r["sub_index"] % 2 else (-1, player)
                slots[slots.index(leaves) if leaves in slots else 4] = enters
            if r["sequence_id"] >= 0:
                states[game, r["sequence_id"]] = (list(court[True]), list(court[False]))
    return states, totals


# the middle game holds nearly all rows: a hot key
@pytest.mark.parametrize("seed, sizes", [(1, (30, 60, 25)), (2, (20, 9000, 40))])
def test_random_games_follow_the_stated_rules(spark, seed, sizes):
    plays, logs, games = random_games(seed, sizes)
    states, totals = stated(plays, logs, games)
    got = in_play(spark, plays, logs, games)
    assert got == states
    mine = minutes(spark, plays, logs)
    assert mine == {k: round(v, 6) for k, v in totals.items()}


def test_small_batches_carry_the_slots_over(spark):
    plays, logs, games = random_games(3, (40, 300))
    states, _ = stated(plays, logs, games)
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        assert in_play(spark, plays, logs, games) == states
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_invariants(spark):
    from conftest import SF_DIR

    from courtflow.plans import fixtures

    plays = fixtures.plays(spark, SF_DIR)
    logs, games = fixtures.game_logs(spark, SF_DIR), fixtures.games(spark, SF_DIR)
    subs = lineups.with_sub_durations(plays, logs, keyed=True)
    per_player = subs.groupBy("game_id", "player_id").agg(
        F.count("*").alias("n"), F.max("sub_index").alias("last"), F.min("sub_duration").alias("least")
    )
    assert per_player.filter("n % 2 = 1 OR last <> n - 1 OR least < 0").count() == 0
    assert lineups.game_minutes(plays, logs, keyed=True).filter("minutes > 50 OR minutes < 0").count() == 0
    got = lineups.with_in_play(plays, logs, games, keyed=True)
    assert got.count() == plays.count() == got.select("game_id", "sequence_id").distinct().count()


def test_sets_equal_slots_while_no_side_exceeds_five(spark):
    logs = [(1, p, True) for p in range(1, 6)]
    plays = [play(p, SHOT, p, 1, 19, 0) for p in range(1, 6)]
    plays += [play(10, SUB, 1, 1, 10, 0), play(11, SUB, 6, 1, 10, 0), play(12, SHOT, 6, 1, 9, 0),
              play(13, SUB, 2, 2, 9, 0), play(14, SUB, 7, 2, 9, 0), play(15, SHOT, 7, 2, 0, 0)]
    p, g, games = frames(spark, plays, logs, [(1, HOME)])
    slots = lineups.with_in_play(p, g, games)
    sets = lineups.lineup_sets(p, g, games).select("sequence_id", "home_set")
    both = slots.join(sets, "sequence_id").filter(lineups.is_other()).collect()
    assert len(both) == 7
    for row in both:
        assert sorted(x for x in row.home_in_play if x != -1) == row.home_set


def test_sort_plays_puts_nulls_first(spark):
    plays = [play(1, SHOT, 7, 1, 5, 0), play(2, SHOT, 7, 1, None, 0), play(3, SHOT, 7, 1, 9, 0)]
    p, _, _ = frames(spark, plays, [], [])
    assert [r.sequence_id for r in ordering.sort_plays(p).collect()] == [2, 3, 1]
    places = {r.sequence_id: r.place for r in ordering.number_plays(p).collect()}
    assert places == {2: 1, 3: 2, 1: 3}
    dated = p.withColumn("datetime", F.when(F.col("sequence_id") == 1, F.lit(1)).otherwise(F.lit(2)))
    assert [r.sequence_id for r in ordering.sort_plays(dated, True).collect()] == [1, 2, 3]


def test_rows_of_one_key_all_get_its_lineup(spark):
    plays = [
        play(1, SHOT, 7, 1, 10, 0),
        play(2, SUB, 8, 1, 5, 0),
        play(2, SHOT, 9, 1, 5, 0),  # the same key, another type
        play(3, SHOT, 7, 1, 4, 0),
    ]
    p, logs, games = frames(spark, plays, [(1, 7, True)], [(1, HOME)])
    found = lineups.with_in_play(p, logs, games).collect()
    assert sorted(r.sequence_id for r in found) == [1, 2, 2, 3]
    assert len({tuple(r.home_in_play) for r in found if r.sequence_id == 2}) == 1
