"""Substitution order, stints, minutes played and the five on court.

Only substitution rows are ever shuffled by player or folded in order, and they are
first reduced to clock readings: a game has a few thousand readings at most, however
many rows it holds. All other plays meet the result by a join on (game, reading).
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtflow.functions.periods import MENS_RULE, PeriodRule, minutes_since
from courtflow.operators.keyed import one_per_key
from courtflow.operators.numbering import places
from courtflow.operators.ordering import READING, order_columns, play_order, reading_order
from courtflow.session import written

# fixed values: play type of a substitution, slots of a side, mark of an empty slot
SUB_TYPE_ID = 584
SLOTS = 5
EMPTY = -1


def is_sub() -> Column:
    """Null for a play without a type, so that a filter on it reaches the scan."""
    return F.col("play_type_id") == SUB_TYPE_ID


def is_other() -> Column:
    return ~F.coalesce(is_sub(), F.lit(False))


def _bookends(plays: DataFrame, game_logs: DataFrame, rule: PeriodRule) -> DataFrame:
    """Substitution rows for players who start or finish the game on court."""
    # rows without a player still tell how long the game went on
    players = (
        plays.groupBy("game_id", "player_id")
        .agg(
            F.min("team_id").alias("any_team"),
            F.max(F.when(is_sub(), F.col("team_id"))).alias("sub_team"),
            F.count_if(is_sub()).alias("n_subs"),
            F.max("period").alias("period"),
        )
    )
    starters = (
        game_logs.filter("started AND player_id >= 1")
        .select("game_id", "player_id")
        .distinct()
        .withColumn("starts", F.lit(True))
    )

    starts = F.coalesce("starts", F.lit(False))
    # going in is always the first move, so an odd count ends on court
    finishes = (F.col("n_subs") + starts.cast("int")) % 2 == 1

    def row(sequence_id: Column, period: Column, minutes: Column, team: Column) -> Column:
        return F.struct(
            sequence_id.cast("bigint").alias("sequence_id"),
            period.cast("bigint").alias("period"),
            minutes.cast("bigint").alias("clock_minutes"),
            F.lit(0).cast("bigint").alias("clock_seconds"),
            team.cast("bigint").alias("team_id"),
        )

    start_row = row(
        F.col("player_id") * -10, F.lit(1), rule.minutes(F.lit(1)), F.col("any_team")
    )
    # greatest() skips nulls
    finish_row = row(
        F.col("player_id") * -10 - 1,
        F.col("last_period"),
        F.lit(0),
        F.greatest("sub_team", F.when(starts, F.col("any_team"))),
    )
    rows = F.array(F.when(starts, start_row), F.when(finishes, finish_row))
    return (
        players.join(starters, ["game_id", "player_id"], "left")
        .withColumn("last_period", F.max("period").over(Window.partitionBy("game_id")))
        .filter((F.col("player_id") >= 1) & (starts | finishes))
        .select("game_id", "player_id", F.explode(F.array_compact(rows)).alias("row"))
        .select(
            "game_id",
            "player_id",
            "row.*",
            F.lit(SUB_TYPE_ID).cast("bigint").alias("play_type_id"),
        )
    )


def add_sub_bookends(
    plays: DataFrame,
    game_logs: DataFrame,
    rule: PeriodRule = MENS_RULE,
    keep_non_sub: bool = True,
    keyed: bool = False,
) -> DataFrame:
    """Plays (or only the substitutions) with a start and a finish row per player.

    ``keyed`` says that (game_id, sequence_id) is already unique, as in a stored
    Plays table; otherwise one row per key is kept, which shuffles every play.
    """
    base = plays if keep_non_sub else plays.filter(is_sub())
    booked = base.unionByName(
        _bookends(plays, game_logs, rule), allowMissingColumns=True
    )
    return booked if keyed else one_per_key(booked, ["game_id", "sequence_id"])


def _booked_subs(
    plays: DataFrame, game_logs: DataFrame, rule: PeriodRule, keyed: bool
) -> DataFrame:
    # duplicates are settled among all plays, so only keyed plays may be cut early
    booked = add_sub_bookends(
        plays, game_logs, rule, keep_non_sub=not keyed, keyed=keyed
    )
    return booked.filter(is_sub())


def player_readings(subs: DataFrame) -> DataFrame:
    """One row per game, player and clock reading that has substitutions.

    ``n_here`` substitutions happen at it, ``n_before`` earlier in the game, and
    ``last_*`` is the player's reading before it. The count combines on the map
    side, so the window sees at most one row per tick of the game clock, even for
    a player who holds a third of all rows.
    """
    player = Window.partitionBy("game_id", "player_id").orderBy(*reading_order())
    earlier = player.rowsBetween(Window.unboundedPreceding, -1)
    last = [F.lag(c).over(player).alias(f"last_{c}") for c in READING]
    return (
        subs.groupBy("game_id", "player_id", *READING)
        .agg(
            F.count("sequence_id").alias("n_here"), F.max("team_id").alias("team_id")
        )
        .select(
            "*",
            F.coalesce(F.sum("n_here").over(earlier), F.lit(0)).alias("n_before"),
            *last,
        )
    )


def _index_subs(subs: DataFrame) -> DataFrame:
    """Substitutions with sub_index, their place among the player's, from 0."""
    return places(subs, ["game_id", "player_id"], play_order(), "sub_index")


def _with_last(subs: DataFrame) -> DataFrame:
    """Indexed substitutions with the reading of the same player's previous one (last_*).

    Every row meets at most one other, so no player or reading can be hot.
    """
    spot = F.struct("player_id", "sub_index")
    following = F.struct("player_id", (F.col("sub_index") + 1).alias("sub_index"))
    last = subs.select(
        "game_id", following.alias("_spot"), *[F.col(c).alias(f"last_{c}") for c in READING]
    )
    return subs.withColumn("_spot", spot).join(last, ["game_id", "_spot"], "left").drop("_spot")


def with_sub_index(
    plays: DataFrame,
    game_logs: DataFrame,
    rule: PeriodRule = MENS_RULE,
    keyed: bool = False,
) -> DataFrame:
    """Running number of a player's substitutions in a game, from 0.

    Even is coming in, odd is going out, -1 marks every other play. Start and finish
    rows are part of the result. Other plays pass through without a shuffle.
    """
    booked = add_sub_bookends(plays, game_logs, rule, keyed=keyed)
    subs = _index_subs(_booked_subs(plays, game_logs, rule, keyed))
    others = booked.filter(is_other()).withColumn(
        "sub_index", F.lit(-1).cast("bigint")
    )
    return others.unionByName(subs, allowMissingColumns=True)


def _minutes_since_last(rule: PeriodRule) -> Column:
    return minutes_since(
        tuple(F.col(f"last_{c}") for c in READING),
        tuple(F.col(c) for c in READING),
        rule,
    )


def with_sub_durations(
    plays: DataFrame,
    game_logs: DataFrame,
    rule: PeriodRule = MENS_RULE,
    sub_duration_col: str = "sub_duration",
    keyed: bool = False,
) -> DataFrame:
    """Substitutions with the minutes since the same player's previous one."""
    subs = _booked_subs(plays, game_logs, rule, keyed)
    return (
        _with_last(_index_subs(subs))
        .withColumn(sub_duration_col, _minutes_since_last(rule))
        .drop(*[f"last_{c}" for c in READING])
    )


def game_minutes(
    plays: DataFrame,
    game_logs: DataFrame,
    rule: PeriodRule = MENS_RULE,
    keyed: bool = False,
) -> DataFrame:
    """Minutes in play of each player in each game.

    Worked out on clock readings alone: further substitutions at a reading the
    player already has add no time, so a reading counts if its first one goes out.
    """
    goes_out = F.col("n_before") % 2 == 1
    return (
        player_readings(_booked_subs(plays, game_logs, rule, keyed))
        .groupBy("game_id", "player_id")
        .agg(
            F.coalesce(
                F.sum(F.when(goes_out, _minutes_since_last(rule))), F.lit(0.0)
            ).alias("minutes"),
            F.sum("n_here").alias("_n"),
        )
        .filter(F.col("_n") > 1)
        .drop("_n")
    )


def _fold_slots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Carry both sides' slots through substitutions sorted by game and time.

    Holds ten slots, a count and the current batch, never a game. ``move`` numbers a game's
    substitutions from 1.
    """
    game, move, sides = None, 0, ([EMPTY] * SLOTS, [EMPTY] * SLOTS)
    for batch in batches:
        states, numbers = [], []
        columns = [batch.column(c).to_pylist() for c in ("game_id", "is_away", "goes_out", "player_id")]
        for own, is_away, goes_out, player in zip(*columns, strict=True):
            if own != game:
                game, move, sides = own, 0, ([EMPTY] * SLOTS, [EMPTY] * SLOTS)
            slots = sides[is_away]
            leaves, enters = (player, EMPTY) if goes_out else (EMPTY, player)
            # without a match the last slot is taken
            slots[slots.index(leaves) if leaves in slots else SLOTS - 1] = enters
            move += 1
            numbers.append(move)
            states.append(sides[0] + sides[1])
        after = np.array(states, dtype=np.int64).reshape(-1, 2 * SLOTS)
        offsets = pa.array(np.arange(batch.num_rows + 1, dtype=np.int32) * SLOTS)
        home, away = (
            pa.ListArray.from_arrays(offsets, pa.array(side.reshape(-1)))
            for side in (after[:, :SLOTS], after[:, SLOTS:])
        )
        yield pa.RecordBatch.from_arrays(
            [batch.column("game_id"), batch.column("spot"), pa.array(numbers, pa.int64()), home, away],
            names=["game_id", "spot", "move", "home_in_play", "away_in_play"],
        )


_SPOT = (
    "struct<period: bigint, clock_minutes: bigint, clock_seconds: bigint, "
    "sub_sequence_id: bigint>"
)
_READING = "struct<period: bigint, clock_minutes: bigint, clock_seconds: bigint>"
_FOLDED = (
    f"game_id bigint, spot {_SPOT}, move bigint, "
    "home_in_play array<bigint>, away_in_play array<bigint>"
)


def _spot(sub_sequence_id: Column) -> Column:
    """Where a play finds its lineup: its clock reading and, for a substitution, itself."""
    return F.struct(
        *READING, sub_sequence_id.cast("bigint").alias("sub_sequence_id")
    ).cast(_SPOT)


def with_in_play(
    plays: DataFrame,
    game_logs: DataFrame,
    games: DataFrame,
    rule: PeriodRule = MENS_RULE,
    keyed: bool = False,
) -> DataFrame:
    """Every play of a known game with the five players on court per side.

    A substitution shows the lineup right after itself. Any other play shows the
    lineup after all substitutions at its clock reading, so all such plays of a reading
    share one answer, and plays themselves are not sorted but joined.

    Which slot a player takes depends on every substitution before, so one game's
    substitutions pass through one task, as a stream of narrow rows. Clock readings do not:
    running counts tell a reading how many substitutions lie behind, and it looks up the
    lineup after the last of them.
    """
    start = (F.col("sequence_id") < 0) & (F.col("clock_minutes") > 0)
    bookend = F.when(start, -1).when(F.col("sequence_id") < 0, 1).otherwise(0)
    none = F.lit(EMPTY)
    at_home = F.coalesce("team_id", none) == F.coalesce("home_id", none)
    homes = games.select(F.col("id").alias("game_id"), "home_id")
    moves = _index_subs(_booked_subs(plays, game_logs, rule, keyed)).withColumn("bookend", bookend)
    folded = (
        moves.join(homes, "game_id")
        .select(
            F.col("game_id").cast("bigint").alias("game_id"),
            _spot(F.col("sequence_id")).alias("spot"),
            "team_id",
            "bookend",
            (F.col("sub_index") % 2 == 1).alias("goes_out"),
            (~at_home).alias("is_away"),
            F.coalesce("player_id", none).cast("bigint").alias("player_id"),
        )
        .repartition("game_id")
        .sortWithinPartitions(
            "game_id",
            *reading_order("spot."),
            *order_columns(
                [
                    ("bookend", False),
                    ("goes_out", True),
                    ("team_id", False),
                    ("spot.sub_sequence_id", False),
                ]
            ),
        )
        .mapInArrow(_fold_slots, _FOLDED)
    )
    # written, as readings and substitutions both look lineups up and the fold is not split
    folded = written(folded, "lineups")
    # finish rows come after the plays of their reading
    counts = moves.select(
        "game_id", *READING, F.lit(1).alias("n"), (F.col("bookend") < 1).cast("int").alias("n_ahead"),
        F.lit(False).alias("is_asked"),
    )
    asked = plays.filter(is_other()).select(
        "game_id", *READING, F.lit(0).alias("n"), F.lit(0).alias("n_ahead"), F.lit(True).alias("is_asked")
    )
    earlier = (
        Window.partitionBy("game_id")
        .orderBy(*reading_order())
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    readings = (
        counts.unionByName(asked)
        .groupBy("game_id", *READING)
        .agg(F.sum("n").alias("n"), F.sum("n_ahead").alias("n_ahead"), F.max("is_asked").alias("is_asked"))
        .withColumn("move", F.coalesce(F.sum("n").over(earlier), F.lit(0)) + F.col("n_ahead"))
        .filter("is_asked")
        .join(homes.select("game_id"), "game_id")
        .select(F.col("game_id").cast("bigint").alias("game_id"), _spot(F.lit(None)).alias("spot"), "move")
    )
    nobody = F.array_repeat(none.cast("bigint"), SLOTS)
    lineup = ["home_in_play", "away_in_play"]
    answers = readings.join(folded.drop("spot"), ["game_id", "move"], "left").select(
        "game_id", "spot", *[F.coalesce(c, nobody).alias(c) for c in lineup]
    )
    in_play = folded.drop("move").unionByName(answers)
    own = F.when(is_sub(), F.col("sequence_id"))
    if keyed:
        found = plays.withColumn("spot", _spot(own)).join(in_play, ["game_id", "spot"])
        return found.select(*plays.columns, *lineup)
    # of rows that share a key one decided what happened; all of them get its lineup
    key = ["game_id", "sequence_id"]
    one = one_per_key(plays, key).withColumn("spot", _spot(own))
    found = one.join(in_play, ["game_id", "spot"]).select(*key, *lineup)
    return plays.join(found, key).select(*plays.columns, *lineup)


def lineup_sets(
    plays: DataFrame,
    game_logs: DataFrame,
    games: DataFrame,
    rule: PeriodRule = MENS_RULE,
    keyed: bool = False,
) -> DataFrame:
    """Every play with the sets of players on court at the end of its clock reading.

    Set-based, with no order inside a reading: a player is on court after a reading
    if an odd number of substitutions lie behind. Readings at which somebody comes or goes
    are numbered; stints are laid over these alone, and every other reading carries the
    number of the last such reading. All of this happens within a game's readings, which
    the clock bounds, so that after one shuffle by game no step needs another.
    Equals ``with_in_play`` as sets on non-substitutions while no side exceeds five.
    """
    finish = (F.col("sequence_id") < 0) & (F.col("clock_minutes") == 0)
    moves = (
        _booked_subs(plays, game_logs, rule, keyed)
        .filter(~finish & F.col("player_id").isNotNull())
        .groupBy("game_id", "player_id", *READING)
        .agg(F.count("sequence_id").alias("n_here"), F.max("team_id").alias("team_id"))
    )
    readings = plays.select("game_id", *READING).distinct()

    in_order = Window.partitionBy("game_id").orderBy(*reading_order())
    own = Window.partitionBy("game_id", "player_id").orderBy(*reading_order())
    here = Window.partitionBy("game_id", *READING).orderBy(F.col("player_id").asc_nulls_last())
    is_move = F.col("player_id").isNotNull()
    first_here = is_move & (F.row_number().over(here) == 1)
    rows = (
        moves.unionByName(readings, allowMissingColumns=True)
        .repartition("game_id")
        .join(games.select(F.col("id").alias("game_id"), "home_id"), "game_id")
        .withColumn("n_behind", F.sum("n_here").over(own))
        # an even number of substitutions at a reading changes nobody's place
        .filter(~is_move | (F.col("n_here") % 2 == 1))
        .withColumn("is_change", first_here.cast("int"))
        # rows of one reading are peers and get the same number
        .withColumn("change", F.sum("is_change").over(in_order))
        .withColumn("next_change", F.lead("change").over(own))
        .withColumn("last_change", F.max("change").over(Window.partitionBy("game_id")))
    )
    spot = F.struct(*[F.col(c).cast("bigint").alias(c) for c in READING])
    is_home = F.coalesce(F.col("team_id") == F.col("home_id"), F.lit(False))
    ends = F.coalesce(F.col("next_change") - 1, F.col("last_change"))

    def part(change: Column, player: Column, home: Column, at: Column) -> Column:
        return F.struct(
            change.alias("change"), player.alias("player_id"), home.alias("is_home"), at.alias("spot")
        )

    nothing = F.lit(None)
    parts = F.when(
        ~is_move,
        F.array(part(F.col("change"), nothing.cast("bigint"), nothing.cast("boolean"), spot)),
    ).when(
        F.col("n_behind") % 2 == 1,
        F.transform(
            F.sequence("change", ends),
            lambda k: part(k, F.col("player_id"), is_home, nothing.cast(_READING)),
        ),
    )

    def players_of(side: Column) -> Column:
        return F.array_sort(F.collect_set(F.when(side, F.col("player_id"))))

    at_reading = (
        rows.select("game_id", F.explode(parts).alias("part"))
        .select("game_id", "part.*")
        .groupBy("game_id", "change")
        .agg(
            players_of(F.col("is_home")).alias("home_set"),
            players_of(~F.col("is_home")).alias("away_set"),
            F.collect_list("spot").alias("spots"),
        )
        .select("game_id", F.explode("spots").alias("spot"), "home_set", "away_set")
    )
    return (
        plays.withColumn("spot", spot)
        .join(at_reading, ["game_id", "spot"])
        .select(*plays.columns, "home_set", "away_set")
    )
