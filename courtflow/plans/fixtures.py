"""The engine's inputs, projected from the given test tables."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

HOME, AWAY = 100, 101


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def plays(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every 200 events make a game of four periods; event_id is unique."""
    k = F.col("k")
    purchase = F.col("event_type") == "purchase"
    return (
        table(spark, sf_dir, "events")
        .selectExpr(
            "*",
            "event_id div 200 AS game_id",
            "event_id % 200 AS k",
            "CASE WHEN event_id % 200 < 100 THEN 1200 - (event_id % 50) * 24 "
            "ELSE 300 - (event_id % 50) * 6 END AS left_s",
        )
        .select(
            "game_id",
            F.col("event_id").alias("sequence_id"),
            F.expr(
                "CAST(CASE event_type WHEN 'signup' THEN 584 WHEN 'click' THEN 1 "
                "WHEN 'view' THEN 2 WHEN 'error' THEN 3 ELSE 4 END AS BIGINT)"
            ).alias("play_type_id"),
            F.when(purchase, 1 + k % 3).otherwise(F.lit(0)).alias("points_attempted"),
            (purchase & (F.col("value") < 20)).alias("is_score"),
            (F.lit(HOME) + F.col("user_id") % 2).alias("team_id"),
            (1 + F.col("user_id") % 16).alias("player_id"),
            F.expr("1 + k div 50").alias("period"),
            F.expr("left_s div 60").alias("clock_minutes"),
            (F.col("left_s") % 60).alias("clock_seconds"),
            F.expr("k div 4").alias("home_score"),
            F.expr("k div 5").alias("away_score"),
            F.col("ts").alias("timestamp"),
        )
    )


def game_logs(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        plays(spark, sf_dir)
        .select("game_id", "player_id")
        .distinct()
        .select(
            "game_id",
            "player_id",
            F.lit(True).alias("played"),
            (F.col("player_id") <= 10).alias("started"),
            F.lit(False).alias("ejected"),
        )
    )


def games(spark: SparkSession, sf_dir: str) -> DataFrame:
    return (
        plays(spark, sf_dir)
        .select(F.col("game_id").alias("id"))
        .distinct()
        .select(
            "id",
            F.lit(HOME).cast("bigint").alias("home_id"),
            F.lit(AWAY).cast("bigint").alias("away_id"),
        )
    )
