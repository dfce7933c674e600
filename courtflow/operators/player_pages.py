"""Player documents as updates of players."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from courtflow.functions.values import part, safe_int
from courtflow.operators.keyed import carried
from courtflow.operators.records import raw_key
from courtflow.schemas import RecordType


def player_updates(parsed: DataFrame) -> DataFrame:
    """Height, weight and birth place, from texts like ``6' 4", 210 lbs``."""
    age = carried(parsed)
    athlete = parsed.select(
        *age,
        raw_key(F.col("document_key"), RecordType.PLAYER).alias("id"),
        F.col("parsed.page.content.player.plyrHdr.ath").alias("ath"),
    ).filter("ath IS NOT NULL")
    body, birth = F.col("ath.htwt"), F.col("ath.brthpl")
    height = F.regexp_replace(part(body, ", ", 0), r"['\"]", "")
    weight = F.replace(part(body, ", ", 1), F.lit(" lbs"), F.lit(""))
    return athlete.select(
        *age,
        "id",
        part(birth, ", ", 0).alias("birth_city"),
        part(birth, ", ", 1).alias("birth_state"),
        safe_int(part(height, " ", 0)).alias("height_ft"),
        safe_int(part(height, " ", 1)).alias("height_in"),
        safe_int(weight).alias("weight"),
        F.lit(True).alias("complete_record"),
    )
