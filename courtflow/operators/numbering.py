"""Places of rows in a total order, without a task that sees a whole group.

Rows are dealt into ranges of the order, as for a global sort, and sorted and numbered there. What
lies before a range is a sum of counts: one per range, or one per range and group. A group or an
equal sort key that holds a third of all rows lies in many ranges, as long as later sort columns differ.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from courtflow.session import written

#: Rows of one partition that monotonically_increasing_id() can number.
_ROWS = (1 << 33) - 1


def _in_ranges(df: DataFrame, order: Sequence[Column]) -> DataFrame:
    """The rows sorted, written with ``_part``, their range, and ``_at``, their place in it.

    Written once to the shared folder: ranges come from a sample, so a second run of the plan could
    deal rows out differently from their counts.
    """
    ranges = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = df.repartitionByRange(ranges, *order).sortWithinPartitions(*order).select(
        "*",
        F.spark_partition_id().alias("_part"),
        F.monotonically_increasing_id().bitwiseAND(F.lit(_ROWS)).alias("_at"),
    )
    return written(rows, "ranges")


def positions(df: DataFrame, order: Sequence[Column], name: str) -> DataFrame:
    """The rows with their place in the order of all rows, from 0."""
    rows = _in_ranges(df, order)
    # one row per range
    counts = {r["_part"]: r["count"] for r in rows.groupBy("_part").count().collect()}
    before, passed = [], 0
    for part in range(max(counts, default=-1) + 1):
        before.append(passed)
        passed += counts.get(part, 0)
    offset = F.element_at(F.lit(before or [0]).cast("array<bigint>"), F.col("_part") + 1)
    return rows.select(*df.columns, (offset + F.col("_at")).alias(name))


def places(
    df: DataFrame, by: Sequence[str], order: Sequence[Column], name: str
) -> DataFrame:
    """The rows with their place in the order of their group, from 0.

    A group has one count per range it reaches into, so neither the window over the counts
    nor the join, on group and range, can be hot.
    """
    rows = _in_ranges(df, [F.col(c).asc_nulls_first() for c in by] + list(order))
    group = F.struct(*by).alias("_group")
    counts = rows.groupBy(group, "_part").agg(
        F.count(F.lit(1)).alias("_n"), F.min("_at").alias("_first")
    )
    earlier = (
        Window.partitionBy("_group")
        .orderBy("_part")
        .rowsBetween(Window.unboundedPreceding, -1)
    )
    shift = F.coalesce(F.sum("_n").over(earlier), F.lit(0)) - F.col("_first")
    return (
        rows.withColumn("_group", group)
        .join(counts.select("_group", "_part", shift.alias("_shift")), ["_group", "_part"])
        .select(*df.columns, (F.col("_at") + F.col("_shift")).alias(name))
    )
