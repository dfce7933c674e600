"""Shards as runs of a Hilbert curve through several metadata dimensions.

Only DataFrame functions. Each dimension becomes a number in its own order and is cut at quantiles
of all rows into 2^bits levels; a cell of levels has its place on the Hilbert curve. Rows sorted by
that place and cut into runs give shards that are narrow in every dimension at once, so that files
can be skipped on any of them.

Rows are never sorted as a whole. A cell's rows are split by a hash of their key into groups of
bounded size; groups are counted with map-side combining, their counts are added up along the
curve, and only within a group rows are numbered. Hot cells, and hot keys in a dimension, thus have
as many tasks as they have rows for. Law `rows`: shard sizes differ by one row at most.

Null values come first in their dimension; a null text has no bytes. Rows that tie go by doc_id and
then by the text's checksum; rows equal in all of these are alike, so their numbers may be swapped.
An empty table gives no rows. Only the columns named are read.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtflow.llm.common import table

BITS = 4
GROUP_ROWS = 20_000
DIMENSIONS = ("lang", "source", "size")


def hilbert_index(point: tuple[int, ...], bits: int) -> int:
    """Place of a point on the Hilbert curve through a cube of 2^bits levels a side (Skilling 2004)."""
    x, n = list(point), len(point)
    q = 1 << (bits - 1)
    while q > 1:
        low = q - 1
        for i in range(n):
            if x[i] & q:
                x[0] ^= low
            else:
                swap = (x[0] ^ x[i]) & low
                x[0] ^= swap
                x[i] ^= swap
        q >>= 1
    for i in range(1, n):
        x[i] ^= x[i - 1]
    flip, q = 0, 1 << (bits - 1)
    while q > 1:
        if x[-1] & q:
            flip ^= q - 1
        q >>= 1
    x = [v ^ flip for v in x]
    index = 0
    for b in range(bits - 1, -1, -1):
        for v in x:
            index = index << 1 | v >> b & 1
    return index


def curve(dimensions: int, bits: int) -> list[int]:
    """The place of every cell; the cell's number has the first dimension's level in its high bits."""
    cells = range(1 << dimensions * bits)
    return [hilbert_index(tuple(c >> (dimensions - 1 - d) * bits & (1 << bits) - 1 for d in range(dimensions)), bits) for c in cells]


def in_order(column: Column, kind: str) -> Column:
    """A number that keeps the column's order: a text by its first seven bytes, null as -1."""
    if kind == "string":
        head = F.rpad(F.hex(F.substring(F.encode(column, "UTF-8"), 1, 7)), 14, "0")
        return F.coalesce(F.conv(head, 16, 10).cast("long"), F.lit(-1))
    return F.coalesce(column.cast("double"), F.lit(-1.0))


def shards(docs: DataFrame, count: int, dimensions: tuple[str, ...] = DIMENSIONS, bits: int = BITS,
           group_rows: int = GROUP_ROWS) -> DataFrame:
    """doc_id, size, text_crc32, curve place, shard and slot of each row, by law `rows`."""
    text = F.coalesce(F.col("text"), F.lit(""))
    size = (F.octet_length(text) + 8).cast("long")
    kinds = dict(docs.dtypes)
    axes = [in_order(size, "long") if d == "size" else in_order(F.col(d), kinds[d]) for d in dimensions]
    share = [i / (1 << bits) for i in range(1, 1 << bits)]
    marks = docs.agg(
        F.count(F.lit(1)).alias("n"), *(F.percentile_approx(a, share, 10_000).alias(f"d{i}") for i, a in enumerate(axes))
    ).first()
    total = marks["n"]
    cell = F.lit(0)
    for i, axis in enumerate(axes):
        level = sum((F.when(axis > v, 1).otherwise(0) for v in sorted(set(marks[f"d{i}"] or []))), F.lit(0))
        cell = cell * (1 << bits) + level
    place = F.get(F.lit(curve(len(axes), bits)), cell)
    groups = max(1, -(-total // group_rows))
    rows = docs.select(
        "doc_id", size.alias("size"), F.crc32(F.encode(text, "UTF-8")).alias("text_crc32"), place.alias("place"),
        F.pmod(F.xxhash64("doc_id"), F.lit(groups)).alias("part"),
    )
    # counts of groups, added up within a place and then over places, of which there are 2^(dimensions x bits)
    counts = rows.groupBy("place", "part").agg(F.count(F.lit(1)).alias("n"))
    places = counts.groupBy("place").agg(F.sum("n").alias("n"))
    along = Window.orderBy("place").rowsBetween(Window.unboundedPreceding, -1)
    within = Window.partitionBy("place").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    ahead = places.select("place", F.coalesce(F.sum("n").over(along), F.lit(0)).alias("before"))
    offsets = (
        counts.select("place", "part", F.coalesce(F.sum("n").over(within), F.lit(0)).alias("inside"))
        .join(ahead, "place")
        .select("place", "part", (F.col("before") + F.col("inside")).alias("offset"))
    )
    inner = Window.partitionBy("place", "part").orderBy(F.col("doc_id").asc_nulls_first(), "text_crc32", "size")
    numbered = rows.withColumn("at", F.row_number().over(inner) - 1).join(offsets, ["place", "part"])
    rank = F.col("offset") + F.col("at")
    shard = F.floor(rank * count / F.lit(total)) if total else F.lit(0)
    # rank * count is exact in long; shard s starts at the first rank with floor(rank * count / total) = s
    shard = F.expr(f"((offset + at) * {count}) div {max(total, 1)}").cast("int")
    first = F.expr(f"(cast(shard as long) * {max(total, 1)} + {count - 1}) div {count}")
    return numbered.withColumn("shard", shard).select(
        "doc_id", "size", "text_crc32", "place", "shard", (F.col("offset") + F.col("at") - first).alias("slot")
    )


def op7_hilbert_shards(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shards(table(spark, sf_dir, "documents"), 24).select(
        "doc_id", "size", "text_crc32", F.lit("rows").alias("law"), "shard", "slot", F.lit(None).cast("int").alias("grown_shard")
    )
