"""Reading, storing and grouping shared by the operators of this subpackage."""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.words import SLICE_BYTES, slices
from courtflow.session import scratch_path

#: Texts handed to Python at once; bounds the Arrow buffers of the JVM where texts are long.
BATCH_ROWS = 256
BATCH_BYTES = 16 << 20


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Keys that are broadcast at most, 8 bytes each; more are joined by a shuffle.
BROADCAST_KEYS = 500_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """The rows, written once to the shared folder; survives lost executors."""
    return Scratch(df.sparkSession).stored(df, name)


class Scratch:
    """Tables that an operator writes to the shared folder and removes when its result is written."""

    def __init__(self, spark: SparkSession):
        self.spark = spark
        self.paths: dict[int, tuple[DataFrame, str]] = {}

    def stored(self, df: DataFrame, name: str) -> DataFrame:
        path = scratch_path(self.spark, name)
        df.write.parquet(path)
        out = self.spark.read.schema(df.schema).parquet(path)
        self.paths[id(out)] = out, path
        return out

    def drop(self, *tables: DataFrame) -> None:
        for table_ in tables:
            _, path = self.paths.pop(id(table_))
            where = self.spark._jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)

    def result(self, df: DataFrame, name: str) -> DataFrame:
        """df, written; the other tables, which it may read, are removed."""
        out = self.stored(df, name)
        self.drop(*(t for t, _ in self.paths.values() if t is not out))
        return out


def with_keys(df: DataFrame, keys: DataFrame, on: list[str], how: str) -> DataFrame:
    """Semi or anti join with distinct keys: broadcast up to BROADCAST_KEYS of them, else by a shuffle."""
    few = keys.limit(BROADCAST_KEYS + 1).count() <= BROADCAST_KEYS
    return df.join(F.broadcast(keys) if few else keys, on, how)


def map_slices(
    df: DataFrame,
    function: Callable[[pa.RecordBatch], Iterator[pa.RecordBatch] | pa.RecordBatch | None],
    schema: str,
    column: str = "text",
    most: int = SLICE_BYTES,
) -> DataFrame:
    """function over slices of bounded size of the rows; it returns no, one or several batches."""
    spark = df.sparkSession
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", BATCH_ROWS)
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", BATCH_BYTES)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in gathered(batches, column, most):
            for piece in slices(batch, column, most):
                out = function(piece)
                yield from () if out is None else (out,) if isinstance(out, pa.RecordBatch) else out
        # a worker process outlives its task
        pa.default_memory_pool().release_unused()

    return df.mapInArrow(run, schema)


def gathered(batches: Iterator[pa.RecordBatch], column: str, most: int) -> Iterator[pa.RecordBatch]:
    """Small batches joined until they hold some bytes of the column."""
    held: list[pa.RecordBatch] = []
    size = 0
    for batch in batches:
        held.append(batch)
        size += batch.column(column).nbytes
        if size >= most:
            yield joined(held)
            held, size = [], 0
    if held:
        yield joined(held)


def joined(batches: list[pa.RecordBatch]) -> pa.RecordBatch:
    if len(batches) == 1:
        return batches[0]
    whole = pa.Table.from_batches(batches).combine_chunks()
    return whole.to_batches()[0] if whole.num_rows else batches[0]


def components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """Smallest id reachable from each id that has an edge: (id, component_id).

    Alternates two rounds that keep the components: every id links its larger neighbours to its
    smallest, then its smaller neighbours likewise. A component ends as a star around its smallest
    id after about log(diameter) rounds. Only edges are shuffled; each round is written to the
    shared folder. A hot centre's edges are counted and compared by aggregates that combine on the
    map side, and joined, so that Spark can split them.
    """
    scratch = Scratch(edges.sparkSession)
    links = scratch.stored(
        edges.select(F.col(a).alias("u"), F.col(b).alias("v"))
        .where("u is not null and v is not null and u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct(),
        "links",
    )
    while True:
        # large star: for each id, larger neighbours link to the smallest of it and its neighbours
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        large = scratch.stored(
            both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v").distinct(),
            "large",
        )
        # small star: an id and its smaller neighbours link to the smallest neighbour
        low = large.groupBy("u").agg(F.min("v").alias("m"))
        small = scratch.stored(
            large.join(low, "u")
            .select(F.explode(F.array(F.struct("u", F.col("m").alias("v")),
                                      F.struct(F.col("v").alias("u"), F.col("m").alias("v")))).alias("x"))
            .select("x.*").where("u <> v").distinct(),
            "small",
        )
        # a star forest: no id is both a centre and a leaf, and each leaf has one centre
        many = small.groupBy("u").count().where("count > 1").limit(1).count()
        nested = many or small.join(small.select(F.col("v").alias("u")).distinct(), "u", "left_semi").limit(1).count()
        scratch.drop(links, large)
        links = small
        if not nested:
            break
    return links.select(F.col("u").alias("id"), F.col("v").alias("component_id")).unionByName(
        links.select(F.col("v").alias("id"), F.col("v").alias("component_id")).distinct()
    )
