"""Near-duplicate vectors by product quantisation.

Distinct vectors of length one lie in coarse lists; within its list a vector is the code of its
residual, one byte for each of SUBSPACES parts. A vector looks into its own list and into every list
whose border is near: as far off as REACH of the radius that the similarity allows. There it meets
codes, by tables of distances from its residual to all code words. A code's own error is kept with
it, so nothing within the radius is lost to the code; what may lie within is checked by the exact
cosine in double precision.

The index is fitted on SAMPLE distinct vectors by order of a hash; all vectors are indexed and all
look. Lists are met in blocks of BLOCK x BLOCK, so a hot list is many tasks. A block returns, for
each vector, how many it met, and links that join what it found connected: never all its pairs.

Equal vectors are one class and link with each other. A vector that is null, zero, or holds null or
non-finite components links with nothing, and vectors of different length do not link. Rows of equal
vec_id and vector count once; a null vec_id gets no links and a null component. Different vectors of one
vec_id each have their own links, and are of one component. An empty table gives no rows. Only vec_id
and embedding are read.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import Scratch, components, map_slices, table

SAMPLE = 16_384
SUBSPACES = 8
WORDS = 256
LISTS = 4096
BLOCK = 4096
REACH = 0.5


@dataclass
class Index:
    """Centres of lists and, for each part of a residual, its code words."""

    centres: np.ndarray
    words: np.ndarray  # part, word, component
    radius: float

    @property
    def width(self) -> int:
        return self.centres.shape[1]

    def padded(self, x: np.ndarray) -> np.ndarray:
        return np.pad(x, ((0, 0), (0, self.width - x.shape[1])))

    def encode(self, x: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """List, code and error of each vector."""
        lists = _nearest(x, self.centres)
        rest = x - self.centres[lists]
        part = self.width // SUBSPACES
        code = np.stack([_nearest(rest[:, s * part : (s + 1) * part], self.words[s]) for s in range(SUBSPACES)], 1)
        near = np.concatenate([self.words[s][code[:, s]] for s in range(SUBSPACES)], 1)
        return lists, code.astype(np.uint8), np.sqrt(((rest - near) ** 2).sum(1))

    def probes(self, x: np.ndarray, lists: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(vector, list) for every list whose border with the vector's own is within reach."""
        square = (self.centres**2).sum(1)[None] - 2 * x @ self.centres.T
        apart = np.sqrt(np.maximum(((self.centres[:, None] - self.centres[None]) ** 2).sum(2), 1e-18)) if len(self.centres) <= 64 else None
        out = []
        for a in range(0, len(x), 1024):
            own = lists[a : a + 1024]
            between = apart[own] if apart is not None else np.sqrt(np.maximum(
                (self.centres**2).sum(1)[own][:, None] + (self.centres**2).sum(1)[None] - 2 * self.centres[own] @ self.centres.T, 1e-18))
            far = (square[a : a + 1024] - square[np.arange(a, a + len(own)), own][:, None]) / (2 * between)
            far[np.arange(len(own)), own] = 0
            who, which = np.nonzero(far <= REACH * self.radius)
            out.append((who + a, which))
        return np.concatenate([w for w, _ in out]), np.concatenate([w for _, w in out])

    def candidates(self, x: np.ndarray, which: int, codes: np.ndarray, errors: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
        """Rows of x and rows of codes, all of one list, that may be within the radius."""
        part = self.width // SUBSPACES
        for a in range(0, len(x), 256):
            rest = x[a : a + 256] - self.centres[which]
            far = np.zeros((len(rest), len(codes)), np.float32)
            for s in range(SUBSPACES):
                sub = rest[:, s * part : (s + 1) * part]
                square = (sub**2).sum(1)[:, None] + (self.words[s] ** 2).sum(1)[None] - 2 * sub @ self.words[s].T
                far += square.astype(np.float32)[:, codes[:, s]]
            who, what = np.nonzero(far <= (self.radius + errors.astype(np.float32) + 1e-3)[None] ** 2)
            yield who + a, what


def _nearest(x: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return np.concatenate([
        ((centres**2).sum(1)[None] - 2 * x[a : a + 4096] @ centres.T).argmin(1) for a in range(0, len(x), 4096)
    ]) if len(x) else np.zeros(0, np.int64)


def _means(x: np.ndarray, k: int, rounds: int, rng: np.random.Generator) -> np.ndarray:
    centres = x[rng.choice(len(x), k, replace=len(x) < k)].copy()
    for _ in range(rounds):
        near = _nearest(x, centres)
        count = np.bincount(near, minlength=k)
        order = np.argsort(near, kind="stable")
        filled = np.flatnonzero(count)
        starts = np.concatenate([[0], np.cumsum(count)])[filled]
        centres[filled] = np.add.reduceat(x[order], starts, axis=0) / count[filled][:, None]
    return centres


def fitted(x: np.ndarray, total: int, similarity: float) -> Index:
    """An index for so many vectors, from a sample of them of length one."""
    rng = np.random.default_rng(7)
    x = np.pad(x, ((0, 0), (0, -x.shape[1] % SUBSPACES)))
    lists = int(min(LISTS, len(x), max(1, round(total**0.5 / 2))))
    centres = _means(x, lists, 8, rng)
    rest = x - centres[_nearest(x, centres)]
    part = x.shape[1] // SUBSPACES
    words = np.stack([_means(rest[:, s * part : (s + 1) * part], WORDS, 6, rng) for s in range(SUBSPACES)])
    return Index(centres, words, float(np.sqrt(2 - 2 * similarity)))


def _unit(vectors: list) -> np.ndarray:
    x = np.array([np.asarray(v, np.float64) for v in vectors])
    return x / np.linalg.norm(x, axis=1)[:, None]


def _classes(vectors: DataFrame) -> DataFrame:
    """The rows with h1 and h2, a digest of the vector; null where it can link with nothing."""
    fields = pa.schema([("vec_id", pa.int64()), ("embedding", pa.list_(pa.float64())), ("h1", pa.int64()), ("h2", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        h1, h2 = [], []
        for i, v in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            x = None if i is None or not v or any(c is None for c in v) else np.asarray(v, np.float64) + 0.0  # no negative zero
            if x is not None and np.isfinite(x).all() and x.any():
                d = hashlib.md5(x.tobytes()).digest()
                h1.append(int.from_bytes(d[:8], "little", signed=True))
                h2.append(int.from_bytes(d[8:], "little", signed=True))
            else:
                h1.append(None)
                h2.append(None)
        return pa.record_batch([batch.column(0), batch.column(1).cast(fields.field(1).type), pa.array(h1, pa.int64()), pa.array(h2, pa.int64())], schema=fields)

    return map_slices(vectors, run, "vec_id long, embedding array<double>, h1 long, h2 long", column="embedding")


def near_duplicates(rows: DataFrame, similarity: float = 0.95) -> DataFrame:
    """vec_id, n_links, component_id and kept of each row."""
    rows = rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("embedding"))
    scratch = Scratch(rows.sparkSession)
    # a class of equal vectors is named by 64 bits of its digest, and held by a row of its smallest id
    known = scratch.stored(_classes(rows).withColumn("id", F.when(F.col("h1").isNotNull(), F.xxhash64("h1", "h2"))), "vectors")
    valid = known.where("id is not null").select("vec_id", "id").distinct()
    classes = scratch.stored(valid.groupBy("id").agg(F.min("vec_id").alias("low"), F.count(F.lit(1)).alias("copies")), "classes")
    reps = classes.select("id", F.col("low").alias("vec_id"), "copies")
    units = scratch.stored(
        known.select("vec_id", "id", "embedding").join(reps, ["vec_id", "id"]).dropDuplicates(["id"])
        .select(F.col("id").alias("vec_id"), "embedding", "copies"), "units")
    total = units.count()
    spark = rows.sparkSession
    if not total:
        links, counts = spark.createDataFrame([], "a long, b long"), spark.createDataFrame([], "id long, met long")
    else:
        sample = units.orderBy(F.xxhash64("vec_id"), "vec_id").limit(SAMPLE).select("embedding").toArrow()  # at most SAMPLE rows
        vectors = sample.column(0).to_pylist()
        width = units.agg(F.max(F.size("embedding"))).first()[0]  # of all, not of the sample
        same = [v + [0.0] * (width - len(v)) for v in vectors]
        links, counts = _met(scratch, units, fitted(_unit(same), total, similarity), similarity)
    # vectors of one vec_id are of one component: each class goes with the smallest of them
    several = valid.groupBy("vec_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("vec_id", "a")
    same = valid.join(several, "vec_id").where("a <> id").select("a", F.col("id").alias("b"))
    groups = components(links.unionByName(same))
    # a component is named by the smallest vec_id in it
    named = classes.select("id", "low").join(groups, "id")
    named = named.join(named.groupBy("component_id").agg(F.min("low").alias("least")), "component_id").select("id", "least")
    found = classes.join(counts, "id", "left").join(named, "id", "left").select(
        "id", (F.coalesce("met", F.lit(0)) + F.col("copies") - 1).alias("n_links"), F.coalesce("least", "low").alias("least"))
    # an invalid row has its own vec_id's component, if a valid one has the same vec_id
    of_id = valid.join(found, "id").groupBy("vec_id").agg(F.min("least").alias("component_id"))
    out = known.select("vec_id", "id").join(found.select("id", "n_links"), "id", "left").join(of_id, "vec_id", "left")
    component = F.coalesce("component_id", "vec_id")
    out = out.select("vec_id", F.coalesce("n_links", F.lit(0)).alias("n_links"), component.alias("component_id"),
                      F.coalesce(component == F.col("vec_id"), F.lit(True)).alias("kept"))
    return scratch.result(out, "kept")


def _met(scratch: Scratch, units: DataFrame, index: Index, similarity: float) -> tuple[DataFrame, DataFrame]:
    spark = units.sparkSession
    shared = spark.sparkContext.broadcast(index)
    width = index.width
    member = pa.schema([("id", pa.int64()), ("list", pa.int32()), ("copies", pa.int64()), ("size", pa.int32()),
                        ("error", pa.float64()), ("code", pa.binary()), ("vector", pa.binary())])

    def read(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
        lists = batch.column("embedding").to_pylist()
        size = np.array([len(v) for v in lists])
        raw = np.array([v + [0.0] * (width - len(v)) for v in lists])
        return raw / np.linalg.norm(raw, axis=1)[:, None], size

    def encode(batch: pa.RecordBatch) -> pa.RecordBatch:
        x, size = read(batch)
        lists, codes, errors = shared.value.encode(x)
        return pa.record_batch([batch.column("vec_id"), pa.array(lists, pa.int32()), batch.column("copies"), pa.array(size, pa.int32()),
                                pa.array(errors), pa.array([c.tobytes() for c in codes]), pa.array([v.tobytes() for v in x])], schema=member)

    coded = scratch.stored(map_slices(units, encode, "id long, list int, copies long, size int, error double, code binary, vector binary", column="embedding"), "codes")

    def look(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = np.frombuffer(b"".join(batch.column("vector").to_pylist())).reshape(-1, width)
        who, which = shared.value.probes(x, batch.column("list").to_numpy())
        return pa.record_batch([batch.column("id").take(pa.array(who)), pa.array(which, pa.int32())], names=["id", "list"])

    seen = scratch.stored(map_slices(coded.select("id", "list", "vector"), look, "id long, list int", column="vector"), "probes")
    # blocks of each list, from both counts: at most LISTS rows
    size = coded.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("members")).join(
        seen.groupBy("list").agg(F.ceil(F.count(F.lit(1)) / BLOCK).alias("lookers")), "list")
    part = lambda n: F.pmod(F.xxhash64("id"), F.col(n)).cast("int")
    # each side has its own block and a copy for every block of the other
    members = coded.join(size, "list").select(
        "list", part("members").alias("m"), F.explode(F.sequence(F.lit(0), F.col("lookers").cast("int") - 1)).alias("l"),
        "id", "copies", "size", "error", "code", "vector")
    lookers = seen.join(size, "list").select(
        "list", "id", part("lookers").alias("l"), F.explode(F.sequence(F.lit(0), F.col("members").cast("int") - 1)).alias("m"),
    ).join(coded.select("id", "size", "vector"), "id")

    def meet(key, left: pa.Table, right: pa.Table) -> pa.Table:
        ids, counts, a, b = [], [], [], []
        if left.num_rows and right.num_rows:
            xi, yi = left["id"].to_numpy(), right["id"].to_numpy()
            x = np.frombuffer(b"".join(left["vector"].to_pylist())).reshape(-1, width)
            y = np.frombuffer(b"".join(right["vector"].to_pylist())).reshape(-1, width)
            xs, ys, copies = left["size"].to_numpy(), right["size"].to_numpy(), right["copies"].to_numpy()
            codes = np.frombuffer(b"".join(right["code"].to_pylist()), np.uint8).reshape(-1, SUBSPACES)
            met = np.zeros(len(x), np.int64)
            root = {}

            def top(v: int) -> int:
                while root.get(v, v) != v:
                    root[v] = root.get(root[v], root[v])
                    v = root[v]
                return v

            for who, what in shared.value.candidates(x, key[0].as_py(), codes, right["error"].to_numpy()):
                for s in range(0, len(who), 65_536):
                    w, t = who[s : s + 65_536], what[s : s + 65_536]
                    good = (np.einsum("ij,ij->i", x[w], y[t]) >= similarity) & (xi[w] != yi[t]) & (xs[w] == ys[t])
                    w, t = w[good], t[good]
                    met += np.bincount(w, copies[t], len(x)).astype(np.int64)
                    for u, v in zip(xi[w].tolist(), yi[t].tolist(), strict=True):
                        u, v = top(u), top(v)
                        if u != v:
                            root[max(u, v)] = min(u, v)
            ids, counts = xi[met > 0].tolist(), met[met > 0].tolist()
            b = [top(u) for u in root]
            a = list(root)
        none = [None] * len(ids)
        return pa.table({
            "id": pa.array(ids + a, pa.int64()), "met": pa.array(counts + [None] * len(a), pa.int64()),
            "to": pa.array(none + b, pa.int64()),
        })

    out = scratch.stored(
        lookers.groupBy("list", "l", "m").cogroup(members.groupBy("list", "l", "m")).applyInArrow(meet, "id long, met long, to long"), "met")
    return (out.where("to is not null").select(F.col("id").alias("a"), F.col("to").alias("b")),
            out.where("met is not null").groupBy("id").agg(F.sum("met").alias("met")))


def op9_embedding_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates(table(spark, sf_dir, "embeddings"))


OP9_SQL = """
WITH RECURSIVE u AS MATERIALIZED (
  SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE embedding IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda c: c IS NULL OR NOT isfinite(c))) = 0
    AND len(list_filter(embedding, lambda c: c <> 0)) > 0),
edges AS MATERIALIZED (
  SELECT a.vec_id AS x, b.vec_id AS y FROM u a JOIN u b ON len(a.e) = len(b.e) AND a.vec_id <> b.vec_id
  WHERE list_cosine_similarity(a.e, b.e) >= 0.95),
reach AS (
  SELECT x AS vec_id, x AS r FROM edges UNION SELECT e.y, reach.r FROM reach JOIN edges e ON e.x = reach.vec_id),
low AS (SELECT vec_id, min(r) AS r FROM reach GROUP BY vec_id),
n AS (SELECT x AS vec_id, count(*) AS n FROM edges GROUP BY x)
SELECT vec_id, CAST(coalesce(n, 0) AS BIGINT) AS n_links, least(vec_id, coalesce(r, vec_id)) AS component_id,
  least(vec_id, coalesce(r, vec_id)) = vec_id AS kept
FROM embeddings LEFT JOIN low USING (vec_id) LEFT JOIN n USING (vec_id)
"""
