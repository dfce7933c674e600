"""Similarity join of word n-gram sets: rare-first prefixes, then length, positional and suffix filters.

1. Words are counted over all rows in a table of fixed width (a hash of the word names its entry).
   A shingle is no commoner than its rarest word, so shingles are ordered by that word's count; any
   fixed order gives right prefixes. Words are far fewer than shingles and grow more slowly.
2. A set of n shingles that reaches similarity t with another shares one of its first
   n - ceil(t n) + 1 shingles with it. Equal sets become one class first, by a 128-bit digest, so
   copies meet nobody. Only prefix shingles that two classes share go on.
3. Every class is compared with the smallest of each of its prefix shingles. Groups of near
   copies, however large, become one component by as many links as they have members.
4. What is left are classes that share a prefix shingle but not yet a component. They are joined on
   it under the length, the positional and the suffix filter. The last is a bound on whole sets
   that stands for the recursive one on suffixes: parity bitmaps differ in no more bits than the
   sets in shingles. Step 3 has no positional filter, as its smallest class may lie anywhere.
   A pair is made at its smallest common shingle: each class carries the LEAD smallest of its own
   that are joined, and a pair that has one of these in common is made at no later shingle.
5. Sets of more than BITMAP shingles fill that bitmap, and their pairs would all pass. Such a set has a
   second one of as many bits as shingles, at least; of two sizes, the larger is folded to the
   smaller. It is compared once a pair, by the same bound, before any whole set is read.
6. Pairs left are verified once with the whole sets.

Pairs within a component are left out, and no others: components are those of all links. Texts
move twice at most, and only keys, sizes and bitmaps are joined on shingles.

Words are runs of other characters than white space, with A-Z in lower case. A text with fewer words
than n has its whole sequence as its one shingle; a null text, or one without words, has an empty set
and no links. Rows with equal doc_id and text count once and each get the result; a null doc_id has
no links and a null component. Several texts of one doc_id are one document, which links with what any
of them links with. An empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from courtflow.llm.common import Scratch, components, map_slices, table, with_keys
from courtflow.llm.words import NOT_SPACE, find_words, mix, rolling, slices, starts_of_runs

WIDTH_BITS = 20
CHUNK_BITS = 14
BITMAP = 512
LEAD = 4
#: Bytes of text at once; its shingles and their orders take some 40 times as much.
SIZE = 1 << 18
_SECOND = np.uint64(0xD6E8FEB86659FD93)


def shingle_sets(texts: pa.Array, n: int, common: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct shingles of each text as hashes, in ascending order, len + 1 offsets, and the count
    of the rarest word of each."""
    words = find_words(texts, NOT_SPACE, lower=True)
    at, text = starts_of_runs(words.first, n)
    hashes = rolling(words.hashes, n)[at]
    count = common[_entry(words.hashes)] if common is not None else np.zeros(len(words.hashes), np.uint32)
    rare = np.minimum.reduce([count[at + k] for k in range(n)]) if len(at) else count[:0]
    counts = np.diff(words.first)
    few = np.flatnonzero((counts > 0) & (counts < n))
    if len(few):
        lone = [rolling(words.hashes[words.first[k] : words.first[k + 1]], counts[k])[0] for k in few]
        hashes = np.concatenate([hashes, mix(np.array(lone, np.uint64) + counts[few].astype(np.uint64))])
        text = np.concatenate([text, few])
        rare = np.concatenate([rare, [count[words.first[k] : words.first[k + 1]].min() for k in few]])
    order = np.lexsort((hashes, text))
    hashes, text, rare = hashes[order], text[order], rare[order]
    if len(hashes):
        new = np.concatenate([[True], (hashes[1:] != hashes[:-1]) | (text[1:] != text[:-1])])
        hashes, text, rare = hashes[new], text[new], rare[new]
    return hashes, np.searchsorted(text, np.arange(len(texts) + 1)), rare


def _entry(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - WIDTH_BITS)).astype(np.int64)


def frequencies(docs: DataFrame) -> np.ndarray:
    """Counts of all words, summed by entry; the table's size does not grow with the data."""
    size, chunks = 1 << CHUNK_BITS, 1 << (WIDTH_BITS - CHUNK_BITS)
    fields = pa.schema([("chunk", pa.int32()), ("counts", pa.binary())])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(1 << WIDTH_BITS, np.int64)
        for batch in batches:
            for piece in slices(batch):
                words = find_words(piece.column("text"), NOT_SPACE, lower=True)
                total += np.bincount(_entry(words.hashes), minlength=len(total))
        for c in range(chunks):
            part = total[c * size : (c + 1) * size]
            if part.any():
                yield pa.record_batch([pa.array([c], pa.int32()), pa.array([np.minimum(part, 2**32 - 1).astype(np.uint32).tobytes()])], schema=fields)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for c, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[c] = sums.get(c, 0) + np.frombuffer(counts, np.uint32).astype(np.int64)
        for c, total in sums.items():
            yield pa.record_batch([pa.array([c], pa.int32()), pa.array([np.minimum(total, 2**32 - 1).astype(np.uint32).tobytes()])], schema=fields)

    parts = (
        docs.select("text").mapInArrow(count, "chunk int, counts binary").repartition(8, "chunk")
        .mapInArrow(add, "chunk int, counts binary")
    )
    out = np.zeros(1 << WIDTH_BITS, np.uint32)
    for c, counts in parts.collect():  # 2^WIDTH_BITS numbers at most
        out[c * size : (c + 1) * size] = np.frombuffer(bytes(counts), np.uint32)
    return out


def _parities(hashes: np.ndarray, first: np.ndarray) -> list[bytes | None]:
    """For each set of more than BITMAP shingles a bitmap of at least as many bits, a power of two times BITMAP."""
    size = np.diff(first)
    wide = np.where(size > BITMAP, BITMAP << np.ceil(np.log2(np.maximum(size, 1) / BITMAP)).clip(0).astype(np.int64), 0)
    ends = np.cumsum(wide)
    held = np.repeat(wide > 0, size)
    width = np.repeat(wide, size)[held]
    at = np.repeat(ends - wide, size)[held] + ((hashes[held] >> np.uint64(7)) % width.astype(np.uint64)).astype(np.int64)
    bits = np.packbits((np.bincount(at, minlength=wide.sum()) & 1).astype(np.uint8))
    return [bits[(e - w) // 8 : e // 8].tobytes() if w else None for e, w in zip(ends.tolist(), wide.tolist(), strict=True)]


def _summaries(docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """Size, digest, bitmaps and rare-first prefix of each row's set."""
    spark = docs.sparkSession
    common = spark.sparkContext.broadcast(frequencies(docs))
    fields = pa.schema([
        ("doc_id", pa.int64()), ("th", pa.int64()), ("n", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
        ("bits", pa.list_(pa.int64())), ("wide", pa.binary()), ("prefix", pa.list_(pa.int64())),
    ])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first, rare = shingle_sets(batch.column("text"), n, common.value)
        size = np.diff(first)
        text = np.repeat(np.arange(len(size)), size)
        sums = np.zeros((2, len(hashes) + 1), np.uint64)
        np.cumsum(mix(hashes), out=sums[0, 1:])
        np.cumsum(mix(hashes ^ _SECOND), out=sums[1, 1:])
        digest = (sums[:, first[1:]] - sums[:, first[:-1]]).view(np.int64)
        spots = np.bincount(text * BITMAP + ((hashes >> np.uint64(7)) % np.uint64(BITMAP)).astype(np.int64),
                            minlength=len(size) * BITMAP)
        bits = np.packbits((spots & 1).astype(np.uint8)).view(np.int64)
        order = np.lexsort((hashes, rare, text))
        length = np.where(size > 0, size - (size * num + den - 1) // den + 1, 0)
        place = np.arange(len(hashes)) - np.repeat(first[:-1], size)
        prefix = hashes[order][place < np.repeat(length, size)].view(np.int64)
        lists = lambda values, ends: pa.ListArray.from_arrays(pa.array(np.concatenate([[0], ends]), pa.int32()), pa.array(values, pa.int64()))
        return pa.record_batch([
            batch.column("doc_id"), batch.column("th"), pa.array(size, pa.int64()), pa.array(digest[0]),
            pa.array(digest[1]), lists(bits, np.arange(1, len(size) + 1) * (BITMAP // 64)),
            pa.array(_parities(hashes, first), pa.binary()), lists(prefix, np.cumsum(length)),
        ], schema=fields)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    return map_slices(rows, run, "doc_id long, th long, n long, h1 long, h2 long, bits array<long>, wide binary, prefix array<long>", most=SIZE)


def _differing(a: str, b: str) -> Column:
    return sum((F.bit_count(F.col(a)[i].bitwiseXOR(F.col(b)[i])) for i in range(BITMAP // 64)), F.lit(0))


def _may_link(a: str, b: str, num: int, den: int) -> Column:
    """Length and suffix filter for two sides with n and bits."""
    na, nb = F.col(f"{a}.n"), F.col(f"{b}.n")
    return (
        (na * den >= nb * num) & (nb * den >= na * num)
        & (_differing(f"{a}.bits", f"{b}.bits") * (num + den) <= (na + nb) * (den - num))
    )


def shared_pairs(posts: DataFrame, num: int, den: int) -> DataFrame:
    """Classes (a, b) of two components c that share a shingle t and pass the filters: once, unless they
    share shingles but none of their LEAD smallest."""
    x, y = posts.alias("x"), posts.alias("y")
    room = F.least(F.col("x.place"), F.col("y.place")) + 1 + F.least(
        F.col("x.n") - F.col("x.place"), F.col("y.n") - F.col("y.place")) - 1
    made = F.array_min(F.array_intersect("x.lead", "y.lead")) < F.col("x.t")
    return x.join(
        y, (F.col("x.t") == F.col("y.t")) & (F.col("x.id") < F.col("y.id")) & (F.col("x.c") != F.col("y.c"))
        & (room * (num + den) >= (F.col("x.n") + F.col("y.n")) * num) & _may_link("x", "y", num, den)
        & ~F.coalesce(made, F.lit(False))).select(F.col("x.id").alias("a"), F.col("y.id").alias("b"))


def near_pairs(pairs: DataFrame, sketches: DataFrame, num: int, den: int) -> DataFrame:
    """Pairs of classes (a, b) without those whose wide bitmaps differ in too many bits.

    sketches: id, n and wide of the classes that have one; a pair with another class stays.
    """
    def keep(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns = (batch.column(c).to_pylist() for c in ("x", "y", "size"))
        return batch.select(["a", "b"]).filter(pa.array([
            x is None or y is None or _apart(x, y) * (num + den) <= size * (den - num) for x, y, size in zip(*columns, strict=True)], pa.bool_()))

    left = sketches.select(F.col("id").alias("a"), F.col("wide").alias("x"), F.col("n").alias("nx"))
    right = sketches.select(F.col("id").alias("b"), F.col("wide").alias("y"), F.col("n").alias("ny"))
    both = pairs.join(left, "a", "left").join(right, "b", "left").select("a", "b", "x", "y", (F.col("nx") + F.col("ny")).alias("size"))
    return map_slices(both, keep, "a long, b long", column="x")


def _apart(x: bytes, y: bytes) -> int:
    """Bits in which two bitmaps differ, the larger folded to the size of the smaller."""
    size = min(len(x), len(y))
    x, y = (np.bitwise_xor.reduce(np.frombuffer(v, np.uint8).reshape(-1, size), axis=0) for v in (x, y))
    return int(np.bitwise_count(x ^ y).sum())


def _links(scratch: Scratch, pairs: DataFrame, sketches: DataFrame, places: DataFrame, docs: DataFrame, n: int, num: int, den: int) -> DataFrame:
    """The pairs of classes (a, b) whose whole sets reach the similarity; each is verified once.

    places names a text (doc_id, th) of every class (id).
    """
    met = scratch.stored(pairs, "met")
    pairs = scratch.stored(near_pairs(met, sketches, num, den), "pairs")
    scratch.drop(met)
    wanted = pairs.select(F.col("a").alias("id")).union(pairs.select("b")).distinct()
    wanted = scratch.stored(places.join(wanted, "id", "left_semi"), "wanted")
    fields = pa.schema([("id", pa.int64()), ("shingles", pa.binary())])

    def sets(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, first, _ = shingle_sets(batch.column("text"), n)
        return pa.record_batch([batch.column("id"), pa.array(
            [hashes[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)], pa.binary())], schema=fields)

    texts = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64("text").alias("th"), "text").where("text is not null")
    texts = with_keys(texts, wanted, ["doc_id", "th"], "inner").select("id", "text")
    whole = scratch.stored(map_slices(texts, sets, "id long, shingles binary", most=SIZE), "shingles")
    if whole.count() > wanted.count():  # rows that are equal
        several = whole
        whole = scratch.stored(several.groupBy("id").agg(F.min("shingles").alias("shingles")), "shingles")
        scratch.drop(several)

    def verify(batch: pa.RecordBatch) -> pa.RecordBatch:
        keep = []
        for x, y in zip(batch.column("x").to_pylist(), batch.column("y").to_pylist(), strict=True):
            x, y = np.frombuffer(x, np.uint64), np.frombuffer(y, np.uint64)
            both = len(np.intersect1d(x, y, assume_unique=True))
            keep.append(both * (num + den) >= num * (len(x) + len(y)))
        return batch.select(["a", "b"]).filter(pa.array(keep, pa.bool_()))

    left = whole.select(F.col("id").alias("a"), F.col("shingles").alias("x"))
    right = whole.select(F.col("id").alias("b"), F.col("shingles").alias("y"))
    links = scratch.stored(map_slices(
        pairs.join(left, "a").join(right, "b").select("a", "b", "x", "y"), verify, "a long, b long", column="x"), "links")
    scratch.drop(pairs, wanted, whole)
    return links


def jaccard_groups(docs: DataFrame, n: int = 5, num: int = 4, den: int = 5) -> DataFrame:
    """doc_id, th (a hash of the text), n_shingles and component_id of each row, for similarity num / den."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.stored(_summaries(docs, n, num, den), "sets")
    known = rows.where("doc_id is not null and n > 0").withColumn("id", F.xxhash64("n", "h1", "h2"))
    # a class of equal sets, by a digest; it is named by 64 bits of it, and held by its smallest row
    reps = scratch.stored(
        known.groupBy("id").agg(F.min(F.struct("doc_id", "th")).alias("row"), F.min("n").alias("n"))
        .select("id", "row.doc_id", "row.th", "n"), "classes")
    facts = with_keys(known, reps.select("id", "doc_id", "th"), ["id", "doc_id", "th"], "left_semi")
    facts = scratch.stored(facts.select("id", "n", "bits", "wide", "prefix"), "facts")
    if facts.count() > reps.count():  # rows that are equal
        several = facts
        facts = scratch.stored(several.dropDuplicates(["id"]), "facts")
        scratch.drop(several)
    tokens = facts.select("id", F.posexplode("prefix").alias("place", "t"))
    shared = tokens.groupBy("t").agg(F.min("id").alias("head"), F.max("id").alias("tail")).where("head < tail")
    posts = scratch.stored(tokens.join(shared.select("t", "head"), "t"), "posts")
    sketches = facts.where("wide is not null").select("id", "n", "wide")
    facts = facts.select("id", "n", "bits")

    # every class with the smallest of each of its shingles
    heads = posts.where("id <> head").select(F.col("head").alias("a"), F.col("id").alias("b")).distinct()
    one = facts.select(F.col("id").alias("a"), F.struct("n", "bits").alias("x"))
    two = facts.select(F.col("id").alias("b"), F.struct("n", "bits").alias("y"))
    heads = heads.join(one, "a").join(two, "b").where(_may_link("x", "y", num, den)).select("a", "b")
    places = reps.select("id", "doc_id", "th")
    first = _links(scratch, heads, sketches, places, docs, n, num, den)
    found = components(first)

    # classes that share a shingle but no component
    labelled = posts.join(found, "id", "left").withColumn("c", F.coalesce("component_id", "id")).select("t", "id", "place", "c")
    mixed = labelled.groupBy("t").agg(F.min("c").alias("c1"), F.max("c").alias("c2")).where("c1 < c2").select("t")
    own = Window.partitionBy("id")
    left_over = labelled.join(mixed, "t", "left_semi").withColumn("k", F.row_number().over(own.orderBy("t")))
    left_over = left_over.withColumn("lead", F.collect_list(F.when(F.col("k") <= LEAD, F.col("t"))).over(own)).drop("k")
    left_over = scratch.stored(left_over.join(facts, "id"), "mixed")
    # pairs linked above are of one component
    rest = shared_pairs(left_over, num, den).distinct()
    second = _links(scratch, rest, sketches, places, docs, n, num, den)
    scratch.drop(left_over, posts)

    # texts of one doc_id are one document: each of its classes goes with the smallest of them
    members = known.select("doc_id", "th", "id").distinct()
    several = members.groupBy("doc_id").agg(F.min("id").alias("a"), F.max("id").alias("b")).where("a < b").select("doc_id", "a")
    same = with_keys(members, several.select("doc_id"), ["doc_id"], "left_semi").join(several, "doc_id").where("a <> id")
    groups = components(first.unionByName(second).unionByName(same.select("a", F.col("id").alias("b"))))
    # a component is named by the smallest doc_id in it
    named = reps.select("id", F.col("doc_id").alias("low")).join(groups, "id")
    named = named.select("id", "component_id", "low").join(
        named.groupBy("component_id").agg(F.min("low").alias("least")), "component_id").select("id", "least")
    lowest = reps.select("id", F.col("doc_id").alias("low")).join(named, "id", "left").select(
        "id", F.coalesce("least", "low").alias("component_id"))
    out = (
        rows.withColumn("id", F.when(F.col("doc_id").isNotNull() & (F.col("n") > 0), F.xxhash64("n", "h1", "h2")))
        .select("doc_id", "th", F.col("n").alias("n_shingles"), "id")
        .join(lowest, "id", "left")
        .select("doc_id", "th", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id"))
    )
    return scratch.result(out, "groups")


def op8_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    groups = jaccard_groups(table(spark, sf_dir, "documents"), 3, 9, 10)
    return groups.select("doc_id", "n_shingles", "component_id")


#: Case is folded for A-Z only; words are split at ASCII white space.
OP8_SQL = r"""
WITH RECURSIVE w AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS MATERIALIZED (
  SELECT doc_id, list_distinct(CASE WHEN len(w) = 0 THEN [] WHEN len(w) < 3 THEN [array_to_string(w, ' ')]
    ELSE list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]) END) AS s FROM w),
t AS MATERIALIZED (SELECT doc_id, len(s) AS n, unnest(s) AS g FROM s),
pairs AS MATERIALIZED (
  SELECT a.doc_id AS x, b.doc_id AS y FROM t a JOIN t b ON a.g = b.g AND a.doc_id < b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 190 * count(*) >= 90 * (a.n + b.n)),
edges AS MATERIALIZED (SELECT x, y FROM pairs UNION SELECT y, x FROM pairs),
reach AS (
  SELECT x AS doc_id, x AS r FROM edges UNION SELECT e.y, reach.r FROM reach JOIN edges e ON e.x = reach.doc_id)
SELECT s.doc_id, CAST(len(s.s) AS BIGINT) AS n_shingles, coalesce(min(r), s.doc_id) AS component_id
FROM s LEFT JOIN reach USING (doc_id) GROUP BY s.doc_id, s.s
"""
