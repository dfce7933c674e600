"""Periodic runs of words: stretches that repeat their first words at least three times.

Of each document the words' suffixes are sorted (by doubled ranks) and the longest common prefixes
of neighbours taken; a stack walks the tree of LCP intervals from the bottom. Every node holds the
sorted places of its suffixes, and every place belongs to the class of the word on its left. Where
two children of an interval of l words meet, places of different classes are maximal pairs: their
l words are equal, the words on both sides differ. A maximal pair at distance d with
d + l >= max(shortest, exponent * d) is a run of d + l words with period d, and every run
is such a pair, so nothing is extended. As l >= 2d, places of one node that lie so close follow
each other at equal distances, and all but the first are of one class: only neighbouring places
can be a pair with the smallest period, so a child's places look at their neighbours in the larger
child's and move there (each place moves log n times at most). Of pairs that tell the same stretch
the smallest distance is its period.

Only documents in which `shortest - shortest / exponent` words in a row occur twice are sorted at all:
a run of that many words with the period d has d + l words, l of which occur twice.

Words are runs of other characters than white space, compared by 64-bit hashes. A null or empty text has no
words and no runs and collapses to an empty text. Rows are treated one by one, so repeated rows and a
null doc_id give a row each; an empty table gives none. Only doc_id and text are read. A long text
costs n log n; its memory is some hundred bytes a word.
"""

from __future__ import annotations

import zlib
from bisect import bisect_left, insort
from collections.abc import Callable

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import map_slices, table
from courtflow.llm.words import NOT_SPACE, Words, find_words, mix, rolling, starts_of_runs

SHORTEST = 24
EXPONENT = 3
_RUN = "struct<start: bigint, length: bigint, period: bigint>"
_RUN_TYPE = pa.list_(pa.struct([(c, pa.int64()) for c in ("start", "length", "period")]))


def _suffixes(words: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Places of the suffixes in order, and the words that each shares with the next."""
    n = len(words)
    ranks = [np.unique(words, return_inverse=True)[1].astype(np.int64)]
    step = 1
    order = np.argsort(ranks[0], kind="stable")
    while ranks[-1][order[-1]] < n - 1:
        both = ranks[-1] * (n + 1)
        both[: n - step] += ranks[-1][step:] + 1
        order = np.argsort(both, kind="stable")
        ordered = both[order]
        rank = np.empty(n, np.int64)
        rank[order] = np.concatenate([[0], np.cumsum(ordered[1:] != ordered[:-1])])
        ranks.append(rank)
        step *= 2
    a, b = order[:-1].copy(), order[1:].copy()
    shared = np.zeros(n - 1, np.int64)
    for level in range(len(ranks) - 1, -1, -1):
        inside = np.flatnonzero((a < n) & (b < n))
        same = inside[ranks[level][a[inside]] == ranks[level][b[inside]]]
        for x in (a, b, shared):
            x[same] += 1 << level
    return order, shared


def find_runs(words: np.ndarray, shortest: int = SHORTEST, exponent: int = EXPONENT) -> list[tuple[int, int, int]]:
    """(start, length, period) of every run in a sequence of words (as numbers), in this order."""
    if len(words) < shortest:
        return []
    least = shortest - shortest // exponent
    order, shared = _suffixes(words)
    deep = np.flatnonzero(shared >= least)
    if not len(deep):
        return []
    left = [None, *words[:-1].tolist()]  # the class of each place
    found: dict[tuple[int, int], int] = {}

    def meet(one: list[int], other: list[int], length: int) -> list[int]:
        """The places of two children of an interval together; their pairs are noted."""
        small, large = (one, other) if len(one) < len(other) else (other, one)
        for place in small:
            at = bisect_left(large, place)
            for near in large[max(at - 1, 0) : at + 1]:
                first, apart = min(near, place), abs(near - place)
                whole = length + apart
                if whole >= exponent * apart and whole >= shortest and left[near] != left[place]:
                    found[first, whole] = min(apart, found.get((first, whole), apart))
        if len(small) < 16:
            for place in small:
                insort(large, place)
        else:
            large += small
            large.sort()
        return large

    for part in np.split(deep, np.flatnonzero(np.diff(deep) > 1) + 1):
        places = order[part[0] : part[-1] + 2].tolist()
        nodes: list[tuple[int, list[int]]] = []
        child = [places[0]]
        for length, place in zip([*shared[part].tolist(), 0], [*places[1:], -1], strict=True):
            while nodes and nodes[-1][0] > length:
                depth, held = nodes.pop()
                child = meet(held, child, depth)
            if nodes and nodes[-1][0] == length:
                child = meet(nodes.pop()[1], child, length)
            nodes.append((length, child))
            child = [place]
    return sorted((start, length, period) for (start, length), period in found.items())


def _repeating(hashes: np.ndarray, words: Words, least: int) -> list[int]:
    """Texts in which so many words in a row occur twice."""
    at, text = starts_of_runs(words.first, least)
    if not len(at):
        return []
    key = mix(rolling(hashes, least)[at] ^ mix(text.astype(np.uint64) + np.uint64(1)))
    order = np.argsort(key)
    again = order[1:][key[order[1:]] == key[order[:-1]]]
    return np.unique(text[again]).tolist()


def collapse(
    docs: DataFrame,
    shortest: int = SHORTEST,
    exponent: int = EXPONENT,
    reread: Callable[[int | None, int], np.ndarray | None] | None = None,
) -> DataFrame:
    """doc_id, n_words, runs (start, length, period) and `collapsed`: the words that stay, joined by spaces.

    A word goes if a run holds it after that run's first period. reread(doc_id, n) may give the places of
    the words to be read in the place of a document's n words.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("n_words", pa.int64()), ("runs", _RUN_TYPE), ("collapsed", pa.string())])
    least = shortest - shortest // exponent

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"), NOT_SPACE)
        counts = np.diff(words.first).tolist()
        hashes, read = words.hashes.copy(), {}
        for k, (doc_id, n) in enumerate(zip(batch.column("doc_id").to_pylist(), counts, strict=True)):
            places = reread(doc_id, n) if reread and n else None
            if places is not None:
                read[k] = places
                hashes[words.first[k] : words.first[k + 1]] = words.hashes[words.first[k] + places]
        runs: list[list] = [[]] * len(counts)
        for k in _repeating(hashes, words, least):
            runs[k] = find_runs(hashes[words.first[k] : words.first[k + 1]], shortest, exponent)
        texts = []
        for k, n in enumerate(counts):
            a, b = words.first[k], words.first[k + 1]
            own = words.data[words.begin[a] : words.end[b - 1]].tobytes().split() if n else []
            places = read.get(k, np.arange(n))
            if runs[k]:
                gone = np.zeros(n + 1, np.int64)
                for start, length, period in runs[k]:
                    gone[start + period] += 1
                    gone[start + length] -= 1
                places = places[np.cumsum(gone)[:n] == 0]
            if k in read or runs[k]:
                own = [own[i] for i in places.tolist()]
            texts.append(b" ".join(own))
        flat = [r for found in runs for r in found]
        ends = np.cumsum([0, *map(len, runs)])
        values = np.array(flat, np.int64).reshape(-1, 3)
        structs = pa.StructArray.from_arrays([pa.array(c) for c in values.T.copy()], ["start", "length", "period"])
        return pa.record_batch([
            batch.column("doc_id"), pa.array(counts, pa.int64()), pa.ListArray.from_arrays(pa.array(ends, pa.int32()), structs),
            pa.array(texts, pa.binary()).cast(pa.string()),
        ], schema=fields)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return map_slices(keyed, run, f"doc_id long, n_words long, runs array<{_RUN}>, collapsed string")


def periodic_tail(doc_id: int | None, n: int) -> np.ndarray | None:
    """Places that let the end of one document in ten repeat; the checksum of its id says where and how."""
    h = 1 if doc_id is None else zlib.crc32(str(doc_id).encode())
    if h % 10:
        return None
    g = h // 10
    a = g % n
    places = np.arange(n)
    places[a:] = a + (places[a:] - a) % (1 + (n - a) // (3 + g % 8))
    return places


def op12_periodic_runs(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = collapse(table(spark, sf_dir, "documents"), reread=periodic_tail)
    nothing = F.lit(None).cast(_RUN)
    # runs are ordered, so a later one must be greater: length / period compared without division
    best = F.aggregate("runs", nothing, lambda top, r: F.when(
        top.isNull() | (r.length * top.period > top.length * r.period), r).otherwise(top))
    lines = F.transform("runs", lambda r: F.concat(
        r.start.cast("string"), F.lit(","), r.length.cast("string"), F.lit(","), r.period.cast("string"), F.lit("\n")))
    return found.select(
        "doc_id", F.size("runs").cast("long").alias("n_runs"), best.alias("best"),
        F.sha2(F.array_join(lines, ""), 256).alias("runs_sha256"), F.sha2(F.col("collapsed"), 256).alias("collapsed_sha256"),
    ).select(
        "doc_id", "n_runs", "best.*", F.floor(1000 * F.col("best.length") / F.col("best.period")).alias("exponent_milli"),
        "runs_sha256", "collapsed_sha256",
    )


#: crc32 of a string of ASCII characters, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(list_transform(string_split({0}, ''),
    lambda c: [unicode(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))))"""

OP12_SQL = r"""
WITH t AS (SELECT doc_id, w, len(w)::BIGINT AS n, CRC AS h FROM (
  SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents)),
p AS (SELECT *, CASE WHEN h % 10 = 0 AND n > 0 THEN (h // 10) % n END AS a FROM t),
d AS MATERIALIZED (SELECT doc_id, n, CASE WHEN a IS NULL THEN w ELSE
  list_transform(range(n), lambda i: w[1 + CASE WHEN i < a THEN i ELSE a + (i - a) % (1 + (n - a) // (3 + (h // 10) % 8)) END]) END AS w
  FROM p),
k AS MATERIALIZED (SELECT doc_id, i, n, array_to_string(w[i + 1:i + 16], ' ') AS g FROM (
  SELECT doc_id, n, w, unnest(range(n - 15)) AS i FROM d WHERE n >= 24)),
m AS (SELECT x.doc_id, x.i, y.i - x.i AS q FROM k x JOIN k y ON x.doc_id = y.doc_id AND x.g = y.g AND y.i > x.i AND 3 * (y.i - x.i) <= x.n),
s AS (SELECT doc_id, q, min(i) AS start, count(*) + 15 + q AS length FROM (
  SELECT *, i - row_number() OVER (PARTITION BY doc_id, q ORDER BY i) AS part FROM m) GROUP BY doc_id, q, part),
r AS (SELECT doc_id, start, length, min(q) AS period FROM s WHERE length >= greatest(24, 3 * q) GROUP BY doc_id, start, length),
best AS (SELECT * FROM (SELECT *, floor(1000 * length / period)::BIGINT AS exponent_milli,
  row_number() OVER (PARTITION BY doc_id ORDER BY length::DOUBLE / period DESC, start, period) AS place FROM r) WHERE place = 1),
lines AS (SELECT doc_id, count(*) AS n_runs, string_agg(start || ',' || length || ',' || period || chr(10), '' ORDER BY start, period) AS lines
  FROM r GROUP BY doc_id),
gone AS (SELECT doc_id, list(DISTINCT i) AS gone FROM (
  SELECT doc_id, unnest(range(start + period, start + length)) AS i FROM r) GROUP BY doc_id)
SELECT d.doc_id, coalesce(n_runs, 0) AS n_runs, start::BIGINT AS start, length::BIGINT AS length, period::BIGINT AS period, exponent_milli,
  sha256(coalesce(lines, '')) AS runs_sha256, sha256(array_to_string(CASE WHEN gone IS NULL THEN w ELSE
    list_transform(list_filter(range(n), lambda i: NOT list_contains(gone, i)), lambda i: w[i + 1]) END, ' ')) AS collapsed_sha256
FROM d LEFT JOIN best USING (doc_id) LEFT JOIN lines USING (doc_id) LEFT JOIN gone USING (doc_id)
""".replace("CRC", _CRC.format("doc_id::VARCHAR"))
