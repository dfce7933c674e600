"""Spelling variants: words one edit apart, found by an index of grams of variable length.

A gram of `SHORT` to `LONG` code points is extended by a code point only while it is frequent: more than
1/2^SHIFT of all code points of the vocabulary begin it. At most 2^SHIFT grams of each length are frequent, which
bounds the dictionary that is broadcast. A word's grams are, for each place, the longest that frequent
grams lead to, without those inside another one.

One edit at a place leaves a gram as it is unless the gram holds the place, or begins
behind it and could vanish inside a new gram that reaches over the edit; a frequent gram must then hold
what lies between. So for each place of an edit a word knows grams before and behind that its variants
surely have. As only one place is edited, a variant also shares all that is before the former and
behind the latter, and the first and last `FAR` code points unless these are edited. The lists of the
index are therefore kept by a gram with what is before it and the word's last code points, and by a
gram with what is behind it and the word's first. A word reads, for every place of an edit, the one list
that must hold its variants, and words on it are verified by their edit distance.

Words in which some edit could touch all grams find each other likewise by all grams of three; any
other variant of theirs finds them through lists of its own. So no pair is lost.

Only the vocabulary is indexed, joined and grouped; texts are read once and counted per slice. A null or empty
text has no words; a row with a null doc_id is taken as it is written. Repeated rows count again, ties
go to the smallest word; an empty table gives no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import re
import zlib
from collections import Counter
from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import Scratch, map_slices, table

SHORT, LONG = 2, 4
SHIFT = 15
LEAST = 32  # a gram that begins so few places is never extended
FAR = 2
MIN_LENGTH = 7
_PLAIN = 3  # length of grams of words that an edit could touch everywhere
_RUNS = re.compile("[a-zÀ-ÿ]{%d,}" % MIN_LENGTH)


def misspelt(doc_id: int | None, run: bytes, length: int) -> int | None:
    """The place whose code point one run in 31 of a document loses, by a checksum."""
    if doc_id is None:
        return None
    h = zlib.crc32(run, zlib.crc32(b"%d:" % doc_id))
    return None if h % 31 else h % length


def vocabulary(docs: DataFrame, change: Callable[[int | None, bytes, int], int | None] | None = None) -> DataFrame:
    """word, n: words of at least MIN_LENGTH letters that occur twice; A-Z in lower case.

    change may name the place of a code point that a run of a document loses.
    """
    fields = pa.schema([("word", pa.string()), ("n", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter[str] = Counter()
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").to_pylist(), strict=True):
            # bytes.lower() changes A-Z alone
            found = Counter(_RUNS.findall((text or "").encode().lower().decode()))
            for word, n in found.items():
                at = change(doc_id, word.encode(), len(word)) if change else None
                if at is not None:
                    word = word[:at] + word[at + 1 :]
                    if len(word) < MIN_LENGTH:
                        continue
                counts[word] += n
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=fields)

    keyed = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    words = map_slices(keyed, run, "word string, n long")
    return words.groupBy("word").agg(F.sum("n").alias("n")).where("n >= 2")


def frequent_grams(words: DataFrame) -> frozenset[str]:
    """Grams that are extended; at most 2^SHIFT of each length."""
    total = words.agg(F.sum(F.length("word"))).first()[0] or 0
    fields = pa.schema([("gram", pa.string()), ("n", pa.int64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        counts: Counter[str] = Counter()
        for word in batch.column("word").to_pylist():
            for size in range(SHORT, LONG):
                counts.update([word[p : p + size] for p in range(len(word) - size + 1)])
        return pa.record_batch([pa.array(counts.keys(), pa.string()), pa.array(counts.values(), pa.int64())], schema=fields)

    grams = map_slices(words.select("word"), run, "gram string, n long", column="word")
    often = grams.groupBy("gram").agg(F.sum("n").alias("n")).where(F.col("n") > max(LEAST, total >> SHIFT))
    return frozenset(r.gram for r in often.collect())


def inner_parts(frequent: frozenset[str]) -> frozenset[str]:
    """What frequent grams hold behind their first code point."""
    return frozenset(g[a:b] for g in frequent for a in range(1, len(g)) for b in range(a + 1, len(g) + 1))


def decompose(word: str, frequent: frozenset[str]) -> list[tuple[int, int]]:
    """Begin and end of the word's grams."""
    grams, far = [], 0
    for begin in range(len(word) - SHORT + 1):
        end = begin + SHORT
        while end < len(word) and end - begin < LONG and word[begin:end] in frequent:
            end += 1
        if end > far:
            grams.append((begin, end))
            far = end
    return grams


def untouched(word: str, grams: list[tuple[int, int]], inner: frozenset[str]) -> list[tuple[int, int]]:
    """For each place of an edit: how much before and how much behind it surely stays, in whole grams.

    (0, 0) says that every gram may be touched. An insertion touches no more than a change of the
    place behind it or, at the end, of the last place.
    """
    kept, before, i, j, n, length = [], 0, 0, 0, len(grams), len(word)
    for place in range(length):
        while i < n and grams[i][1] <= place:
            before = grams[i][1]
            i += 1
        while j < n and grams[j][0] <= place:
            j += 1
        k = j
        while k < n and word[place + 1 : grams[k][1] - 1] in inner:
            k += 1
        kept.append((before, length - grams[k][0] if k < n else 0))
    return kept


def _reads(word: str, kept: list[tuple[int, int]]) -> list[str]:
    """The lists that a word reads: for each place of an edit that of the longer side."""
    length, keys = len(word), set()
    for place, (before, behind) in enumerate(kept):
        tail = FAR if place < length - FAR else 0
        head = FAR if place >= FAR else 0
        if before and (before + tail >= behind + head or not behind):
            keys.add(f"{word[:before]}<{word[length - tail:]}")
        else:
            keys.add(f"{word[:head]}>{word[length - behind:]}")
    return list(keys)


def _lists(word: str, grams: list[tuple[int, int]]) -> list[str]:
    """The lists that a word is on.

    Ends of neighbouring grams are less than LONG apart, so what is before one of the last
    places, where no tail is read with it, is nearly the whole word.
    """
    length = len(word)
    head, tail = word[:FAR], word[length - FAR :]
    return [
        *(f"{word[:end]}<{tail}" for _, end in grams if end + FAR <= length),
        *(f"{word[:end]}<" for _, end in grams if end >= length - LONG - 1),
        *(f"{head}>{word[begin:]}" for begin, _ in grams if begin >= FAR),
        *(f">{word[begin:]}" for begin, _ in grams),
    ]


def keys_of(word: str, frequent: frozenset[str], inner: frozenset[str]) -> tuple[list[str], list[str]]:
    """The lists that a word reads, and those that it is on."""
    grams = decompose(word, frequent)
    kept = untouched(word, grams, inner)
    on = _lists(word, grams)
    if (0, 0) not in kept:
        return _reads(word, kept), on
    plain = [(p, p + _PLAIN) for p in range(len(word) - _PLAIN + 1)]
    reads = _reads(word, untouched(word, plain, frozenset()))
    # lists of their own: no word holds a plus
    return [f"+{key}" for key in reads], on + [f"+{key}" for key in _lists(word, plain)]


def near_pairs(scratch: Scratch, words: DataFrame) -> DataFrame:
    """a, b, n_a, n_b: words of a vocabulary (word, n) that are one edit apart, a before b."""
    frequent = frequent_grams(words)
    inner = inner_parts(frequent)
    lists = pa.list_(pa.string())

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        reads, on = zip(*(keys_of(word, frequent, inner) for word in batch.column("word").to_pylist()), strict=True)
        return pa.record_batch([batch.column("word"), batch.column("n"), pa.array(reads, lists), pa.array(on, lists)],
                               names=["word", "n", "reads", "is_on"])

    keys = map_slices(words.select("word", "n"), run, "word string, n long, reads array<string>, is_on array<string>",
                      column="word", most=1 << 18)
    keys = scratch.stored(keys, "keys")

    def side(name: str, column: str) -> DataFrame:
        rows = keys.select("word", "n", F.explode(column).alias("key"))
        return rows.select("word", "n", F.xxhash64("key").alias("key")).alias(name)

    x, y = side("x", "reads"), side("y", "is_on")
    apart = F.abs(F.length("x.word") - F.length("y.word"))
    first, second = (F.struct(f"{s}.word", f"{s}.n") for s in "xy")
    return (
        x.join(y, F.col("x.key") == F.col("y.key"))
        .where((F.col("x.word") != F.col("y.word")) & (apart <= 1))
        .where(F.levenshtein(F.col("x.word"), F.col("y.word"), 1) == 1)
        .select(F.least(first, second).alias("a"), F.greatest(first, second).alias("b"))
        .distinct()
        .select(F.col("a.word").alias("a"), F.col("b.word").alias("b"), F.col("a.n").alias("n_a"), F.col("b.n").alias("n_b"))
    )


def variants(words: DataFrame, times: int = 10) -> DataFrame:
    """word, n, n_near, form, form_n, root of every word of a vocabulary (word, n).

    form is the most frequent near word if it is `times` as frequent; root is where forms lead to.
    """
    scratch = Scratch(words.sparkSession)
    words = scratch.stored(words, "vocabulary")
    both = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), F.col("n_b").alias("near_n")),
        F.struct(F.col("b").alias("word"), F.col("a").alias("near"), F.col("n_a").alias("near_n"))))
    near = near_pairs(scratch, words).select(both.alias("x")).select("x.*").groupBy("word").agg(
        F.count(F.lit(1)).alias("n_near"), F.min(F.struct((-F.col("near_n")).alias("less"), "near")).alias("top"))
    enough = -F.col("top.less") >= times * F.col("n")
    formed = scratch.stored(
        words.join(near, "word", "left").select(
            "word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"),
            F.when(enough, F.col("top.near")).alias("form"), F.when(enough, -F.col("top.less")).alias("form_n")),
        "formed")
    # a form is `times` as frequent, so chains are short; each round doubles what is behind a word
    ways = scratch.stored(formed.where("form is not null").select("word", F.col("form").alias("root")), "ways")
    while True:
        ahead = ways.select(F.col("word").alias("root"), F.col("root").alias("further"))
        onward = ways.join(ahead, "root", "left").select(
            "word", F.coalesce("further", "root").alias("root"), F.col("further").isNotNull().alias("moved"))
        onward = scratch.stored(onward, "ways")
        more = onward.where("moved").limit(1).count()
        scratch.drop(ways)
        ways = onward
        if not more:
            break
    out = formed.join(ways.drop("moved"), "word", "left").withColumn("root", F.coalesce("root", "word"))
    return scratch.result(out.select("word", "form", "root", "n", "n_near", "form_n"), "variants")


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return variants(vocabulary(table(spark, sf_dir, "documents"), misspelt))


#: crc32 of a string of code points up to U+00FF, bit by bit
_CRC = """xor(4294967295, list_reduce(list_prepend(4294967295::BIGINT, flatten(flatten(list_transform(string_split({0}, ''),
    lambda c: CASE WHEN unicode(c) < 128 THEN [[unicode(c)::BIGINT, 0, 0, 0, 0, 0, 0, 0]]
      ELSE [[195::BIGINT, 0, 0, 0, 0, 0, 0, 0], [unicode(c)::BIGINT - 64, 0, 0, 0, 0, 0, 0, 0]] END)))),
    lambda a, b: xor(xor(a, b) >> 1, 3988292384 * (xor(a, b) & 1))))"""

OP11_SQL = r"""
WITH RECURSIVE t AS (SELECT doc_id, unnest(regexp_extract_all(
    translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{C0}-\x{FF}]+')) AS w FROM documents),
r AS MATERIALIZED (SELECT doc_id, w, count(*) AS n FROM t WHERE length(w) >= 7 GROUP BY doc_id, w),
h AS (SELECT w, n, CRC AS h FROM r),
c AS (SELECT CASE WHEN h % 31 = 0 THEN left(w, h % length(w)) || substr(w, h % length(w) + 2) ELSE w END AS word, n FROM h),
v AS MATERIALIZED (SELECT word, sum(n)::BIGINT AS n FROM c WHERE length(word) >= 7 GROUP BY word HAVING sum(n) >= 2),
d AS MATERIALIZED (SELECT word, n, i, left(word, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(length(word))) AS i FROM v)),
e AS MATERIALIZED (
  SELECT x.word AS word, y.word AS near, y.n AS near_n FROM d x JOIN d y ON x.rest = y.rest AND x.i = y.i AND x.word <> y.word
  UNION SELECT d.word, v.word, v.n FROM d JOIN v ON d.rest = v.word UNION SELECT v.word, d.word, d.n FROM d JOIN v ON d.rest = v.word),
k AS (SELECT word, count(*) AS n_near, min({'a': -near_n, 'b': near}) AS top FROM e GROUP BY word),
f AS MATERIALIZED (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN -top.a >= 10 * n THEN top.b END AS form,
  CASE WHEN -top.a >= 10 * n THEN -top.a END AS form_n FROM v LEFT JOIN k USING (word)),
g AS (SELECT word, word AS root, 0 AS depth FROM f
  UNION ALL SELECT g.word, f.form, depth + 1 FROM g JOIN f ON g.root = f.word WHERE f.form IS NOT NULL),
o AS (SELECT word, arg_max(root, depth) AS root FROM g GROUP BY word)
SELECT word, form, root, n, n_near, form_n FROM f JOIN o USING (word)
""".replace("CRC", _CRC.format("doc_id::VARCHAR || ':' || w"))
