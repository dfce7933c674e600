"""Scores of texts by a class-based bigram model: P(word | class) * P(class | class of the word before).

Classes come from exchange clustering: a word moves to the class that raises the likelihood of the
corpus most. As in distributed exchange, all words of a round are tried at once against the counts
of the round before; after the first round one half of them moves, then the other. The `CORE` most
frequent words are exchanged; they begin as one class each, as far as classes go, and one class for
the rest. Every other word then joins the class under which its neighbours are likeliest, which is
one exchange against the counts of the core. The core bounds what is broadcast: its hashes, counts
and classes, and a matrix of classes. All words keep their own count and class.

Transitions are counted over all training texts with all words' classes, and smoothed by absolute
discounting towards the classes' shares; emissions are counts over the class's count. A word that
training never saw stands for one unknown word whose share is that of words seen once; behind it
the classes' shares hold.

Texts are read twice, to count words and to write them as numbers: a word of the core by its rank,
others by their place in the text's own list. Later steps read these. Classes of other words reach
a text by a join on the word and one on the text; words outside the core cannot be hot.

Words are runs of other characters than white space, A-Z in lower case, held as 64-bit hashes, and one end a
text. A null or empty text has the end alone. Rows are scored one by one, repeated ones alike; a null
doc_id trains. Without training texts all tokens are unknown and every score is 0. An empty table gives
no rows. Only doc_id and text are read.
"""

from __future__ import annotations

import gc
import time
from collections.abc import Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import Scratch, gathered, map_slices, table
from courtflow.llm.words import NOT_SPACE, find_words

CORE = 1 << 15
CLASSES = 128
ROUNDS = 4
TASKS = 64
END = np.uint64(0x9D1C5B8E52F4A7E3)
#: Words of the core are looked up by so many bits of their hash.
START_BITS = 17
#: Lists of so many entries are added up side by side.
SHORT = 16
UNKNOWN = 255  # a class is a byte, so CLASSES may be 255 at most


def _starting(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - START_BITS)).astype(np.int64)


class Core(NamedTuple):
    """The most frequent words: rank 0 is the end; hashes in order, with the rank and count of each."""

    hashes: np.ndarray
    ranks: np.ndarray
    counts: np.ndarray  # by rank

    def starts(self) -> np.ndarray:
        """The first place in hashes for each beginning of START_BITS bits, and the end."""
        counts = np.bincount(_starting(self.hashes), minlength=1 << START_BITS)
        return np.concatenate([[0], np.cumsum(counts)]).astype(np.int32)

    def rank(self, hashes: np.ndarray, starts: np.ndarray) -> np.ndarray:
        """The rank of each word, or -1."""
        begin = _starting(hashes)
        at, stop = starts[begin], starts[begin + 1]
        out = np.full(len(hashes), -1, np.int64)
        rest = np.flatnonzero(at < stop)
        while len(rest):
            place = at[rest]
            met = self.hashes[place] == hashes[rest]
            out[rest[met]] = self.ranks[place[met]]
            rest = rest[~met]
            at[rest] += 1
            rest = rest[at[rest] < stop[rest]]
        return out


class Model(NamedTuple):
    core: Core
    core_classes: np.ndarray
    words: DataFrame  # h, n, class of the words outside the core
    totals: np.ndarray  # tokens of each class
    n: int
    distinct: int
    once: int

    def base(self, counts: np.ndarray) -> np.ndarray:
        return np.log10((counts + 0.1) / (self.n + 0.1 * (self.distinct + 1)))

    def unknown(self) -> float:
        return max(self.once, 0.1) / (self.n + 0.1 * (self.distinct + 1)) if self.n else 1.0


def held_out() -> Column:
    return F.coalesce(F.crc32(F.col("doc_id").cast("string")) % 10 == 0, F.lit(False))


def _release(spark: SparkSession) -> None:
    """Let Spark delete shuffle files of steps that are written.

    It does so, a little later, when the driver's memory is cleared of the plans that made them: first of
    Python's handles, then of the plans.
    """
    for _ in range(2):
        gc.collect()
        spark._jvm.System.gc()
        time.sleep(1)


def word_counts(docs: DataFrame) -> DataFrame:
    """h, n: how often every word (and the end) occurs."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"), NOT_SPACE, lower=True)
        h, n = np.unique(words.hashes, return_counts=True)
        h, n = np.append(h, END), np.append(n, batch.num_rows)
        return pa.record_batch([pa.array(h.view(np.int64)), pa.array(n, pa.int64())], names=["h", "n"])

    return map_slices(docs.select("text"), run, "h long, n long").groupBy("h").agg(F.sum("n").alias("n"))


def core_of(counts: DataFrame, size: int) -> Core:
    """The end and the most frequent words; ties go to the smaller hash."""
    end = int(END.view(np.int64))
    top = counts.where(F.col("h") != end).orderBy(F.desc("n"), "h").limit(size - 1).collect()
    ends = counts.where(F.col("h") == end).first()
    hashes = np.array([end, *(r.h for r in top)], np.int64).view(np.uint64)
    order = np.argsort(hashes)
    return Core(hashes[order], order, np.array([ends.n if ends else 0, *(r.n for r in top)], np.int64))


def as_numbers(docs: DataFrame, core: Core, size: int) -> DataFrame:
    """Texts in numbers: row, doc_id, held, codes (ranks in the core, or size + place in `other`), wide, other (hashes).

    Codes are bytes, two a code or, where a text is wide, four.
    """
    fields = pa.schema([("doc_id", pa.int64()), ("held", pa.bool_()), ("codes", pa.binary()), ("wide", pa.bool_()), ("other", pa.list_(pa.int64()))])

    starts = core.starts()

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"), NOT_SPACE, lower=True)
        codes = core.rank(words.hashes, starts)
        away = np.flatnonzero(codes < 0)
        text, h = words.text_of()[away], words.hashes[away]
        order = np.lexsort((h, text))
        text, h = text[order], h[order]
        new = np.ones(len(h), bool)
        new[1:] = (h[1:] != h[:-1]) | (text[1:] != text[:-1])
        begins = np.searchsorted(text[new], np.arange(batch.num_rows + 1))
        codes[away[order]] = size + np.cumsum(new) - 1 - begins[text]
        codes = np.insert(codes, words.first[1:], 0)  # the end of each text
        first = words.first + np.arange(len(words.first))
        wide = size + np.diff(begins) > 1 << 16
        return pa.record_batch([
            batch.column("doc_id"), batch.column("held"),
            pa.array([codes[a:b].astype("<u4" if w else "<u2").tobytes() for a, b, w in zip(first, first[1:], wide, strict=False)], pa.binary()),
            pa.array(wide), pa.ListArray.from_arrays(pa.array(begins, pa.int32()), pa.array(h[new].view(np.int64))),
        ], schema=fields)

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), held_out().alias("held"), "text")
    rows = map_slices(rows, run, "doc_id long, held boolean, codes binary, wide boolean, other array<long>")
    return rows.select(F.monotonically_increasing_id().alias("row"), "*")


def _codes(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The codes of all texts and len + 1 offsets."""
    parts = [np.frombuffer(c, "<u4" if w else "<u2")
             for c, w in zip(batch.column("codes").to_pylist(), batch.column("wide").to_pylist(), strict=True)]
    return np.concatenate([x.astype(np.int64) for x in parts]), np.concatenate([[0], np.cumsum([len(x) for x in parts])])


def _lists(column: pa.ListArray) -> tuple[np.ndarray, np.ndarray]:
    """The values of all lists and len + 1 offsets."""
    sizes = pc.list_value_length(column).fill_null(0).to_numpy(zero_copy_only=False)
    return column.flatten().to_numpy(zero_copy_only=False), np.concatenate([[0], np.cumsum(sizes)]).astype(np.int64)


def _before(codes: np.ndarray, first: np.ndarray) -> np.ndarray:
    """What stands before each token; the end before a text's first."""
    out = np.empty_like(codes)
    out[1:] = codes[:-1]
    out[first[:-1]] = 0
    return out


def core_pairs(texts: DataFrame, size: int) -> DataFrame:
    """a, b, n: how often a word of the core stands before another in training texts."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, first = _codes(batch)
        before = _before(codes, first)
        both = (codes < size) & (before < size)
        pairs, n = np.unique(before[both] * size + codes[both], return_counts=True)
        return pa.record_batch([pa.array(pairs, pa.int64()), pa.array(n, pa.int64())], names=["pair", "n"])

    pairs = map_slices(texts.where("not held").select("codes", "wide"), run, "pair long, n long", column="codes", most=1 << 20)
    return pairs.groupBy("pair").agg(F.sum("n").alias("n")).select(
        F.floor(F.col("pair") / size).cast("int").alias("a"), (F.col("pair") % size).cast("int").alias("b"), "n")


def neighbours(pairs: DataFrame, size: int) -> DataFrame:
    """word, near, n: all neighbours of a word of the core, those before it raised by size; 2 * size at most."""
    sides = F.explode(F.array(
        F.struct(F.col("a").alias("word"), F.col("b").alias("near"), "n"),
        F.struct(F.col("b").alias("word"), (F.col("a") + size).alias("near"), "n")))
    # so many files that the exchange, which is work and not bytes, has tasks for all cores
    return pairs.select(sides.alias("x")).select("x.*").repartition(TASKS, "word").groupBy("word").agg(
        F.sort_array(F.collect_list(F.struct("near", "n"))).alias("x")).select("word", "x.near", "x.n")


def _cells(batches: DataFrame, classes: int) -> np.ndarray:
    """Rows (cell, n) summed into a matrix of classes."""
    out = np.zeros(classes * classes, np.float64)
    for r in batches.groupBy("cell").agg(F.sum("n").alias("n")).collect():
        out[r.cell] = r.n
    return out.reshape(classes, classes)


def class_pairs(pairs: DataFrame, of: np.ndarray, classes: int) -> np.ndarray:
    """How often a class stands before another, from pairs of words."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        a, b, n = (batch.column(c).to_numpy(zero_copy_only=False) for c in ("a", "b", "n"))
        sums = np.bincount(of[a] * classes + of[b], n, classes * classes).astype(np.int64)  # exact up to 2^53
        cells = np.flatnonzero(sums)
        return pa.record_batch([pa.array(cells, pa.int64()), pa.array(sums[cells])], names=["cell", "n"])

    def batches(rows: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return (run(b) for b in gathered(rows, "n", 8 << 20) if b.num_rows)

    return _cells(pairs.mapInArrow(batches, "cell long, n long"), classes)


def _xlogx(x: np.ndarray) -> np.ndarray:
    return x * np.log(np.maximum(x, 1))


def gains(matrix: np.ndarray, own: int, after: np.ndarray, before: np.ndarray, twice: float, logs: np.ndarray | None = None) -> np.ndarray:
    """How much the likelihood of the corpus gains from a word that joins each class instead of none.

    after and before count the classes of the words next to it, twice counts it next to itself. logs is
    _xlogx(matrix), of which a word changes its own class's row and column only.
    """
    logs = _xlogx(matrix) if logs is None else logs.copy()
    left = matrix.copy()
    left[own] -= after
    left[:, own] -= before
    left[own, own] -= twice
    logs[own], logs[:, own] = _xlogx(left[own]), _xlogx(left[:, own])
    s, p = np.flatnonzero(after), np.flatnonzero(before)
    rows = _xlogx(left[:, s] + after[s]) - logs[:, s]
    columns = _xlogx(left[p] + before[p, None]) - logs[p]
    rows[s, np.arange(len(s))] = 0
    columns[np.arange(len(p)), p] = 0
    middle = left.diagonal()
    gain = rows.sum(axis=1) + columns.sum(axis=0) + _xlogx(middle + after + before + twice) - _xlogx(middle)
    # its neighbours' pairs with it count in their classes' sums wherever it goes
    for total, more in ((left.sum(axis=1) + before, after.sum()), (left.sum(axis=0) + after, before.sum())):
        gain -= _xlogx(total + more + twice) - _xlogx(total)
    return gain


def exchange(near: DataFrame, matrix: np.ndarray, of: np.ndarray, size: int, classes: int) -> np.ndarray:
    """The class that each word of the core would choose; the end keeps its own."""
    logs = _xlogx(matrix)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        ids, offsets = _lists(batch.column("near"))
        counts, _ = _lists(batch.column("n"))
        words = batch.column("word").to_numpy(zero_copy_only=False)
        chosen = []
        for k, word in enumerate(words.tolist()):
            own = int(of[word])
            at, n = ids[offsets[k] : offsets[k + 1]], counts[offsets[k] : offsets[k + 1]].astype(np.float64)
            behind, self_ = at < size, at % size == word
            twice = n[behind & self_].sum()
            sides = [np.bincount(of[at[m] % size], n[m], classes) for m in (behind & ~self_, ~behind & ~self_)]
            gain = gains(matrix, own, *sides, twice, logs)
            gain[0] = -np.inf
            best = int(gain.argmax())
            chosen.append(best if word and gain[best] > gain[own] + 1e-6 else own)
        return pa.record_batch([pa.array(words, pa.int32()), pa.array(chosen, pa.int32())], names=["word", "class"])

    moved = map_slices(near, run, "word int, class int", column="near")
    out = of.copy()
    for r in moved.collect():  # at most as many as the core has words
        out[r.word] = r["class"]
    return out


def cluster(pairs: DataFrame, near: DataFrame, words: int, size: int, classes: int, rounds: int) -> tuple[np.ndarray, np.ndarray]:
    """The class of each word of the core, and the matrix of their transitions."""
    of = np.minimum(np.arange(words), classes - 1)
    for k in range(rounds):
        wanted = exchange(near, class_pairs(pairs, of, classes), of, size, classes)
        # all move at first, then one half and the other: two words that attract each other do not change places for ever
        moves = np.ones(words, bool) if k == 0 else np.arange(words) % 2 == k % 2
        of = np.where(moves, wanted, of)
    return of, class_pairs(pairs, of, classes)


def sums_of_lists(rows, offsets: np.ndarray, width: int) -> np.ndarray:
    """For each list, which has entries, the sum of the rows of a matrix that rows gives for some entries."""
    size = np.diff(offsets)
    order = np.argsort(-size, kind="stable")
    begin, size = offsets[:-1][order], size[order]
    sums = np.zeros((len(size), width))
    long = int((size > SHORT).sum())
    for k, (a, b) in enumerate(zip(begin[:long].tolist(), size[:long].tolist(), strict=True)):
        sums[k] = rows(np.arange(a, a + b)).sum(axis=0)
    # the first entries of all short lists, the second ones and so on; most have few
    for k in range(SHORT):
        some = int((size > k).sum())
        sums[long:some] += rows(begin[long:some] + k)
    out = np.empty_like(sums)
    out[order] = sums
    return out


def joined_classes(texts: DataFrame, of: np.ndarray, matrix: np.ndarray, size: int, classes: int) -> DataFrame:
    """h, class of words outside the core that stand next to a word of it in training texts."""
    def contexts(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, first = _codes(batch)
        other, begins = _lists(batch.column("other"))
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        before = _before(codes, first)
        # a text ends in a word of the core, so what follows lies in the same text
        at = np.flatnonzero(codes >= size)
        sides = [np.where(near < size, of[np.where(near < size, near, 0)], classes) for near in (before[at], codes[at + 1])]
        code = sides[0] * (classes + 1) + sides[1]
        return pa.record_batch([pa.array(other[begins[text[at]] + codes[at] - size], pa.int64()), pa.array(code, pa.int32())], names=["h", "code"])

    smooth = matrix + 0.01
    after = np.log(smooth / smooth.sum(axis=0))  # row: the class before, column: the class joined
    before = np.log(smooth.T / smooth.sum(axis=1))  # row: the class behind
    # the last row is for a neighbour outside the core, which says nothing
    after, before = (np.vstack([x, np.zeros(classes)]) for x in (after, before))

    def choose(batch: pa.RecordBatch) -> pa.RecordBatch:
        code, offsets = _lists(batch.column("code"))
        n, _ = _lists(batch.column("n"))
        scores = sums_of_lists(lambda at: (after[code[at] // (classes + 1)] + before[code[at] % (classes + 1)]) * n[at, None], offsets, classes)
        scores[:, 0] = -np.inf
        return pa.record_batch([batch.column("h"), pa.array(scores.argmax(axis=1), pa.int32())], names=["h", "class"])

    rows = map_slices(texts.where("not held").select("codes", "wide", "other"), contexts, "h long, code int", column="codes", most=1 << 20)
    # one shuffle serves both groupings; a word outside the core is too rare to be hot
    lists = rows.repartition("h").groupBy("h", "code").agg(F.count(F.lit(1)).alias("n")).groupBy("h").agg(
        F.collect_list(F.struct("code", "n")).alias("x")).select("h", "x.code", "x.n")
    # a number for each class and neighbour, so few words at once
    return map_slices(lists, choose, "h long, class int", column="code", most=1 << 17)


def train(scratch: Scratch, docs: DataFrame, size: int = CORE, classes: int = CLASSES, rounds: int = ROUNDS) -> tuple[Model, DataFrame]:
    """The model, and all texts in numbers."""
    spark = scratch.spark
    counts = scratch.stored(word_counts(docs.where(~held_out())), "counts")
    sums = counts.agg(F.sum("n"), F.count(F.lit(1)), F.count_if(F.col("n") == 1)).first()
    core = core_of(counts, size)
    texts = scratch.stored(as_numbers(docs, core, size), "numbers")
    pairs = scratch.stored(core_pairs(texts, size), "pairs")
    near = scratch.stored(neighbours(pairs, size), "neighbours")
    _release(spark)
    of, matrix = cluster(pairs, near, len(core.counts), size, classes, rounds)
    scratch.drop(pairs, near)
    known = spark.createDataFrame([(int(h),) for h in core.hashes.view(np.int64)], "h long")
    likely = int(np.bincount(of[1:], core.counts[1:], classes).argmax()) if len(of) > 1 else 1
    others = counts.join(F.broadcast(known), "h", "left_anti").join(joined_classes(texts, of, matrix, size, classes), "h", "left")
    words = scratch.stored(others.select("h", "n", F.coalesce("class", F.lit(likely)).alias("class")), "words")
    _release(spark)
    totals = np.bincount(of, core.counts, classes)
    for r in words.groupBy("class").agg(F.sum("n").alias("n")).collect():
        totals[r["class"]] += r.n
    scratch.drop(counts)
    return Model(core, of, words, totals, sums[0] or 0, sums[1], sums[2]), texts


def with_classes(scratch: Scratch, texts: DataFrame, model: Model, size: int = CORE) -> DataFrame:
    """Per text: n_tokens, n_known, base_score, emission (log10 of words given their classes) and the classes of its tokens.

    Classes are bytes, UNKNOWN for a word that training never saw.
    """
    other = texts.select("row", F.posexplode("other").alias("place", "h"))
    found = other.join(model.words, "h").groupBy("row").agg(F.collect_list(F.struct("place", "class", "n")).alias("found"))
    # written, so that what led to it can go before texts are moved
    found = scratch.stored(found.select("row", "found.place", "found.class", "found.n"), "found")
    _release(scratch.spark)
    texts = texts.withColumn("n_other", F.size("other")).drop("other").join(found, "row", "left")
    core, of, totals = model.core, model.core_classes, model.totals
    known = model._replace(words=None)
    fields = pa.schema([("doc_id", pa.int64()), ("held", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()),
                        ("base_score", pa.float64()), ("emission", pa.float64()), ("classes", pa.binary())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        codes, first = _codes(batch)
        begins = np.concatenate([[0], np.cumsum(batch.column("n_other").to_numpy())])
        places, offsets = _lists(batch.column("place"))
        text = np.repeat(np.arange(len(first) - 1), np.diff(first))
        # counts and classes of the words outside the core, in the order of the texts' lists
        n, kind = np.zeros(begins[-1] + 1, np.int64), np.full(begins[-1] + 1, UNKNOWN, np.int64)
        at = np.repeat(begins[:-1], np.diff(offsets)) + places
        n[at], kind[at] = _lists(batch.column("n"))[0], _lists(batch.column("class"))[0]
        inside = codes < size
        own = np.where(inside, begins[-1], begins[text] + codes - size)
        rank = np.where(inside, codes, 0)
        counts = np.where(inside, core.counts[rank], n[own])
        kinds = np.where(counts > 0, np.where(inside, of[rank], kind[own]), UNKNOWN)
        total = np.append(totals, np.ones(UNKNOWN + 1 - len(totals)))[kinds]
        emission = np.where(counts > 0, np.log10(np.maximum(counts, 1) / np.maximum(total, 1)), 0.0)
        add = lambda x: np.add.reduceat(x, first[:-1])  # noqa: E731  every text has its end
        data = kinds.astype(np.uint8)
        return pa.record_batch([
            batch.column("doc_id"), batch.column("held"), pa.array(np.diff(first), pa.int64()), pa.array(add((counts > 0).astype(np.int64))),
            pa.array(add(known.base(counts))), pa.array(add(emission)),
            pa.array([data[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)], pa.binary()),
        ], schema=fields)

    return map_slices(texts, run, "doc_id long, held boolean, n_tokens long, n_known long, base_score double, emission double, classes binary",
                      column="codes")


def _kinds(batch: pa.RecordBatch) -> tuple[np.ndarray, np.ndarray]:
    """The classes of the tokens of all texts and len + 1 offsets."""
    lists = batch.column("classes").to_pylist()
    return np.frombuffer(b"".join(lists), np.uint8).astype(np.int64), np.concatenate([[0], np.cumsum([len(x) for x in lists])])


def transitions(read: DataFrame, classes: int) -> np.ndarray:
    """How often a class stands before another in training texts; texts begin behind an end."""
    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds, first = _kinds(batch)
        before = _before(kinds, first)
        both = (before != UNKNOWN) & (kinds != UNKNOWN)
        n = np.bincount(before[both] * classes + kinds[both], minlength=classes * classes)
        cells = np.flatnonzero(n)
        return pa.record_batch([pa.array(cells, pa.int64()), pa.array(n[cells], pa.int64())], names=["cell", "n"])

    rows = map_slices(read.where("not held").select("classes"), run, "cell long, n long", column="classes", most=1 << 20)
    return _cells(rows, classes)


def smoothed(matrix: np.ndarray, totals: np.ndarray) -> np.ndarray:
    """log10 of P(class | class before) by absolute discounting; the last row is for an unknown word before."""
    share = totals / max(totals.sum(), 1)
    once, twice = (matrix == 1).sum(), (matrix == 2).sum()
    discount = once / (once + 2 * twice) if once else 0.1
    sums = matrix.sum(axis=1, keepdims=True)
    kept = np.maximum(matrix - discount, 0)
    given = (kept + (sums - kept.sum(axis=1, keepdims=True)) * share) / np.maximum(sums, 1)
    with np.errstate(divide="ignore"):
        return np.log10(np.vstack([np.where(sums > 0, given, share), share]))


def scores(docs: DataFrame, size: int = CORE, classes: int = CLASSES, rounds: int = ROUNDS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score of every row."""
    scratch = Scratch(docs.sparkSession)
    model, texts = train(scratch, docs, size, classes, rounds)
    read = scratch.stored(with_classes(scratch, texts, model, size), "classes")
    _release(docs.sparkSession)
    step = smoothed(transitions(read, classes), model.totals)
    unknown, known = np.log10(model.unknown()), np.log10(1 - model.unknown()) if model.n else 0.0

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kinds, first = _kinds(batch)
        before = _before(kinds, first)
        seen = kinds != UNKNOWN
        row, column = np.where(before == UNKNOWN, classes, before), np.where(seen, kinds, 0)
        each = np.where(seen, known + step[row, column], unknown)
        score = np.add.reduceat(each, first[:-1]) + batch.column("emission").to_numpy()
        columns = ["doc_id", "held", "n_tokens", "n_known", "base_score"]
        return pa.record_batch([*(batch.column(c) for c in columns), pa.array(score)], names=[*columns, "score"])

    out = map_slices(read, run, "doc_id long, held boolean, n_tokens long, n_known long, base_score double, score double", column="classes")
    return scratch.result(out.select(
        "doc_id", F.col("held").alias("held_out"), "n_tokens", "n_known", F.lit(model.n).cast("long").alias("train_tokens"), "base_score", "score"),
        "scores")


def perplexity(scored: DataFrame) -> DataFrame:
    """held_out, perplexity, base_perplexity over all tokens of texts held out or not."""
    each = lambda c: F.pow(F.lit(10.0), -F.sum(c) / F.sum("n_tokens"))
    return scored.groupBy("held_out").agg(each("score").alias("perplexity"), each("base_score").alias("base_perplexity"))


def op13_class_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scores(table(spark, sf_dir, "documents"))
