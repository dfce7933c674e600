"""Benchmark passages in documents, by latent semantic retrieval and a longest common subsequence.

1. Texts are cut into passages of PASSAGE words, each begun half a passage after the last, and these
   become TF-IDF vectors over hashed words. Document frequencies come from all passages; no term is
   left out, however common, so an item that many documents hold keeps its vector.
2. A randomised singular value decomposition gives DIMENSIONS latent directions: every task adds up
   A'(A G) for its passages A and a random G, sums of fixed size meet in a few tasks, and the driver
   orthogonalises one matrix of terms by directions, POWERS + 1 times. The index is fitted on all
   passages of all documents; their words are cut once and written as numbers of terms, two bytes a
   word. Directions are scaled by their singular values, so that none outweighs the others.
3. A passage and an item meet if the words around the passage hold as many of the item's rarer words
   as any text has that passes step 4 (its other words are too few for that), and as many words in
   common with the item, in whatever order, as step 4 asks for in order; so nothing is lost here.
   Passages that meet an item are projected and compared by cosine with its projected passages. The
   benchmark, cut likewise, is an index of bounded size that a task holds whole; beyond ITEMS rows it
   is taken in blocks of so many. What reaches COSINE is a candidate.
4. Around a candidate, the longest common subsequence of words with the item must be a share of
   the item: COPIED, or PARAPHRASED if the item's last sentence, its answer, stands there as well.
   Up to SPAN neighbouring candidates are tried together first; where all their words have too few
   in common with the item, so has each.

Words are runs of letters, digits and other than ASCII, with A-Z in lower case. A null text has none and
matches nothing; items of fewer than MIN_WORDS words are not looked for. Repeated rows are judged
alike; several items of one text each count. An empty table, or an empty benchmark, gives no matches.
Only doc_id, text, item_id are read.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import Scratch, gathered, map_slices, table
from courtflow.llm.words import ALNUM, find_words, slices

TERM_BITS = 14
TERMS = 1 << TERM_BITS
DIMENSIONS = 128
POWERS = 1
PASSAGE = 32
#: What a term counts that all passages have.
FLOOR = 1.0
COSINE = 0.05
COPIED = 0.7
PARAPHRASED = 0.5
MIN_WORDS = 5
#: Passages in a row that are held against an item together, before each of them is.
SPAN = 8
#: Rarer words of an item that must be around a passage: a share of its words, three at least.
SHARED = 6
ITEMS = 20_000
#: Bytes of text and passages in memory at once.
SIZE = 1 << 19
PASSAGES_AT_ONCE = 1024
PROJECTED_AT_ONCE = 32
#: Bytes of numbers of terms that are fitted together; with more passages, more of them share a term.
FITTED_AT_ONCE = 3 << 17
#: Rows that are added up together for their terms, and from how many on a term has a product of its own.
TURNED_AT_ONCE = 1024
MANY = 64
MEETINGS_AT_ONCE = 1 << 17
#: First bits of a word's hash that a rarer word must have, before it is looked up.
BEGIN_BITS = 18
#: First bits of a word's hash, by which words are told apart before their order counts, and words looked at together.
MARK_BITS = 12
MARKED_AT_ONCE = 1 << 16


def passages(texts: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all words; first and last word, past the end, of each passage; its text; words' ends by text."""
    words = find_words(texts, ALNUM, lower=True)
    return terms_of(words.hashes).astype(np.int64), *cut(words.first), words.hashes


def terms_of(hashes: np.ndarray) -> np.ndarray:
    return hashes >> np.uint64(64 - TERM_BITS)


def cut(first: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First and last word, past the end, of each passage, and its text; text k has words first[k] to first[k + 1]."""
    count = np.diff(first)
    step = PASSAGE // 2
    number = np.where(count > 0, np.maximum(1, -(-(count - step) // step)), 0)
    text = np.repeat(np.arange(len(count)), number)
    inside = np.arange(len(text)) - np.repeat(np.cumsum(number) - number, number)
    begin = first[text] + inside * step
    return begin, np.minimum(begin + PASSAGE, first[text + 1]), text


def vectors(terms: np.ndarray, begin: np.ndarray, end: np.ndarray, idf: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Passages as (row, term, weight), one entry a distinct term, of length one."""
    row, term, times = distinct(terms, begin, end)
    scale = 1 + np.log(np.arange(1, times.max(initial=1) + 1))
    weight = scale[times - 1] * idf[term]
    norm = np.sqrt(np.bincount(row, weight**2, len(begin)))
    return row, term, (weight / np.maximum(norm, 1e-12)[row]).astype(np.float32)


def distinct(terms: np.ndarray, begin: np.ndarray, end: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Each passage's distinct terms in order, as (row, term), and how often it has them."""
    size = end - begin
    at = np.arange(size.sum()) + np.repeat(begin - (np.cumsum(size) - size), size)
    key = np.repeat(np.arange(len(begin)) << TERM_BITS, size) + terms[at]
    if len(begin) <= 1 << (32 - TERM_BITS):
        key = key.astype(np.uint32)  # sorted faster
    key.sort()
    edges = np.flatnonzero(np.concatenate([[len(key) > 0], key[1:] != key[:-1]]))
    times = np.diff(edges, append=len(key))
    key = key[edges].astype(np.int64)
    return key >> TERM_BITS, key & (TERMS - 1), times


def project(row: np.ndarray, term: np.ndarray, weight: np.ndarray, n: int, basis: np.ndarray) -> np.ndarray:
    """Rows of A times a matrix of terms by directions."""
    width = basis.shape[1]
    out = np.zeros((n, 1, width), np.float32)
    count = np.bincount(row, minlength=n)
    first = np.cumsum(count) - count
    most = count.max(initial=0)
    held = np.empty(PROJECTED_AT_ONCE * most * width, basis.dtype)
    for a in range(0, n if most else 0, PASSAGES_AT_ONCE):
        own = count[a : a + PASSAGES_AT_ONCE]
        low, high = first[a], first[a] + own.sum()
        # a passage's few terms side by side, those that are missing with no weight
        terms = np.zeros((len(own), most), np.int64)
        weights = np.zeros((len(own), 1, most), np.float32)
        at = (row[low:high] - a) * most + np.arange(low, high) - first[row[low:high]]
        terms.reshape(-1)[at], weights.reshape(-1)[at] = term[low:high], weight[low:high]
        for b in range(0, len(own), PROJECTED_AT_ONCE):
            some = terms[b : b + PROJECTED_AT_ONCE]
            rows = held[: some.size * width].reshape(*some.shape, width)
            np.take(basis, some, axis=0, out=rows, mode="clip")
            np.matmul(weights[b : b + len(some)], rows, out=out[a + b : a + b + len(some)])
    return out[:, 0]


def _turned(row: np.ndarray, term: np.ndarray, weight: np.ndarray, left: np.ndarray, total: np.ndarray) -> None:
    """Add A' times left to total, term by term; terms that equally many rows have, together."""
    order = np.argsort(term.astype(np.uint16), kind="stable")  # TERM_BITS are fewer than 16
    row, term, weight = row[order], term[order], weight[order]
    starts = np.flatnonzero(np.diff(term, prepend=-1))
    count = np.diff(starts, append=len(term))
    own = term[starts]
    width = left.shape[1]
    held = np.empty((TURNED_AT_ONCE, width), left.dtype)
    alike = np.argsort(count, kind="stable")
    sizes, since = np.unique(count[alike], return_index=True)
    for size, low, high in zip(sizes.tolist(), since.tolist(), np.append(since, len(alike))[1:].tolist(), strict=True):
        if size < MANY:
            step = TURNED_AT_ONCE // size
            for a in range(low, high, step):
                some = alike[a : min(a + step, high)]
                at = starts[some][:, None] + np.arange(size)
                rows = held[: at.size].reshape(*at.shape, width)
                np.take(left, row[at], axis=0, out=rows, mode="clip")
                total[own[some]] += np.matmul(weight[at][:, None], rows)[:, 0]
            continue
        for k in alike[low:high].tolist():
            for a in range(starts[k], starts[k] + size, TURNED_AT_ONCE):
                b = min(a + TURNED_AT_ONCE, starts[k] + size)
                np.take(left, row[a:b], axis=0, out=held[: b - a], mode="clip")
                total[own[k]] += weight[a:b] @ held[: b - a]


def numbered(docs: DataFrame) -> DataFrame:
    """The words of each text as numbers of terms, two bytes a word; none for a null text."""

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"), ALNUM, lower=True)
        terms = terms_of(words.hashes).astype("<u2")
        ends = pa.py_buffer((words.first * terms.itemsize).astype(np.int32))
        rows = pa.Array.from_buffers(pa.binary(), batch.num_rows, [None, ends, pa.py_buffer(terms)])
        return pa.record_batch([rows], names=["words"])

    return map_slices(docs.select("text"), run, "words binary", most=SIZE)


def _numbered_passages(words: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Terms of all words; first and last word, past the end, of each passage."""
    _, ends, data = words.buffers()
    ends = np.frombuffer(ends, np.int32)[words.offset : words.offset + len(words) + 1].astype(np.int64) // 2
    terms = np.frombuffer(data or b"", "<u2")[ends[0] : ends[-1]].astype(np.int64)
    return terms, *cut(ends - ends[0])[:2]


def _summed(numbers: DataFrame, add, width: int) -> np.ndarray:
    """The sum over all slices of a matrix of terms by width that add fills; of fixed size everywhere."""
    fields = pa.schema([("part", pa.int32()), ("values", pa.binary())])
    rows, parts = TERMS // 64, 64

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, any_ = np.zeros((TERMS, width)), False
        for batch in gathered(batches, "words", FITTED_AT_ONCE):
            for piece in slices(batch, "words", 2 * FITTED_AT_ONCE):
                any_ = True
                add(*_numbered_passages(piece.column("words")), total)
        for p in range(parts if any_ else 0):
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([total[p * rows : (p + 1) * rows].astype(np.float32).tobytes()])], schema=fields)
        # a worker process outlives its task
        pa.default_memory_pool().release_unused()

    def gather(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for p, values in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                sums[p] = sums.get(p, 0) + np.frombuffer(values, np.float32).astype(np.float64)
        for p, total in sums.items():
            yield pa.record_batch([pa.array([p], pa.int32()), pa.array([total.astype(np.float32).tobytes()])], schema=fields)

    spec = "part int, values binary"
    # tasks' sums meet by part; each part is as large as the others
    met = numbers.mapInArrow(run, spec).repartition(8, "part").mapInArrow(gather, spec)
    out = np.zeros((TERMS, width), np.float32)
    for p, values in met.collect():  # one matrix
        out[p * rows : (p + 1) * rows] = np.frombuffer(bytes(values), np.float32).reshape(rows, width)
    return out


@dataclass
class Space:
    """Weights of terms and the latent directions, terms by directions."""

    idf: np.ndarray
    basis: np.ndarray

    def place(self, terms: np.ndarray, begin: np.ndarray, end: np.ndarray) -> np.ndarray:
        """Passages as directions of length one."""
        row, term, weight = vectors(terms, begin, end, self.idf)
        out = project(row, term, weight, len(begin), self.basis)
        return out / np.maximum(np.sqrt((out**2).sum(1)), 1e-12)[:, None]


def latent_space(docs: DataFrame, dimensions: int = DIMENSIONS, powers: int = POWERS) -> Space:
    """The space of the passages of all texts."""
    spark = docs.sparkSession
    scratch = Scratch(spark)
    numbers = scratch.stored(numbered(docs), "numbered")

    def count(terms: np.ndarray, begin: np.ndarray, end: np.ndarray, total: np.ndarray) -> None:
        _, term, _ = distinct(terms, begin, end)
        total[:, 0] += np.bincount(term, minlength=TERMS)
        total[0, 1] += len(begin)

    counts = _summed(numbers, count, 2).astype(np.float64)
    n = counts[:, 1].sum()
    idf = np.log((n + 1) / (counts[:, 0] + 1)) + FLOOR
    basis = np.random.default_rng(11).standard_normal((TERMS, dimensions)).astype(np.float32)
    for _ in range(powers + 1):
        shared = spark.sparkContext.broadcast(Space(idf, basis))

        def add(terms: np.ndarray, begin: np.ndarray, end: np.ndarray, total: np.ndarray, shared=shared) -> None:
            entries = vectors(terms, begin, end, shared.value.idf)
            _turned(*entries, project(*entries, len(begin), shared.value.basis), total)

        made = _summed(numbers, add, dimensions)
        basis, values = np.linalg.qr(made.astype(np.float64))
        basis = basis.astype(np.float32)
    scratch.drop(numbers)
    # what A'A does to the last basis turns it and gives the squares of the singular values
    turn, squares, _ = np.linalg.svd(values)
    kept = squares > 1e-6 * max(squares[0], 1e-12)
    return Space(idf, (basis @ (turn[:, kept] / np.sqrt(squares[kept]))).astype(np.float32))


def places_of(words: np.ndarray) -> dict[int, int]:
    """The places of each word, as bits of one number."""
    places: dict[int, int] = {}
    for k, w in enumerate(words.tolist()):
        places[w] = places.get(w, 0) | 1 << k
    return places


def common_words(a: np.ndarray, b: np.ndarray) -> int:
    """Length of the longest common subsequence."""
    return common_places(a.tolist(), places_of(b), len(b))


def common_places(a: list[int], places: dict[int, int], size: int, least: int = 0) -> int:
    """Length of the longest common subsequence of a and size words with these places.

    0 where fewer than least of a's words are among them, for then it is shorter than that.
    """
    met = list(filter(None, map(places.get, a)))
    if len(met) < least:
        return 0
    full = row = (1 << size) - 1
    for m in met:
        match = row & m
        row = (row + match | row - match) & full
    return size - row.bit_count()


@dataclass
class Items:
    """Benchmark rows: their words, last sentences, and projected passages with the row of each."""

    ids: list[int]
    words: list[dict[int, int]]  # and their places
    sizes: list[int]
    answers: list[np.ndarray]
    places: np.ndarray
    owner: np.ndarray
    rare: np.ndarray  # the rarer words of all items, sorted
    begun: np.ndarray  # whether any of them has these first bits
    first: np.ndarray  # where each begins in held, and its end
    held: np.ndarray  # items that have it
    need: np.ndarray  # of which a text that passes has so many around it
    marked: np.ndarray  # where each item's marks begin, and the last one's end
    marks: np.ndarray  # marks of its words, each once
    times: np.ndarray  # how many of its words have it


def _items(rows: list, space: Space) -> Items:
    rows = [(r["item_id"], r["text"] or "") for r in rows]
    texts = pa.array([t for _, t in rows], pa.string())
    terms, begin, end, owner, hashes = passages(texts)
    words = find_words(texts, ALNUM, lower=True)
    own = [hashes[a:b] for a, b in zip(words.first, words.first[1:], strict=False)]
    ends = [re.sub(r"[.!?\s]+$", "", re.sub("[!?]", ".", t)).rfind(".") for _, t in rows]
    tails = find_words(pa.array([t[e + 1 :] for (_, t), e in zip(rows, ends, strict=True)], pa.string()), ALNUM, lower=True)
    answers = [tails.hashes[a:b] for a, b in zip(tails.first, tails.first[1:], strict=False)]
    sizes = np.array([len(w) for w in own], np.int64)
    keep = sizes[owner] >= MIN_WORDS
    need = np.maximum(3, -(-sizes // SHARED))
    rare, held = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for k in np.flatnonzero(sizes >= MIN_WORDS):
        # a text that passes lacks at most size - least words, so of so many more than that it has need
        some = int(sizes[k]) - math.ceil(int(sizes[k]) * PARAPHRASED) + int(need[k])
        weight = space.idf[terms[words.first[k] : words.first[k + 1]]]
        rare.append(np.unique(own[k][np.argsort(-weight, kind="stable")[:some]]))
        held.append(np.full(len(rare[-1]), k))
    rare, held = np.concatenate(rare), np.concatenate(held)
    of_item, times = np.unique((np.repeat(np.arange(len(rows)), sizes) << MARK_BITS) + marks_of(hashes), return_counts=True)
    marked = np.searchsorted(of_item, np.arange(len(rows) + 1) << MARK_BITS)
    order = np.argsort(rare, kind="stable")
    rare, first = np.unique(rare[order], return_index=True)
    begun = np.zeros(1 << BEGIN_BITS, bool)
    begun[(rare >> np.uint64(64 - BEGIN_BITS)).astype(np.int64)] = True
    return Items([i for i, _ in rows], [places_of(w) for w in own], sizes.tolist(), answers, space.place(terms, begin[keep], end[keep]),
                 owner[keep], rare, begun, np.append(first, len(order)), held[order], need, marked, of_item & ((1 << MARK_BITS) - 1), times)


def meetings(items: Items, hashes: np.ndarray, begin: np.ndarray, end: np.ndarray, last: np.ndarray, stop: np.ndarray) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """Passages and items of which enough rarer words are as near as the item can reach; texts by text.

    last and stop are the ends of each text in passages and in words.
    """
    at = np.flatnonzero(items.begun[(hashes >> np.uint64(64 - BEGIN_BITS)).astype(np.int64)])
    found = np.minimum(np.searchsorted(items.rare, hashes[at]), len(items.rare) - 1)
    is_rare = items.rare[found] == hashes[at]
    at, found = at[is_rare], found[is_rare]
    text = np.searchsorted(stop, at, "right")
    size, many = np.array(items.sizes), len(items.sizes)
    count = items.first[found + 1] - items.first[found]
    done = np.concatenate([[0], np.cumsum(count)])
    ends = np.flatnonzero(np.diff(text, append=-1)) + 1  # of each text that has any
    low = 0
    while low < len(at):
        high = max(ends[np.searchsorted(ends, low, "right")], ends[max(0, np.searchsorted(done[ends], done[low] + MEETINGS_AT_ONCE, "right") - 1)])
        n = count[low:high]
        place, own = np.repeat(at[low:high], n), np.repeat(text[low:high], n)
        item = items.held[np.repeat(items.first[found[low:high]], n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)]
        low = high
        # sorted as one number with the place in a row, which is faster than an order of numbers
        bits = len(item).bit_length()
        order = np.sort((((own - own[0]) * many + item) << bits) + np.arange(len(item))) & ((1 << bits) - 1)
        place, own, item = place[order], own[order], item[order]
        k = np.arange(len(order))
        to = np.minimum(k + items.need[item] - 1, len(order) - 1)
        good = (k + items.need[item] <= len(order)) & (own[to] == own) & (item[to] == item) & (place[to] - place < PASSAGE + 2 * size[item])
        place, to, own, item = place[good], place[to[good]], own[good], item[good]
        # passages from which the item reaches the first and the last of these words
        since = np.maximum(np.searchsorted(end, to - size[item], "right"), np.where(own > 0, last[own - 1], 0))
        till = np.minimum(np.searchsorted(begin, place + size[item], "right"), last[own])
        new = np.ones(len(item), bool)
        new[1:] = (since[1:] != since[:-1]) | (till[1:] != till[:-1]) | (item[1:] != item[:-1])
        since, till, item = since[new], till[new], item[new]
        n = np.maximum(till - since, 0)
        passage = np.repeat(since, n) + np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        both = np.unique(passage * many + np.repeat(item, n))
        if len(both):
            yield both // many, both % many


def marks_of(hashes: np.ndarray) -> np.ndarray:
    return (hashes >> np.uint64(64 - MARK_BITS)).astype(np.int64)


def _ranges(start: np.ndarray, size: np.ndarray) -> np.ndarray:
    """The numbers of all ranges, one behind the other."""
    return np.arange(size.sum()) + np.repeat(start - (np.cumsum(size) - size), size)


def likely(items: Items, marks: np.ndarray, begin: np.ndarray, end: np.ndarray, text: np.ndarray, stop: np.ndarray, met: np.ndarray, of: np.ndarray) -> np.ndarray:
    """Which of the passages and items that meet may pass: enough words around are the item's, in whatever order.

    Words of one mark count as equal: what words have in common, their marks have as well.
    """
    size, own = np.array(items.sizes)[of], text[met]
    start = np.maximum(begin[met] - size, np.where(own > 0, stop[own - 1], 0))
    length = np.minimum(end[met] + size, stop[own]) - start
    least = np.ceil(size * PARAPHRASED)
    good = np.zeros(len(met), bool)
    order = np.argsort(of, kind="stable")
    done = np.cumsum(length[order])
    a = 0
    while a < len(order):
        b = max(a + 1, int(np.searchsorted(done, (done[a - 1] if a else 0) + MARKED_AT_ONCE, "right")))
        some = order[a:b]
        a = b
        # each item's marks are numbered from 1 on; other marks have 0
        item, place = np.unique(of[some], return_inverse=True)
        many = items.marked[item + 1] - items.marked[item]
        number = np.zeros((len(item), 1 << MARK_BITS), np.int16)
        number[np.repeat(np.arange(len(item)), many), items.marks[_ranges(items.marked[item], many)]] = _ranges(np.ones(len(item), np.int64), many)
        n = length[some]
        found = number.reshape(-1)[np.repeat(place << MARK_BITS, n) + marks[_ranges(start[some], n)]]
        # how often the words around have them, next to how often the item has them
        many = many[place]
        base = np.cumsum(many) - many
        found = (np.repeat(base - 1, n) + found)[found > 0]
        both = np.minimum(np.bincount(found, minlength=many.sum()), items.times[_ranges(items.marked[of[some]], many)])
        good[some] = np.add.reduceat(both, base) >= least[some]
    return good


def candidates(space: Space, items: Items, terms: np.ndarray, begin: np.ndarray, end: np.ndarray, met: np.ndarray, of: np.ndarray, cosine: float) -> tuple[np.ndarray, np.ndarray]:
    """The passages and items, of those that meet (in order of passages), whose cosine reaches the bar."""
    starts = np.searchsorted(items.owner, of)
    count = np.searchsorted(items.owner, of, "right") - starts
    pick, row = np.unique(met, return_inverse=True)
    good = np.zeros(len(met), bool)
    for a in range(0, len(pick), PASSAGES_AT_ONCE):
        some = pick[a : a + PASSAGES_AT_ONCE]
        near = space.place(terms, begin[some], end[some]) @ items.places.T
        pairs = np.arange(*np.searchsorted(row, [a, a + len(some)]))
        for k in range(int(count[pairs].max())):  # an item's first passage, its second and so on
            pairs = pairs[count[pairs] > k]
            good[pairs] |= near[row[pairs] - a, starts[pairs] + k] >= cosine
    return met[good], of[good]


def spans(passage: np.ndarray, item: np.ndarray, text: np.ndarray) -> Iterator[tuple[int, int, list[int]]]:
    """Text, item and passages of candidates that lie within SPAN passages of a text, in order."""
    own = text[passage]
    order = np.lexsort((passage, item, own))
    passage, item, own = passage[order], item[order], own[order]
    new = np.ones(len(order) + 1, bool)
    new[1:-1] = (np.diff(own) != 0) | (np.diff(item) != 0) | (np.diff(passage // SPAN) != 0)
    edges = np.flatnonzero(new).tolist()
    for a, b in zip(edges, edges[1:], strict=False):
        yield int(own[a]), int(item[a]), passage[a:b].tolist()


def matches(docs: DataFrame, benchmark: DataFrame, space: Space | None = None, cosine: float = COSINE) -> DataFrame:
    """doc_id, item_id and the best score of each pair that passes the checks; score is the common share."""
    return matches_by_text(docs, benchmark, space, cosine).groupBy("doc_id", "item_id").agg(F.max("score").alias("score"))


def matches_by_text(docs: DataFrame, benchmark: DataFrame, space: Space | None = None, cosine: float = COSINE) -> DataFrame:
    """The same for each doc_id and th, a hash of the text; a doc_id may be null or have several texts."""
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))
    space = space or latent_space(docs)
    fields = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("item_id", pa.int64()), ("score", pa.float64())])
    found = None
    spark = docs.sparkSession
    rows = benchmark.select(F.col("item_id").cast("long").alias("item_id"), "text").where("text is not null").distinct()
    blocks = max(1, -(-rows.count() // ITEMS))
    for block in range(blocks):
        held = rows.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block).collect()  # about ITEMS rows
        shared = spark.sparkContext.broadcast((space, _items(held, space)))

        def run(batch: pa.RecordBatch, shared=shared) -> pa.RecordBatch | None:
            space, items = shared.value
            if not len(items.owner):
                return None
            terms, begin, end, text, hashes = passages(batch.column("text"))
            last = np.searchsorted(text, np.arange(batch.num_rows), "right")
            stop = np.where(last > 0, np.append(end, 0)[last - 1], 0)
            best: dict[tuple[int, int], float] = {}
            marks = marks_of(hashes)
            ids, th = batch.column("doc_id").to_pylist(), batch.column("th").to_pylist()
            for met, of in meetings(items, hashes, begin, end, last, stop):
                good = likely(items, marks, begin, end, text, stop, met, of)
                met, of = met[good], of[good]
                if not len(met):
                    continue
                for k, item, near in spans(*candidates(space, items, terms, begin, end, met, of, cosine), text):
                    size = items.sizes[item]
                    least = math.ceil(size * PARAPHRASED)
                    # as far around the passages as the item can reach
                    low, high = (stop[k - 1] if k else 0), stop[k]
                    if len(near) > 1:
                        whole = hashes[max(begin[near[0]] - size, low) : min(end[near[-1]] + size, high)].tolist()
                        # what a part has in common with the item, the whole has as well
                        if common_places(whole, items.words[item], size, least) < least:
                            continue
                    for p in near:
                        if best.get((k, item), 0) >= COPIED:
                            break
                        reach = slice(max(begin[p] - size, low), min(end[p] + size, high))
                        share = common_places(hashes[reach].tolist(), items.words[item], size, least) / size
                        if share < PARAPHRASED:
                            continue
                        answer = items.answers[item]
                        said = len(answer) >= 3 and common_words(hashes[reach], answer) == len(answer)
                        enough = PARAPHRASED if said else COPIED
                        if share >= enough:
                            best[k, item] = max(best.get((k, item), 0), share)
            columns = [[ids[k] for k, _ in best], [th[k] for k, _ in best], [items.ids[i] for _, i in best], list(best.values())]
            return pa.record_batch([pa.array(c, f.type) for c, f in zip(columns, fields, strict=True)], schema=fields)

        part = map_slices(docs, run, "doc_id long, th long, item_id long, score double", most=SIZE)
        found = part if found is None else found.unionByName(part)
    return found.groupBy("doc_id", "th", "item_id").agg(F.max("score").alias("score"))


def op6_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents that hold benchmark passages: each pair of document and item with the common share."""
    return matches(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark")).where("doc_id is not null")
