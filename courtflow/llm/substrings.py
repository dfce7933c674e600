"""Removal of passages that earlier documents hold, by relative Lempel-Ziv factors.

Every document is factored against the blocks of all documents with a smaller id. A factor is a
longest run of words whose windows of `window` words all start in the same earliest document; the
runs of one document, greedily from its first word, are its factors. A factor ends, and is checked,
where the next window has another earliest holder or none: windows are compared by 128-bit hashes on
both sides of the boundary, so a factor neither misses nor adds a word.

Windows are not indexed one by one. Each window has an anchor, the smallest hash of its runs of half
a window; equal windows have equal anchors. Anchors that only one document has, which are nearly
all, drop out with a shuffle of a few hashes per hundred words. Only documents that share an anchor
are read again, and only their windows at shared anchors are indexed: their smallest document is an
aggregate that combines on the map side. Documents with the same words are one class, whose later
members are removed without a look at their windows.

Words are runs of other characters than white space; a null text has none. Fewer words than a
window are never removed. Rows with equal doc_id and text each get the same result; a null doc_id
takes part in nothing and keeps its words. An empty table gives no rows. Only doc_id and text are
read.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import Scratch, map_slices, table, with_keys
from courtflow.llm.words import NOT_SPACE, Words, find_words, mix, rolling, starts_of_runs

WINDOW = 50
_SECOND = np.uint64(0xA0761D6478BD642F)


def _anchors(hashes: np.ndarray, window: int) -> np.ndarray:
    """The anchor of the window at each word, regardless of texts."""
    part = window // 2
    runs = mix(rolling(hashes, part) ^ _SECOND)
    wide, low = 1, runs
    most = window - part + 1  # runs in a window
    while wide * 2 <= most:
        low = np.minimum(low[:-wide], low[wide:]) if len(low) > wide else low[:0]
        wide *= 2
    rest = most - wide
    return np.minimum(low[: len(low) - rest], low[rest:]) if len(low) > rest else low[:0]


def _windows(words: Words, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """First word, text and anchor of every window within a text."""
    at, text = starts_of_runs(words.first, window)
    return at, text, _anchors(words.hashes, window)[at] if len(at) else np.zeros(0, np.uint64)


def _kept(words: Words, text: int, gone: np.ndarray | None) -> str:
    """Digest of the words of a text that stay, joined by single spaces."""
    a, b = words.first[text], words.first[text + 1]
    base = words.begin[a] if b > a else 0
    data = words.data[base : words.end[b - 1] if b > a else 0].tobytes()
    split = data.split()
    if gone is not None:
        split = [w for w, g in zip(split, gone.tolist(), strict=True) if not g]
    return hashlib.sha256(b" ".join(split)).hexdigest()


def _summaries(docs: DataFrame, window: int) -> DataFrame:
    fields = pa.schema([
        ("doc_id", pa.int64()), ("th", pa.int64()), ("n_words", pa.int64()), ("h1", pa.int64()), ("h2", pa.int64()),
        ("kept_sha256", pa.string()), ("anchors", pa.list_(pa.int64())),
    ])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"), NOT_SPACE)
        n = np.diff(words.first)
        _, text, anchor = _windows(words, window)
        order = np.lexsort((anchor, text))
        text, anchor = text[order], anchor[order]
        if len(text):
            new = np.concatenate([[True], (anchor[1:] != anchor[:-1]) | (text[1:] != text[:-1])])
            text, anchor = text[new], anchor[new]
        ends = np.searchsorted(text, np.arange(len(n) + 1))
        digests = [
            hashlib.md5(words.hashes[a:b].tobytes()).digest() for a, b in zip(words.first, words.first[1:], strict=False)
        ]
        digest = np.frombuffer(b"".join(digests), np.int64).reshape(-1, 2)
        return pa.record_batch([
            batch.column("doc_id"), batch.column("th"), pa.array(n, pa.int64()), pa.array(digest[:, 0]), pa.array(digest[:, 1]),
            pa.array([_kept(words, k, None) for k in range(len(n))]),
            pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.array(anchor.view(np.int64))),
        ], schema=fields)

    return map_slices(_keyed(docs), run, (
        "doc_id long, th long, n_words long, h1 long, h2 long, kept_sha256 string, anchors array<long>"))


def _keyed(docs: DataFrame) -> DataFrame:
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("th"))


def factors(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """The long factors: doc_id, th, first_word, n_words, ref_doc_id, which is smaller than doc_id.

    Factors of neighbouring runs overlap by window - 1 words. Copies as a whole are one factor.
    """
    scratch = Scratch(docs.sparkSession)
    rows = scratch.stored(_summaries(docs, window), "anchors")
    return scratch.result(_factors(scratch, docs, rows, window)[0], "factors")


def _factors(scratch: Scratch, docs: DataFrame, rows: DataFrame, window: int) -> tuple[DataFrame, DataFrame, DataFrame]:
    long_ = rows.where(f"doc_id is not null and n_words >= {window}")
    classes = long_.groupBy("n_words", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    placed = long_.drop("anchors").join(classes, ["n_words", "h1", "h2"])
    copies = scratch.stored(placed.where("doc_id > rep").select("doc_id", "th", "n_words", "rep").distinct(), "copies")
    first = long_.join(copies.select("doc_id", "th"), ["doc_id", "th"], "left_anti")

    points = first.select("doc_id", F.explode("anchors").alias("anchor"))
    shared = points.groupBy("anchor").agg(F.min("doc_id").alias("low"), F.max("doc_id").alias("high")).where("low < high").select("anchor")
    per_doc = points.join(shared, "anchor", "left_semi").groupBy("doc_id").agg(F.collect_set("anchor").alias("anchors"))
    per_doc = scratch.stored(per_doc, "shared")
    # the few texts that share an anchor are cut out first, then given their anchors
    near = with_keys(_keyed(docs), per_doc.select("doc_id"), ["doc_id"], "left_semi")
    texts = scratch.stored(near.join(per_doc, "doc_id").dropDuplicates(["doc_id", "th"]), "sharing")

    fields = pa.schema([(c, pa.int64()) for c in ("doc_id", "th", "at", "w1", "w2")])

    def index(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"), NOT_SPACE)
        at, text, anchor = _windows(words, window)
        lists = batch.column("anchors")
        wanted = np.frombuffer(b"".join(np.array(x, np.int64).tobytes() for x in lists.to_pylist()), np.uint64)
        owner = np.repeat(np.arange(len(lists)), np.fromiter(map(len, lists), np.int64, len(lists)))
        # a pair (text, anchor) is looked up as one number
        salt = lambda t: mix(t.astype(np.uint64) + np.uint64(1))
        keep = np.isin(mix(anchor ^ salt(text)), mix(wanted ^ salt(owner)))
        at, text = at[keep], text[keep]
        w1 = rolling(words.hashes, window)[at] if len(at) else np.zeros(0, np.uint64)
        w2 = rolling(mix(words.hashes ^ _SECOND), window)[at] if len(at) else np.zeros(0, np.uint64)
        take = lambda c: batch.column(c).take(pa.array(text))
        return pa.record_batch([
            take("doc_id"), take("th"), pa.array(at - words.first[text], pa.int64()), pa.array(w1.view(np.int64)), pa.array(w2.view(np.int64)),
        ], schema=fields)

    # made twice from the few texts rather than stored: there are more windows than words of text
    windows = map_slices(texts, index, "doc_id long, th long, at long, w1 long, w2 long")
    # stored, so that the join's sides come by shuffles alone and Spark can split a passage that many documents hold
    holders = scratch.stored(
        windows.groupBy("w1", "w2").agg(F.min("doc_id").alias("ref"), F.max("doc_id").alias("last")).where("ref < last").drop("last"),
        "holders")
    found = windows.join(holders, ["w1", "w2"]).where("ref < doc_id").groupBy("doc_id", "th").agg(
        F.array_sort(F.collect_list(F.struct("at", "ref"))).alias("hits"))
    found = scratch.stored(found, "hits")
    scratch.drop(holders)

    def runs(batch: pa.RecordBatch) -> pa.RecordBatch:
        columns: list[list] = [[], [], [], [], []]
        for doc_id, th, hits in zip(*(batch.column(c).to_pylist() for c in ("doc_id", "th", "hits")), strict=True):
            at = np.array([h["at"] for h in hits])
            ref = np.array([h["ref"] for h in hits])
            cut = np.flatnonzero((np.diff(at) != 1) | (np.diff(ref) != 0)) + 1
            for a, b in zip([0, *cut.tolist()], [*cut.tolist(), len(at)], strict=True):
                for c, v in zip(columns, (doc_id, th, int(at[a]), b - a + window - 1, int(ref[a])), strict=True):
                    c.append(v)
        return pa.record_batch([pa.array(c, pa.int64()) for c in columns],
                               names=["doc_id", "th", "first_word", "n_words", "ref_doc_id"])

    parts = map_slices(found, runs, "doc_id long, th long, first_word long, n_words long, ref_doc_id long", column="hits")
    whole = copies.select("doc_id", "th", F.lit(0).cast("long").alias("first_word"), "n_words", F.col("rep").alias("ref_doc_id"))
    scratch.drop(per_doc)
    return parts.unionByName(whole), scratch.stored(parts, "factors"), texts.select("doc_id", "th", "text")


def deduplicated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, n_words, n_removed and kept_sha256 of each row."""
    scratch = Scratch(docs.sparkSession)
    rows = scratch.stored(_summaries(docs, window), "anchors")
    _, parts, texts = _factors(scratch, docs, rows, window)
    spans = parts.groupBy("doc_id", "th").agg(F.collect_list(F.struct("first_word", "n_words")).alias("spans"))
    fields = pa.schema([("doc_id", pa.int64()), ("th", pa.int64()), ("removed", pa.int64()), ("sha", pa.string())])

    def cut(batch: pa.RecordBatch) -> pa.RecordBatch:
        words = find_words(batch.column("text"), NOT_SPACE, hashed=False)
        removed, shas = [], []
        for k, spans_ in enumerate(batch.column("spans").to_pylist()):
            gone = np.zeros(words.first[k + 1] - words.first[k], bool)
            for s in spans_:
                gone[s["first_word"] : s["first_word"] + s["n_words"]] = True
            removed.append(int(gone.sum()))
            shas.append(_kept(words, k, gone))
        return pa.record_batch([batch.column("doc_id"), batch.column("th"), pa.array(removed, pa.int64()), pa.array(shas)], schema=fields)

    changed = map_slices(texts.join(spans, ["doc_id", "th"]), cut, "doc_id long, th long, removed long, sha string")
    copies = (
        rows.where(f"doc_id is not null and n_words >= {window}").groupBy("n_words", "h1", "h2").agg(F.min("doc_id").alias("rep"))
    )
    nothing = hashlib.sha256(b"").hexdigest()
    out = rows.drop("anchors").join(changed, ["doc_id", "th"], "left").join(copies, ["n_words", "h1", "h2"], "left")
    copy = F.coalesce(F.col("rep") < F.col("doc_id"), F.lit(False))
    return scratch.result(out.select(
        "doc_id", "n_words",
        F.when(copy, F.col("n_words")).otherwise(F.coalesce("removed", F.lit(0))).cast("long").alias("n_removed"),
        F.when(copy, nothing).otherwise(F.coalesce("sha", "kept_sha256")).alias("kept_sha256"),
    ), "kept")


def op10_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return deduplicated(table(spark, sf_dir, "documents"))


OP10_SQL = r"""
WITH w AS MATERIALIZED (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
k AS MATERIALIZED (
  SELECT doc_id, i, sha256(array_to_string(w[i:i + 49], ' ')) AS h FROM (
    SELECT doc_id, w, unnest(range(1, len(w) - 48)) AS i FROM w WHERE len(w) >= 50)),
m AS (SELECT h, min(doc_id) AS first FROM k GROUP BY h),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 50)) AS i FROM k JOIN m USING (h) WHERE first < doc_id),
gone_list AS (SELECT doc_id, list(i) AS g, count(*) AS n FROM gone GROUP BY doc_id)
SELECT w.doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(coalesce(n, 0) AS BIGINT) AS n_removed,
  sha256(array_to_string(CASE WHEN n IS NULL THEN w ELSE
    list_transform(list_filter(range(1, len(w) + 1), lambda i: NOT list_contains(g, i)), lambda i: w[i]) END, ' ')) AS kept_sha256
FROM w LEFT JOIN gone_list USING (doc_id)
"""
