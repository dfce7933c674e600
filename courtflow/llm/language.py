"""Language identification by family first, then one-versus-one machines within the family.

Features are relative frequencies of hashed runs of one to three bytes over a whole text, A-Z in
lower case. Families, and the languages of one family, are told apart by linear support vector
machines, one for each pair; the class with most votes wins, ties by the sum of margins. A score is
the product of the winner's chances in its closest contest on either level.

The machines are fitted on about PER_LANGUAGE rows of each language, chosen by a hash of doc_id from
the rows to learn from, so the fit's size is bounded; all rows are predicted from their whole texts.
A text is scored by sums of weights, so no feature vector is built and nothing is shuffled.

A null text, or one without letters, is `und` with score 0. Without any row to learn from all texts
are `und`. A null doc_id counts as the empty id. Repeated rows get repeated results; an empty table
gives no rows. Only doc_id, text and, to learn, lang are read.
"""

from __future__ import annotations

import re
from dataclasses import dataclass
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from courtflow.llm.common import map_slices, table
from courtflow.llm.words import LOWER, raw

BUCKET_BITS = 12
PER_LANGUAGE = 800
UNKNOWN = "und"
#: What stands in each row for a machine's bias.
BIAS = 0.1
#: Rows squared at once.
ROWS = 256
#: Bytes of text at once; sums over its bytes take some 30 times as much.
SIZE = 1 << 18
#: ISO 639-1 codes by family. Other codes are families of their own.
FAMILIES = {
    "germanic": "en de nl sv da no nb nn is af fy lb yi fo",
    "romance": "fr es pt it ro ca gl oc rm la",
    "slavic": "ru uk be pl cs sk bg sr hr bs sl mk",
    "baltic": "lt lv",
    "celtic": "ga gd cy br",
    "uralic": "fi et hu",
    "turkic": "tr az kk ky uz tk tt",
    "indic": "hi ur bn pa gu mr ne si as or",
    "iranian": "fa ps ku tg",
    "semitic": "ar he am mt",
    "malayic": "id ms jv su tl",
}
FAMILY_OF = {code: family for family, codes in FAMILIES.items() for code in codes.split()}
_LETTER = re.compile(r"[^\W\d_]")


def family_of(language: str) -> str:
    return FAMILY_OF.get(language.lower().replace("_", "-").split("-")[0], language)


def buckets(data: np.ndarray) -> tuple[np.ndarray, ...]:
    """Hashed buckets of the runs of one, two and three bytes that start at each byte."""
    b = data.astype(np.uint32)
    shift = np.uint32(32 - BUCKET_BITS)
    out = []
    for n in (1, 2, 3):
        if len(b) < n:
            out.append(np.zeros(0, np.int32))
            continue
        code = b[: len(b) - n + 1].copy()
        for k in range(1, n):
            code = code << np.uint32(8) | b[k : len(b) - n + 1 + k]
        code = (code + np.uint32(n << 26)) * np.uint32(0x9E3779B1)
        code ^= code >> np.uint32(15)
        out.append(((code * np.uint32(0x85EBCA77)) >> shift).astype(np.int32))
    return tuple(out)


def frequencies(texts: pa.Array) -> np.ndarray:
    """Relative frequencies of the buckets of each text, each of the three lengths summing to one."""
    data, offsets = raw(texts)
    grams = buckets(LOWER[data])
    out = np.zeros((len(texts), 1 << BUCKET_BITS), np.float32)
    for k, (a, b) in enumerate(zip(offsets, offsets[1:], strict=False)):
        for n, g in enumerate(grams, 1):
            if b - a >= n:
                out[k] += np.bincount(g[a : b - n + 1], minlength=1 << BUCKET_BITS).astype(np.float32) / (b - a - n + 1)
    return out


def margins(texts: pa.Array, weights: np.ndarray) -> np.ndarray:
    """frequencies(texts) @ weights.T, by sums over the bytes."""
    data, offsets = raw(texts)
    grams = buckets(LOWER[data])
    out = np.zeros((len(texts), len(weights)))
    sums = np.zeros(len(data) + 1)
    for n, g in enumerate(grams, 1):
        ends = np.maximum(offsets[1:] - n + 1, offsets[:-1])
        size = np.maximum(ends - offsets[:-1], 1)
        for m, w in enumerate(weights):
            np.cumsum(w[g], dtype=np.float64, out=sums[1 : len(g) + 1])
            out[:, m] += (sums[np.minimum(ends, len(g))] - sums[np.minimum(offsets[:-1], len(g))]) / size
    return out


def machine(x: np.ndarray, y: np.ndarray, rounds: int = 200, penalty: float = 1e-3) -> tuple[np.ndarray, float]:
    """A linear support vector machine (squared hinge, balanced classes) and its bias; y is 1 or -1.

    x's last column is BIAS. Nesterov's accelerated gradient steps on all rows.
    """
    share = np.where(y > 0, 0.5 / max(1, (y > 0).sum()), 0.5 / max(1, (y < 0).sum()))
    share, y = share.astype(np.float32), y.astype(np.float32)
    squares = np.concatenate([(x[a : a + ROWS] ** 2).sum(1) for a in range(0, len(x), ROWS)])
    step = np.float32(1 / (2 * float((share * squares).sum()) + penalty))
    w = v = np.zeros(x.shape[1], np.float32)
    for k in range(rounds):
        slack = np.maximum(np.float32(0), 1 - y * (x @ v))
        new = v - step * (np.float32(penalty) * v - 2 * ((share * y * slack) @ x))
        v = new + np.float32(k / (k + 3)) * (new - w)
        w = new
    return w[:-1], float(w[-1] * BIAS)


@dataclass
class Model:
    """Contests of one level: pairs of class numbers, the first of which a positive margin favours."""

    families: list[str]
    languages: list[list[str]]  # of each family
    contests: list[tuple[int, int, int]]  # level (-1: families, else the family), class, class
    weights: np.ndarray
    bias: np.ndarray
    slope: np.ndarray  # of each contest's chances over its margin

    def predict(self, texts: pa.Array) -> tuple[list[str], np.ndarray]:
        n = len(texts)
        values = margins(texts, self.weights) + self.bias if len(self.weights) else np.zeros((n, 0))
        family, sure = self._winner(-1, len(self.families), values)
        label, score = np.array([UNKNOWN] * n, object), np.zeros(n)
        for f, own in enumerate(self.languages):
            rows = np.flatnonzero(family == f)
            best, chance = self._winner(f, len(own), values[rows])
            label[rows] = np.array(own, object)[best]
            score[rows] = sure[rows] * chance
        for k, text in enumerate(texts.to_pylist()):
            if not text or not _LETTER.search(text):
                label[k], score[k] = UNKNOWN, 0.0
        return label.tolist(), score

    def _winner(self, level: int, classes: int, values: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        votes, total = np.zeros((len(values), classes)), np.zeros((len(values), classes))
        mine = [(k, a, b) for k, (at, a, b) in enumerate(self.contests) if at == level]
        for k, a, b in mine:
            won = values[:, k] > 0
            votes[:, a] += won
            votes[:, b] += ~won
            total[:, a] += values[:, k]
            total[:, b] -= values[:, k]
        best = np.lexsort((total, votes), axis=1)[:, -1] if classes > 1 else np.zeros(len(values), int)
        chance = np.ones(len(values))
        for k, a, b in mine:
            sign = np.where(best == a, 1, np.where(best == b, -1, 0))
            p = 1 / (1 + np.exp(-np.clip(sign * values[:, k] * self.slope[k], -50, 50)))
            chance = np.where(sign == 0, chance, np.minimum(chance, p))
        return best, chance


def _contest(x: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, float, float]:
    w, bias = machine(x, y)
    margin = y * (x[:, :-1] @ w + bias)
    slopes = np.array([0.5, 1, 2, 3, 4, 6, 8])
    loss = [np.log1p(np.exp(-np.clip(s * margin, -50, 50))).mean() for s in slopes]
    return w, bias, float(slopes[int(np.argmin(loss))])


def fitted(x: np.ndarray, languages: list[str]) -> Model:
    """All contests, each on the rows of its two classes; x's last column is BIAS."""

    def only(rows: np.ndarray) -> np.ndarray:
        return x if rows.all() else x[rows]

    families = sorted({family_of(v) for v in languages})
    own = [sorted({v for v in languages if family_of(v) == f}) for f in families]
    y = np.array(languages, object)
    family = np.array([family_of(v) for v in languages], object)
    contests, parts = [], []
    for a, b in combinations(range(len(families)), 2):
        rows = (family == families[a]) | (family == families[b])
        contests.append((-1, a, b))
        parts.append(_contest(only(rows), np.where(family[rows] == families[a], 1, -1)))
    for f, names in enumerate(own):
        for a, b in combinations(range(len(names)), 2):
            rows = (y == names[a]) | (y == names[b])
            contests.append((f, a, b))
            parts.append(_contest(only(rows), np.where(y[rows] == names[a], 1, -1)))
    weights = np.array([w for w, _, _ in parts], np.float32).reshape(len(parts), 1 << BUCKET_BITS)
    return Model(families, own, contests, weights, np.array([b for _, b, _ in parts]), np.array([s for _, _, s in parts]))


def _crc() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary"))


def learned(docs: DataFrame, teach: Column) -> Model:
    """A model from the rows for which teach holds and lang is known."""
    docs = docs.select("doc_id", "text", "lang").where(teach & F.col("lang").isNotNull() & (F.col("lang") != "") & F.col("text").isNotNull())
    counts = {r["lang"]: r["n"] for r in docs.groupBy("lang").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row a language
    if not counts:
        return Model([], [], [], np.zeros((0, 1 << BUCKET_BITS), np.float32), np.zeros(0), np.zeros(0))
    share = F.create_map(*(F.lit(v) for k, n in sorted(counts.items()) for v in (k, min(1.0, PER_LANGUAGE / n))))
    spot = F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(1 << 20)) / float(1 << 20)
    fields = pa.schema([("lang", pa.string()), ("spots", pa.binary()), ("values", pa.binary())])

    def features(batch: pa.RecordBatch) -> pa.RecordBatch:
        x = frequencies(batch.column("text"))
        filled = [np.flatnonzero(r).astype(np.uint16) for r in x]
        return pa.record_batch([batch.column("lang"), pa.array([f.tobytes() for f in filled]),
                                pa.array([r[f].tobytes() for r, f in zip(x, filled, strict=True)])], schema=fields)

    chosen = map_slices(docs.where(spot < F.element_at(share, F.col("lang"))), features, "lang string, spots binary, values binary", most=1 << 18)
    sample = chosen.toArrow()  # about PER_LANGUAGE rows a language
    if not sample.num_rows:
        return Model([], [], [], np.zeros((0, 1 << BUCKET_BITS), np.float32), np.zeros(0), np.zeros(0))
    return fitted(*_features(sample))


def _features(sample: pa.Table) -> tuple[np.ndarray, list[str]]:
    """Dense rows with BIAS behind them, and their languages; written once, in the order of the fit."""
    languages = sample["lang"].to_pylist()
    spots = [np.frombuffer(v, np.uint16) for v in sample["spots"].to_pylist()]
    values = [np.frombuffer(v, np.float32) for v in sample["values"].to_pylist()]
    # the fit does not hang on the order of rows
    lead = np.zeros((2, len(spots)), np.float32)
    for k in range(len(spots)):
        few = spots[k][:2][spots[k][:2] < 2]
        lead[few, k] = values[k][: len(few)]
    order = np.lexsort((lead[1], lead[0])).tolist()
    x = np.zeros((len(order), (1 << BUCKET_BITS) + 1), np.float32)
    x[:, -1] = BIAS
    for row, k in zip(x, order, strict=True):
        row[spots[k]] = values[k]
    return x, [languages[k] for k in order]


def held_out() -> Column:
    return _crc() % 5 == 0


def predicted(docs: DataFrame, model: Model) -> DataFrame:
    """doc_id, lang_pred and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(model)
    fields = pa.schema([("doc_id", pa.int64()), ("lang_pred", pa.string()), ("score", pa.float64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        label, score = shared.value.predict(batch.column("text"))
        return pa.record_batch([batch.column("doc_id"), pa.array(label, pa.string()), pa.array(score)], schema=fields)

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, lang_pred string, score double")


def with_language(docs: DataFrame, model: Model, name: str = "lang_pred") -> DataFrame:
    """All columns and the predicted language under a name that must be free."""
    shared = docs.sparkSession.sparkContext.broadcast(model)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        label, _ = shared.value.predict(batch.column("text"))
        return batch.append_column(name, pa.array(label, pa.string()))

    return map_slices(docs, run, T.StructType([*docs.schema.fields, T.StructField(name, T.StringType())]), most=SIZE)


def op5_language_identification(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    found = predicted(docs, learned(docs, ~held_out()))
    return found.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")
