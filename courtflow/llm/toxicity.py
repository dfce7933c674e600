"""Toxicity by weak supervision.

Many voters look at a text: the words of a given list, words and word beginnings that training
labels speak for, and patterns of shape. Each votes `toxic` or stays silent. A generative label model takes the voters'
rates and their joint rates over all documents, a table of bounded size, and fits one number for each voter
so that products of two numbers meet the covariances; pairs far above what their covariances with
third voters say are correlated and left out of the fit, and their voters share their weight. From
these numbers follow each voter's rates among toxic and clean documents, and a posterior for any set of
votes. A linear classifier over the words and word beginnings that a text has is then trained on posterior labels, not
on given ones; its scores are mapped by the training labels so that 0.7 is a sensible cut.

Rows whose labels may be learned from are used for the choice of word voters, for the share of toxic
documents, and for the last mapping; at most about SAMPLE of them, chosen by a hash of doc_id. The
classifier is fitted on about SAMPLE documents, chosen likewise, plus those labelled. Votes and
scores cover all documents and whole texts.

A null or empty text has no votes and no words and gets the lowest ordinary score, that of the
classifier's bias. Repeated rows get repeated results; several labels of one doc_id count as their
largest; an empty table gives no rows. Without labels only the given words and the patterns vote. Only doc_id, text
and the labels' doc_id and toxic are read.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from courtflow.llm.common import Scratch, map_slices, table
from courtflow.llm.words import find_words, hash_ranges, slices

SAMPLE = 6_000
#: Bytes of letters once A-Z is lower case: words are runs of letters and of other than ASCII.
LETTERS = np.array([b >= 128 or 97 <= b <= 122 for b in range(256)])
#: Words that name or insult; each is a voter.
LEXICON = (
    "idiot idiots moron morons stupid dumb imbecile fool cretin dimwit pathetic worthless loser losers useless clown "
    "clowns disgusting scum trash garbage vermin filth filthy kill die hang shoot damn crap shit fuck fucking bitch "
    "bastard asshole"
)


#: Besides whole words, their first bytes are tokens: stems are told by how words begin.
STEMS = (3, 4, 5, 6, 7)


def tokens(texts: pa.Array, wanted: np.ndarray | None = None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct (text, token) of whole words and their beginnings, by text and token; and words of each text.

    Tokens are 32-bit hashes. wanted, sorted, keeps only these tokens.
    """
    words = find_words(texts, LETTERS, lower=True)
    text = words.text_of()
    if wanted is not None:
        table = np.zeros(1 << 16, bool)
        table[wanted >> np.uint32(16)] = True
    found = []
    for size in (None, *STEMS):
        end = words.end if size is None else words.begin + size
        rows = slice(None) if size is None else np.flatnonzero(words.end > end)
        hashes = words.hashes if size is None else hash_ranges(words.data, words.begin[rows], end[rows])
        # a beginning is not the same token as a word of these letters
        token = (hashes >> np.uint64(32)).astype(np.uint32) ^ np.uint32(0 if size is None else 0x5BD1E995)
        owner = text[rows]
        if wanted is not None:
            keep = np.flatnonzero(table[token >> np.uint32(16)])
            token, owner = token[keep], owner[keep]
            at = np.minimum(np.searchsorted(wanted, token), max(len(wanted) - 1, 0))
            keep = wanted[at] == token if len(wanted) else np.zeros(len(token), bool)
            token, owner = token[keep], owner[keep]
        found.append((owner.astype(np.uint64) << np.uint64(32)) | token)
    both = np.unique(np.concatenate(found))
    return (both >> np.uint64(32)).astype(np.int64), both.astype(np.uint32), np.diff(words.first)


def shape(texts: pa.Array, sizes: np.ndarray) -> np.ndarray:
    """Votes of shape of each text, whose numbers of words are given: shouting, exclaiming."""
    out = np.zeros((len(texts), 2), np.uint8)
    for k, t in enumerate(texts.to_pylist()):
        if t:
            out[k] = t.isupper(), t.count("!") * 20 > sizes[k]
    return out


def tokens_of(words: list[str]) -> np.ndarray:
    return (find_words(pa.array([" ".join(words)]), LETTERS, lower=True).hashes >> np.uint64(32)).astype(np.uint32)


@dataclass
class Voters:
    """A voter for each token, which are sorted, and two for shape."""

    names: list[str]
    keys: np.ndarray

    @classmethod
    def of(cls, named: dict[int, str]) -> Voters:
        keys = np.array(sorted(named), np.uint32)
        return cls([*(named[k] for k in keys.tolist()), "shouting", "exclaiming"], keys)

    def votes(self, texts: pa.Array) -> np.ndarray:
        """1 where a voter says toxic, 0 where it is silent; a row for each text."""
        text, token, sizes = tokens(texts, self.keys)
        out = np.zeros((len(texts), len(self.names)), np.uint8)
        out[text, np.searchsorted(self.keys, token)] = 1
        out[:, -2:] = shape(texts, sizes)
        return out


@dataclass
class LabelModel:
    """log odds of toxic: prior plus, for each voter, what its vote or its silence adds."""

    prior: float
    said: np.ndarray
    silent: np.ndarray
    correlated: list[tuple[int, int]] = field(default_factory=list)
    accuracy: np.ndarray = field(default_factory=lambda: np.zeros(0))

    def posterior(self, votes: np.ndarray) -> np.ndarray:
        odds = self.prior + votes @ self.said + (1 - votes.astype(float)) @ self.silent
        return 1 / (1 + np.exp(-np.clip(odds, -30, 30)))


def label_model(n: int, both: np.ndarray, toxic_share: float) -> LabelModel:
    """From the number of documents and the counts of votes of each two voters (a voter's own on the diagonal).

    Given the label, voters are independent but for the pairs found correlated. A vote's covariance
    with another's is then the product of one number of each; the numbers come from alternating
    least squares. Left out are pairs that shun each other beyond chance, as words of two languages
    do, and correlated ones: their covariance is far above what those with third voters say.
    """
    n = max(n, 1)
    m = len(both)
    p = min(max(toxic_share, 1e-4), 0.5)
    rate = np.diag(both) / n
    cov = both / n - np.outer(rate, rate)
    noise = np.sqrt(np.maximum(np.outer(rate, rate), 1 / n) / n)
    used = ~np.eye(m, dtype=bool) & (rate > 0)[:, None] & (rate > 0)[None] & (cov > -noise)
    pairs: list[tuple[int, int]] = []
    for i in range(m):
        for j in range(i + 1, m):
            if used[i, j]:
                # the covariance that others say the two should have, from each k and l
                k, l = np.flatnonzero(used[i]), np.flatnonzero(used[j])
                k, l = k[k != j], l[l != i]
                both_used = used[np.ix_(k, l)] & (cov[np.ix_(k, l)] > 3 * noise[np.ix_(k, l)])
                if both_used.sum() >= 3:
                    told = (np.outer(cov[i, k], cov[j, l])[both_used] / cov[np.ix_(k, l)][both_used])
                    if cov[i, j] > 1.5 * np.median(told) + 6 * noise[i, j]:
                        pairs.append((i, j))
    for i, j in pairs:
        used[i, j] = used[j, i] = False
    z = np.sqrt(np.maximum(rate * p, 1e-12))
    for _ in range(200):
        for i in range(m):
            down = (z[used[i]] ** 2).sum()
            z[i] = max(0.0, (cov[i, used[i]] * z[used[i]]).sum() / down) if down > 0 else 0.0
    gap = z / np.sqrt(p * (1 - p))
    # votes among toxic documents, of which all votes set a bound, and among clean ones
    hit = np.clip(np.minimum(rate + (1 - p) * gap, rate / p), 1e-4, 0.99)
    miss = np.clip((rate - p * hit) / (1 - p), 1e-4, 0.99)
    hit = np.maximum(hit, miss)
    share = 1.0 / (1 + np.array([sum(k in pair for pair in pairs) for k in range(m)]))
    return LabelModel(float(np.log(p / (1 - p))), share * np.log(hit / miss), share * np.log((1 - hit) / (1 - miss)), pairs, hit)


@dataclass
class Classifier:
    """A logistic curve over the sum of the weights of a text's distinct tokens; tokens are sorted."""

    keys: np.ndarray
    weights: np.ndarray
    bias: float
    slope: float = 1.0
    shift: float = 0.0

    def scores(self, texts: pa.Array) -> np.ndarray:
        text, token, _ = tokens(texts, self.keys)
        odds = self.bias + np.bincount(text, self.weights[np.searchsorted(self.keys, token)] if len(token) else None, len(texts))
        return 1 / (1 + np.exp(-np.clip(self.slope * odds + self.shift, -50, 50)))


def sparse_logistic(rows: np.ndarray, columns: np.ndarray, n: int, target: np.ndarray, penalty: float = 0.5,
                    rounds: int = 200) -> tuple[np.ndarray, np.ndarray, float]:
    """Logistic regression on soft labels with an absolute penalty: tokens, weights, bias.

    Only tokens of five rows or more whose mean target is off the overall one beyond chance are used.
    """
    share = min(max(target.mean(), 1e-3), 0.999) if n else 0.5
    bias = float(np.log(share / (1 - share)))
    names, columns, count = np.unique(columns, return_inverse=True, return_counts=True)
    mean = np.bincount(columns, target[rows], len(names)) / np.maximum(count, 1)
    good = (count >= 5) & (np.abs(mean - share) > 4 * np.sqrt(share * (1 - share) / np.maximum(count, 1)))
    new = np.cumsum(good) - 1
    keep = good[columns]
    rows, columns, names = rows[keep], new[columns[keep]], names[good]
    # a weight's step is bounded by the sizes of the rows that have it
    size = np.bincount(rows, minlength=n)
    bound = 0.25 * np.bincount(columns, size[rows].astype(float), len(names)) + 1e-9
    w = v = np.zeros(len(names))
    for k in range(rounds if len(names) else 0):
        odds = bias + np.bincount(rows, v[columns], n)
        p = 1 / (1 + np.exp(-np.clip(odds, -30, 30)))
        step = v - np.bincount(columns, (p - target)[rows], len(names)) / bound
        step = np.sign(step) * np.maximum(np.abs(step) - penalty / bound, 0)
        v = step + k / (k + 3) * (step - w)
        w = step
        bias -= float((p - target).sum() / max((p * (1 - p)).sum(), 0.05 * n, 1))
    return names[w != 0], w[w != 0], bias


def _spot(seed: int) -> Column:
    return F.pmod(F.xxhash64("doc_id", F.lit(seed)), F.lit(1 << 20)) / float(1 << 20)


def held_out() -> Column:
    return F.crc32(F.coalesce(F.col("doc_id").cast("string"), F.lit("")).cast("binary")) % 3 == 1


def _vote_counts(docs: DataFrame, voters: Voters) -> tuple[int, np.ndarray]:
    """Documents, and how many of them each two voters called toxic; over all documents."""
    m = len(voters.names)
    shared = docs.sparkSession.sparkContext.broadcast(voters)
    fields = pa.schema([("i", pa.int32()), ("j", pa.int32()), ("n", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        both, n = np.zeros((m, m), np.int64), 0
        for batch in batches:
            for piece in slices(batch):
                votes = shared.value.votes(piece.column("text")).astype(np.int64)
                both += votes.T @ votes
                n += len(votes)
        i, j = np.nonzero(both)
        yield pa.record_batch([pa.array([*i, -1], pa.int32()), pa.array([*j, -1], pa.int32()), pa.array([*both[i, j], n], pa.int64())], schema=fields)

    both, n = np.zeros((m, m), np.int64), 0
    sums = docs.select("text").mapInArrow(run, "i int, j int, n long").groupBy("i", "j").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # at most voters squared
        if r["i"] < 0:
            n = r["n"]
        else:
            both[r["i"], r["j"]] = r["n"]
    return n, both


def learned(docs: DataFrame, labels: DataFrame | None, teach: Column) -> tuple[Classifier, LabelModel, Voters]:
    """Classifier, label model and voters; labels are read only of rows for which teach holds."""
    spark = docs.sparkSession
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    total = docs.count()
    given = None
    if labels is not None:
        given = labels.select(F.col("doc_id").cast("long").alias("doc_id"), "toxic").where(teach & F.col("toxic").isNotNull())
        given = given.groupBy("doc_id").agg(F.max("toxic").cast("int").alias("toxic"))
        known = given.count()
        given = given.where(_spot(1) < min(1.0, SAMPLE / max(known, 1)))
        share = given.agg(F.avg("toxic")).first()[0]
    texts = docs.where(_spot(2) < min(1.0, SAMPLE / max(total, 1))).withColumn("toxic", F.lit(None).cast("int"))
    if given is not None:
        # labelled rows by the same hash on both sides, so that few texts move
        labelled = docs.where(_spot(1) < min(1.0, SAMPLE / max(known, 1))).join(given, "doc_id")
        texts = texts.join(given.select("doc_id"), "doc_id", "left_anti").unionByName(labelled)
    fields = pa.schema([("doc_id", pa.int64()), ("toxic", pa.int32()), ("tokens", pa.binary()), ("shape", pa.list_(pa.int8()))])

    def distinct(batch: pa.RecordBatch) -> pa.RecordBatch:
        text, token, sizes = tokens(batch.column("text"))
        first = np.searchsorted(text, np.arange(batch.num_rows + 1))
        return pa.record_batch([
            batch.column("doc_id"), batch.column("toxic"),
            pa.array([token[a:b].tobytes() for a, b in zip(first, first[1:], strict=False)], pa.binary()),
            pa.array(shape(batch.column("text"), sizes).tolist(), pa.list_(pa.int8())),
        ], schema=fields)

    scratch = Scratch(spark)
    rows = map_slices(texts, distinct, "doc_id long, toxic int, tokens binary, shape array<tinyint>")
    sample = scratch.stored(rows.select(F.monotonically_increasing_id().alias("row"), "*"), "sample")
    known_rows = sample.select("row", "doc_id", "toxic", "shape").toArrow()  # about 2 x SAMPLE rows, without tokens
    names = known_rows["row"].to_numpy()
    order = np.lexsort((names, np.array([-1 if i is None else i for i in known_rows["doc_id"].to_pylist()], np.int64)))
    place = {r: k for k, r in enumerate(names[order].tolist())}
    truth = np.array([-1 if t is None else int(t > 0) for t in known_rows["toxic"].to_pylist()], int)[order]

    named = dict(zip(tokens_of(LEXICON.split()).tolist(), LEXICON.split(), strict=True))
    toxic, clean = int((truth == 1).sum()), int((truth == 0).sum())
    if toxic >= 5 and clean >= 5:
        telling = _sums(sample.where("toxic is not null"), {r: float(truth[k]) for r, k in place.items()})
        bad, good = F.col("target"), F.col("n") - F.col("target")
        telling = telling.where((bad >= max(3, 0.01 * toxic)) & (bad / toxic > 20 * good / clean) & (bad >= 4 * good))
        owner, token = _places(sample.where("toxic is not null"), telling, place)
        named = {k: f"token-{k:08x}" for k in _telling(owner, token, truth)} | named
    voters = Voters.of(named)
    n, both = _vote_counts(docs, voters)
    if given is None or share is None:
        share = float(np.clip(both.diagonal()[:-2].max() / max(n, 1), 1e-3, 0.5)) if len(voters.keys) else 0.05
    model = label_model(n, both, float(share))
    votes = np.zeros((len(place), len(voters.names)), np.uint8)
    owner, token = _places(sample, spark.createDataFrame([(k,) for k in voters.keys.tolist()], "token long"), place)
    votes[owner, np.searchsorted(voters.keys, token)] = 1
    if len(place):
        votes[:, -2:] = np.array(known_rows["shape"].to_pylist(), np.uint8)[order]
    target = model.posterior(votes)
    # tokens whose mean target is off the overall one; the regression looks at these alone
    mean = float(target.mean()) if len(target) else 0.5
    usual = min(max(mean, 1e-3), 0.999)
    sums = _sums(sample, {r: float(target[k]) for r, k in place.items()})
    off = F.abs(F.col("target") / F.col("n") - usual) > 4 * F.sqrt(usual * (1 - usual) / F.col("n"))
    owner, token = _places(sample, sums.where((F.col("n") >= 5) & off), place)
    scratch.drop(sample)
    out = Classifier(*sparse_logistic(owner, token, len(place), target))
    if toxic >= 5 and clean >= 5:
        at = np.minimum(np.searchsorted(out.keys, token), max(len(out.keys) - 1, 0))
        hit = out.keys[at] == token if len(out.keys) else np.zeros(len(token), bool)
        odds = out.bias + np.bincount(owner[hit], out.weights[at[hit]], len(place))
        out.slope, out.shift = _mapped(odds[truth >= 0], truth[truth >= 0])
    return out, model, voters


def _sums(sample: DataFrame, targets: dict[int, float]) -> DataFrame:
    """token, n and target: rows of the sample with a token, and the sum of their targets."""
    shared = sample.sparkSession.sparkContext.broadcast(targets)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        sets = [np.frombuffer(w, np.uint32) for w in batch.column("tokens").to_pylist()]
        own = [shared.value[r] for r in batch.column("row").to_pylist()]
        token, at = np.unique(np.concatenate([*sets, np.zeros(0, np.uint32)]), return_inverse=True)
        target = np.bincount(at, np.repeat(own, [len(x) for x in sets]), len(token))
        return pa.record_batch([pa.array(token.astype(np.int64)), pa.array(np.bincount(at, minlength=len(token))), pa.array(target)],
                               names=["token", "n", "target"])

    rows = map_slices(sample.select("row", "tokens"), run, "token long, n long, target double", column="tokens")
    return rows.groupBy("token").agg(F.sum("n").alias("n"), F.sum("target").alias("target"))


def _places(sample: DataFrame, chosen: DataFrame, place: dict[int, int]) -> tuple[np.ndarray, np.ndarray]:
    """Row numbers and tokens where rows of the sample have chosen tokens, by row and token.

    Only these come to the driver.
    """
    wanted = np.array(sorted(r.token for r in chosen.select("token").collect()), np.uint32)
    shared = sample.sparkSession.sparkContext.broadcast(wanted)

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        kept = []
        for w in batch.column("tokens").to_pylist():
            own = np.frombuffer(w, np.uint32)
            kept.append(own[np.isin(own, shared.value)].tobytes())
        return pa.record_batch([batch.column("row"), pa.array(kept, pa.binary())], names=["row", "tokens"])

    found = map_slices(sample.select("row", "tokens"), run, "row long, tokens binary", column="tokens").toArrow()
    sets = [np.frombuffer(w, np.uint32) for w in found["tokens"].to_pylist()]
    rows = np.repeat(np.array([place[r] for r in found["row"].to_pylist()], np.int64), [len(x) for x in sets])
    token = np.concatenate([*sets, np.zeros(0, np.uint32)])
    order = np.lexsort((token, rows))
    return rows[order], token[order]


def _telling(rows: np.ndarray, token: np.ndarray, truth: np.ndarray, cover: int = 3) -> list[int]:
    """Tokens that speak for toxic labels: hardly any clean document has them.

    Greedily, the token that most toxic documents have that still lack voters, until each has so
    many or none is left that adds a hundredth. Tokens that nearly the same documents have count once.
    """
    toxic, clean = (truth == 1).sum(), (truth == 0).sum()
    if toxic < 5 or clean < 5:
        return []
    labelled = truth[rows] >= 0
    names, column = np.unique(token[labelled], return_inverse=True)
    owner = rows[labelled]
    bad = np.bincount(column, truth[owner] == 1, len(names))
    good = np.bincount(column, truth[owner] == 0, len(names))
    fit = np.flatnonzero((bad >= max(3, 0.01 * toxic)) & (bad / toxic > 20 * good / clean) & (bad >= 4 * good))
    index = np.full(len(names), -1)
    index[fit] = np.arange(len(fit))
    mine = (index[column] >= 0) & (truth[owner] == 1)
    place = np.full(len(truth), -1)
    place[truth == 1] = np.arange(toxic)
    have = np.zeros((len(fit), toxic), bool)
    have[index[column[mine]], place[owner[mine]]] = True
    lack, out = np.full(toxic, cover), []
    while len(have):
        gain = have.astype(np.float32) @ (lack > 0)
        k = int(gain.argmax())
        if gain[k] < max(3, 0.01 * toxic):
            break
        out.append(int(names[fit[k]]))
        lack -= have[k]
        alike = (have & have[k]).sum(1) > 0.9 * (have | have[k]).sum(1)
        have, fit = have[~alike], fit[~alike]
    return out


def _mapped(odds: np.ndarray, truth: np.ndarray) -> tuple[float, float]:
    """Slope and shift of a logistic curve through labels, by Newton's steps with a light prior."""
    a, b = 1.0, 0.0
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(a * odds + b, -30, 30)))
        g = np.array([((p - truth) * odds).sum() + (a - 1), (p - truth).sum() + 0.1 * b])
        q = p * (1 - p) + 1e-6
        h = np.array([[(q * odds**2).sum() + 1, (q * odds).sum()], [(q * odds).sum(), q.sum() + 0.1]])
        step = np.linalg.solve(h, g)
        a, b = a - np.clip(step[0], -1, 1), b - np.clip(step[1], -2, 2)
        a = max(a, 0.05)
    return float(a), float(b)


def scored(docs: DataFrame, classifier: Classifier) -> DataFrame:
    """doc_id and score of each row."""
    shared = docs.sparkSession.sparkContext.broadcast(classifier)
    fields = pa.schema([("doc_id", pa.int64()), ("score", pa.float64())])

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        return pa.record_batch([batch.column("doc_id"), pa.array(shared.value.scores(batch.column("text")))], schema=fields)

    return map_slices(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, "doc_id long, score double")


def op4_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    classifier, _, _ = learned(docs, table(spark, sf_dir, "labels"), ~held_out())
    return scored(docs, classifier).select(
        "doc_id", held_out().alias("held_out"), "score", (F.col("score") >= 0.7).cast("int").alias("predicted"))
