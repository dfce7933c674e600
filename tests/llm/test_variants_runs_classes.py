"""Spelling variants, periodic runs and the class model: against plain statements, and on odd rows."""

import math
import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest
from conftest import SF_DIR

from courtflow.llm import class_model, periodic, spelling

DDL = ("doc_id long, text string, word string, n long, runs string, `class` int, code int, codes string, held boolean, `row` long, "
       "h long, near string, start long, lang string")
ODD = [
    (1, None), (2, ""), (3, " \n\t "), (4, "One two"), (5, "spelling spelling speling"), (5, "spelling spelling speling"), (None, "spelling variants Variants"),
    (6, "la " * 30), (7, "é 日本　x"), (8, "a" * 40_000), (9, "one two three four " * 5_000), (10, "ab cd " * 11 + "x"),
]


def framed(spark, rows):
    return spark.createDataFrame([(i, t, "x", 1, "x", 1, 1, "x", True, 1, 1, "x", 1, "en") for i, t in rows], DDL)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


@pytest.fixture(scope="module")
def odd(spark):
    return framed(spark, ODD)


@pytest.fixture(scope="module")
def none(spark):
    return framed(spark, [])


# spelling

def plain_variants(counts):
    words, near = sorted(counts), {}
    for w in words:
        cut = {w[:i] + w[i + 1 :] for i in range(len(w))}
        near[w] = [v for v in words if v != w and (
            v in cut or (len(v) == len(w) and sum(a != b for a, b in zip(v, w, strict=True)) == 1)
            or (len(v) == len(w) + 1 and any(v[:i] + v[i + 1 :] == w for i in range(len(v)))))]
    form = {}
    for w in words:
        top = min(near[w], key=lambda v: (-counts[v], v), default=None)
        form[w] = top if top and counts[top] >= 10 * counts[w] else None
    out = {}
    for w in words:
        root = w
        while form[root]:
            root = form[root]
        out[w] = (form[w], root, counts[w], len(near[w]), counts[form[w]] if form[w] else None)
    return out


def found_variants(df):
    return {r.word: (r.form, r.root, r.n, r.n_near, r.form_n) for r in df.collect()}


@pytest.mark.parametrize("letters, length, least", [("ab", 9, 2), ("abc", 8, 2), ("abcdeé", 12, 1), ("a", 30, 1)])
def test_variants_equal_all_pairs(spark, monkeypatch, letters, length, least):
    # few letters, so that grams are extended and many words have grams that one edit could all touch
    monkeypatch.setattr(spelling, "LEAST", least)
    rnd = random.Random(length)
    base = ["".join(rnd.choice(letters) for _ in range(rnd.randint(7, length))) for _ in range(120)]
    words = set(base)
    for w in base:
        at = rnd.randrange(len(w))
        words |= {w[:at] + w[at + 1 :], w[:at] + rnd.choice(letters) + w[at:], w[:at] + rnd.choice(letters) + w[at + 1 :]}
    counts = {w: rnd.choice([2, 3, 30, 400, 5000]) for w in sorted(words) if len(w) >= 7}
    frame = spark.createDataFrame(list(counts.items()), "word string, n long")
    assert found_variants(spelling.variants(frame)) == plain_variants(counts)


def test_grams_before_and_behind_an_edit_stay(monkeypatch):
    monkeypatch.setattr(spelling, "LEAST", 1)
    rnd = random.Random(2)
    frequent = {x for x in ("".join(rnd.choice("abc") for _ in range(rnd.choice([2, 3]))) for _ in range(12))}
    frequent = frozenset(g for g in frequent if all(g[:k] in frequent for k in range(2, len(g))))
    inner = spelling.inner_parts(frequent)
    for _ in range(3000):
        w = "".join(rnd.choice("abc") for _ in range(rnd.randint(7, 12)))
        i, c = rnd.randrange(len(w)), rnd.choice("abcd")
        grams = spelling.decompose(w, frequent)
        before, behind = spelling.untouched(w, grams, inner)[i]
        for v in (w[:i] + c + w[i + 1 :], w[:i] + w[i + 1 :], w[:i] + c + w[i:]):
            theirs = spelling.decompose(v, frequent)
            assert not before or any(end == before and v[:end] == w[:before] for _, end in theirs)
            assert not behind or any(len(v) - b == behind and v[b:] == w[len(w) - behind :] for b, _ in theirs)
            if len(v) >= 7 and v != w and (0, 0) not in spelling.untouched(w, grams, inner):
                reads, _ = spelling.keys_of(w, frequent, inner)
                assert set(reads) & set(spelling.keys_of(v, frequent, inner)[1])


def plain_vocabulary(rows, change):
    counts = Counter()
    for doc_id, text in rows:
        lower = "".join(c.lower() if c.isascii() else c for c in text or "")
        for run in re.findall("[a-zÀ-ÿ]+", lower):
            if change and doc_id is not None:
                h = zlib.crc32(f"{doc_id}:{run}".encode())
                if h % 31 == 0:
                    run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= 7:
                counts[run] += 1
    return {w: n for w, n in counts.items() if n >= 2}


def test_vocabulary_and_variants_of_odd_rows(spark, docs, odd, none):
    for frame in (docs, odd):
        rows = [(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()]
        for change in (None, spelling.misspelt):
            mine = {r.word: r.n for r in spelling.vocabulary(frame, change).collect()}
            assert mine == plain_vocabulary(rows, change)
    found = found_variants(spelling.variants(spelling.vocabulary(odd)))
    assert found["spelling"][:2] == (None, "spelling") and "a" * 40_000 not in found
    assert spelling.variants(spelling.vocabulary(none)).count() == 0


def test_forms_lead_to_a_root_over_several_steps(spark):
    words = [("abcdefgh" + "x" * k, 3 * 10**k) for k in range(6)]
    found = found_variants(spelling.variants(spark.createDataFrame(words, "word string, n long")))
    assert {r for _, r, *_ in found.values()} == {words[-1][0]} and found[words[0][0]][0] == words[1][0]


# runs

def plain_runs(w, shortest=24, exponent=3):
    found = {}
    for q in range(1, len(w) // exponent + 1):
        i = 0
        while i + q < len(w):
            j = i
            while j + q < len(w) and w[j] == w[j + q]:
                j += 1
            if j > i and j - i + q >= max(shortest, exponent * q):
                found.setdefault((i, j - i + q), q)
            i = max(j, i + 1)
    return sorted((s, n, q) for (s, n), q in found.items())


@pytest.mark.parametrize("letters", [1, 2, 3, 6])
def test_runs_equal_all_periods(letters):
    rnd = random.Random(letters)
    for _ in range(400):
        w = [rnd.randrange(letters) for _ in range(rnd.randint(0, 150))]
        for _ in range(rnd.randint(0, 3)):
            if len(w) > 3:
                a = rnd.randrange(len(w))
                p, e = rnd.randint(1, max(1, (len(w) - a) // 3)), rnd.randint(a, len(w))
                w[a:e] = [w[a + (i - a) % p] for i in range(a, e)]
        assert periodic.find_runs(np.array(w, np.uint64)) == plain_runs(w)
        assert periodic.find_runs(np.array(w, np.uint64), 6, 2) == plain_runs(w, 6, 2)


def test_collapsed_texts(spark, docs, odd, none):
    for frame in (docs.limit(60), odd):
        expected = Counter()
        for r in frame.collect():
            w = (r.text or "").encode().split()
            runs = plain_runs(w) if len(w) < 2000 else None
            gone = {i for s, n, q in runs or () for i in range(s + q, s + n)}
            if runs is not None:
                expected[r.doc_id, len(w), tuple(runs), b" ".join(x for i, x in enumerate(w) if i not in gone).decode()] += 1
        got = Counter((r.doc_id, r.n_words, tuple((x.start, x.length, x.period) for x in r.runs), r.collapsed)
                      for r in periodic.collapse(frame).collect() if r.n_words < 2000)
        assert got == expected
    long_ = periodic.collapse(odd.where("doc_id = 9")).first()
    assert [tuple(x) for x in long_.runs] == [(0, 20_000, 4)] and long_.collapsed == "one two three four"
    assert periodic.collapse(none).count() == 0


# the class model

def plain_model(texts, held, of, core_size):
    """Base scores, transitions and emissions stated word by word, for given classes of all words."""
    words = [[*re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if c.isascii() else c for c in t or "")), None] for t in texts]
    counts = Counter(w for ws, h in zip(words, held, strict=True) if not h for w in ws)
    n, v = sum(counts.values()), len(counts)
    base = [sum(math.log10((counts[w] + 0.1) / (n + 0.1 * (v + 1))) for w in ws) for ws in words]
    return words, counts, n, v, base


def test_scores_follow_the_stated_model(spark, docs):
    frame = docs.limit(80)
    size, classes = 40, 8
    rows = frame.select("doc_id", "text").collect()
    held = {r.doc_id: zlib.crc32(str(r.doc_id).encode()) % 10 == 0 for r in rows}
    words, counts, n, v, base = plain_model([r.text for r in rows], [held[r.doc_id] for r in rows], None, size)
    got = {r.doc_id: r for r in class_model.scores(frame, size, classes, 3).collect()}
    for r, ws, b in zip(rows, words, base, strict=True):
        g = got[r.doc_id]
        assert (g.held_out, g.n_tokens, g.n_known, g.train_tokens) == (held[r.doc_id], len(ws), sum(counts[w] > 0 for w in ws), n)
        assert g.base_score == pytest.approx(b, rel=1e-9) and g.score < 0


def test_the_model_is_a_distribution(spark, docs):
    """Over all words and the unknown one, after every class, the probabilities sum to one."""
    from courtflow.llm.common import Scratch

    scratch = Scratch(spark)
    model, texts = class_model.train(scratch, docs.limit(80), 60, 10, 3)
    read = class_model.with_classes(scratch, texts, model, 60)
    step = class_model.smoothed(class_model.transitions(read, 10), model.totals)
    others = {r.h: (r.n, r["class"]) for r in model.words.collect()}
    core = [(int(c), int(k)) for c, k in zip(model.core.counts, model.core_classes, strict=True)]
    per_class = np.zeros(10)
    for c, k in [*core, *others.values()]:
        per_class[k] += c
    assert (per_class == model.totals).all() and model.core_classes[0] == 0 and sum(k == 0 for _, k in [*core, *others.values()]) == 1
    # emissions sum to one in each class that has words, so transitions must as well
    assert np.allclose((10.0**step).sum(axis=1), 1)
    assert 0 < model.unknown() < 1


def test_exchange_raises_the_likelihood():
    rng = np.random.default_rng(3)
    words, classes = 30, 5
    pairs = rng.poisson(2.0, (words, words)).astype(float)
    of = rng.integers(0, classes, words)

    def matrix(of):
        out = np.zeros((classes, classes))
        np.add.at(out, (of[:, None], of[None]), pairs)
        return out

    def likelihood(of):
        f = lambda x: (x * np.log(np.maximum(x, 1))).sum()
        m = matrix(of)
        return f(m) - f(m.sum(0)) - f(m.sum(1))

    for word in range(words):
        others = np.arange(words) != word
        after = np.bincount(of[others], pairs[word, others], classes)
        before = np.bincount(of[others], pairs[others, word], classes)
        gain = class_model.gains(matrix(of), of[word], after, before, pairs[word, word])
        for to in range(classes):
            moved = of.copy()
            moved[word] = to
            assert likelihood(moved) - likelihood(of) == pytest.approx(gain[to] - gain[of[word]], abs=1e-6)


def test_held_out_texts_score_better_than_by_words_alone(spark):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    scored = class_model.scores(docs, 2000, 32, 3)
    by = {r.held_out: r for r in class_model.perplexity(scored).collect()}
    assert by[True].perplexity < 0.6 * by[True].base_perplexity and by[False].perplexity < by[False].base_perplexity


def test_scores_of_odd_rows(spark, odd, none):
    got = class_model.scores(odd).collect()
    assert len(got) == len(ODD) and all(math.isfinite(r.score) and math.isfinite(r.base_score) for r in got)
    same = [r for r in got if r.doc_id == 5]
    assert same[0] == same[1] and next(r for r in got if r.doc_id == 1).n_tokens == 1
    assert class_model.scores(none).count() == 0
    # nothing to learn from: every token is the unknown one
    held = next(i for i in range(1000) if zlib.crc32(str(i).encode()) % 10 == 0)
    only = class_model.scores(framed(spark, [(held, "a b a")])).first()
    assert (only.score, only.base_score, only.n_known, only.train_tokens) == (0.0, 0.0, 0, 0)


def test_gains_with_logarithms_given():
    rnd = np.random.default_rng(6)
    matrix = rnd.integers(50, 5000, (12, 12)).astype(float)
    logs = class_model._xlogx(matrix)
    kept = logs.copy()
    for own in (1, 7):
        after, before = (np.where(rnd.random(12) < 0.5, rnd.integers(0, 9, 12), 0).astype(float) for _ in range(2))
        plain = class_model.gains(matrix, own, after, before, 2.0)
        assert np.array_equal(class_model.gains(matrix, own, after, before, 2.0, logs), plain) and np.array_equal(logs, kept)


def test_sums_of_short_and_long_lists():
    rnd = np.random.default_rng(7)
    size = np.append(rnd.integers(1, 30, 200), [1, 400, class_model.SHORT, class_model.SHORT + 1])
    offsets = np.concatenate([[0], np.cumsum(size)])
    values = rnd.random((offsets[-1], 5))
    found = class_model.sums_of_lists(lambda at: values[at], offsets, 5)
    assert np.allclose(found, np.add.reduceat(values, offsets[:-1]))
    assert class_model.sums_of_lists(lambda at: values[at], offsets[:1], 5).shape == (0, 5)


def test_ranks_of_words_that_begin_alike():
    rnd = np.random.default_rng(8)
    hashes = np.unique(np.append(rnd.integers(0, 1 << 63, 500, dtype=np.uint64) << np.uint64(1), np.array([0, 5, 6, 7, 2**64 - 2, 2**64 - 1], np.uint64)))
    core = class_model.Core(hashes, rnd.permutation(len(hashes)), np.ones(len(hashes)))
    asked = np.concatenate([hashes, hashes + np.uint64(1), np.array([1, 8, 2**64 - 3], np.uint64)])
    place = {h: r for h, r in zip(hashes.tolist(), core.ranks.tolist(), strict=True)}
    assert core.rank(asked, core.starts()).tolist() == [place.get(h, -1) for h in asked.tolist()]
    assert len(core.rank(asked[:0], core.starts())) == 0
