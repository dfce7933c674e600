"""One long text with very many spans, and ids that several texts or vectors share."""

import random
import time

import pytest

from courtflow.llm import jaccard, licenses, pii, vectors
from test_operators import plain_spans

N = 100_000


def test_a_hundred_thousand_spans_in_one_text(spark):
    rnd = random.Random(1)
    text = " ".join(rnd.choice(["10.0.0.1", "10.0.0.300", "é日 8.8.8.8", "a.b@c.de", "x"]) for _ in range(N))
    frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
    begin = time.monotonic()
    spans = pii.scan(frame).first().spans
    hidden = pii.redact(frame).first().text
    assert time.monotonic() - begin < 90
    plain = plain_spans(text)
    assert [f"{s.kind}:{s.start}:{s.end}" for s in spans if s.kind in ("email", "ip", "card", "phone")] == plain and len(plain) > 50_000
    out, at = [], 0
    for kind, start, end in sorted((p.split(":") for p in plain), key=lambda p: int(p[1])):
        out += [text[at : int(start)], f"[{kind.upper()}]"]
        at = int(end)
    assert hidden == "".join(out) + text[at:]


def test_scores_look_at_forty_code_points(spark):
    for gap, score in ((20, 0.6), (60, 0.3)):
        text = "é日" * 10 + " ssn " + "é " * (gap // 2) + "078-05-1120"
        frame = spark.createDataFrame([(1, text)], "doc_id long, text string")
        spans = [s for s in pii.scan(frame).first().spans if s.kind == "ssn"]
        assert [round(s.score, 3) for s in spans] == ([score] if score >= 0.5 else [])


def test_a_hundred_thousand_notices_in_one_text(spark):
    text = "cc by x " * N
    begin = time.monotonic()
    r = licenses.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert time.monotonic() - begin < 60
    assert (r.n_words, r.n_base, r.first_word, r.last_word) == (3 * N, N, 0, 3 * (N - 1))
    assert [m.n_words for m in r.matches[:3]] == [2, 2, 2] and r.matches[7].first_word == 21


def words(seed, n=40):
    rnd = random.Random(seed)
    return [f"w{rnd.randrange(500)}" for _ in range(n)]


def near(ws, k):
    return " ".join([*ws[:-1], f"n{k}"])


@pytest.mark.parametrize("turned", [False, True])
def test_texts_of_one_id_keep_their_links(spark, turned):
    a, b, c = words(1), words(2), words(3)
    rows = [(1, " ".join(a)), (1, " ".join(b)), (2, near(a, 2)), (3, near(b, 3)), (9, " ".join(c)), (7, near(c, 7)),
            (20, near(a, 5)), (None, " ".join(a)), (8, "")]
    frame = spark.createDataFrame(rows[::-1] if turned else rows, "doc_id long, text string").repartition(3)
    found = {}
    for r in jaccard.jaccard_groups(frame, 3, 8, 10).collect():
        found.setdefault(r.doc_id, set()).add(r.component_id)
    assert found == {1: {1}, 2: {1}, 3: {1}, 9: {7}, 7: {7}, 20: {1}, None: {None}, 8: {8}}


def test_documents_met_through_one_of_two_texts(spark):
    a, b = words(1), words(2)
    rows = [(5, " ".join(a)), (5, " ".join(b)), (2, near(a, 2)), (3, near(b, 3))]
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    assert {(r.doc_id, r.component_id) for r in jaccard.jaccard_groups(frame, 3, 8, 10).collect()} == {(5, 2), (2, 2), (3, 2)}


@pytest.mark.parametrize("turned", [False, True])
def test_vectors_of_one_id_keep_their_links(spark, turned):
    rnd = random.Random(4)
    a, b = ([rnd.gauss(0, 1) for _ in range(16)] for _ in range(2))
    close = lambda v: [x + 0.001 for x in v]
    rows = [(1, a), (1, b), (2, close(a)), (3, close(b)), (4, [float("nan")] * 16), (4, [x * 2 for x in a]), (5, None), (None, a)]
    frame = spark.createDataFrame(rows[::-1] if turned else rows, "vec_id long, embedding array<double>").repartition(2)
    got = sorted((r.vec_id or 0, r.n_links, r.component_id, r.kept) for r in vectors.near_duplicates(frame).collect())
    assert got == [(0, 0, None, True), (1, 1, 1, True), (1, 2, 1, True), (2, 2, 1, False), (3, 1, 1, False),
                   (4, 0, 1, False), (4, 2, 1, False), (5, 0, 5, True)]
