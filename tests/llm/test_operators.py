"""The operators for training data: against plain statements, SQL, and on odd rows."""

import hashlib
import random
import re
import tracemalloc
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pyarrow as pa
import pytest
from compare import connect, difference
from conftest import SF_DIR
from tokenizers import Tokenizer

from courtflow.llm import (
    decontamination,
    jaccard,
    language,
    licenses,
    packing,
    pii,
    registry,
    sharding,
    substrings,
    toxicity,
    vectors,
    words,
)

DDL = ("doc_id long, text string, lang string, source string, n_chars long, th long, n long, id long, a long, "
       "anchors string, place string, size string, spans string, score double, `list` int, prefix string, hits string, `__th2` long")
WORDS = [f"w{k}" for k in range(400)]


def prose(seed, n):
    rnd = random.Random(seed)
    return " ".join(rnd.choice(WORDS) for _ in range(n))


PASSAGE = prose(1, 60)
ODD = [
    (1, None, None), (2, "", "en"), (3, " \n\t ", "en"), (4, "One two", "en"), (5, PASSAGE, "en"), (6, PASSAGE, "en"),
    (6, PASSAGE, "en"), (None, PASSAGE, None), (7, prose(2, 30) + " " + PASSAGE + " " + prose(3, 30), "fr"),
    (8, prose(4, 20_000), "fr"), (9, "CC BY-NC 4.0 all rights\nreserved", None), (10, "a" * 50_000, "de"), (11, "é 日本　x", "de"),
    (12, "one TWO", None),
]


@pytest.fixture(scope="module")
def odd(spark):
    rows = [(i, t, lang, None, None, 1, 2, 3, 4, "x", "y", "z", "s", 0.5, 6, "p", "h", 7) for i, t, lang in ODD]
    return spark.createDataFrame(rows, DDL)


@pytest.fixture(scope="module")
def none(spark):
    return spark.createDataFrame([], DDL)


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF_DIR}/documents.parquet")


def by_id(df):
    return {r.doc_id: r for r in df.collect() if r.doc_id is not None}


@pytest.mark.parametrize("name", [n for n, (_, sql) in registry.QUERIES.items() if sql])
def test_query_equals_sql(spark, name):
    query, sql = registry.QUERIES[name]
    assert difference(spark, connect(SF_DIR), SF_DIR, query, sql) is None


# licence scan

def words_of(text):
    lower = "".join(c.lower() if c.isascii() else c for c in text or "")
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", lower)


def test_licences_equal_a_plain_search(docs, odd):
    phrases = {"cc-by": ["cc", "by"], "gpl": ["general", "public", "license"], "reserved": ["all", "rights", "reserved"]}
    for frame in (docs, odd):
        texts = {(r.doc_id, r.text) for r in frame.select("doc_id", "text").collect()}
        found = defaultdict(set)
        for r in licenses.scan(frame).collect():
            found[r.doc_id].add((r.n_words, r.n_base, r.first_word, r.last_word, r.base_labels))
            assert 0 <= r.score <= 1 and set(r.base_labels.split(",")) <= set(r.labels.split(",")) | {""}
        for doc_id, text in texts:
            w = words_of(text)
            hits = [(k, n) for n, p in phrases.items() for k in range(len(w)) if w[k : k + len(p)] == p]
            at = [k for k, _ in hits]
            plain = (len(w), len(hits), min(at, default=None), max(at, default=None), ",".join(sorted({n for _, n in hits})))
            assert plain in found[doc_id]


@pytest.mark.parametrize("text, label, edits", [
    ("under the general publik license now", "gpl", 1), ("al rights reservd", "reserved", 2),
    ("released under the mitt license", "mit", 1), ("general public", None, 0), ("accc byte", None, 0),
])
def test_fuzzy_notices(text, label, edits):
    found = licenses.find(f" {text} ".encode())
    assert (label in {n.label for n, *_ in found}) if label else not found
    assert not label or min(e for n, _, _, e in found if n.label == label) == edits


# packing

def test_pieces_put_documents_together_again(spark, docs, odd, none):
    tokenizer = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    for frame in (docs, odd.where("doc_id is not null").dropDuplicates(["doc_id"])):
        pieces = defaultdict(list)
        sequences = defaultdict(list)
        for p in packing.packed(frame, with_ids=True).collect():
            assert p.length == len(p.ids) and p.ids_crc32 == zlib.crc32(np.array(p.ids, "<u4").tobytes())
            pieces[p.doc_id].append((p.start, p.ids, p.doc_tokens))
            sequences[p.sequence_id].append((p.offset, p.length))
        for r in frame.select("doc_id", "text").collect():
            ids = tokenizer.encode(r.text or "", add_special_tokens=False).ids + [0]
            mine = sorted(pieces[r.doc_id])
            assert [i for _, part, _ in mine for i in part] == ids and {n for *_, n in mine} == {len(ids)}
        for parts in sequences.values():
            at = 0
            for offset, length in sorted(parts):
                assert offset == at
                at += length
            assert at == 1024 or at & (at - 1) == 0
    assert packing.packed(none).count() == 0
    assert packing.packed(odd).count() >= len(ODD)


def test_units_equal_whole_texts():
    rnd = random.Random(3)
    bits = ["a", "b", " ", "  ", "\n", "\t", "\xa0", " ", "　", "\x1c", "\x0b", "\x85", "é", "1", "²", "'s", ".", "!!",
            "<|endoftext|>", "日", "\r\n", "́", "\x00"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    units = packing.UnitTokenizer(public_tokenizers.path("byte_bpe_50k.json"), most=500)
    whole = units.ids(texts)
    for a in range(0, len(texts), 300):
        assert [x.tolist() for x in units.encode(pa.array(texts[a : a + 300]))] == whole[a : a + 300]


def test_words_and_the_punctuation_after_them_are_learned_apart():
    rnd = random.Random(8)
    bits = ["a", "It", "w7", "42", "'s", "'ll", "'", "s", ".", ",", "!?", "-", "_", "\"", " ", "  ", "\n", "é", "—", "…", "|", "\x7f", "\x1b"]
    texts = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 12))) for _ in range(3000)]
    units = packing.UnitTokenizer(public_tokenizers.path("byte_bpe_50k.json"))
    whole = units.ids(texts)
    for a in range(0, len(texts), 300):
        assert [x.tolist() for x in units.encode(pa.array(texts[a : a + 300]))] == whole[a : a + 300]
    units._forget()
    units.encode(pa.array([" ".join(w + mark for w in WORDS for mark in ".,;:!?")]))
    assert len(units.keys) <= len(WORDS) + 7


def test_level_grows_the_sum_of_squares_least():
    rnd, packer = random.Random(5), packing.LevelPacker(16)
    for d in range(400):
        size = rnd.randint(1, 15)
        counts = packer.counts.copy()

        def after(level, size=size, counts=counts):
            c = counts.copy()
            if level:
                c[level] -= 1
            if level + size < 16:
                c[level + size] += 1
            return int((c**2).sum())

        level = packer.level_for(size)
        assert after(level) == min(after(x) for x in range(17 - size) if x == 0 or counts[x])
        list(packer.add(d, np.arange(size, dtype=np.uint32)))


# personal data

def luhn(digits):
    return sum(sum(divmod(int(c) * (1 + k % 2), 10)) for k, c in enumerate(reversed(digits))) % 10 == 0


PLAIN = {
    "email": (r"[A-Za-z0-9._%+-]+@[A-Za-z0-9-]+(\.[A-Za-z0-9-]+)+", lambda m: True),
    "ip": (r"[0-9]+(\.[0-9]+)(\.[0-9]+)(\.[0-9]+)", lambda m: all(int(p) <= 255 for p in m.split("."))),
    "card": (r"[0-9]([\x20-]?[0-9])+", lambda m: 13 <= len(d := re.sub(r"[^0-9]", "", m)) <= 19 and luhn(d)),
    "phone": (r"\+[0-9][\x20().0-9-]+[0-9]", lambda m: 9 <= len(re.sub("[^0-9]", "", m)) <= 15),
}


def plain_spans(text):
    return [f"{k}:{m.start()}:{m.end()}" for k, (p, ok) in PLAIN.items() for m in re.finditer(p, text or "") if ok(m[0])]


def test_personal_data_equals_a_plain_search(spark, docs):
    rnd = random.Random(9)
    bits = ["a", "@", ".", "b.co", "1", "23", "255", "256", " ", "-", "+4", "(", "4111 1111 1111 1111", "é", "日", "\n", "_", "1.2.3.4",
            "x@y.z", "+49 170 1234567", "00", "0001"]
    made = ["".join(rnd.choice(bits) for _ in range(rnd.randint(0, 25))) for _ in range(1500)] + ["1." * 3000, "a@b" + ".c" * 3000, "1 " * 5000, None]
    frame = spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").unionByName(
        docs.selectExpr("doc_id + 100000 AS doc_id", "text"))
    texts = {r.doc_id: r.text for r in frame.collect()}
    for r in pii.scan(frame).collect():
        mine = [f"{s.kind}:{s.start}:{s.end}" for s in r.spans if s.kind in PLAIN]
        assert mine == plain_spans(texts[r.doc_id]), texts[r.doc_id]


def test_query_counts_each_kind_and_parts_of_zeros(spark, tmp_path):
    rnd = random.Random(12)
    bits = ["a@b.co", "1.2.3.4", "0000.01.000000255.0", "256.0000.1.1", "4111 1111 1111 1111", "+49 170 1234567", "é", "x"]
    made = [" ".join(rnd.choice(bits) for _ in range(rnd.randint(0, 9))) for _ in range(300)] + [None]
    spark.createDataFrame(list(enumerate(made)), "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    for r in pii.op3_personal_data(spark, str(tmp_path)).collect():
        plain = plain_spans(made[r.doc_id])
        kinds = Counter(s.split(":")[0] for s in plain)
        assert (r.n_email, r.n_ip, r.n_card, r.n_phone) == tuple(kinds[k] for k in PLAIN)
        assert r.base_sha256 == hashlib.sha256(",".join(plain).encode()).hexdigest()


def test_query_digests_and_other_kinds(spark, odd, none):
    text = "IBAN DE89 3704 0044 0532 0130 00, mail me: a.b@c.de or +49 170 1234567"
    frame = spark.createDataFrame([(1, text, "en", "s", len(text))], "doc_id long, text string, lang string, source string, n_chars long")
    kinds = [s.kind for s in pii.scan(frame).first().spans]
    assert "iban" in kinds and "email" in kinds and "phone" in kinds
    out = pii.redact(frame).first()
    assert out.text == "IBAN [IBAN], mail me: [EMAIL] or [PHONE]" and out.n_chars == len(out.text)
    assert pii.scan(odd).count() == len(ODD) and pii.redact(odd).columns == odd.columns and pii.scan(none).count() == 0


def test_ibans_before_capitals_and_digits(spark):
    rows = ["IBAN DE89 3704 0044 0532 0130 00 BIC COBADEFFXXX", "DE89370400440532013000 2024", "GB82WEST12345698765432 AND MORE", "DE89370400440532013001 2024"]
    frame = spark.createDataFrame(list(enumerate(rows)), "doc_id long, text string")
    out = [r.text for r in pii.redact(frame).orderBy("doc_id").collect()]
    assert out == ["IBAN [IBAN] BIC COBADEFFXXX", "[IBAN] 2024", "[IBAN] AND MORE", rows[3]]


# toxicity and language

def test_held_out_toxicity(spark):
    sf = "/root/testdata/sf0.01"
    rows = toxicity.op4_toxicity(spark, sf).join(spark.read.parquet(f"{sf}/labels.parquet"), "doc_id").where("held_out").collect()
    hit = sum(r.predicted == r.toxic == 1 for r in rows)
    assert hit >= 0.6 * sum(r.toxic for r in rows) and hit >= 0.9 * sum(r.predicted for r in rows)


def test_label_model_finds_rates_and_correlation():
    rng = np.random.default_rng(1)
    n, y = 200_000, rng.random(200_000) < 0.1
    votes = np.stack([rng.random(n) < np.where(y, h, m) for h, m in ((0.5, 0.01), (0.4, 0.01), (0.3, 0.02), (0.4, 0.01), (0.5, 0.02))] , 1)
    votes = np.hstack([votes, (votes[:, :1] & (rng.random((n, 1)) < 0.95))])  # repeats the first voter
    model = toxicity.label_model(n, votes.T.astype(np.int64) @ votes, 0.1)
    assert (0, 5) in model.correlated
    assert np.abs(model.accuracy[:5] - [0.5, 0.4, 0.3, 0.4, 0.5]).max() < 0.1
    assert model.posterior(np.array([[1, 1, 0, 0, 0, 1]]))[0] > 0.9 > 0.1 > model.posterior(np.zeros((1, 6)))[0]


def test_toxicity_of_odd_rows(spark, odd, none):
    labels = spark.createDataFrame([(5, 1, 1), (None, 1, 1), (5, None, 0), (4, 0, None)], "doc_id long, quality int, toxic int")
    for frame in (odd, none):
        model, _, _ = toxicity.learned(frame, labels, ~toxicity.held_out())
        rows = toxicity.scored(frame, model).collect()
        assert len(rows) == frame.count() and all(0 <= r.score <= 1 for r in rows)


def test_held_out_language(spark):
    sf = "/root/testdata/sf0.01"
    rows = language.op5_language_identification(spark, sf).join(
        spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "lang"), "doc_id").where("held_out and lang is not null").collect()
    assert sum(r.lang == r.lang_pred for r in rows) >= 0.97 * len(rows)


def test_languages_of_odd_rows(odd, none):
    for frame in (odd, none):
        model = language.learned(frame, ~language.held_out())
        found = language.predicted(frame, model).collect()
        assert len(found) == frame.count() and all(0 <= r.score <= 1 for r in found)
        assert all(r.lang_pred == "und" for r in found if r.doc_id in (1, 2, 3))
        assert language.with_language(frame, model, "guess").columns == [*frame.columns, "guess"]


def test_fit_of_languages_holds_its_rows_once(spark):
    n = 1600
    rows = [(k, f"{('the', 'der', 'les', 'los')[k % 4]} {prose(k, 20)}", ("en", "de", "fr", "es")[k % 4]) for k in range(n)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    models = []
    most = peak_mb(lambda: models.append(language.learned(frame, language.held_out() | ~language.held_out())))
    assert len(models[0].contests) == 3 and most * 1e6 < 2.2 * n * 4 * (1 << language.BUCKET_BITS)


def test_sums_of_weights_equal_features():
    texts = pa.array(["", None, "a", "ab", "abc é", prose(1, 50)])
    weights = np.random.default_rng(0).standard_normal((3, 1 << language.BUCKET_BITS)).astype(np.float32)
    assert np.allclose(language.margins(texts, weights), language.frequencies(texts) @ weights.T, atol=1e-4)


# benchmark

def test_benchmark_passages(spark, odd, none):
    filler = [(100 + k, prose(50 + k, 120), "en") for k in range(200)]
    item = prose(900, 40)
    edited = " ".join(w if k % 9 else "zz" for k, w in enumerate(item.split()))
    rows = [*filler, (1, prose(800, 90) + " " + item + " " + prose(801, 90), "en"), (2, f"{edited} {prose(802, 40)}", "en"), (3, item, None), (4, None, None), (5, "", None)]
    frame = spark.createDataFrame(rows, "doc_id long, text string, lang string")
    benchmark = spark.createDataFrame([(7, item, "q"), (8, None, "q"), (9, "a b", "q"), (7, item, "q")], "item_id long, text string, score string")
    assert {(r.doc_id, r.item_id) for r in decontamination.matches(frame, benchmark).collect()} == {(1, 7), (2, 7), (3, 7)}
    assert decontamination.matches(odd, benchmark).count() == 0
    assert decontamination.matches(none, benchmark).count() == 0
    assert decontamination.matches(frame, benchmark.limit(0)).count() == 0


def test_an_item_that_a_third_of_documents_hold(spark):
    rnd = random.Random(6)
    text = lambda n: [f"v{rnd.randrange(4000)}" for _ in range(n)]
    item = text(20)
    rows = []
    for k in range(600):
        at = rnd.randint(0, 60)
        words = text(60)
        rows.append((k, " ".join(words if k % 3 else words[:at] + item + words[at:])))
    frame = spark.createDataFrame(rows, "doc_id long, text string")
    benchmark = spark.createDataFrame([(1, " ".join(item)), *((2 + k, " ".join(text(30))) for k in range(20))], "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.matches(frame, benchmark).collect()}
    assert found <= {(k, 1) for k in range(0, 600, 3)} and len(found) >= 190


def every_match(texts, items):
    """Pairs of text and item that pass the checks around any passage, by trying them all."""
    place = lambda t: decontamination.passages(pa.array([t]))
    known = [place(t)[4] for t in items]
    ends = [place(re.split("[.!?]", t.rstrip(".!? \n"))[-1])[4] for t in items]
    table = [decontamination.places_of(w) for w in known]
    found = set()
    for k, t in enumerate(texts):
        _, begin, end, _, words = place(t)
        for i, (own, last) in enumerate(zip(known, ends, strict=True)):
            for b, e in zip(begin, end, strict=True):
                around = words[max(0, b - len(own)) : e + len(own)]
                share = decontamination.common_places(around, table[i], len(own), len(own) // 2) / len(own)
                said = share >= 0.5 and len(last) >= 3 and decontamination.common_words(around, last) == len(last)
                if share >= (0.5 if said else 0.7):
                    found.add((k, i))
                    break
    return found


def test_recall_of_benchmark_places(spark):
    rnd = random.Random(8)
    texts = [r.text or "" for r in spark.read.parquet("/root/testdata/sf0.01/documents.parquet").orderBy("doc_id").collect()]
    items = [r.text for r in spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet").orderBy("item_id").collect()]
    vocabulary = sorted({w for t in texts[:100] for w in t.split()})
    some = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    planted = defaultdict(set)

    def plant(kind, item, words):
        k = rnd.randrange(250)
        held = texts[k].split()
        at = rnd.randint(0, len(held))
        texts[k] = " ".join(held[:at] + words + held[at:])
        planted[kind].add((k, item))

    for i in range(40):
        words = items[i].split()
        plant("exact", i, words)
        answer = len(re.split("[.!?]", items[i].rstrip(".!? \n"))[-1].split())
        kept = set(rnd.sample(range(len(words) - answer), max(0, min(len(words) - answer, round(rnd.uniform(0.5, 0.6) * len(words)) - answer + 1))))
        plant("paraphrased", i, [w if j in kept or j >= len(words) - answer else rnd.choice(vocabulary) for j, w in enumerate(words)])
    for i in range(40, 80):
        items.append(" ".join(some(rnd.randint(5, 7))))
        plant("short", i, items[i].split())
    right = every_match(texts[:250], items)
    benchmark = spark.createDataFrame(list(enumerate(items)), "item_id long, text string")
    found = {(r.doc_id, r.item_id) for r in decontamination.matches(
        spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), benchmark).collect() if r.doc_id < 250}
    recall = {kind: (len(found & pairs & right), len(pairs & right)) for kind, pairs in {**planted, "all": right}.items()}
    print(recall)
    assert found <= right and all(b >= 20 and a >= 0.9 * b for a, b in recall.values()), recall


def test_the_directions_are_fitted_on_all_documents(spark):
    rnd = random.Random(12)
    texts = [" ".join(rnd.choice("abcdefghijklmnopqrstuvwxyz") for _ in range(6)) for _ in range(9000)] + ["", None]
    docs = spark.createDataFrame([(k, t) for k, t in enumerate(texts)], "doc_id long, text string").repartition(3)
    space = decontamination.latent_space(docs, dimensions=32)
    terms, begin, end, _, _ = decontamination.passages(pa.array(texts))
    row, term, weight = decontamination.vectors(terms, begin, end, space.idf)
    own = np.unique(term)
    dense = np.zeros((len(begin), decontamination.TERMS))
    dense[row, term] = weight
    dense = dense[:, own]
    assert np.allclose(space.idf[own], np.log(9001 / ((dense > 0).sum(0) + 1)) + decontamination.FLOOR, atol=1e-4)
    # as many directions as terms: each scaled by its singular value, together they turn A'A into one
    assert len(own) == 26 and np.allclose(space.basis[own] @ space.basis[own].T @ (dense.T @ dense), np.eye(26), atol=0.01)


def test_numbers_of_terms_give_the_passages_of_texts(spark):
    texts = ["", None, "a", "A b, C!", prose(1, 100), "é " * 40, prose(2, 33)]
    numbers = decontamination.numbered(spark.createDataFrame([(t,) for t in texts], "text string").coalesce(1)).toArrow()["words"].combine_chunks()
    for some in (slice(0, 7), slice(3, 5), slice(0, 2)):
        found = decontamination._numbered_passages(numbers[some])
        assert all(np.array_equal(a, b) for a, b in zip(found, decontamination.passages(pa.array(texts[some], pa.string()))[:3], strict=True))


def test_the_turned_product_of_terms_in_many_rows():
    rnd = np.random.default_rng(6)
    n = 2500
    dense = np.where(rnd.random((n, 12)) < np.linspace(0.002, 1, 12), rnd.random((n, 12)), 0).astype(np.float32)
    row, term = np.nonzero(dense)
    left = rnd.random((n, 5)).astype(np.float32)
    total = np.zeros((decontamination.TERMS, 5))
    decontamination._turned(row, term, dense[row, term], left, total)
    assert np.allclose(total[:12], dense.T @ left, rtol=1e-4) and not total[12:].any()


def test_projection_equals_a_dense_product():
    rnd = np.random.default_rng(4)
    basis = rnd.standard_normal((decontamination.TERMS, 7)).astype(np.float32)
    dense = np.where(rnd.random((300, 50)) < 0.2, rnd.random((300, 50)), 0).astype(np.float32)
    dense[[0, 17, 299]] = 0  # passages without terms
    row, term = np.nonzero(dense)
    found = decontamination.project(row, term, dense[row, term], 300, basis)
    assert np.allclose(found, dense @ basis[:50], atol=1e-4)
    assert decontamination.project(row[:0], term[:0], dense[row, term][:0], 0, basis).shape == (0, 7)
    assert not decontamination.project(row[:0], term[:0], dense[row, term][:0], 5, basis).any()


def peak_mb(function):
    tracemalloc.start()
    function()
    most = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    return most / 1e6


def test_the_fit_adds_a_turned_product_in_little_memory():
    rnd = np.random.default_rng(5)
    n, width = 1500, 128
    row, term = np.repeat(np.arange(n), 30), (rnd.random((n, 30)) * 500 + np.arange(30) * 500).astype(np.int64).ravel()
    weight = rnd.random(len(row)).astype(np.float32)
    left = rnd.random((n, width)).astype(np.float32)
    dense = np.zeros((n, decontamination.TERMS))
    dense[row, term] = weight
    total = np.ones((decontamination.TERMS, width))
    assert peak_mb(lambda: decontamination._turned(row, term, weight, left, total)) < 8
    assert np.allclose(total, 1 + dense.T @ left, atol=1e-3)
    decontamination._turned(row[:0], term[:0], weight[:0], left[:0], total)
    decontamination._turned(row[:0], term[:0], weight[:0], left[:5], total)
    assert np.allclose(total, 1 + dense.T @ left, atol=1e-3)


def test_words_take_little_memory():
    text = pa.array(["Some words, of 5 or so letters each " * 15_000])
    assert peak_mb(lambda: words.find_words(text, words.NOT_SPACE, lower=True)) < 30 * 0.54


def test_words_in_several_blocks_and_between_texts():
    rnd = random.Random(9)
    long = "".join(rnd.choice("aB1 \t\né字") for _ in range(90_000))
    texts = ["", None, "x", " y", long, "z ", "", long[:50], "Z"]
    found = words.find_words(pa.array(texts), words.NOT_SPACE, lower=True)
    plain = [re.findall(r"[^\x20\x09-\x0D]+", (t or "").replace("B", "b").replace("Z", "z")) for t in texts]
    assert np.diff(found.first).tolist() == [len(w) for w in plain]
    names = [w for own in plain for w in own]
    assert [found.data[a:b].tobytes().decode() for a, b in zip(found.begin, found.end, strict=True)] == names
    assert len(set(zip(names, found.hashes.tolist(), strict=True))) == len(set(names)) == len(set(found.hashes.tolist()))


def test_meetings_take_little_memory():
    rnd = random.Random(12)
    item = [f"v{k}" for k in range(20)]
    texts = pa.array([" ".join(rnd.choice(item) for _ in range(100)) for _ in range(100)])
    space = decontamination.Space(np.ones(decontamination.TERMS), np.ones((decontamination.TERMS, 1), np.float32))
    items = decontamination._items([{"item_id": k, "text": " ".join(item)} for k in range(100)], space)
    _, begin, end, text, hashes = decontamination.passages(texts)
    last = np.searchsorted(text, np.arange(100), "right")
    stop = end[last - 1]
    pairs = set()
    most = peak_mb(lambda: [0 for _ in decontamination.meetings(items, hashes, begin, end, last, stop)])
    for met, of in decontamination.meetings(items, hashes, begin, end, last, stop):
        pairs |= set(zip(met.tolist(), of.tolist(), strict=True))
    assert len(pairs) == len(begin) * 100 and most < 40


def test_only_pairs_without_enough_common_words_are_unlikely():
    rnd = random.Random(13)
    some = lambda n: " ".join(f"v{int(rnd.random() ** 3 * 300)}" for _ in range(n))
    texts = pa.array(["", None, *(some(rnd.randint(1, 200)) for _ in range(60))])
    space = decontamination.Space(np.ones(decontamination.TERMS), np.ones((decontamination.TERMS, 1), np.float32))
    items = decontamination._items([{"item_id": k, "text": some(rnd.randint(5, 60))} for k in range(40)], space)
    _, begin, end, text, hashes = decontamination.passages(texts)
    stop = np.searchsorted(text, np.arange(len(texts)), "right")
    stop = np.where(stop > 0, np.append(end, 0)[stop - 1], 0)
    met, of = (x.ravel() for x in np.meshgrid(np.arange(len(begin)), np.arange(40), indexing="ij"))
    found = decontamination.likely(items, decontamination.marks_of(hashes), begin, end, text, stop, met, of)
    right = []
    for p, i in zip(met.tolist(), of.tolist(), strict=True):
        size, k = items.sizes[i], text[p]
        around = Counter(hashes[max(begin[p] - size, stop[k - 1] if k else 0) : min(end[p] + size, stop[k])].tolist())
        right.append(sum(min(own.bit_count(), around[w]) for w, own in items.words[i].items()) >= size / 2)
    assert 100 < sum(right) < len(right) / 2 and found[right].all() and found.sum() < 1.2 * sum(right)
    assert not len(decontamination.likely(items, decontamination.marks_of(hashes), begin, end, text, stop, met[:0], of[:0]))


def test_spans_hold_every_candidate_once():
    rnd = random.Random(5)
    text = np.sort(np.array([rnd.randrange(6) for _ in range(100)]))
    pairs = sorted({(rnd.randrange(100), rnd.randrange(4)) for _ in range(150)})
    passage, item = np.array(pairs).T
    made = list(decontamination.spans(passage, item, text))
    assert sorted((p, i) for _, i, near in made for p in near) == pairs and len(made) < len(pairs)
    for k, _, near in made:
        assert near == sorted(near) and near[-1] - near[0] < decontamination.SPAN and set(text[near]) == {k}
    assert not list(decontamination.spans(passage[:0], item[:0], text))


def test_common_subsequence():
    rnd = random.Random(2)
    for _ in range(200):
        a, b = ([rnd.randint(0, 5) for _ in range(rnd.randint(1, 30))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        assert decontamination.common_words(np.array(a, np.uint64), np.array(b, np.uint64)) == table[-1][-1]


# shards

def test_curve_visits_every_cell_by_single_steps():
    order = sorted(range(4096), key=sharding.curve(3, 4).__getitem__)
    cells = [(c >> 8, c >> 4 & 15, c & 15) for c in order]
    assert len(set(cells)) == 4096
    assert all(sum(abs(p - q) for p, q in zip(a, b, strict=True)) == 1 for a, b in zip(cells, cells[1:], strict=False))


@pytest.mark.parametrize("group", [3, 20_000])
def test_shards(spark, docs, odd, none, group):
    for frame in (docs, odd.drop("size")):
        rows = sharding.shards(frame, 24, group_rows=group).collect()
        count = Counter(r.shard for r in rows)
        assert len(rows) == frame.count() and max(count.values()) - min(count[s] for s in range(24)) <= 1 and set(count) <= set(range(24))
        for s in count:
            assert sorted(r.slot for r in rows if r.shard == s) == list(range(count[s]))
        texts = {(r.doc_id, len((r.text or "").encode()) + 8, zlib.crc32((r.text or "").encode())) for r in frame.collect()}
        assert {(r.doc_id, r["size"], r.text_crc32) for r in rows} == texts
        ordered = sorted(rows, key=lambda r: (r.shard, r.slot))
        assert [r.place for r in ordered] == sorted(r.place for r in rows)
    assert sharding.shards(none.drop("size"), 24).count() == 0


# Jaccard join

def test_jaccard_equals_all_pairs(spark):
    rnd = random.Random(4)
    base = [prose(k, 60) for k in range(6)]
    rows = []
    for k in range(160):
        words = rnd.choice(base).split()
        for _ in range(rnd.randint(0, 4)):
            words[rnd.randrange(len(words))] = rnd.choice(WORDS)
        rows.append((k, " ".join(words) if k % 20 else ["", None, "one", "ONE"][k // 20 % 4]))
    for n, num, den in ((3, 9, 10), (5, 4, 5)):
        sets = {}
        for i, t in rows:
            w = (t or "").lower().split()
            sets[i] = {tuple(w[k : k + n]) for k in range(len(w) - n + 1)} or ({tuple(w)} if w else set())
        top = {i: i for i in sets}
        for a in sets:
            for b in sets:
                if a < b and sets[a] and sets[b] and len(sets[a] & sets[b]) * den >= num * len(sets[a] | sets[b]):
                    low, high = sorted((top[a], top[b]))
                    top = {i: low if t == high else t for i, t in top.items()}
        found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), n, num, den).collect()}
        assert found == {i: (len(s), top[i]) for i, s in sets.items()}


@pytest.mark.parametrize("lead", [2, 8])
def test_pairs_that_share_many_shingles_are_made_once(spark, lead):
    rnd = random.Random(lead)
    held = {k: sorted(rnd.sample(range(60), 55)) for k in range(40)}
    rows = [(t, k, place, k // 2, 60, [0] * 8, mine[:lead]) for k, mine in held.items() for place, t in enumerate(mine)]
    posts = spark.createDataFrame(rows, "t long, id long, place long, c long, n long, bits array<long>, lead array<long>")
    made = [(r.a, r.b) for r in jaccard.shared_pairs(posts, 1, 10).collect()]
    assert set(made) == {(a, b) for a in held for b in held if a < b and a // 2 != b // 2}
    # pairs without a common shingle among their smallest may come more than once
    lone = {(a, b) for a, b in made if not set(held[a][:lead]) & set(held[b][:lead])}
    assert len([p for p in made if p not in lone]) == len(set(made) - lone)
    assert len(made) <= (3 if lead == 2 else 1.1) * len(set(made))


def test_long_sets_that_share_little_are_not_verified(spark, monkeypatch):
    rnd = random.Random(12)
    vocabulary = [f"w{k}" for k in range(500)]
    text = lambda n: [rnd.choice(vocabulary) for _ in range(n)]
    base = text(4000)
    edited = [w if k % 200 else "zz" for k, w in enumerate(base)]
    # 4,096 lies between the sizes of the first and the third
    words = [base, edited, base + text(300), *(text(rnd.randint(3900, 4300)) for _ in range(12))]
    rows = [(k, " ".join([*w, "aa", "bb", "cc"])) for k, w in enumerate(words)]
    sets = [{tuple(t.split()[j : j + 3]) for j in range(len(t.split()) - 2)} for _, t in rows]
    made, stored = [], jaccard.Scratch.stored

    def counted(self, df, name):
        out = stored(self, df, name)
        made.extend((r.a, r.b) for r in out.collect() if name == "pairs")
        return out

    monkeypatch.setattr(jaccard.Scratch, "stored", counted)
    found = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_groups(spark.createDataFrame(rows, "doc_id long, text string"), 3, 9, 10).collect()}
    assert all(len(sets[0] & sets[k]) >= 0.9 * len(sets[0] | sets[k]) for k in (1, 2))
    assert found == {k: (len(s), 0 if k < 3 else k) for k, s in enumerate(sets)}
    assert len(made) <= 3  # any two share a rare shingle


def test_wide_bitmaps_bound_the_difference():
    rnd = np.random.default_rng(3)
    for n, m in ((600, 500), (1024, 1030), (2000, 2100), (513, 512), (5000, 900)):
        x = rnd.integers(0, 1 << 63, n, dtype=np.uint64)
        y = np.concatenate([x[: min(n, m) - 50], rnd.integers(0, 1 << 63, m - min(n, m) + 50, dtype=np.uint64)])
        a, b = jaccard._parities(np.concatenate([x, y]), np.array([0, n, n + m]))
        assert (a is None, b is None) == (n <= 512, m <= 512)
        if a and b:
            assert len(a) * 8 >= n and len(b) * 8 >= m
            apart = len(np.setxor1d(x, y))
            assert apart - 2 * apart**2 // (8 * min(len(a), len(b))) <= jaccard._apart(a, b) <= apart


def test_jaccard_of_odd_rows(odd, none):
    rows = jaccard.jaccard_groups(odd, 3, 9, 10).collect()
    assert len(rows) == len(ODD)
    found = {r.doc_id: r for r in rows}
    assert [found[i].n_shingles for i in (1, 2, 3, 4)] == [0, 0, 0, 1]
    assert found[6].component_id == 5 and found[12].component_id == 4 and found[None].component_id is None
    assert jaccard.jaccard_groups(none).count() == 0


# vectors

def test_vectors(spark):
    rng = np.random.default_rng(3)
    base = rng.standard_normal((300, 20))
    near = base[:60] + 0.05 * rng.standard_normal((60, 20))
    rows = [(k, v.tolist()) for k, v in enumerate([*base, *near, *base[:10]])]
    bad = [None, [], [0.0] * 20, [None] + [1.0] * 19, [float("nan")] * 20, [float("inf")] + [0.0] * 19, base[0][:7].tolist()]
    rows += [(1000 + k, v) for k, v in enumerate(bad)] + [(None, base[0].tolist()), rows[0]]
    frame = spark.createDataFrame(rows, "vec_id long, embedding array<double>").selectExpr("*", "1 AS id", "2 AS `list`", "3 AS copies")
    unit = np.array([v for i, v in rows[:370]])
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    link = unit @ unit.T >= 0.95
    np.fill_diagonal(link, False)
    out = vectors.near_duplicates(frame).collect()
    assert len(out) == len(rows)
    found = {r.vec_id: r for r in out}
    top = list(range(370))
    for a, b in zip(*np.nonzero(link), strict=True):
        low, high = sorted((top[a], top[b]))
        top = [low if t == high else t for t in top]
    counts = link.sum(1)
    assert sum(found[k].n_links for k in range(370)) >= 0.97 * counts.sum()
    assert all(found[k].n_links <= counts[k] and found[k].component_id == top[k] and found[k].kept == (top[k] == k) for k in range(370))
    assert all(found[1000 + k].n_links == 0 and found[1000 + k].component_id == 1000 + k for k in range(7))
    assert vectors.near_duplicates(frame.limit(0)).count() == 0


def test_a_longer_vector_outside_the_sample(spark, monkeypatch):
    monkeypatch.setattr(vectors, "SAMPLE", 64)
    order = [r.id for r in spark.range(300).selectExpr("id", "xxhash64(id) AS h").orderBy("h", "id").collect()]
    rng = np.random.default_rng(9)
    rows = {k: rng.standard_normal(8).tolist() for k in range(300)}
    # longer ones: one that begins like a short one, one that begins with zeros, and two that are near each other
    like, zeros, one, two = order[-4:]
    rows[like] = rows[order[0]] + [5.0] * 8
    rows[zeros] = [0.0] * 8 + [1.0, -1.0] * 4
    rows[one] = [1.0] * 8 + [-1.0] * 8
    rows[two] = [1.0] * 8 + [-1.01] * 8
    frame = spark.createDataFrame(list(rows.items()), "vec_id long, embedding array<double>")
    found = {r.vec_id: r for r in vectors.near_duplicates(frame).collect()}
    unit = {k: np.array(v) / np.linalg.norm(v) for k, v in rows.items()}
    links = {k: sum(len(unit[j]) == len(unit[k]) and j != k and unit[j] @ unit[k] >= 0.95 for j in rows) for k in rows}
    assert all(found[k].n_links == links[k] for k in (like, zeros, one, two)) and links[one] == 1 and links[like] == 0


def test_recall_of_links(spark):
    sf = "/root/testdata/sf0.1"
    x = spark.read.parquet(f"{sf}/embeddings.parquet").toPandas()
    unit = np.stack(x.embedding).astype(float)
    unit /= np.linalg.norm(unit, axis=1)[:, None]
    links = (unit @ unit.T >= 0.95).sum() - len(unit)
    assert vectors.op9_embedding_near_dedup(spark, sf).agg({"n_links": "sum"}).first()[0] >= 0.99 * links


# substrings

def test_substrings_of_odd_rows(spark, odd, none):
    rows = substrings.deduplicated(odd).collect()
    assert len(rows) == len(ODD)
    found = {r.doc_id: r for r in rows}
    digest = lambda t: hashlib.sha256(t.encode()).hexdigest()
    assert (found[5].n_removed, found[6].n_removed, found[None].n_removed) == (0, 60, 0)
    assert found[7].n_removed == 60 and found[7].kept_sha256 == digest(prose(2, 30) + " " + prose(3, 30))
    assert (found[1].n_words, found[1].kept_sha256) == (0, digest("")) and found[8].n_removed == 0
    factors = {(r.doc_id, r.first_word, r.n_words, r.ref_doc_id) for r in substrings.factors(odd).collect()}
    assert factors == {(6, 0, 60, 5), (7, 30, 60, 5)}
    assert substrings.deduplicated(none).count() == 0
