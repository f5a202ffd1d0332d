import zlib

import numpy as np
import pytest
from helpers import SHAPE, documents, odd_rows

from revspine.llm import language_id, queries
from revspine.llm.common import bounded_sample, table
from revspine.llm.language_id import ORDERS, Spectrum, classify, fit, identify, predict, train

SAMPLE = [(" ".join(p for _ in range(5)), lang) for lang, ps in {"en": ["the cat and the dog", "this is that thing", "of what they were"], "de": ["der hund und die katze", "das ist nicht gut", "ich habe ein haus"], "fr": ["le chat et la souris", "ce n'est pas bon", "nous avons une maison"]}.items() for p in ps]


def _grams(text):
    data = text.lower().encode()
    return {data[k : k + n] for n in ORDERS for k in range(len(data) - n + 1)}


def test_presence_products_are_the_kernel():
    marks = [t for t, _ in SAMPLE]
    s = Spectrum.of(marks)
    vocabulary = set().union(*map(_grams, marks))
    assert s.size == len(vocabulary)
    texts = ["The dog, the house", "x", "", "äöü und", "n'est"]
    k = s.presence(texts) @ s.presence(marks).T
    for i, t in enumerate(texts):
        for j, m in enumerate(marks):
            a, b = _grams(t) & vocabulary, _grams(m)
            want = len(a & b) / np.sqrt(max(1, len(a)) * len(b))
            assert abs(k[i, j] - want) < 1e-5


def test_batches_do_not_mix_texts():
    model = train(SAMPLE)
    s = Spectrum(model["vocabulary"])
    texts = ["the dog", "die katze", "", None, "123 ...", "la souris", "the dog"]
    assert predict(model, s, texts) == tuple(list(x) for x in zip(*[(a[0], b[0]) for a, b in (predict(model, s, [t]) for t in texts)], strict=True))
    assert predict(model, s, texts)[0] == ["en", "de", "und", "und", "und", "fr", "en"]


def test_scores_are_those_of_plain_kernel_ridge_regression():
    """Kernels from sets of n-grams, the same regression solved on them without presence matrices."""
    model = train(SAMPLE)
    marks = [t for t, _ in SAMPLE]
    vocabulary = set().union(*map(_grams, marks))

    def kernel(a, b):
        x, y = _grams(a) & vocabulary, _grams(b) & vocabulary
        return len(x & y) / np.sqrt(max(1, len(x)) * max(1, len(y)))

    languages = sorted({lang for _, lang in SAMPLE})
    texts = marks + [language_id._short(t) for t in marks]
    labels = [lang for _, lang in SAMPLE] * 2
    mm = np.array([[kernel(a, b) for b in marks] for a in marks])
    nm = np.array([[kernel(a, b) for b in marks] for a in texts])
    values, vectors = np.linalg.eigh(mm)
    root = vectors / np.sqrt(np.maximum(values, 1e-6 * values.max()))
    x = np.hstack([nm @ root, np.ones((len(nm), 1))])
    y = np.array([[1.0 if lang == want else -1.0 for want in languages] for lang in labels])
    weight = np.array([[1 / labels.count(lang)] for lang in labels])
    penalty = language_id.RIDGE * np.eye(x.shape[1]) * len(languages) / x.shape[1]
    penalty[-1, -1] = 0
    w = np.linalg.solve(x.T @ (weight * x) + penalty, x.T @ (weight * y))
    s = Spectrum(model["vocabulary"])
    for text in ["the dog is here", "die maus und der hund", "une souris", "xyz", "Das Haus " * 50]:
        z = np.array([kernel(text, m) for m in marks]) @ root @ w[:-1] + w[-1]
        p = np.exp(language_id.SHARPNESS * (z - z.max()))
        p /= p.sum()
        (lang,), (score,) = predict(model, s, [text])
        assert lang == languages[int(p.argmax())] and abs(score - p.max()) < 1e-4, text


def test_scores_do_not_depend_on_the_batch(spark):
    rows = table(spark, "/root/testdata/sf0.01", "documents").where("lang IS NOT NULL").limit(400).collect()
    model = train([(r.text[:3000], r.lang) for r in rows[:120] if r.text])
    s = Spectrum(model["vocabulary"])
    texts = [r.text for r in rows]
    whole = list(zip(*predict(model, s, texts), strict=True))
    for step in (1, 7, 64):
        assert whole == [x for lo in range(0, len(texts), step) for x in zip(*predict(model, s, texts[lo : lo + step]), strict=True)]


def test_signs_that_are_numbers_are_no_letters():
    model = train(SAMPLE)
    assert predict(model, Spectrum(model["vocabulary"]), ["½ ² ① Ⅷ", "ª", "Ⅷ a"])[0][0] == "und"
    assert "und" not in predict(model, Spectrum(model["vocabulary"]), ["ªª", "x Ⅷ"])[0]


@pytest.mark.parametrize("ids", ["CAST(NULL AS BIGINT)", "CAST(770 AS BIGINT)", "doc_id"])
def test_any_ids_give_a_bounded_sample(spark, ids, monkeypatch):
    """Rows with NULL ids, or one id for all, teach like others, and the driver gets no more than the bound."""
    received = []
    monkeypatch.setattr(language_id, "train", lambda sample: received.extend(sample) or train(sample))
    rows = [(k, f"{SAMPLE[k % 9][0]} number {k % 500}" if k % 4 else SAMPLE[0][0], SAMPLE[k % 9][1] if k % 4 else "en") for k in range(4000)]
    df = documents(spark, rows).selectExpr(f"{ids} AS doc_id", "text", "lang", "source", "n_chars")
    model = fit(df, per_language=40)
    assert model["languages"] == ["de", "en", "fr"]
    assert len(received) == len(set(received)) == 120  # copies of a text teach once


def test_a_language_of_long_texts_is_learned(spark):
    long_ = [(k, "wort und haus " * 3000 + str(k), "de") for k in range(6)] + [(10 + k, f"the cat {k}", "en") for k in range(6)]
    model = fit(documents(spark, long_))
    assert model["languages"] == ["de", "en"]
    assert predict(model, Spectrum(model["vocabulary"]), ["haus und wort"])[0] == ["de"]


def test_odd_rows(spark):
    df = documents(spark, odd_rows() + [(30, "the cat", "en"), (31, "die katze ist", "de")])
    got = classify(df.selectExpr("*", "text AS score", "1 AS _text")).collect()
    assert len(got) == len(odd_rows()) + 2
    by = {r.doc_id: r for r in got}
    assert by[2].lang_pred == "und" and by[2].score == 0.0 and all(0 <= r.score <= 1 for r in got)
    assert all(r.held_out == (r.doc_id is not None and zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert classify(spark.createDataFrame([], SHAPE)).count() == 0
    unlabelled = df.selectExpr("doc_id", "text", "CAST(NULL AS STRING) lang", "source", "n_chars")
    assert {r.lang_pred for r in classify(unlabelled).collect()} == {"und"}


def test_identify_keeps_columns(spark):
    df = documents(spark, [(1, "the cat", "en"), (2, None)]).selectExpr("*", "array(doc_id) AS c0", "named_struct('a', 1) AS lang_pred")
    got = identify(df, fit(df)).collect()
    assert [tuple(r)[:-2] for r in sorted(got)] == [tuple(r) for r in sorted(df.collect())]


def test_held_out_labels_are_not_read(spark):
    df = documents(spark, [(k, SAMPLE[k % 9][0], SAMPLE[k % 9][1]) for k in range(60)])
    flipped = df.selectExpr("doc_id", "text", "IF(crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 4 = 2, 'xx', lang) AS lang", "source", "n_chars")
    assert sorted(map(tuple, classify(df).collect())) == sorted(map(tuple, classify(flipped).collect()))


def test_held_out_accuracy(spark):
    sf = "/root/testdata/sf0.1"
    got = queries.op5_language_id(spark, sf).join(table(spark, sf, "documents").select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(got) > 2000 and sum(r.lang == r.lang_pred for r in got) / len(got) >= 0.99


@pytest.mark.parametrize("bound", [1, 7, 300])
def test_bounded_sample_is_that_of_the_smallest_hashes(spark, bound):
    """Copies, many classes and few texts: exactly the bound, or all there are."""
    rows = [(f"c{k % 3}", f"text {k % 2500}") for k in range(9000)] + [("c0", "copy")] * 4000 + [("few", "one"), ("few", "two"), ("few", "one")]
    df = spark.createDataFrame(rows, "lang string, text string").repartition(6)
    hashes = {r.text: r.h for r in df.selectExpr("text", "xxhash64(5, text) AS h").distinct().collect()}
    want = sorted((c, *x) for c in ("c0", "c1", "c2", "few") for x in sorted({(hashes[t], t) for k, t in rows if k == c})[:bound])
    assert sorted((r.lang, r._h, r.text) for r in bounded_sample(df, "text", bound, 5, ("lang",)).collect()) == want
    every = sorted({(hashes[t], t) for _, t in rows})[:bound]
    assert sorted((r._h, r.text) for r in bounded_sample(df, "text", bound, 5).collect()) == every
