"""Held-out accuracy, mixtures, the counting of trigrams against a plain loop, and edge cases."""

import itertools
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradescope.llm import language_id as L

SF = "/root/testdata/sf0.01"


def test_trigrams_as_a_plain_loop():
    texts = ["", "a", "Ab, c1", "été  là", "...", "xyz"]
    bucket, counts = L.trigrams(texts)
    assert counts.tolist() == [0, 1, 3, 5, 0, 3]
    at = 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        alone, _ = L.trigrams([t])
        assert bucket[at : at + n].tolist() == alone.tolist()
        at += n
    # A blank is whatever is no letter, and case does not count.
    assert L.trigrams(["A b"])[0].tolist() == L.trigrams(["a.b"])[0].tolist()


@pytest.fixture(scope="module")
def docs(spark):
    return spark.read.parquet(f"{SF}/documents.parquet")


@pytest.fixture(scope="module")
def model(docs):
    return L.fit(docs.where(~L.held_out(F.col("doc_id"))).select("lang", "text"))


def test_counts_cover_every_labelled_row(docs, model):
    rows = [r for r in docs.select("doc_id", "lang", "text").collect() if zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    for k, lang in enumerate(model.languages):
        count = np.bincount(np.concatenate([L.trigrams([r.text])[0] for r in rows if r.lang == lang]), minlength=L.BUCKETS) + L.SMOOTHING
        assert np.allclose(model.likelihood[:, k], count / count.sum(), rtol=1e-5)


def test_held_out_accuracy(spark, docs):
    from tradescope.llm.queries import QUERIES

    got = {r.doc_id: r for r in QUERIES["op10_language_id"](spark, SF).collect()}
    truth = {r.doc_id: r.lang for r in docs.select("doc_id", "lang").collect()}
    assert got.keys() == truth.keys()
    assert all(r.held_out == (zlib.crc32(str(i).encode()) % 4 == 2) for i, r in got.items())
    unseen = [i for i, r in got.items() if r.held_out]
    assert len(unseen) > 200 and sum(got[i].lang_pred == truth[i] for i in unseen) >= 0.98 * len(unseen)
    assert all(0 <= r.score <= 1 for r in got.values())


def test_held_out_labels_and_other_columns_play_no_part(spark, docs):
    mine = docs.withColumn("lang", F.when(L.held_out(F.col("doc_id")), "xx").otherwise(F.col("lang"))).withColumn("source", F.lit("q"))
    a = {tuple(r) for r in L.identify(docs.limit(300)).collect()}
    assert a == {tuple(r) for r in L.identify(mine.limit(300)).collect()}


def test_mixture_of_two_languages(model, docs):
    texts = {r.lang: r.text for r in docs.where("n_chars BETWEEN 1500 AND 3000").select("lang", "text").collect()}
    (found,) = L.language_sets(model, [texts["de"][:1400] + " " + texts["fr"][:700]])
    assert [x for x, _ in found] == ["de", "fr"] and 0.5 < found[0][1] < 0.85
    (alone,) = L.language_sets(model, [texts["es"]])
    assert alone == [("es", 1.0)]
    together = L.language_sets(model, [texts["de"], "", texts["fr"], "12"])
    assert [x[0][0] if x else None for x in together] == ["de", None, "fr", None]


ROWS = [(1, "the cat and the dog", "en"), (3, "le chat et le chien", "fr"), (6, None, "en"), (7, "", "en"), (8, "123 !!", "en"), (9, "the dog", None), (9, "the dog", None), (None, "the cat", None), (10, "the " * 60_000, None)]


def test_rows(spark):
    df = spark.createDataFrame([(i, t, x, 1.0) for i, t, x in ROWS], "doc_id long, text string, lang string, score double")
    out = L.identify(df)
    assert out.columns == ["doc_id", "held_out", "lang_pred", "score", "languages"]
    got = sorted([(r.doc_id, r.lang_pred) for r in out.collect()], key=str)
    assert got == sorted([(1, "en"), (3, "fr"), (6, "und"), (7, "und"), (8, "und"), (9, "en"), (9, "en"), (None, "en"), (10, "en")], key=str)
    kept = L.keep_identified(df)
    assert kept.columns == df.columns
    assert Counter(str(r.doc_id) for r in kept.collect()) == Counter(["1", "3", "9", "9", "None", "10"])


def test_nothing_to_learn(spark):
    df = spark.createDataFrame([(1, "text", None)], "doc_id long, text string, lang string")
    assert [(r.lang_pred, r.score) for r in L.identify(df).collect()] == [("und", 0.0)]
    assert L.identify(df.limit(0)).count() == 0 and L.keep_identified(df.limit(0)).count() == 0


def test_without_labels_texts_with_letters_stay(spark):
    df = spark.createDataFrame([(1, "plain English", None), (2, "more of it", None), (3, "12", None), (4, None, None), (None, "é", None)], "doc_id long, text string, lang string")
    assert Counter(str(r.doc_id) for r in L.keep_identified(df).collect()) == Counter(["1", "2", "None"])


def plain_sets(model, text):
    """The best set of languages by trying all, with an EM of its own (plain loops, thousands of steps)."""
    bucket, _ = L.trigrams([text])
    p = model.likelihood[bucket].astype(np.float64)
    price = L.PENALTY * 0.5 * np.log(len(bucket) + 1)
    best = None
    for size in range(1, len(model.languages) + 1):
        for chosen in itertools.combinations(range(len(model.languages)), size):
            q, share = p[:, chosen], np.full(size, 1 / size)
            for _ in range(3000 if size > 1 else 1):
                joint = q * share
                share = (joint / joint.sum(axis=1, keepdims=True)).mean(axis=0)
            value = np.log((q * share).sum(axis=1)).sum() - price * (size - 1)
            if best is None or value > best[0]:
                best = value, {model.languages[j]: s for j, s in zip(chosen, share.tolist(), strict=True)}
    return best[1]


def test_sets_and_shares_as_trying_all_sets(model, docs):
    texts = {r.lang: r.text for r in docs.where("n_chars BETWEEN 1500 AND 3000").select("lang", "text").collect()}
    langs = sorted(texts)
    mixed = [texts[a][:x] + " " + texts[b][:y] for a in langs for b in langs for x, y in ((300, 40), (300, 300), (90, 20))]
    mixed += [" ".join(texts[x][:200] for x in langs), " ".join(texts[x][:60] for x in langs[:3]), "a", "hé hé"]
    for text, found in zip(mixed, L.language_sets(model, mixed), strict=True):
        want = plain_sets(model, text)
        assert dict(found).keys() == want.keys()
        assert all(abs(dict(found)[x] - s) < 0.02 for x, s in want.items())
