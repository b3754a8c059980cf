"""Merge rounds against the library: ids and decoded texts must be the same."""

import random

import public_tokenizers
import pytest
import sentencepiece
from hypothesis import given, settings
from hypothesis import strategies as st

from tradescope.llm.common import sha256_hex
from tradescope.llm.sentencepiece_bpe import encode_documents, encoder, groups_by_size, round_trip

MODEL = public_tokenizers.path("piece_bpe_32k.model")
SP = sentencepiece.SentencePieceProcessor(model_file=MODEL)


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=st.one_of(st.sampled_from("aabcdethe   \t\n.,-_▁0123456789ABé漢字"), st.characters(exclude_categories=("Cs",))), max_size=80))
def test_same_ids_as_library(text):
    assert encoder(MODEL).encode([text])[0] == SP.encode(text)


def test_runs_and_long_words():
    rnd = random.Random(5)
    texts = [" " * k + tail for k in range(70) for tail in ("", "the")]
    texts += ["a" * 20000, "ab" * 9999, "".join(rnd.choice("ABCDEFabcdef0123456789+/") for _ in range(5000)), "漢字" * 3000]
    for t in texts:
        assert encoder(MODEL).encode([t])[0] == SP.encode(t)


def test_cache_is_bounded(monkeypatch):
    import tradescope.llm.sentencepiece_bpe as m

    monkeypatch.setattr(m, "CACHE_WORDS", 50)
    e = m.MergeEncoder(MODEL)
    texts = [f"word{k} thing{k} other" for k in range(200)]
    for t in texts:
        assert e.encode([t])[0] == SP.encode(t)
        assert len(e.cache) <= 60


def test_groups_by_size():
    assert groups_by_size([]) == []
    assert groups_by_size(["aaaa", "b", "c"], 3) == [(0, 1), (1, 3)]


def _want(doc_id, text):
    ids = SP.encode(text or "")
    return (doc_id, len(ids), sha256_hex(",".join(map(str, ids))), sha256_hex(SP.decode(ids)))


def test_round_trip_rows(spark):
    rows = [(1, "Hello  world"), (1, "Hello  world"), (2, None), (3, ""), (None, "x\x00y\tz"), (4, "é" * 30000 + " end")]
    df = spark.createDataFrame([(i, t, "n", 7) for i, t in rows], "doc_id long, text string, n_tokens string, ids int")
    got = sorted(map(tuple, round_trip(df, MODEL).collect()), key=str)
    assert got == sorted((_want(*r) for r in rows), key=str)
    assert encode_documents(df, MODEL).where("doc_id = 2").first().ids == []


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert round_trip(df, MODEL).columns == ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
    assert round_trip(df, MODEL).count() == 0


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query_against_library(spark, sf):
    from tradescope.llm.queries import QUERIES

    docs = spark.read.parquet(f"{sf}/documents.parquet").select("doc_id", "text").collect()
    got = sorted(map(tuple, QUERIES["op9_sentencepiece"](spark, sf).collect()))
    assert got == sorted(_want(r.doc_id, r.text) for r in docs)
