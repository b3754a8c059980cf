"""Token ids against the library, dominance against exhaustive packing, and gapless sequences."""

import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from tradescope.llm import packing
from tradescope.llm.packing import best_fit, dominant_sets, pack_documents, plan, runs_of, word_tokens

FILE = public_tokenizers.path("word_bpe_49k.json")
LIBRARY = Tokenizer.from_file(FILE)
LIBRARY.encode_special_tokens = True


def library_ids(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids


ALPHABET = st.one_of(st.sampled_from("aabcdethe  'sST \t\n\r\x0b\x1c\x85\xa0.,-_09Éüİß漢한😀́|Σς<>"), st.characters(exclude_categories=("Cs",)))


@settings(max_examples=300, deadline=None)
@given(st.text(alphabet=ALPHABET, max_size=60))
def test_ids_as_library(text):
    assert word_tokens(FILE).token_bytes(text) == np.array(library_ids(text), dtype="<u4").tobytes()


def test_special_strings_are_ordinary_text():
    assert word_tokens(FILE).token_bytes("a<|endoftext|> b") == np.array(library_ids("a<|endoftext|> b"), dtype="<u4").tobytes()


def total(patterns):
    out = Counter()
    for pattern, times in patterns:
        for length, copies in pattern:
            out[length] += copies * times
    return dict(out)


def fewest(items, capacity):
    """Exact bin packing by depth-first search."""
    items, best = sorted(items, reverse=True), [len(items)]

    def go(k, bins):
        if len(bins) >= best[0]:
            return
        if k == len(items):
            best[0] = len(bins)
            return
        for i in range(len(bins)):
            if bins[i] + items[k] <= capacity and bins[i] not in bins[:i]:
                go(k + 1, [*bins[:i], bins[i] + items[k], *bins[i + 1 :]])
        go(k + 1, [*bins, items[k]])

    go(0, [])
    return best[0]


@settings(max_examples=120, deadline=None)
@given(st.lists(st.integers(1, 20), min_size=1, max_size=9))
def test_dominant_sets_keep_a_best_packing(items):
    counts = np.bincount(items, minlength=21).astype(np.int64)
    fixed, rest = dominant_sets(counts, 20)
    left = [x for x in range(21) for _ in range(int(rest[x]))]
    assert total(fixed) == {k: v for k, v in Counter(items).items() if v - rest[k]} | {k: int(v - rest[k]) for k, v in Counter(items).items() if v - rest[k]}
    assert all(sum(a * b for a, b in p) <= 20 for p, _ in fixed)
    assert sum(t for _, t in fixed) + fewest(left, 20) == fewest(items, 20)


def test_plan_holds_everything_and_is_tight():
    r = np.random.default_rng(4)
    sizes = np.minimum(4096, np.exp(r.normal(6, 1.4, 20000)).astype(int) + 1)
    histogram = {int(k): int(v) for k, v in zip(*np.unique(sizes, return_counts=True), strict=True)}
    patterns = plan(histogram)
    assert total(patterns) == histogram
    assert all(0 < sum(a * b for a, b in p) <= 4096 for p, _ in patterns)
    assert sum(t for _, t in patterns) <= -(-int(sizes.sum()) // 4096) * 1.005 + 1


@settings(max_examples=60, deadline=None)
@given(st.dictionaries(st.integers(1, 30), st.integers(1, 40), max_size=12))
def test_best_fit_holds_everything(histogram):
    counts = np.zeros(31, dtype=np.int64)
    for k, v in histogram.items():
        counts[k] = v
    patterns = best_fit(counts, 30)
    assert total(patterns) == histogram
    assert all(sum(a * b for a, b in p) <= 30 for p, _ in patterns)


def test_runs_cover_every_rank():
    runs = runs_of([(((5, 2), (3, 1)), 4), (((3, 3),), 2)])
    assert runs["length"].tolist() == [3, 3, 5]
    assert (runs["code"] & ((1 << 44) - 1)).tolist() == [0, 4, 0]


def check(rows, texts, capacity=4096):
    """Every document in whole pieces, every sequence gapless from 0."""
    ids = [library_ids(t) + [1] for t in texts]
    want = Counter(
        (k // capacity, k, len(p), zlib.crc32(np.array(p, dtype="<u4").tobytes()))
        for d in ids
        for k in range(0, len(d), capacity)
        for p in [d[k : k + capacity]]
    )
    assert Counter((r.piece, r.start, r.length, r.ids_crc32) for r in rows) == want
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        at = 0
        for offset, length in sorted(parts):
            assert offset == at
            at += length
        assert at <= capacity
    return len(sequences)


def test_small_tables(spark):
    rnd = random.Random(2)
    texts = [None, "", "", "word " * 9000, "same text", "same text"] + [" ".join("abc" for _ in range(rnd.randint(1, 900))) for _ in range(60)]
    df = spark.createDataFrame([(k if k != 3 else None, t, 1, "x") for k, t in enumerate(texts)] + [(5, "same text", 1, "x")], "doc_id long, text string, piece int, length string")
    rows = pack_documents(df, FILE).collect()
    n = check(rows, [*texts, "same text"])
    tokens = sum(r.length for r in rows)
    assert n <= -(-tokens // 4096) + 1
    assert sum(r.doc_id is None for r in rows) == 3


def test_shared_length_is_split(spark, monkeypatch):
    monkeypatch.setattr(packing, "RANKED_TOGETHER", 7)
    df = spark.createDataFrame([(k, "one two three") for k in range(300)], "doc_id long, text string")
    check(pack_documents(df, FILE, capacity=13).collect(), ["one two three"] * 300, 13)


def test_empty_table(spark):
    out = pack_documents(spark.createDataFrame([], "doc_id long, text string"), FILE)
    assert out.columns == ["doc_id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
    assert out.count() == 0


UNTOUCHED = Tokenizer.from_file(FILE)
SPECIAL = st.lists(st.one_of(st.sampled_from(["<|endoftext|>", "<|startoftext|>", "<|ENDOFTEXT|>", "<|end", "oftext|>", "<", "|>", " ", "\n", "Ab", "é", "\u0301", "9", "'s"]), st.text(alphabet=ALPHABET, max_size=3)), max_size=10).map("".join)


@settings(max_examples=300, deadline=None)
@given(SPECIAL)
def test_ids_as_the_untouched_library(text):
    want = UNTOUCHED.encode(text, add_special_tokens=False).ids
    assert word_tokens(FILE, special_ids=True).token_bytes(text) == np.array(want, dtype="<u4").tobytes()


def test_pieces_as_the_untouched_library(spark):
    texts = ["end of text <|endoftext|> next", "a<|endoftext|>b", "<|startoftext|>x.", "<|ENDOFTEXT|> plain"]
    rows = pack_documents(spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string"), FILE).collect()
    want = {k: UNTOUCHED.encode(t, add_special_tokens=False).ids + [1] for k, t in enumerate(texts)}
    assert {r.doc_id: (r.length, r.ids_crc32) for r in rows} == {k: (len(x), zlib.crc32(np.array(x, dtype="<u4").tobytes())) for k, x in want.items()}
    assert len(want[0]) == 6


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001"])
def test_query(spark, sf):
    from tradescope.llm.queries import QUERIES

    rows = QUERIES["op4_best_fit_packing"](spark, sf).collect()
    texts = {r.doc_id: r.text for r in spark.read.parquet(f"{sf}/documents.parquet").collect()}
    n = check(rows, texts.values())
    assert {r.doc_id for r in rows} == set(texts)
    assert n <= -(-sum(r.length for r in rows) // 4096) + 1
