"""Signatures against exact similarity, classes against all-pairs brute force, and edge cases."""

import itertools
import random
import re
from collections import Counter

import numpy as np
import pytest

from tradescope.llm import near_dedup as N

SF = "/root/testdata/sf0.001"


def plain_shingles(text):
    words = re.findall(r"\w+", text.lower()) or ([text.lower()] if text else [])
    return Counter(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else Counter()


def plain_similarity(a, b):
    low, high = sum((a & b).values()), sum((a | b).values())
    return low / high if high else 1.0


def brute_groups(rows, threshold=0.8):
    """A number of each row's connected component, over all pairs."""
    bags = [plain_shingles(t or "") for _, t in rows]
    up = list(range(len(rows)))

    def top(k):
        while up[k] != k:
            k = up[k]
        return k

    for i, j in itertools.combinations(range(len(rows)), 2):
        if plain_similarity(bags[i], bags[j]) >= threshold:
            up[top(j)] = top(i)
    return [top(k) for k in range(len(rows))]


def brute_classes(rows, threshold=0.8):
    """Least id of each row's connected component."""
    groups, least = brute_groups(rows, threshold), {}
    for (doc_id, _), g in zip(rows, groups, strict=True):
        if doc_id is not None:
            least[g] = min(doc_id, least.get(g, doc_id))
    return sorted(((doc_id, least.get(g)) for (doc_id, _), g in zip(rows, groups, strict=True)), key=str)


def noisy(rnd, words, share):
    return " ".join(rnd.choice(["alpha", "beta", "gamma"]) + str(rnd.randint(0, 999)) if rnd.random() < share else w for w in words)


def test_exact_similarity():
    rnd = random.Random(1)
    words = [f"w{rnd.randint(0, 40)}" for _ in range(200)]
    texts = ["", "?!", "one", "One two.", "a b c d e", "a b c d e f", " ".join(words), noisy(rnd, words, 0.02), " ".join(["x y"] * 50), " ".join(["x y"] * 40)]
    for a, b in itertools.product(texts, texts):
        assert N.similarity(N.shingle_counts(a), N.shingle_counts(b)) == pytest.approx(plain_similarity(plain_shingles(a), plain_shingles(b)))


def test_chunks_do_not_matter():
    texts = ["", "a b", "?", "c d e f g h", "", "été là"]
    hashes, counts = N.word_hashes(texts)
    assert counts.tolist() == [0, 2, 1, 6, 0, 2]
    at = 0
    for t, n in zip(texts, counts.tolist(), strict=True):
        assert hashes[at : at + n].tolist() == N.word_hashes([t])[0].tolist()
        at += n


def test_signature_is_unbiased_for_weights():
    """Many independent shingle sets with weights up to 60: the share of equal components is the weighted similarity."""
    rng = np.random.default_rng(3)
    n, share, exact = 40, [], []
    for _ in range(150):
        shingle = np.sort(rng.integers(0, 2**63, n).astype(np.uint64))
        a, b = rng.integers(0, 61, n), rng.integers(0, 61, n)
        b = np.where(rng.random(n) < 0.5, a, b)
        rows = [np.flatnonzero(x) for x in (a, b)]
        text = np.repeat([0, 1], [len(r) for r in rows])
        s = N.signatures(text, np.concatenate([shingle[r] for r in rows]), np.concatenate([a[rows[0]], b[rows[1]]]), 2)
        share.append((s[0] == s[1]).mean())
        exact.append(np.minimum(a, b).sum() / np.maximum(a, b).sum())
    assert np.isfinite(share).all() and abs(np.mean(share) - np.mean(exact)) < 0.01
    assert abs(np.corrcoef(share, exact)[0, 1]) > 0.8


@pytest.fixture(scope="module")
def rows():
    rnd = random.Random(11)
    out, doc = [], 100

    def add(text):
        nonlocal doc
        doc += 1
        out.append((doc, text))

    hub = [f"h{rnd.randint(0, 5000)}" for _ in range(160)]
    for _ in range(60):  # a large loose group, most of it linked, some of it not
        add(noisy(rnd, hub, rnd.choice([0.005, 0.01, 0.02, 0.05])))
    chain = [f"c{k}" for k in range(200)]
    for k in range(12):  # a chain: neighbours are near, its ends are not
        chain = [f"n{k}x{i}" if k * 8 <= i < k * 8 + 8 else w for i, w in enumerate(chain)]
        add(" ".join(chain))
    for _ in range(30):
        add(" ".join(f"u{rnd.randint(0, 9999)}" for _ in range(rnd.randint(1, 80))))
    out += [(1, None), (2, ""), (3, "?!"), (4, "?!"), (5, "Same words here."), (6, "same WORDS, here"), (6, "same WORDS, here"), (7, "tiny"), (7, "other text of the same id"), (8, "word " * 30_000), (9, "word " * 30_001)]
    out += [(None, "same words here"), (None, "nobody else says this"), (None, "nobody else says this")]
    return out


@pytest.mark.parametrize("small_bucket", [24, 2])
def test_classes_as_brute_force(spark, rows, monkeypatch, small_bucket):
    monkeypatch.setattr(N, "SMALL_BUCKET", small_bucket)
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, content string, bucket int").repartition(3)
    got = sorted(((r.doc_id, r.class_id) for r in N.near_duplicates(df).collect()), key=str)
    assert got == brute_classes(rows)


def test_keep_one(spark, rows):
    df = spark.createDataFrame([(i, t, "c", 1) for i, t in rows], "doc_id long, text string, content string, n long")
    out = N.keep_one(df)
    assert out.columns == df.columns
    # One row per component: its least id, or a row without an id. Unlike texts under one id both stay.
    least = {}
    for (doc_id, _), g in zip(rows, brute_groups(rows), strict=True):
        least[g] = min((i for i in (doc_id, least.get(g)) if i is not None), default=None)
    kept = [(r.doc_id, r.text) for r in out.collect()]
    assert Counter(i for i, _ in kept) == Counter(least.values())
    assert {t for i, t in kept if i == 7} == {"tiny", "other text of the same id"}
    assert all(row in rows for row in kept)


def test_unlike_texts_under_one_id_and_near_copies_without_ids(spark):
    long = " ".join(f"w{k}" for k in range(200))
    rows = [(7, "text a"), (7, "quite another b"), (8, "text a"), (None, long), (None, long + " end"), (None, long + " end"), (None, "alone without id"), (9, "again"), (9, "again")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    kept = sorted([(r.doc_id, r.text) for r in N.keep_one(df).collect()], key=str)
    assert [t for i, t in kept if i == 7] == ["quite another b", "text a"] and (8, "text a") not in kept
    assert sum(t.startswith(long) for _, t in kept) == 1 and (None, "alone without id") in kept and kept.count((9, "again")) == 1
    assert len(kept) == 5
    assert sum(r.kept for r in N.near_duplicates(df).collect()) == sum(Counter(rows)[x] for x in kept)


def test_links_are_verified(spark, rows):
    df = spark.createDataFrame(rows, "doc_id long, text string")
    classed, links = N.near_classes(df)
    text = {r.content: t for r in classed.collect() for i, t in rows if i == r.doc_id and N.shingle_counts(t or "")[2] == r.content}
    for r in links.collect():
        assert r.similarity >= 0.8
        assert r.similarity == pytest.approx(plain_similarity(plain_shingles(text[r.a]), plain_shingles(text[r.b])))


def test_components_of_a_long_path(spark):
    key = lambda k: k.to_bytes(4, "big")
    rnd = random.Random(4)
    order = list(range(120))
    rnd.shuffle(order)
    df = spark.createDataFrame([(bytearray(key(a)), bytearray(key(b))) for a, b in itertools.pairwise(order)], "a binary, b binary")
    assert {(bytes(r.label)) for r in N.components(df).collect()} == {key(0)}


def test_empty_table(spark):
    df = spark.createDataFrame([], "doc_id long, text string")
    assert N.near_duplicates(df).count() == 0 and N.keep_one(df).count() == 0


def test_query_against_brute_force(spark):
    from tradescope.llm.queries import QUERIES

    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    out = QUERIES["op8_near_dedup"](spark, SF).collect()
    assert sorted(((r.doc_id, r.class_id) for r in out), key=str) == brute_classes(docs)
    assert all(r.kept == (r.doc_id == r.class_id) for r in out)


def test_chunks_bound_both_sides(spark, monkeypatch):
    """A bucket whose members are nearly all unlike: no task holds much more than a chunk of either side, and no pair is lost."""
    compare, most = N.close_pairs, 32

    def bounded(outside, members):
        if max(outside.num_rows, members.num_rows) > most:
            raise ValueError(f"{outside.num_rows} rows against {members.num_rows}")
        return compare(outside, members)

    monkeypatch.setattr(N, "CHUNK", most // 4)
    monkeypatch.setattr(N, "close_pairs", bounded)
    rnd = random.Random(5)
    texts = [" ".join(f"w{rnd.randint(0, 9999)}" for _ in range(150)) for _ in range(110)]
    near = [t.rsplit(" ", 1)[0] + " changed" for t in texts[::3]]
    key = {t: N.content_keys(*N.word_hashes([t]))[0] for t in [*texts, *near]}
    linked = texts[1:60:3]  # the largest component
    shared = spark.createDataFrame([(7, bytearray(k), len(key), False, 0, 0, 0, 0) for k in key.values()], f"bucket long, content binary, n long, pivot boolean, {', '.join(f'{s} long' for s in N.SKETCH)}")
    labels = spark.createDataFrame([(bytearray(key[t]), bytearray(b"main")) for t in linked], "node binary, label binary")
    held = spark.createDataFrame([(bytearray(k), t) for t, k in key.items()], "content binary, text string")
    got = [(bytes(r.a), bytes(r.b)) for r in N.left_over_pairs(shared, labels, held).collect()]
    assert len(got) == len(set(got)) and set(got) == {tuple(sorted((key[a], key[b]))) for a, b in zip(texts[::3], near, strict=True)}


@pytest.mark.parametrize("chunk", [3])
def test_classes_in_small_chunks(spark, rows, monkeypatch, chunk):
    monkeypatch.setattr(N, "SMALL_BUCKET", 2)
    monkeypatch.setattr(N, "CHUNK", chunk)
    got = sorted(((r.doc_id, r.class_id) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_classes(rows)


@pytest.mark.parametrize("oversized, chunk", [(4, 2048), (30, 4)])
def test_classes_with_oversized_buckets(spark, rows, monkeypatch, oversized, chunk):
    monkeypatch.setattr(N, "SMALL_BUCKET", 2)
    monkeypatch.setattr(N, "OVERSIZED", oversized)
    monkeypatch.setattr(N, "CHUNK", chunk)
    got = sorted(((r.doc_id, r.class_id) for r in N.near_duplicates(spark.createDataFrame(rows, "doc_id long, text string")).collect()), key=str)
    assert got == brute_classes(rows)


def test_unlike_members_of_a_bucket_do_not_meet(spark, monkeypatch):
    """One bucket of 600 unlike texts and a few near copies: what is compared follows the rows, not their square."""
    compared = spark.sparkContext.accumulator(0)
    compare = N.close_pairs

    def counted(outside, members):
        compared.add(outside.num_rows * members.num_rows)
        return compare(outside, members)

    monkeypatch.setattr(N, "close_pairs", counted)
    monkeypatch.setattr(N, "OVERSIZED", 64)
    rnd = random.Random(6)
    texts = [" ".join(f"w{rnd.randint(0, 9999)}" for _ in range(120)) for _ in range(600)]
    near = [t.rsplit(" ", 1)[0] + " changed" for t in texts[::20]]
    key = {t: N.content_keys(*N.word_hashes([t]))[0] for t in [*texts, *near]}
    shared = spark.createDataFrame([(7, bytearray(k), len(key), False, 0, 0, 0, 0) for k in key.values()], f"bucket long, content binary, n long, pivot boolean, {', '.join(f'{s} long' for s in N.SKETCH)}")
    held = spark.createDataFrame([(bytearray(k), t) for t, k in key.items()], "content binary, text string")
    labels = spark.createDataFrame([], "node binary, label binary")
    got = {(bytes(r.a), bytes(r.b)) for r in N.left_over_pairs(shared, labels, held).collect()}
    assert got == {tuple(sorted((key[a], key[b]))) for a, b in zip(texts[::20], near, strict=True)}
    assert compared.value < 50 * len(key)
