"""Norm-bucket search against plain scoring of every document, its bounds, and the SQL form."""

import math
import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tradescope.llm import lexical_search
from tradescope.llm.lexical_search import Best, chunk_of, impact_vectors, norm_buckets, queries_of, search, search_buckets, search_chunk, statistics, term_vectors, terms_of

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def words(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+", (text or "").translate(LOWER))


def plain(docs, items, k=20):
    """item -> [(doc_id, score)], by scoring every document."""
    held = [(i, Counter(words(t))) for i, t in docs]
    held = [(i, c) for i, c in held if c]
    n, total, df = len(held), sum(sum(c.values()) for _, c in held), Counter(t for _, c in held for t in c)
    out = []
    for item, text in items:
        scores = []
        for doc, c in held:
            m = 75 + 25 * sum(c.values()) * n // total
            s = sum(math.floor(1000 * math.log((2 * n + 2) / (2 * df[t] + 1))) * (10**9 * c[t] // (1000 * c[t] + 12 * m)) for t in words(text) if c[t])
            if s > 0:
                scores.append((doc, s))
        scores.sort(key=lambda x: (-x[1], x[0] is None, x[0]))
        out += [(item, r + 1, doc, s) for r, (doc, s) in enumerate(scores[:k])]
    return sorted(out, key=str)


def got(df):
    return sorted((tuple(r) for r in df.select("item_id", "rank", "doc_id", "score").collect()), key=str)


DOCS = [
    (1, "The quick brown fox"),
    (2, "the THE the lazy dog; quick!"),
    (3, None),
    (4, ""),
    (5, "?!. -"),
    (6, "Ärger İstanbul straße 42 x_y ÄRGER"),
    (7, "fox " * 4000 + "dog"),
    (None, "a fox without an id"),
    (None, "a fox without an id"),
    *[(k, "the same copy of a fox and a dog") for k in range(100, 130)],
    (130, "the same copy of a fox and a dog"),
    (130, "the same copy of a fox and a dog"),
]
ITEMS = [(1, "quick fox"), (2, "fox fox dog"), (3, None), (4, "..."), (5, "ärger ÄRGER straße x y 42"), (6, "unknown words only"), (7, "the"), (7, "dog"), (None, "lazy")]


def frames(spark, docs, items):
    return spark.createDataFrame(docs, "doc_id long, text string"), spark.createDataFrame(items, "item_id long, text string")


def test_terms():
    for text in ["Ab-cD é É x1\x7f\x00y", "漢字 ＡＢ a_b", "", "\x80\x85 z"]:
        assert [t.decode() for t in terms_of(text)] == words(text)


def test_against_plain_scores(spark):
    assert got(search(*frames(spark, DOCS, ITEMS))) == plain(DOCS, ITEMS)


def test_blocks_of_queries_small_chunks_and_clashing_columns(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "BLOCK_CHARS", 40)
    monkeypatch.setattr(lexical_search, "CHUNK", 3)
    docs, items = frames(spark, DOCS, ITEMS)
    clash = docs.withColumn("score", F.lit(0)).withColumn("terms", F.lit("x")).withColumn("bucket", F.lit(1))
    assert got(search(clash, items.withColumn("rank", F.lit("y")).withColumn("query", F.lit(0)), 4)) == plain(DOCS, ITEMS, 4)


@pytest.mark.parametrize("docs, items", [([], ITEMS), (DOCS, []), ([(1, None), (2, "--")], ITEMS), (DOCS, [(1, None)])])
def test_nothing_to_find(spark, docs, items):
    assert search(*frames(spark, docs, items)).collect() == []


def test_random_tables(spark, monkeypatch):
    monkeypatch.setattr(lexical_search, "CHUNK", 16)
    rng = random.Random(3)
    vocabulary = [f"w{int(rng.paretovariate(0.7))}" for _ in range(400)]
    docs = [(k // 2 if k % 5 == 0 else k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 5, 30, 200])))) for k in range(400)]
    items = [(k, " ".join(rng.choices(vocabulary, k=rng.choice([1, 3, 12])))) for k in range(25)]
    assert got(search(*frames(spark, docs, items), 5)) == plain(docs, items, 5)


def test_survivors_are_few_and_bounds_hold(spark):
    """On the driver's documents the buckets after the first score a small part of all pairs, and lose none of the best."""
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    items = spark.read.parquet("/root/testdata/sf0.01/benchmark.parquet")
    queries = queries_of([tuple(r) for r in items.select("item_id", "text").collect()])
    vectors = term_vectors(docs, queries.vocabulary)
    stats = statistics(vectors, len(queries.vocabulary))
    buckets = norm_buckets(impact_vectors(vectors, stats)).cache()
    edges = buckets.groupBy("bucket").agg(F.min("norm").alias("a"), F.max("norm").alias("b")).orderBy("bucket").collect()
    assert len(edges) > 2 and all(x.a >= y.b for x, y in zip(edges, edges[1:], strict=False))
    thresholds = np.full(len(queries.terms), 0)
    full = search_buckets(buckets, queries, stats.weight, thresholds, 20)
    best = {r["query"]: r["min(score)"] for r in lexical_search.best_rows(full, 20).groupBy("query").agg(F.min("score")).collect()}
    known = np.array([best.get(q, 0) for q in range(len(queries.terms))])
    pruned = search_buckets(buckets, queries, stats.weight, known, 20)
    keep = lambda df: sorted(tuple(r) for r in lexical_search.best_rows(df, 20).select("query", "rank", "doc_id", "score").collect())
    assert keep(pruned) == keep(full)
    scored = pruned.agg(F.sum("scored")).first()[0]
    assert scored < 0.2 * len(queries.terms) * buckets.count()


def test_a_short_bucket_is_skipped():
    import pyarrow as pa

    batch = pa.record_batch(
        {"doc_id": [1, 2], "norm": [5.0, 2.0], "terms": pa.array([[0, 1], [1]], pa.list_(pa.int32())), "impacts": pa.array([[3, 4], [2]], pa.list_(pa.int32()))}
    )
    chunk = chunk_of(batch, 2)
    weight, terms, counts = np.array([1, 1]), np.array([0, 1]), np.array([1, 1])
    assert search_chunk(chunk, terms, counts, weight, best := Best(1, 0)) == 2 and best.score.tolist() == [7]
    assert search_chunk(chunk, terms, counts, weight, Best(1, 8)) == 0  # sqrt(2) * 5 < 8: by length
    assert search_chunk(chunk, terms, counts, weight, Best(1, 7)) == 1  # the second is too short


def test_whole_table_against_sql(spark, matches_oracle):
    assert matches_oracle("op12_lexical_search", "/root/testdata/sf0.001") > 0
