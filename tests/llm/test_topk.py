"""Top-k against brute force on whole numbers, ties, odd vectors, and the DuckDB twin."""

import math
import random

import pytest

from tradescope.llm import topk as T


def brute(rows, k, is_query):
    good = [(i, [math.floor(1024 * x) for x in v]) for i, v in rows if i is not None and v is not None and all(x is not None and math.isfinite(x) for x in v)]
    out = []
    for q, a in {i: v for i, v in good if is_query(i)}.items():
        scored = sorted((-max(-(2**63), min(2**63 - 1, sum(x * y for x, y in zip(a, b, strict=False)))), i) for i, b in good if i != q)[:k]
        out += [(q, r, i, -s) for r, (s, i) in enumerate(scored, 1)]
    return sorted(out)


def run(spark, rows, k, condition):
    df = spark.createDataFrame([(i, v, 1, 2) for i, v in rows], "vec_id long, embedding array<double>, score int, rank int")
    vectors = T.usable(df, "vec_id", "embedding")
    return sorted(tuple(r) for r in T.top_k(vectors.where(condition), vectors, k).collect())


@pytest.mark.parametrize(("queries", "candidates", "cells"), [(1024, 8192, 1 << 20), (3, 17, 40)])
def test_against_brute_force(spark, monkeypatch, queries, candidates, cells):
    monkeypatch.setattr(T, "QUERY_BLOCK", queries)
    monkeypatch.setattr(T, "CANDIDATE_BLOCK", candidates)
    monkeypatch.setattr(T, "CELLS", cells)
    rnd = random.Random(3)
    rows = [(i, [rnd.gauss(0, 0.2) for _ in range(10)]) for i in range(150)]
    rows += [(200 + i, [0.1] * 10) for i in range(25)] + [(231, [0.1] * 10)] * 2  # ties and repeated rows
    rows += [(300, None), (301, [None] * 10), (302, [math.nan] * 10), (303, [math.inf] * 10), (304, []), (305, [0.5, -0.5]), (None, [1.0] * 10), (306, [-1.0] * 10), (307, [0.3] * 14)]
    assert run(spark, rows, 5, "vec_id % 7 = 0") == brute(rows, 5, lambda i: i % 7 == 0)


def test_fewer_than_k(spark):
    rows = [(0, [1.0]), (1, [2.0]), (2, [-1.0])]
    assert run(spark, rows, 10, "vec_id = 0") == [(0, 1, 1, 2048 * 1024), (0, 2, 2, -1024 * 1024)]
    assert run(spark, rows[:1], 10, "vec_id = 0") == []
    assert run(spark, [], 10, "vec_id = 0") == []


def test_large_components_stay_exact(spark):
    rows = [(0, [2.0**40, 1.0]), (1, [2.0**9, 3.0]), (2, [2.0**9, 2.0]), (3, [2.0**70, 0.0]), (4, [-(2.0**70), 0.0])]
    assert run(spark, rows, 4, "vec_id = 0") == brute(rows, 4, lambda i: i == 0)


@pytest.mark.parametrize("sf", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_oracle(matches_oracle, sf):
    assert matches_oracle("op5_topk", sf) > 0


def test_short_vectors_are_not_sent(spark):
    """Only candidates that may reach a cutoff travel to the queries; all others are never scored."""
    rnd = random.Random(5)
    rows = [(i, [rnd.gauss(0, 1) * (1.0 if i < 40 else 0.001) for _ in range(8)]) for i in range(1, 400)] + [(0, [1.0] * 8)]
    rows += [(1000 + i, [1.0 + i / 64] * 8) for i in range(5)]
    vectors = T.with_lengths(T.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding"))
    cutoff = brute(rows, 5, lambda i: i == 0)[-1][3]
    told = vectors.where("vec_id = 0").selectExpr("0L AS qb", f"{cutoff}L AS cutoff", *T.PARTS)
    kept = {r.vec_id for r in T.sent(vectors.selectExpr("0L AS qb", "vec_id", *T.PARTS), T.reach_of(told)).collect()}
    assert {1000 + i for i in range(5)} <= kept and len(kept) < 50
    assert run(spark, rows, 5, "vec_id = 0") == brute(rows, 5, lambda i: i == 0)


def test_heads_are_bounded_and_give_a_safe_cutoff(spark, monkeypatch):
    monkeypatch.setattr(T, "HEAD_GROUPS", 3)
    rnd = random.Random(6)
    rows = [(i, [float(rnd.randrange(-9, 10)) for _ in range(rnd.randrange(0, 12))]) for i in range(300)] + [(7, [3.0] * 6)] * 40
    vectors = T.with_lengths(T.usable(spark.createDataFrame(rows, "vec_id long, embedding array<double>"), "vec_id", "embedding"))
    heads = T.heads_of(vectors).collect()
    assert 0 < len(heads) <= 3 * T.SLICES and len({r.vec_id for r in heads}) == len(heads)
    assert run(spark, rows, 4, "vec_id % 10 = 0") == brute(rows, 4, lambda i: i % 10 == 0)


def test_no_positive_score(spark):
    rows = [(0, [1.0, 0.0, 0.5])] + [(i, [-float(i), 0.0, -1.0]) for i in range(1, 30)]
    assert run(spark, rows, 3, "vec_id = 0") == brute(rows, 3, lambda i: i == 0)
