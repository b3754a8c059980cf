"""Scalable operators against brute force."""

import random

from pyspark.sql import functions as F

from helpers import frame, max_streaks_window, trade
from tradescope.operators import order_stats
from tradescope.operators.order_stats import element_at_fraction
from tradescope.operators.streaks import max_streaks


def _rows(seed, n=400):
    rnd = random.Random(seed)
    out = []
    for i in range(1, n + 1):
        p = rnd.choice([None, 0.0, 1.0, -1.0, 2.0, -0.5, 0.25])
        out.append(trade(rnd.randint(1, 10 * n) * 10 + i % 10, p, pair=rnd.choice(["A/X", "B/X", "C/Y"]), strategy=rnd.choice(["s1", "s2"])))
    # unique ids
    seen, uniq = set(), []
    for r in out:
        if r["trade_id"] not in seen:
            seen.add(r["trade_id"])
            uniq.append(r)
    return uniq


def _as_dict(df, key):
    return {r[key]: (r.max_consecutive_wins, r.max_consecutive_losses) for r in df.collect()}


def test_streaks_bucketed_equal_window(spark):
    for seed in range(3):
        df = frame(spark, _rows(seed))
        for key in ("pair", "strategy"):
            brute = _as_dict(max_streaks_window(df, key), key)
            for bucket in (7, 64, 1 << 20):
                assert _as_dict(max_streaks(df, key, bucket_ids=bucket), key) == brute, (seed, key, bucket)


def test_streaks_on_fixture(spark, sf001):
    closed = sf001.where(~F.col("is_open"))
    brute = _as_dict(max_streaks_window(closed, "pair"), "pair")
    assert _as_dict(max_streaks(closed, "pair", bucket_ids=13), "pair") == brute


def test_element_at_fraction(spark, monkeypatch):
    monkeypatch.setattr(order_stats, "BUCKETS", 8)
    rnd = random.Random(1)
    inf = float("inf")
    cases = [
        [rnd.choice([rnd.uniform(-50, 0), -3.0, -3.0, -7.25]) for _ in range(3000)],
        [rnd.choice([-inf, inf, 1e300, -1e300, 5e-324, 0.0, -2.5]) for _ in range(500)],
        [4.0],
        [-1.0, -1.0],
    ]
    for values in cases:
        df = spark.createDataFrame([(v,) for v in [*values, None]], "v double")
        for level in (0.0, 0.05, 0.5, 0.9):
            assert element_at_fraction(df, "v", level).first()[0] == sorted(values)[int(len(values) * level)]
    assert element_at_fraction(df.where("v IS NULL"), "v", 0.05).first()[0] is None


def test_element_at_fraction_of_many_keys(spark, monkeypatch):
    """All keys are narrowed together, in two scans of the values, whatever their number."""
    monkeypatch.setattr(order_stats, "BUCKETS", 4)
    rnd = random.Random(7)
    rows = [(f"k{rnd.randint(0, 40)}", rnd.randint(0, 1), rnd.choice([-1.5, rnd.uniform(-100, 5), rnd.gauss(0, 1e-3), None])) for _ in range(4000)]
    rows += [(None, 1, -4.0), (None, 1, -5.0), ("hot", 0, -0.25)] + [("hot", 0, rnd.uniform(-1, -0.9)) for _ in range(3000)]
    df = spark.createDataFrame(rows, "k string, g int, v double")
    for level in (0.0, 0.05, 0.5, 0.999):
        got = {(r.k, r.g): r.value for r in element_at_fraction(df, "v", level, ["k", "g"]).collect()}
        want = {}
        for k, g, v in rows:
            if v is not None:
                want.setdefault((k, g), []).append(v)
        assert got == {key: sorted(vs)[int(len(vs) * level)] for key, vs in want.items()}
    assert element_at_fraction(df.where("k = 'none'"), "v", 0.5, ["k"]).collect() == []


def test_ranges_keep_the_order_of_values(spark):
    tiny, huge = 5e-324, 1.7976931348623157e308
    values = sorted({s * x for s in (-1, 1) for x in (0.0, tiny, 2 * tiny, 3 * tiny, 1e-300, 0.5, 0.999999, 1.0, 1.0000001, 2.0, 3.99, 4.0, 1e5, huge, float("inf"))})
    df = spark.createDataFrame([(v,) for v in values], "v double").select("v", order_stats.value_range(F.col("v")).alias("r"))
    ranges = [r.r for r in df.orderBy("v").collect()]
    assert ranges == sorted(ranges) and len(set(ranges)) > 20


def test_rank_index_adds_up_over_batches(spark):
    rnd = random.Random(5)
    batches = [[rnd.choice([-3.0, rnd.uniform(-60, -0.01)]) for _ in range(n)] for n in (300, 1, 40, 200)]
    parts = [order_stats.count_values(spark.createDataFrame([(v,) for v in b], "v double"), "v").cache() for b in batches]
    values = parts[0]
    ranges = order_stats.count_ranges(parts[0])
    for p in parts[1:]:
        values, ranges = values.unionByName(p), ranges.unionByName(order_stats.count_ranges(p))
    every = sorted(v for b in batches for v in b)
    for level in (0.0, 0.05, 0.7):
        assert order_stats.element_from_index(order_stats.merge_ranges(ranges), values, level).first()[0] == every[int(len(every) * level)]


def test_pinned_frames_keep_no_empty_partitions(spark):
    from tradescope.operators.grains import pin

    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    try:
        pinned = pin(spark.range(100).groupBy((F.col("id") % 5).alias("k")).count())
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
    assert pinned.rdd.getNumPartitions() == 1 and pinned.count() == 5


def test_bucket_summaries_sort_trades_once(spark):
    from tradescope.operators.streaks import bucket_summaries, keyed_rows

    profits = [1.0, 2.0, None, 3.0, -1.0, 0.0, 4.0, 5.0, 6.0, None]
    rows = frame(spark, [trade(i, p) for i, p in enumerate(profits)] + [trade(20, None), trade(21, None)])
    out = bucket_summaries(keyed_rows(rows, ["pair"], 10))
    assert out._jdf.queryExecution().sparkPlan().toString().count("Window ") <= 1 and out._jdf.queryExecution().executedPlan().toString().count("Sort [") == 1
    got = {r.b: r.asDict() for r in out.collect()}
    assert {c: v for c, v in got[0].items() if c not in "kb"} == {"n": 10, "tw": 4, "tl": 8, "w_pre": 2, "w_suf": 0, "w_best": 3, "l_pre": 0, "l_suf": 0, "l_best": 2}
    assert {c: v for c, v in got[2].items() if c not in "kb"} == {"n": 2, "tw": 2, "tl": 2, "w_pre": 0, "w_suf": 0, "w_best": None, "l_pre": 0, "l_suf": 0, "l_best": None}
