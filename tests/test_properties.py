
import random

from pyspark.sql import functions as F

from helpers import frame, max_streaks_window, trade
from tradescope.operators.streaks import max_streaks
from tradescope.plans.tables import Tables


def test_counts_add_up(spark, sf001):
    t = Tables(sf001)
    closed = t.closed
    null_profit = closed.where(F.col("profit_pct").isNull()).groupBy("strategy").count()
    sp = t.strategy_performance.join(null_profit.withColumnRenamed("strategy", "strategy_name"), "strategy_name", "left")
    for r in sp.collect():
        assert r.winning_trades + r.losing_trades + (r["count"] or 0) == r.total_trades
        assert r.max_consecutive_wins is None or r.max_consecutive_wins <= r.winning_trades
        assert r.max_consecutive_losses is None or r.max_consecutive_losses <= r.losing_trades


def test_sum_over_pairs_is_overall(spark, sf001):
    t = Tables(sf001)
    pa = t.pair_analytics.agg(F.sum("total_trades").alias("n"), F.sum("total_profit_abs").alias("a")).first()
    ov = t.timing_analysis.where("time_category = 'overall'").first()
    assert pa.n == ov.trade_count and pa.a == ov.total_profit_abs
    pr = t.performance_rankings.agg(F.sum("trade_count")).first()[0]
    assert pr == ov.trade_count


def test_poller_is_subset_of_sql(spark, sf001):
    sql, poll = Tables(sf001), Tables(sf001, variant="poller")
    common = ["pair", "total_trades", "winning_trades", "losing_trades", "win_rate", "avg_profit_pct", "total_profit_abs"]
    a = {tuple(r) for r in sql.pair_analytics.select(*common).collect()}
    b = {tuple(r) for r in poll.pair_analytics.select(*common).collect()}
    assert a == b
    assert {r.time_category for r in poll.timing_analysis.collect()} == {"overall"}
    assert poll.risk_metrics.count() == 1


def test_hot_key_streaks(spark):
    """One pair holds a third of all trades and spans many buckets."""
    rnd = random.Random(7)
    rows = []
    for i in range(1, 901):
        pair = "HOT/X" if i % 3 == 0 else rnd.choice(["A/X", "B/X", "C/X"])
        rows.append(trade(i, rnd.choice([1.0, 1.0, -1.0, None, 0.5]), pair=pair))
    df = frame(spark, rows)
    got = {r.pair: (r.max_consecutive_wins, r.max_consecutive_losses) for r in max_streaks(df, "pair", bucket_ids=16).collect()}
    want = {r.pair: (r.max_consecutive_wins, r.max_consecutive_losses) for r in max_streaks_window(df, "pair").collect()}
    assert got == want
