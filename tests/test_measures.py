"""Edge cases of the shared measures (FIXTURES.md section 4)."""

import math

from pyspark.sql import functions as F

from helpers import frame, trade
from tradescope.functions import measures as m
from tradescope.operators import grains as G
from tradescope.operators.duration import duration_category
from tradescope.operators.health import build_bot_health
from tradescope.operators.risk import build_risk_var
from tradescope.operators.strategy import build_strategy_performance
from tradescope.operators.timing import build_timing_analysis


def agg(spark, rows, *cols):
    """Derived measures over all rows, from the grain statistics."""
    return G.overall(G.grain_stats(frame(spark, rows), ["overall"])).select(*cols).first()


def test_empty_input_scalar_aggregates(spark):
    df = frame(spark, [])
    r = df.agg(m.n_rows().alias("n"), m.win_rate().alias("w"), m.sl_triggered().alias("t")).first()
    assert r.n == 0 and r.w is None and r.t is None


def test_single_trade(spark):
    sp = build_strategy_performance(frame(spark, [trade(1, 2.0)])).first()
    assert sp.total_trades == 1 and sp.consistency_score == 0.5
    assert sp.sharpe_ratio is None and sp.sortino_ratio is None and sp.calmar_ratio is None
    assert sp.max_consecutive_wins == 1 and sp.max_consecutive_losses is None


def test_constant_profit_variance(spark):
    rows = [trade(i, 0.1) for i in range(1, 4)]
    r = agg(spark, rows, G.volatility().alias("v"), G.sharpe().alias("s"))
    # E[x^2]-E[x]^2 may cancel to a tiny negative: NULL volatility, Sharpe 0 (SQLite rule).
    assert r.v is None or r.v < 1e-6
    assert r.s == 0.0


def test_no_losses_profit_factor_zero(spark):
    rows = [trade(i, 1.0) for i in range(1, 5)]
    r = agg(spark, rows, G.profit_factor().alias("pf"), G.risk_reward().alias("rr"), F.col("losses").alias("l"))
    assert r.pf == 0.0 and r.rr == 0.0 and r.l == 0


def test_no_wins(spark):
    rows = [trade(i, -1.0) for i in range(1, 5)]
    sp = build_strategy_performance(frame(spark, rows)).first()
    assert sp.winning_trades == 0 and sp.max_consecutive_wins is None and sp.max_consecutive_losses == 4
    assert sp.calmar_ratio == -1.0


def test_mean_zero_consistency(spark):
    rows = [trade(1, 1.0), trade(2, -1.0)]
    sp = build_strategy_performance(frame(spark, rows)).first()
    assert sp.consistency_score == 0.0


def test_null_profit_breaks_runs_and_counts(spark):
    rows = [trade(1, 1.0), trade(2, 1.0), trade(3, None), trade(4, 1.0), trade(5, -1.0), trade(6, 0.0)]
    sp = build_strategy_performance(frame(spark, rows)).first()
    assert sp.total_trades == 6
    assert sp.winning_trades + sp.losing_trades == 5
    assert sp.max_consecutive_wins == 2 and sp.max_consecutive_losses == 2
    assert math.isclose(sp.win_rate, 3 / 6)


def test_profit_exactly_zero_is_a_loss(spark):
    r = agg(spark, [trade(1, 0.0)], F.col("wins").alias("w"), F.col("losses").alias("l"))
    assert r.w == 0 and r.l == 1


def test_null_exit_reason_excluded_from_not_triggered(spark):
    rows = [trade(1, 1.0, exit_reason=None), trade(2, 3.0, exit_reason="roi"), trade(3, -2.0, exit_reason="stop_loss")]
    df = frame(spark, rows)
    r = df.agg(F.avg(F.when(F.col("exit_reason") != "stop_loss", F.col("profit_pct"))).alias("a")).first()
    assert r.a == 3.0


def test_sl_effectiveness_thresholds_are_strict(spark):
    rows = [trade(1, -5.0, exit_reason="stop_loss"), trade(2, -10.0, exit_reason="stop_loss"), trade(3, -4.0, exit_reason="stop_loss")]
    r = agg(spark, rows, G.sl_eff_count("kept10").alias("e10"), G.sl_eff_count("kept5").alias("e5"))
    assert math.isclose(r.e10, 200.0 / 3) and math.isclose(r.e5, 100.0 / 3)


def test_duration_category_bounds(spark):
    rows = [trade(i, 1.0, trade_duration=d) for i, d in enumerate([0, 60, 61, 480, 481, 1440, 1441], start=1)]
    got = [r.c for r in frame(spark, rows).orderBy("trade_id").select(duration_category().alias("c")).collect()]
    assert got == ["scalp", "scalp", "short_term", "short_term", "day_trade", "day_trade", "swing_trade"]


def test_var_index_for_twenty_losers(spark):
    rows = [trade(i, -float(i)) for i in range(1, 21)]
    v = build_risk_var(frame(spark, rows)).first().var_95_pct
    assert v == -19.0


def test_builders_take_all_trades(spark):
    """Open trades given to a builder are left out by it."""
    rows = [trade(1, 2.0), trade(2, -1.0), trade(3, -50.0, is_open=True)]
    df = frame(spark, rows)
    sp = build_strategy_performance(df).first()
    assert sp.total_trades == 2 and sp.max_consecutive_losses == 1
    assert build_risk_var(df).first().var_95_pct == -1.0


def test_var_no_losers_is_null(spark):
    assert build_risk_var(frame(spark, [trade(1, 1.0)])).first().var_95_pct is None


def test_health_open_day_span_zero(spark):
    rows = [trade(1, 1.0, open_date=None), trade(2, 1.0)]
    rows[0]["open_date"] = rows[1]["open_date"]
    h = {r.metric_name: r for r in build_bot_health(frame(spark, rows)).collect()}
    assert h["trading_activity"].metric_value == 0.0 and h["trading_activity"].health_status == "CRITICAL"


def test_health_empty_input_is_critical(spark):
    h = {r.metric_name: r for r in build_bot_health(frame(spark, [])).collect()}
    assert len(h) == 11
    assert h["overall_win_rate"].health_status == "CRITICAL"
    assert h["best_win_achievement"].health_status == "HEALTHY"


def test_poller_health_no_rows_without_trades(spark):
    assert build_bot_health(frame(spark, []), variant="poller").count() == 0


def test_timing_best_worst_hour_ties_lowest_hour(spark):
    import datetime as dt

    rows = [
        trade(1, 1.0, open_date=dt.datetime(2024, 1, 1, 23, 0)),
        trade(2, 1.0, open_date=dt.datetime(2024, 1, 1, 0, 0)),
        trade(3, -1.0, open_date=dt.datetime(2024, 1, 1, 5, 0)),
    ]
    ov = build_timing_analysis(frame(spark, rows)).where("time_category = 'overall'").first()
    assert ov.best_performance_hour == 0 and ov.worst_performance_hour == 5
