"""Report queries over the result tables (and "direct" ones over closed trades).

Each ``report`` takes a :class:`Tables` and returns a DataFrame. Rounding is
the reference's ``ROUND(x, d)`` (half away from zero, always a double).
Where the reference sorts on a rounded alias before a LIMIT, the unrounded
value and the entity key are added as tie-breaks so results are deterministic.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradescope.functions import labels as L
from tradescope.functions import measures as m
from tradescope.functions.bands import band, pick
from tradescope.plans.tables import Tables

c = F.col


def R(x, d: int) -> Column:
    """``ROUND(x, d)`` as SQLite computes it: a double, half away from zero."""
    return F.round(m.col(x).cast("double"), d)


def pct(x="win_rate", d: int = 1) -> Column:
    return R(m.col(x) * 100, d)


def avg_win_pct() -> Column:
    return R(F.avg("win_rate") * 100, 1)


def top(df: DataFrame, k: int, *order: Column) -> DataFrame:
    return df.orderBy(*order).limit(k)


def _pr(t: Tables) -> DataFrame:
    return t.performance_rankings.where(c("ranking_type") == "by_pair")


def _rm(t: Tables, kind: str) -> DataFrame:
    return t.risk_rows(kind)


def _ta(t: Tables, kind: str) -> DataFrame:
    return t.timing_analysis.where(c("time_category") == kind)


def _sl(t: Tables, kind: str) -> DataFrame:
    return t.stop_loss_analytics.where(c("analysis_type") == kind)


def _dp(t: Tables, kind: str) -> DataFrame:
    return t.duration_patterns.where(c("pattern_type") == kind)


# ------------------------------------------------------------- rankings
def pr_top10(t):
    return top(
        _pr(t).select(
            "rank_position",
            c("entity_name").alias("trading_pair"),
            R("profit_pct", 2).alias("avg_profit_pct"),
            pct().alias("win_rate_pct"),
            "trade_count",
            R("total_volume", 2).alias("total_volume_usdt"),
            R("avg_duration_minutes", 0).alias("avg_duration_min"),
        ),
        10,
        c("rank_position"),
    )


def pr_bottom5(t):
    return top(
        _pr(t).select(
            "rank_position",
            c("entity_name").alias("trading_pair"),
            R("profit_pct", 2).alias("avg_profit_pct"),
            pct().alias("win_rate_pct"),
            "trade_count",
            R("min_profit_pct", 2).alias("worst_trade_pct"),
        ),
        5,
        c("rank_position").desc(),
    )


def pr_high_win_low_profit(t, min_win: float = 0.7, max_profit: float = 1.0):
    return (
        _pr(t)
        .where((c("win_rate") >= min_win) & (c("profit_pct") < max_profit))
        .orderBy(c("win_rate").desc())
        .select(
            c("entity_name").alias("trading_pair"),
            R("profit_pct", 2).alias("avg_profit_pct"),
            pct().alias("win_rate_pct"),
            "trade_count",
            R("max_profit_pct", 2).alias("best_trade_pct"),
        )
    )


def pr_high_volume(t, k: int = 10):
    df = _pr(t)
    return top(df, k, c("total_volume").desc_nulls_last(), c("entity_name")).select(
        c("entity_name").alias("trading_pair"),
        R("profit_pct", 2).alias("avg_profit_pct"),
        "trade_count",
        R("total_volume", 2).alias("total_volume_usdt"),
        R(c("total_volume") / c("trade_count"), 2).alias("avg_stake_per_trade"),
    )


def pr_portfolio_summary(t):
    return _pr(t).agg(
        F.count(F.lit(1)).alias("total_pairs_traded"),
        R(F.avg("profit_pct"), 2).alias("portfolio_avg_profit_pct"),
        avg_win_pct().alias("portfolio_avg_win_rate"),
        F.sum("trade_count").alias("total_trades"),
        R(F.sum("profit_abs"), 2).alias("total_profit_abs"),
        R(F.sum("total_volume"), 2).alias("total_volume_traded"),
    )


def pr_profit_distribution(t):
    return (
        _pr(t)
        .groupBy(band("profit_pct", L.PROFIT_BANDS, L.PROFIT_BANDS_ELSE).alias("performance_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("profit_pct"), 2).alias("avg_profit_in_category"),
            avg_win_pct().alias("avg_win_rate_in_category"),
        )
        .orderBy(c("avg_profit_in_category").desc())
    )


def pr_winrate_distribution(t):
    return (
        _pr(t)
        .groupBy(band("win_rate", L.WINRATE_BANDS, L.WINRATE_BANDS_ELSE).alias("win_rate_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("profit_pct"), 2).alias("avg_profit_pct"),
            R(F.min("profit_pct"), 2).alias("min_profit_pct"),
            R(F.max("profit_pct"), 2).alias("max_profit_pct"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def _currency(t, currency: str, min_pairs: int | None, last: tuple[str, str]):
    # Pair -> currency from *all* trades (open ones too); a pair set, so small.
    lookup = t.trades.select(c("pair"), c(currency)).distinct()
    j = _pr(t).join(lookup, _pr(t)["entity_name"] == lookup["pair"])
    out = j.groupBy(currency).agg(
        F.countDistinct("entity_name").alias("pair_count"),
        R(F.avg("profit_pct"), 2).alias("avg_profit_pct"),
        avg_win_pct().alias("avg_win_rate"),
        F.sum("trade_count").alias("total_trades"),
        R(F.sum(last[0]), 2).alias(last[1]),
    )
    if min_pairs is not None:
        out = out.where(c("pair_count") >= min_pairs)
    return out


def pr_base_currency(t):
    return _currency(t, "base_currency", 2, ("profit_abs", "total_profit")).orderBy(c("avg_profit_pct").desc())


def pr_quote_currency(t):
    return _currency(t, "quote_currency", None, ("total_volume", "total_volume")).orderBy(c("total_volume").desc())


def pr_direct_top20(t, min_trades: int = 5, k: int = 20):
    g = t.closed.groupBy("pair").agg(
        m.n_rows().alias("trade_count"),
        R(F.avg(m.P), 2).alias("avg_profit_pct"),
        F.avg(m.P).alias("_avg"),
        R(m.win_rate() * 100, 1).alias("win_rate_pct"),
        R(F.max(m.P), 2).alias("best_trade_pct"),
        R(F.min(m.P), 2).alias("worst_trade_pct"),
        R(F.sum("stake_amount"), 2).alias("total_volume"),
        R(F.avg("trade_duration"), 0).alias("avg_duration_min"),
    )
    g = g.where(c("trade_count") >= min_trades)
    return top(g, k, c("avg_profit_pct").desc_nulls_last(), c("_avg").desc_nulls_last(), c("pair")).drop("_avg")


# ------------------------------------------------------------- risk
def rm_overall(t):
    return _rm(t, "overall").select(
        "metric_type",
        "stop_loss_triggered_count",
        R("stop_loss_effectiveness_pct", 2).alias("sl_effectiveness_pct"),
        R("max_drawdown_pct", 2).alias("max_drawdown_pct"),
        R("sharpe_ratio", 3).alias("sharpe_ratio"),
    )


def _risk_row(name_alias: str, dd_alias: str):
    return [
        c("entity_name").alias(name_alias),
        c("stop_loss_triggered_count").alias("sl_triggers"),
        R("stop_loss_effectiveness_pct", 1).alias("sl_effectiveness_pct"),
        R("max_drawdown_pct", 2).alias(dd_alias),
        R("volatility_pct", 2).alias("volatility_pct"),
        R("risk_reward_ratio", 2).alias("risk_reward_ratio"),
    ]


def rm_sl_by_pair(t):
    return _rm(t, "by_pair").select(*_risk_row("trading_pair", "max_drawdown_pct")).orderBy(c("sl_effectiveness_pct").desc())


def rm_strategy_compare(t):
    return _rm(t, "by_strategy").select(*_risk_row("strategy", "worst_loss_pct")).orderBy(c("risk_reward_ratio").desc())


def rm_high_risk_pairs(t, worst: float = -10, vol: float = 5, eff: float = 50):
    r = _rm(t, "by_pair")
    return (
        r.where((c("max_drawdown_pct") < worst) | (c("volatility_pct") > vol) | (c("stop_loss_effectiveness_pct") < eff))
        .orderBy(c("max_drawdown_pct").asc())
        .select(
            c("entity_name").alias("trading_pair"),
            R("max_drawdown_pct", 2).alias("worst_loss_pct"),
            R("volatility_pct", 2).alias("volatility_pct"),
            c("stop_loss_triggered_count").alias("sl_triggers"),
            R("stop_loss_effectiveness_pct", 1).alias("sl_effectiveness_pct"),
        )
    )


def _risk_with_rank(t):
    rm = _rm(t, "by_pair").alias("rm")
    pr = _pr(t).alias("pr")
    return rm.join(pr, c("rm.entity_name") == c("pr.entity_name"))


def rm_risk_adjusted(t):
    j = _risk_with_rank(t)
    return j.select(
        c("rm.entity_name").alias("trading_pair"),
        c("pr.profit_pct").alias("avg_profit_pct"),
        c("rm.volatility_pct").alias("volatility_pct"),
        c("rm.max_drawdown_pct").alias("max_drawdown_pct"),
        c("rm.risk_reward_ratio").alias("risk_reward_ratio"),
        F.when(c("rm.volatility_pct") > 0, R(c("pr.profit_pct") / c("rm.volatility_pct"), 2))
        .otherwise(F.lit(0.0))
        .alias("risk_adjusted_return"),
    ).orderBy(c("risk_adjusted_return").desc())


def rm_sl_eff_distribution(t):
    return (
        _rm(t, "by_pair")
        .groupBy(band("stop_loss_effectiveness_pct", L.SL_EFFECTIVENESS_BANDS, L.RISK_SL_EFFECTIVENESS_ELSE).alias("sl_effectiveness_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("stop_loss_effectiveness_pct"), 1).alias("avg_effectiveness"),
            R(F.avg("max_drawdown_pct"), 2).alias("avg_max_drawdown"),
        )
        .orderBy(c("avg_effectiveness").desc())
    )


def rm_volatility_vs_perf(t):
    j = _risk_with_rank(t)
    return (
        j.groupBy(band(c("rm.volatility_pct"), L.VOLATILITY_BANDS, L.VOLATILITY_BANDS_ELSE).alias("volatility_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("pr.profit_pct"), 2).alias("avg_profit_pct"),
            R(F.avg("rm.volatility_pct"), 2).alias("avg_volatility"),
            R(F.avg("rm.risk_reward_ratio"), 2).alias("avg_risk_reward"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def rm_direct_summary(t):
    return t.closed.agg(
        F.lit(L.CAPTIONS["rm_direct_summary"]).alias("analysis_type"),
        m.n_rows().alias("total_trades"),
        m.sl_triggered().alias("stop_loss_exits"),
        R(m.sl_triggered() * 100.0 / m.n_rows(), 1).alias("sl_trigger_rate_pct"),
        R(F.min(m.P), 2).alias("worst_trade_pct"),
        R(F.max(m.P), 2).alias("best_trade_pct"),
        R(m.pop_std(), 2).alias("volatility_pct"),
        R(m.avg_win_or_zero(), 2).alias("avg_win_pct"),
        R(m.avg_loss_or_zero(), 2).alias("avg_loss_pct"),
    )


def _by_exit_reason(t, names: tuple[str, str], with_duration: bool):
    # Group every closed trade by reason (NULL included) so the share of all
    # closed trades comes from a window over the few reason groups, no join.
    g = t.closed.groupBy("exit_reason").agg(
        m.n_rows().alias("trade_count"),
        R(F.avg(m.P), 2).alias("avg_profit_pct"),
        R(F.min(m.P), 2).alias(names[0]),
        R(F.max(m.P), 2).alias(names[1]),
        *([R(F.avg("trade_duration"), 0).alias("avg_duration_min")] if with_duration else []),
    )
    total = F.sum("trade_count").over(Window.partitionBy(F.lit(1)))
    g = g.withColumn("percentage_of_trades", R(c("trade_count") * 100.0 / total, 1))
    cols = ["exit_reason", "trade_count", "percentage_of_trades", "avg_profit_pct", names[0], names[1]]
    if with_duration:
        cols.append("avg_duration_min")
    return g.where(c("exit_reason").isNotNull()).select(*cols).orderBy(c("trade_count").desc())


def rm_by_exit_reason(t):
    return _by_exit_reason(t, ("worst_case_pct", "best_case_pct"), False)


def rm_daily_drawdown(t, min_trades: int = 2, days: int = 30):
    g = (
        t.closed.where(c("open_date").isNotNull())
        .groupBy(F.to_date("open_date").alias("trade_date"))
        .agg(
            m.n_rows().alias("trades_that_day"),
            R(F.avg(m.P), 2).alias("daily_avg_profit"),
            R(F.min(m.P), 2).alias("daily_worst_trade"),
            m.count_when(c(m.P) < 0).alias("losing_trades"),
        )
        .where(c("trades_that_day") >= min_trades)
    )
    return top(g, days, c("trade_date").desc())


# ------------------------------------------------------------- strategy
def _sp(t):
    return t.strategy_performance


def sp_ranking(t):
    return _sp(t).select(
        "strategy_name",
        "total_trades",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("total_profit_abs", 2).alias("total_profit"),
        R("profit_factor", 2).alias("profit_factor"),
        R("expectancy", 3).alias("expectancy"),
    ).orderBy(c("avg_profit_pct").desc())


def sp_best(t, min_trades: int = 5, k: int = 10):
    df = _sp(t).where(c("total_trades") >= min_trades).select(
        "strategy_name",
        "total_trades",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        c("avg_profit_pct").alias("_avg"),
        R("profit_factor", 2).alias("profit_factor"),
        R("best_trade_pct", 2).alias("best_trade_pct"),
        R("worst_trade_pct", 2).alias("worst_trade_pct"),
        R("consistency_score", 3).alias("consistency"),
        R("avg_trade_duration_minutes", 0).alias("avg_duration_min"),
    )
    return top(df, k, c("avg_profit_pct").desc_nulls_last(), c("_avg").desc_nulls_last(), c("strategy_name")).drop("_avg")


def sp_risk_adjusted(t, min_trades: int = 10):
    return (
        _sp(t)
        .where(c("total_trades") >= min_trades)
        .select(
            "strategy_name",
            R("avg_profit_pct", 2).alias("avg_profit_pct"),
            R("sharpe_ratio", 3).alias("sharpe_ratio"),
            R("sortino_ratio", 3).alias("sortino_ratio"),
            R("calmar_ratio", 3).alias("calmar_ratio"),
            "max_consecutive_losses",
            R("consistency_score", 3).alias("consistency"),
        )
        .orderBy(c("sharpe_ratio").desc())
    )


def _efficiency_cols(key):
    return [
        key,
        "total_trades",
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("avg_trade_duration_minutes", 0).alias("avg_duration_min"),
        R(c("avg_profit_pct") / (c("avg_trade_duration_minutes") / 60.0), 3).alias("profit_per_hour"),
        R(c("total_profit_abs") / c("total_trades"), 2).alias("profit_per_trade"),
    ]


def sp_efficiency(t):
    return _sp(t).where(c("avg_trade_duration_minutes") > 0).select(*_efficiency_cols("strategy_name")).orderBy(c("profit_per_hour").desc())


def sp_profit_distribution(t):
    return (
        _sp(t)
        .groupBy(band("avg_profit_pct", L.PROFIT_BANDS, L.PROFIT_BANDS_ELSE).alias("performance_category"))
        .agg(
            F.count(F.lit(1)).alias("strategy_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_in_category"),
            avg_win_pct().alias("avg_win_rate_pct"),
            F.sum("total_trades").alias("total_trades_in_category"),
        )
        .orderBy(c("avg_profit_in_category").desc())
    )


def sp_winrate_distribution(t):
    return (
        _sp(t)
        .groupBy(band("win_rate", L.WINRATE_BANDS, L.WINRATE_BANDS_ELSE).alias("win_rate_category"))
        .agg(
            F.count(F.lit(1)).alias("strategy_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            R(F.avg("profit_factor"), 2).alias("avg_profit_factor"),
            R(F.avg("expectancy"), 3).alias("avg_expectancy"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def sp_consistency_distribution(t):
    return (
        _sp(t)
        .where(c("consistency_score").isNotNull())
        .groupBy(band("consistency_score", L.CONSISTENCY_BANDS, L.CONSISTENCY_BANDS_ELSE).alias("consistency_category"))
        .agg(
            F.count(F.lit(1)).alias("strategy_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            R(F.avg("consistency_score"), 3).alias("avg_consistency"),
            R(F.avg("max_consecutive_losses"), 1).alias("avg_max_loss_streak"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def sp_duration_distribution(t):
    return (
        _sp(t)
        .where(c("avg_trade_duration_minutes").isNotNull())
        .groupBy(band("avg_trade_duration_minutes", L.STRATEGY_DURATION_BANDS, L.STRATEGY_DURATION_BANDS_ELSE).alias("duration_category"))
        .agg(
            F.count(F.lit(1)).alias("strategy_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.avg("avg_trade_duration_minutes"), 0).alias("avg_duration_min"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def _head_to_head(df: DataFrame, key: str, value: str, caption: str, names: tuple[str, str]):
    # Only the top two rows meet in one task; two conditional maxima give one row.
    order = [c(value).desc_nulls_last(), c(key).asc_nulls_first()]
    r = df.select(key, value).orderBy(*order).limit(2).select(key, value, F.row_number().over(Window.orderBy(*order)).alias("rn"))
    first = F.max(F.when(c("rn") == 1, c(value)))
    second = F.max(F.when(c("rn") == 2, c(value)))
    return r.agg(
        F.lit(caption).alias("analysis_type"),
        F.max(F.when(c("rn") == 1, c(key))).alias(names[0]),
        R(first, 2).alias("best_profit_pct"),
        F.max(F.when(c("rn") == 2, c(key))).alias(names[1]),
        R(second, 2).alias("second_profit_pct"),
        R(first - second, 2).alias("profit_difference"),
    )


def sp_head_to_head(t):
    return _head_to_head(_sp(t), "strategy_name", "avg_profit_pct", L.CAPTIONS["sp_head_to_head"], ("best_strategy", "second_strategy"))


def _rating(avg_col: Column, second: Column, spec) -> Column:
    arms = []
    for min_avg, min_second, label in spec:
        cond = avg_col >= min_avg
        if min_second is not None:
            cond = cond & (second >= min_second)
        arms.append((cond, label))
    return pick(arms, L.RATING_ELSE)


def sp_matrix(t, min_trades: int = 5):
    return (
        _sp(t)
        .where(c("total_trades") >= min_trades)
        .select(
            "strategy_name",
            "total_trades",
            R("avg_profit_pct", 2).alias("profit_pct"),
            pct().alias("win_rate_pct"),
            R("profit_factor", 2).alias("profit_factor"),
            R("sharpe_ratio", 3).alias("sharpe"),
            c("max_consecutive_losses").alias("max_loss_streak"),
            _rating(c("avg_profit_pct"), c("win_rate"), L.STRATEGY_RATING).alias("performance_rating"),
        )
        .orderBy(c("profit_pct").desc())
    )


def sp_direct(t, min_trades: int = 3):
    return (
        t.closed.where(c("strategy").isNotNull())
        .groupBy("strategy")
        .agg(
            m.n_rows().alias("total_trades"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            R(m.win_rate() * 100, 1).alias("win_rate_pct"),
            R(F.max(m.P), 2).alias("best_trade_pct"),
            R(F.min(m.P), 2).alias("worst_trade_pct"),
            R(F.sum(m.A), 2).alias("total_profit"),
            F.countDistinct("pair").alias("pairs_traded"),
            R(F.avg("trade_duration"), 0).alias("avg_duration_min"),
        )
        .where(c("total_trades") >= min_trades)
        .orderBy(c("avg_profit_pct").desc())
    )


def sp_by_pair(t, min_trades: int = 2):
    return (
        t.closed.where(c("strategy").isNotNull())
        .groupBy("strategy", "pair")
        .agg(
            m.n_rows().alias("trades"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            R(m.win_rate() * 100, 1).alias("win_rate_pct"),
        )
        .where(c("trades") >= min_trades)
        .orderBy("strategy", c("avg_profit_pct").desc())
    )


# ------------------------------------------------------------- timing
def _period_type(dow: Column) -> Column:
    return F.when(dow.isin(*L.WEEKEND_DAYS), F.lit("Weekend")).otherwise(F.lit("Weekday"))


def ta_overall(t):
    return _ta(t, "overall").select(
        "time_category",
        "trade_count",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        "best_performance_hour",
        "worst_performance_hour",
        R("weekend_performance_pct", 2).alias("weekend_profit_pct"),
        R("weekday_performance_pct", 2).alias("weekday_profit_pct"),
    )


def ta_best_hours(t):
    return _ta(t, "hourly").select(
        "hour_of_day",
        "time_period_name",
        "trade_count",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("total_profit_abs", 2).alias("total_profit"),
        R("duration_minutes_avg", 0).alias("avg_duration_min"),
    ).orderBy(c("avg_profit_pct").desc())


def ta_day_of_week(t):
    return _ta(t, "daily").select(
        c("time_period_name").alias("day_name"),
        "day_of_week",
        "trade_count",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("total_profit_abs", 2).alias("total_profit"),
        _period_type(c("day_of_week")).alias("period_type"),
    ).orderBy(c("avg_profit_pct").desc())


def ta_monthly(t):
    return _ta(t, "monthly").select(
        c("time_period_name").alias("month_name"),
        "month_of_year",
        "trade_count",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("total_profit_abs", 2).alias("total_profit"),
    ).orderBy("month_of_year")


def ta_sessions(t):
    return (
        _ta(t, "hourly")
        .groupBy(c("time_period_name").alias("trading_session"))
        .agg(
            F.count(F.lit(1)).alias("hours_in_session"),
            F.sum("trade_count").alias("total_trades"),
            R(F.avg("avg_profit_pct"), 2).alias("session_avg_profit"),
            avg_win_pct().alias("session_avg_winrate"),
            R(F.sum("total_profit_abs"), 2).alias("session_total_profit"),
        )
        .orderBy(c("session_avg_profit").desc())
    )


def ta_weekend_vs_weekday(t):
    return (
        _ta(t, "daily")
        .groupBy(_period_type(c("day_of_week")).alias("period_type"))
        .agg(
            F.count(F.lit(1)).alias("days_analyzed"),
            F.sum("trade_count").alias("total_trades"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.sum("total_profit_abs"), 2).alias("total_profit"),
            R(F.avg("duration_minutes_avg"), 0).alias("avg_trade_duration"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def ta_hour_rating(t):
    return _ta(t, "hourly").select(
        "hour_of_day",
        "time_period_name",
        R("avg_profit_pct", 2).alias("profit_pct"),
        pct().alias("win_rate_pct"),
        "trade_count",
        band("avg_profit_pct", L.HOUR_RATING, L.HOUR_RATING_ELSE).alias("hour_rating"),
    ).orderBy(c("profit_pct").desc())


def ta_volatility(t):
    return (
        _ta(t, "hourly")
        .where(c("volatility_pct").isNotNull())
        .groupBy("time_period_name")
        .agg(
            R(F.avg("volatility_pct"), 2).alias("avg_volatility"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            R(F.try_divide(F.avg("volatility_pct"), F.nullif(F.avg("avg_profit_pct"), F.lit(0.0))), 2).alias("volatility_to_profit_ratio"),
            F.sum("trade_count").alias("total_trades"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def market_session(hour: Column) -> Column:
    return pick([(hour.isin(*hours), label) for hours, label in L.MARKET_SESSIONS], L.MARKET_SESSIONS_ELSE)


def ta_market_sessions(t):
    return (
        _ta(t, "hourly")
        .groupBy(market_session(c("hour_of_day")).alias("market_session"))
        .agg(
            F.countDistinct("hour_of_day").alias("hours_in_session"),
            F.sum("trade_count").alias("total_trades"),
            R(F.avg("avg_profit_pct"), 2).alias("session_avg_profit"),
            avg_win_pct().alias("session_win_rate"),
            R(F.sum("total_profit_abs"), 2).alias("session_total_profit"),
        )
        .orderBy(c("session_avg_profit").desc())
    )


def ta_consecutive_hours(t, k: int = 10):
    # At most 24 hourly rows on each side: a bounded broadcast.
    h = _ta(t, "hourly")
    t1 = h.select(c("hour_of_day").alias("h1"), c("avg_profit_pct").alias("a1"), c("trade_count").alias("n1"))
    t2 = h.select(c("hour_of_day").alias("h2"), c("avg_profit_pct").alias("a2"), c("trade_count").alias("n2"))
    j = t1.join(F.broadcast(t2), c("h2") == (c("h1") + 1) % 24)
    return top(j, k, c("a1").desc_nulls_last(), c("h1")).select(
        c("h1").alias("current_hour"),
        c("h2").alias("next_hour"),
        R("a1", 2).alias("current_hour_profit"),
        R("a2", 2).alias("next_hour_profit"),
        c("n1").alias("current_hour_trades"),
        c("n2").alias("next_hour_trades"),
    )


def ta_direct_hours(t, min_trades: int = 2, k: int = 10):
    g = (
        t.closed.where(c("open_date").isNotNull())
        .groupBy(m.hour_of().alias("hour"))
        .agg(
            m.n_rows().alias("trade_count"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            F.avg(m.P).alias("_avg"),
            R(m.win_rate() * 100, 1).alias("win_rate_pct"),
            R(F.sum(m.A), 2).alias("total_profit"),
            R(F.avg("trade_duration"), 0).alias("avg_duration_min"),
        )
        .where(c("trade_count") >= min_trades)
    )
    return (
        top(g, k, c("avg_profit_pct").desc_nulls_last(), c("_avg").desc_nulls_last(), c("hour"))
        .drop("_avg")
        .select(F.lit(L.CAPTIONS["ta_direct_hours"]).alias("analysis_type"), "*")
    )


def _day_name(d: Column) -> Column:
    return pick([(d == i, name) for i, name in enumerate(L.DAY_NAMES)], F.lit(None).cast("string"))


def ta_direct_dow(t):
    return (
        t.closed.where(c("open_date").isNotNull())
        .groupBy(m.dow_of().alias("day_number"))
        .agg(
            m.n_rows().alias("trade_count"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            R(m.win_rate() * 100, 1).alias("win_rate_pct"),
        )
        .select(
            _day_name(c("day_number")).alias("day_name"),
            "day_number",
            "trade_count",
            "avg_profit_pct",
            "win_rate_pct",
            _period_type(c("day_number")).alias("period_type"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


# ------------------------------------------------------------- pairs
def _pa(t):
    return t.pair_analytics


def pa_top15(t, k: int = 15):
    df = _pa(t).select(
        "pair",
        "base_currency",
        "quote_currency",
        "total_trades",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        c("avg_profit_pct").alias("_avg"),
        R("total_profit_abs", 2).alias("total_profit"),
        R("price_volatility_pct", 2).alias("volatility_pct"),
        R("profit_factor", 2).alias("profit_factor"),
        R("avg_trade_duration_minutes", 0).alias("avg_duration_min"),
    )
    return top(df, k, c("avg_profit_pct").desc_nulls_last(), c("_avg").desc_nulls_last(), c("pair")).drop("_avg")


def pa_worst10(t, min_trades: int = 3, k: int = 10):
    df = _pa(t).where(c("total_trades") >= min_trades).select(
        "pair",
        "total_trades",
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        c("avg_profit_pct").alias("_avg"),
        pct().alias("win_rate_pct"),
        R("worst_trade_pct", 2).alias("worst_trade_pct"),
        "max_consecutive_losses",
    )
    return top(df, k, c("avg_profit_pct").asc_nulls_first(), c("_avg").asc_nulls_first(), c("pair")).drop("_avg")


def pa_high_volume(t, k: int = 10):
    df = _pa(t).select(
        "pair",
        "total_trades",
        R("total_volume", 2).alias("total_volume"),
        c("total_volume").alias("_vol"),
        R("avg_stake_amount", 2).alias("avg_stake_per_trade"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("total_profit_abs", 2).alias("total_profit"),
    )
    return top(df, k, c("total_volume").desc_nulls_last(), c("_vol").desc_nulls_last(), c("pair")).drop("_vol")


def pa_consistent(t, min_trades: int = 5, k: int = 10):
    df = _pa(t).where((c("total_trades") >= min_trades) & (c("avg_profit_pct") > 0)).select(
        "pair",
        "total_trades",
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("price_volatility_pct", 2).alias("volatility_pct"),
        c("price_volatility_pct").alias("_vol"),
        c("sharpe_ratio").alias("_sharpe"),
        pct().alias("win_rate_pct"),
        R("sharpe_ratio", 3).alias("sharpe_ratio"),
    )
    return top(
        df, k, c("sharpe_ratio").desc_nulls_last(), c("_vol").asc_nulls_first(), c("_sharpe").desc_nulls_last(), c("pair")
    ).drop("_vol", "_sharpe")


def pa_base_currency(t, min_pairs: int = 2):
    return (
        _pa(t)
        .groupBy("base_currency")
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            F.sum("total_trades").alias("total_trades"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.sum("total_profit_abs"), 2).alias("total_profit"),
            R(F.sum("total_volume"), 2).alias("total_volume_traded"),
            R(F.avg("price_volatility_pct"), 2).alias("avg_volatility_pct"),
        )
        .where(c("pair_count") >= min_pairs)
        .orderBy(c("avg_profit_pct").desc())
    )


def pa_quote_currency(t):
    return (
        _pa(t)
        .groupBy("quote_currency")
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            F.sum("total_trades").alias("total_trades"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.sum("total_profit_abs"), 2).alias("total_profit"),
            R(F.sum("total_volume"), 2).alias("total_volume_traded"),
        )
        .orderBy(c("total_volume_traded").desc())
    )


def pa_currency_combo(t):
    return (
        _pa(t)
        .groupBy("base_currency", "quote_currency")
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            F.sum("total_trades").alias("total_trades"),
            R(F.avg("price_volatility_pct"), 2).alias("avg_volatility_pct"),
        )
        .select(
            F.concat(c("base_currency"), F.lit("/"), c("quote_currency")).alias("currency_combo"),
            "pair_count",
            "avg_profit_pct",
            "avg_win_rate_pct",
            "total_trades",
            "avg_volatility_pct",
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def pa_volatility_bands(t):
    return (
        _pa(t)
        .where(c("price_volatility_pct").isNotNull())
        .groupBy(band("price_volatility_pct", L.VOLATILITY_BANDS, L.VOLATILITY_BANDS_ELSE).alias("volatility_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            R(F.avg("price_volatility_pct"), 2).alias("avg_volatility"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.avg("sharpe_ratio"), 3).alias("avg_sharpe_ratio"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def pa_frequency_bands(t):
    return (
        _pa(t)
        .groupBy(band("total_trades", L.FREQUENCY_BANDS, L.FREQUENCY_BANDS_ELSE).alias("frequency_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            R(F.avg("total_trades"), 1).alias("avg_trades_per_pair"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.sum("total_profit_abs"), 2).alias("category_total_profit"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def pa_winrate_bands(t):
    return (
        _pa(t)
        .groupBy(band("win_rate", L.PAIR_WINRATE_BANDS, L.PAIR_WINRATE_BANDS_ELSE).alias("win_rate_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            R(F.avg("profit_factor"), 2).alias("avg_profit_factor"),
            R(F.avg("max_consecutive_losses"), 1).alias("avg_max_loss_streak"),
        )
        .orderBy(c("avg_profit_pct").desc())
    )


def pa_head_to_head(t):
    return _head_to_head(_pa(t), "pair", "avg_profit_pct", L.CAPTIONS["pa_head_to_head"], ("best_pair", "second_pair"))


def pa_efficiency(t, k: int = 15):
    df = _pa(t).where(c("avg_trade_duration_minutes") > 0).select(
        *_efficiency_cols("pair"), (c("avg_profit_pct") / (c("avg_trade_duration_minutes") / 60.0)).alias("_pph")
    )
    return top(df, k, c("profit_per_hour").desc_nulls_last(), c("_pph").desc_nulls_last(), c("pair")).drop("_pph")


def pa_rating(t, min_trades: int = 5):
    return (
        _pa(t)
        .where(c("total_trades") >= min_trades)
        .select(
            "pair",
            R("avg_profit_pct", 2).alias("avg_profit_pct"),
            R("price_volatility_pct", 2).alias("volatility_pct"),
            R("sharpe_ratio", 3).alias("sharpe_ratio"),
            R("profit_factor", 2).alias("profit_factor"),
            "max_consecutive_losses",
            _rating(c("avg_profit_pct"), c("sharpe_ratio"), L.PAIR_RATING).alias("performance_rating"),
        )
        .orderBy(c("sharpe_ratio").desc(), c("avg_profit_pct").desc())
    )


def pa_direct(t, min_trades: int = 3):
    return (
        t.closed.groupBy("pair", "base_currency", "quote_currency")
        .agg(
            m.n_rows().alias("total_trades"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            R(m.win_rate() * 100, 1).alias("win_rate_pct"),
            R(F.max(m.P), 2).alias("best_trade_pct"),
            R(F.min(m.P), 2).alias("worst_trade_pct"),
            R(F.sum("stake_amount"), 2).alias("total_volume"),
            R(F.avg("trade_duration"), 0).alias("avg_duration_min"),
            F.countDistinct(F.to_date("open_date")).alias("trading_days"),
        )
        .where(c("total_trades") >= min_trades)
        .orderBy(c("avg_profit_pct").desc())
    )


def pa_by_month(t, min_trades: int = 2):
    return (
        t.closed.where(c("open_date").isNotNull())
        .groupBy("pair", F.date_format("open_date", "yyyy-MM").alias("month"))
        .agg(
            m.n_rows().alias("trades_that_month"),
            R(F.avg(m.P), 2).alias("monthly_avg_profit"),
            R(m.win_rate() * 100, 1).alias("monthly_win_rate"),
        )
        .where(c("trades_that_month") >= min_trades)
        .orderBy("pair", c("month").desc())
    )


# ------------------------------------------------------------- stop loss
def sl_overall(t):
    return _sl(t, "overall").select(
        "analysis_type",
        R("stop_loss_level_pct", 2).alias("avg_sl_level_pct"),
        "total_trades_with_sl",
        "sl_triggered_count",
        "sl_trigger_rate_pct",
        "sl_effectiveness_pct",
        R("avg_loss_when_triggered_pct", 2).alias("avg_loss_when_triggered_pct"),
        R("avg_profit_when_not_triggered_pct", 2).alias("avg_profit_when_not_triggered_pct"),
        "trades_without_sl",
    )


def sl_by_pair(t):
    return _sl(t, "by_pair").select(
        "pair",
        "total_trades_with_sl",
        "sl_triggered_count",
        "sl_trigger_rate_pct",
        "sl_effectiveness_pct",
        R("stop_loss_level_pct", 2).alias("avg_sl_level_pct"),
        R("optimal_sl_level_pct", 2).alias("optimal_sl_level_pct"),
        R("avg_loss_when_triggered_pct", 2).alias("avg_loss_triggered"),
        R("avg_profit_when_not_triggered_pct", 2).alias("avg_profit_not_triggered"),
    ).orderBy(c("sl_effectiveness_pct").desc())


def sl_by_strategy(t):
    return _sl(t, "by_strategy").select(
        "strategy",
        "total_trades_with_sl",
        "sl_triggered_count",
        "sl_trigger_rate_pct",
        "sl_effectiveness_pct",
        R("stop_loss_level_pct", 2).alias("avg_sl_level_pct"),
        R("avg_loss_when_triggered_pct", 2).alias("avg_loss_triggered"),
        R("max_loss_prevented_pct", 2).alias("max_loss_prevented"),
    ).orderBy(c("sl_effectiveness_pct").desc())


def sl_needs_work(t, min_eff: float = 50, aggressive: float = 30, loose: float = 5):
    e, r = c("sl_effectiveness_pct"), c("sl_trigger_rate_pct")
    a = L.SL_ASSESSMENT
    return _sl(t, "by_pair").select(
        "pair",
        "sl_effectiveness_pct",
        "sl_trigger_rate_pct",
        R("stop_loss_level_pct", 2).alias("current_avg_sl"),
        R("optimal_sl_level_pct", 2).alias("suggested_sl"),
        pick([(e < min_eff, a[0]), (r > aggressive, a[1]), (r < loose, a[2])], a[3]).alias("sl_assessment"),
    ).orderBy(c("sl_effectiveness_pct").asc())


def sl_eff_bands(t):
    return (
        _sl(t, "by_pair")
        .groupBy(band("sl_effectiveness_pct", L.SL_EFFECTIVENESS_BANDS, L.SL_EFFECTIVENESS_ELSE).alias("effectiveness_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("sl_effectiveness_pct"), 1).alias("avg_effectiveness"),
            R(F.avg("sl_trigger_rate_pct"), 1).alias("avg_trigger_rate"),
            R(F.avg("stop_loss_level_pct"), 2).alias("avg_sl_level"),
        )
        .orderBy(c("avg_effectiveness").desc())
    )


def sl_trigger_bands(t):
    return (
        _sl(t, "by_pair")
        .groupBy(band("sl_trigger_rate_pct", L.SL_TRIGGER_BANDS, L.SL_TRIGGER_BANDS_ELSE).alias("trigger_rate_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("sl_trigger_rate_pct"), 1).alias("avg_trigger_rate"),
            R(F.avg("sl_effectiveness_pct"), 1).alias("avg_effectiveness"),
            R(F.avg("avg_loss_when_triggered_pct"), 2).alias("avg_loss_when_triggered"),
        )
        .orderBy(c("avg_trigger_rate").desc())
    )


def sl_level_bands(t):
    return (
        _sl(t, "by_pair")
        .where(c("stop_loss_level_pct").isNotNull())
        .groupBy(band("stop_loss_level_pct", L.SL_LEVEL_BANDS, L.SL_LEVEL_BANDS_ELSE).alias("sl_level_category"))
        .agg(
            F.count(F.lit(1)).alias("pair_count"),
            R(F.avg("stop_loss_level_pct"), 2).alias("avg_sl_level"),
            R(F.avg("sl_trigger_rate_pct"), 1).alias("avg_trigger_rate"),
            R(F.avg("sl_effectiveness_pct"), 1).alias("avg_effectiveness"),
            R(F.avg("avg_profit_when_not_triggered_pct"), 2).alias("avg_profit_no_trigger"),
        )
        .orderBy(c("avg_effectiveness").desc())
    )


def sl_direct_overview(t):
    has = c("stop_loss_pct").isNotNull()
    with_sl = m.count_when(has)
    return t.closed.agg(
        F.lit(L.CAPTIONS["sl_direct_overview"]).alias("analysis_type"),
        m.n_rows().alias("total_trades"),
        with_sl.alias("trades_with_sl"),
        R(with_sl * 100.0 / m.n_rows(), 1).alias("sl_usage_rate_pct"),
        m.sl_triggered().alias("sl_triggered"),
        R(F.try_divide(m.sl_triggered() * 100.0, F.nullif(with_sl, F.lit(0))), 1).alias("sl_trigger_rate_pct"),
        R(F.avg(F.when(has, c("stop_loss_pct"))), 2).alias("avg_sl_level_pct"),
        R(F.avg(F.when(m.is_sl_exit(), c(m.P))), 2).alias("avg_loss_when_triggered"),
    )


def sl_by_exit_reason(t):
    return _by_exit_reason(t, ("worst_outcome_pct", "best_outcome_pct"), True)


def _protection_row(label: str, side: Column, triggered: Column) -> Column:
    return F.struct(
        F.lit(label).alias("protection_type"),
        F.count(F.when(side, 1)).alias("trade_count"),
        R(F.avg(F.when(side, c(m.P))), 2).alias("avg_profit_pct"),
        R(F.min(F.when(side, c(m.P))), 2).alias("worst_loss_pct"),
        R(F.avg(F.when(side, m.win_flag())) * 100, 1).alias("win_rate_pct"),
        triggered.alias("protection_triggered"),
    )


def sl_with_vs_without(t):
    # One scan; both rows exist even when one side is empty.
    has = c("stop_loss_pct").isNotNull()
    triggered = F.sum(F.when(has, F.when(m.is_sl_exit(), 1).otherwise(0))).cast("long")
    sides = t.closed.agg(_protection_row(L.WITH_SL, has, triggered).alias("a"), _protection_row(L.WITHOUT_SL, ~has, F.lit(0).cast("long")).alias("b"))
    return sides.select(F.explode(F.array("a", "b")).alias("r")).select("r.*").orderBy("protection_type")


def sl_level_distribution(t):
    trig = m.sl_triggered()
    return (
        t.closed.where(c("stop_loss_pct").isNotNull())
        .groupBy(band("stop_loss_pct", L.SL_RAW_LEVEL_BANDS, L.SL_RAW_LEVEL_BANDS_ELSE).alias("sl_level_range"))
        .agg(
            m.n_rows().alias("trade_count"),
            R(F.avg("stop_loss_pct"), 2).alias("avg_sl_level"),
            trig.alias("triggered_count"),
            R(trig * 100.0 / m.n_rows(), 1).alias("trigger_rate_pct"),
            R(F.avg(m.P), 2).alias("avg_outcome_pct"),
        )
        .orderBy("avg_sl_level")
    )


# ------------------------------------------------------------- duration
def dp_overall(t):
    return _dp(t, "duration_based").select(
        "duration_category",
        "trade_count",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("total_profit_abs", 2).alias("total_profit"),
        R("optimal_exit_timing_minutes", 0).alias("avg_duration_min"),
        R("profit_per_hour", 3).alias("profit_per_hour"),
        R("min_duration_minutes", 0).alias("min_duration_min"),
        R("max_duration_minutes", 0).alias("max_duration_min"),
    ).orderBy(c("profit_per_hour").desc())


def dp_efficiency_rating(t):
    return _dp(t, "duration_based").select(
        "duration_category",
        "trade_count",
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("profit_per_hour", 3).alias("profit_per_hour"),
        R(c("optimal_exit_timing_minutes") / 60.0, 1).alias("avg_duration_hours"),
        band("profit_per_hour", L.EFFICIENCY_BANDS, L.EFFICIENCY_BANDS_ELSE).alias("efficiency_rating"),
    ).orderBy(c("profit_per_hour").desc())


def dp_by_pair_top20(t, min_trades: int = 3, k: int = 20):
    df = _dp(t, "by_pair").where(c("trade_count") >= min_trades).select(
        "pair",
        "duration_category",
        "trade_count",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("profit_per_hour", 3).alias("profit_per_hour"),
        c("profit_per_hour").alias("_pph"),
        R("optimal_exit_timing_minutes", 0).alias("optimal_timing_min"),
    )
    return top(
        df, k, c("profit_per_hour").desc_nulls_last(), c("_pph").desc_nulls_last(), c("pair"), c("duration_category")
    ).drop("_pph")


def dp_by_strategy(t):
    return _dp(t, "by_strategy").select(
        "strategy",
        "duration_category",
        "trade_count",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("profit_per_hour", 3).alias("profit_per_hour"),
        R(c("optimal_exit_timing_minutes") / 60.0, 1).alias("optimal_timing_hours"),
    ).orderBy("strategy", c("profit_per_hour").desc())


def dp_efficiency_rank(t):
    w = Window.orderBy(c("profit_per_hour").desc_nulls_last())
    return _dp(t, "duration_based").select(
        F.lit(L.CAPTIONS["dp_efficiency_rank"]).alias("analysis_type"),
        "duration_category",
        "trade_count",
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R("optimal_exit_timing_minutes", 0).alias("avg_duration_min"),
        R("profit_per_hour", 3).alias("profit_per_hour_r"),
        F.rank().over(w).alias("efficiency_rank"),
    ).withColumnRenamed("profit_per_hour_r", "profit_per_hour")


def dp_win_rating(t):
    arms = []
    for min_win, min_avg, label in L.DURATION_RATING:
        cond = c("win_rate") >= min_win
        if min_avg is not None:
            cond = cond & (c("avg_profit_pct") >= min_avg)
        arms.append((cond, label))
    return _dp(t, "duration_based").select(
        "duration_category",
        pct().alias("win_rate_pct"),
        R("avg_profit_pct", 2).alias("avg_profit_pct"),
        R(c("optimal_exit_timing_minutes") / 60.0, 1).alias("avg_duration_hours"),
        "trade_count",
        pick(arms, L.DURATION_RATING_ELSE).alias("performance_rating"),
    ).orderBy(c("win_rate_pct").desc(), c("avg_profit_pct").desc())


def dp_optimal_by_pair(t, min_categories: int = 2):
    cats = [name for _op, _v, name in L.DURATION_CATEGORIES] + [L.DURATION_CATEGORIES_ELSE]
    cols = ["scalp_efficiency", "short_efficiency", "day_efficiency", "swing_efficiency"]
    g = (
        _dp(t, "by_pair")
        .groupBy("pair")
        .agg(
            F.countDistinct("duration_category").alias("categories_traded"),
            *[F.max(F.when(c("duration_category") == cat, c("profit_per_hour"))).alias(col) for cat, col in zip(cats, cols)],
            F.max("profit_per_hour").alias("_best"),
        )
        .where(c("categories_traded") >= min_categories)
    )
    opt = pick([(c("_best") == c(col), cat) for cat, col in zip(cats[:3], cols[:3])], cats[3])
    return g.select("pair", "categories_traded", *cols, opt.alias("optimal_duration_category"), "_best").orderBy(
        c("_best").desc()
    ).drop("_best")


def _dp_pair_bands(t, name, bands, else_label, aggs):
    return _dp(t, "by_pair").groupBy(band("optimal_exit_timing_minutes", bands, else_label).alias(name)).agg(*aggs)


def dp_timing_ranges(t):
    return _dp_pair_bands(
        t,
        "timing_range",
        L.TIMING_RANGES,
        L.TIMING_RANGES_ELSE,
        [
            F.count(F.lit(1)).alias("pattern_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.avg("profit_per_hour"), 3).alias("avg_profit_per_hour"),
            F.sum("trade_count").alias("total_trades_in_range"),
        ],
    ).orderBy(c("avg_profit_per_hour").desc())


def dp_windows(t):
    return _dp_pair_bands(
        t,
        "duration_window",
        L.DURATION_WINDOWS,
        L.DURATION_WINDOWS_ELSE,
        [
            F.count(F.lit(1)).alias("pattern_count"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.sum("total_profit_abs"), 2).alias("total_profit_in_window"),
            R(F.avg("profit_per_hour"), 3).alias("avg_efficiency"),
        ],
    ).orderBy(c("avg_efficiency").desc())


def dp_strategy_efficiency(t, min_categories: int = 2):
    return (
        _dp(t, "by_strategy")
        .groupBy("strategy")
        .agg(
            F.countDistinct("duration_category").alias("duration_categories_used"),
            R(F.avg("avg_profit_pct"), 2).alias("overall_avg_profit"),
            R(F.avg("profit_per_hour"), 3).alias("overall_efficiency"),
            F.max("profit_per_hour").alias("best_efficiency"),
            F.min("profit_per_hour").alias("worst_efficiency"),
            R(F.max("profit_per_hour") - F.min("profit_per_hour"), 3).alias("efficiency_range"),
        )
        .where(c("duration_categories_used") >= min_categories)
        .orderBy(c("overall_efficiency").desc())
    )


def dp_category_matrix(t):
    return (
        _dp(t, "by_pair")
        .groupBy("duration_category")
        .agg(
            F.countDistinct("pair").alias("pairs_using_duration"),
            R(F.avg("avg_profit_pct"), 2).alias("avg_profit_pct"),
            avg_win_pct().alias("avg_win_rate_pct"),
            R(F.avg("profit_per_hour"), 3).alias("avg_efficiency"),
            F.sum("trade_count").alias("total_trades"),
            R(F.sum("total_profit_abs"), 2).alias("total_profit_generated"),
        )
        .orderBy(c("avg_efficiency").desc())
    )


def dp_direct(t):
    d = c("trade_duration")
    return (
        t.closed.where(d.isNotNull())
        .groupBy(band(d, L.STRATEGY_DURATION_BANDS, L.STRATEGY_DURATION_BANDS_ELSE).alias("duration_category"))
        .agg(
            m.n_rows().alias("trade_count"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            R(m.win_rate() * 100, 1).alias("win_rate_pct"),
            R(F.min(d), 0).alias("min_duration_min"),
            R(F.max(d), 0).alias("max_duration_min"),
            R(F.avg(d), 0).alias("avg_duration_min"),
            # No zero guard here in the reference: x/0 -> NULL.
            R(F.try_divide(F.avg(m.P), F.avg(d) / 60.0), 3).alias("profit_per_hour"),
        )
        .orderBy(c("profit_per_hour").desc())
    )


def dp_hour_histogram(t, max_minutes: int = 2880, min_trades: int = 2):
    d = c("trade_duration")
    return (
        t.closed.where(d.isNotNull() & (d <= max_minutes))
        .groupBy(R(d / 60.0, 1).alias("duration_hours"))
        .agg(
            m.n_rows().alias("trades_at_duration"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            R(F.min(m.P), 2).alias("min_profit_pct"),
            R(F.max(m.P), 2).alias("max_profit_pct"),
        )
        .where(c("trades_at_duration") >= min_trades)
        .orderBy("duration_hours")
    )


def dp_exit_timing(t, min_trades: int = 5, k: int = 15):
    d = c("trade_duration")
    g = (
        t.closed.where(d.isNotNull())
        .groupBy("pair")
        .agg(
            m.n_rows().alias("total_trades"),
            R(F.avg(d), 0).alias("avg_duration_min"),
            R(F.avg(m.P), 2).alias("avg_profit_pct"),
            F.avg(m.P).alias("_avg"),
            R(F.min(d), 0).alias("fastest_exit_min"),
            R(F.max(d), 0).alias("slowest_exit_min"),
            R(F.max(d) - F.min(d), 0).alias("duration_range_min"),
            F.countDistinct(R(d / 60.0, 0)).alias("distinct_duration_hours"),
        )
        .where(c("total_trades") >= min_trades)
    )
    return top(g, k, c("avg_profit_pct").desc_nulls_last(), c("_avg").desc_nulls_last(), c("pair")).drop("_avg")


# ------------------------------------------------------------- health
def _bh(t):
    return t.bot_health_metrics


def _status_rank(s: Column) -> Column:
    return pick([(s == name, i + 1) for i, name in enumerate(L.STATUS_ORDER)], F.lit(None).cast("int"))


def bh_dashboard(t):
    return _bh(t).select(
        "metric_name",
        R("metric_value", 2).alias("current_value"),
        "metric_unit",
        "health_status",
        R("threshold_warning", 2).alias("warning_threshold"),
        R("threshold_critical", 2).alias("critical_threshold"),
        "metric_description",
    ).orderBy(_status_rank(c("health_status")), "metric_name")


def bh_status_summary(t):
    g = _bh(t).groupBy("health_status").agg(F.count(F.lit(1)).alias("metric_count"))
    total = F.sum("metric_count").over(Window.partitionBy(F.lit(1)))
    return g.select(
        "health_status", "metric_count", R(c("metric_count") * 100.0 / total, 1).alias("percentage_of_metrics")
    ).orderBy(_status_rank(c("health_status")))


def bh_attention(t):
    s = c("health_status")
    return (
        _bh(t)
        .where(s.isin(L.CRITICAL, L.WARNING))
        .select(
            "metric_name",
            R("metric_value", 2).alias("current_value"),
            "metric_unit",
            "health_status",
            "recommendation",
            pick([(s == k, v) for k, v in L.PRIORITY.items()], L.PRIORITY_ELSE).alias("priority_level"),
        )
        .orderBy(_status_rank(s), "metric_name")
    )


def _status_counts():
    s = c("health_status")
    return (
        F.count(F.when(s == L.HEALTHY, 1)),
        F.count(F.when(s == L.WARNING, 1)),
        F.count(F.when(s == L.CRITICAL, 1)),
    )


def bh_summary(t):
    healthy, warning, critical = _status_counts()
    return _bh(t).agg(
        F.lit(L.CAPTIONS["bh_summary"]).alias("summary_type"),
        F.count(F.lit(1)).alias("total_metrics"),
        healthy.alias("healthy_metrics"),
        warning.alias("warning_metrics"),
        critical.alias("critical_metrics"),
        R(F.try_divide(healthy * 100.0, F.count(F.lit(1))), 1).alias("health_score_pct"),
    )


def bh_correlated(t):
    stats = t.closed.agg(R(F.avg(m.P), 2).alias("_avg"), R(m.n_rows(), 0).alias("_n"))
    metrics = _bh(t).where(c("metric_name").isin("overall_win_rate", "average_profit_pct"))
    # One-row statistics joined to (at most) two metric rows.
    j = metrics.join(F.broadcast(stats), how="left", on=F.lit(True))
    return j.select(
        "metric_name",
        "metric_value",
        "health_status",
        F.when(c("metric_name") == "overall_win_rate", c("_avg"))
        .when(c("metric_name") == "average_profit_pct", c("_n"))
        .alias("correlated_value"),
    ).orderBy("metric_name")


def _pivot_metrics(t, names: list[str]) -> DataFrame:
    """One row: value and status of each named metric (the reference repeats a
    scalar subquery per field; here it is a single conditional aggregate)."""
    b = _bh(t)
    aggs = []
    for n in names:
        aggs.append(F.max(F.when(c("metric_name") == n, c("metric_value"))).alias(f"v_{n}"))
        aggs.append(F.max(F.when(c("metric_name") == n, c("health_status"))).alias(f"s_{n}"))
    return b.agg(*aggs)


def bh_risk_assessment(t):
    names = ["worst_loss_control", "stop_loss_utilization_rate", "portfolio_diversification"]
    p = _pivot_metrics(t, names)
    s = {n: c(f"s_{n}") for n in names}
    lbl = L.RISK_HEALTH
    return p.select(
        F.lit(L.CAPTIONS["bh_risk_assessment"]).alias("assessment_type"),
        c("v_worst_loss_control").alias("worst_loss_pct"),
        c("v_stop_loss_utilization_rate").alias("sl_trigger_rate_pct"),
        c("v_portfolio_diversification").alias("pairs_traded"),
        pick(
            [
                ((s[names[0]] == L.HEALTHY) & (s[names[1]] == L.HEALTHY) & (s[names[2]] == L.HEALTHY), lbl[0]),
                ((s[names[0]] != L.CRITICAL) & (s[names[1]] != L.CRITICAL), lbl[1]),
            ],
            lbl[2],
        ).alias("overall_risk_health"),
    )


def bh_efficiency(t):
    names = ["trade_duration_efficiency", "trading_activity", "strategy_utilization"]
    p = _pivot_metrics(t, names)
    d, a = c("v_trade_duration_efficiency"), c("v_trading_activity")
    lbl = L.EFFICIENCY_HEALTH
    return p.select(
        F.lit(L.CAPTIONS["bh_efficiency"]).alias("assessment_type"),
        d.alias("avg_duration_min"),
        a.alias("activity_consistency_pct"),
        c("v_strategy_utilization").alias("strategies_count"),
        pick([((d <= 240) & (a >= 60), lbl[0]), ((d <= 480) & (a >= 40), lbl[1])], lbl[2]).alias("efficiency_rating"),
    )


def bh_profitability(t):
    names = ["total_profit_abs", "average_profit_pct", "overall_win_rate", "best_win_achievement"]
    p = _pivot_metrics(t, names)
    tp, ap, wr = c("v_total_profit_abs"), c("v_average_profit_pct"), c("v_overall_win_rate")
    lbl = L.PROFITABILITY
    return p.select(
        F.lit(L.CAPTIONS["bh_profitability"]).alias("check_type"),
        R(tp, 2).alias("total_profit"),
        R(ap, 2).alias("avg_profit_pct"),
        R(wr, 1).alias("win_rate_pct"),
        R("v_best_win_achievement", 2).alias("best_win_pct"),
        pick([((tp > 0) & (ap > 0.5) & (wr > 60), lbl[0]), (tp >= 0, lbl[1])], lbl[2]).alias("profitability_status"),
    )


def _alerts(t, status: str, threshold: str, threshold_alias: str, action_alias: str, caption: str):
    cols = [
        c("metric_name").alias("alert_metric"),
        c("metric_value").alias("current_value"),
        c(threshold).alias(threshold_alias),
        "metric_unit",
        c("recommendation").alias(action_alias),
        F.lit(L.CAPTIONS[caption]).alias("alert_level"),
        t.analysis_date.alias("alert_time"),
    ]
    return _bh(t).where(c("health_status") == status).select(*cols).orderBy("alert_metric")


def bh_critical_alerts(t):
    return _alerts(t, L.CRITICAL, "threshold_critical", "critical_threshold", "action_required", "critical_alert")


def bh_warning_alerts(t):
    return _alerts(t, L.WARNING, "threshold_warning", "warning_threshold", "suggested_action", "warning_alert")


def bh_score(t):
    healthy, warning, critical = _status_counts()
    score = F.try_divide(healthy * 100.0, F.count(F.lit(1)))
    return _bh(t).agg(
        F.lit(L.CAPTIONS["bh_score"]).alias("metric_type"),
        R(score, 1).alias("health_score_pct"),
        healthy.alias("healthy_count"),
        warning.alias("warning_count"),
        critical.alias("critical_count"),
        F.count(F.lit(1)).alias("total_metrics"),
        band(score, L.HEALTH_SCORE_BANDS, L.HEALTH_SCORE_ELSE).alias("overall_health_rating"),
    )


def bh_realtime(t):
    wr, ap, tp = m.win_rate(), F.avg(m.P), F.sum(m.A)
    return t.closed.agg(
        F.lit(L.CAPTIONS["bh_realtime"]).alias("check_type"),
        m.n_rows().alias("total_trades"),
        R(wr * 100, 1).alias("current_win_rate_pct"),
        R(ap, 2).alias("current_avg_profit_pct"),
        R(tp, 2).alias("current_total_profit"),
        R(F.min(m.P), 2).alias("current_worst_loss_pct"),
        F.countDistinct("pair").alias("pairs_currently_traded"),
        F.countDistinct("strategy").alias("strategies_currently_used"),
        pick([((wr >= 0.6) & (ap >= 0.5) & (tp > 0), L.HEALTHY), ((wr >= 0.4) & (tp >= 0), L.WARNING)], L.CRITICAL).alias(
            "real_time_health_status"
        ),
    )


def bh_recent30(t, n: int = 30):
    # Global top-n by trade id: per-partition top-n then a merge of n rows each.
    recent = t.closed.select("trade_id", m.P, "trade_duration", m.A).orderBy(c("trade_id").desc()).limit(n)
    ap, wr = F.avg(m.P), m.win_rate()
    lbl = L.TREND
    return recent.agg(
        F.lit(L.CAPTIONS["bh_recent30"]).alias("trend_type"),
        m.n_rows().alias("recent_trades"),
        R(ap, 2).alias("recent_avg_profit_pct"),
        R(wr * 100, 1).alias("recent_win_rate_pct"),
        R(F.sum(m.A), 2).alias("recent_total_profit"),
        R(F.avg("trade_duration"), 0).alias("recent_avg_duration_min"),
        pick([((ap >= 0.5) & (wr >= 0.6), lbl[0]), (ap >= 0.0, lbl[1])], lbl[2]).alias("trend_direction"),
    )


def bh_utilization(t):
    pairs, strategies = F.countDistinct("pair"), F.countDistinct("strategy")
    lbl = L.DIVERSIFICATION
    return t.closed.agg(
        F.lit(L.CAPTIONS["bh_utilization"]).alias("metric_type"),
        pairs.alias("unique_pairs_traded"),
        strategies.alias("unique_strategies_used"),
        F.countDistinct("base_currency").alias("unique_base_currencies"),
        F.countDistinct("quote_currency").alias("unique_quote_currencies"),
        F.countDistinct(F.to_date("open_date")).alias("unique_trading_days"),
        R(F.avg("stake_amount"), 2).alias("avg_stake_per_trade"),
        R(F.sum("stake_amount"), 2).alias("total_capital_deployed"),
        pick([((pairs >= 5) & (strategies >= 2), lbl[0]), (pairs >= 3, lbl[1])], lbl[2]).alias("diversification_level"),
    )


# ------------------------------------------------------------- data quality
def _nulls(col_name: str) -> Column:
    return F.count(F.when(c(col_name).isNull(), 1))


def _count_if(cond: Column) -> Column:
    return F.count(F.when(cond, 1))


def dq_pr_quality(t):
    return _pr(t).agg(
        F.lit(L.CAPTIONS["pr_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_pairs"),
        _nulls("profit_pct").alias("null_profit_count"),
        _nulls("win_rate").alias("null_winrate_count"),
        _count_if(c("trade_count") < 1).alias("invalid_trade_count"),
    )


def dq_rm_quality(t):
    return t.risk_metrics.agg(
        F.lit(L.CAPTIONS["rm_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_records"),
        _nulls("stop_loss_triggered_count").alias("null_sl_count"),
        _nulls("max_drawdown_pct").alias("null_drawdown_count"),
        _count_if(c("max_drawdown_pct") > 0).alias("positive_drawdown_errors"),
    )


def dq_sp_quality(t):
    return _sp(t).agg(
        F.lit(L.CAPTIONS["sp_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_strategies"),
        _nulls("avg_profit_pct").alias("null_profit_count"),
        _nulls("win_rate").alias("null_winrate_count"),
        _count_if(c("total_trades") < 1).alias("invalid_trade_count"),
        _count_if(c("win_rate") > 1.0).alias("invalid_winrate_count"),
    )


def dq_ta_quality(t):
    return t.timing_analysis.agg(
        F.lit(L.CAPTIONS["ta_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_records"),
        F.countDistinct("time_category").alias("categories_analyzed"),
        _nulls("avg_profit_pct").alias("null_profit_count"),
        _count_if(c("trade_count") < 1).alias("invalid_trade_count"),
        F.min("analysis_date").alias("oldest_analysis"),
        F.max("analysis_date").alias("newest_analysis"),
    )


def dq_pa_quality(t):
    return _pa(t).agg(
        F.lit(L.CAPTIONS["pa_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_pairs"),
        _nulls("avg_profit_pct").alias("null_profit_count"),
        _nulls("win_rate").alias("null_winrate_count"),
        _count_if(c("total_trades") < 1).alias("invalid_trade_count"),
        _count_if(c("win_rate") > 1.0).alias("invalid_winrate_count"),
        _nulls("base_currency").alias("null_base_currency_count"),
    )


def dq_sl_quality(t):
    return t.stop_loss_analytics.agg(
        F.lit(L.CAPTIONS["sl_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_records"),
        _nulls("sl_effectiveness_pct").alias("null_effectiveness_count"),
        _nulls("sl_trigger_rate_pct").alias("null_trigger_rate_count"),
        _count_if(c("sl_effectiveness_pct") > 100).alias("invalid_effectiveness_count"),
        _count_if(c("total_trades_with_sl") < c("sl_triggered_count")).alias("logic_errors"),
    )


def dq_dp_quality(t):
    return t.duration_patterns.agg(
        F.lit(L.CAPTIONS["dp_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_records"),
        _nulls("avg_profit_pct").alias("null_profit_count"),
        _nulls("optimal_exit_timing_minutes").alias("null_timing_count"),
        _nulls("profit_per_hour").alias("null_efficiency_count"),
        _count_if(c("trade_count") < 1).alias("invalid_trade_count"),
        _count_if(c("min_duration_minutes") > c("max_duration_minutes")).alias("duration_logic_errors"),
    )


def dq_bh_quality(t):
    s = c("health_status")
    return _bh(t).agg(
        F.lit(L.CAPTIONS["bh_quality"]).alias("check_type"),
        F.count(F.lit(1)).alias("total_metrics"),
        _nulls("metric_value").alias("null_value_count"),
        _nulls("health_status").alias("null_status_count"),
        _count_if(~s.isin(L.HEALTHY, L.WARNING, L.CRITICAL)).alias("invalid_status_count"),
        _nulls("metric_unit").alias("null_unit_count"),
    )


def dq_key_unique(t):
    """DQ-9: number of natural keys held by more than one row, per result table."""
    from tradescope.plans.tables import NATURAL_KEYS

    out = None
    for name, keys in NATURAL_KEYS.items():
        dup = (
            t.table(name)
            .groupBy(*keys)
            .count()
            .agg(F.lit(name).alias("table_name"), F.count(F.when(c("count") > 1, 1)).alias("duplicate_keys"))
        )
        out = dup if out is None else out.unionByName(dup)
    return out


def dq_trades_nulls(t):
    return t.closed.agg(
        m.n_rows().alias("total_trades"),
        F.count(m.P).alias("trades_with_profit"),
        F.count("trade_duration").alias("trades_with_duration"),
    )


# ------------------------------------------------------------- guide queries
def doc_top_pairs(t, limit: int = 5):
    return top(_pr(t), limit, c("profit_pct").desc_nulls_last(), c("entity_name")).select(
        "entity_name", "profit_pct", "win_rate", "trade_count"
    )


def doc_strategy_list(t):
    return _sp(t).select(
        "strategy_name", pct().alias("win_rate_pct"), R("avg_profit_pct", 2).alias("avg_profit"), "total_trades"
    ).orderBy(c("avg_profit").desc())


def doc_health_list(t):
    return _bh(t).select("metric_name", R("metric_value", 2).alias("value"), "metric_unit", "health_status").orderBy("metric_name")


def doc_health_lookup(t, metric: str = "overall_win_rate"):
    return _bh(t).where(c("metric_name") == metric).select(
        "metric_name", "metric_value", "metric_unit", "health_status", "threshold_warning", "threshold_critical"
    )


def doc_best_hours(t):
    return _ta(t, "overall").select(
        c("best_performance_hour").alias("best_hour"),
        c("worst_performance_hour").alias("worst_hour"),
        R("weekend_performance_pct", 2).alias("weekend_profit"),
        R("weekday_performance_pct", 2).alias("weekday_profit"),
    )


def doc_high_risk(t, worst: float = -10, vol: float = 5):
    return (
        _rm(t, "by_pair")
        .where((c("max_drawdown_pct") < worst) | (c("volatility_pct") > vol))
        .select(
            c("entity_name").alias("trading_pair"),
            c("max_drawdown_pct").alias("worst_loss"),
            "volatility_pct",
            "stop_loss_effectiveness_pct",
        )
        .orderBy("max_drawdown_pct")
    )


def doc_three_way(t, k: int = 10):
    pr = _pr(t).alias("pr")
    rm = t.risk_metrics.alias("rm")
    ta = _ta(t, "overall").select("best_performance_hour")
    j = pr.join(rm, c("pr.entity_name") == c("rm.entity_name")).join(F.broadcast(ta), how="inner", on=F.lit(True))
    return top(j, k, c("pr.profit_pct").desc_nulls_last(), c("pr.entity_name"), c("rm.metric_type")).select(
        c("pr.entity_name").alias("pair"), c("pr.profit_pct").alias("profit_pct"), c("rm.volatility_pct").alias("volatility_pct"), "best_performance_hour"
    )


def doc_recent_trades(t, k: int = 10):
    return top(t.closed, k, c("close_date").desc_nulls_last(), c("trade_id").desc()).select(
        "pair",
        "strategy",
        R(c("profit_ratio") * 100, 2).alias("profit_pct"),
        "exit_reason",
        c("open_date").alias("open_date_utc"),
        c("close_date").alias("close_date_utc"),
    )


def src_normalize_trades(t):
    """SRC-2: the bot's own trade columns, normalised back to ``trades``."""
    from tradescope.sources.trades import normalize_trades, to_upstream

    return normalize_trades(to_upstream(t.trades))


def doc_strategy_raw(t):
    cp = c("profit_ratio")
    return t.closed.groupBy("strategy").agg(
        m.n_rows().alias("total_trades"),
        F.avg(cp * 100).alias("avg_profit_pct"),
        (m.count_when(cp > 0) * 100.0 / m.n_rows()).alias("win_rate"),
    )
