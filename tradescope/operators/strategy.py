"""strategy_performance: strategy grain of the grain statistics plus streaks."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.operators import grains as G
from tradescope.operators.streaks import DEFAULT_BUCKET_IDS, max_streaks

NEEDS = ["strategy"]

STRATEGY_COLUMNS = [
    "strategy_name",
    "total_trades",
    "winning_trades",
    "losing_trades",
    "win_rate",
    "avg_profit_pct",
    "total_profit_abs",
    "profit_factor",
    "expectancy",
    "best_trade_pct",
    "worst_trade_pct",
    "consistency_score",
    "avg_trade_duration_minutes",
    "max_consecutive_wins",
    "max_consecutive_losses",
    "sharpe_ratio",
    "sortino_ratio",
    "calmar_ratio",
]


def build_strategy_performance(
    closed: DataFrame,
    variant: str = "sql",
    bucket_ids: int = DEFAULT_BUCKET_IDS,
    stats: DataFrame | None = None,
    streaks: DataFrame | None = None,
) -> DataFrame:
    """Core metrics, then (SQL variant) consistency/Sharpe/Sortino/Calmar for
    strategies with more than one trade and the longest win/loss streaks.

    The reference's correlated ratio updates are the same grain statistics;
    the streaks (raw-row operator) are joined back on the strategy key.
    """
    g = G.grain(G.stats_for(closed, NEEDS, stats), "strategy")
    sql = variant == "sql"
    null_d = F.lit(None).cast("double")
    agg = g.select(
        F.col("strategy").alias("strategy_name"),
        F.col("n").alias("total_trades"),
        F.col("wins").alias("winning_trades"),
        F.col("losses").alias("losing_trades"),
        G.win_rate().alias("win_rate"),
        G.avg_p().alias("avg_profit_pct"),
        F.col("s_a").alias("total_profit_abs"),
        G.profit_factor().alias("profit_factor"),
        (G.avg_p() * G.win_rate()).alias("expectancy"),
        F.col("max_p").alias("best_trade_pct"),
        F.col("min_p").alias("worst_trade_pct"),
        (G.multi_trade(G.consistency(), F.lit(0.5)) if sql else F.lit(0.5)).alias("consistency_score"),
        G.avg_duration().alias("avg_trade_duration_minutes"),
        (G.multi_trade(G.sharpe()) if sql else null_d).alias("sharpe_ratio"),
        (G.multi_trade(G.sortino()) if sql else null_d).alias("sortino_ratio"),
        (G.multi_trade(G.calmar()) if sql else null_d).alias("calmar_ratio"),
    )
    if sql:
        if streaks is None:
            streaks = max_streaks(closed, "strategy", bucket_ids=bucket_ids)
        agg = agg.join(streaks.withColumnRenamed("strategy", "strategy_name"), "strategy_name", "left")
    else:
        agg = agg.select("*", *[F.lit(None).cast("long").alias(c) for c in ("max_consecutive_wins", "max_consecutive_losses")])
    return agg.select(*STRATEGY_COLUMNS)
