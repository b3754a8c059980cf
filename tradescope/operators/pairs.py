"""pair_analytics: pair grain of the grain statistics, streaks and Sharpe ratio."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.operators import grains as G
from tradescope.operators.streaks import DEFAULT_BUCKET_IDS, max_streaks

NEEDS = ["pair_currency"]

PAIR_COLUMNS = [
    "pair",
    "base_currency",
    "quote_currency",
    "total_trades",
    "winning_trades",
    "losing_trades",
    "win_rate",
    "avg_profit_pct",
    "total_profit_abs",
    "avg_trade_duration_minutes",
    "price_volatility_pct",
    "best_trade_pct",
    "worst_trade_pct",
    "total_volume",
    "avg_stake_amount",
    "max_consecutive_wins",
    "max_consecutive_losses",
    "profit_factor",
    "sharpe_ratio",
]

POLLER_COLUMNS = PAIR_COLUMNS[:11]


def build_pair_analytics(
    closed: DataFrame,
    variant: str = "sql",
    bucket_ids: int = DEFAULT_BUCKET_IDS,
    stats: DataFrame | None = None,
    streaks: DataFrame | None = None,
) -> DataFrame:
    g = G.grain(G.stats_for(closed, NEEDS, stats), "pair_currency")
    agg = g.select(
        "pair",
        "base_currency",
        "quote_currency",
        F.col("n").alias("total_trades"),
        F.col("wins").alias("winning_trades"),
        F.col("losses").alias("losing_trades"),
        G.win_rate().alias("win_rate"),
        G.avg_p().alias("avg_profit_pct"),
        F.col("s_a").alias("total_profit_abs"),
        G.avg_duration().alias("avg_trade_duration_minutes"),
        G.volatility().alias("price_volatility_pct"),
        F.col("max_p").alias("best_trade_pct"),
        F.col("min_p").alias("worst_trade_pct"),
        F.col("s_stake").alias("total_volume"),
        G.avg("s_stake", "n_stake").alias("avg_stake_amount"),
        G.profit_factor().alias("profit_factor"),
        G.multi_trade(G.sharpe()).alias("sharpe_ratio"),
    )
    if variant == "poller":
        return agg.select(*POLLER_COLUMNS)
    if streaks is None:
        streaks = max_streaks(closed, "pair", bucket_ids=bucket_ids)
    return agg.join(streaks, "pair", "left").select(*PAIR_COLUMNS)
