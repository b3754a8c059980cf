"""Several bots in one analysis (SRC-5): the bot is part of every key.

Input is ``sources.trades.union_bots``: closed trades with a ``bot_id``. Trade ids
of different bots may collide; a trade is known by bot and id.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradescope.operators import grains as G
from tradescope.operators.order_stats import element_at_fraction
from tradescope.operators.streaks import DEFAULT_BUCKET_IDS, max_streaks

SEPARATOR = "\u001f"


def rankings_by_bot(trades: DataFrame) -> DataFrame:
    """Pairs ranked by average profit within each bot, from one scan and one aggregate."""
    rows = G.stats_by(trades, ["bot_id", "pair"]).select(
        "bot_id",
        F.col("pair").alias("entity_name"),
        G.avg_p().alias("profit_pct"),
        F.col("s_a").alias("profit_abs"),
        F.col("n").alias("trade_count"),
        G.win_rate().alias("win_rate"),
    )
    # One row per bot and pair.
    order = Window.partitionBy("bot_id").orderBy(F.desc_nulls_last("profit_pct"), F.asc_nulls_first("entity_name"))
    return rows.withColumn("rank_position", F.row_number().over(order))


def strategies_by_bot(trades: DataFrame, bucket_ids: int = DEFAULT_BUCKET_IDS) -> DataFrame:
    """Strategy metrics and longest runs within each bot: one scan for the statistics, one for the runs."""
    core = G.stats_by(trades, ["bot_id", "strategy"]).select(
        "bot_id",
        F.col("strategy").alias("strategy_name"),
        F.col("n").alias("total_trades"),
        F.col("wins").alias("winning_trades"),
        F.col("losses").alias("losing_trades"),
        G.win_rate().alias("win_rate"),
        G.avg_p().alias("avg_profit_pct"),
        G.profit_factor().alias("profit_factor"),
        G.multi_trade(G.sharpe()).alias("sharpe_ratio"),
    )
    keyed = trades.withColumn("bot_strategy", F.concat_ws(SEPARATOR, "bot_id", "strategy"))
    runs = max_streaks(keyed, "bot_strategy", bucket_ids).select(
        F.split_part("bot_strategy", F.lit(SEPARATOR), F.lit(1)).alias("bot_id"),
        F.split_part("bot_strategy", F.lit(SEPARATOR), F.lit(2)).alias("strategy_name"),
        "max_consecutive_wins",
        "max_consecutive_losses",
    )
    return core.join(runs, ["bot_id", "strategy_name"], "left")


def var_by_bot(trades: DataFrame, level: float = 0.05) -> DataFrame:
    """``bot_id, var_95_pct``: value at risk of each bot's losing trades, all bots in the same two scans."""
    losing = G.only_closed(trades).where(F.col("profit_pct") < 0)
    return element_at_fraction(losing, "profit_pct", level, ["bot_id"], "var_95_pct")
