"""performance_rankings: per-pair averages ranked by average profit."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradescope.operators import grains as G

NEEDS = ["pair"]


def build_performance_rankings(closed: DataFrame, variant: str = "sql", stats: DataFrame | None = None) -> DataFrame:
    """``ranking_type='by_pair'`` rows; ``rank_position`` = 1 for the best average profit.

    Read from the pair grain of the shared grain statistics (one hash
    aggregate); the rank is a window over the aggregated rows, one per pair.
    Both variants compute the same rows (the SQL file only adds a no-op
    ``HAVING COUNT(*) >= 1``).
    """
    g = G.grain(G.stats_for(closed, NEEDS, stats), "pair")
    rows = g.select(
        "pair",
        G.avg("s_ratio", "n_ratio").alias("profit_ratio"),
        G.avg_p().alias("profit_pct"),
        F.col("s_a").alias("profit_abs"),
        F.col("n").alias("trade_count"),
        G.win_rate().alias("win_rate"),
        G.avg_duration().alias("avg_duration_minutes"),
        F.col("max_p").alias("max_profit_pct"),
        F.col("min_p").alias("min_profit_pct"),
        F.col("s_stake").alias("total_volume"),
    )
    rank_w = Window.orderBy(F.desc_nulls_last("profit_pct"), F.asc_nulls_first("pair"))
    return rows.select(
        F.lit("by_pair").alias("ranking_type"),
        F.col("pair").alias("entity_name"),
        F.lit("trading_pair").alias("entity_type"),
        "profit_ratio",
        "profit_pct",
        "profit_abs",
        "trade_count",
        "win_rate",
        "avg_duration_minutes",
        "max_profit_pct",
        "min_profit_pct",
        "total_volume",
        F.row_number().over(rank_w).alias("rank_position"),
    )
