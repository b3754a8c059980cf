"""duration_patterns: duration_based / by_pair / by_strategy from the grain statistics."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.functions import labels as L
from tradescope.functions.bands import band
from tradescope.operators import grains as G

DURATION_COLUMNS = [
    "pattern_type",
    "duration_category",
    "min_duration_minutes",
    "max_duration_minutes",
    "trade_count",
    "win_rate",
    "avg_profit_pct",
    "total_profit_abs",
    "optimal_exit_timing_minutes",
    "profit_per_hour",
    "pair",
    "strategy",
]
NEEDS = ["category", "pair_category", "strategy_category"]


def duration_category(d="trade_duration"):
    """m_duration_category (after the not-null filter)."""
    return band(d, L.DURATION_CATEGORIES, L.DURATION_CATEGORIES_ELSE)


def build_duration_patterns(
    closed: DataFrame,
    variant: str = "sql",
    stats: DataFrame | None = None,
    min_pair_trades: int = 2,
    min_strategy_trades: int = 3,
) -> DataFrame:
    poller = variant == "poller"
    st = G.stats_for(closed, ["category"] if poller else NEEDS, stats)
    specs = [("duration_based", "category", None, 1)]
    if not poller:
        specs += [("by_pair", "pair_category", "pair", min_pair_trades), ("by_strategy", "strategy_category", "strategy", min_strategy_trades)]
    out = None
    for pattern, name, key, min_n in specs:
        part = G.grain(st, name).where(F.col("n") >= min_n).select(
            F.lit(pattern).alias("pattern_type"),
            "duration_category",
            F.col("min_d").cast("double").alias("min_duration_minutes"),
            F.col("max_d").cast("double").alias("max_duration_minutes"),
            F.col("n").alias("trade_count"),
            G.win_rate().alias("win_rate"),
            G.avg_p().alias("avg_profit_pct"),
            F.col("s_a").alias("total_profit_abs"),
            G.avg_duration().alias("optimal_exit_timing_minutes"),
            (F.lit(None).cast("double") if poller else G.profit_per_hour()).alias("profit_per_hour"),
            (F.col("pair") if key == "pair" else F.lit(None).cast("string")).alias("pair"),
            (F.col("strategy") if key == "strategy" else F.lit(None).cast("string")).alias("strategy"),
        )
        out = part if out is None else out.unionByName(part)
    return out
