"""stop_loss_analytics: overall / by_pair / by_strategy from the grain statistics.

The reference fills two columns afterwards with correlated updates: the
optimal stop level (best average outcome among rounded levels with at least
two trades) and the maximum loss taken through a stop-loss exit. Both are
decorrelated: the max loss is one more statistic of the same grains (its
"NULL matches everything" predicate is exactly the grain of each row), and
the optimal level comes from the level grains of the same aggregate.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.functions import measures as m
from tradescope.operators import grains as G

SL_COLUMNS = [
    "analysis_type",
    "pair",
    "strategy",
    "stop_loss_level_pct",
    "total_trades_with_sl",
    "sl_triggered_count",
    "sl_trigger_rate_pct",
    "sl_effectiveness_pct",
    "avg_loss_when_triggered_pct",
    "avg_profit_when_not_triggered_pct",
    "max_loss_prevented_pct",
    "optimal_sl_level_pct",
    "trades_without_sl",
    "avg_loss_without_sl_pct",
]
NEEDS = ["overall", "pair", "strategy", "level", "pair_level"]


def _sl_row(df: DataFrame, analysis_type: str, pair, strategy, kept: str, overall: bool, poller: bool = False) -> DataFrame:
    c = F.col
    trig = c("trig_sl")
    if poller:  # the poller divides first and scales after, unrounded
        eff = F.when(trig > 0, (c(kept) * m.ONE / trig) * m.HUNDRED).otherwise(m.ZERO)
        rate = F.lit(None).cast("double")
    else:
        eff = F.when(trig > 0, F.round(c(kept) * m.HUNDRED / trig, 2)).otherwise(m.ZERO)
        rate = F.round(F.try_divide(trig * m.HUNDRED, c("n_sl")), 2)
    null_d = F.lit(None).cast("double")
    return df.select(
        F.lit(analysis_type).alias("analysis_type"),
        (pair if pair is not None else F.lit(None).cast("string")).alias("pair"),
        (strategy if strategy is not None else F.lit(None).cast("string")).alias("strategy"),
        G.avg("s_level", "n_sl").alias("stop_loss_level_pct"),
        c("n_sl").alias("total_trades_with_sl"),
        trig.alias("sl_triggered_count"),
        rate.alias("sl_trigger_rate_pct"),
        eff.alias("sl_effectiveness_pct"),
        G.avg("s_p_trig", "n_p_trig").alias("avg_loss_when_triggered_pct"),
        G.avg("s_p_not", "n_p_not").alias("avg_profit_when_not_triggered_pct"),
        (null_d if poller else F.abs(c("min_p_sl_exit"))).alias("max_loss_prevented_pct"),
        (c("n_nosl") if overall else F.lit(None).cast("long")).alias("trades_without_sl"),
        (G.avg("s_loss_nosl", "n_loss_nosl") if overall else null_d).alias("avg_loss_without_sl_pct"),
    )


def optimal_levels(stats: DataFrame, min_trades: int = 2) -> DataFrame:
    """m_optimal_sl for every pair and overall: ``(_type, _pair, optimal_sl_level_pct)``.

    Levels are ``ROUND(stop_loss_pct, 1)``; among levels with at least
    ``min_trades`` trades the best average profit wins; ties go to the most
    negative level.
    """
    per = G.grain(stats, "level").select(F.lit("overall").alias("_type"), F.lit(None).cast("string").alias("_pair"), "level", "n", G.avg_p().alias("a")).unionByName(
        G.grain(stats, "pair_level").select(F.lit("by_pair").alias("_type"), F.col("pair").alias("_pair"), "level", "n", G.avg_p().alias("a"))
    )
    return (
        per.where(F.col("n") >= min_trades)
        .groupBy("_type", "_pair")
        .agg(F.max_by("level", F.struct(F.col("a").isNotNull(), F.col("a"), -F.col("level"))).alias("optimal_sl_level_pct"))
    )


def build_stop_loss_analytics(
    closed: DataFrame,
    variant: str = "sql",
    stats: DataFrame | None = None,
    min_pair_trades: int = 3,
    min_strategy_trades: int = 5,
) -> DataFrame:
    st = G.stats_for(closed, ["pair"] if variant == "poller" else NEEDS, stats)
    if variant == "poller":
        pairs = G.grain(st, "pair").where(F.col("n_sl") > 0)
        return _sl_row(pairs, "by_pair", F.col("pair"), None, "kept10_sl", False, poller=True).withColumn(
            "optimal_sl_level_pct", F.lit(None).cast("double")
        ).select(*SL_COLUMNS)
    parts = [
        _sl_row(G.overall(st), "overall", None, None, "kept10_sl", True),
        _sl_row(G.grain(st, "pair").where(F.col("n_sl") >= min_pair_trades), "by_pair", F.col("pair"), None, "kept10_sl", False),
        _sl_row(G.grain(st, "strategy").where(F.col("n_sl") >= min_strategy_trades), "by_strategy", None, F.col("strategy"), "kept5_sl", False),
    ]
    grains = parts[0].unionByName(parts[1]).unionByName(parts[2])
    opt = optimal_levels(st)
    joined = grains.join(
        opt,
        (grains["analysis_type"] == opt["_type"]) & grains["pair"].eqNullSafe(opt["_pair"]),
        "left",
    )
    return joined.select(*SL_COLUMNS)
