"""risk_metrics: overall / by_pair / by_strategy rows in one grouping-sets pass, plus VaR."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.functions import measures as m
from tradescope.operators import grains as G
from tradescope.operators.order_stats import element_at_fraction, element_from_index

RISK_COLUMNS = [
    "metric_type",
    "entity_name",
    "stop_loss_triggered_count",
    "stop_loss_effectiveness_pct",
    "sharpe_ratio",
    "max_drawdown_pct",
    "volatility_pct",
    "var_95_pct",
    "risk_reward_ratio",
]

NEEDS = ["overall", "pair", "strategy"]


def build_risk_overall(stats: DataFrame) -> DataFrame:
    """The overall row from statistics that hold the overall grain."""
    null_d = F.lit(None).cast("double")
    return G.overall(stats).select(
        F.lit("overall").alias("metric_type"),
        F.lit(None).cast("string").alias("entity_name"),
        F.col("trig").alias("stop_loss_triggered_count"),
        G.sl_eff_money().alias("stop_loss_effectiveness_pct"),
        F.lit(0.0).alias("sharpe_ratio"),
        F.col("min_p").alias("max_drawdown_pct"),
        null_d.alias("volatility_pct"),
        null_d.alias("var_95_pct"),
        null_d.alias("risk_reward_ratio"),
    )


def build_risk_grains(
    closed: DataFrame,
    min_pair_trades: int = 3,
    min_strategy_trades: int = 5,
    stats: DataFrame | None = None,
) -> DataFrame:
    """overall / by_pair / by_strategy rows from the shared grain statistics.

    Stop-loss effectiveness: money share for overall, count share above -10
    for pairs and above -5 for strategies (the reference's thresholds).
    """
    st = G.stats_for(closed, NEEDS, stats)
    null_d = F.lit(None).cast("double")
    parts = [build_risk_overall(st)]
    for name, key, kept, min_n in (("by_pair", "pair", "kept10", min_pair_trades), ("by_strategy", "strategy", "kept5", min_strategy_trades)):
        parts.append(
            G.grain(st, key)
            .where(F.col("n") >= min_n)
            .select(
                F.lit(name).alias("metric_type"),
                F.col(key).alias("entity_name"),
                F.col("trig").alias("stop_loss_triggered_count"),
                G.sl_eff_count(kept).alias("stop_loss_effectiveness_pct"),
                null_d.alias("sharpe_ratio"),
                F.col("min_p").alias("max_drawdown_pct"),
                G.volatility().alias("volatility_pct"),
                null_d.alias("var_95_pct"),
                G.risk_reward().alias("risk_reward_ratio"),
            )
        )
    return parts[0].unionByName(parts[1]).unionByName(parts[2])


def losers(closed: DataFrame) -> DataFrame:
    """The losing trades' profits (``is_open`` trades left out)."""
    return G.only_closed(closed).where(F.col(m.P) < 0).select(m.P)


def build_risk_var(closed: DataFrame, level: float = 0.05, index: tuple[DataFrame, DataFrame] | None = None, value: DataFrame | None = None) -> DataFrame:
    """m_var95: among losing trades sorted ascending, the element at ``floor(level*N)``.

    ``index`` is a kept rank index of the losers (range counts, values with
    counts); without it the trades are scanned twice. Either way the search runs
    small jobs while this plan is built. ``value`` is a known result (``var_95_pct``).
    """
    if value is not None:
        value = value.select("var_95_pct")
    elif index is None:
        value = element_at_fraction(losers(closed), m.P, level, out="var_95_pct")
    else:
        value = element_from_index(*index, level, out="var_95_pct")
    return value.select(
        F.lit("var_analysis").alias("metric_type"),
        F.lit("portfolio").alias("entity_name"),
        *[F.lit(None).cast("long" if c == "stop_loss_triggered_count" else "double").alias(c) for c in RISK_COLUMNS[2:7]],
        F.col("var_95_pct"),
        F.lit(None).cast("double").alias("risk_reward_ratio"),
    )


def build_risk_metrics(
    closed: DataFrame,
    variant: str = "sql",
    stats: DataFrame | None = None,
    index: tuple[DataFrame, DataFrame] | None = None,
    value: DataFrame | None = None,
    **params,
) -> DataFrame:
    if variant == "poller":
        return build_risk_overall(G.stats_for(closed, ["overall"], stats))
    return build_risk_grains(closed, stats=stats, **params).unionByName(build_risk_var(closed, index=index, value=value))
