"""bot_health_metrics: eleven metrics from one scalar aggregate, unpivoted with ``stack``."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradescope.functions import labels as L
from tradescope.functions import measures as m

HEALTH_COLUMNS = [
    "metric_name",
    "metric_value",
    "metric_unit",
    "health_status",
    "threshold_warning",
    "threshold_critical",
    "last_calculation",
    "metric_description",
    "recommendation",
]

MICROS_PER_DAY = 86_400_000_000.0


NEEDS = ["overall", "pair", "strategy", "day"]


def trading_stats(closed: DataFrame, stats: DataFrame | None = None) -> DataFrame:
    """The one-row statistics every health metric is computed from.

    Read from the grain statistics: distinct pairs / strategies / trading
    days are the numbers of groups of those grains.
    """
    from tradescope.operators import grains as G

    st = G.stats_for(closed, NEEDS, stats)
    return G.overall(
        st,
        G.count_groups("pair", "pair").alias("pairs_traded"),
        G.count_groups("strategy", "strategy").alias("strategies_used"),
        G.count_groups("day", "open_day").alias("active_trading_days"),
    ).select(
        F.col("n").alias("total_trades"),
        G.win_rate().alias("win_rate"),
        G.avg_p().alias("avg_profit_pct"),
        F.col("s_a").alias("total_profit"),
        F.col("min_p").alias("worst_loss"),
        F.col("max_p").alias("best_win"),
        "pairs_traded",
        "strategies_used",
        G.avg_duration().alias("avg_duration_minutes"),
        F.col("trig").alias("sl_triggered"),
        "active_trading_days",
        (F.timestamp_diff("MICROSECOND", F.col("first_open"), F.col("last_open")) / F.lit(MICROS_PER_DAY)).alias(
            "total_trading_period_days"
        ),
    )


def _metric_values(thresholds: dict | None = None):
    """(value column, status column) per metric, in the reference's order."""
    t = {name: (h, w) for name, _u, _hb, h, w, *_ in L.HEALTH_METRICS}
    if thresholds:
        t.update(thresholds)
    c = F.col
    sl_rate = c("sl_triggered") * m.HUNDRED / F.nullif(c("total_trades"), F.lit(0))
    span = c("total_trading_period_days")
    activity = c("active_trading_days") * m.HUNDRED / span
    out = {}
    out["overall_win_rate"] = (c("win_rate") * F.lit(100), m.status(c("win_rate"), *t["overall_win_rate"]))
    out["average_profit_pct"] = (c("avg_profit_pct"), m.status(c("avg_profit_pct"), *t["average_profit_pct"]))
    out["total_trades"] = (c("total_trades").cast("double"), m.status(c("total_trades"), *t["total_trades"]))
    out["total_profit_abs"] = (c("total_profit"), m.status(c("total_profit"), *t["total_profit_abs"]))
    out["worst_loss_control"] = (c("worst_loss"), m.status(c("worst_loss"), *t["worst_loss_control"], strict=True))
    out["best_win_achievement"] = (c("best_win"), F.lit(L.HEALTHY))
    out["portfolio_diversification"] = (c("pairs_traded").cast("double"), m.status(c("pairs_traded"), *t["portfolio_diversification"]))
    out["strategy_utilization"] = (c("strategies_used").cast("double"), m.status(c("strategies_used"), *t["strategy_utilization"]))
    out["trade_duration_efficiency"] = (
        c("avg_duration_minutes"),
        m.status(c("avg_duration_minutes"), *t["trade_duration_efficiency"], higher_is_better=False),
    )
    out["stop_loss_utilization_rate"] = (sl_rate, m.status(sl_rate, *t["stop_loss_utilization_rate"], higher_is_better=False))
    hb, wb = t["trading_activity"]
    out["trading_activity"] = (
        F.when(span > 0, activity).otherwise(m.ZERO),
        F.when((span > 0) & (activity >= hb), F.lit(L.HEALTHY))
        .when((span > 0) & (activity >= wb), F.lit(L.WARNING))
        .otherwise(F.lit(L.CRITICAL)),
    )
    return out


def build_bot_health(
    closed: DataFrame, variant: str = "sql", thresholds: dict | None = None, as_of=None, stats: DataFrame | None = None
) -> DataFrame:
    """Eleven (SQL) or six (poller) metric rows from one scan.

    The stats row is unpivoted with ``explode(array(struct ...))``: no
    eleven-branch UNION, no re-scan per metric.
    """
    if variant == "poller":
        return _poller_health(trading_stats(closed, stats), as_of)
    stats = trading_stats(closed, stats)
    values = _metric_values(thresholds)
    calculated = _calculated(as_of)
    rows = []
    for name, unit, _hb, _h, _w, tw, tc, desc, rec in L.HEALTH_METRICS:
        value, st = values[name]
        rows.append(
            F.struct(
                F.lit(name).alias("metric_name"),
                value.cast("double").alias("metric_value"),
                F.lit(unit).alias("metric_unit"),
                st.alias("health_status"),
                F.lit(tw).cast("double").alias("threshold_warning"),
                F.lit(tc).cast("double").alias("threshold_critical"),
                calculated.alias("last_calculation"),
                F.lit(desc).alias("metric_description"),
                F.lit(rec).alias("recommendation"),
            )
        )
    return stats.select(F.explode(F.array(*rows)).alias("r")).select("r.*")


def _calculated(as_of) -> Column:
    return F.localtimestamp() if as_of is None else F.lit(as_of).cast("timestamp_ntz")


def _poller_health(stats: DataFrame, as_of) -> DataFrame:
    c = F.col
    calculated = _calculated(as_of)
    shared = (
        F.when((c("win_rate") >= 0.7) & (c("avg_profit_pct") >= 0.5), F.lit(L.HEALTHY))
        .when((c("win_rate") >= 0.5) & (c("avg_profit_pct") >= 0), F.lit(L.WARNING))
        .otherwise(F.lit(L.CRITICAL))
    )
    spec = [
        ("overall_win_rate", c("win_rate") * F.lit(100), "%", shared, 60.0, 40.0),
        ("avg_profit_pct", c("avg_profit_pct"), "%", shared, 0.5, 0.0),
        ("total_trades", c("total_trades").cast("double"), "count", F.lit(L.HEALTHY), None, None),
        ("total_profit", c("total_profit"), "abs", shared, None, None),
        ("worst_loss", c("worst_loss"), "%", F.when(c("worst_loss") > -20, F.lit(L.HEALTHY)).otherwise(F.lit(L.WARNING)), -10.0, -20.0),
        ("best_win", c("best_win"), "%", F.lit(L.HEALTHY), None, None),
    ]
    rows = [
        F.struct(
            F.lit(name).alias("metric_name"),
            value.cast("double").alias("metric_value"),
            F.lit(unit).alias("metric_unit"),
            st.alias("health_status"),
            F.lit(tw).cast("double").alias("threshold_warning"),
            F.lit(tc).cast("double").alias("threshold_critical"),
            calculated.alias("last_calculation"),
            F.lit(None).cast("string").alias("metric_description"),
            F.lit(None).cast("string").alias("recommendation"),
        )
        for name, value, unit, st, tw, tc in spec
    ]
    # No rows at all when there is no closed trade.
    return stats.where(c("total_trades") > 0).select(F.explode(F.array(*rows)).alias("r")).select("r.*")
