"""timing_analysis: overall / hourly / daily / monthly rows (subtype union)."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradescope.functions import labels as L
from tradescope.operators import grains as G

TIMING_COLUMNS = [
    "time_category",
    "trade_count",
    "win_rate",
    "avg_profit_pct",
    "total_profit_abs",
    "best_performance_hour",
    "worst_performance_hour",
    "weekend_performance_pct",
    "weekday_performance_pct",
    "duration_minutes_avg",
    "volatility_pct",
    "hour_of_day",
    "day_of_week",
    "day_of_month",
    "month_of_year",
    "time_period_name",
]
_INT_COLS = {"best_performance_hour", "worst_performance_hour", "hour_of_day", "day_of_week", "day_of_month", "month_of_year"}


def _conform(df: DataFrame) -> DataFrame:
    cols = []
    for c in TIMING_COLUMNS:
        if c in df.columns:
            cols.append(F.col(c))
        else:
            t = "int" if c in _INT_COLS else ("string" if c == "time_period_name" else "double")
            cols.append(F.lit(None).cast(t).alias(c))
    return df.select(*cols)


def _name_of(value, names, first: int) -> Column:
    expr = None
    for i, name in enumerate(names):
        cond = value == F.lit(first + i)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


def hour_period(hour) -> Column:
    expr = None
    for lo, hi, name in L.HOUR_PERIODS:
        cond = hour.between(lo, hi)
        expr = F.when(cond, F.lit(name)) if expr is None else expr.when(cond, F.lit(name))
    return expr


NEEDS = ["overall", "hour", "dow", "month"]


def _basic_from_stats():
    return [
        F.col("n").alias("trade_count"),
        G.win_rate().alias("win_rate"),
        G.avg_p().alias("avg_profit_pct"),
        F.col("s_a").alias("total_profit_abs"),
        G.avg_duration().alias("duration_minutes_avg"),
    ]


def build_timing_analysis(closed: DataFrame, variant: str = "sql", stats: DataFrame | None = None) -> DataFrame:
    """All four categories from the grain statistics (overall, hour, weekday,
    month). Undated trades count in the overall row only, as in the
    reference. Best and worst hour are picked from the (at most 24) hourly
    rows of the same aggregate.
    """
    poller = variant == "poller"
    st = G.stats_for(closed, ["overall", "hour"] if poller else NEEDS, stats)
    hours = G.grain(st, "hour").select(
        "hour_of_day", *_basic_from_stats(), G.volatility().alias("volatility_pct")
    )
    h = F.col("hour_of_day")
    has = F.col("avg_profit_pct").isNotNull()
    picks = hours.agg(
        F.max_by(h, F.struct(has, F.col("avg_profit_pct"), -h)).alias("best_performance_hour"),
        F.min_by(h, F.struct(has, F.col("avg_profit_pct"), h)).alias("worst_performance_hour"),
    )
    ov = (
        G.overall(st)
        .select(
            *_basic_from_stats(),
            G.avg("s_p_weekend", "n_p_weekend").alias("weekend_performance_pct"),
            G.avg("s_p_weekday", "n_p_weekday").alias("weekday_performance_pct"),
        )
        .join(F.broadcast(picks), how="left", on=F.lit(True))  # 1 row x 1 row
        .withColumn("time_category", F.lit("overall"))
    )
    if poller:  # the overall row alone, with 0 where nothing was found
        return _conform(ov.na.fill(0, ["best_performance_hour", "worst_performance_hour", "weekend_performance_pct", "weekday_performance_pct"]))
    hourly = hours.select("*", hour_period(h).alias("time_period_name"), F.lit("hourly").alias("time_category"))
    daily = G.grain(st, "dow").select(
        "day_of_week",
        *_basic_from_stats(),
        _name_of(F.col("day_of_week"), L.DAY_NAMES, 0).alias("time_period_name"),
        F.lit("daily").alias("time_category"),
    )
    monthly = (
        G.grain(st, "month")
        .where(F.col("n") >= 2)
        .select(
            "month_of_year",
            *_basic_from_stats(),
            _name_of(F.col("month_of_year"), L.MONTH_NAMES, 1).alias("time_period_name"),
            F.lit("monthly").alias("time_category"),
        )
    )
    out = _conform(ov)
    for part in (hourly, daily, monthly):
        out = out.unionByName(_conform(part))
    return out
