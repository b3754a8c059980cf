"""Registry of every query: result-table builders, poller variants, reports,
data-quality checks, guide queries and source checks.

``CATALOG[name](tables) -> DataFrame``. Builders are exposed through a
projection that rounds the one measure whose sum is not exact in binary
(``profit_ratio``) to 9 places. Registered queries date their results ``AS_OF``.
"""

from __future__ import annotations

import datetime as dt
import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.plans import reports as r
from tradescope.plans.tables import NATURAL_KEYS, RESULT_TABLES, Tables
from tradescope.sources.trades import open_closed_counts

AS_OF = dt.datetime(2024, 7, 1, 12, 0)
INEXACT = {"profit_ratio"}


def comparable(df: DataFrame) -> DataFrame:
    return df.select(*[F.round(F.col(n), 9).alias(n) if n in INEXACT else F.col(n) for n in df.columns])


def _builder(name: str, variant: str = "sql") -> Callable[[Tables], DataFrame]:
    def run(t: Tables) -> DataFrame:
        if variant != t.variant:
            t = Tables(t.trades, variant=variant, bucket_ids=t.bucket_ids, as_of=t.as_of)
        return comparable(t.table(name))

    run.__name__ = f"build_{name}"
    return run


BUILDERS = {
    "build_performance_rankings": _builder("performance_rankings"),
    "build_risk_metrics": _builder("risk_metrics"),
    "build_strategy_performance": _builder("strategy_performance"),
    "build_timing_analysis": _builder("timing_analysis"),
    "build_pair_analytics": _builder("pair_analytics"),
    "build_stop_loss_analytics": _builder("stop_loss_analytics"),
    "build_duration_patterns": _builder("duration_patterns"),
    "build_bot_health": _builder("bot_health_metrics"),
}

POLLER = {
    "poll_performance_rankings": _builder("performance_rankings", "poller"),
    "poll_risk": _builder("risk_metrics", "poller"),
    "poll_strategy": _builder("strategy_performance", "poller"),
    "poll_timing": _builder("timing_analysis", "poller"),
    "poll_pair": _builder("pair_analytics", "poller"),
    "poll_stop_loss": _builder("stop_loss_analytics", "poller"),
    "poll_duration": _builder("duration_patterns", "poller"),
    "poll_bot_health": _builder("bot_health_metrics", "poller"),
}

def _part(table: str, column: str | None, value: str | None, cols: list[str]) -> Callable[[Tables], DataFrame]:
    """A §2.3 sub-builder: one subtype / column group of a result table."""

    def run(t: Tables) -> DataFrame:
        df = t.risk_rows(value) if table == "risk_metrics" else t.table(table)
        if column is not None:
            df = df.where(F.col(column) == value)
        return comparable(df.select(*cols))

    return run


def _streaks(key: str, name: str) -> Callable[[Tables], DataFrame]:
    def run(t: Tables) -> DataFrame:
        return t.streaks(key).withColumnRenamed(key, name)

    return run


def _risk_var(t: Tables) -> DataFrame:
    from tradescope.operators.risk import build_risk_var

    return build_risk_var(t.closed).select("metric_type", "entity_name", "var_95_pct")


_SP_KEY = ["strategy_name"]
_SL_KEY = ["analysis_type", "pair", "strategy"]
SUB_BUILDERS = {
    "build_risk_overall": _part("risk_metrics", "metric_type", "overall", ["stop_loss_triggered_count", "stop_loss_effectiveness_pct", "sharpe_ratio", "max_drawdown_pct"]),
    "build_risk_by_pair": _part("risk_metrics", "metric_type", "by_pair", ["entity_name", "stop_loss_triggered_count", "stop_loss_effectiveness_pct", "max_drawdown_pct", "volatility_pct", "risk_reward_ratio"]),
    "build_risk_by_strategy": _part("risk_metrics", "metric_type", "by_strategy", ["entity_name", "stop_loss_triggered_count", "stop_loss_effectiveness_pct", "max_drawdown_pct", "volatility_pct", "risk_reward_ratio"]),
    "build_risk_var": _risk_var,
    "build_strategy_core": _part("strategy_performance", None, None, _SP_KEY + ["total_trades", "winning_trades", "losing_trades", "win_rate", "avg_profit_pct", "total_profit_abs", "profit_factor", "expectancy", "best_trade_pct", "worst_trade_pct", "avg_trade_duration_minutes"]),
    "build_strategy_streaks": _streaks("strategy", "strategy_name"),
    "build_strategy_consistency": _part("strategy_performance", None, None, _SP_KEY + ["consistency_score"]),
    "build_strategy_sharpe": _part("strategy_performance", None, None, _SP_KEY + ["sharpe_ratio"]),
    "build_strategy_sortino": _part("strategy_performance", None, None, _SP_KEY + ["sortino_ratio"]),
    "build_strategy_calmar": _part("strategy_performance", None, None, _SP_KEY + ["calmar_ratio"]),
    "build_timing_overall": _part("timing_analysis", "time_category", "overall", ["trade_count", "win_rate", "avg_profit_pct", "total_profit_abs", "best_performance_hour", "worst_performance_hour", "weekend_performance_pct", "weekday_performance_pct", "duration_minutes_avg"]),
    "build_timing_hourly": _part("timing_analysis", "time_category", "hourly", ["hour_of_day", "time_period_name", "trade_count", "win_rate", "avg_profit_pct", "total_profit_abs", "duration_minutes_avg", "volatility_pct"]),
    "build_timing_daily": _part("timing_analysis", "time_category", "daily", ["day_of_week", "time_period_name", "trade_count", "win_rate", "avg_profit_pct", "total_profit_abs", "duration_minutes_avg"]),
    "build_timing_monthly": _part("timing_analysis", "time_category", "monthly", ["month_of_year", "time_period_name", "trade_count", "win_rate", "avg_profit_pct", "total_profit_abs", "duration_minutes_avg"]),
    "build_pair_core": _part("pair_analytics", None, None, ["pair", "base_currency", "quote_currency", "total_trades", "winning_trades", "losing_trades", "win_rate", "avg_profit_pct", "total_profit_abs", "avg_trade_duration_minutes", "price_volatility_pct", "best_trade_pct", "worst_trade_pct", "total_volume", "avg_stake_amount", "profit_factor"]),
    "build_pair_streaks": _streaks("pair", "pair"),
    "build_pair_sharpe": _part("pair_analytics", None, None, ["pair", "sharpe_ratio"]),
    "build_sl_overall": _part("stop_loss_analytics", "analysis_type", "overall", ["stop_loss_level_pct", "total_trades_with_sl", "sl_triggered_count", "sl_trigger_rate_pct", "sl_effectiveness_pct", "avg_loss_when_triggered_pct", "avg_profit_when_not_triggered_pct", "trades_without_sl", "avg_loss_without_sl_pct"]),
    "build_sl_by_pair": _part("stop_loss_analytics", "analysis_type", "by_pair", ["pair", "stop_loss_level_pct", "total_trades_with_sl", "sl_triggered_count", "sl_trigger_rate_pct", "sl_effectiveness_pct", "avg_loss_when_triggered_pct", "avg_profit_when_not_triggered_pct"]),
    "build_sl_by_strategy": _part("stop_loss_analytics", "analysis_type", "by_strategy", ["strategy", "stop_loss_level_pct", "total_trades_with_sl", "sl_triggered_count", "sl_trigger_rate_pct", "sl_effectiveness_pct", "avg_loss_when_triggered_pct", "avg_profit_when_not_triggered_pct"]),
    "build_sl_optimal": _part("stop_loss_analytics", None, None, _SL_KEY + ["optimal_sl_level_pct"]),
    "build_sl_max_prevented": _part("stop_loss_analytics", None, None, _SL_KEY + ["max_loss_prevented_pct"]),
    "build_duration_based": _part("duration_patterns", "pattern_type", "duration_based", ["duration_category", "min_duration_minutes", "max_duration_minutes", "trade_count", "win_rate", "avg_profit_pct", "total_profit_abs", "optimal_exit_timing_minutes", "profit_per_hour"]),
    "build_duration_by_pair": _part("duration_patterns", "pattern_type", "by_pair", ["pair", "duration_category", "min_duration_minutes", "max_duration_minutes", "trade_count", "win_rate", "avg_profit_pct", "total_profit_abs", "optimal_exit_timing_minutes", "profit_per_hour"]),
    "build_duration_by_strategy": _part("duration_patterns", "pattern_type", "by_strategy", ["strategy", "duration_category", "min_duration_minutes", "max_duration_minutes", "trade_count", "win_rate", "avg_profit_pct", "total_profit_abs", "optimal_exit_timing_minutes", "profit_per_hour"]),
}

REPORT_NAMES = [
    # performance rankings
    "pr_top10", "pr_bottom5", "pr_high_win_low_profit", "pr_high_volume", "pr_portfolio_summary",
    "pr_profit_distribution", "pr_winrate_distribution", "pr_base_currency", "pr_quote_currency", "pr_direct_top20",
    # risk
    "rm_overall", "rm_sl_by_pair", "rm_strategy_compare", "rm_high_risk_pairs", "rm_risk_adjusted",
    "rm_sl_eff_distribution", "rm_volatility_vs_perf", "rm_direct_summary", "rm_by_exit_reason", "rm_daily_drawdown",
    # strategy
    "sp_ranking", "sp_best", "sp_risk_adjusted", "sp_efficiency", "sp_profit_distribution", "sp_winrate_distribution",
    "sp_consistency_distribution", "sp_duration_distribution", "sp_head_to_head", "sp_matrix", "sp_direct", "sp_by_pair",
    # timing
    "ta_overall", "ta_best_hours", "ta_day_of_week", "ta_monthly", "ta_sessions", "ta_weekend_vs_weekday",
    "ta_hour_rating", "ta_volatility", "ta_market_sessions", "ta_consecutive_hours", "ta_direct_hours", "ta_direct_dow",
    # pairs
    "pa_top15", "pa_worst10", "pa_high_volume", "pa_consistent", "pa_base_currency", "pa_quote_currency",
    "pa_currency_combo", "pa_volatility_bands", "pa_frequency_bands", "pa_winrate_bands", "pa_head_to_head",
    "pa_efficiency", "pa_rating", "pa_direct", "pa_by_month",
    # stop loss
    "sl_overall", "sl_by_pair", "sl_by_strategy", "sl_needs_work", "sl_eff_bands", "sl_trigger_bands", "sl_level_bands",
    "sl_direct_overview", "sl_by_exit_reason", "sl_with_vs_without", "sl_level_distribution",
    # duration
    "dp_overall", "dp_efficiency_rating", "dp_by_pair_top20", "dp_by_strategy", "dp_efficiency_rank", "dp_win_rating",
    "dp_optimal_by_pair", "dp_timing_ranges", "dp_windows", "dp_strategy_efficiency", "dp_category_matrix",
    "dp_direct", "dp_hour_histogram", "dp_exit_timing",
    # bot health
    "bh_dashboard", "bh_status_summary", "bh_attention", "bh_summary", "bh_correlated", "bh_risk_assessment",
    "bh_efficiency", "bh_profitability", "bh_critical_alerts", "bh_warning_alerts", "bh_score", "bh_realtime",
    "bh_recent30", "bh_utilization",
    # data quality
    "dq_pr_quality", "dq_rm_quality", "dq_sp_quality", "dq_ta_quality", "dq_pa_quality", "dq_sl_quality",
    "dq_dp_quality", "dq_bh_quality", "dq_key_unique", "dq_trades_nulls",
    # guide queries
    "doc_top_pairs", "doc_strategy_list", "doc_health_list", "doc_health_lookup", "doc_best_hours", "doc_high_risk",
    "doc_three_way", "doc_recent_trades", "doc_strategy_raw",
    # sources
    "src_normalize_trades",
]

REPORTS = {name: getattr(r, name) for name in REPORT_NAMES}



def src_rejects(t: Tables) -> DataFrame:
    """SRC-2: reject counts of a loosely typed copy of the trades with some values spoilt."""
    from tradescope.sources.trades import rejects

    spoilt = F.col("trade_id") % 7 == 0
    raw = t.trades.select(
        F.col("trade_id").cast("string").alias("trade_id"),
        "pair",
        F.when(spoilt, "maybe").when(F.col("is_open"), "TRUE").otherwise("f").alias("is_open"),
        F.when(spoilt, "n/a").otherwise(F.col("profit_pct").cast("string")).alias("profit_pct"),
        F.when(F.col("trade_id") % 11 == 0, "yesterday").otherwise(F.col("open_date").cast("string")).alias("open_date"),
    )
    return rejects(raw).select("rows_read", "trade_id_rejected", "is_open_rejected", "profit_pct_rejected", "open_date_rejected")


def _two_bots(t: Tables) -> DataFrame:
    """Two bots whose trade ids collide: the second has a third of the trades, numbered anew by the first one's ids."""
    from tradescope.sources.trades import union_bots

    second = t.trades.where("trade_id % 3 = 0").withColumn("trade_id", F.floor(F.col("trade_id") / 3))
    return union_bots({"bot_a": t.trades, "bot_b": second})


def bots_rankings(t: Tables) -> DataFrame:
    from tradescope.operators.bots import rankings_by_bot

    return rankings_by_bot(_two_bots(t))


def bots_strategies(t: Tables) -> DataFrame:
    from tradescope.operators.bots import strategies_by_bot

    return strategies_by_bot(_two_bots(t), t.bucket_ids)


def bots_var(t: Tables) -> DataFrame:
    from tradescope.operators.bots import var_by_bot

    return var_by_bot(_two_bots(t))


def src_load_trades(t: Tables) -> DataFrame:
    """SRC-1: a written trades table read back with its schema; columns of the file beyond it are not read."""
    from tradescope.sources.trades import load_trades

    spark, path = t.trades.sparkSession, _scratch(t, "load")
    t.trades.withColumn("note", F.lit("not read")).write.parquet(path)
    return load_trades(spark, path)


def _of_bots(name: str) -> Callable[[Tables], DataFrame]:
    """A result table of two bots, written by a refresh and read back."""

    def run(t: Tables) -> DataFrame:
        from tradescope.sinks.refresh import read_result, refresh

        root = _scratch(t, "bots")
        refresh(t.trades.sparkSession, _two_bots(t), root, as_of=t.as_of or AS_OF, names=[name])
        return comparable(read_result(t.trades.sparkSession, root, name))

    return run


BOT_TABLES = {f"bots_{name}": _of_bots(name) for name in RESULT_TABLES}

SOURCES = {
    "src_load_trades": src_load_trades,
    "bots_rankings": bots_rankings,
    "bots_strategies": bots_strategies,
    "bots_var": bots_var,
    "src_open_closed_counts": lambda t: open_closed_counts(t.trades),
    "src_rejects": src_rejects,
}


def _scratch(t: Tables, prefix: str) -> str:
    from tradescope.session import shared_path

    return shared_path(t.trades.sparkSession, f"{prefix}-{uuid.uuid4().hex[:10]}")


# ------------------------------------------------------------ writing, refreshing, streaming
def _parts(t: Tables, n: int) -> list[DataFrame]:
    """Closed trades in ``n`` equal spans of close time (undated first); durations differ, so ids come out of order.

    They are written once, so that each part reads stored trades and does not derive them again.
    """
    spark, path = t.trades.sparkSession, _scratch(t, "arrivals")
    t.closed.write.parquet(path)
    rows = spark.read.schema(t.closed.schema).parquet(path)
    at = F.timestamp_diff("MICROSECOND", F.lit(dt.datetime(1970, 1, 1)).cast("timestamp_ntz"), F.col("close_date"))
    low, high = rows.agg(F.min(at), F.max(at)).first()
    edges = [] if low is None else [low + (high - low) * k // n for k in range(1, n)]
    part = sum((F.when(at > e, 1).otherwise(0) for e in edges), F.lit(0))
    return [rows.where(part == k) for k in range(n)]


def _streamed(t: Tables, n: int = 3) -> str:
    """Refreshes over ``n`` arrivals of closed trades, one per micro-batch; returns the root of the results."""
    from tradescope.streaming.stream import stream_refresh

    spark = t.trades.sparkSession
    root = _scratch(t, "stream")
    for part in _parts(t, n):
        part.write.mode("append").parquet(f"{root}/source")
        stream_refresh(spark, f"{root}/source", f"{root}/out", f"{root}/checkpoint", as_of=t.as_of).awaitTermination()
    return f"{root}/out"


def str_stream_refresh(t: Tables) -> DataFrame:
    """STR-1..6: after three arrivals in close order (late ids included) all eight tables equal a
    batch build. One row per table, row and column, so that all of them can be compared at once."""
    from tradescope.sinks.refresh import read_result

    spark, out, all_rows = t.trades.sparkSession, _streamed(t), None
    for name in RESULT_TABLES:
        rows = as_cells(read_result(spark, out, name), name)
        all_rows = rows if all_rows is None else all_rows.unionByName(rows)
    return all_rows


def as_cells(df: DataFrame, table: str) -> DataFrame:
    """``table, entity, metric, number, word``: one row per value, rows named by their natural key."""
    keys = NATURAL_KEYS[table]
    entity = F.concat_ws("|", *[F.coalesce(F.col(k).cast("string"), F.lit("-")) for k in keys])
    cells = []
    for f in df.schema.fields:
        if f.name in (*keys, "analysis_date", "last_calculation"):
            continue
        text = f.dataType.simpleString() == "string"
        number = F.lit(None).cast("double") if text else F.col(f.name).cast("double")
        number = F.round(number, 9) if f.name in INEXACT else number
        word = F.col(f.name) if text else F.lit(None).cast("string")
        cells.append(F.struct(F.lit(f.name).alias("metric"), number.alias("number"), word.alias("word")))
    return df.select(F.lit(table).alias("table"), entity.alias("entity"), F.explode(F.array(*cells)).alias("c")).select("table", "entity", "c.*")


def str_alerts(t: Tables) -> DataFrame:
    """STR-7: alerts of the later batches against the health of the batch before."""
    from tradescope.streaming.incremental import read_alerts

    return read_alerts(t.trades.sparkSession, _streamed(t)).select("batch_id", "metric_name", F.round("metric_value", 6).alias("metric_value"), "health_status", "previous_status", "changed")


def bh_history_lag(t: Tables) -> DataFrame:
    """SNK-8: change of each metric over the snapshots that three refreshes stored."""
    from tradescope.sinks.refresh import health_history_lag, read_health_history

    history = read_health_history(t.trades.sparkSession, _streamed(t))
    return health_history_lag(history.withColumn("metric_value", F.round("metric_value", 6)))


def str_live_windows(t: Tables) -> DataFrame:
    """STR-8: hourly windows on close time, appended to files once the watermark has passed them."""
    from tradescope.streaming.stream import closed_trade_stream, live_window_stats, write_windows

    spark = t.trades.sparkSession
    root = _scratch(t, "windows")
    t.closed.write.parquet(f"{root}/source")
    windows = live_window_stats(closed_trade_stream(spark, f"{root}/source"))
    write_windows(windows, f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return spark.read.schema(windows.schema).parquet(f"{root}/out")


def str_revised_windows(t: Tables) -> DataFrame:
    """STR-8: the same windows over arrivals in the wrong order: rows behind the watermark revise their window and are counted."""
    from tradescope.streaming.stream import closed_trade_stream, read_windows, revised_window_stream

    spark, root = t.trades.sparkSession, _scratch(t, "revised")
    first, second, third = _parts(t, 3)
    for part in (third, first, second):
        part.write.mode("append").parquet(f"{root}/source")
        revised_window_stream(closed_trade_stream(spark, f"{root}/source"), f"{root}/out", f"{root}/checkpoint").awaitTermination()
    return read_windows(spark, f"{root}/out")


def snk_overwrite_subtypes(t: Tables) -> DataFrame:
    """SNK-1: the risk table written, then by_pair replaced by its riskier half and by_strategy by nothing."""
    from tradescope.sinks.refresh import overwrite_subtypes, read_subtypes

    spark, path = t.trades.sparkSession, _scratch(t, "subtypes")
    risk = t.risk_metrics
    overwrite_subtypes(risk, path, "metric_type", ["overall", "by_pair", "by_strategy", "var_analysis"])
    overwrite_subtypes(risk.where("metric_type = 'by_pair' AND max_drawdown_pct < -15"), path, "metric_type", ["by_pair", "by_strategy"])
    return read_subtypes(spark, path, risk.schema)


def _refreshed(t: Tables) -> str:
    """Two refreshes with something new, one without, and a forced one (SNK-2, SNK-9)."""
    from tradescope.sinks.refresh import refresh

    spark, root, start = t.trades.sparkSession, _scratch(t, "refresh"), t.as_of or AS_OF
    refresh(spark, t.trades.where("trade_id % 3 <> 0"), root, as_of=start)
    refresh(spark, t.trades, root, as_of=start + dt.timedelta(hours=1))  # low ids close late: new although no id is higher
    refresh(spark, t.trades, root, as_of=start + dt.timedelta(hours=2))  # nothing new: no run
    refresh(spark, t.trades, root, as_of=start + dt.timedelta(hours=3), full=True)
    return root


def snk_version(t: Tables) -> DataFrame:
    """SNK-2/9: the current version of a result table after several refreshes."""
    from tradescope.sinks.refresh import read_result

    return read_result(t.trades.sparkSession, _refreshed(t), "stop_loss_analytics").drop("analysis_date")


def snk_update_table(t: Tables) -> DataFrame:
    """SNK-2: one table updated after a whole refresh of fewer trades; the other tables stay as they were."""
    from tradescope.sinks.refresh import read_result, refresh

    spark, root, start = t.trades.sparkSession, _scratch(t, "update"), t.as_of or AS_OF
    refresh(spark, t.trades.where("trade_id % 3 <> 0"), root, as_of=start)
    refresh(spark, t.trades, root, as_of=start + dt.timedelta(hours=1), names=["pair_analytics"])
    pairs = read_result(spark, root, "pair_analytics").select(F.lit("pair_analytics").alias("table"), F.col("pair").alias("entity"), F.col("total_trades").alias("trades"))
    hours = read_result(spark, root, "timing_analysis").where("time_category = 'hourly'")
    return pairs.unionByName(hours.select(F.lit("timing_analysis").alias("table"), F.col("hour_of_day").cast("string").alias("entity"), F.col("trade_count").alias("trades")))


def _stored(name: str) -> Callable[[Tables], DataFrame]:
    """A report read from a stored version, which is held while later refreshes replace and prune it."""

    def run(t: Tables) -> DataFrame:
        from tradescope.plans.stored import StoredTables
        from tradescope.sinks.refresh import refresh

        spark, root, start = t.trades.sparkSession, _scratch(t, "stored"), t.as_of or AS_OF
        names = [STORED_REPORTS[name]]
        refresh(spark, t.trades, root, as_of=start, names=names)
        stored = StoredTables.open(spark, root)
        refresh(spark, t.trades.where("trade_id % 3 = 0"), root, as_of=start, names=names, full=True, keep_versions=1)
        return REPORTS[name](stored)

    return run


#: Reports that are also read from a stored version, one of each result table.
STORED_REPORTS = {
    "pr_top10": "performance_rankings",
    "rm_sl_by_pair": "risk_metrics",
    "sp_ranking": "strategy_performance",
    "ta_best_hours": "timing_analysis",
    "pa_rating": "pair_analytics",
    "sl_by_strategy": "stop_loss_analytics",
    "dp_by_strategy": "duration_patterns",
    "bh_dashboard": "bot_health_metrics",
}


def snk_ledger_report(t: Tables) -> DataFrame:
    """SNK-5/6: the last three runs of the ledger."""
    from tradescope.sinks.refresh import ledger_report, read_ledger

    return ledger_report(read_ledger(t.trades.sparkSession, _refreshed(t)))


def snk_upsert(t: Tables) -> DataFrame:
    """SNK-3: rows of the risk table replaced on their natural key; the VaR row is new."""
    from tradescope.sinks.refresh import upsert

    risk = t.risk_metrics.select("metric_type", "entity_name", "max_drawdown_pct", "var_95_pct")
    old = risk.where("metric_type <> 'var_analysis'")
    new = risk.where("metric_type IN ('overall', 'by_strategy', 'var_analysis')").withColumn("max_drawdown_pct", F.col("max_drawdown_pct") * 2)
    return upsert(old, new, NATURAL_KEYS["risk_metrics"])


def snk_csv_export(t: Tables) -> DataFrame:
    """SNK-7: a result table through CSV and back."""
    from tradescope.sinks.refresh import export_csv

    spark, path = t.trades.sparkSession, _scratch(t, "csv")
    rows = t.pair_analytics.select("pair", "total_trades", "winning_trades", "best_trade_pct", "worst_trade_pct", "total_volume")
    export_csv(rows, path)
    return spark.read.schema(rows.schema).option("header", True).csv(path)


STREAMS = {
    f.__name__: f
    for f in (
        str_stream_refresh,
        str_alerts,
        bh_history_lag,
        str_live_windows,
        str_revised_windows,
        snk_overwrite_subtypes,
        snk_version,
        snk_ledger_report,
        snk_upsert,
        snk_csv_export,
        snk_update_table,
    )
} | BOT_TABLES | {f"stored_{name}": _stored(name) for name in STORED_REPORTS}

CATALOG: dict[str, Callable[[Tables], DataFrame]] = {**BUILDERS, **SUB_BUILDERS, **POLLER, **REPORTS, **SOURCES, **STREAMS}

# Columns compared after rounding to 9 places (sums of non-dyadic values).
ROUND9 = {"doc_strategy_raw": ["avg_profit_pct"]}


def run(name: str, t: Tables) -> DataFrame:
    df = CATALOG[name](t)
    for col in ROUND9.get(name, []):
        df = df.withColumn(col, F.round(col, 9))
    return df


__all__ = ["CATALOG", "RESULT_TABLES", "run", "comparable"]
