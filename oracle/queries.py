"""Final SELECT of each oracle query (run after ``prelude.with_prelude``).

Where a LIMIT depends on order, the same tie-breaks as the Spark side are
spelled out with explicit NULLS FIRST/LAST (DuckDB's default differs).
"""

from __future__ import annotations

from oracle import values as L
from oracle.sql import band_sql, sql_str

WIN = "CASE WHEN profit_pct > 0 THEN 1.0 ELSE 0.0 END"
PR = "(SELECT * FROM performance_rankings WHERE ranking_type = 'by_pair')"


def _rm(kind):
    return f"(SELECT * FROM risk_metrics WHERE metric_type = '{kind}')"


def _ta(kind):
    return f"(SELECT * FROM timing_analysis WHERE time_category = '{kind}')"


def _sl(kind):
    return f"(SELECT * FROM stop_loss_analytics WHERE analysis_type = '{kind}')"


def _dp(kind):
    return f"(SELECT * FROM duration_patterns WHERE pattern_type = '{kind}')"


def _sd(x="profit_pct"):
    v = f"(avg({x} * {x}) - avg({x}) * avg({x}))"
    return f"sqrt(CASE WHEN {v} >= 0 THEN {v} END)"


def _pick(arms, else_label):
    return "CASE " + " ".join(f"WHEN {cond} THEN {sql_str(lbl)}" for cond, lbl in arms) + f" ELSE {sql_str(else_label)} END"


def _rating(avg, second, spec):
    arms = []
    for a, s, lbl in spec:
        cond = f"{avg} >= {a}" + (f" AND {second} >= {s}" if s is not None else "")
        arms.append((cond, lbl))
    return _pick(arms, L.RATING_ELSE)


def _status_rank(col="health_status"):
    return "CASE " + " ".join(f"WHEN {col} = '{s}' THEN {i + 1}" for i, s in enumerate(L.STATUS_ORDER)) + " END"


def _period_type(col):
    return f"CASE WHEN {col} IN (0, 6) THEN 'Weekend' ELSE 'Weekday' END"


def _market_session(col):
    arms = [(f"{col} IN ({', '.join(map(str, hours))})", lbl) for hours, lbl in L.MARKET_SESSIONS]
    return _pick(arms, L.MARKET_SESSIONS_ELSE)


def _day_name(col):
    return "CASE " + " ".join(f"WHEN {col} = {i} THEN {sql_str(n)}" for i, n in enumerate(L.DAY_NAMES)) + " END"


def _pivot(names):
    cols = []
    for n in names:
        cols.append(f"max(CASE WHEN metric_name = '{n}' THEN metric_value END) AS v_{n}")
        cols.append(f"max(CASE WHEN metric_name = '{n}' THEN health_status END) AS s_{n}")
    return f"(SELECT {', '.join(cols)} FROM bot_health_metrics)"


def _head_to_head(table, key, caption, names):
    return f"""
SELECT {sql_str(caption)} AS analysis_type,
  max(CASE WHEN rn = 1 THEN {key} END) AS {names[0]},
  ROUND(max(CASE WHEN rn = 1 THEN avg_profit_pct END), 2) AS best_profit_pct,
  max(CASE WHEN rn = 2 THEN {key} END) AS {names[1]},
  ROUND(max(CASE WHEN rn = 2 THEN avg_profit_pct END), 2) AS second_profit_pct,
  ROUND(max(CASE WHEN rn = 1 THEN avg_profit_pct END) - max(CASE WHEN rn = 2 THEN avg_profit_pct END), 2) AS profit_difference
FROM (SELECT {key}, avg_profit_pct, row_number() OVER (ORDER BY avg_profit_pct DESC NULLS LAST, {key} ASC NULLS FIRST) AS rn
      FROM {table}) WHERE rn <= 2"""


def _by_exit_reason(names, with_duration):
    extra = ", ROUND(avg(trade_duration), 0) AS avg_duration_min" if with_duration else ""
    return f"""
SELECT exit_reason, count(*) AS trade_count,
  ROUND(count(*) * 100.0 / (SELECT count(*) FROM closed), 1) AS percentage_of_trades,
  ROUND(avg(profit_pct), 2) AS avg_profit_pct, ROUND(min(profit_pct), 2) AS {names[0]},
  ROUND(max(profit_pct), 2) AS {names[1]}{extra}
FROM closed WHERE exit_reason IS NOT NULL GROUP BY exit_reason"""


def _currency(cur, having, last):
    h = f"HAVING count(DISTINCT pr.entity_name) >= {having}" if having else ""
    return f"""
SELECT t.{cur}, count(DISTINCT pr.entity_name) AS pair_count, ROUND(avg(pr.profit_pct), 2) AS avg_profit_pct,
  ROUND(avg(pr.win_rate) * 100, 1) AS avg_win_rate, ISUM(pr.trade_count) AS total_trades,
  ROUND(sum(pr.{last[0]}), 2) AS {last[1]}
FROM {PR} pr JOIN (SELECT DISTINCT pair, {cur} FROM trades) t ON pr.entity_name = t.pair
GROUP BY t.{cur} {h}"""


def _alerts(status, threshold, t_alias, action_alias, caption):
    return f"""
SELECT metric_name AS alert_metric, metric_value AS current_value, {threshold} AS {t_alias}, metric_unit,
  recommendation AS {action_alias}, {sql_str(L.CAPTIONS[caption])} AS alert_level, analysis_date AS alert_time
FROM bot_health_metrics WHERE health_status = '{status}'"""


def _dq(table, caption, cols):
    return f"SELECT {sql_str(L.CAPTIONS[caption])} AS check_type, {cols} FROM {table}"


HEALTH_COUNTS = (
    "count(CASE WHEN health_status = 'HEALTHY' THEN 1 END)",
    "count(CASE WHEN health_status = 'WARNING' THEN 1 END)",
    "count(CASE WHEN health_status = 'CRITICAL' THEN 1 END)",
)

_BUILDER_COLS = {
    "performance_rankings": "ranking_type, entity_name, entity_type, round(profit_ratio, 9) AS profit_ratio, profit_pct, profit_abs, "
    "trade_count, win_rate, avg_duration_minutes, max_profit_pct, min_profit_pct, total_volume, rank_position, analysis_date",
}

Q: dict[str, str] = {}

# ----------------------------------------------------------------- builders
Q["build_performance_rankings"] = f"SELECT {_BUILDER_COLS['performance_rankings']} FROM performance_rankings"
Q["build_risk_metrics"] = "SELECT * FROM risk_metrics"
Q["build_strategy_performance"] = "SELECT * FROM strategy_performance"
Q["build_timing_analysis"] = "SELECT * FROM timing_analysis"
Q["build_pair_analytics"] = "SELECT * FROM pair_analytics"
Q["build_stop_loss_analytics"] = "SELECT * FROM stop_loss_analytics"
Q["build_duration_patterns"] = "SELECT * FROM duration_patterns"
Q["build_bot_health"] = "SELECT * FROM bot_health_metrics"

# ----------------------------------------------------------------- poller variants
Q["poll_performance_rankings"] = Q["build_performance_rankings"]
Q["poll_risk"] = "SELECT * FROM risk_metrics WHERE metric_type = 'overall'"
Q["poll_strategy"] = """
SELECT strategy_name, total_trades, winning_trades, losing_trades, win_rate, avg_profit_pct, total_profit_abs,
  profit_factor, expectancy, best_trade_pct, worst_trade_pct, 0.5 AS consistency_score, avg_trade_duration_minutes,
  CAST(NULL AS BIGINT) AS max_consecutive_wins, CAST(NULL AS BIGINT) AS max_consecutive_losses,
  CAST(NULL AS DOUBLE) AS sharpe_ratio, CAST(NULL AS DOUBLE) AS sortino_ratio, CAST(NULL AS DOUBLE) AS calmar_ratio, analysis_date
FROM strategy_performance"""
Q["poll_timing"] = "SELECT * FROM poll_timing"
Q["poll_pair"] = """
SELECT pair, base_currency, quote_currency, total_trades, winning_trades, losing_trades, win_rate, avg_profit_pct,
  total_profit_abs, avg_trade_duration_minutes, price_volatility_pct, analysis_date FROM pair_analytics"""
Q["poll_stop_loss"] = """
SELECT 'by_pair' AS analysis_type, pair, CAST(NULL AS VARCHAR) AS strategy, avg(stop_loss_pct) AS stop_loss_level_pct,
  count(*) AS total_trades_with_sl, ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS sl_triggered_count,
  CAST(NULL AS DOUBLE) AS sl_trigger_rate_pct,
  CASE WHEN ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) > 0
       THEN (ISUM(CASE WHEN exit_reason = 'stop_loss' AND profit_pct > -10 THEN 1 ELSE 0 END) * 1.0
             / ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END)) * 100
       ELSE 0.0 END AS sl_effectiveness_pct,
  avg(CASE WHEN exit_reason = 'stop_loss' THEN profit_pct END) AS avg_loss_when_triggered_pct,
  avg(CASE WHEN exit_reason <> 'stop_loss' THEN profit_pct END) AS avg_profit_when_not_triggered_pct,
  CAST(NULL AS DOUBLE) AS max_loss_prevented_pct, CAST(NULL AS DOUBLE) AS optimal_sl_level_pct,
  CAST(NULL AS BIGINT) AS trades_without_sl, CAST(NULL AS DOUBLE) AS avg_loss_without_sl_pct,
  TIMESTAMP '2024-07-01 12:00:00' AS analysis_date
FROM closed WHERE stop_loss_pct IS NOT NULL GROUP BY pair"""
Q["poll_duration"] = """
SELECT pattern_type, duration_category, min_duration_minutes, max_duration_minutes, trade_count, win_rate, avg_profit_pct,
  total_profit_abs, optimal_exit_timing_minutes, CAST(NULL AS DOUBLE) AS profit_per_hour, pair, strategy, analysis_date
FROM duration_patterns WHERE pattern_type = 'duration_based'"""
Q["poll_bot_health"] = "SELECT * FROM poll_health"

# ----------------------------------------------------------------- rankings
Q["pr_top10"] = f"""
SELECT rank_position, entity_name AS trading_pair, ROUND(profit_pct, 2) AS avg_profit_pct, ROUND(win_rate * 100, 1) AS win_rate_pct,
  trade_count, ROUND(total_volume, 2) AS total_volume_usdt, ROUND(avg_duration_minutes, 0) AS avg_duration_min
FROM {PR} ORDER BY rank_position LIMIT 10"""
Q["pr_bottom5"] = f"""
SELECT rank_position, entity_name AS trading_pair, ROUND(profit_pct, 2) AS avg_profit_pct, ROUND(win_rate * 100, 1) AS win_rate_pct,
  trade_count, ROUND(min_profit_pct, 2) AS worst_trade_pct
FROM {PR} ORDER BY rank_position DESC LIMIT 5"""
Q["pr_high_win_low_profit"] = f"""
SELECT entity_name AS trading_pair, ROUND(profit_pct, 2) AS avg_profit_pct, ROUND(win_rate * 100, 1) AS win_rate_pct,
  trade_count, ROUND(max_profit_pct, 2) AS best_trade_pct
FROM {PR} WHERE win_rate >= 0.7 AND profit_pct < 1.0"""
Q["pr_high_volume"] = f"""
SELECT entity_name AS trading_pair, ROUND(profit_pct, 2) AS avg_profit_pct, trade_count, ROUND(total_volume, 2) AS total_volume_usdt,
  ROUND(total_volume / trade_count, 2) AS avg_stake_per_trade
FROM {PR} ORDER BY total_volume DESC NULLS LAST, entity_name LIMIT 10"""
Q["pr_portfolio_summary"] = f"""
SELECT count(*) AS total_pairs_traded, ROUND(avg(profit_pct), 2) AS portfolio_avg_profit_pct,
  ROUND(avg(win_rate) * 100, 1) AS portfolio_avg_win_rate, ISUM(trade_count) AS total_trades,
  ROUND(sum(profit_abs), 2) AS total_profit_abs, ROUND(sum(total_volume), 2) AS total_volume_traded
FROM {PR}"""
Q["pr_profit_distribution"] = f"""
SELECT {band_sql('profit_pct', L.PROFIT_BANDS, L.PROFIT_BANDS_ELSE)} AS performance_category, count(*) AS pair_count,
  ROUND(avg(profit_pct), 2) AS avg_profit_in_category, ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_in_category
FROM {PR} GROUP BY 1"""
Q["pr_winrate_distribution"] = f"""
SELECT {band_sql('win_rate', L.WINRATE_BANDS, L.WINRATE_BANDS_ELSE)} AS win_rate_category, count(*) AS pair_count,
  ROUND(avg(profit_pct), 2) AS avg_profit_pct, ROUND(min(profit_pct), 2) AS min_profit_pct, ROUND(max(profit_pct), 2) AS max_profit_pct
FROM {PR} GROUP BY 1"""
Q["pr_base_currency"] = _currency("base_currency", 2, ("profit_abs", "total_profit"))
Q["pr_quote_currency"] = _currency("quote_currency", None, ("total_volume", "total_volume"))
Q["pr_direct_top20"] = f"""
SELECT pair, trade_count, avg_profit_pct, win_rate_pct, best_trade_pct, worst_trade_pct, total_volume, avg_duration_min FROM (
  SELECT pair, count(*) AS trade_count, ROUND(avg(profit_pct), 2) AS avg_profit_pct, avg(profit_pct) AS a,
    ROUND(avg({WIN}) * 100, 1) AS win_rate_pct, ROUND(max(profit_pct), 2) AS best_trade_pct, ROUND(min(profit_pct), 2) AS worst_trade_pct,
    ROUND(sum(stake_amount), 2) AS total_volume, ROUND(avg(trade_duration), 0) AS avg_duration_min
  FROM closed GROUP BY pair HAVING count(*) >= 5)
ORDER BY avg_profit_pct DESC NULLS LAST, a DESC NULLS LAST, pair LIMIT 20"""

# ----------------------------------------------------------------- risk
Q["rm_overall"] = f"""
SELECT metric_type, stop_loss_triggered_count, ROUND(stop_loss_effectiveness_pct, 2) AS sl_effectiveness_pct,
  ROUND(max_drawdown_pct, 2) AS max_drawdown_pct, ROUND(sharpe_ratio, 3) AS sharpe_ratio FROM {_rm('overall')}"""
_RISK_ROW = """stop_loss_triggered_count AS sl_triggers, ROUND(stop_loss_effectiveness_pct, 1) AS sl_effectiveness_pct,
  ROUND(max_drawdown_pct, 2) AS {dd}, ROUND(volatility_pct, 2) AS volatility_pct, ROUND(risk_reward_ratio, 2) AS risk_reward_ratio"""
Q["rm_sl_by_pair"] = f"SELECT entity_name AS trading_pair, {_RISK_ROW.format(dd='max_drawdown_pct')} FROM {_rm('by_pair')}"
Q["rm_strategy_compare"] = f"SELECT entity_name AS strategy, {_RISK_ROW.format(dd='worst_loss_pct')} FROM {_rm('by_strategy')}"
Q["rm_high_risk_pairs"] = f"""
SELECT entity_name AS trading_pair, ROUND(max_drawdown_pct, 2) AS worst_loss_pct, ROUND(volatility_pct, 2) AS volatility_pct,
  stop_loss_triggered_count AS sl_triggers, ROUND(stop_loss_effectiveness_pct, 1) AS sl_effectiveness_pct
FROM {_rm('by_pair')} WHERE max_drawdown_pct < -10 OR volatility_pct > 5 OR stop_loss_effectiveness_pct < 50"""
Q["rm_risk_adjusted"] = f"""
SELECT rm.entity_name AS trading_pair, pr.profit_pct AS avg_profit_pct, rm.volatility_pct, rm.max_drawdown_pct, rm.risk_reward_ratio,
  CASE WHEN rm.volatility_pct > 0 THEN ROUND(pr.profit_pct / rm.volatility_pct, 2) ELSE 0.0 END AS risk_adjusted_return
FROM {_rm('by_pair')} rm JOIN {PR} pr ON rm.entity_name = pr.entity_name"""
Q["rm_sl_eff_distribution"] = f"""
SELECT {band_sql('stop_loss_effectiveness_pct', L.SL_EFFECTIVENESS_BANDS, L.RISK_SL_EFFECTIVENESS_ELSE)} AS sl_effectiveness_category,
  count(*) AS pair_count, ROUND(avg(stop_loss_effectiveness_pct), 1) AS avg_effectiveness, ROUND(avg(max_drawdown_pct), 2) AS avg_max_drawdown
FROM {_rm('by_pair')} GROUP BY 1"""
Q["rm_volatility_vs_perf"] = f"""
SELECT {band_sql('rm.volatility_pct', L.VOLATILITY_BANDS, L.VOLATILITY_BANDS_ELSE)} AS volatility_category, count(*) AS pair_count,
  ROUND(avg(pr.profit_pct), 2) AS avg_profit_pct, ROUND(avg(rm.volatility_pct), 2) AS avg_volatility,
  ROUND(avg(rm.risk_reward_ratio), 2) AS avg_risk_reward
FROM {_rm('by_pair')} rm JOIN {PR} pr ON rm.entity_name = pr.entity_name GROUP BY 1"""
Q["rm_direct_summary"] = f"""
SELECT {sql_str(L.CAPTIONS['rm_direct_summary'])} AS analysis_type, count(*) AS total_trades,
  ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS stop_loss_exits,
  ROUND(ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) * 100.0 / count(*), 1) AS sl_trigger_rate_pct,
  ROUND(min(profit_pct), 2) AS worst_trade_pct, ROUND(max(profit_pct), 2) AS best_trade_pct, ROUND({_sd()}, 2) AS volatility_pct,
  ROUND(avg(CASE WHEN profit_pct > 0 THEN profit_pct ELSE 0.0 END), 2) AS avg_win_pct,
  ROUND(avg(CASE WHEN profit_pct < 0 THEN abs(profit_pct) ELSE 0.0 END), 2) AS avg_loss_pct
FROM closed"""
Q["rm_by_exit_reason"] = _by_exit_reason(("worst_case_pct", "best_case_pct"), False)
Q["rm_daily_drawdown"] = """
SELECT CAST(open_date AS DATE) AS trade_date, count(*) AS trades_that_day, ROUND(avg(profit_pct), 2) AS daily_avg_profit,
  ROUND(min(profit_pct), 2) AS daily_worst_trade, ISUM(CASE WHEN profit_pct < 0 THEN 1 ELSE 0 END) AS losing_trades
FROM closed WHERE open_date IS NOT NULL GROUP BY 1 HAVING count(*) >= 2 ORDER BY trade_date DESC LIMIT 30"""

# ----------------------------------------------------------------- strategy
SP = "strategy_performance"
Q["sp_ranking"] = f"""
SELECT strategy_name, total_trades, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
  ROUND(total_profit_abs, 2) AS total_profit, ROUND(profit_factor, 2) AS profit_factor, ROUND(expectancy, 3) AS expectancy
FROM {SP}"""
Q["sp_best"] = f"""
SELECT strategy_name, total_trades, win_rate_pct, avg_profit_pct, profit_factor, best_trade_pct, worst_trade_pct, consistency, avg_duration_min FROM (
  SELECT strategy_name, total_trades, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct, avg_profit_pct AS a,
    ROUND(profit_factor, 2) AS profit_factor, ROUND(best_trade_pct, 2) AS best_trade_pct, ROUND(worst_trade_pct, 2) AS worst_trade_pct,
    ROUND(consistency_score, 3) AS consistency, ROUND(avg_trade_duration_minutes, 0) AS avg_duration_min
  FROM {SP} WHERE total_trades >= 5)
ORDER BY avg_profit_pct DESC NULLS LAST, a DESC NULLS LAST, strategy_name NULLS FIRST LIMIT 10"""
Q["sp_risk_adjusted"] = f"""
SELECT strategy_name, ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(sharpe_ratio, 3) AS sharpe_ratio,
  ROUND(sortino_ratio, 3) AS sortino_ratio, ROUND(calmar_ratio, 3) AS calmar_ratio, max_consecutive_losses,
  ROUND(consistency_score, 3) AS consistency
FROM {SP} WHERE total_trades >= 10"""
_EFF = """{key}, total_trades, ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(avg_trade_duration_minutes, 0) AS avg_duration_min,
  ROUND(avg_profit_pct / (avg_trade_duration_minutes / 60.0), 3) AS profit_per_hour,
  ROUND(total_profit_abs / total_trades, 2) AS profit_per_trade"""
Q["sp_efficiency"] = f"SELECT {_EFF.format(key='strategy_name')} FROM {SP} WHERE avg_trade_duration_minutes > 0"
Q["sp_profit_distribution"] = f"""
SELECT {band_sql('avg_profit_pct', L.PROFIT_BANDS, L.PROFIT_BANDS_ELSE)} AS performance_category, count(*) AS strategy_count,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_in_category, ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct,
  ISUM(total_trades) AS total_trades_in_category
FROM {SP} GROUP BY 1"""
Q["sp_winrate_distribution"] = f"""
SELECT {band_sql('win_rate', L.WINRATE_BANDS, L.WINRATE_BANDS_ELSE)} AS win_rate_category, count(*) AS strategy_count,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(profit_factor), 2) AS avg_profit_factor, ROUND(avg(expectancy), 3) AS avg_expectancy
FROM {SP} GROUP BY 1"""
Q["sp_consistency_distribution"] = f"""
SELECT {band_sql('consistency_score', L.CONSISTENCY_BANDS, L.CONSISTENCY_BANDS_ELSE)} AS consistency_category, count(*) AS strategy_count,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(consistency_score), 3) AS avg_consistency,
  ROUND(avg(max_consecutive_losses), 1) AS avg_max_loss_streak
FROM {SP} WHERE consistency_score IS NOT NULL GROUP BY 1"""
Q["sp_duration_distribution"] = f"""
SELECT {band_sql('avg_trade_duration_minutes', L.STRATEGY_DURATION_BANDS, L.STRATEGY_DURATION_BANDS_ELSE)} AS duration_category,
  count(*) AS strategy_count, ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct,
  ROUND(avg(avg_trade_duration_minutes), 0) AS avg_duration_min
FROM {SP} WHERE avg_trade_duration_minutes IS NOT NULL GROUP BY 1"""
Q["sp_head_to_head"] = _head_to_head(SP, "strategy_name", L.CAPTIONS["sp_head_to_head"], ("best_strategy", "second_strategy"))
Q["sp_matrix"] = f"""
SELECT strategy_name, total_trades, ROUND(avg_profit_pct, 2) AS profit_pct, ROUND(win_rate * 100, 1) AS win_rate_pct,
  ROUND(profit_factor, 2) AS profit_factor, ROUND(sharpe_ratio, 3) AS sharpe, max_consecutive_losses AS max_loss_streak,
  {_rating('avg_profit_pct', 'win_rate', L.STRATEGY_RATING)} AS performance_rating
FROM {SP} WHERE total_trades >= 5"""
Q["sp_direct"] = f"""
SELECT strategy, count(*) AS total_trades, ROUND(avg(profit_pct), 2) AS avg_profit_pct, ROUND(avg({WIN}) * 100, 1) AS win_rate_pct,
  ROUND(max(profit_pct), 2) AS best_trade_pct, ROUND(min(profit_pct), 2) AS worst_trade_pct, ROUND(sum(profit_abs), 2) AS total_profit,
  count(DISTINCT pair) AS pairs_traded, ROUND(avg(trade_duration), 0) AS avg_duration_min
FROM closed WHERE strategy IS NOT NULL GROUP BY strategy HAVING count(*) >= 3"""
Q["sp_by_pair"] = f"""
SELECT strategy, pair, count(*) AS trades, ROUND(avg(profit_pct), 2) AS avg_profit_pct, ROUND(avg({WIN}) * 100, 1) AS win_rate_pct
FROM closed WHERE strategy IS NOT NULL GROUP BY strategy, pair HAVING count(*) >= 2"""

# ----------------------------------------------------------------- timing
Q["ta_overall"] = f"""
SELECT time_category, trade_count, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
  best_performance_hour, worst_performance_hour, ROUND(weekend_performance_pct, 2) AS weekend_profit_pct,
  ROUND(weekday_performance_pct, 2) AS weekday_profit_pct FROM {_ta('overall')}"""
Q["ta_best_hours"] = f"""
SELECT hour_of_day, time_period_name, trade_count, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
  ROUND(total_profit_abs, 2) AS total_profit, ROUND(duration_minutes_avg, 0) AS avg_duration_min FROM {_ta('hourly')}"""
Q["ta_day_of_week"] = f"""
SELECT time_period_name AS day_name, day_of_week, trade_count, ROUND(win_rate * 100, 1) AS win_rate_pct,
  ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(total_profit_abs, 2) AS total_profit, {_period_type('day_of_week')} AS period_type
FROM {_ta('daily')}"""
Q["ta_monthly"] = f"""
SELECT time_period_name AS month_name, month_of_year, trade_count, ROUND(win_rate * 100, 1) AS win_rate_pct,
  ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(total_profit_abs, 2) AS total_profit FROM {_ta('monthly')}"""
Q["ta_sessions"] = f"""
SELECT time_period_name AS trading_session, count(*) AS hours_in_session, ISUM(trade_count) AS total_trades,
  ROUND(avg(avg_profit_pct), 2) AS session_avg_profit, ROUND(avg(win_rate) * 100, 1) AS session_avg_winrate,
  ROUND(sum(total_profit_abs), 2) AS session_total_profit
FROM {_ta('hourly')} GROUP BY time_period_name"""
Q["ta_weekend_vs_weekday"] = f"""
SELECT {_period_type('day_of_week')} AS period_type, count(*) AS days_analyzed, ISUM(trade_count) AS total_trades,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct,
  ROUND(sum(total_profit_abs), 2) AS total_profit, ROUND(avg(duration_minutes_avg), 0) AS avg_trade_duration
FROM {_ta('daily')} GROUP BY 1"""
Q["ta_hour_rating"] = f"""
SELECT hour_of_day, time_period_name, ROUND(avg_profit_pct, 2) AS profit_pct, ROUND(win_rate * 100, 1) AS win_rate_pct, trade_count,
  {band_sql('avg_profit_pct', L.HOUR_RATING, L.HOUR_RATING_ELSE)} AS hour_rating FROM {_ta('hourly')}"""
Q["ta_volatility"] = f"""
SELECT time_period_name, ROUND(avg(volatility_pct), 2) AS avg_volatility, ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct,
  ROUND(avg(volatility_pct) / NULLIF(avg(avg_profit_pct), 0.0), 2) AS volatility_to_profit_ratio, ISUM(trade_count) AS total_trades
FROM {_ta('hourly')} WHERE volatility_pct IS NOT NULL GROUP BY time_period_name"""
Q["ta_market_sessions"] = f"""
SELECT {_market_session('hour_of_day')} AS market_session, count(DISTINCT hour_of_day) AS hours_in_session,
  ISUM(trade_count) AS total_trades, ROUND(avg(avg_profit_pct), 2) AS session_avg_profit,
  ROUND(avg(win_rate) * 100, 1) AS session_win_rate, ROUND(sum(total_profit_abs), 2) AS session_total_profit
FROM {_ta('hourly')} GROUP BY 1"""
Q["ta_consecutive_hours"] = f"""
SELECT t1.hour_of_day AS current_hour, t2.hour_of_day AS next_hour, ROUND(t1.avg_profit_pct, 2) AS current_hour_profit,
  ROUND(t2.avg_profit_pct, 2) AS next_hour_profit, t1.trade_count AS current_hour_trades, t2.trade_count AS next_hour_trades
FROM {_ta('hourly')} t1 JOIN {_ta('hourly')} t2 ON t2.hour_of_day = (t1.hour_of_day + 1) % 24
ORDER BY t1.avg_profit_pct DESC NULLS LAST, t1.hour_of_day LIMIT 10"""
Q["ta_direct_hours"] = f"""
SELECT {sql_str(L.CAPTIONS['ta_direct_hours'])} AS analysis_type, hour, trade_count, avg_profit_pct, win_rate_pct, total_profit, avg_duration_min FROM (
  SELECT CAST(hour(open_date) AS INTEGER) AS hour, count(*) AS trade_count, ROUND(avg(profit_pct), 2) AS avg_profit_pct, avg(profit_pct) AS a,
    ROUND(avg({WIN}) * 100, 1) AS win_rate_pct, ROUND(sum(profit_abs), 2) AS total_profit, ROUND(avg(trade_duration), 0) AS avg_duration_min
  FROM closed WHERE open_date IS NOT NULL GROUP BY 1 HAVING count(*) >= 2)
ORDER BY avg_profit_pct DESC NULLS LAST, a DESC NULLS LAST, hour LIMIT 10"""
Q["ta_direct_dow"] = f"""
SELECT {_day_name('d')} AS day_name, d AS day_number, trade_count, avg_profit_pct, win_rate_pct, {_period_type('d')} AS period_type FROM (
  SELECT CAST(dayofweek(open_date) AS INTEGER) AS d, count(*) AS trade_count, ROUND(avg(profit_pct), 2) AS avg_profit_pct,
    ROUND(avg({WIN}) * 100, 1) AS win_rate_pct
  FROM closed WHERE open_date IS NOT NULL GROUP BY 1)"""

# ----------------------------------------------------------------- pairs
PA = "pair_analytics"
Q["pa_top15"] = f"""
SELECT pair, base_currency, quote_currency, total_trades, win_rate_pct, avg_profit_pct, total_profit, volatility_pct, profit_factor, avg_duration_min FROM (
  SELECT pair, base_currency, quote_currency, total_trades, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
    avg_profit_pct AS a, ROUND(total_profit_abs, 2) AS total_profit, ROUND(price_volatility_pct, 2) AS volatility_pct,
    ROUND(profit_factor, 2) AS profit_factor, ROUND(avg_trade_duration_minutes, 0) AS avg_duration_min FROM {PA})
ORDER BY avg_profit_pct DESC NULLS LAST, a DESC NULLS LAST, pair LIMIT 15"""
Q["pa_worst10"] = f"""
SELECT pair, total_trades, avg_profit_pct, win_rate_pct, worst_trade_pct, max_consecutive_losses FROM (
  SELECT pair, total_trades, ROUND(avg_profit_pct, 2) AS avg_profit_pct, avg_profit_pct AS a, ROUND(win_rate * 100, 1) AS win_rate_pct,
    ROUND(worst_trade_pct, 2) AS worst_trade_pct, max_consecutive_losses FROM {PA} WHERE total_trades >= 3)
ORDER BY avg_profit_pct ASC NULLS FIRST, a ASC NULLS FIRST, pair LIMIT 10"""
Q["pa_high_volume"] = f"""
SELECT pair, total_trades, total_volume, avg_stake_per_trade, avg_profit_pct, total_profit FROM (
  SELECT pair, total_trades, ROUND(total_volume, 2) AS total_volume, total_volume AS v, ROUND(avg_stake_amount, 2) AS avg_stake_per_trade,
    ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(total_profit_abs, 2) AS total_profit FROM {PA})
ORDER BY total_volume DESC NULLS LAST, v DESC NULLS LAST, pair LIMIT 10"""
Q["pa_consistent"] = f"""
SELECT pair, total_trades, avg_profit_pct, volatility_pct, win_rate_pct, sharpe_ratio FROM (
  SELECT pair, total_trades, ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(price_volatility_pct, 2) AS volatility_pct,
    price_volatility_pct AS v, sharpe_ratio AS s, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(sharpe_ratio, 3) AS sharpe_ratio
  FROM {PA} WHERE total_trades >= 5 AND avg_profit_pct > 0)
ORDER BY sharpe_ratio DESC NULLS LAST, v ASC NULLS FIRST, s DESC NULLS LAST, pair LIMIT 10"""
Q["pa_base_currency"] = f"""
SELECT base_currency, count(*) AS pair_count, ISUM(total_trades) AS total_trades, ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct,
  ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct, ROUND(sum(total_profit_abs), 2) AS total_profit,
  ROUND(sum(total_volume), 2) AS total_volume_traded, ROUND(avg(price_volatility_pct), 2) AS avg_volatility_pct
FROM {PA} GROUP BY base_currency HAVING count(*) >= 2"""
Q["pa_quote_currency"] = f"""
SELECT quote_currency, count(*) AS pair_count, ISUM(total_trades) AS total_trades, ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct,
  ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct, ROUND(sum(total_profit_abs), 2) AS total_profit,
  ROUND(sum(total_volume), 2) AS total_volume_traded
FROM {PA} GROUP BY quote_currency"""
Q["pa_currency_combo"] = f"""
SELECT base_currency || '/' || quote_currency AS currency_combo, count(*) AS pair_count, ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct,
  ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct, ISUM(total_trades) AS total_trades, ROUND(avg(price_volatility_pct), 2) AS avg_volatility_pct
FROM {PA} GROUP BY base_currency, quote_currency"""
Q["pa_volatility_bands"] = f"""
SELECT {band_sql('price_volatility_pct', L.VOLATILITY_BANDS, L.VOLATILITY_BANDS_ELSE)} AS volatility_category, count(*) AS pair_count,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(price_volatility_pct), 2) AS avg_volatility,
  ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct, ROUND(avg(sharpe_ratio), 3) AS avg_sharpe_ratio
FROM {PA} WHERE price_volatility_pct IS NOT NULL GROUP BY 1"""
Q["pa_frequency_bands"] = f"""
SELECT {band_sql('total_trades', L.FREQUENCY_BANDS, L.FREQUENCY_BANDS_ELSE)} AS frequency_category, count(*) AS pair_count,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(total_trades), 1) AS avg_trades_per_pair,
  ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct, ROUND(sum(total_profit_abs), 2) AS category_total_profit
FROM {PA} GROUP BY 1"""
Q["pa_winrate_bands"] = f"""
SELECT {band_sql('win_rate', L.PAIR_WINRATE_BANDS, L.PAIR_WINRATE_BANDS_ELSE)} AS win_rate_category, count(*) AS pair_count,
  ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct, ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct,
  ROUND(avg(profit_factor), 2) AS avg_profit_factor, ROUND(avg(max_consecutive_losses), 1) AS avg_max_loss_streak
FROM {PA} GROUP BY 1"""
Q["pa_head_to_head"] = _head_to_head(PA, "pair", L.CAPTIONS["pa_head_to_head"], ("best_pair", "second_pair"))
Q["pa_efficiency"] = f"""
SELECT pair, total_trades, avg_profit_pct, avg_duration_min, profit_per_hour, profit_per_trade FROM (
  SELECT {_EFF.format(key='pair')}, avg_profit_pct / (avg_trade_duration_minutes / 60.0) AS pph
  FROM {PA} WHERE avg_trade_duration_minutes > 0)
ORDER BY profit_per_hour DESC NULLS LAST, pph DESC NULLS LAST, pair LIMIT 15"""
Q["pa_rating"] = f"""
SELECT pair, ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(price_volatility_pct, 2) AS volatility_pct,
  ROUND(sharpe_ratio, 3) AS sharpe_ratio, ROUND(profit_factor, 2) AS profit_factor, max_consecutive_losses,
  {_rating('avg_profit_pct', 'sharpe_ratio', L.PAIR_RATING)} AS performance_rating
FROM {PA} WHERE total_trades >= 5"""
Q["pa_direct"] = f"""
SELECT pair, base_currency, quote_currency, count(*) AS total_trades, ROUND(avg(profit_pct), 2) AS avg_profit_pct,
  ROUND(avg({WIN}) * 100, 1) AS win_rate_pct, ROUND(max(profit_pct), 2) AS best_trade_pct, ROUND(min(profit_pct), 2) AS worst_trade_pct,
  ROUND(sum(stake_amount), 2) AS total_volume, ROUND(avg(trade_duration), 0) AS avg_duration_min,
  count(DISTINCT CAST(open_date AS DATE)) AS trading_days
FROM closed GROUP BY pair, base_currency, quote_currency HAVING count(*) >= 3"""
Q["pa_by_month"] = f"""
SELECT pair, strftime(open_date, '%Y-%m') AS month, count(*) AS trades_that_month, ROUND(avg(profit_pct), 2) AS monthly_avg_profit,
  ROUND(avg({WIN}) * 100, 1) AS monthly_win_rate
FROM closed WHERE open_date IS NOT NULL GROUP BY 1, 2 HAVING count(*) >= 2"""

# ----------------------------------------------------------------- stop loss
Q["sl_overall"] = f"""
SELECT analysis_type, ROUND(stop_loss_level_pct, 2) AS avg_sl_level_pct, total_trades_with_sl, sl_triggered_count, sl_trigger_rate_pct,
  sl_effectiveness_pct, ROUND(avg_loss_when_triggered_pct, 2) AS avg_loss_when_triggered_pct,
  ROUND(avg_profit_when_not_triggered_pct, 2) AS avg_profit_when_not_triggered_pct, trades_without_sl FROM {_sl('overall')}"""
Q["sl_by_pair"] = f"""
SELECT pair, total_trades_with_sl, sl_triggered_count, sl_trigger_rate_pct, sl_effectiveness_pct,
  ROUND(stop_loss_level_pct, 2) AS avg_sl_level_pct, ROUND(optimal_sl_level_pct, 2) AS optimal_sl_level_pct,
  ROUND(avg_loss_when_triggered_pct, 2) AS avg_loss_triggered, ROUND(avg_profit_when_not_triggered_pct, 2) AS avg_profit_not_triggered
FROM {_sl('by_pair')}"""
Q["sl_by_strategy"] = f"""
SELECT strategy, total_trades_with_sl, sl_triggered_count, sl_trigger_rate_pct, sl_effectiveness_pct,
  ROUND(stop_loss_level_pct, 2) AS avg_sl_level_pct, ROUND(avg_loss_when_triggered_pct, 2) AS avg_loss_triggered,
  ROUND(max_loss_prevented_pct, 2) AS max_loss_prevented FROM {_sl('by_strategy')}"""
_A = L.SL_ASSESSMENT
Q["sl_needs_work"] = f"""
SELECT pair, sl_effectiveness_pct, sl_trigger_rate_pct, ROUND(stop_loss_level_pct, 2) AS current_avg_sl,
  ROUND(optimal_sl_level_pct, 2) AS suggested_sl,
  {_pick([('sl_effectiveness_pct < 50', _A[0]), ('sl_trigger_rate_pct > 30', _A[1]), ('sl_trigger_rate_pct < 5', _A[2])], _A[3])} AS sl_assessment
FROM {_sl('by_pair')}"""
Q["sl_eff_bands"] = f"""
SELECT {band_sql('sl_effectiveness_pct', L.SL_EFFECTIVENESS_BANDS, L.SL_EFFECTIVENESS_ELSE)} AS effectiveness_category, count(*) AS pair_count,
  ROUND(avg(sl_effectiveness_pct), 1) AS avg_effectiveness, ROUND(avg(sl_trigger_rate_pct), 1) AS avg_trigger_rate,
  ROUND(avg(stop_loss_level_pct), 2) AS avg_sl_level
FROM {_sl('by_pair')} GROUP BY 1"""
Q["sl_trigger_bands"] = f"""
SELECT {band_sql('sl_trigger_rate_pct', L.SL_TRIGGER_BANDS, L.SL_TRIGGER_BANDS_ELSE)} AS trigger_rate_category, count(*) AS pair_count,
  ROUND(avg(sl_trigger_rate_pct), 1) AS avg_trigger_rate, ROUND(avg(sl_effectiveness_pct), 1) AS avg_effectiveness,
  ROUND(avg(avg_loss_when_triggered_pct), 2) AS avg_loss_when_triggered
FROM {_sl('by_pair')} GROUP BY 1"""
Q["sl_level_bands"] = f"""
SELECT {band_sql('stop_loss_level_pct', L.SL_LEVEL_BANDS, L.SL_LEVEL_BANDS_ELSE)} AS sl_level_category, count(*) AS pair_count,
  ROUND(avg(stop_loss_level_pct), 2) AS avg_sl_level, ROUND(avg(sl_trigger_rate_pct), 1) AS avg_trigger_rate,
  ROUND(avg(sl_effectiveness_pct), 1) AS avg_effectiveness, ROUND(avg(avg_profit_when_not_triggered_pct), 2) AS avg_profit_no_trigger
FROM {_sl('by_pair')} WHERE stop_loss_level_pct IS NOT NULL GROUP BY 1"""
Q["sl_direct_overview"] = f"""
SELECT {sql_str(L.CAPTIONS['sl_direct_overview'])} AS analysis_type, count(*) AS total_trades,
  ISUM(CASE WHEN stop_loss_pct IS NOT NULL THEN 1 ELSE 0 END) AS trades_with_sl,
  ROUND(ISUM(CASE WHEN stop_loss_pct IS NOT NULL THEN 1 ELSE 0 END) * 100.0 / count(*), 1) AS sl_usage_rate_pct,
  ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS sl_triggered,
  ROUND(ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) * 100.0
        / NULLIF(ISUM(CASE WHEN stop_loss_pct IS NOT NULL THEN 1 ELSE 0 END), 0), 1) AS sl_trigger_rate_pct,
  ROUND(avg(stop_loss_pct), 2) AS avg_sl_level_pct,
  ROUND(avg(CASE WHEN exit_reason = 'stop_loss' THEN profit_pct END), 2) AS avg_loss_when_triggered
FROM closed"""
Q["sl_by_exit_reason"] = _by_exit_reason(("worst_outcome_pct", "best_outcome_pct"), True)
_PROT = f"""count(*) AS trade_count, ROUND(avg(profit_pct), 2) AS avg_profit_pct, ROUND(min(profit_pct), 2) AS worst_loss_pct,
  ROUND(avg({WIN}) * 100, 1) AS win_rate_pct"""
Q["sl_with_vs_without"] = f"""
SELECT {sql_str(L.WITH_SL)} AS protection_type, {_PROT}, ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS protection_triggered
FROM closed WHERE stop_loss_pct IS NOT NULL
UNION ALL
SELECT {sql_str(L.WITHOUT_SL)}, {_PROT}, CAST(0 AS BIGINT) FROM closed WHERE stop_loss_pct IS NULL"""
Q["sl_level_distribution"] = f"""
SELECT {band_sql('stop_loss_pct', L.SL_RAW_LEVEL_BANDS, L.SL_RAW_LEVEL_BANDS_ELSE)} AS sl_level_range, count(*) AS trade_count,
  ROUND(avg(stop_loss_pct), 2) AS avg_sl_level, ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS triggered_count,
  ROUND(ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) * 100.0 / count(*), 1) AS trigger_rate_pct,
  ROUND(avg(profit_pct), 2) AS avg_outcome_pct
FROM closed WHERE stop_loss_pct IS NOT NULL GROUP BY 1"""

# ----------------------------------------------------------------- duration
Q["dp_overall"] = f"""
SELECT duration_category, trade_count, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
  ROUND(total_profit_abs, 2) AS total_profit, ROUND(optimal_exit_timing_minutes, 0) AS avg_duration_min,
  ROUND(profit_per_hour, 3) AS profit_per_hour, ROUND(min_duration_minutes, 0) AS min_duration_min,
  ROUND(max_duration_minutes, 0) AS max_duration_min FROM {_dp('duration_based')}"""
Q["dp_efficiency_rating"] = f"""
SELECT duration_category, trade_count, ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(profit_per_hour, 3) AS profit_per_hour,
  ROUND(optimal_exit_timing_minutes / 60.0, 1) AS avg_duration_hours,
  {band_sql('profit_per_hour', L.EFFICIENCY_BANDS, L.EFFICIENCY_BANDS_ELSE)} AS efficiency_rating FROM {_dp('duration_based')}"""
Q["dp_by_pair_top20"] = f"""
SELECT pair, duration_category, trade_count, win_rate_pct, avg_profit_pct, profit_per_hour, optimal_timing_min FROM (
  SELECT pair, duration_category, trade_count, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
    ROUND(profit_per_hour, 3) AS profit_per_hour, profit_per_hour AS pph, ROUND(optimal_exit_timing_minutes, 0) AS optimal_timing_min
  FROM {_dp('by_pair')} WHERE trade_count >= 3)
ORDER BY profit_per_hour DESC NULLS LAST, pph DESC NULLS LAST, pair NULLS FIRST, duration_category NULLS FIRST LIMIT 20"""
Q["dp_by_strategy"] = f"""
SELECT strategy, duration_category, trade_count, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
  ROUND(profit_per_hour, 3) AS profit_per_hour, ROUND(optimal_exit_timing_minutes / 60.0, 1) AS optimal_timing_hours
FROM {_dp('by_strategy')}"""
Q["dp_efficiency_rank"] = f"""
SELECT {sql_str(L.CAPTIONS['dp_efficiency_rank'])} AS analysis_type, duration_category, trade_count,
  ROUND(avg_profit_pct, 2) AS avg_profit_pct, ROUND(optimal_exit_timing_minutes, 0) AS avg_duration_min,
  ROUND(profit_per_hour, 3) AS profit_per_hour, CAST(rank() OVER (ORDER BY profit_per_hour DESC NULLS LAST) AS INTEGER) AS efficiency_rank
FROM {_dp('duration_based')}"""
_DR = [(f"win_rate >= {w}" + (f" AND avg_profit_pct >= {a}" if a is not None else ""), lbl) for w, a, lbl in L.DURATION_RATING]
Q["dp_win_rating"] = f"""
SELECT duration_category, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit_pct,
  ROUND(optimal_exit_timing_minutes / 60.0, 1) AS avg_duration_hours, trade_count,
  {_pick(_DR, L.DURATION_RATING_ELSE)} AS performance_rating FROM {_dp('duration_based')}"""
_CATS = [n for _o, _v, n in L.DURATION_CATEGORIES] + [L.DURATION_CATEGORIES_ELSE]
_EFFC = ["scalp_efficiency", "short_efficiency", "day_efficiency", "swing_efficiency"]
Q["dp_optimal_by_pair"] = f"""
SELECT pair, categories_traded, {', '.join(_EFFC)},
  {_pick([(f'best = {col}', cat) for cat, col in zip(_CATS[:3], _EFFC[:3])], _CATS[3])} AS optimal_duration_category
FROM (
  SELECT pair, count(DISTINCT duration_category) AS categories_traded,
    {', '.join(f"max(CASE WHEN duration_category = '{cat}' THEN profit_per_hour END) AS {col}" for cat, col in zip(_CATS, _EFFC))},
    max(profit_per_hour) AS best
  FROM {_dp('by_pair')} GROUP BY pair HAVING count(DISTINCT duration_category) >= 2)"""
Q["dp_timing_ranges"] = f"""
SELECT {band_sql('optimal_exit_timing_minutes', L.TIMING_RANGES, L.TIMING_RANGES_ELSE)} AS timing_range, count(*) AS pattern_count,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct,
  ROUND(avg(profit_per_hour), 3) AS avg_profit_per_hour, ISUM(trade_count) AS total_trades_in_range
FROM {_dp('by_pair')} GROUP BY 1"""
Q["dp_windows"] = f"""
SELECT {band_sql('optimal_exit_timing_minutes', L.DURATION_WINDOWS, L.DURATION_WINDOWS_ELSE)} AS duration_window, count(*) AS pattern_count,
  ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct, ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct,
  ROUND(sum(total_profit_abs), 2) AS total_profit_in_window, ROUND(avg(profit_per_hour), 3) AS avg_efficiency
FROM {_dp('by_pair')} GROUP BY 1"""
Q["dp_strategy_efficiency"] = f"""
SELECT strategy, count(DISTINCT duration_category) AS duration_categories_used, ROUND(avg(avg_profit_pct), 2) AS overall_avg_profit,
  ROUND(avg(profit_per_hour), 3) AS overall_efficiency, max(profit_per_hour) AS best_efficiency, min(profit_per_hour) AS worst_efficiency,
  ROUND(max(profit_per_hour) - min(profit_per_hour), 3) AS efficiency_range
FROM {_dp('by_strategy')} GROUP BY strategy HAVING count(DISTINCT duration_category) >= 2"""
Q["dp_category_matrix"] = f"""
SELECT duration_category, count(DISTINCT pair) AS pairs_using_duration, ROUND(avg(avg_profit_pct), 2) AS avg_profit_pct,
  ROUND(avg(win_rate) * 100, 1) AS avg_win_rate_pct, ROUND(avg(profit_per_hour), 3) AS avg_efficiency,
  ISUM(trade_count) AS total_trades, ROUND(sum(total_profit_abs), 2) AS total_profit_generated
FROM {_dp('by_pair')} GROUP BY duration_category"""
Q["dp_direct"] = f"""
SELECT {band_sql('trade_duration', L.STRATEGY_DURATION_BANDS, L.STRATEGY_DURATION_BANDS_ELSE)} AS duration_category, count(*) AS trade_count,
  ROUND(avg(profit_pct), 2) AS avg_profit_pct, ROUND(avg({WIN}) * 100, 1) AS win_rate_pct,
  ROUND(min(trade_duration), 0) AS min_duration_min, ROUND(max(trade_duration), 0) AS max_duration_min,
  ROUND(avg(trade_duration), 0) AS avg_duration_min,
  ROUND(avg(profit_pct) / NULLIF(avg(trade_duration) / 60.0, 0.0), 3) AS profit_per_hour
FROM closed WHERE trade_duration IS NOT NULL GROUP BY 1"""
Q["dp_hour_histogram"] = """
SELECT ROUND(trade_duration / 60.0, 1) AS duration_hours, count(*) AS trades_at_duration, ROUND(avg(profit_pct), 2) AS avg_profit_pct,
  ROUND(min(profit_pct), 2) AS min_profit_pct, ROUND(max(profit_pct), 2) AS max_profit_pct
FROM closed WHERE trade_duration IS NOT NULL AND trade_duration <= 2880 GROUP BY 1 HAVING count(*) >= 2"""
Q["dp_exit_timing"] = """
SELECT pair, total_trades, avg_duration_min, avg_profit_pct, fastest_exit_min, slowest_exit_min, duration_range_min, distinct_duration_hours FROM (
  SELECT pair, count(*) AS total_trades, ROUND(avg(trade_duration), 0) AS avg_duration_min, ROUND(avg(profit_pct), 2) AS avg_profit_pct,
    avg(profit_pct) AS a, ROUND(min(trade_duration), 0) AS fastest_exit_min, ROUND(max(trade_duration), 0) AS slowest_exit_min,
    ROUND(max(trade_duration) - min(trade_duration), 0) AS duration_range_min,
    count(DISTINCT ROUND(trade_duration / 60.0, 0)) AS distinct_duration_hours
  FROM closed WHERE trade_duration IS NOT NULL GROUP BY pair HAVING count(*) >= 5)
ORDER BY avg_profit_pct DESC NULLS LAST, a DESC NULLS LAST, pair LIMIT 15"""

# ----------------------------------------------------------------- health
BH = "bot_health_metrics"
Q["bh_dashboard"] = f"""
SELECT metric_name, ROUND(metric_value, 2) AS current_value, metric_unit, health_status,
  ROUND(threshold_warning, 2) AS warning_threshold, ROUND(threshold_critical, 2) AS critical_threshold, metric_description FROM {BH}"""
Q["bh_status_summary"] = f"""
SELECT health_status, count(*) AS metric_count, ROUND(count(*) * 100.0 / (SELECT count(*) FROM {BH}), 1) AS percentage_of_metrics
FROM {BH} GROUP BY health_status"""
Q["bh_attention"] = f"""
SELECT metric_name, ROUND(metric_value, 2) AS current_value, metric_unit, health_status, recommendation,
  {_pick([(f"health_status = '{k}'", v) for k, v in L.PRIORITY.items()], L.PRIORITY_ELSE)} AS priority_level
FROM {BH} WHERE health_status IN ('CRITICAL', 'WARNING')"""
Q["bh_summary"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_summary'])} AS summary_type, count(*) AS total_metrics, {HEALTH_COUNTS[0]} AS healthy_metrics,
  {HEALTH_COUNTS[1]} AS warning_metrics, {HEALTH_COUNTS[2]} AS critical_metrics,
  ROUND({HEALTH_COUNTS[0]} * 100.0 / NULLIF(count(*), 0), 1) AS health_score_pct FROM {BH}"""
Q["bh_correlated"] = f"""
SELECT metric_name, metric_value, health_status,
  CASE WHEN metric_name = 'overall_win_rate' THEN (SELECT ROUND(avg(profit_pct), 2) FROM closed)
       WHEN metric_name = 'average_profit_pct' THEN (SELECT ROUND(count(*), 0) FROM closed) END AS correlated_value
FROM {BH} WHERE metric_name IN ('overall_win_rate', 'average_profit_pct')"""
_RH = L.RISK_HEALTH
Q["bh_risk_assessment"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_risk_assessment'])} AS assessment_type, v_worst_loss_control AS worst_loss_pct,
  v_stop_loss_utilization_rate AS sl_trigger_rate_pct, v_portfolio_diversification AS pairs_traded,
  {_pick([("s_worst_loss_control = 'HEALTHY' AND s_stop_loss_utilization_rate = 'HEALTHY' AND s_portfolio_diversification = 'HEALTHY'", _RH[0]),
          ("s_worst_loss_control <> 'CRITICAL' AND s_stop_loss_utilization_rate <> 'CRITICAL'", _RH[1])], _RH[2])} AS overall_risk_health
FROM {_pivot(['worst_loss_control', 'stop_loss_utilization_rate', 'portfolio_diversification'])}"""
_EH = L.EFFICIENCY_HEALTH
Q["bh_efficiency"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_efficiency'])} AS assessment_type, v_trade_duration_efficiency AS avg_duration_min,
  v_trading_activity AS activity_consistency_pct, v_strategy_utilization AS strategies_count,
  {_pick([("v_trade_duration_efficiency <= 240 AND v_trading_activity >= 60", _EH[0]),
          ("v_trade_duration_efficiency <= 480 AND v_trading_activity >= 40", _EH[1])], _EH[2])} AS efficiency_rating
FROM {_pivot(['trade_duration_efficiency', 'trading_activity', 'strategy_utilization'])}"""
_PH = L.PROFITABILITY
Q["bh_profitability"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_profitability'])} AS check_type, ROUND(v_total_profit_abs, 2) AS total_profit,
  ROUND(v_average_profit_pct, 2) AS avg_profit_pct, ROUND(v_overall_win_rate, 1) AS win_rate_pct,
  ROUND(v_best_win_achievement, 2) AS best_win_pct,
  {_pick([("v_total_profit_abs > 0 AND v_average_profit_pct > 0.5 AND v_overall_win_rate > 60", _PH[0]),
          ("v_total_profit_abs >= 0", _PH[1])], _PH[2])} AS profitability_status
FROM {_pivot(['total_profit_abs', 'average_profit_pct', 'overall_win_rate', 'best_win_achievement'])}"""
Q["bh_critical_alerts"] = _alerts("CRITICAL", "threshold_critical", "critical_threshold", "action_required", "critical_alert")
Q["bh_warning_alerts"] = _alerts("WARNING", "threshold_warning", "warning_threshold", "suggested_action", "warning_alert")
_SCORE = f"{HEALTH_COUNTS[0]} * 100.0 / NULLIF(count(*), 0)"
Q["bh_score"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_score'])} AS metric_type, ROUND({_SCORE}, 1) AS health_score_pct,
  {HEALTH_COUNTS[0]} AS healthy_count, {HEALTH_COUNTS[1]} AS warning_count, {HEALTH_COUNTS[2]} AS critical_count,
  count(*) AS total_metrics, {band_sql(f'({_SCORE})', L.HEALTH_SCORE_BANDS, L.HEALTH_SCORE_ELSE)} AS overall_health_rating
FROM {BH}"""
Q["bh_realtime"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_realtime'])} AS check_type, count(*) AS total_trades, ROUND(avg({WIN}) * 100, 1) AS current_win_rate_pct,
  ROUND(avg(profit_pct), 2) AS current_avg_profit_pct, ROUND(sum(profit_abs), 2) AS current_total_profit,
  ROUND(min(profit_pct), 2) AS current_worst_loss_pct, count(DISTINCT pair) AS pairs_currently_traded,
  count(DISTINCT strategy) AS strategies_currently_used,
  {_pick([(f"avg({WIN}) >= 0.6 AND avg(profit_pct) >= 0.5 AND sum(profit_abs) > 0", L.HEALTHY),
          (f"avg({WIN}) >= 0.4 AND sum(profit_abs) >= 0", L.WARNING)], L.CRITICAL)} AS real_time_health_status
FROM closed"""
_TR = L.TREND
Q["bh_recent30"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_recent30'])} AS trend_type, count(*) AS recent_trades, ROUND(avg(profit_pct), 2) AS recent_avg_profit_pct,
  ROUND(avg({WIN}) * 100, 1) AS recent_win_rate_pct, ROUND(sum(profit_abs), 2) AS recent_total_profit,
  ROUND(avg(trade_duration), 0) AS recent_avg_duration_min,
  {_pick([(f"avg(profit_pct) >= 0.5 AND avg({WIN}) >= 0.6", _TR[0]), ("avg(profit_pct) >= 0.0", _TR[1])], _TR[2])} AS trend_direction
FROM (SELECT profit_pct, trade_duration, profit_abs FROM closed ORDER BY trade_id DESC LIMIT 30)"""
_DV = L.DIVERSIFICATION
Q["bh_utilization"] = f"""
SELECT {sql_str(L.CAPTIONS['bh_utilization'])} AS metric_type, count(DISTINCT pair) AS unique_pairs_traded,
  count(DISTINCT strategy) AS unique_strategies_used, count(DISTINCT base_currency) AS unique_base_currencies,
  count(DISTINCT quote_currency) AS unique_quote_currencies, count(DISTINCT CAST(open_date AS DATE)) AS unique_trading_days,
  ROUND(avg(stake_amount), 2) AS avg_stake_per_trade, ROUND(sum(stake_amount), 2) AS total_capital_deployed,
  {_pick([("count(DISTINCT pair) >= 5 AND count(DISTINCT strategy) >= 2", _DV[0]), ("count(DISTINCT pair) >= 3", _DV[1])], _DV[2])} AS diversification_level
FROM closed"""

# ----------------------------------------------------------------- data quality
Q["dq_pr_quality"] = _dq(PR, "pr_quality", "count(*) AS total_pairs, count(CASE WHEN profit_pct IS NULL THEN 1 END) AS null_profit_count, "
                     "count(CASE WHEN win_rate IS NULL THEN 1 END) AS null_winrate_count, count(CASE WHEN trade_count < 1 THEN 1 END) AS invalid_trade_count")
Q["dq_rm_quality"] = _dq("risk_metrics", "rm_quality", "count(*) AS total_records, count(CASE WHEN stop_loss_triggered_count IS NULL THEN 1 END) AS null_sl_count, "
                     "count(CASE WHEN max_drawdown_pct IS NULL THEN 1 END) AS null_drawdown_count, "
                     "count(CASE WHEN max_drawdown_pct > 0 THEN 1 END) AS positive_drawdown_errors")
Q["dq_sp_quality"] = _dq(SP, "sp_quality", "count(*) AS total_strategies, count(CASE WHEN avg_profit_pct IS NULL THEN 1 END) AS null_profit_count, "
                     "count(CASE WHEN win_rate IS NULL THEN 1 END) AS null_winrate_count, count(CASE WHEN total_trades < 1 THEN 1 END) AS invalid_trade_count, "
                     "count(CASE WHEN win_rate > 1.0 THEN 1 END) AS invalid_winrate_count")
Q["dq_ta_quality"] = _dq("timing_analysis", "ta_quality", "count(*) AS total_records, count(DISTINCT time_category) AS categories_analyzed, "
                     "count(CASE WHEN avg_profit_pct IS NULL THEN 1 END) AS null_profit_count, count(CASE WHEN trade_count < 1 THEN 1 END) AS invalid_trade_count, "
                     "min(analysis_date) AS oldest_analysis, max(analysis_date) AS newest_analysis")
Q["dq_pa_quality"] = _dq(PA, "pa_quality", "count(*) AS total_pairs, count(CASE WHEN avg_profit_pct IS NULL THEN 1 END) AS null_profit_count, "
                     "count(CASE WHEN win_rate IS NULL THEN 1 END) AS null_winrate_count, count(CASE WHEN total_trades < 1 THEN 1 END) AS invalid_trade_count, "
                     "count(CASE WHEN win_rate > 1.0 THEN 1 END) AS invalid_winrate_count, count(CASE WHEN base_currency IS NULL THEN 1 END) AS null_base_currency_count")
Q["dq_sl_quality"] = _dq("stop_loss_analytics", "sl_quality", "count(*) AS total_records, count(CASE WHEN sl_effectiveness_pct IS NULL THEN 1 END) AS null_effectiveness_count, "
                     "count(CASE WHEN sl_trigger_rate_pct IS NULL THEN 1 END) AS null_trigger_rate_count, "
                     "count(CASE WHEN sl_effectiveness_pct > 100 THEN 1 END) AS invalid_effectiveness_count, "
                     "count(CASE WHEN total_trades_with_sl < sl_triggered_count THEN 1 END) AS logic_errors")
Q["dq_dp_quality"] = _dq("duration_patterns", "dp_quality", "count(*) AS total_records, count(CASE WHEN avg_profit_pct IS NULL THEN 1 END) AS null_profit_count, "
                     "count(CASE WHEN optimal_exit_timing_minutes IS NULL THEN 1 END) AS null_timing_count, "
                     "count(CASE WHEN profit_per_hour IS NULL THEN 1 END) AS null_efficiency_count, count(CASE WHEN trade_count < 1 THEN 1 END) AS invalid_trade_count, "
                     "count(CASE WHEN min_duration_minutes > max_duration_minutes THEN 1 END) AS duration_logic_errors")
Q["dq_bh_quality"] = _dq(BH, "bh_quality", "count(*) AS total_metrics, count(CASE WHEN metric_value IS NULL THEN 1 END) AS null_value_count, "
                     "count(CASE WHEN health_status IS NULL THEN 1 END) AS null_status_count, "
                     "count(CASE WHEN health_status NOT IN ('HEALTHY', 'WARNING', 'CRITICAL') THEN 1 END) AS invalid_status_count, "
                     "count(CASE WHEN metric_unit IS NULL THEN 1 END) AS null_unit_count")


def _dup(table, keys):
    k = ", ".join(keys)
    return f"SELECT '{table}' AS table_name, count(CASE WHEN c > 1 THEN 1 END) AS duplicate_keys FROM (SELECT {k}, count(*) AS c FROM {table} GROUP BY {k})"


def _key_unique():
    return "\nUNION ALL\n".join(_dup(t, keys) for t, (keys, _, _) in CELLS.items())


Q["dq_trades_nulls"] = "SELECT count(*) AS total_trades, count(profit_pct) AS trades_with_profit, count(trade_duration) AS trades_with_duration FROM closed"

# ----------------------------------------------------------------- guide queries
Q["doc_top_pairs"] = f"SELECT entity_name, profit_pct, win_rate, trade_count FROM {PR} ORDER BY profit_pct DESC NULLS LAST, entity_name LIMIT 5"
Q["doc_strategy_list"] = f"SELECT strategy_name, ROUND(win_rate * 100, 1) AS win_rate_pct, ROUND(avg_profit_pct, 2) AS avg_profit, total_trades FROM {SP}"
Q["doc_health_list"] = f"SELECT metric_name, ROUND(metric_value, 2) AS value, metric_unit, health_status FROM {BH}"
Q["doc_health_lookup"] = f"SELECT metric_name, metric_value, metric_unit, health_status, threshold_warning, threshold_critical FROM {BH} WHERE metric_name = 'overall_win_rate'"
Q["doc_best_hours"] = f"""
SELECT best_performance_hour AS best_hour, worst_performance_hour AS worst_hour, ROUND(weekend_performance_pct, 2) AS weekend_profit,
  ROUND(weekday_performance_pct, 2) AS weekday_profit FROM {_ta('overall')}"""
Q["doc_high_risk"] = f"""
SELECT entity_name AS trading_pair, max_drawdown_pct AS worst_loss, volatility_pct, stop_loss_effectiveness_pct
FROM {_rm('by_pair')} WHERE max_drawdown_pct < -10 OR volatility_pct > 5"""
Q["doc_three_way"] = f"""
SELECT pr.entity_name AS pair, pr.profit_pct, rm.volatility_pct, ta.best_performance_hour
FROM {PR} pr JOIN risk_metrics rm ON pr.entity_name = rm.entity_name JOIN {_ta('overall')} ta ON true
ORDER BY pr.profit_pct DESC NULLS LAST, pr.entity_name, rm.metric_type LIMIT 10"""
Q["doc_recent_trades"] = """
SELECT pair, strategy, ROUND(profit_ratio * 100, 2) AS profit_pct, exit_reason, open_date AS open_date_utc, close_date AS close_date_utc
FROM closed ORDER BY close_date DESC NULLS LAST, trade_id DESC LIMIT 10"""
Q["doc_strategy_raw"] = """
SELECT strategy, count(*) AS total_trades, round(avg(profit_ratio * 100), 9) AS avg_profit_pct,
  ISUM(CASE WHEN profit_ratio > 0 THEN 1 ELSE 0 END) * 100.0 / count(*) AS win_rate
FROM closed GROUP BY strategy"""

# ----------------------------------------------------------------- sources
Q["src_open_closed_counts"] = """
SELECT count(*) AS total_trades, sum(CAST(is_open AS BIGINT)) AS open_trades, sum(CAST(NOT is_open AS BIGINT)) AS closed_trades FROM trades"""
Q["src_open_closed_counts"] = Q["src_open_closed_counts"].replace("sum(CAST(is_open AS BIGINT))", "ISUM(CAST(is_open AS INTEGER))").replace(
    "sum(CAST(NOT is_open AS BIGINT))", "ISUM(CAST(NOT is_open AS INTEGER))"
)

# ----------------------------------------------------------------- streaming
# Columns of each result table besides its key: numbers, then words.
CELLS = {
    "performance_rankings": (["ranking_type", "entity_name", "entity_type"],
        "profit_ratio profit_pct profit_abs trade_count win_rate avg_duration_minutes max_profit_pct min_profit_pct total_volume rank_position", ""),
    "risk_metrics": (["metric_type", "entity_name"],
        "stop_loss_triggered_count stop_loss_effectiveness_pct sharpe_ratio max_drawdown_pct volatility_pct var_95_pct risk_reward_ratio", ""),
    "strategy_performance": (["strategy_name"],
        "total_trades winning_trades losing_trades win_rate avg_profit_pct total_profit_abs profit_factor expectancy best_trade_pct worst_trade_pct "
        "consistency_score avg_trade_duration_minutes max_consecutive_wins max_consecutive_losses sharpe_ratio sortino_ratio calmar_ratio", ""),
    "timing_analysis": (["time_category", "hour_of_day", "day_of_week", "day_of_month", "month_of_year"],
        "trade_count win_rate avg_profit_pct total_profit_abs best_performance_hour worst_performance_hour weekend_performance_pct "
        "weekday_performance_pct duration_minutes_avg volatility_pct", "time_period_name"),
    "pair_analytics": (["pair"],
        "total_trades winning_trades losing_trades win_rate avg_profit_pct total_profit_abs avg_trade_duration_minutes price_volatility_pct "
        "best_trade_pct worst_trade_pct total_volume avg_stake_amount profit_factor sharpe_ratio max_consecutive_wins max_consecutive_losses",
        "base_currency quote_currency"),
    "stop_loss_analytics": (["analysis_type", "pair", "strategy"],
        "stop_loss_level_pct total_trades_with_sl sl_triggered_count sl_trigger_rate_pct sl_effectiveness_pct avg_loss_when_triggered_pct "
        "avg_profit_when_not_triggered_pct max_loss_prevented_pct optimal_sl_level_pct trades_without_sl avg_loss_without_sl_pct", ""),
    "duration_patterns": (["pattern_type", "duration_category", "pair", "strategy"],
        "min_duration_minutes max_duration_minutes trade_count win_rate avg_profit_pct total_profit_abs optimal_exit_timing_minutes profit_per_hour", ""),
    "bot_health_metrics": (["metric_name"], "metric_value threshold_warning threshold_critical", "metric_unit health_status metric_description recommendation"),
}


def _cells() -> str:
    out = []
    for table, (keys, numbers, words) in CELLS.items():
        entity = " || '|' || ".join(f"coalesce(CAST({k} AS VARCHAR), '-')" for k in keys)
        for name in numbers.split():
            number = f"round({name}, 9)" if name == "profit_ratio" else f"CAST({name} AS DOUBLE)"
            out.append(f"SELECT '{table}' AS \"table\", {entity} AS entity, '{name}' AS metric, {number} AS number, CAST(NULL AS VARCHAR) AS word FROM {table}")
        for name in words.split():
            out.append(f"SELECT '{table}', {entity}, '{name}', CAST(NULL AS DOUBLE), {name} FROM {table}")
    return "\nUNION ALL\n".join(out)


Q["dq_key_unique"] = _key_unique()
Q["str_stream_refresh"] = _cells()
Q["str_live_windows"] = f"""
SELECT time_bucket(INTERVAL '1 hour', close_date) AS window_start, time_bucket(INTERVAL '1 hour', close_date) + INTERVAL '1 hour' AS window_end,
  strategy, count(*) AS trades, avg(profit_pct) AS avg_profit_pct, sum(profit_abs) AS total_profit_abs, avg({WIN}) AS win_rate
FROM closed WHERE close_date IS NOT NULL
  AND time_bucket(INTERVAL '1 hour', close_date) + INTERVAL '1 hour' <= (SELECT max(close_date) - INTERVAL '1 hour' FROM closed)
GROUP BY 1, 2, 3"""

Q["str_revised_windows"] = f"""
, span AS (SELECT epoch_us(min(close_date)) AS low, epoch_us(max(close_date)) AS high, max(close_date) - INTERVAL '1 hour' AS passed FROM closed),
timed AS (
  SELECT c.*, time_bucket(INTERVAL '1 hour', close_date) AS window_start, epoch_us(close_date) <= low + (high - low) * 2 // 3 AS after_the_last
  FROM closed c, span WHERE close_date IS NOT NULL
)
SELECT window_start, window_start + INTERVAL '1 hour' AS window_end, strategy, count(*) AS trades, avg(profit_pct) AS avg_profit_pct,
  sum(profit_abs) AS total_profit_abs, avg({WIN}) AS win_rate,
  ISUM(CASE WHEN after_the_last AND window_start + INTERVAL '1 hour' <= passed THEN 1 ELSE 0 END) AS late_rows
FROM timed, span GROUP BY window_start, strategy"""

# ----------------------------------------------------------------- health history / normalisation
def _history() -> str:
    """Health of the trades of the first one, two and three thirds of the span of close times."""
    from oracle.prelude import AS_OF, _health_rows

    rows = _health_rows().replace("FROM health_stats", "FROM history_stats")
    rows = rows.replace("SELECT 'overall_win_rate' AS metric_name", "SELECT batch_id, 'overall_win_rate' AS metric_name")
    rows = rows.replace("\n  UNION ALL\n  SELECT ", "\n  UNION ALL\n  SELECT batch_id, ")
    return f"""
, span AS (SELECT epoch_us(min(close_date)) AS low, epoch_us(max(close_date)) AS high FROM closed),
arrivals AS (
  SELECT c.*, CASE WHEN close_date IS NULL OR epoch_us(close_date) <= low + (high - low) * 1 // 3 THEN 0
                   WHEN epoch_us(close_date) <= low + (high - low) * 2 // 3 THEN 1 ELSE 2 END AS arrived
  FROM closed c, span
),
history_stats AS (
  SELECT b.batch_id, count(*) AS total_trades, avg({WIN}) AS win_rate, avg(c.profit_pct) AS avg_profit_pct,
    sum(c.profit_abs) AS total_profit, min(c.profit_pct) AS worst_loss, max(c.profit_pct) AS best_win,
    count(DISTINCT c.pair) AS pairs_traded, count(DISTINCT c.strategy) AS strategies_used, avg(c.trade_duration) AS avg_duration_minutes,
    ISUM(CASE WHEN c.exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS sl_triggered,
    count(DISTINCT CAST(c.open_date AS DATE)) AS active_days,
    (epoch_us(max(c.open_date)) - epoch_us(min(c.open_date))) / 86400000000.0 AS span
  FROM (SELECT unnest([0, 1, 2]) AS batch_id) b JOIN arrivals c ON c.arrived <= b.batch_id
  GROUP BY b.batch_id
),
history AS (
  SELECT CAST(batch_id AS BIGINT) AS batch_id, metric_name, ROUND(metric_value, 6) AS metric_value, health_status,
    {AS_OF} + to_hours(batch_id) AS analysis_date,
    lag(health_status) OVER (PARTITION BY metric_name ORDER BY batch_id) AS previous_status
  FROM ({rows})
)"""


Q["bh_history_lag"] = _history() + """
SELECT metric_name, metric_value, health_status, analysis_date,
  lag(metric_value) OVER (PARTITION BY metric_name ORDER BY analysis_date) AS previous_value,
  ROUND(metric_value - lag(metric_value) OVER (PARTITION BY metric_name ORDER BY analysis_date), 2) AS value_change
FROM history"""
Q["str_alerts"] = _history() + """
SELECT batch_id, metric_name, metric_value, health_status, previous_status, previous_status <> health_status AS changed
FROM history WHERE batch_id > 0 AND (previous_status <> health_status OR health_status IN ('CRITICAL', 'WARNING'))"""

# ----------------------------------------------------------------- sinks
Q["snk_overwrite_subtypes"] = """
SELECT * FROM risk_metrics WHERE metric_type IN ('overall', 'var_analysis') OR (metric_type = 'by_pair' AND max_drawdown_pct < -15)"""
Q["snk_version"] = "SELECT * EXCLUDE (analysis_date) FROM stop_loss_analytics"
Q["snk_ledger_report"] = """
SELECT 'automated_analysis' AS snapshot_type, 'completed' AS status, records_processed, TIMESTAMP '2024-07-01 12:00:00' + to_hours(hours) AS last_run
FROM (
  SELECT count(*) AS records_processed, 0 AS hours FROM closed WHERE trade_id % 3 <> 0
  UNION ALL SELECT count(*), 1 FROM closed WHERE trade_id % 3 = 0
  UNION ALL SELECT count(*), 3 FROM closed
)"""
Q["snk_upsert"] = """
SELECT metric_type, entity_name, max_drawdown_pct * CASE WHEN metric_type IN ('overall', 'by_strategy', 'var_analysis') THEN 2 ELSE 1 END AS max_drawdown_pct,
  var_95_pct FROM risk_metrics"""
Q["snk_csv_export"] = "SELECT pair, total_trades, winning_trades, best_trade_pct, worst_trade_pct, total_volume FROM pair_analytics"
Q["snk_update_table"] = """
SELECT 'pair_analytics' AS "table", pair AS entity, total_trades AS trades FROM pair_analytics
UNION ALL SELECT 'timing_analysis', CAST(hour(open_date) AS VARCHAR), count(*) FROM closed WHERE trade_id % 3 <> 0 AND open_date IS NOT NULL GROUP BY 2"""
for _report in ("pr_top10", "rm_sl_by_pair", "sp_ranking", "ta_best_hours", "pa_rating", "sl_by_strategy", "dp_by_strategy", "bh_dashboard"):
    Q[f"stored_{_report}"] = Q[_report]
Q["src_load_trades"] = """
SELECT trade_id, pair, base_currency, quote_currency, is_open, strategy, profit_pct, profit_abs, profit_ratio, trade_duration, exit_reason,
  stop_loss_pct, stake_amount, open_date, close_date FROM trades"""
Q["src_rejects"] = """
SELECT count(*) AS rows_read, CAST(0 AS BIGINT) AS trade_id_rejected, count(CASE WHEN trade_id % 7 = 0 THEN 1 END) AS is_open_rejected,
  count(CASE WHEN trade_id % 7 = 0 THEN 1 END) AS profit_pct_rejected, count(CASE WHEN trade_id % 11 = 0 THEN 1 END) AS open_date_rejected
FROM trades"""
_BOTS = """
, bots AS (
  SELECT 'bot_a' AS bot_id, trade_id, pair, strategy, profit_pct, profit_abs FROM closed
  UNION ALL SELECT 'bot_b', trade_id // 3, pair, strategy, profit_pct, profit_abs FROM closed WHERE trade_id % 3 = 0
)"""
Q["bots_rankings"] = _BOTS + f"""
SELECT bot_id, pair AS entity_name, avg(profit_pct) AS profit_pct, sum(profit_abs) AS profit_abs, count(*) AS trade_count, avg({WIN}) AS win_rate,
  CAST(row_number() OVER (PARTITION BY bot_id ORDER BY avg(profit_pct) DESC NULLS LAST, pair ASC NULLS FIRST) AS INTEGER) AS rank_position
FROM bots GROUP BY bot_id, pair"""
Q["bots_strategies"] = _BOTS + f"""
, numbered AS (
  SELECT *, row_number() OVER (PARTITION BY bot_id, strategy ORDER BY trade_id) AS rn,
    row_number() OVER (PARTITION BY bot_id, strategy, coalesce(profit_pct > 0, false) ORDER BY trade_id) AS rw,
    row_number() OVER (PARTITION BY bot_id, strategy, coalesce(profit_pct <= 0, false) ORDER BY trade_id) AS rl
  FROM bots
),
runs AS (
  SELECT bot_id, strategy, count(*) AS w, NULL AS l FROM numbered WHERE profit_pct > 0 GROUP BY bot_id, strategy, rn - rw
  UNION ALL SELECT bot_id, strategy, NULL, count(*) FROM numbered WHERE profit_pct <= 0 GROUP BY bot_id, strategy, rn - rl
),
longest AS (SELECT bot_id, strategy, max(w) AS max_consecutive_wins, max(l) AS max_consecutive_losses FROM runs GROUP BY bot_id, strategy)
SELECT b.bot_id, b.strategy AS strategy_name, count(*) AS total_trades,
  ISUM(CASE WHEN profit_pct > 0 THEN 1 ELSE 0 END) AS winning_trades, ISUM(CASE WHEN profit_pct <= 0 THEN 1 ELSE 0 END) AS losing_trades,
  avg({WIN}) AS win_rate, avg(profit_pct) AS avg_profit_pct,
  CASE WHEN sum(CASE WHEN profit_abs < 0 THEN abs(profit_abs) ELSE 0.0 END) > 0
       THEN sum(CASE WHEN profit_abs > 0 THEN profit_abs ELSE 0.0 END) / sum(CASE WHEN profit_abs < 0 THEN abs(profit_abs) ELSE 0.0 END)
       ELSE 0.0 END AS profit_factor,
  CASE WHEN count(*) > 1 THEN (CASE WHEN {_sd()} > 0 THEN avg(profit_pct) / {_sd()} ELSE 0.0 END) END AS sharpe_ratio,
  max(max_consecutive_wins) AS max_consecutive_wins, max(max_consecutive_losses) AS max_consecutive_losses
FROM bots b LEFT JOIN longest g ON g.bot_id = b.bot_id AND g.strategy = b.strategy GROUP BY b.bot_id, b.strategy"""
Q["bots_var"] = _BOTS + """
, losers AS (
  SELECT bot_id, profit_pct, row_number() OVER (PARTITION BY bot_id ORDER BY profit_pct) AS rn, count(*) OVER (PARTITION BY bot_id) AS n
  FROM bots WHERE profit_pct < 0
)
SELECT bot_id, max(profit_pct) AS var_95_pct FROM losers WHERE rn = CAST(floor(n * 0.05) AS BIGINT) + 1 GROUP BY bot_id"""
Q["src_normalize_trades"] = """
SELECT trade_id, pair, base_currency, quote_currency, is_open, strategy, profit_ratio * 100.0 AS profit_pct, profit_abs, profit_ratio,
  date_sub('minute', open_date, close_date) AS trade_duration, exit_reason, stop_loss_pct, stake_amount, open_date, close_date
FROM trades"""

# ----------------------------------------------------------------- sub-builders
def _sub():
    from tradescope.plans import catalog as C

    out = {}
    spec = {
        "build_risk_overall": ("risk_metrics", "metric_type", "overall"),
        "build_risk_by_pair": ("risk_metrics", "metric_type", "by_pair"),
        "build_risk_by_strategy": ("risk_metrics", "metric_type", "by_strategy"),
        "build_strategy_core": ("strategy_performance", None, None),
        "build_strategy_consistency": ("strategy_performance", None, None),
        "build_strategy_sharpe": ("strategy_performance", None, None),
        "build_strategy_sortino": ("strategy_performance", None, None),
        "build_strategy_calmar": ("strategy_performance", None, None),
        "build_timing_overall": ("timing_analysis", "time_category", "overall"),
        "build_timing_hourly": ("timing_analysis", "time_category", "hourly"),
        "build_timing_daily": ("timing_analysis", "time_category", "daily"),
        "build_timing_monthly": ("timing_analysis", "time_category", "monthly"),
        "build_pair_core": ("pair_analytics", None, None),
        "build_pair_sharpe": ("pair_analytics", None, None),
        "build_sl_overall": ("stop_loss_analytics", "analysis_type", "overall"),
        "build_sl_by_pair": ("stop_loss_analytics", "analysis_type", "by_pair"),
        "build_sl_by_strategy": ("stop_loss_analytics", "analysis_type", "by_strategy"),
        "build_sl_optimal": ("stop_loss_analytics", None, None),
        "build_sl_max_prevented": ("stop_loss_analytics", None, None),
        "build_duration_based": ("duration_patterns", "pattern_type", "duration_based"),
        "build_duration_by_pair": ("duration_patterns", "pattern_type", "by_pair"),
        "build_duration_by_strategy": ("duration_patterns", "pattern_type", "by_strategy"),
    }
    import inspect

    for name, (table, col, val) in spec.items():
        cols = inspect.getclosurevars(C.SUB_BUILDERS[name]).nonlocals["cols"]
        where = f" WHERE {col} = '{val}'" if col else ""
        out[name] = f"SELECT {', '.join(cols)} FROM {table}{where}"
    return out


Q.update(_sub())
Q["build_strategy_streaks"] = "SELECT k AS strategy_name, max_consecutive_wins, max_consecutive_losses FROM strategy_streaks"
Q["build_pair_streaks"] = "SELECT k AS pair, max_consecutive_wins, max_consecutive_losses FROM pair_streaks"
Q["build_risk_var"] = "SELECT metric_type, entity_name, var_95_pct FROM risk_metrics WHERE metric_type = 'var_analysis'"


def _of_bots(body: str) -> str:
    """The query over each of two bots' trades; the second has a third of them, numbered anew."""
    from oracle.prelude import TRADES, with_prelude

    second = f"(WITH {TRADES.strip()} SELECT * REPLACE (trade_id // 3 AS trade_id) FROM trades WHERE trade_id % 3 = 0)"
    return f"SELECT 'bot_a' AS bot_id, a.* FROM ({with_prelude(body)}) a UNION ALL SELECT 'bot_b', b.* FROM ({with_prelude(body, second)}) b"


for _table in ("performance_rankings", "risk_metrics", "strategy_performance", "timing_analysis", "pair_analytics", "stop_loss_analytics", "duration_patterns"):
    Q[f"bots_{_table}"] = _of_bots(Q[f"build_{_table}"])
Q["bots_bot_health_metrics"] = _of_bots(Q["build_bot_health"])
