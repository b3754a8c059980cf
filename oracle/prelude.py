"""DuckDB SQL for the oracle: the fixture ``trades`` and the eight result tables.

Written independently of the Spark code as plain SQL over the driver's
``events`` view. Three macros keep DuckDB's arithmetic identical to the
SQLite/Spark semantics (see ``expand``):

* ``ROUND(x, d)`` -> decimal rounding of the double (half away from zero on
  the shortest decimal form, as SQLite and Spark do);
* ``ISUM(x)``     -> ``CAST(SUM(x) AS BIGINT)`` (DuckDB widens integer sums);
* decimal literals (``1.0``) are DOUBLE, not DECIMAL.
"""

from __future__ import annotations

import re

from oracle import values as L
from oracle.sql import band_sql, sql_str
from oracle.values import EVENT_PROFIT_OFFSETS

_NUM = re.compile(r"(?<![\w.])(\d+\.\d+)(?![\w.])")


def _split_args(s: str, start: int) -> tuple[list[str], int]:
    """Arguments of the call whose '(' is at ``start``; returns (args, index after ')')."""
    depth, args, cur, i = 0, [], [], start
    in_str = False
    while i < len(s):
        ch = s[i]
        if in_str:
            cur.append(ch)
            if ch == "'":
                in_str = False
        elif ch == "'":
            in_str = True
            cur.append(ch)
        elif ch == "(":
            depth += 1
            if depth > 1:
                cur.append(ch)
        elif ch == ")":
            depth -= 1
            if depth == 0:
                args.append("".join(cur).strip())
                return args, i + 1
            cur.append(ch)
        elif ch == "," and depth == 1:
            args.append("".join(cur).strip())
            cur = []
        else:
            cur.append(ch)
        i += 1
    raise ValueError("unbalanced parentheses")


def _macro(sql: str, name: str, render) -> str:
    pat = re.compile(rf"\b{name}\(")
    while True:
        mt = pat.search(sql)
        if not mt:
            return sql
        args, end = _split_args(sql, mt.end() - 1)
        sql = sql[: mt.start()] + render(*args) + sql[end:]


def _doubles(sql: str) -> str:
    parts = sql.split("'")
    for i in range(0, len(parts), 2):
        parts[i] = _NUM.sub(r"CAST(\1 AS DOUBLE)", parts[i])
    return "'".join(parts)


def expand(sql: str) -> str:
    sql = _macro(sql, "ROUND", lambda x, d: f"CAST(round(CAST(({x}) AS DECIMAL(38,10)), {d}) AS DOUBLE)")
    sql = _macro(sql, "ISUM", lambda x: f"CAST(sum({x}) AS BIGINT)")
    return _doubles(sql)


def _when_chain(expr: str, mapping) -> str:
    return "CASE " + " ".join(f"WHEN {expr} = {k} THEN {sql_str(v)}" for k, v in mapping) + " END"


_OFFSETS = "CASE event_type " + " ".join(f"WHEN {sql_str(k)} THEN {v}" for k, v in EVENT_PROFIT_OFFSETS.items()) + " END"

TRADES = f"""
ev AS (
  SELECT event_id AS e, ts, event_type, value,
         CAST(json_extract(props, '$.k') AS INTEGER) AS k,
         (event_id % 20 = 19) AS is_open
  FROM events
),
ev2 AS (
  SELECT *,
    CASE WHEN NOT is_open AND e % 211 <> 0 THEN (k - {_OFFSETS} + e % 12 - 6) / 4.0 END AS profit_pct,
    floor(value * 4) / 4.0 + 1.0 AS stake_amount,
    CASE WHEN NOT is_open AND e % 97 <> 0 THEN CAST(1 + (e * 7919) % 3001 AS BIGINT) END AS trade_duration,
    ts + to_days(CAST(30 * ((e // 7) % 12) AS INTEGER)) AS open_date,
    'C' || CAST(e % 12 AS VARCHAR) AS base_currency,
    'Q' || CAST((e // 12) % 3 AS VARCHAR) AS quote_currency
  FROM ev
),
trades AS (
  SELECT e + 1 AS trade_id,
    base_currency || '/' || quote_currency AS pair, base_currency, quote_currency,
    is_open, event_type AS strategy, profit_pct,
    stake_amount * profit_pct / 128.0 AS profit_abs,
    profit_pct / 100.0 AS profit_ratio,
    trade_duration,
    CASE WHEN is_open OR e % 53 = 0 THEN NULL
         WHEN profit_pct < 0 AND k % 2 = 0 THEN 'stop_loss'
         WHEN k % 3 = 0 THEN 'roi'
         WHEN k % 3 = 1 THEN 'exit_signal'
         ELSE 'force_exit' END AS exit_reason,
    CASE WHEN e % 5 <> 0 THEN -2.0 * (1 + (31 * e + k) % 8) END AS stop_loss_pct,
    stake_amount, open_date,
    CASE WHEN NOT is_open THEN open_date + to_minutes(CAST(trade_duration AS INTEGER)) END AS close_date
  FROM ev2
),
closed AS (SELECT * FROM trades WHERE NOT is_open)
"""

WIN = "CASE WHEN profit_pct > 0 THEN 1.0 ELSE 0.0 END"


def _var(x="profit_pct"):
    return f"(avg({x} * {x}) - avg({x}) * avg({x}))"


def _sd(x="profit_pct"):
    v = _var(x)
    return f"sqrt(CASE WHEN {v} >= 0 THEN {v} END)"


def _streaks(key: str, name: str) -> str:
    """Gaps and islands per key with two row numbers (brute-force form)."""
    return f"""
{name}_rows AS (
  SELECT {key} AS k, profit_pct,
    row_number() OVER (PARTITION BY {key} ORDER BY trade_id)
      - row_number() OVER (PARTITION BY {key}, coalesce(profit_pct > 0, false) ORDER BY trade_id) AS gw,
    row_number() OVER (PARTITION BY {key} ORDER BY trade_id)
      - row_number() OVER (PARTITION BY {key}, coalesce(profit_pct <= 0, false) ORDER BY trade_id) AS gl
  FROM closed
),
{name} AS (
  SELECT k,
    (SELECT max(cnt) FROM (SELECT count(*) AS cnt FROM {name}_rows r WHERE r.k = o.k AND r.profit_pct > 0 GROUP BY gw)) AS max_consecutive_wins,
    (SELECT max(cnt) FROM (SELECT count(*) AS cnt FROM {name}_rows r WHERE r.k = o.k AND r.profit_pct <= 0 GROUP BY gl)) AS max_consecutive_losses
  FROM (SELECT DISTINCT k FROM {name}_rows) o
)"""


PERFORMANCE_RANKINGS = f"""
performance_rankings AS (
  SELECT 'by_pair' AS ranking_type, pair AS entity_name, 'trading_pair' AS entity_type,
    avg(profit_ratio) AS profit_ratio, avg(profit_pct) AS profit_pct, sum(profit_abs) AS profit_abs,
    count(*) AS trade_count, avg({WIN}) AS win_rate, avg(trade_duration) AS avg_duration_minutes,
    max(profit_pct) AS max_profit_pct, min(profit_pct) AS min_profit_pct, sum(stake_amount) AS total_volume,
    CAST(row_number() OVER (ORDER BY avg(profit_pct) DESC NULLS LAST, pair ASC NULLS FIRST) AS INTEGER) AS rank_position
  FROM closed GROUP BY pair
)"""


def _risk(thresh_pair=-10, thresh_strategy=-5):
    return f"""
risk_grains AS (
  SELECT GROUPING(pair, strategy) AS gid, pair, strategy, count(*) AS n,
    ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS trig,
    sum(CASE WHEN exit_reason = 'stop_loss' AND profit_abs < 0 THEN abs(profit_abs) ELSE 0.0 END) AS lost_sl,
    sum(CASE WHEN profit_abs < 0 THEN abs(profit_abs) ELSE 0.0 END) AS lost,
    ISUM(CASE WHEN exit_reason = 'stop_loss' AND profit_pct > {thresh_pair} THEN 1 ELSE 0 END) AS kept_p,
    ISUM(CASE WHEN exit_reason = 'stop_loss' AND profit_pct > {thresh_strategy} THEN 1 ELSE 0 END) AS kept_s,
    min(profit_pct) AS min_p,
    CASE WHEN count(*) > 1 THEN {_sd()} ELSE 0.0 END AS vol,
    avg(CASE WHEN profit_pct > 0 THEN profit_pct ELSE 0.0 END) AS aw,
    avg(CASE WHEN profit_pct < 0 THEN abs(profit_pct) ELSE 0.0 END) AS al
  FROM closed GROUP BY GROUPING SETS ((), (pair), (strategy))
),
risk_losers AS (
  SELECT profit_pct, row_number() OVER (ORDER BY profit_pct) AS rn FROM closed WHERE profit_pct < 0
),
risk_metrics AS (
  SELECT CASE gid WHEN 3 THEN 'overall' WHEN 1 THEN 'by_pair' ELSE 'by_strategy' END AS metric_type,
    CASE gid WHEN 1 THEN pair WHEN 2 THEN strategy END AS entity_name,
    trig AS stop_loss_triggered_count,
    CASE WHEN trig > 0 THEN
      CASE gid WHEN 3 THEN lost_sl / NULLIF(lost, 0.0) * 100.0
               WHEN 1 THEN kept_p * 100.0 / trig
               ELSE kept_s * 100.0 / trig END
    ELSE 0.0 END AS stop_loss_effectiveness_pct,
    CASE WHEN gid = 3 THEN 0.0 END AS sharpe_ratio,
    min_p AS max_drawdown_pct,
    CASE WHEN gid <> 3 THEN vol END AS volatility_pct,
    CAST(NULL AS DOUBLE) AS var_95_pct,
    CASE WHEN gid <> 3 THEN (CASE WHEN al > 0 THEN aw / al ELSE 0.0 END) END AS risk_reward_ratio
  FROM risk_grains WHERE gid = 3 OR (gid = 1 AND n >= 3) OR (gid = 2 AND n >= 5)
  UNION ALL
  SELECT 'var_analysis', 'portfolio', CAST(NULL AS BIGINT), NULL, NULL, NULL, NULL,
    (SELECT max(CASE WHEN rn = (SELECT CAST(floor(count(*) * 0.05) AS BIGINT) + 1 FROM risk_losers) THEN profit_pct END) FROM risk_losers),
    NULL
)"""


STRATEGY = f"""
{_streaks('strategy', 'strategy_streaks')},
strategy_stats AS (
  SELECT strategy, count(*) AS n,
    ISUM(CASE WHEN profit_pct > 0 THEN 1 ELSE 0 END) AS wins,
    ISUM(CASE WHEN profit_pct <= 0 THEN 1 ELSE 0 END) AS losses,
    avg({WIN}) AS wr, avg(profit_pct) AS ap, sum(profit_abs) AS tp,
    sum(CASE WHEN profit_abs > 0 THEN profit_abs ELSE 0.0 END) AS gp,
    sum(CASE WHEN profit_abs < 0 THEN abs(profit_abs) ELSE 0.0 END) AS gl,
    max(profit_pct) AS best, min(profit_pct) AS worst, avg(trade_duration) AS ad,
    {_sd()} AS sd,
    sqrt(avg(CASE WHEN profit_pct < 0 THEN profit_pct * profit_pct ELSE 0.0 END)) AS dd
  FROM closed GROUP BY strategy
),
strategy_performance AS (
  SELECT s.strategy AS strategy_name, n AS total_trades, wins AS winning_trades, losses AS losing_trades,
    wr AS win_rate, ap AS avg_profit_pct, tp AS total_profit_abs,
    CASE WHEN gl > 0 THEN gp / gl ELSE 0.0 END AS profit_factor,
    ap * wr AS expectancy, best AS best_trade_pct, worst AS worst_trade_pct,
    CASE WHEN n > 1 THEN (CASE WHEN ap = 0 THEN 0.0 ELSE 1.0 - sd / abs(ap) END) ELSE 0.5 END AS consistency_score,
    ad AS avg_trade_duration_minutes,
    st.max_consecutive_wins, st.max_consecutive_losses,
    CASE WHEN n > 1 THEN (CASE WHEN sd > 0 THEN ap / sd ELSE 0.0 END) END AS sharpe_ratio,
    CASE WHEN n > 1 THEN (CASE WHEN dd > 0 THEN ap / dd ELSE 0.0 END) END AS sortino_ratio,
    CASE WHEN n > 1 THEN (CASE WHEN worst < 0 THEN ap / abs(worst) ELSE 0.0 END) END AS calmar_ratio
  FROM strategy_stats s LEFT JOIN strategy_streaks st ON st.k = s.strategy
)"""


def _period_name_case(expr):
    arms = " ".join(f"WHEN {expr} BETWEEN {lo} AND {hi} THEN {sql_str(n)}" for lo, hi, n in L.HOUR_PERIODS)
    return f"CASE {arms} END"


TIMING = f"""
timing_hours AS (
  SELECT CAST(hour(open_date) AS INTEGER) AS h, count(*) AS n, avg({WIN}) AS wr, avg(profit_pct) AS ap,
    sum(profit_abs) AS tp, avg(trade_duration) AS ad,
    CASE WHEN count(*) > 1 THEN {_sd()} ELSE 0.0 END AS vol
  FROM closed WHERE open_date IS NOT NULL GROUP BY 1
),
timing_analysis AS (
  SELECT 'overall' AS time_category, count(*) AS trade_count, avg({WIN}) AS win_rate, avg(profit_pct) AS avg_profit_pct,
    sum(profit_abs) AS total_profit_abs,
    (SELECT h FROM timing_hours ORDER BY ap DESC NULLS LAST, h LIMIT 1) AS best_performance_hour,
    (SELECT h FROM timing_hours ORDER BY ap ASC NULLS FIRST, h LIMIT 1) AS worst_performance_hour,
    avg(CASE WHEN open_date IS NOT NULL AND dayofweek(open_date) IN (0, 6) THEN profit_pct END) AS weekend_performance_pct,
    avg(CASE WHEN open_date IS NOT NULL AND dayofweek(open_date) NOT IN (0, 6) THEN profit_pct END) AS weekday_performance_pct,
    avg(trade_duration) AS duration_minutes_avg, CAST(NULL AS DOUBLE) AS volatility_pct,
    CAST(NULL AS INTEGER) AS hour_of_day, CAST(NULL AS INTEGER) AS day_of_week, CAST(NULL AS INTEGER) AS day_of_month,
    CAST(NULL AS INTEGER) AS month_of_year, CAST(NULL AS VARCHAR) AS time_period_name
  FROM closed
  UNION ALL
  SELECT 'hourly', n, wr, ap, tp, NULL, NULL, NULL, NULL, ad, vol, h, NULL, NULL, NULL, {_period_name_case('h')}
  FROM timing_hours
  UNION ALL
  SELECT 'daily', count(*), avg({WIN}), avg(profit_pct), sum(profit_abs), NULL, NULL, NULL, NULL, avg(trade_duration), NULL,
    NULL, CAST(dayofweek(open_date) AS INTEGER), NULL, NULL,
    {_when_chain('dayofweek(open_date)', list(enumerate(L.DAY_NAMES)))}
  FROM closed WHERE open_date IS NOT NULL GROUP BY dayofweek(open_date)
  UNION ALL
  SELECT 'monthly', count(*), avg({WIN}), avg(profit_pct), sum(profit_abs), NULL, NULL, NULL, NULL, avg(trade_duration), NULL,
    NULL, NULL, NULL, CAST(month(open_date) AS INTEGER),
    {_when_chain('month(open_date)', [(i + 1, n) for i, n in enumerate(L.MONTH_NAMES)])}
  FROM closed WHERE open_date IS NOT NULL GROUP BY month(open_date) HAVING count(*) >= 2
)"""


PAIRS = f"""
{_streaks('pair', 'pair_streaks')},
pair_analytics AS (
  SELECT a.*, st.max_consecutive_wins, st.max_consecutive_losses FROM (
    SELECT pair, base_currency, quote_currency, count(*) AS total_trades,
      ISUM(CASE WHEN profit_pct > 0 THEN 1 ELSE 0 END) AS winning_trades,
      ISUM(CASE WHEN profit_pct <= 0 THEN 1 ELSE 0 END) AS losing_trades,
      avg({WIN}) AS win_rate, avg(profit_pct) AS avg_profit_pct, sum(profit_abs) AS total_profit_abs,
      avg(trade_duration) AS avg_trade_duration_minutes,
      CASE WHEN count(*) > 1 THEN {_sd()} ELSE 0.0 END AS price_volatility_pct,
      max(profit_pct) AS best_trade_pct, min(profit_pct) AS worst_trade_pct,
      sum(stake_amount) AS total_volume, avg(stake_amount) AS avg_stake_amount,
      CASE WHEN sum(CASE WHEN profit_abs < 0 THEN abs(profit_abs) ELSE 0.0 END) > 0
           THEN sum(CASE WHEN profit_abs > 0 THEN profit_abs ELSE 0.0 END) / sum(CASE WHEN profit_abs < 0 THEN abs(profit_abs) ELSE 0.0 END)
           ELSE 0.0 END AS profit_factor,
      CASE WHEN count(*) > 1 THEN (CASE WHEN {_sd()} > 0 THEN avg(profit_pct) / {_sd()} ELSE 0.0 END) END AS sharpe_ratio
    FROM closed GROUP BY pair, base_currency, quote_currency
  ) a LEFT JOIN pair_streaks st ON st.k = a.pair
)"""


STOP_LOSS = """
sl_grains AS (
  SELECT GROUPING(pair, strategy) AS gid, pair, strategy,
    avg(stop_loss_pct) AS lvl,
    count(*) FILTER (WHERE stop_loss_pct IS NOT NULL) AS n_sl,
    ISUM(CASE WHEN stop_loss_pct IS NOT NULL AND exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS trig,
    ISUM(CASE WHEN stop_loss_pct IS NOT NULL AND exit_reason = 'stop_loss' AND profit_pct > -10 THEN 1 ELSE 0 END) AS kept_p,
    ISUM(CASE WHEN stop_loss_pct IS NOT NULL AND exit_reason = 'stop_loss' AND profit_pct > -5 THEN 1 ELSE 0 END) AS kept_s,
    avg(CASE WHEN stop_loss_pct IS NOT NULL AND exit_reason = 'stop_loss' THEN profit_pct END) AS avg_trig,
    avg(CASE WHEN stop_loss_pct IS NOT NULL AND exit_reason <> 'stop_loss' THEN profit_pct END) AS avg_not,
    abs(min(CASE WHEN exit_reason = 'stop_loss' THEN profit_pct END)) AS max_loss,
    count(*) FILTER (WHERE stop_loss_pct IS NULL) AS n_nosl,
    avg(CASE WHEN stop_loss_pct IS NULL AND profit_pct < 0 THEN profit_pct END) AS avg_loss_nosl
  FROM closed GROUP BY GROUPING SETS ((), (pair), (strategy))
),
sl_level_rows AS (
  SELECT pair, ROUND(stop_loss_pct, 1) AS lvl, profit_pct FROM closed WHERE stop_loss_pct IS NOT NULL
),
sl_levels AS (
  SELECT GROUPING(pair) AS overall, pair, lvl, count(*) AS n, avg(profit_pct) AS a
  FROM sl_level_rows GROUP BY GROUPING SETS ((lvl), (pair, lvl))
),
sl_optimal AS (
  SELECT overall, pair, lvl FROM (
    SELECT *, row_number() OVER (PARTITION BY overall, pair ORDER BY a DESC NULLS LAST, lvl ASC) AS rn
    FROM sl_levels WHERE n >= 2) WHERE rn = 1
),
sl_rows AS (
  SELECT CASE gid WHEN 3 THEN 'overall' WHEN 1 THEN 'by_pair' ELSE 'by_strategy' END AS analysis_type,
    CASE WHEN gid = 1 THEN pair END AS pair,
    CASE WHEN gid = 2 THEN strategy END AS strategy,
    lvl AS stop_loss_level_pct, n_sl AS total_trades_with_sl, trig AS sl_triggered_count,
    ROUND(trig * 100.0 / NULLIF(n_sl, 0), 2) AS sl_trigger_rate_pct,
    CASE WHEN trig > 0 THEN ROUND((CASE WHEN gid = 2 THEN kept_s ELSE kept_p END) * 100.0 / trig, 2) ELSE 0.0 END AS sl_effectiveness_pct,
    avg_trig AS avg_loss_when_triggered_pct, avg_not AS avg_profit_when_not_triggered_pct,
    max_loss AS max_loss_prevented_pct,
    CASE WHEN gid = 3 THEN n_nosl END AS trades_without_sl,
    CASE WHEN gid = 3 THEN avg_loss_nosl END AS avg_loss_without_sl_pct
  FROM sl_grains WHERE gid = 3 OR (gid = 1 AND n_sl >= 3) OR (gid = 2 AND n_sl >= 5)
),
stop_loss_analytics AS (
  SELECT r.analysis_type, r.pair, r.strategy, r.stop_loss_level_pct, r.total_trades_with_sl, r.sl_triggered_count,
    r.sl_trigger_rate_pct, r.sl_effectiveness_pct, r.avg_loss_when_triggered_pct, r.avg_profit_when_not_triggered_pct,
    r.max_loss_prevented_pct, o.lvl AS optimal_sl_level_pct, r.trades_without_sl, r.avg_loss_without_sl_pct
  FROM sl_rows r LEFT JOIN sl_optimal o
    ON (r.analysis_type = 'overall' AND o.overall = 1) OR (r.analysis_type = 'by_pair' AND o.overall = 0 AND o.pair = r.pair)
)"""


DURATION = f"""
dur_rows AS (
  SELECT *, {band_sql('trade_duration', L.DURATION_CATEGORIES, L.DURATION_CATEGORIES_ELSE)} AS duration_category
  FROM closed WHERE trade_duration IS NOT NULL
),
dur_grains AS (
  SELECT GROUPING(pair, strategy, duration_category) AS gid, pair, strategy, duration_category,
    CAST(min(trade_duration) AS DOUBLE) AS min_duration_minutes, CAST(max(trade_duration) AS DOUBLE) AS max_duration_minutes,
    count(*) AS trade_count, avg({WIN}) AS win_rate, avg(profit_pct) AS avg_profit_pct, sum(profit_abs) AS total_profit_abs,
    avg(trade_duration) AS optimal_exit_timing_minutes,
    CASE WHEN avg(trade_duration) > 0 THEN avg(profit_pct) / (avg(trade_duration) / 60.0) ELSE 0.0 END AS profit_per_hour
  FROM dur_rows GROUP BY GROUPING SETS ((duration_category), (pair, duration_category), (strategy, duration_category))
),
duration_patterns AS (
  SELECT CASE gid WHEN 6 THEN 'duration_based' WHEN 2 THEN 'by_pair' ELSE 'by_strategy' END AS pattern_type,
    duration_category, min_duration_minutes, max_duration_minutes, trade_count, win_rate, avg_profit_pct,
    total_profit_abs, optimal_exit_timing_minutes, profit_per_hour,
    CASE WHEN gid = 2 THEN pair END AS pair, CASE WHEN gid = 4 THEN strategy END AS strategy
  FROM dur_grains WHERE gid = 6 OR (gid = 2 AND trade_count >= 2) OR (gid = 4 AND trade_count >= 3)
)"""


def _health_rows() -> str:
    values = {
        "overall_win_rate": "win_rate * 100",
        "average_profit_pct": "avg_profit_pct",
        "total_trades": "CAST(total_trades AS DOUBLE)",
        "total_profit_abs": "total_profit",
        "worst_loss_control": "worst_loss",
        "best_win_achievement": "best_win",
        "portfolio_diversification": "CAST(pairs_traded AS DOUBLE)",
        "strategy_utilization": "CAST(strategies_used AS DOUBLE)",
        "trade_duration_efficiency": "avg_duration_minutes",
        "stop_loss_utilization_rate": "sl_triggered * 100.0 / NULLIF(total_trades, 0)",
        "trading_activity": "CASE WHEN span > 0 THEN active_days * 100.0 / span ELSE 0.0 END",
    }
    # Status is judged on the raw statistic (the win rate as a fraction).
    judged = {**values, "overall_win_rate": "win_rate"}
    rows = []
    for name, unit, hb, h, w, tw, tc, desc, rec in L.HEALTH_METRICS:
        v = values[name]
        j = judged[name]
        if name == "best_win_achievement":
            st = sql_str(L.HEALTHY)
        elif name == "trading_activity":
            a = "active_days * 100.0 / span"
            st = f"CASE WHEN span > 0 AND {a} >= {h} THEN 'HEALTHY' WHEN span > 0 AND {a} >= {w} THEN 'WARNING' ELSE 'CRITICAL' END"
        elif name == "worst_loss_control":
            st = f"CASE WHEN {j} > {h} THEN 'HEALTHY' WHEN {j} > {w} THEN 'WARNING' ELSE 'CRITICAL' END"
        else:
            op = ">=" if hb else "<="
            st = f"CASE WHEN {j} {op} {h} THEN 'HEALTHY' WHEN {j} {op} {w} THEN 'WARNING' ELSE 'CRITICAL' END"
        rows.append(
            f"SELECT {sql_str(name)} AS metric_name, CAST({v} AS DOUBLE) AS metric_value, {sql_str(unit)} AS metric_unit, "
            f"{st} AS health_status, CAST({tw!r} AS DOUBLE) AS threshold_warning, CAST({tc!r} AS DOUBLE) AS threshold_critical, "
            f"{sql_str(desc)} AS metric_description, {sql_str(rec)} AS recommendation FROM health_stats"
        )
    return "\n  UNION ALL\n  ".join(rows)


HEALTH = f"""
health_stats AS (
  SELECT count(*) AS total_trades, avg({WIN}) AS win_rate, avg(profit_pct) AS avg_profit_pct,
    sum(profit_abs) AS total_profit, min(profit_pct) AS worst_loss, max(profit_pct) AS best_win,
    count(DISTINCT pair) AS pairs_traded, count(DISTINCT strategy) AS strategies_used,
    avg(trade_duration) AS avg_duration_minutes,
    ISUM(CASE WHEN exit_reason = 'stop_loss' THEN 1 ELSE 0 END) AS sl_triggered,
    count(DISTINCT CAST(open_date AS DATE)) AS active_days,
    (epoch_us(max(open_date)) - epoch_us(min(open_date))) / 86400000000.0 AS span
  FROM closed
),
bot_health_metrics AS (
  {_health_rows()}
)"""


def poller_ctes() -> str:
    """Result tables under the poller's inline rules."""
    return f"""
poll_timing_hours AS (
  SELECT CAST(hour(open_date) AS INTEGER) AS h, avg(profit_pct) AS ap FROM closed WHERE open_date IS NOT NULL GROUP BY 1
),
poll_timing AS (
  SELECT 'overall' AS time_category, count(*) AS trade_count, avg({WIN}) AS win_rate, avg(profit_pct) AS avg_profit_pct,
    sum(profit_abs) AS total_profit_abs,
    coalesce((SELECT h FROM poll_timing_hours ORDER BY ap DESC NULLS LAST, h LIMIT 1), 0) AS best_performance_hour,
    coalesce((SELECT h FROM poll_timing_hours ORDER BY ap ASC NULLS FIRST, h LIMIT 1), 0) AS worst_performance_hour,
    coalesce(avg(CASE WHEN open_date IS NOT NULL AND dayofweek(open_date) IN (0, 6) THEN profit_pct END), 0.0) AS weekend_performance_pct,
    coalesce(avg(CASE WHEN open_date IS NOT NULL AND dayofweek(open_date) NOT IN (0, 6) THEN profit_pct END), 0.0) AS weekday_performance_pct,
    avg(trade_duration) AS duration_minutes_avg, CAST(NULL AS DOUBLE) AS volatility_pct,
    CAST(NULL AS INTEGER) AS hour_of_day, CAST(NULL AS INTEGER) AS day_of_week, CAST(NULL AS INTEGER) AS day_of_month,
    CAST(NULL AS INTEGER) AS month_of_year, CAST(NULL AS VARCHAR) AS time_period_name
  FROM closed
),
poll_stats AS (
  SELECT count(*) AS n, avg({WIN}) AS wr, avg(profit_pct) AS ap, sum(profit_abs) AS tp, min(profit_pct) AS worst, max(profit_pct) AS best
  FROM closed
),
poll_health AS (
  SELECT name AS metric_name, value AS metric_value, unit AS metric_unit, st AS health_status,
    tw AS threshold_warning, tc AS threshold_critical,
    CAST(NULL AS VARCHAR) AS metric_description, CAST(NULL AS VARCHAR) AS recommendation
  FROM (
    SELECT *, CASE WHEN wr >= 0.7 AND ap >= 0.5 THEN 'HEALTHY' WHEN wr >= 0.5 AND ap >= 0 THEN 'WARNING' ELSE 'CRITICAL' END AS shared
    FROM poll_stats WHERE n > 0
  ) s,
  LATERAL (VALUES
    ('overall_win_rate', wr * 100, '%', shared, 60.0, 40.0),
    ('avg_profit_pct', ap, '%', shared, 0.5, 0.0),
    ('total_trades', CAST(n AS DOUBLE), 'count', 'HEALTHY', NULL, NULL),
    ('total_profit', tp, 'abs', shared, NULL, NULL),
    ('worst_loss', worst, '%', CASE WHEN worst > -20 THEN 'HEALTHY' ELSE 'WARNING' END, -10.0, -20.0),
    ('best_win', best, '%', 'HEALTHY', NULL, NULL)
  ) v(name, value, unit, st, tw, tc)
)"""


#: The date of every result row of the registered queries.
AS_OF = "TIMESTAMP '2024-07-01 12:00:00'"
DATED = [
    "performance_rankings", "risk_metrics", "strategy_performance", "timing_analysis", "pair_analytics",
    "stop_loss_analytics", "duration_patterns", "bot_health_metrics", "poll_timing", "poll_health",
]


def all_ctes() -> str:
    parts = [TRADES, PERFORMANCE_RANKINGS, _risk(), STRATEGY, TIMING, PAIRS, STOP_LOSS, DURATION, HEALTH, poller_ctes()]
    sql = ",".join(p.strip("\n") for p in parts)
    for name in DATED:
        sql = re.sub(rf"\b{name} AS \(", f"{name}_rows AS (", sql)
        calculated = f"{AS_OF} AS last_calculation, " if "health" in name else ""
        sql += f",\n{name} AS (SELECT *, {calculated}{AS_OF} AS analysis_date FROM {name}_rows)"
    return sql


def with_prelude(body: str, trades: str | None = None) -> str:
    """The whole query; ``trades`` names a table to read instead of the fixture trades."""
    ctes = all_ctes()
    if trades is not None:
        given = f"trades AS (SELECT * FROM {trades}),\nclosed AS (SELECT * FROM trades WHERE NOT is_open)"
        ctes = ctes.replace(TRADES.strip("\n"), given)
    return expand("WITH " + ctes + "\n" + body)
