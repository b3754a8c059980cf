"""Fixed values that the oracle's SQL is written with: thresholds, labels and names.

Written out here on their own, so that a changed threshold or label in the
library shows as a difference. Listed plainly, in the order in which they are
tried (first match wins); a band is ``(op, threshold, label)``.
"""

from __future__ import annotations

# ---------------------------------------------------------------- fixed values
# Performance / win-rate bands shared by rankings and strategies.
PROFIT_BANDS = [(">=", 2.0, "Excellent (≥2%)"), (">=", 1.0, "Good (1-2%)"), (">=", 0.0, "Break-even (0-1%)")]
PROFIT_BANDS_ELSE = "Losing (<0%)"

WINRATE_BANDS = [
    (">=", 0.8, "High Win Rate (≥80%)"),
    (">=", 0.6, "Good Win Rate (60-80%)"),
    (">=", 0.4, "Average Win Rate (40-60%)"),
]
WINRATE_BANDS_ELSE = "Low Win Rate (<40%)"

PAIR_WINRATE_BANDS = [
    (">=", 0.8, "Excellent Win Rate (≥80%)"),
    (">=", 0.6, "Good Win Rate (60-80%)"),
    (">=", 0.4, "Average Win Rate (40-60%)"),
]
PAIR_WINRATE_BANDS_ELSE = "Poor Win Rate (<40%)"

CONSISTENCY_BANDS = [
    (">=", 0.8, "Very Consistent (≥80%)"),
    (">=", 0.6, "Consistent (60-80%)"),
    (">=", 0.4, "Moderately Consistent (40-60%)"),
]
CONSISTENCY_BANDS_ELSE = "Inconsistent (<40%)"

STRATEGY_DURATION_BANDS = [("<=", 60, "Scalp (≤1h)"), ("<=", 480, "Short (1-8h)"), ("<=", 1440, "Day (8-24h)")]
STRATEGY_DURATION_BANDS_ELSE = "Swing (>24h)"

STRATEGY_RATING = [
    # (min avg profit, min win rate or None, label)
    (1.5, 0.7, "Star Performer"),
    (1.0, 0.6, "Solid Performer"),
    (0.5, None, "Moderate Performer"),
    (0.0, None, "Break-even"),
]
PAIR_RATING = [
    # (min avg profit, min sharpe or None, label)
    (1.5, 0.5, "Star Performer"),
    (1.0, 0.3, "Solid Performer"),
    (0.5, None, "Moderate Performer"),
    (0.0, None, "Break-even"),
]
RATING_ELSE = "Underperformer"

# Risk.
SL_EFFECTIVENESS_BANDS = [
    (">=", 80, "Excellent (≥80%)"),
    (">=", 60, "Good (60-80%)"),
    (">=", 40, "Average (40-60%)"),
    (">", 0, "Poor (<40%)"),
]
RISK_SL_EFFECTIVENESS_ELSE = "No Stop-Losses"
SL_EFFECTIVENESS_ELSE = "No Stop-Loss Triggers"

VOLATILITY_BANDS = [
    (">=", 5, "High Volatility (≥5%)"),
    (">=", 3, "Medium Volatility (3-5%)"),
    (">=", 1, "Low Volatility (1-3%)"),
]
VOLATILITY_BANDS_ELSE = "Very Low Volatility (<1%)"

# Timing.
HOUR_PERIODS = [(0, 5, "Early Morning (0-5)"), (6, 11, "Morning (6-11)"), (12, 17, "Afternoon (12-17)"), (18, 23, "Evening (18-23)")]
DAY_NAMES = ["Sunday", "Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday"]
MONTH_NAMES = [
    "January", "February", "March", "April", "May", "June",
    "July", "August", "September", "October", "November", "December",
]
WEEKEND_DAYS = (0, 6)
HOUR_RATING = [(">=", 1.5, "Excellent Hour"), (">=", 1.0, "Good Hour"), (">=", 0.5, "Average Hour"), (">=", 0.0, "Break-even Hour")]
HOUR_RATING_ELSE = "Poor Hour"
MARKET_SESSIONS = [
    ((13, 14, 15, 16, 17, 18, 19, 20), "US Market Hours (13-20 UTC)"),
    ((8, 9, 10, 11, 12, 13, 14, 15), "EU Market Hours (8-15 UTC)"),
    ((0, 1, 2, 3, 4, 5, 6, 7), "Asia Market Hours (0-7 UTC)"),
]
MARKET_SESSIONS_ELSE = "Off Market Hours"

# Pairs.
FREQUENCY_BANDS = [
    (">=", 20, "High Frequency (≥20 trades)"),
    (">=", 10, "Medium Frequency (10-19 trades)"),
    (">=", 5, "Low Frequency (5-9 trades)"),
]
FREQUENCY_BANDS_ELSE = "Very Low Frequency (<5 trades)"

# Stop loss.
SL_TRIGGER_BANDS = [
    (">=", 30, "High Trigger Rate (≥30%)"),
    (">=", 15, "Medium Trigger Rate (15-30%)"),
    (">=", 5, "Low Trigger Rate (5-15%)"),
]
SL_TRIGGER_BANDS_ELSE = "Very Low Trigger Rate (<5%)"
SL_LEVEL_BANDS = [("<=", -10, "Very Tight (≤-10%)"), ("<=", -5, "Tight (-5% to -10%)"), ("<=", -2, "Moderate (-2% to -5%)")]
SL_LEVEL_BANDS_ELSE = "Loose (>-2%)"
SL_RAW_LEVEL_BANDS = [
    ("<=", -15, "Very Tight (≤-15%)"),
    ("<=", -10, "Tight (-10% to -15%)"),
    ("<=", -5, "Moderate (-5% to -10%)"),
    ("<=", -2, "Loose (-2% to -5%)"),
]
SL_RAW_LEVEL_BANDS_ELSE = "Very Loose (>-2%)"
SL_ASSESSMENT = ["Needs Improvement", "Too Aggressive", "Too Loose", "Acceptable"]
WITH_SL = "With Stop Loss"
WITHOUT_SL = "Without Stop Loss"

# Duration.
DURATION_CATEGORIES = [("<=", 60, "scalp"), ("<=", 480, "short_term"), ("<=", 1440, "day_trade")]
DURATION_CATEGORIES_ELSE = "swing_trade"
EFFICIENCY_BANDS = [(">=", 1.0, "Highly Efficient"), (">=", 0.5, "Moderately Efficient"), (">=", 0.1, "Low Efficiency")]
EFFICIENCY_BANDS_ELSE = "Inefficient"
DURATION_RATING = [
    # (min win rate, min avg profit or None, label)
    (0.7, 1.0, "High Performance"),
    (0.6, 0.5, "Good Performance"),
    (0.5, None, "Average Performance"),
]
DURATION_RATING_ELSE = "Below Average"
TIMING_RANGES = [
    ("<=", 30, "Ultra Short (≤30min)"),
    ("<=", 120, "Short (30min-2h)"),
    ("<=", 480, "Medium (2h-8h)"),
    ("<=", 1440, "Long (8h-1d)"),
]
TIMING_RANGES_ELSE = "Very Long (>1d)"
DURATION_WINDOWS = [("<=", 60, "0-1 hours"), ("<=", 240, "1-4 hours"), ("<=", 720, "4-12 hours"), ("<=", 1440, "12-24 hours")]
DURATION_WINDOWS_ELSE = "1+ days"

# Health.
HEALTHY, WARNING, CRITICAL = "HEALTHY", "WARNING", "CRITICAL"
STATUS_ORDER = [CRITICAL, WARNING, HEALTHY]
PRIORITY = {CRITICAL: "Immediate Action Required", WARNING: "Monitoring Recommended"}
PRIORITY_ELSE = "No Action Needed"
HEALTH_SCORE_BANDS = [(">=", 80, "EXCELLENT"), (">=", 70, "GOOD"), (">=", 60, "ACCEPTABLE")]
HEALTH_SCORE_ELSE = "NEEDS_ATTENTION"
RISK_HEALTH = ["EXCELLENT", "ACCEPTABLE", "NEEDS_IMPROVEMENT"]
EFFICIENCY_HEALTH = ["HIGHLY_EFFICIENT", "MODERATELY_EFFICIENT", "LOW_EFFICIENCY"]
PROFITABILITY = ["PROFITABLE", "BREAK_EVEN", "UNPROFITABLE"]
TREND = ["IMPROVING", "STABLE", "DECLINING"]
DIVERSIFICATION = ["WELL_DIVERSIFIED", "MODERATELY_DIVERSIFIED", "LOW_DIVERSIFICATION"]

# The eleven health metrics of the SQL build, in the reference's order:
# (name, unit, higher_is_better, healthy_bound, warning_bound,
#  threshold_warning, threshold_critical, description, recommendation)
HEALTH_METRICS = [
    ("overall_win_rate", "%", True, 0.6, 0.4, 60.0, 40.0,
     "Percentage of profitable trades", "Review strategy performance if below 60%"),
    ("average_profit_pct", "%", True, 0.5, 0.0, 0.5, 0.0,
     "Average profit percentage per trade", "Optimize strategies if below 0.5%"),
    ("total_trades", "count", True, 50, 10, 50.0, 10.0,
     "Total number of completed trades", "Increase trading frequency if below threshold"),
    ("total_profit_abs", "abs", True, 100, 0, 100.0, 0.0,
     "Total absolute profit generated", "Review strategy allocation if unprofitable"),
    ("worst_loss_control", "%", None, -10, -20, -10.0, -20.0,
     "Largest single trade loss percentage", "Review risk management if losses exceed -10%"),
    ("best_win_achievement", "%", None, None, None, 5.0, 2.0,
     "Largest single trade profit percentage", "Excellent profit capture capability"),
    ("portfolio_diversification", "count", True, 5, 3, 5.0, 3.0,
     "Number of different trading pairs used", "Increase diversification if below 5 pairs"),
    ("strategy_utilization", "count", True, 3, 2, 3.0, 2.0,
     "Number of different strategies deployed", "Consider multi-strategy approach for better risk distribution"),
    ("trade_duration_efficiency", "minutes", False, 480, 1440, 480.0, 1440.0,
     "Average trade duration in minutes", "Consider faster exit strategies if duration exceeds 8 hours"),
    ("stop_loss_utilization_rate", "%", False, 20, 40, 20.0, 40.0,
     "Percentage of trades exited via stop loss", "Review stop loss levels if trigger rate exceeds 20%"),
    ("trading_activity", "%", True, 50, 25, 50.0, 25.0,
     "Percentage of days with trading activity", "Increase trading consistency if below 50%"),
]

# Poller variant of the health table: six metrics with one shared status.

# Literal report captions.
CAPTIONS = {
    "pr_quality": "Data Quality Check",
    "rm_quality": "Risk Metrics Quality Check",
    "sp_quality": "Strategy Performance Quality Check",
    "ta_quality": "Timing Analysis Quality Check",
    "pa_quality": "Pair Analytics Quality Check",
    "sl_quality": "Stop Loss Analytics Quality Check",
    "dp_quality": "Duration Patterns Quality Check",
    "bh_quality": "Bot Health Metrics Quality Check",
    "rm_direct_summary": "Portfolio Risk Summary",
    "sp_head_to_head": "Strategy Comparison",
    "pa_head_to_head": "Pair Comparison",
    "ta_direct_hours": "Timing Summary",
    "sl_direct_overview": "Stop Loss Overview",
    "dp_efficiency_rank": "Duration Efficiency Analysis",
    "bh_summary": "Bot Health Summary",
    "bh_risk_assessment": "Risk Management Health",
    "bh_efficiency": "Performance Efficiency",
    "bh_profitability": "Profitability Health Check",
    "bh_score": "Overall Bot Health Score",
    "bh_realtime": "Real-time Health Check",
    "bh_recent30": "Recent Performance Trend",
    "bh_utilization": "System Utilization",
    "critical_alert": "CRITICAL ALERT",
    "warning_alert": "WARNING ALERT",
}

# Profit offset of each event type in the fixture trades.
EVENT_PROFIT_OFFSETS = {"click": 30, "view": 40, "purchase": 45, "signup": 55, "error": 70}
