"""Shared trade measures as ``Column`` builders (aggregate expressions).

Null rule of the reference, kept everywhere: a NULL ``profit_pct`` row counts
in ``COUNT(*)`` and as "not a win" in the win rate, but in neither the winning
nor the losing count nor in any AVG/MIN/MAX of profit.

All literals are doubles (``F.lit(1.0)``): a SQL-text ``1.0`` would be typed
DECIMAL by Spark and silently truncate averages.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

P = "profit_pct"
A = "profit_abs"
# Python floats become double literals when combined with a Column.
ZERO = 0.0
ONE = 1.0
HUNDRED = 100.0


def col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def n_rows() -> Column:
    return F.count(F.lit(1))


def is_win(p: Column | str = P) -> Column:
    return col(p) > 0


def win_flag(p: Column | str = P) -> Column:
    return F.when(is_win(p), ONE).otherwise(ZERO)


def win_rate(p: Column | str = P) -> Column:
    """m_win_rate: mean of 1.0/0.0 over all rows (NULL profit -> 0.0)."""
    return F.avg(win_flag(p))


def count_when(cond: Column) -> Column:
    """``SUM(CASE WHEN cond THEN 1 ELSE 0 END)``: 0 for none, NULL over empty input."""
    return F.sum(F.when(cond, F.lit(1)).otherwise(F.lit(0)))


def pop_variance(p: Column | str = P) -> Column:
    """``E[x^2] - E[x]^2`` over non-null values, exactly as the reference writes it."""
    x = col(p)
    return F.avg(x * x) - F.avg(x) * F.avg(x)


def pop_std(p: Column | str = P) -> Column:
    """``SQRT(E[x^2]-E[x]^2)``; a negative difference (cancellation) gives NULL, like SQLite."""
    v = pop_variance(p)
    return F.sqrt(F.when(v >= 0, v))


def avg_win_or_zero(p: Column | str = P) -> Column:
    return F.avg(F.when(col(p) > 0, col(p)).otherwise(ZERO))


def avg_loss_or_zero(p: Column | str = P) -> Column:
    return F.avg(F.when(col(p) < 0, F.abs(col(p))).otherwise(ZERO))


def is_sl_exit() -> Column:
    return F.col("exit_reason") == "stop_loss"


def sl_triggered() -> Column:
    """m_sl_triggered (``SUM(CASE ...)``: NULL over empty input)."""
    return count_when(is_sl_exit())


def profit_per_hour(avg_profit: Column, avg_duration: Column) -> Column:
    """m_profit_per_hour with the reference's zero guard."""
    return F.when(avg_duration > 0, avg_profit / (avg_duration / F.lit(60.0))).otherwise(ZERO)


def hour_of(ts: Column | str = "open_date") -> Column:
    return F.hour(col(ts))


def dow_of(ts: Column | str = "open_date") -> Column:
    """Day of week with 0 = Sunday (SQLite ``%w``)."""
    return F.dayofweek(col(ts)) - 1


def month_of(ts: Column | str = "open_date") -> Column:
    return F.month(col(ts))


def status(value: Column, healthy, warning, higher_is_better: bool = True, strict: bool = False) -> Column:
    """m_status: HEALTHY / WARNING / CRITICAL first-match bands."""
    if higher_is_better:
        op = (lambda c, v: c > v) if strict else (lambda c, v: c >= v)
    else:
        op = (lambda c, v: c < v) if strict else (lambda c, v: c <= v)
    return (
        F.when(op(value, F.lit(healthy)), F.lit("HEALTHY"))
        .when(op(value, F.lit(warning)), F.lit("WARNING"))
        .otherwise(F.lit("CRITICAL"))
    )
