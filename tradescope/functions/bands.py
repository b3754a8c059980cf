"""First-match banding as a Spark ``Column``."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

_OPS = {
    ">=": lambda c, v: c >= v,
    ">": lambda c, v: c > v,
    "<=": lambda c, v: c <= v,
    "<": lambda c, v: c < v,
}


def band(col: Column | str, bands, else_label: str) -> Column:
    """``F.when`` chain: the first ``(op, threshold, label)`` that holds wins."""
    c = F.col(col) if isinstance(col, str) else col
    expr = None
    for op, threshold, label in bands:
        cond = _OPS[op](c, F.lit(threshold))
        expr = F.when(cond, F.lit(label)) if expr is None else expr.when(cond, F.lit(label))
    return expr.otherwise(F.lit(else_label))


def pick(pairs, else_value) -> Column:
    """First-match ``F.when`` over ``(condition, value)`` pairs."""
    expr = None
    for cond, value in pairs:
        v = value if isinstance(value, Column) else F.lit(value)
        expr = F.when(cond, v) if expr is None else expr.when(cond, v)
    return expr.otherwise(else_value if isinstance(else_value, Column) else F.lit(else_value))
