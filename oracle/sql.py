"""Small pieces of SQL text."""

from __future__ import annotations


def band_sql(col: str, bands, else_label: str) -> str:
    """The same banding as a SQL ``CASE`` expression."""
    arms = " ".join(f"WHEN {col} {op} {_sql_num(t)} THEN {sql_str(label)}" for op, t, label in bands)
    return f"CASE {arms} ELSE {sql_str(else_label)} END"


def sql_str(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _sql_num(v) -> str:
    return f"CAST({v!r} AS DOUBLE)" if isinstance(v, float) else str(v)
