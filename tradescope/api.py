"""The result tables as functions of trades: ``build_<table>(trades, variant, as_of)``.

``trades`` may hold open trades, which are left out. ``variant`` is ``"sql"`` or
``"poller"``; ``as_of`` dates the rows (without it: the time of the query). For
several tables over the same trades, ``plans.tables.Tables`` shares their statistics.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame

from tradescope.plans.tables import RESULT_TABLES, Tables


def _builder(name: str):
    def build(trades: DataFrame, variant: str = "sql", as_of: dt.datetime | None = None) -> DataFrame:
        return Tables(trades, variant=variant, as_of=as_of).table(name)

    build.__name__ = f"build_{name}"
    build.__doc__ = f"The ``{name}`` table of the closed trades, with ``analysis_date``."
    return build


__all__ = [f"build_{name}" for name in RESULT_TABLES]
globals().update({f"build_{name}": _builder(name) for name in RESULT_TABLES})
