"""Hand-made trade rows for unit tests."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from tradescope.sources.trades import TRADES_SCHEMA

BASE = dt.datetime(2024, 1, 7, 10, 0, 0)  # a Sunday


def trade(trade_id, profit=1.0, pair="BTC/USDT", strategy="s1", **kw):
    base, quote = pair.split("/")
    row = {
        "trade_id": trade_id,
        "pair": pair,
        "base_currency": base,
        "quote_currency": quote,
        "is_open": False,
        "strategy": strategy,
        "profit_pct": profit,
        "profit_abs": None if profit is None else profit * 2,
        "profit_ratio": None if profit is None else profit / 100,
        "trade_duration": 60,
        "exit_reason": "roi",
        "stop_loss_pct": -2.0,
        "stake_amount": 100.0,
        "open_date": BASE + dt.timedelta(hours=trade_id),
        "close_date": BASE + dt.timedelta(hours=trade_id, minutes=60),
    }
    row.update(kw)
    return row


def frame(spark, rows):
    names = [f.name for f in TRADES_SCHEMA.fields]
    return spark.createDataFrame([tuple(r[n] for n in names) for r in rows], TRADES_SCHEMA)


def max_streaks_window(closed: DataFrame, key: str, profit: str = "profit_pct", order: str = "trade_id") -> DataFrame:
    """Longest runs by two row numbers per key: the brute force for the bucketed streaks."""
    p = F.col(profit)
    w_all = Window.partitionBy(key).orderBy(order)
    out = closed.select(key).distinct()
    for name, cls in (("max_consecutive_wins", p > 0), ("max_consecutive_losses", p <= 0)):
        flag = F.when(cls, F.lit(1)).otherwise(F.lit(0))
        w_cls = Window.partitionBy(F.col(key), flag).orderBy(order)
        runs = closed.select(key, profit, (F.row_number().over(w_all) - F.row_number().over(w_cls)).alias("grp")).where(cls)
        out = out.join(runs.groupBy(key, "grp").count().groupBy(key).agg(F.max("count").alias(name)), key, "left")
    return out
