"""The eight result tables of several bots (SRC-5), with the bot as part of every key.

The trades of all bots are read together: one scan for the grain statistics, crossed
with the bot, one for the streaks, and two for all bots' VaR, whatever their number.
From there on everything is small, and each bot's tables are derived from its own
rows, so every rule (ranks, thresholds, best hours) holds within a bot.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.operators.bots import var_by_bot
from tradescope.operators.grains import grain_stats
from tradescope.operators.grains import pin as _pin
from tradescope.operators.streaks import DEFAULT_BUCKET_IDS, max_streaks_multi
from tradescope.plans.tables import GRAINS_OF, NATURAL_KEYS, RESULT_TABLES, Tables
from tradescope.sources.trades import closed as closed_filter

SEPARATOR, MISSING = "\u001f", "\u0000"
STREAK_KEYS = ["pair", "strategy"]
#: Natural keys with the bot.
BOT_KEYS = {name: ["bot_id", *keys] for name, keys in NATURAL_KEYS.items()}


class BotTables:
    """Result tables with a ``bot_id`` column; trade ids of different bots may collide.

    A trade is known by bot and id. A bot without closed trades has the same rows
    as a single bot without any has (none, mostly) only if it is named in ``bots``.
    """

    def __init__(self, trades: DataFrame, variant: str = "sql", bucket_ids: int = DEFAULT_BUCKET_IDS, as_of: dt.datetime | None = None, bots: list[str] | None = None):
        self.trades, self.variant, self.bucket_ids, self.as_of, self.bots = trades, variant, bucket_ids, as_of, bots
        self._whole: dict[str, DataFrame] = {}
        self._stats: DataFrame | None = None
        self._streaks: DataFrame | None = None
        self._var: DataFrame | None = None

    @property
    def closed(self) -> DataFrame:
        return closed_filter(self.trades)

    def streaks(self) -> DataFrame:
        """``bot_id, key_name, key_value`` and the longest runs: each key is crossed with the bot for the one scan."""
        if self._streaks is None:
            crossed = self.closed.select(
                "trade_id", "profit_pct", *[F.concat("bot_id", F.lit(SEPARATOR), F.coalesce(F.col(k), F.lit(MISSING))).alias(k) for k in STREAK_KEYS]
            )
            value = F.split_part("key_value", F.lit(SEPARATOR), F.lit(2))
            rows = max_streaks_multi(crossed, STREAK_KEYS, bucket_ids=self.bucket_ids).withColumn("bot_id", F.split_part("key_value", F.lit(SEPARATOR), F.lit(1)))
            self._streaks = _pin(rows.withColumn("key_value", F.nullif(value, F.lit(MISSING))))
        return self._streaks

    def var(self) -> DataFrame:
        if self._var is None:
            self._var = _pin(var_by_bot(self.closed))
        return self._var

    def table(self, name: str) -> DataFrame:
        """One result table of all bots: ``bot_id`` and the columns of a single bot's table."""
        if name not in self._whole:
            stats = self._stats if self._stats is not None else _pin(grain_stats(self.closed, GRAINS_OF[name], by=["bot_id"]))
            # One row per bot.
            bots = self.bots or sorted(r[0] for r in stats.select("bot_id").distinct().collect())
            out = None
            for bot in bots:
                rows = self._of(bot, name, stats).select(F.lit(bot).alias("bot_id"), "*")
                out = rows if out is None else out.unionByName(rows)
            if out is None:
                nothing = Tables(self.trades.where(F.lit(False)).drop("bot_id"), self.variant, as_of=self.as_of).table(name)
                out = nothing.where(F.lit(False)).select(F.lit(None).cast("string").alias("bot_id"), "*")
            self._whole[name] = out
        return self._whole[name]

    def _of(self, bot: str, name: str, stats: DataFrame) -> DataFrame:
        mine = F.col("bot_id") == bot
        single = Tables(self.trades.where(mine), self.variant, self.bucket_ids, self.as_of)
        single._stats = stats.where(mine).drop("bot_id")
        if self.variant == "sql":
            if name in ("strategy_performance", "pair_analytics"):
                single._streaks = self.streaks().where(mine).drop("bot_id")
            if name == "risk_metrics":
                # A bot without a losing trade keeps its row, without a value.
                found = self.var().where(mine).agg(F.max("var_95_pct").alias("var_95_pct"))
                single._var = found
        return single.table(name)

    def persist_results(self, **_) -> "BotTables":
        """Materialise the shared statistics and all result tables."""
        self._stats = _pin(grain_stats(self.closed, by=["bot_id"]))
        for name in RESULT_TABLES:
            self._whole[name] = _pin(self.table(name))
        return self

    def release(self) -> None:
        self._whole.clear()
        self._stats = self._streaks = self._var = None
