"""Lazily built result tables over one ``trades`` source.

Reports take a ``Tables`` and read the result table they need; a table is
built (as a lazy plan) the first time it is asked for. ``persist_results``
pins the small result tables once per refresh so that the ~100 reports
reuse them instead of re-running the builders.
"""

from __future__ import annotations

import datetime as dt
from functools import cached_property

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tradescope.operators.duration import build_duration_patterns
from tradescope.operators.health import build_bot_health
from tradescope.operators.pairs import build_pair_analytics
from tradescope.operators.rankings import build_performance_rankings
from tradescope.operators.risk import build_risk_grains, build_risk_metrics
from tradescope.operators.stop_loss import build_stop_loss_analytics
from tradescope.operators.strategy import build_strategy_performance
from tradescope.operators.grains import grain_stats
from tradescope.operators.grains import pin as _pin
from tradescope.operators.streaks import DEFAULT_BUCKET_IDS, max_streaks, max_streaks_multi, streaks_for
from tradescope.operators.timing import build_timing_analysis
from tradescope.sources.trades import closed as closed_filter

RESULT_TABLES = [
    "performance_rankings",
    "risk_metrics",
    "strategy_performance",
    "timing_analysis",
    "pair_analytics",
    "stop_loss_analytics",
    "duration_patterns",
    "bot_health_metrics",
]

# Natural keys (the reference's UNIQUE constraints).
NATURAL_KEYS = {
    "performance_rankings": ["ranking_type", "entity_name", "entity_type"],
    "risk_metrics": ["metric_type", "entity_name"],
    "strategy_performance": ["strategy_name"],
    "timing_analysis": ["time_category", "hour_of_day", "day_of_week", "day_of_month", "month_of_year"],
    "pair_analytics": ["pair"],
    "stop_loss_analytics": ["analysis_type", "pair", "strategy"],
    "duration_patterns": ["pattern_type", "duration_category", "pair", "strategy"],
    "bot_health_metrics": ["metric_name"],
}


# Grains that a table reads; the poller's rules need fewer for some.
GRAINS_OF = {
    "performance_rankings": ["pair"],
    "risk_metrics": ["overall", "pair", "strategy"],
    "strategy_performance": ["strategy"],
    "timing_analysis": ["overall", "hour", "dow", "month"],
    "pair_analytics": ["pair_currency"],
    "stop_loss_analytics": ["overall", "pair", "strategy", "level", "pair_level"],
    "duration_patterns": ["category", "pair_category", "strategy_category"],
    "bot_health_metrics": ["overall", "pair", "strategy", "day"],
}
POLLER_GRAINS_OF = {
    "risk_metrics": ["overall"],
    "timing_analysis": ["overall", "hour"],
    "stop_loss_analytics": ["pair"],
    "duration_patterns": ["category"],
    "bot_health_metrics": ["overall"],
}


class Tables:
    """``as_of`` is the analysis date of every result row; without it, the time of the query."""

    def __init__(self, trades: DataFrame, variant: str = "sql", bucket_ids: int = DEFAULT_BUCKET_IDS, as_of: dt.datetime | None = None):
        self.trades = trades
        self.variant = variant
        self.bucket_ids = bucket_ids
        self.as_of = as_of
        self._cached: list[DataFrame] = []
        self._lazy_stats: dict[tuple[str, ...], DataFrame] = {}
        # Shared intermediates, set by ``persist_results``: the grain
        # statistics (one scan for all builders) and the pair+strategy streaks.
        self._stats: DataFrame | None = None
        self._streaks: DataFrame | None = None
        self._losers: tuple[DataFrame, DataFrame] | None = None
        self._var: DataFrame | None = None

    @cached_property
    def closed(self) -> DataFrame:
        return closed_filter(self.trades)

    @property
    def analysis_date(self):
        return F.localtimestamp() if self.as_of is None else F.lit(self.as_of).cast("timestamp_ntz")

    def _dated(self, df: DataFrame) -> DataFrame:
        return df.withColumn("analysis_date", self.analysis_date)

    @cached_property
    def performance_rankings(self) -> DataFrame:
        return self._dated(build_performance_rankings(self.closed, self.variant, stats=self.stats("performance_rankings")))

    @cached_property
    def risk_metrics(self) -> DataFrame:
        return self._dated(build_risk_metrics(self.closed, self.variant, stats=self.stats("risk_metrics"), index=self._losers, value=self._var))

    @cached_property
    def risk_grains(self) -> DataFrame:
        """The risk table without its VaR row, which takes jobs of its own."""
        if self.variant == "poller":
            return self.risk_metrics
        return self._dated(build_risk_grains(self.closed, stats=self.stats("risk_metrics")))

    def risk_rows(self, kind: str) -> DataFrame:
        """Rows of one metric type; VaR is only computed where it is asked for."""
        whole = "risk_metrics" in self.__dict__ or kind == "var_analysis"
        return (self.risk_metrics if whole else self.risk_grains).where(F.col("metric_type") == kind)

    @cached_property
    def strategy_performance(self) -> DataFrame:
        streaks = self.streaks("strategy") if self.variant == "sql" else None
        return self._dated(build_strategy_performance(self.closed, self.variant, stats=self.stats("strategy_performance"), streaks=streaks))

    @cached_property
    def timing_analysis(self) -> DataFrame:
        return self._dated(build_timing_analysis(self.closed, self.variant, stats=self.stats("timing_analysis")))

    @cached_property
    def pair_analytics(self) -> DataFrame:
        streaks = self.streaks("pair") if self.variant == "sql" else None
        return self._dated(build_pair_analytics(self.closed, self.variant, stats=self.stats("pair_analytics"), streaks=streaks))

    @cached_property
    def stop_loss_analytics(self) -> DataFrame:
        return self._dated(build_stop_loss_analytics(self.closed, self.variant, stats=self.stats("stop_loss_analytics")))

    @cached_property
    def duration_patterns(self) -> DataFrame:
        return self._dated(build_duration_patterns(self.closed, self.variant, stats=self.stats("duration_patterns")))

    @cached_property
    def bot_health_metrics(self) -> DataFrame:
        return self._dated(build_bot_health(self.closed, self.variant, as_of=self.as_of, stats=self.stats("bot_health_metrics")))

    def stats(self, table: str) -> DataFrame:
        """Statistics of the grains that ``table`` needs: those of
        ``persist_results``, or a plan of their own. Building it runs no job; where
        several grains are read, the first action caches them after one scan."""
        if self._stats is not None:
            return self._stats
        names = (POLLER_GRAINS_OF if self.variant == "poller" else {}).get(table, GRAINS_OF[table])
        if tuple(names) not in self._lazy_stats:
            df = grain_stats(self.closed, names)
            if len(names) > 1:
                df = df.cache()
                self._cached.append(df)
            self._lazy_stats[tuple(names)] = df
        return self._lazy_stats[tuple(names)]

    def table(self, name: str) -> DataFrame:
        return getattr(self, name)

    def streaks(self, key: str) -> DataFrame:
        """Longest runs per ``key``: the pinned ones, or a plan for this key alone."""
        if self._streaks is not None:
            return streaks_for(self._streaks, key)
        return max_streaks(self.closed, key, bucket_ids=self.bucket_ids)

    def persist_results(self, stats: DataFrame | None = None, streaks: DataFrame | None = None, losers: tuple[DataFrame, DataFrame] | None = None) -> "Tables":
        """Materialise every result table once (they are small: one row per
        pair/strategy/hour/...). The fact table is scanned once for the grain
        statistics and once for both streak keys; builders then only derive
        from those small frames. Precomputed (e.g. incrementally merged)
        statistics, streaks and a rank index of the losers may be passed in instead."""
        self._losers = losers
        self._stats = _pin(stats if stats is not None else grain_stats(self.closed))
        if self.variant == "sql":
            if streaks is None:
                streaks = max_streaks_multi(self.closed, ["pair", "strategy"], bucket_ids=self.bucket_ids)
            self._streaks = _pin(streaks)
        for name in RESULT_TABLES:
            # Result tables hold one row per group: AQE merges their partitions.
            self.__dict__[name] = _pin(self.table(name))
        return self

    def release(self) -> None:
        """Drop cached statistics and forget the pinned tables. Their checkpoint
        files go when the session's cleaner meets the unreferenced frames
        (``spark.cleaner.referenceTracking.cleanCheckpoints``)."""
        for df in self._cached:
            df.unpersist()
        self._cached.clear()
        self._lazy_stats.clear()
        self._stats = self._streaks = self._losers = None
        for name in [*RESULT_TABLES, "risk_grains"]:
            self.__dict__.pop(name, None)
