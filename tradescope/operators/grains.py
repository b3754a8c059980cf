"""Grain statistics: one scan, one aggregate, every result-table grain.

A full refresh needs the closed trades grouped thirteen ways (overall, pair,
pair+currencies, strategy, hour, weekday, month, open day, duration category
alone / with pair / with strategy, stop level alone / with pair). Instead of
one scan per builder, ``grain_stats`` computes all of them with a single
``GROUPING SETS`` aggregate: rows are expanded per set *inside* the scan
stage and combined by partial aggregation before the shuffle, so the fact
table is read once and the exchange carries one row per group and task.

Only mergeable statistics are kept (counts, sums, sums of squares, min,
max); builders derive averages and deviations from them with the same
arithmetic Spark's ``avg`` uses (``sum / count``), so results are
bit-identical to aggregating the trades directly.

Rows outside a grain's population (undated trades for the time grains,
no duration for the duration grains, no stop loss for the level grains) land
in the NULL group of that grain and are dropped by ``grain``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tradescope.functions import labels as L
from tradescope.functions import measures as m
from tradescope.functions.bands import band

KEYS = [
    "pair",
    "base_currency",
    "quote_currency",
    "strategy",
    "hour_of_day",
    "day_of_week",
    "month_of_year",
    "open_day",
    "duration_category",
    "level",
]

GRAINS: dict[str, list[str]] = {
    "overall": [],
    "pair": ["pair"],
    "pair_currency": ["pair", "base_currency", "quote_currency"],
    "strategy": ["strategy"],
    "hour": ["hour_of_day"],
    "dow": ["day_of_week"],
    "month": ["month_of_year"],
    "day": ["open_day"],
    "category": ["duration_category"],
    "pair_category": ["pair", "duration_category"],
    "strategy_category": ["strategy", "duration_category"],
    "level": ["level"],
    "pair_level": ["pair", "level"],
}

# Key that must be non-NULL for a row to belong to the grain's population.
POPULATION = {
    "hour": "hour_of_day",
    "dow": "day_of_week",
    "month": "month_of_year",
    "day": "open_day",
    "category": "duration_category",
    "pair_category": "duration_category",
    "strategy_category": "duration_category",
    "level": "level",
    "pair_level": "level",
}


def grain_id(name: str) -> int:
    """``grouping_id(KEYS...)`` of a grain: bit set for every key not grouped."""
    keys = set(GRAINS[name])
    gid = 0
    for k in KEYS:
        gid = (gid << 1) | (0 if k in keys else 1)
    return gid


def _keyed(closed: DataFrame) -> DataFrame:
    od = F.col("open_date")
    dated = od.isNotNull()
    d = F.col("trade_duration")
    has_sl = F.col("stop_loss_pct").isNotNull()
    return closed.select(
        "*",
        F.when(dated, m.hour_of()).alias("hour_of_day"),
        F.when(dated, m.dow_of()).alias("day_of_week"),
        F.when(dated, m.month_of()).alias("month_of_year"),
        F.to_date(od).alias("open_day"),
        F.when(d.isNotNull(), band(d, L.DURATION_CATEGORIES, L.DURATION_CATEGORIES_ELSE)).alias("duration_category"),
        F.when(has_sl, F.round("stop_loss_pct", 1)).alias("level"),
    )


def _sum_if(cond: Column, value: Column) -> Column:
    return F.sum(F.when(cond, value))


def _stats() -> list[Column]:
    p, a, d = F.col(m.P), F.col(m.A), F.col("trade_duration")
    sl_exit = m.is_sl_exit()
    has_sl = F.col("stop_loss_pct").isNotNull()
    dated = F.col("open_date").isNotNull()
    weekend = m.dow_of().isin(*L.WEEKEND_DAYS)
    cnt = m.count_when
    return [
        m.n_rows().alias("n"),
        F.sum(m.win_flag()).alias("s_win"),
        cnt(p > 0).alias("wins"),
        cnt(p <= 0).alias("losses"),
        F.sum(p).alias("s_p"),
        F.count(p).alias("n_p"),
        F.sum(p * p).alias("s_pp"),
        F.sum(F.when(p < 0, p * p).otherwise(m.ZERO)).alias("s_neg_pp"),
        F.sum(F.when(p > 0, p).otherwise(m.ZERO)).alias("s_win_p"),
        F.sum(F.when(p < 0, F.abs(p)).otherwise(m.ZERO)).alias("s_loss_p"),
        F.min(p).alias("min_p"),
        F.max(p).alias("max_p"),
        F.sum(a).alias("s_a"),
        F.sum(F.when(a > 0, a).otherwise(m.ZERO)).alias("gross_profit"),
        F.sum(F.when(a < 0, F.abs(a)).otherwise(m.ZERO)).alias("gross_loss"),
        F.sum(F.when(sl_exit & (a < 0), F.abs(a)).otherwise(m.ZERO)).alias("gross_loss_sl"),
        F.sum("profit_ratio").alias("s_ratio"),
        F.count("profit_ratio").alias("n_ratio"),
        F.sum(d).alias("s_d"),
        F.count(d).alias("n_d"),
        F.min(d).alias("min_d"),
        F.max(d).alias("max_d"),
        F.sum("stake_amount").alias("s_stake"),
        F.count("stake_amount").alias("n_stake"),
        cnt(sl_exit).alias("trig"),
        cnt(sl_exit & (p > -10)).alias("kept10"),
        cnt(sl_exit & (p > -5)).alias("kept5"),
        F.min(F.when(sl_exit, p)).alias("min_p_sl_exit"),
        # restricted to trades with a stop loss
        F.count(F.when(has_sl, 1)).alias("n_sl"),
        _sum_if(has_sl, F.col("stop_loss_pct")).alias("s_level"),
        cnt(has_sl & sl_exit).alias("trig_sl"),
        cnt(has_sl & sl_exit & (p > -10)).alias("kept10_sl"),
        cnt(has_sl & sl_exit & (p > -5)).alias("kept5_sl"),
        _sum_if(has_sl & sl_exit, p).alias("s_p_trig"),
        F.count(F.when(has_sl & sl_exit, p)).alias("n_p_trig"),
        _sum_if(has_sl & (F.col("exit_reason") != "stop_loss"), p).alias("s_p_not"),
        F.count(F.when(has_sl & (F.col("exit_reason") != "stop_loss"), p)).alias("n_p_not"),
        # trades without a stop loss
        F.count(F.when(~has_sl, 1)).alias("n_nosl"),
        _sum_if(~has_sl & (p < 0), p).alias("s_loss_nosl"),
        F.count(F.when(~has_sl & (p < 0), p)).alias("n_loss_nosl"),
        # weekend / weekday split of dated trades
        _sum_if(dated & weekend, p).alias("s_p_weekend"),
        F.count(F.when(dated & weekend, p)).alias("n_p_weekend"),
        _sum_if(dated & ~weekend, p).alias("s_p_weekday"),
        F.count(F.when(dated & ~weekend, p)).alias("n_p_weekday"),
        F.min("open_date").alias("first_open"),
        F.max("open_date").alias("last_open"),
    ]


def grain_stats(closed: DataFrame, names: list[str] | None = None, by: list[str] | None = None) -> DataFrame:
    """Statistics for the named grains (all by default) from one scan; ``by`` names columns that every grain is crossed with."""
    names, by = names or list(GRAINS), by or []
    sets = [[*by, *GRAINS[n]] for n in names]
    # Columns of every set leave the grouping id as it is without them.
    return _keyed(closed).groupingSets(sets, *by, *KEYS).agg(F.grouping_id(*by, *KEYS).alias("gid"), *_stats())


def stats_by(trades: DataFrame, keys: list[str]) -> DataFrame:
    """The statistics of closed trades grouped by any columns, e.g. by bot and pair."""
    return trades.where(~F.col("is_open")).groupBy(*keys).agg(*_stats())


def only_closed(trades: DataFrame) -> DataFrame:
    """Trades without the open ones, where the frame says which are open."""
    return trades.where(~F.col("is_open")) if "is_open" in trades.columns else trades


def stats_for(closed: DataFrame, names: list[str], stats: DataFrame | None = None) -> DataFrame:
    """Given statistics, or those of the named grains of ``closed``.

    A builder that reads several grains of one aggregate would rescan the
    trades for each, since Catalyst pushes every branch's grain filter into the
    aggregate. The statistics are small (one row per group), so a checkpoint
    pins them after a single scan. One grain stays lazy. Open trades are left
    out here, so a builder may be given all trades.
    """
    if stats is not None:
        return stats
    own = grain_stats(only_closed(closed), names)
    return own if len(names) == 1 else pin(own)


def pin(df: DataFrame) -> DataFrame:
    """Materialise a small frame once as a reliable checkpoint (shared storage).

    Later queries get a leaf plan: no re-planning of the producer, no cache
    matching against its large plan, and no lineage back to the trades.
    The checkpoint computes the frame once by itself; a cache before it would keep
    all shuffle partitions, and every reader of a few rows would run that many tasks.
    """
    from tradescope.session import ensure_checkpoint_dir

    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def grain(stats: DataFrame, name: str) -> DataFrame:
    """Rows of one grain (its population only)."""
    out = stats.where(F.col("gid") == grain_id(name))
    if name in POPULATION:
        out = out.where(F.col(POPULATION[name]).isNotNull())
    return out


# ------------------------------------------------------------ derived measures
c = F.col


def avg(s: str, n: str) -> Column:
    """``avg`` from a sum and its count (NULL when nothing was counted)."""
    return F.try_divide(c(s), c(n).cast("double"))


def win_rate() -> Column:
    return c("s_win") / c("n").cast("double")


def avg_p() -> Column:
    return avg("s_p", "n_p")


def pop_std() -> Column:
    v = avg("s_pp", "n_p") - avg_p() * avg_p()
    return F.sqrt(F.when(v >= 0, v))


def volatility() -> Column:
    return F.when(c("n") > 1, pop_std()).otherwise(m.ZERO)


def sharpe() -> Column:
    sd = pop_std()
    return F.when(sd > 0, avg_p() / sd).otherwise(m.ZERO)


def sortino() -> Column:
    dd = F.sqrt(c("s_neg_pp") / c("n").cast("double"))
    return F.when(dd > 0, avg_p() / dd).otherwise(m.ZERO)


def calmar() -> Column:
    return F.when(c("min_p") < 0, avg_p() / F.abs(c("min_p"))).otherwise(m.ZERO)


def consistency() -> Column:
    mu = avg_p()
    return F.when(mu == 0, m.ZERO).otherwise(m.ONE - pop_std() / F.abs(mu))


def multi_trade(value: Column, otherwise=None) -> Column:
    w = F.when(c("n") > 1, value)
    return w if otherwise is None else w.otherwise(otherwise)


def profit_factor() -> Column:
    return F.when(c("gross_loss") > 0, c("gross_profit") / c("gross_loss")).otherwise(m.ZERO)


def risk_reward() -> Column:
    n = c("n").cast("double")
    loss = c("s_loss_p") / n
    return F.when(loss > 0, (c("s_win_p") / n) / loss).otherwise(m.ZERO)


def sl_eff_money() -> Column:
    return F.when(c("trig") > 0, F.try_divide(c("gross_loss_sl"), F.nullif(c("gross_loss"), F.lit(m.ZERO))) * m.HUNDRED).otherwise(m.ZERO)


def sl_eff_count(kept: str, trig: str = "trig") -> Column:
    return F.when(c(trig) > 0, c(kept) * m.HUNDRED / c(trig)).otherwise(m.ZERO)


def avg_duration() -> Column:
    return avg("s_d", "n_d")


def profit_per_hour() -> Column:
    return m.profit_per_hour(avg_p(), avg_duration())


STAT_COLUMNS = [
    "n", "s_win", "wins", "losses", "s_p", "n_p", "s_pp", "s_neg_pp", "s_win_p", "s_loss_p", "min_p", "max_p", "s_a",
    "gross_profit", "gross_loss", "gross_loss_sl", "s_ratio", "n_ratio", "s_d", "n_d", "min_d", "max_d", "s_stake",
    "n_stake", "trig", "kept10", "kept5", "min_p_sl_exit", "n_sl", "s_level", "trig_sl", "kept10_sl", "kept5_sl",
    "s_p_trig", "n_p_trig", "s_p_not", "n_p_not", "n_nosl", "s_loss_nosl", "n_loss_nosl", "s_p_weekend",
    "n_p_weekend", "s_p_weekday", "n_p_weekday", "first_open", "last_open",
]
# COUNT-type statistics are 0 over no rows; SUM/MIN/MAX-type ones stay NULL.
COUNT_COLUMNS = {"n", "n_p", "n_ratio", "n_d", "n_stake", "n_sl", "n_p_trig", "n_p_not", "n_nosl", "n_loss_nosl", "n_p_weekend", "n_p_weekday"}


def overall(stats: DataFrame, *extra: Column) -> DataFrame:
    """Exactly one row: the overall grain (a scalar aggregate over the few
    stats rows, so empty input still yields the row, with COUNTs at 0)."""
    is_ov = F.col("gid") == grain_id("overall")
    cols = []
    for name in STAT_COLUMNS:
        v = F.max(F.when(is_ov, F.col(name)))
        cols.append((F.coalesce(v, F.lit(0).cast("long")) if name in COUNT_COLUMNS else v).alias(name))
    return stats.agg(*cols, *extra)


def count_groups(name: str, key: str) -> Column:
    """Number of non-NULL groups of a grain (a distinct count over the stats)."""
    return F.count(F.when((F.col("gid") == grain_id(name)) & F.col(key).isNotNull(), 1))


_MIN_COLUMNS = {"min_p", "min_d", "min_p_sl_exit", "first_open"}
_MAX_COLUMNS = {"max_p", "max_d", "last_open"}


def merge_stats(parts: DataFrame, by: list[str] | None = None) -> DataFrame:
    """Combine grain statistics computed on disjoint sets of trades (e.g. one
    per id bucket), apart for each value of ``by``: counts and sums add, minima and maxima combine."""
    aggs = []
    for name in STAT_COLUMNS:
        fn = F.min if name in _MIN_COLUMNS else F.max if name in _MAX_COLUMNS else F.sum
        aggs.append(fn(name).alias(name))
    return parts.groupBy(*(by or []), "gid", *KEYS).agg(*aggs)
