"""m_streak: longest run of winning / losing trades per key, ordered by ``trade_id``.

The textbook form (``row_number`` over the key minus ``row_number`` over
key+class) needs every trade of a key in one task; with few strategies and a
hot pair that is a handful of tasks holding most of the table. Here a key's
trades are cut into buckets of consecutive ``trade_id``s:

1. Within each (key, bucket) a running count of "breaker" rows numbers the
   islands; their rows are counted and each bucket is reduced to
   ``(rows, breakers, prefix run, suffix run, best run)`` per side.
2. Across the buckets of a key (a few rows per bucket), runs that cross bucket
   edges are chained: suffix of a broken bucket + all-run buckets + prefix of
   the next broken bucket. The merge is associative, so a late trade only
   changes its own bucket.

A win is ``profit_pct > 0``; a loss ``<= 0``; a NULL profit breaks both.
Keys without any win (loss) get NULL, as the reference's ``MAX`` over no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tradescope.operators.grains import only_closed

# 2^20 consecutive trade ids per bucket: buckets stay far below a task's memory
# while the bucket-level chain per key stays small (ids / 1M rows).
DEFAULT_BUCKET_IDS = 1 << 20

_SIDES = ("w", "l")
#: Columns of a bucket's summary beside its key.
SUMMARY = ["n", "tw", "tl", *(f"{s}_{c}" for s in _SIDES for c in ("pre", "suf", "best"))]


def max_streaks(closed: DataFrame, key: str, bucket_ids: int = DEFAULT_BUCKET_IDS) -> DataFrame:
    """Return ``(key, max_consecutive_wins, max_consecutive_losses)``."""
    return streaks_for(max_streaks_multi(closed, [key], bucket_ids), key)


def max_streaks_multi(closed: DataFrame, keys: list[str], bucket_ids: int = DEFAULT_BUCKET_IDS) -> DataFrame:
    """Streaks for several keys from one scan and one shuffle of the trades.

    Trades are partitioned on the id bucket and only then exploded into one row
    per key; the windows on (key, bucket) and the bucket summaries reuse that
    partitioning. The summaries (a few numbers per key and bucket) are
    partitioned on the key for the chaining window and the final maxima.
    Returns ``(key_name, key_value, max_consecutive_wins, max_consecutive_losses)``.
    """
    return split_keys(chain_buckets(bucket_summaries(keyed_rows(closed, keys, bucket_ids))))


def split_keys(out: DataFrame) -> DataFrame:
    return out.select(F.col("k.key_name").alias("key_name"), F.col("k.key_value").alias("key_value"), "max_consecutive_wins", "max_consecutive_losses")


def streaks_for(multi: DataFrame, key: str) -> DataFrame:
    """One key's rows of ``max_streaks_multi`` output, named like ``max_streaks``."""
    return multi.where(F.col("key_name") == key).select(
        F.col("key_value").alias(key), "max_consecutive_wins", "max_consecutive_losses"
    )


def bucket_summaries(src: DataFrame) -> DataFrame:
    """Level 1 over columns (k, b, o, p): one row per (k, b) with run statistics.

    ``(n, tw, tl, w_pre, w_suf, w_best, l_pre, l_suf, l_best)``: rows, breakers
    of win runs / loss runs, and the prefix, suffix and longest run per side.
    The running window and both aggregates share the partitioning on b that
    ``keyed_rows`` made; only the running window sorts the trades.
    """
    p = F.col("p")
    rows = src.select(
        "k",
        "o",
        "b",
        F.when(p > 0, F.lit(0)).otherwise(F.lit(1)).alias("not_w"),
        F.when(p <= 0, F.lit(0)).otherwise(F.lit(1)).alias("not_l"),
        F.when(p > 0, F.lit("w")).when(p <= 0, F.lit("l")).otherwise(F.lit("n")).alias("side"),
    )
    running = Window.partitionBy("k", "b").orderBy("o").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    rows = rows.select(
        "k",
        "b",
        "side",
        F.when(F.col("side") == "w", F.sum("not_w").over(running))
        .when(F.col("side") == "l", F.sum("not_l").over(running))
        .otherwise(F.lit(-1))
        .alias("brk"),
    )
    # One row per island; the rows without a side are one island that breaks both.
    islands = rows.groupBy("k", "b", "side", "brk").agg(F.count(F.lit(1)).alias("len"))
    aggs, summary = [], []
    for s in _SIDES:
        mine = F.col("side") == s
        aggs += [
            F.sum(F.when(mine, F.lit(0)).otherwise(F.col("len"))).alias(f"t{s}"),
            F.coalesce(F.max(F.when(mine & (F.col("brk") == 0), F.col("len"))), F.lit(0)).alias(f"{s}_pre"),
            # The island after most breakers: the suffix, if those are all there are.
            F.max(F.when(mine, F.col("brk"))).alias(f"{s}_end"),
            F.max_by(F.when(mine, F.col("len")), F.when(mine, F.col("brk"))).alias(f"{s}_tail"),
            F.max(F.when(mine, F.col("len"))).alias(f"{s}_best"),
        ]
        summary.append(F.when(F.col(f"{s}_end") == F.col(f"t{s}"), F.col(f"{s}_tail")).otherwise(F.lit(0)).alias(f"{s}_suf"))
    done = islands.groupBy("k", "b").agg(F.sum("len").alias("n"), *aggs)
    return done.select("*", *summary).select("k", "b", *SUMMARY)


def _chains(buckets: DataFrame, keys: list[str]) -> DataFrame:
    """``keys, side, chain, len, best, last``: the runs that touch bucket edges, by side, with the side's best inner run.

    ``chain`` counts the broken buckets before a run, ``last`` those of the key:
    chain 0 begins at the first row, chain ``last`` ends at the last one.
    """
    chain_w = Window.partitionBy(*keys).orderBy("b").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    per_key = Window.partitionBy(*keys)
    parts = []
    for s in _SIDES:
        broken = F.col(f"t{s}") > 0
        seg = F.col(f"{s}_seg")
        piece = lambda chain, length: F.struct(
            F.lit(s).alias("side"), chain.alias("chain"), length.alias("len"), F.col(f"{s}_kbest").alias("best"), F.col(f"{s}_last").alias("last")
        )
        parts.append(
            F.when(broken, F.array(piece(seg, F.col(f"{s}_suf")), piece(seg - 1, F.col(f"{s}_pre")))).otherwise(
                F.array(piece(seg, F.col("n")))
            )
        )
    buckets = buckets.select(
        "*",
        *[F.sum(F.when(F.col(f"t{s}") > 0, F.lit(1)).otherwise(F.lit(0))).over(chain_w).alias(f"{s}_seg") for s in _SIDES],
        *[F.sum(F.when(F.col(f"t{s}") > 0, F.lit(1)).otherwise(F.lit(0))).over(per_key).alias(f"{s}_last") for s in _SIDES],
        *[F.max(f"{s}_best").over(per_key).alias(f"{s}_kbest") for s in _SIDES],
    )
    pieces = buckets.select(*keys, F.explode(F.concat(*parts)).alias("c")).select(*keys, "c.*")
    return pieces.groupBy(*keys, "side", "chain").agg(F.sum("len").alias("len"), F.max("best").alias("best"), F.max("last").alias("last"))


def _longest(side: str) -> Column:
    """Over the chains of a key: the longest run of a side, null without any."""
    mine = F.col("side") == side
    return F.greatest(F.max(F.when(mine, F.col("best"))), F.max(F.when(mine & (F.col("len") > 0), F.col("len"))))


def chain_buckets(buckets: DataFrame) -> DataFrame:
    """Level 2: longest runs per k from its bucket summaries (runs crossing
    bucket edges are chained). Returns ``(k, max_consecutive_wins, max_consecutive_losses)``."""
    return _chains(buckets, ["k"]).groupBy("k").agg(_longest("w").cast("long").alias("max_consecutive_wins"), _longest("l").cast("long").alias("max_consecutive_losses"))


def merge_buckets(buckets: DataFrame) -> DataFrame:
    """Summaries of consecutive buckets ``b`` as one summary per ``(k, node)``, of the same form: what holds for
    a bucket's rows then holds for the node's."""
    keys = ["k", "node"]
    sums = buckets.groupBy(*keys).agg(*[F.sum(c).alias(c) for c in ("n", *(f"t{s}" for s in _SIDES))])
    edges = []
    for s in _SIDES:
        mine = F.col("side") == s
        edges += [
            F.max(F.when(mine & (F.col("chain") == 0), F.col("len"))).alias(f"{s}_pre"),
            F.max(F.when(mine & (F.col("chain") == F.col("last")), F.col("len"))).alias(f"{s}_suf"),
            _longest(s).alias(f"{s}_best"),
        ]
    joined = sums.join(_chains(buckets, keys).groupBy(*keys).agg(*edges), keys)
    return joined.select(*keys, *SUMMARY)


def keyed_rows(closed: DataFrame, keys: list[str], bucket_ids: int = DEFAULT_BUCKET_IDS) -> DataFrame:
    """(k, b, o, p) rows with k = struct(key_name, key_value), one per trade and key, partitioned on the id bucket b."""
    rows = only_closed(closed).select(F.col("trade_id").alias("o"), F.col("profit_pct").alias("p"), F.floor(F.col("trade_id") / F.lit(bucket_ids)).alias("b"), *keys)
    names = F.array(*[F.struct(F.lit(k).alias("key_name"), F.col(k).cast("string").alias("key_value")) for k in keys])
    return rows.repartition("b").select("o", "p", "b", F.explode(names).alias("k"))
