"""Structured Streaming refresh (STR-1 ... STR-8).

The reference polls every five minutes for closed trades with an id above
its cursor and then recomputes everything. Here the *close event* is the
stream: closed trades arrive as files (or any streaming source), and each
micro-batch goes through ``streaming.incremental``, which keeps what it has
seen, so a trade with a lower id that closes late is still picked up, and a
replayed file or batch changes nothing.

Source offsets live in the checkpoint, so a restarted query resumes where it
stopped; ``availableNow`` gives the reference's one-shot run and a
processing-time trigger its five-minute cadence.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradescope.sinks import manifest
from tradescope.sources.trades import TRADES_SCHEMA
from tradescope.streaming.incremental import process_batch_incremental

DEFAULT_INTERVAL = "5 minutes"


def closed_trade_stream(spark: SparkSession, source_dir: str, max_files_per_trigger: int | None = None, open_too: bool = False) -> DataFrame:
    reader = spark.readStream.schema(TRADES_SCHEMA)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.parquet(source_dir)
    return rows if open_too else rows.where(~F.col("is_open"))


def stream_refresh(
    spark: SparkSession,
    source_dir: str,
    root: str,
    checkpoint: str,
    *,
    available_now: bool = True,
    interval: str = DEFAULT_INTERVAL,
    max_files_per_trigger: int | None = None,
    variant: str = "sql",
    as_of: dt.datetime | None = None,
    corrections: bool = False,
):
    """STR-3/4/5: start the refresh stream; returns the ``StreamingQuery``.

    With ``corrections`` a later row of a trade replaces the stored one, and an
    open row takes it out of the results until it closes again.

    With ``as_of`` the n-th batch is dated n hours after it, for results that
    can be compared; without it, at the time it runs.
    """

    def step(df: DataFrame, batch_id: int) -> None:
        date = None if as_of is None else as_of + dt.timedelta(hours=batch_id)
        process_batch_incremental(spark, df, batch_id, root, variant=variant, as_of=date, corrections=corrections)

    writer = closed_trade_stream(spark, source_dir, max_files_per_trigger, corrections).writeStream.foreachBatch(step).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)
    return writer.start()


def live_window_stats(closed_stream: DataFrame, window: str = "1 hour", watermark: str = "1 hour") -> DataFrame:
    """STR-8: per-window trade statistics on close time, tolerant to late data
    up to ``watermark``; emits each window once it is final (append mode)."""
    ts = F.col("close_date").cast("timestamp")
    return (
        closed_stream.where(F.col("close_date").isNotNull())
        .withColumn("close_ts", ts)
        .withWatermark("close_ts", watermark)
        .groupBy(F.window("close_ts", window).alias("w"), "strategy")
        .agg(
            F.count(F.lit(1)).alias("trades"),
            F.avg("profit_pct").alias("avg_profit_pct"),
            F.sum("profit_abs").alias("total_profit_abs"),
            F.avg(F.when(F.col("profit_pct") > 0, 1.0).otherwise(0.0)).alias("win_rate"),
        )
        .select(
            F.col("w.start").cast("timestamp_ntz").alias("window_start"),
            F.col("w.end").cast("timestamp_ntz").alias("window_end"),
            "strategy",
            "trades",
            "avg_profit_pct",
            "total_profit_abs",
            "win_rate",
        )
    )


def write_windows(windows: DataFrame, out: str, checkpoint: str, interval: str | None = None):
    """STR-8: append each window once it is final to Parquet files; returns the ``StreamingQuery``."""
    writer = windows.writeStream.outputMode("append").format("parquet").option("path", out).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()


# ------------------------------------------------------------------ STR-8, revised
#: Mergeable sums of a window and strategy; ``late`` counts the rows that came after the watermark had passed the window.
WINDOW_SCHEMA = T.StructType(
    [
        T.StructField("window_start", T.TimestampNTZType()),
        T.StructField("window_end", T.TimestampNTZType()),
        T.StructField("strategy", T.StringType()),
        T.StructField("trades", T.LongType()),
        T.StructField("n_p", T.LongType()),
        T.StructField("s_p", T.DoubleType()),
        T.StructField("s_a", T.DoubleType()),
        T.StructField("wins", T.LongType()),
        T.StructField("late", T.LongType()),
    ]
)
WINDOWS = "windows"


def revise_windows(batch: DataFrame, batch_id: int, root: str, window: str = "1 hour", watermark: str = "1 hour") -> None:
    """Takes a batch into the windows under ``root``, however late its rows are.

    A window is kept as sums that add up, in a part per day; a batch rewrites the
    days that it reaches. Rows behind the watermark (the latest close of earlier
    batches less ``watermark``) revise their window and are counted as late. A batch
    is taken once: a replay changes nothing.
    """
    spark = batch.sparkSession
    state = manifest.begin(spark, root)
    if batch_id <= state.notes.get("batch", -1):
        return
    closing = F.col("close_date").cast("timestamp")
    rows = batch.where(~F.col("is_open") & F.col("close_date").isNotNull()).select("*", F.window(closing, window).alias("w"))
    passed = F.lit(state.notes.get("seen")).cast("timestamp_ntz") - F.expr(f"INTERVAL {watermark}")
    p, end = F.col("profit_pct"), F.col("w.end").cast("timestamp_ntz")
    fresh = rows.groupBy(F.col("w.start").cast("timestamp_ntz").alias("window_start"), end.alias("window_end"), "strategy").agg(
        F.count(F.lit(1)).alias("trades"),
        F.count(p).alias("n_p"),
        F.sum(p).alias("s_p"),
        F.sum("profit_abs").alias("s_a"),
        F.sum(F.when(p > 0, 1).otherwise(0)).alias("wins"),
        F.sum(F.when(end <= passed, 1).otherwise(0)).alias("late"),
    )
    fresh = fresh.checkpoint()
    day = F.date_format("window_start", "yyyy-MM-dd")
    # One row per day that the batch reaches.
    days = [r[0] for r in fresh.select(day).distinct().collect()]
    seen = batch.where(~F.col("is_open")).agg(F.max("close_date")).first()[0]
    known = manifest.read_parts(spark, root, state.parts(WINDOWS), WINDOW_SCHEMA, days)
    sums = [F.sum(f.name).alias(f.name) for f in WINDOW_SCHEMA.fields[3:]]
    merged = known.unionByName(fresh).groupBy("window_start", "window_end", "strategy").agg(*sums)
    latest = max(filter(None, (seen.isoformat() if seen else None, state.notes.get("seen"))), default=None)
    manifest.commit(spark, root, state, {WINDOWS: manifest.write_parts(merged.withColumn("day", day), root, "day")}, {"batch": batch_id, "seen": latest})


def read_windows(spark: SparkSession, root: str) -> DataFrame:
    """All windows as they stand, with ``late_rows``."""
    rows = manifest.read_parts(spark, root, manifest.current(spark, root).parts(WINDOWS), WINDOW_SCHEMA)
    return rows.select(
        "window_start",
        "window_end",
        "strategy",
        "trades",
        F.try_divide("s_p", "n_p").alias("avg_profit_pct"),
        F.col("s_a").alias("total_profit_abs"),
        F.try_divide(F.col("wins").cast("double"), F.col("trades")).alias("win_rate"),
        F.col("late").alias("late_rows"),
    )


def revised_window_stream(closed_stream: DataFrame, root: str, checkpoint: str, interval: str | None = None, **params):
    """STR-8: keep every window right for any order of arrival; returns the ``StreamingQuery``."""
    writer = closed_stream.writeStream.foreachBatch(lambda df, k: revise_windows(df, k, root, **params)).option("checkpointLocation", checkpoint)
    writer = writer.trigger(availableNow=True) if interval is None else writer.trigger(processingTime=interval)
    return writer.start()
