"""Incremental micro-batch refresh: work per batch follows the batch, not the table.

The state under ``root/state`` is one manifest store (``sinks.manifest``). A batch
writes new parts beside the old ones and commits all of them at once, with its
number, so a stop at any point leaves the state before the batch or the one after
it. A batch that is replayed after its commit changes no state; only its results are
written again.

Closed trades are kept by trade-id bucket (2^20 ids); a batch reads and rewrites only
the buckets that its rows fall into. Everything else is derived from whole buckets and
merges, so it is kept as trees over the buckets, ``FANOUT`` children to a node: a batch
renews the leaves of its buckets and the nodes above them, and the root
describes all trades. Trees hold the grain statistics, the run summaries of the
streaks, and how many losing profits each fixed range holds. Statistics and counts
add up, so their leaves take in the batch's own; where trades were taken out of a
bucket, and for the runs, leaves are computed from whole buckets. With the distinct
losing profits of each bucket, the range counts are a rank index: VaR is found from
the root's range counts and the values of one range, and no stored trade is read for it.

A stored trade wins over a later row with its id, and of several rows with one id
in a batch the one that closed last does: a close happens once. With
``corrections`` the later row wins: it replaces the stored trade, and an open row
takes it out again. As leaves are then computed from what a bucket holds, extremes, counts
and runs are those of the trades that are left.
"""

from __future__ import annotations

import datetime as dt
import os
from collections.abc import Callable
from typing import NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradescope.operators.grains import grain_stats, merge_stats, only_closed
from tradescope.operators.order_stats import count_ranges, count_values, merge_ranges
from tradescope.operators.streaks import DEFAULT_BUCKET_IDS, bucket_summaries, chain_buckets, keyed_rows, merge_buckets, split_keys
from tradescope.session import ensure_checkpoint_dir
from tradescope.sinks import logtable, manifest
from tradescope.sinks import refresh as sink
from tradescope.sources.trades import TRADES_SCHEMA

STREAK_KEYS = ["pair", "strategy"]
# Children of a node in the trees over the buckets.
FANOUT = 64

VALUES_SCHEMA = T.StructType([T.StructField("v", T.DoubleType()), T.StructField("n", T.LongType())])

ALERT_SCHEMA = T.StructType(
    [
        T.StructField("metric_name", T.StringType(), True),
        T.StructField("metric_value", T.DoubleType(), True),
        T.StructField("health_status", T.StringType(), True),
        T.StructField("recommendation", T.StringType(), True),
        T.StructField("previous_status", T.StringType(), True),
        T.StructField("changed", T.BooleanType(), True),
        T.StructField("batch_id", T.LongType(), True),
    ]
)


def state_path(root: str) -> str:
    return os.path.join(root, "state")


def alerts_path(root: str) -> str:
    return os.path.join(root, "alerts")


def read_trades(spark: SparkSession, root: str) -> DataFrame:
    """All stored trades of the committed state."""
    path = state_path(root)
    return manifest.read_parts(spark, path, manifest.current(spark, path).parts("trades"), TRADES_SCHEMA)


def one_close_per_id(batch: DataFrame, corrections: bool = False) -> DataFrame:
    """One row per id of a batch: the last close (ties: the greatest row), by partial aggregation.

    With ``corrections`` an id that only open rows have keeps one of them.
    """
    rest = [c for c in TRADES_SCHEMA.names if c not in ("trade_id", "close_date", "is_open")]
    rows = batch if corrections else batch.where(~F.col("is_open"))
    order = F.struct((~F.col("is_open")).alias("ended"), "close_date", *rest, "is_open")
    return rows.groupBy("trade_id").agg(F.max(order).alias("t")).select("trade_id", "t.*").select(*TRADES_SCHEMA.names)


# ------------------------------------------------------------------ trees over the buckets
def _level(name: str, level: int) -> str:
    return f"{name}/{level}"


def root_parts(state: manifest.State, name: str) -> dict[str, str]:
    """The parts that describe all buckets: the first level with one node, or the highest (ids below zero)."""
    level = 0
    while len(state.parts(_level(name, level))) > 1 and state.parts(_level(name, level + 1)):
        level += 1
    return state.parts(_level(name, level))


def read_node_parts(spark: SparkSession, path: str, parts: dict[str, str]) -> DataFrame:
    return spark.read.parquet(*[os.path.join(path, p) for p in parts.values()])


def grow_tree(
    spark: SparkSession, path: str, state: manifest.State, name: str, leaves: dict[str, str | None], merge: Callable[[DataFrame], DataFrame]
) -> dict[str, dict[str, str | None]]:
    """The changes of a tree: new leaves (None: the bucket is empty) and the nodes above them.

    ``merge`` gets the rows of children with their own number ``b`` and their
    parent's ``node``, and returns one set of rows per ``node``.
    """
    changes: dict[str, dict[str, str | None]] = {_level(name, 0): leaves}
    level = 0
    while True:
        here = changes[_level(name, level)]
        nodes = {k: p for k, p in {**state.parts(_level(name, level)), **here}.items() if p is not None}
        above = _level(name, level + 1)
        grown = {int(k) // FANOUT for k in nodes}
        # One node is the root; ids on both sides of zero end in two.
        if not state.parts(above) and (len(nodes) <= 1 or grown == {int(k) for k in nodes}):
            return changes
        touched = {int(k) // FANOUT for k in here} if state.parts(above) else grown
        children = {k: p for k, p in nodes.items() if int(k) // FANOUT in touched}
        written = {}
        if children:
            rows = read_node_parts(spark, path, children).withColumnRenamed("node", "b").withColumn("node", F.floor(F.col("b") / FANOUT))
            written = manifest.write_parts(merge(rows), path, "node")
        changes[above] = {str(k): written.get(str(k)) for k in touched}
        level += 1


def store_batch(spark: SparkSession, batch: DataFrame, batch_id: int, root: str, bucket_ids: int, variant: str, corrections: bool = False) -> manifest.State | None:
    """Takes a batch's new trades into the state; nothing if it has none."""
    path = state_path(root)
    state = manifest.begin(spark, path)
    if batch_id <= state.notes.get("batch", -1):  # a replay: the state has this batch
        return state if batch_id == state.notes["batch"] else None
    node = F.floor(F.col("trade_id") / F.lit(bucket_ids))
    incoming = one_close_per_id(batch, corrections).checkpoint()
    # One row per 2^20 ids that the batch reaches.
    touched = [r[0] for r in incoming.select(node).distinct().collect()]
    stored = manifest.read_parts(spark, path, state.parts("trades"), TRADES_SCHEMA, touched)
    if corrections:
        # Rows that are stored just so are no news.
        fresh = incoming.where(~F.col("is_open")).join(stored.intersect(incoming).select("trade_id"), "trade_id", "left_anti")
        gone = incoming.where("is_open").unionByName(fresh).select("trade_id").join(stored.select("trade_id"), "trade_id", "left_semi")
    else:
        fresh = incoming.join(stored.select("trade_id"), "trade_id", "left_anti")
        gone = incoming.select("trade_id").where(F.lit(False))
    fresh, gone = fresh.select(*TRADES_SCHEMA.names).checkpoint(), gone.checkpoint()
    row = fresh.agg(F.count(F.lit(1)).alias("n"), F.max("trade_id").alias("top"), F.collect_set(node).alias("nodes")).first()
    left = gone.agg(F.count(F.lit(1)).alias("n"), F.collect_set(node).alias("nodes")).first()
    if not row["n"] and not left["n"]:
        return None
    nodes = sorted({*row["nodes"], *left["nodes"]})
    stored = manifest.read_parts(spark, path, state.parts("trades"), TRADES_SCHEMA, nodes)
    if left["n"]:
        stored = stored.join(gone, "trade_id", "left_anti").select(*TRADES_SCHEMA.names)
    # Parts never change, so the rewritten buckets may be read while they are written.
    content = stored.unionByName(fresh).withColumn("node", node)

    def whole(df: DataFrame) -> dict[str, str | None]:
        """Parts of all buckets that the batch changes; those without rows go."""
        written = manifest.write_parts(df, path, "node")
        return {str(k): written.get(str(k)) for k in nodes}

    def grown(leaves: str, compute: Callable[[DataFrame], DataFrame], merge: Callable[[DataFrame], DataFrame]) -> dict[str, str | None]:
        """New leaves of what adds up: the batch's own merged into the stored ones; from whole buckets where trades were taken out."""
        if left["n"]:
            return whole(compute(content))
        own = compute(fresh.withColumn("node", node))
        known = {str(k): state.parts(leaves)[str(k)] for k in nodes if str(k) in state.parts(leaves)}
        return whole(merge(read_node_parts(spark, path, known).unionByName(own)) if known else own)

    trades = whole(content)
    content = read_node_parts(spark, path, {k: p for k, p in trades.items() if p}) if any(trades.values()) else content.where(F.lit(False))
    values = grown(
        "loser_values",
        lambda rows: count_values(only_closed(rows).where(F.col("profit_pct") < 0), "profit_pct", ["node"]),
        lambda rows: rows.groupBy("node", "v").agg(F.sum("n").alias("n")),
    )
    held = {k: p for k, p in values.items() if p}
    losing = read_node_parts(spark, path, held) if held else spark.createDataFrame([], "node long, v double, n long")
    changes = {"trades": trades, "loser_values": values}
    changes |= grow_tree(spark, path, state, "loser_ranges", whole(count_ranges(losing, ["node"])), lambda rows: merge_ranges(rows, ["node"]))
    stats = grown(_level("stats", 0), lambda rows: grain_stats(rows, by=["node"]), lambda rows: merge_stats(rows, ["node"]))
    changes |= grow_tree(spark, path, state, "stats", stats, lambda rows: merge_stats(rows, ["node"]))
    if variant == "sql":
        runs = bucket_summaries(keyed_rows(content, STREAK_KEYS, bucket_ids)).withColumnRenamed("b", "node")
        changes |= grow_tree(spark, path, state, "streaks", whole(runs), merge_buckets)
    before = state.notes
    notes = {"batch": batch_id, "new": row["n"], "top": max(row["top"] or 0, before.get("top", 0)), "closed": row["n"] - left["n"] + before.get("closed", 0)}
    return manifest.commit(spark, path, state, changes, notes)


class Current(NamedTuple):
    """What the state says about all trades: merged statistics, longest runs, and the rank index of the losers."""

    stats: DataFrame
    streaks: DataFrame | None
    losers: tuple[DataFrame, DataFrame]


def current_summaries(spark: SparkSession, root: str, state: manifest.State, variant: str) -> Current:
    path = state_path(root)
    empty_ranges = "place long, n long, low double, high double"
    found = {name: root_parts(state, name) for name in ("stats", "streaks", "loser_ranges")}
    ranges = read_node_parts(spark, path, found["loser_ranges"]) if found["loser_ranges"] else spark.createDataFrame([], empty_ranges)
    values = manifest.read_parts(spark, path, state.parts("loser_values"), VALUES_SCHEMA)
    stats = merge_stats(read_node_parts(spark, path, found["stats"])) if found["stats"] else grain_stats(spark.createDataFrame([], TRADES_SCHEMA))
    streaks = None
    if variant == "sql" and found["streaks"]:
        streaks = split_keys(chain_buckets(read_node_parts(spark, path, found["streaks"]).withColumnRenamed("node", "b")))
    return Current(stats, streaks, (merge_ranges(ranges), values))


def process_batch_incremental(
    spark: SparkSession,
    batch: DataFrame,
    batch_id: int,
    root: str,
    bucket_ids: int = DEFAULT_BUCKET_IDS,
    variant: str = "sql",
    as_of: dt.datetime | None = None,
    corrections: bool = False,
) -> dict:
    """One micro-batch; replaying a batch leaves the same state. ``as_of`` is the time of the run unless given."""
    ensure_checkpoint_dir(spark)
    state = store_batch(spark, batch, batch_id, root, bucket_ids, variant, corrections)
    if state is None:  # STR-2: nothing new, nothing is written
        return {"batch_id": batch_id, "status": "skipped"}
    known = current_summaries(spark, root, state, variant)
    previous = previous_health(spark, root, batch_id)
    run = sink.refresh(
        spark,
        manifest.read_parts(spark, state_path(root), state.parts("trades"), TRADES_SCHEMA),
        root,
        full=True,
        variant=variant,
        as_of=as_of,
        snapshot_type="stream_batch",
        run_id=f"batch-{batch_id:012d}",
        batch_id=batch_id,
        counts=(state.notes["new"], state.notes["top"], state.notes["closed"]),
        stats=known.stats,
        streaks=known.streaks,
        losers=known.losers,
    )
    if previous is not None:
        record_alerts(spark, root, previous, batch_id)
    return {"batch_id": batch_id, **run}


def previous_health(spark: SparkSession, root: str, batch_id: int) -> DataFrame | None:
    """The health snapshot of the last batch before this one (eleven rows)."""
    earlier = sink.read_health_history(spark, root).where(F.col("batch_id") < batch_id)
    last = earlier.agg(F.max("batch_id")).first()[0]
    if last is None:
        return None
    rows = earlier.where(F.col("batch_id") == last)
    # A copy: the run that follows may rewrite the files these rows come from.
    return spark.createDataFrame(rows.collect(), rows.schema)


def record_alerts(spark: SparkSession, root: str, previous: DataFrame, batch_id: int) -> None:
    """STR-7: status changes against the previous batch plus current alerts."""
    current = sink.read_result(spark, root, "bot_health_metrics")
    alerts = sink.status_changes(previous, current).withColumn("batch_id", F.lit(batch_id).cast("long"))
    logtable.write_run(alerts.select(*ALERT_SCHEMA.names), alerts_path(root), f"batch-{batch_id:012d}")


def read_alerts(spark: SparkSession, root: str) -> DataFrame:
    return logtable.read(spark, alerts_path(root), ALERT_SCHEMA).drop("run")
