"""Writing results: versioned refresh, subtype overwrite, upsert, run ledger,
metric history and CSV export.

All outputs live under a root directory on shared storage (the cluster's
checkpoint folder by default). A run writes every result table into a new
version directory and then adds a pointer file that names it; readers take the
newest pointer, so they see the old tables or the new ones and never a mix. The
health snapshot follows the switch, so the history holds only versions that were
current. Ledger and history rows are keyed on the run: a replayed batch
replaces its own rows.
"""

from __future__ import annotations

import datetime as dt
import json
import os
import time
import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradescope.plans.bots import BotTables
from tradescope.plans.tables import RESULT_TABLES, Tables
from tradescope.sinks import logtable, manifest, storage

LEDGER_SCHEMA = T.StructType(
    [
        T.StructField("id", T.StringType(), True),
        T.StructField("snapshot_type", T.StringType(), True),
        T.StructField("records_processed", T.LongType(), True),
        T.StructField("status", T.StringType(), True),
        T.StructField("last_trade_id", T.LongType(), True),
        T.StructField("closed_trades", T.LongType(), True),
        T.StructField("last_analysis_run", T.TimestampNTZType(), True),
        T.StructField("error_message", T.StringType(), True),
    ]
)

HISTORY_SCHEMA = T.StructType(
    [
        T.StructField("metric_name", T.StringType(), True),
        T.StructField("metric_value", T.DoubleType(), True),
        T.StructField("health_status", T.StringType(), True),
        T.StructField("analysis_date", T.TimestampNTZType(), True),
        T.StructField("batch_id", T.LongType(), True),
        T.StructField("bot_id", T.StringType(), True),
    ]
)

SUBTYPE_COLUMNS = {
    "performance_rankings": "ranking_type",
    "risk_metrics": "metric_type",
    "timing_analysis": "time_category",
    "stop_loss_analytics": "analysis_type",
    "duration_patterns": "pattern_type",
}

#: The ledger's name for a run that rebuilt some tables only.
TABLE_UPDATE = "table_update"
#: The table of a subtype store.
SUBTYPES = "subtypes"
#: A reader's hold on a version ends after so many seconds, should the reader never give it back.
LEASE_SECONDS = 24 * 3600


# ------------------------------------------------------------------ SNK-1
def overwrite_subtypes(df: DataFrame, path: str, subtype_col: str, subtypes: list[str]) -> None:
    """Replace the named subtypes by the rows of ``df`` (``DELETE WHERE type=...; INSERT``), all at once.

    A subtype without rows ends up empty; subtypes that are not named stay as
    they are, and rows of ``df`` of another subtype are left out. The table is a
    manifest store: readers see the old subtypes or the new ones, whenever the writer stops.
    """
    spark = df.sparkSession
    state = manifest.begin(spark, path)
    written = manifest.write_parts(df.where(F.col(subtype_col).isin(subtypes)), path, subtype_col)
    manifest.commit(spark, path, state, {SUBTYPES: {name: written.get(name) for name in subtypes}})


def read_subtypes(spark: SparkSession, path: str, schema: T.StructType, subtypes: list[str] | None = None) -> DataFrame:
    """The table that ``overwrite_subtypes`` keeps, or some of its subtypes."""
    return manifest.read_parts(spark, path, manifest.current(spark, path).parts(SUBTYPES), schema, subtypes)


# ------------------------------------------------------------------ SNK-3
def upsert(old: DataFrame, new: DataFrame, keys: list[str]) -> DataFrame:
    """``INSERT OR REPLACE`` on a natural key: old rows whose key is in ``new``
    are dropped (null-safe key match), then ``new`` is appended."""
    cond = None
    for k in keys:
        c = old[k].eqNullSafe(new[k])
        cond = c if cond is None else cond & c
    return old.join(new, cond, "left_anti").unionByName(new, allowMissingColumns=True)


# ------------------------------------------------------------------ SNK-2
def _pointers(root: str) -> str:
    return os.path.join(root, "pointers")


def current_version(spark: SparkSession, root: str) -> str | None:
    """The version that the newest pointer names."""
    names = [n for n in storage.list_files(spark, _pointers(root)) if not n.startswith(".")]
    text = storage.read_text(spark, os.path.join(_pointers(root), names[-1])) if names else None
    return text.strip() if text and text.strip() else None


def _switch(spark: SparkSession, root: str, version: str, keep: int = 3) -> None:
    """Point readers at ``version``: a pointer appears under its final name complete, older ones stay until then."""
    names = [n for n in storage.list_files(spark, _pointers(root)) if not n.startswith(".")]
    number = int(names[-1]) + 1 if names else 0
    hidden = os.path.join(_pointers(root), f".{uuid.uuid4().hex}")
    storage.write_text(spark, hidden, version)
    storage.rename(spark, hidden, os.path.join(_pointers(root), f"{number:020d}"))
    for name in names[: max(0, len(names) + 1 - keep)]:
        storage.delete(spark, os.path.join(_pointers(root), name))


def about_version(spark: SparkSession, root: str, version: str) -> dict | None:
    """What a complete version says about itself: ``as_of``, ``variant``, and per table the version folder that holds it."""
    text = storage.read_text(spark, os.path.join(root, "versions", version, "about.json"))
    return json.loads(text) if text else None


def _leases(root: str) -> str:
    return os.path.join(root, "leases")


def held_versions(spark: SparkSession, root: str) -> set[str]:
    """Versions that readers hold; holds that have run out are removed."""
    held = set()
    for name in storage.list_files(spark, _leases(root)):
        version, since, _ = name.rsplit(".", 2)
        if time.time() - int(since) < LEASE_SECONDS:
            held.add(version)
        else:
            storage.delete(spark, os.path.join(_leases(root), name))
    return held


def hold_version(spark: SparkSession, root: str, version: str | None = None) -> tuple[str, str]:
    """(version, lease): keeps the current version, or the named one, from being pruned until ``release_version``.

    The hold is written first and the version looked for after that; one that a
    refresh pruned in between is given up for the then current one.
    """
    while True:
        found = version or current_version(spark, root)
        if found is None:
            raise FileNotFoundError(f"no completed refresh under {root}")
        lease = os.path.join(_leases(root), f"{found}.{int(time.time())}.{uuid.uuid4().hex}")
        storage.write_text(spark, lease, found)
        if about_version(spark, root, found) is not None:
            return found, lease
        storage.delete(spark, lease)
        if version is not None:
            raise FileNotFoundError(f"version {version} is not under {root}")


def release_version(spark: SparkSession, lease: str) -> None:
    storage.delete(spark, lease)


def prune_versions(spark: SparkSession, root: str, keep: int = 3) -> list[str]:
    """Retention: drop all but the newest ``keep`` result versions, the current one, those that readers hold, and
    those that one of these takes a table from. Returns the removed version ids."""
    base = os.path.join(root, "versions")
    versions = [name for name, _ in sorted(storage.list_dirs(spark, base), key=lambda v: v[1], reverse=True)]
    stay = {*versions[:keep], current_version(spark, root), *held_versions(spark, root)} - {None}
    for name in list(stay):
        stay |= set(((about_version(spark, root, name) or {}).get("tables") or {}).values())
    removed = [name for name in versions if name not in stay]
    for name in removed:
        storage.delete(spark, os.path.join(base, name))
    return removed


def write_version(tables: Tables | BotTables, root: str, version: str, names: list[str] | None = None) -> str:
    """Write result tables under ``root/versions/<version>/<table>``, each with its schema beside it.

    With ``names`` only these are written, and the version takes the others from
    the current one. ``about.json`` comes last and makes the version complete.
    """
    spark, base = tables.trades.sparkSession, os.path.join(root, "versions", version)
    places = {}
    if names is not None and (current := current_version(spark, root)) is not None:
        places = dict(about_version(spark, root, current)["tables"])
    for name in names or RESULT_TABLES:
        df = tables.table(name)
        writer = df.write.mode("overwrite")
        parts = [c for c in ("bot_id", SUBTYPE_COLUMNS.get(name)) if c in df.columns]
        if parts:
            writer = writer.partitionBy(*parts)
        storage.write_parquet(writer, os.path.join(base, name))
        storage.write_text(spark, os.path.join(base, f"{name}.schema"), df.schema.json())
        places[name] = version
    about = {"as_of": tables.as_of.isoformat() if tables.as_of else None, "variant": tables.variant, "tables": places}
    storage.write_text(spark, os.path.join(base, "about.json"), json.dumps(about))
    return base


def read_table_of(spark: SparkSession, root: str, version: str, name: str) -> DataFrame:
    """A result table of one version, also where it has no rows."""
    place = ((about_version(spark, root, version) or {}).get("tables") or {}).get(name)
    if place is None:
        raise FileNotFoundError(f"{name} has not been refreshed under {root}")
    path = os.path.join(root, "versions", place, name)
    schema = T.StructType.fromJson(json.loads(storage.read_text(spark, f"{path}.schema")))
    return spark.read.schema(schema).parquet(path).select(*schema.names)


def read_result(spark: SparkSession, root: str, name: str) -> DataFrame:
    """A result table of the current version."""
    version = current_version(spark, root)
    if version is None:
        raise FileNotFoundError(f"no completed refresh under {root}")
    return read_table_of(spark, root, version, name)


# ------------------------------------------------------------------ SNK-5 / SNK-6
def ledger_path(root: str) -> str:
    return os.path.join(root, "analysis_snapshots")


def write_ledger(spark: SparkSession, root: str, **row) -> None:
    """The state of one run (processing, then completed or failed); a later state replaces the earlier one."""
    df = spark.createDataFrame([tuple(row.get(f.name) for f in LEDGER_SCHEMA.fields)], LEDGER_SCHEMA)
    logtable.write_run(df, ledger_path(root), row["id"])


def read_ledger(spark: SparkSession, root: str) -> DataFrame:
    """One row per run, its latest state."""
    return logtable.read(spark, ledger_path(root), LEDGER_SCHEMA).drop("run")


def ledger_report(ledger: DataFrame, k: int = 3) -> DataFrame:
    """SNK-6: the last ``k`` runs by time."""
    return (
        ledger.orderBy(F.col("last_analysis_run").desc(), "id")
        .limit(k)
        .select("snapshot_type", "status", "records_processed", F.col("last_analysis_run").alias("last_run"))
    )


def processed_so_far(spark: SparkSession, root: str) -> tuple[int, int]:
    """STR-1: (highest trade id, closed trades) of the completed runs; zeros before the first one."""
    done = read_ledger(spark, root).where((F.col("status") == "completed") & (F.col("snapshot_type") != TABLE_UPDATE))
    row = done.agg(F.max("last_trade_id").alias("id"), F.max_by("closed_trades", "last_analysis_run").alias("n")).first()
    return row["id"] or 0, row["n"] or 0


# ------------------------------------------------------------------ SNK-8
def history_path(root: str) -> str:
    return os.path.join(root, "bot_health_history")


def write_health_snapshot(health: DataFrame, root: str, run: str, as_of: dt.datetime, batch_id: int | None = None) -> None:
    """Keep a run's health metrics (of each bot, where there are several) with its analysis date."""
    snap = health.select(
        "metric_name",
        "metric_value",
        "health_status",
        F.lit(as_of).cast("timestamp_ntz").alias("analysis_date"),
        F.lit(batch_id).cast("long").alias("batch_id"),
        (F.col("bot_id") if "bot_id" in health.columns else F.lit(None).cast("string")).alias("bot_id"),
    )
    logtable.write_run(snap, history_path(root), run)


def read_health_history(spark: SparkSession, root: str) -> DataFrame:
    return logtable.read(spark, history_path(root), HISTORY_SCHEMA)


def health_history_lag(history: DataFrame, bots: bool = False) -> DataFrame:
    """bh_history_lag: previous value and change per metric (and bot) over the stored snapshots."""
    by = ["bot_id"] if bots else []
    w = Window.partitionBy(*by, "metric_name").orderBy("analysis_date")
    prev = F.lag("metric_value").over(w)
    return history.select(
        *by,
        "metric_name",
        "metric_value",
        "health_status",
        "analysis_date",
        prev.alias("previous_value"),
        F.round(F.col("metric_value") - prev, 2).alias("value_change"),
    )


# ------------------------------------------------------------------ SNK-7
def export_csv(df: DataFrame, path: str, files: int | None = None) -> None:
    """CSV files with a header line; ``files=1`` for a table that is known to be small."""
    (df if files is None else df.coalesce(files)).write.mode("overwrite").option("header", True).csv(path)


# ------------------------------------------------------------------ refresh
def refresh(
    spark: SparkSession,
    trades: DataFrame,
    root: str,
    *,
    full: bool = False,
    variant: str = "sql",
    as_of: dt.datetime | None = None,
    snapshot_type: str | None = None,
    run_id: str | None = None,
    batch_id: int | None = None,
    counts: tuple[int, int, int] | None = None,
    stats: DataFrame | None = None,
    streaks: DataFrame | None = None,
    losers: tuple[DataFrame, DataFrame] | None = None,
    names: list[str] | None = None,
    keep_versions: int = 3,
) -> dict:
    """One analysis run: look for newly closed trades, rebuild
    every result table into a new version, switch to it, keep the health
    snapshot and record the run.

    A trade counts as new when it has closed since the last completed run,
    whatever its id, so the number of closed trades decides and not the highest
    id. ``full=True`` (SNK-9) always recomputes. ``run_id`` names the run (a
    stream names it after the batch, so a replay replaces its rows); a caller that
    knows ``counts=(new, highest id, closed)`` and holds merged ``stats``,
    ``streaks`` or a rank index of the ``losers`` saves those scans. With ``names``
    only these tables are rebuilt, whatever is new, from the statistics that they
    need; the new version takes the others from the current one, and the run does not
    count as one that has seen the new trades. Trades with a ``bot_id`` give tables with
    one, partitioned by it. Failures are recorded with their whole message
    and raised again.
    """
    as_of = as_of or dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    if counts is None:
        top, known = processed_so_far(spark, root)
        row = trades.where(~F.col("is_open")).agg(F.count(F.lit(1)).alias("n"), F.max("trade_id").alias("top")).first()
        if not full and names is None and row["n"] == known and (row["top"] or 0) <= top:
            return {"status": "skipped", "records_processed": 0, "last_trade_id": top}
        counts = (int(row["n"]) - (0 if full else known), row["top"], int(row["n"]))
    run_id = run_id or uuid.uuid4().hex
    snapshot_type = snapshot_type or ("automated_analysis" if names is None else TABLE_UPDATE)
    common = dict(id=run_id, snapshot_type=snapshot_type, records_processed=counts[0], last_trade_id=counts[1], closed_trades=counts[2], last_analysis_run=as_of)
    write_ledger(spark, root, status="processing", **common)
    version = f"{run_id}-{uuid.uuid4().hex[:8]}"  # a replay must not write into the version that is being read
    tables = (BotTables if "bot_id" in trades.columns else Tables)(trades, variant=variant, as_of=as_of)
    try:
        if names is None:
            tables.persist_results(stats=stats, streaks=streaks, losers=losers)
        write_version(tables, root, version, names)
        _switch(spark, root, version)
        if names is None or "bot_health_metrics" in names:
            write_health_snapshot(read_table_of(spark, root, version, "bot_health_metrics"), root, run_id, as_of, batch_id)
        prune_versions(spark, root, keep_versions)
        write_ledger(spark, root, status="completed", **common)
    except Exception as exc:
        write_ledger(spark, root, status="failed", error_message=str(exc), **common)
        raise
    finally:
        tables.release()
    return {"status": "completed", "version": version, "records_processed": counts[0], "last_trade_id": counts[1]}


def status_changes(previous: DataFrame, current: DataFrame) -> DataFrame:
    """STR-7: metrics whose health status changed between two snapshots, plus
    current CRITICAL / WARNING alerts."""
    p = previous.select("metric_name", F.col("health_status").alias("previous_status"))
    c = current.select("metric_name", "metric_value", "health_status", "recommendation")
    j = c.join(p, "metric_name", "left")
    changed: Column = F.col("previous_status").isNull() | (F.col("previous_status") != F.col("health_status"))
    alert = F.col("health_status").isin("CRITICAL", "WARNING")
    return j.where(changed | alert).withColumn("changed", changed)
