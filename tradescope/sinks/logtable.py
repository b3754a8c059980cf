"""Small append-only tables on shared storage, written once per run and safe to write again.

A run's rows are a part of a manifest store (``sinks.manifest``), replaced as a
whole and at once, so a replayed run replaces its own rows and a crash loses none.
After ``KEEP_FRESH`` runs everything is folded into one base part, in one commit.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradescope.sinks import manifest

KEEP_FRESH = 64
ROWS, BASE = "rows", "base"


def _with_run(schema: T.StructType) -> T.StructType:
    return T.StructType([*schema.fields, T.StructField("run", T.StringType(), True)])


def write_run(df: DataFrame, path: str, run: str) -> None:
    """Replace the rows of one run."""
    spark = df.sparkSession
    state = manifest.begin(spark, path)
    rows = df.coalesce(1).withColumn("run", F.lit(run))
    written = manifest.write_parts(rows, path, "run", arranged=True)
    state = manifest.commit(spark, path, state, {ROWS: {f"run:{run}": written.get(run)}})
    if len(state.parts(ROWS)) > KEEP_FRESH:
        compact(spark, path, df.schema)


def _rows(spark: SparkSession, path: str, state: manifest.State, schema: T.StructType) -> DataFrame:
    parts = dict(state.parts(ROWS))
    base = parts.pop(BASE, None)
    out = manifest.read_parts(spark, path, parts, _with_run(schema))
    if base is not None:
        older = manifest.read_parts(spark, path, {BASE: base}, _with_run(schema))
        # A run that was written again after it was folded.
        out = older.where(~F.col("run").isin([k.removeprefix("run:") for k in parts])).unionByName(out)
    return out


def read(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """All rows with their ``run``; empty if nothing was written."""
    return _rows(spark, path, manifest.current(spark, path), schema)


def compact(spark: SparkSession, path: str, schema: T.StructType) -> None:
    """Fold all runs into a new base."""
    state = manifest.begin(spark, path)
    rows = _rows(spark, path, state, schema).coalesce(1).withColumn("all", F.lit(BASE))
    base = manifest.write_parts(rows, path, "all", arranged=True)
    manifest.commit(spark, path, state, {ROWS: {value: None for value in state.parts(ROWS)} | {BASE: base.get(BASE)}})
