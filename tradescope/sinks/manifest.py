"""Tables in parts that are never changed, under a manifest that is replaced at once.

A store is a folder that holds one or more tables. A table is a set of parts, one for
each value of some column (a bucket, a subtype, a batch); each part is a folder of
Parquet files under a name of its own. The newest file in ``manifests`` says which
parts make up every table. A writer puts new parts beside the old ones and then
commits: a new manifest appears under the next number, complete, and all changes of
all tables hold from then on. Whatever stops a writer before that leaves the
former state; what it left lying about goes with the next ``begin``. A store has one
writer at a time; readers keep the state they began with for one more commit.
"""

from __future__ import annotations

import json
import os
import uuid
from collections.abc import Iterable
from typing import Any, NamedTuple
from urllib.parse import unquote

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tradescope.sinks import storage

#: Manifests, and with them the parts that only they name, that stay after a commit.
KEEP = 2
PART = "part"


class State(NamedTuple):
    """``tables``: table -> value -> folder of the part; ``notes``: what the writer wants to remember with it."""

    number: int
    tables: dict[str, dict[str, str]]
    notes: dict[str, Any]

    def parts(self, table: str) -> dict[str, str]:
        return self.tables.get(table, {})


def _folder(root: str) -> str:
    return os.path.join(root, "manifests")


def _numbers(spark: SparkSession, root: str) -> list[str]:
    return [n for n in storage.list_files(spark, _folder(root)) if not n.startswith(".")]


def _load(spark: SparkSession, root: str, name: str) -> State:
    said = json.loads(storage.read_text(spark, os.path.join(_folder(root), name)))
    return State(int(name), said["tables"], said["notes"])


def current(spark: SparkSession, root: str) -> State:
    """The committed state; an empty one before the first commit."""
    names = _numbers(spark, root)
    return _load(spark, root, names[-1]) if names else State(-1, {}, {})


def begin(spark: SparkSession, root: str) -> State:
    """The committed state for a writer; removes what earlier writers left without a commit."""
    named = {path.split("/")[1] for n in _numbers(spark, root) for table in _load(spark, root, n).tables.values() for path in table.values()}
    for name, _ in storage.list_dirs(spark, os.path.join(root, "data")):
        if name not in named:
            storage.delete(spark, os.path.join(root, "data", name))
    return current(spark, root)


def write_parts(df: DataFrame, root: str, column: str, arranged: bool = False) -> dict[str, str]:
    """Write ``df`` as parts by the value of ``column``: value -> folder, for values that have rows.

    Each part is one file, unless ``arranged`` keeps the frame's own partitioning and order.
    """
    folder = os.path.join("data", uuid.uuid4().hex)
    rows = df.withColumn(PART, F.col(column))
    storage.write_parquet((rows if arranged else rows.repartition(PART)).write.partitionBy(PART), os.path.join(root, folder))
    found = [n for n, _ in storage.list_dirs(df.sparkSession, os.path.join(root, folder)) if n.startswith(f"{PART}=")]
    return {unquote(n.split("=", 1)[1]): os.path.join(folder, n) for n in found}


def read_parts(spark: SparkSession, root: str, parts: dict[str, str], schema: T.StructType, values: Iterable[Any] | None = None) -> DataFrame:
    """The rows of the given parts, or of those with the given values, and of no others."""
    chosen = parts.values() if values is None else [parts[str(v)] for v in values if str(v) in parts]
    paths = [os.path.join(root, p) for p in chosen]
    return spark.read.schema(schema).parquet(*paths) if paths else spark.createDataFrame([], schema)


def commit(spark: SparkSession, root: str, old: State, changes: dict[str, dict[str, str | None]], notes: dict[str, Any] | None = None) -> State:
    """Replace parts (None: remove) of any tables at once; the result is the new state."""
    tables = {name: dict(parts) for name, parts in old.tables.items()}
    for name, parts in changes.items():
        table = tables.setdefault(name, {})
        for value, path in parts.items():
            if path is None:
                table.pop(value, None)
            else:
                table[value] = path
    new = State(old.number + 1, tables, old.notes if notes is None else notes)
    hidden = os.path.join(_folder(root), f".{uuid.uuid4().hex}")
    storage.write_text(spark, hidden, json.dumps({"tables": new.tables, "notes": new.notes}))
    storage.rename(spark, hidden, os.path.join(_folder(root), f"{new.number:020d}"))
    _retire(spark, root)
    return new


def _retire(spark: SparkSession, root: str) -> None:
    """Drop the manifests beyond ``KEEP`` and the parts that no newer one names: parts first, so a stop leaves nothing unnamed."""
    names = _numbers(spark, root)
    kept = {path for n in names[-KEEP:] for table in _load(spark, root, n).tables.values() for path in table.values()}
    for n in names[:-KEEP]:
        for table in _load(spark, root, n).tables.values():
            for path in table.values():
                if path not in kept:
                    storage.delete(spark, os.path.join(root, path))
        storage.delete(spark, os.path.join(_folder(root), n))
