"""Repeated lines are found with levelled sorted runs of line hashes, and dropped from all documents but one.

A line's key is the line without the white space around it, A-Z lower-cased; it
is hashed to 128 bits. The index is a set of runs, as in a log-structured merge
tree: each run is a table of the shared folder, bucketed and sorted by hash, with the
number of documents that hold the key and the largest id among them. A new batch of
documents is reduced to one row per key and merge-anti-joined with every run: keys
that a run shows to be settled (held by enough documents, one of them with a larger
id) go, all others become a run of their own at level 0. ``FANOUT`` runs of a level are
merged into one of the next, which adds up their counts.

Batches may come in any order. Taken from the largest ids to the smallest, a key is
settled for good once enough documents hold it, so frequent lines are written a few
times, not once per document.

The decision joins each document's keys with the repeated keys of the index. Keys that
hold more than 1 / ``HOT_SHARE`` of a batch's lines are joined by broadcast (at most
``HOT_SHARE`` keys per batch), so no key gathers in one task.
"""

from __future__ import annotations

import hashlib
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tradescope.llm.common import cut, forget, keyed, map_rows, same_row
from tradescope.session import ensure_checkpoint_dir

#: Runs of one level that are merged into a run of the next.
FANOUT = 4
#: Batches that a whole table is cut into, by id.
BATCHES = 6
HOT_SHARE = 1000
#: White space that does not count at the ends of a line: blank, and the controls from tab to carriage return.
AROUND = b" \t\n\x0b\x0c\r"


def line_key(line: bytes, min_chars: int) -> bytes | None:
    """The hash of a line's key (``line`` in UTF-8), or nothing if the key is shorter than ``min_chars`` code points."""
    key = line.strip(AROUND).lower()  # bytes: only A-Z
    if len(key) < min_chars or (len(key) < 4 * min_chars and sum(b & 0xC0 != 0x80 for b in key) < min_chars):
        return None
    return hashlib.blake2b(key, digest_size=16).digest()


def line_hashes(docs: DataFrame, min_chars: int) -> DataFrame:
    """``doc_id, t1, t2, hashes array<binary>``: the distinct keys of each whole text."""

    def run(cols):
        out = {c: cols[c] for c in ("doc_id", "t1", "t2")} | {"hashes": []}
        for text in cols["text"]:
            found = {line_key(line, min_chars) for line in text.encode("utf-8", "surrogatepass").split(b"\n")}
            out["hashes"].append(list(found - {None}))
        return out

    return map_rows(keyed(docs), run, "doc_id long, t1 long, t2 long, hashes array<binary>")


class LineRuns:
    """The index: levelled runs of ``h, n, top`` (hash, documents that hold it, largest id), sorted by hash.

    ``top`` is null where only documents without an id hold the key. ``n`` is exact up
    to ``min_docs``; beyond that it may lag behind. A run is only deleted after
    its successor is written, and no run is ever changed.
    """

    def __init__(self, spark: SparkSession, min_docs: int, fanout: int = FANOUT):
        self.spark, self.min_docs, self.fanout = spark, min_docs, fanout
        self.buckets = int(spark.conf.get("spark.sql.shuffle.partitions", "200"))
        self.levels: list[list[str]] = []

    def runs(self) -> list[str]:
        """The tables of all runs, largest first."""
        return [r for level in reversed(self.levels) for r in level]

    def _write(self, keys: DataFrame) -> str:
        name = f"line_run_{uuid.uuid4().hex}"
        path = f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}"
        keys.write.format("parquet").bucketBy(self.buckets, "h").sortBy("h").option("path", path).saveAsTable(name)
        return name

    def _drop(self, name: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {name}")
        forget(self.spark, f"{ensure_checkpoint_dir(self.spark).rstrip('/')}/{name}")

    def unsettled(self, keys: DataFrame) -> DataFrame:
        """The rows of ``keys`` that no run shows to be settled: a merge-anti-join with each run in turn."""
        for name in self.runs():
            run = self.spark.table(name).where(F.col("n") >= self.min_docs).hint("merge").alias("run")
            held = (F.col("keys.h") == F.col("run.h")) & (F.col("keys.top").isNull() | (F.col("run.top") >= F.col("keys.top")))
            keys = keys.alias("keys").join(run, held, "left_anti")
        return keys

    def add(self, keys: DataFrame) -> None:
        """Adds a batch (one row per hash) as a run of level 0 and merges levels that are full."""
        self._place(self._write(self.unsettled(keys)), 0)

    def _place(self, run: str, level: int) -> None:
        if level == len(self.levels):
            self.levels.append([])
        self.levels[level].append(run)
        if len(self.levels[level]) == self.fanout:
            full = self.levels[level]
            merged = self._write(self.merged(full))
            self.levels[level] = []
            for name in full:
                self._drop(name)
            self._place(merged, level + 1)

    def merged(self, runs: list[str] | None = None) -> DataFrame:
        """``h, n, top`` over the given runs (all, if not named)."""
        names = self.runs() if runs is None else runs
        rows = self.spark.createDataFrame([], "h binary, n long, top long")
        for name in names:
            rows = rows.unionByName(self.spark.table(name))
        return rows.groupBy("h").agg(F.sum("n").alias("n"), F.max("top").alias("top"))

    def drop(self) -> None:
        """Deletes all runs."""
        for name in self.runs():
            self._drop(name)
        self.levels = []


def batch_of(docs: DataFrame, n: int):
    """A column that numbers ``n`` batches of about equal size, from the largest ids to the smallest; null ids come last."""
    at = [k / n for k in range(1, n)]
    edges = docs.select(F.percentile_approx(F.col("doc_id").cast("long"), at, 10_000).alias("e")).first()["e"] if at else []
    below = sum((F.when(F.col("doc_id") <= e, 1).otherwise(0) for e in sorted(set(edges or []))), F.lit(0))
    return F.when(F.col("doc_id").isNull(), F.lit(n - 1)).otherwise(below).cast("int")


def dropped_lines(docs: DataFrame, min_chars: int, min_docs: int, batches: int = BATCHES) -> DataFrame:
    """``doc_id, t1, t2, drops array<binary>`` of the documents that lose lines: the keys of those lines."""
    spark = docs.sparkSession
    lines = cut(line_hashes(docs, min_chars).withColumn("batch", batch_of(docs, batches)), by=["batch"])
    index, hot = LineRuns(spark, min_docs), set()
    for (batch,) in sorted(lines.select("batch").distinct().collect()):  # at most ``batches`` rows
        each = lines.where(F.col("batch") == batch).select("doc_id", F.explode("hashes").alias("h"))
        keys = cut(each.groupBy("h").agg(F.count(F.lit(1)).alias("n"), F.max("doc_id").alias("top")))
        total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        hot.update(bytes(h) for (h,) in keys.where(F.col("n") > total / HOT_SHARE).where(F.col("n") > 1).select("h").collect())  # fewer than HOT_SHARE
        index.add(keys)
    repeated = cut(index.merged().where(F.col("n") >= min_docs).select("h", "top"))
    index.drop()
    frequent = F.broadcast(spark.createDataFrame([(h,) for h in hot], "h binary"))
    each = lines.select("doc_id", "t1", "t2", F.explode("hashes").alias("h"))
    by_broadcast = each.join(F.broadcast(repeated.join(frequent, "h", "left_semi")), "h")
    by_shuffle = each.join(frequent, "h", "left_anti").join(repeated.hint("merge"), "h")
    lost = by_broadcast.unionByName(by_shuffle).where(~F.col("doc_id").eqNullSafe(F.col("top")))
    return lost.groupBy("doc_id", "t1", "t2").agg(F.collect_set("h").alias("drops"))


def dedup_lines(docs: DataFrame, min_chars: int = 20, min_docs: int = 3, batches: int = BATCHES) -> DataFrame:
    """``doc_id, n_lines, n_dropped, text`` of every whole text without its repeated lines, one row per input row.

    A key of at least ``min_chars`` code points that at least ``min_docs`` documents
    hold loses all its lines except in the document with the largest id that
    holds it, where all its lines stay. Null and empty texts are one empty line.
    Every row counts as a document: rows that share the largest id all keep the
    line; a null id is smaller than any other, and where only null ids hold a key, it
    stays in all of them. Other columns play no part.
    """
    drops = dropped_lines(docs, min_chars, min_docs, batches)
    rows = keyed(docs).alias("d").join(drops.alias("x"), same_row("d", "x"), "left").select("d.doc_id", "d.text", "x.drops")

    def run(cols):
        out = {"doc_id": cols["doc_id"], "n_lines": [], "n_dropped": [], "text": []}
        for text, drops in zip(cols["text"], cols["drops"], strict=True):
            lines, gone = text.split("\n"), set(drops or [])
            kept = [x for x in lines if line_key(x.encode("utf-8", "surrogatepass"), min_chars) not in gone] if gone else lines
            out["n_lines"].append(len(lines))
            out["n_dropped"].append(len(lines) - len(kept))
            out["text"].append("\n".join(kept))
        return out

    return map_rows(rows, run, "doc_id long, n_lines long, n_dropped long, text string")


def line_digest(docs: DataFrame) -> DataFrame:
    """``doc_id, n_lines, n_dropped, kept_sha256`` of ``dedup_lines``."""
    return dedup_lines(docs).select("doc_id", "n_lines", "n_dropped", F.sha2(F.col("text").cast("binary"), 256).alias("kept_sha256"))
