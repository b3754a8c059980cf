"""Small helpers that several corpus operators share."""

from __future__ import annotations

import hashlib
import uuid
from collections.abc import Callable, Iterable, Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tradescope.session import ensure_checkpoint_dir


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


#: Spark's own setting: an execution's shuffle files are deleted when it ends.
FREE_SHUFFLES = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def cut(df: DataFrame, by: Sequence[str] = (), free: bool = False) -> DataFrame:
    """Write ``df`` as a table in the shared checkpoint folder and read it back, which cuts its lineage.

    Unlike ``checkpoint()``, the table brings its true size with it; estimates
    carried through the joins of an iteration would multiply without end.
    The tables stay until ``drop_cuts`` or the folder's own retention. The columns
    ``by`` become folders, so that a filter on them reads its own files only. With
    ``free`` the shuffle files of the write go as soon as the table stands, so that
    steps in turn need the disk of the largest one and not of all.
    """
    spark = df.sparkSession
    path = f"{ensure_checkpoint_dir(spark).rstrip('/')}/cut-{uuid.uuid4().hex}"
    before = spark.conf.get(FREE_SHUFFLES)
    spark.conf.set(FREE_SHUFFLES, "true" if free else before)
    try:
        df.write.partitionBy(*by).parquet(path)
    finally:
        spark.conf.set(FREE_SHUFFLES, before)
    CUTS.append(path)
    return spark.read.schema(df.schema).parquet(path)


#: Tables that this driver has written with ``cut``.
CUTS: list[str] = []


def drop_cuts(spark: SparkSession) -> None:
    """Delete the tables of ``cut``; call it once results that were built on them are written."""
    while CUTS:
        forget(spark, CUTS.pop())


def forget(spark: SparkSession, path: str) -> None:
    """Delete a table that this driver has written."""
    folder = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    folder.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(folder, True)


def dealt(df: DataFrame) -> DataFrame:
    """``df`` as a side of a join that deals both sides by their keys and broadcasts neither.

    Spark sizes an exploded table by its rows before the explosion, and a stored one by its
    compressed files, so it takes a side for small that the driver's memory cannot hold.
    """
    return df.hint("merge")


def documents_of(df: DataFrame) -> DataFrame:
    """Only ``doc_id`` and ``text`` (null: empty); every other column is pruned."""
    return df.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce(F.col("text"), F.lit("")).alias("text"))


def keyed(docs: DataFrame) -> DataFrame:
    """``doc_id, t1, t2, text`` (null: empty): rows that are equal in the first three have the same text."""
    text = F.coalesce(F.col("text"), F.lit(""))
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.xxhash64(text).alias("t1"), F.xxhash64(F.lit(1), text).alias("t2"), text.alias("text"))


def same_row(a: str, b: str) -> Column:
    """Rows of ``keyed`` under two aliases are equal; null ids equal each other."""
    return F.col(f"{a}.doc_id").eqNullSafe(F.col(f"{b}.doc_id")) & (F.col(f"{a}.t1") == F.col(f"{b}.t1")) & (F.col(f"{a}.t2") == F.col(f"{b}.t2"))


ROWS_AT_ONCE = 1024


def map_rows(df: DataFrame, fn: Callable[[dict[str, list]], dict[str, list]], schema: str) -> DataFrame:
    """``mapInArrow`` with plain Python columns: ``fn`` gets and returns a dict of lists per record batch.

    Rows stay in the scan's partitions, so no key, source or group of copies
    can gather in one task. ``ROWS_AT_ONCE`` bounds what is held as Python objects.
    """
    out = df.sparkSession.createDataFrame([], schema).schema
    from pyspark.sql.pandas.types import to_arrow_schema

    arrow = to_arrow_schema(out)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for k in range(0, b.num_rows, ROWS_AT_ONCE):
                yield pa.RecordBatch.from_pydict(fn(b.slice(k, ROWS_AT_ONCE).to_pydict()), schema=arrow)

    return df.mapInArrow(run, out)


def sha256_hex(text: str) -> str:
    """Lowercase hex digest of the UTF-8 form; a lone surrogate cannot occur in Spark's strings."""
    return hashlib.sha256(text.encode("utf-8", "surrogatepass")).hexdigest()


def span_list(spans: Iterable[tuple[str, int, int]]) -> str:
    return ",".join(f"{kind}:{start}:{end}" for kind, start, end in spans)
