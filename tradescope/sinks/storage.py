"""Hadoop FileSystem access for paths on shared storage (HDFS, object stores or local)."""

from __future__ import annotations

from pyspark.sql import DataFrameWriter, SparkSession


def filesystem(spark: SparkSession, path: str):
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    return p.getFileSystem(spark._jsc.hadoopConfiguration()), p


def exists(spark: SparkSession, path: str) -> bool:
    fs, p = filesystem(spark, path)
    return bool(fs.exists(p))


def list_dirs(spark: SparkSession, path: str) -> list[tuple[str, int]]:
    """(name, modification time) of the sub-directories of ``path``."""
    if not exists(spark, path):
        return []
    fs, p = filesystem(spark, path)
    return [(st.getPath().getName(), st.getModificationTime()) for st in fs.listStatus(p) if st.isDirectory()]


def list_files(spark: SparkSession, path: str) -> list[str]:
    if not exists(spark, path):
        return []
    fs, p = filesystem(spark, path)
    return sorted(st.getPath().getName() for st in fs.listStatus(p) if st.isFile())


def delete(spark: SparkSession, path: str) -> None:
    fs, p = filesystem(spark, path)
    if fs.exists(p):
        fs.delete(p, True)


def rename(spark: SparkSession, src: str, dst: str) -> None:
    fs, a = filesystem(spark, src)
    if not fs.rename(a, filesystem(spark, dst)[1]):
        raise OSError(f"cannot rename {src} to {dst}")


def read_text(spark: SparkSession, path: str) -> str | None:
    if not exists(spark, path):
        return None
    fs, p = filesystem(spark, path)
    stream = fs.open(p)
    try:
        reader = spark._jvm.java.io.BufferedReader(spark._jvm.java.io.InputStreamReader(stream, "UTF-8"))
        line = reader.readLine()
        return None if line is None else str(line)
    finally:
        stream.close()


def write_text(spark: SparkSession, path: str, text: str) -> None:
    fs, p = filesystem(spark, path)
    out = fs.create(p, True)
    try:
        out.write(bytearray(text.encode("utf-8")))
    finally:
        out.close()


def write_parquet(writer: DataFrameWriter, path: str) -> None:
    """A new folder of Parquet files."""
    writer.parquet(path)
