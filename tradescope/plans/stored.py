"""Result tables of one stored version, for reports that read what the last refresh wrote."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession

from tradescope.plans.tables import RESULT_TABLES, Tables
from tradescope.sinks import refresh as sink


class StoredTables(Tables):
    """``Tables`` bound to one version under ``root``: reports on result tables read its files and scan no trades.

    ``open`` holds the version, so that refreshes neither change nor prune what the
    reports read; ``close`` (or the end of a ``with`` block) gives it back. A table is
    read when a report first asks for it. Reports on single trades need ``trades``.
    """

    def __init__(self, spark: SparkSession, root: str, version: str, trades: DataFrame | None = None, lease: str | None = None):
        about = sink.about_version(spark, root, version)
        if about is None:
            raise FileNotFoundError(f"version {version} is not under {root}")
        super().__init__(trades, about["variant"], as_of=dt.datetime.fromisoformat(about["as_of"]) if about["as_of"] else None)
        self.spark, self.root, self.version, self.lease = spark, root, version, lease

    @classmethod
    def open(cls, spark: SparkSession, root: str, version: str | None = None, trades: DataFrame | None = None) -> "StoredTables":
        found, lease = sink.hold_version(spark, root, version)
        return cls(spark, root, found, trades, lease)

    def close(self) -> None:
        if self.lease is not None:
            sink.release_version(self.spark, self.lease)
            self.lease = None
        self.release()

    def __enter__(self) -> "StoredTables":
        return self

    def __exit__(self, *_) -> None:
        self.close()

    def table(self, name: str) -> DataFrame:
        if name not in self.__dict__:
            self.__dict__[name] = sink.read_table_of(self.spark, self.root, self.version, name)
        return self.__dict__[name]

    def risk_rows(self, kind: str) -> DataFrame:
        return self.risk_metrics.where(f"metric_type = '{kind}'")

    @property
    def trades(self) -> DataFrame:
        if self._trades is None:
            raise ValueError("this report reads single trades: open the version with trades=...")
        return self._trades

    @trades.setter
    def trades(self, trades: DataFrame | None) -> None:
        self._trades = trades


def _stored(name: str) -> property:
    return property(lambda self: self.table(name))


for _name in RESULT_TABLES:
    setattr(StoredTables, _name, _stored(_name))
