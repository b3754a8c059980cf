"""A writer that stops between any two file operations, and its replay."""

import datetime as dt
import itertools
import os
import shutil
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import frame, trade
from tradescope.operators.risk import build_risk_var
from tradescope.session import shared_path
from tradescope.sinks import logtable, manifest, storage
from tradescope.sinks import refresh as sink
from tradescope.streaming import incremental as inc

CHANGING = ("write_text", "rename", "delete", "write_parquet")


class Stop(Exception):
    pass


@pytest.fixture
def stop_after(monkeypatch):
    """Lets ``n`` changing file operations through; the next one stops the writer."""
    real = {name: getattr(storage, name) for name in CHANGING}

    def arm(n):
        count = itertools.count()

        def wrap(name):
            def call(*args, **kw):
                if next(count) >= n:
                    raise Stop
                return real[name](*args, **kw)

            return call

        for name in CHANGING:
            monkeypatch.setattr(storage, name, wrap(name))

    def disarm():
        for name in CHANGING:
            monkeypatch.setattr(storage, name, real[name])

    return arm, disarm


def _root(spark):
    return shared_path(spark, f"crash-{uuid.uuid4().hex[:8]}")


def _until_done(spark, stop_after, start, act, check):
    """Stops ``act`` before each of its operations in turn, each time on a copy of ``start``, and checks what is left."""
    arm, disarm = stop_after
    for n in itertools.count():
        root = _root(spark)
        shutil.copytree(_local(start), _local(root))
        arm(n)
        try:
            act(root)
            finished = True
        except Stop:
            finished = False
        disarm()
        check(n, root)
        if finished:
            return n


def _local(path):
    return path.removeprefix("file:")


def test_subtype_overwrite(spark, stop_after):
    schema = "kind string, v int"
    old = spark.createDataFrame([("a", 1), ("b", 2), ("c", 3)], schema)
    new = spark.createDataFrame([("a", 9)], schema)
    before, after = {("a", 1), ("b", 2), ("c", 3)}, {("a", 9), ("c", 3)}
    start = _root(spark)
    sink.overwrite_subtypes(old, start, "kind", ["a", "b", "c"])
    act = lambda path: sink.overwrite_subtypes(new, path, "kind", ["a", "b"])

    def check(n, path):
        rows = lambda: {tuple(r) for r in sink.read_subtypes(spark, path, old.schema).collect()}
        assert rows() in (before, after)
        act(path)
        assert rows() == after

    assert _until_done(spark, stop_after, start, act, check) >= 3


def _values(spark, root):
    """The committed state of the store, as rows."""
    state = manifest.current(spark, inc.state_path(root))
    known = inc.current_summaries(spark, root, state, "sql")
    ranges, values = known.losers
    rows = lambda df: [] if df is None else sorted(map(str, df.collect()))
    return rows(inc.read_trades(spark, root)), rows(ranges), rows(values.groupBy("v").agg(F.sum("n"))), rows(known.streaks), rows(known.stats), state.notes


def test_stream_state(spark, stop_after):
    """Trades, streaks, statistics and rank index all change together, at every level of their trees."""
    rows = [trade(i, [1.0, -1.0, 0.5, -2.0][i % 4], pair=["A/X", "B/X"][i % 2]) for i in range(1, 13)]
    first, second = frame(spark, rows[4:9]).checkpoint(), frame(spark, rows[:6] + rows[8:]).checkpoint()
    store = lambda root, batch, k: inc.store_batch(spark, batch, k, root, 8, "sql")
    start, good = _root(spark), _root(spark)
    store(start, first, 0)
    before = manifest.current(spark, inc.state_path(start))
    shutil.copytree(_local(start), _local(good))
    store(good, second, 1)
    after = _values(spark, good)
    assert len(after[0]) == 12 and after[-1] == {"batch": 1, "new": 7, "top": 12, "closed": 12}

    def check(n, root):
        path = inc.state_path(root)
        state = manifest.current(spark, path)
        # The former state as it was, or the new one; every part that it names is there.
        assert state == before or state.notes == after[-1]
        assert all(storage.exists(spark, os.path.join(path, p)) for t in state.tables.values() for p in t.values())
        if n % 6 == 0 or state != before:
            store(root, second, 1)
            assert _values(spark, root) == after
        # Nothing that no manifest names stays behind the next writer.
        manifest.begin(spark, path)
        named = {p.split("/")[1] for k in storage.list_files(spark, f"{path}/manifests") if k[0] != "." for t in manifest._load(spark, path, k).tables.values() for p in t.values()}
        assert {name for name, _ in storage.list_dirs(spark, f"{path}/data")} == named

    assert _until_done(spark, stop_after, start, lambda root: store(root, second, 1), check) >= 8


def test_log_run_keeps_its_rows(spark, stop_after, monkeypatch):
    monkeypatch.setattr(logtable, "KEEP_FRESH", 2)
    schema = spark.createDataFrame([], "k int").schema
    start = _root(spark)
    for k in range(2):
        logtable.write_run(spark.createDataFrame([(k,)], schema), start, f"r{k}")
    act = lambda path: logtable.write_run(spark.createDataFrame([(7,)], schema), path, "r2")

    def check(n, path):
        rows = lambda: {tuple(r) for r in logtable.read(spark, path, schema).collect()}
        assert {(0, "r0"), (1, "r1")} <= rows() <= {(0, "r0"), (1, "r1"), (7, "r2")}
        act(path)
        assert rows() == {(0, "r0"), (1, "r1"), (7, "r2")}

    assert _until_done(spark, stop_after, start, act, check) >= 5


def test_a_batch_reads_no_stored_loser(spark, monkeypatch):
    """VaR of the stream comes from the rank index: the same value as from the trades."""
    import random

    monkeypatch.setattr(inc, "FANOUT", 2)
    rnd = random.Random(2)
    root, rows = _root(spark), [trade(i, round(rnd.uniform(-9, 3), 2)) for i in range(1, 400)]
    seen = []
    nothing = frame(spark, []).withColumn("profit_pct", F.raise_error(F.lit("a trade was read")).cast("double"))
    for k in range(3):
        seen += rows[k::3]
        state = inc.store_batch(spark, frame(spark, rows[k::3]), k, root, 64, "poller")
        known = inc.current_summaries(spark, root, state, "poller")
        losing = sorted(r["profit_pct"] for r in seen if r["profit_pct"] < 0)
        assert build_risk_var(nothing, index=known.losers).first().var_95_pct == losing[int(len(losing) * 0.05)]


def test_a_held_version_outlives_refreshes(spark, monkeypatch):
    from tradescope.plans.stored import StoredTables

    root, rows = _root(spark), [trade(i, float(i % 3 - 1)) for i in range(1, 13)]
    names = ["performance_rankings", "pair_analytics"]
    sink.refresh(spark, frame(spark, rows[:6]), root, as_of=dt.datetime(2024, 1, 1), names=names)
    with StoredTables.open(spark, root) as held:
        trades = held.performance_rankings
        for k in range(7, 11):
            sink.refresh(spark, frame(spark, rows[:k]), root, names=["performance_rankings"], keep_versions=1)
        assert trades.first().trade_count == 6 and held.as_of == dt.datetime(2024, 1, 1)
        newer = StoredTables.open(spark, root)
        # The table that was not updated comes from the first version.
        assert newer.performance_rankings.first().trade_count == 10 and newer.pair_analytics.first().total_trades == 6
        newer.close()
        with pytest.raises(ValueError, match="single trades"):
            _ = held.closed
        with pytest.raises(FileNotFoundError):
            _ = held.bot_health_metrics
    assert storage.list_files(spark, os.path.join(root, "leases")) == []
    assert len(sink.prune_versions(spark, root, 1)) == 0  # the first version still holds pair_analytics
    # A hold that its reader never gave back runs out.
    _, lease = sink.hold_version(spark, root)
    monkeypatch.setattr(sink, "LEASE_SECONDS", 0)
    assert sink.held_versions(spark, root) == set() and not storage.exists(spark, lease)


def test_a_version_pruned_while_it_is_opened(spark, monkeypatch):
    root, rows = _root(spark), [trade(i, 1.0) for i in range(1, 5)]
    sink.refresh(spark, frame(spark, rows[:2]), root, names=["pair_analytics"])
    gone = sink.current_version(spark, root)
    sink.refresh(spark, frame(spark, rows), root, names=["pair_analytics"], keep_versions=1)
    answers = iter([gone, sink.current_version(spark, root)])
    monkeypatch.setattr(sink, "current_version", lambda *_: next(answers))
    version, _ = sink.hold_version(spark, root)
    assert version != gone
    with pytest.raises(FileNotFoundError):
        sink.hold_version(spark, root, gone)
