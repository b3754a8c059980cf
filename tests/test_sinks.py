"""Refresh, ledger, upsert, subtype overwrite, history and the streaming store."""

import datetime as dt
import os
import uuid

import pytest
from pyspark.sql import functions as F

from helpers import frame, trade
from tradescope.session import shared_path
from tradescope.sinks import logtable, manifest, storage
from tradescope.sinks import refresh as sink
from tradescope.streaming import incremental as inc


def _root(spark):
    return shared_path(spark, f"test-{uuid.uuid4().hex[:8]}")


def _rows(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


def test_refresh_runs_history_and_late_closer(spark):
    root = _root(spark)
    rows = [trade(i, float(i % 3 - 1)) for i in range(2, 12)]
    run = sink.refresh(spark, frame(spark, rows), root, as_of=dt.datetime(2024, 1, 1))
    assert run["status"] == "completed" and run["records_processed"] == 10 and run["last_trade_id"] == 11
    assert sink.processed_so_far(spark, root) == (11, 10)
    assert sink.refresh(spark, frame(spark, rows), root)["status"] == "skipped"
    # A trade with a lower id closes late: new, though the id cursor has passed it.
    rows.append(trade(1, 2.0))
    late = sink.refresh(spark, frame(spark, rows), root, as_of=dt.datetime(2024, 1, 2))
    assert late["status"] == "completed" and late["records_processed"] == 1
    ledger = sink.read_ledger(spark, root).collect()
    assert [r.status for r in ledger] == ["completed", "completed"] and sorted(r.closed_trades for r in ledger) == [10, 11]
    result = sink.read_result(spark, root, "performance_rankings").first()
    assert result.trade_count == 11 and result.analysis_date == dt.datetime(2024, 1, 2)
    lag = sink.health_history_lag(sink.read_health_history(spark, root)).where("metric_name = 'total_trades'").orderBy("analysis_date").collect()
    assert [r.previous_value for r in lag] == [None, 10.0] and lag[1].value_change == 1.0


def test_empty_refresh_is_readable(spark):
    root = _root(spark)
    sink.refresh(spark, frame(spark, []), root, full=True)
    assert sink.read_result(spark, root, "performance_rankings").count() == 0
    assert sink.read_result(spark, root, "duration_patterns").columns[-1] == "analysis_date"


def test_failed_run_keeps_version_history_and_whole_message(spark, monkeypatch):
    root = _root(spark)
    rows = [trade(i, 1.0) for i in range(1, 4)]
    sink.refresh(spark, frame(spark, rows), root, as_of=dt.datetime(2024, 1, 1))
    before = sink.current_version(spark, root)
    bad = frame(spark, rows + [trade(4, 1.0)]).withColumn("profit_pct", F.raise_error(F.lit("boom " * 1000)).cast("double"))
    with pytest.raises(Exception, match="boom"):
        sink.refresh(spark, bad, root)
    # A crash after the version is written and before the pointer moves.
    monkeypatch.setattr(sink, "_switch", lambda *a, **k: (_ for _ in ()).throw(RuntimeError("crash")))
    with pytest.raises(RuntimeError, match="crash"):
        sink.refresh(spark, frame(spark, rows + [trade(4, 1.0)]), root)
    assert sink.current_version(spark, root) == before
    assert sink.read_result(spark, root, "performance_rankings").first().trade_count == 3
    failed = sink.read_ledger(spark, root).where("status = 'failed'").collect()
    assert len(failed) == 2 and max(len(r.error_message) for r in failed) > 5000
    assert sink.read_health_history(spark, root).select("run").distinct().count() == 1


def test_pointer_always_names_a_version(spark):
    root = _root(spark)
    for k in range(5):
        sink._switch(spark, root, f"v{k}")
        assert sink.current_version(spark, root) == f"v{k}"
    assert len(storage.list_files(spark, os.path.join(root, "pointers"))) == 3


def test_upsert_and_subtype_overwrite(spark):
    schema = "metric_type string, entity_name string, v double"
    old = spark.createDataFrame([("var_analysis", "portfolio", 1.0), ("overall", None, 2.0), ("by_pair", "A", 3.0)], schema)
    new = spark.createDataFrame([("var_analysis", "portfolio", 9.0)], schema)
    assert {(r.metric_type, r.v) for r in sink.upsert(old, new, ["metric_type", "entity_name"]).collect()} == {("var_analysis", 9.0), ("overall", 2.0), ("by_pair", 3.0)}
    path = os.path.join(_root(spark), "rm")
    sink.overwrite_subtypes(old, path, "metric_type", ["var_analysis", "overall", "by_pair"])
    sink.overwrite_subtypes(new, path, "metric_type", ["var_analysis", "by_pair"])
    assert {(r.metric_type, r.v) for r in sink.read_subtypes(spark, path, old.schema).collect()} == {("var_analysis", 9.0), ("overall", 2.0)}
    assert [r.v for r in sink.read_subtypes(spark, path, old.schema, ["overall", "by_pair"]).collect()] == [2.0]


def test_log_table_replaces_runs_and_compacts(spark, monkeypatch):
    monkeypatch.setattr(logtable, "KEEP_FRESH", 3)
    path = os.path.join(_root(spark), "log")
    schema = spark.createDataFrame([], "k int").schema
    assert logtable.read(spark, path, schema).count() == 0
    for k in range(6):
        logtable.write_run(spark.createDataFrame([(k,)], schema), path, f"r{k}")
        logtable.write_run(spark.createDataFrame([(k + 10,)], schema), path, f"r{k}")
    logtable.write_run(spark.createDataFrame([(99,)], schema), path, "r0")  # a run that is already in the base
    assert _rows(logtable.read(spark, path, schema)) == [(11, "r1"), (12, "r2"), (13, "r3"), (14, "r4"), (15, "r5"), (99, "r0")]
    assert logtable.BASE in manifest.current(spark, path).parts(logtable.ROWS)


def test_csv_export(spark):
    path = os.path.join(_root(spark), "csv")
    sink.export_csv(frame(spark, [trade(1, 1.0)]).select("trade_id", "pair"), path)
    back = spark.read.option("header", True).csv(path).collect()
    assert back[0].pair == "BTC/USDT"


def _state(spark, root):
    return (
        _rows(inc.read_trades(spark, root)),
        _rows(sink.read_ledger(spark, root)),
        _rows(sink.read_health_history(spark, root)),
        _rows(inc.read_alerts(spark, root)),
        _rows(sink.read_result(spark, root, "strategy_performance")),
    )


def test_stream_empty_late_and_replayed(spark):
    root, date = _root(spark), dt.datetime(2024, 5, 1)
    empty = frame(spark, [trade(9, 1.0, is_open=True)])
    assert inc.process_batch_incremental(spark, empty, 0, root)["status"] == "skipped"
    b1 = frame(spark, [trade(5, 1.0), trade(6, -30.0), trade(6, -30.0)])
    inc.process_batch_incremental(spark, b1, 1, root, as_of=date)
    b2 = frame(spark, [trade(2, 1.0), trade(6, 7.0)])  # late id 2; id 6 is known, its first close stands
    inc.process_batch_incremental(spark, b2, 2, root, as_of=date + dt.timedelta(hours=1))
    first = _state(spark, root)
    assert [r[0] for r in first[0]] == [2, 5, 6] and len(first[1]) == 2 and len(first[2]) == 22
    assert any(r[5] for r in first[3])  # some status changed
    inc.process_batch_incremental(spark, b2, 2, root, as_of=date + dt.timedelta(hours=1))
    assert _state(spark, root) == first
    assert inc.process_batch_incremental(spark, b2, 3, root)["status"] == "skipped"
    assert inc.process_batch_incremental(spark, empty, 4, root)["status"] == "skipped"


def test_incremental_batches_equal_batch_build(spark, monkeypatch):
    from tools.check_oracle import digest
    from tradescope.plans.catalog import as_cells
    from tradescope.plans.tables import RESULT_TABLES, Tables

    monkeypatch.setattr(inc, "FANOUT", 2)  # several levels
    root, date = _root(spark), dt.datetime(2024, 5, 1)
    rows = [trade(i, [1.0, -1.0, 0.5, None, 2.0, -3.0][i % 6], pair=["A/X", "B/X"][i % 2], strategy=["s1", "s2", "s3"][i % 3]) for i in range(1, 41)]
    batches = [rows[20:], rows[:10], rows[5:20]]  # late ids and overlaps
    for bid, b in enumerate([*batches, batches[-1]]):
        inc.process_batch_incremental(spark, frame(spark, b).repartition(4), min(bid, 2), root, bucket_ids=4, as_of=date)  # the last one is a replay
    assert sorted(r.trade_id for r in inc.read_trades(spark, root).collect()) == list(range(1, 41))
    for part in manifest.current(spark, inc.state_path(root)).parts("trades").values():
        files = [f for f in storage.list_files(spark, os.path.join(inc.state_path(root), part)) if f.endswith(".parquet")]
        assert len(files) == 1  # not tasks x buckets
    state = manifest.current(spark, inc.state_path(root))
    assert len(state.parts("stats/0")) == 11 and len(inc.root_parts(state, "stats")) == len(inc.root_parts(state, "streaks")) == 1
    expected = Tables(frame(spark, rows), bucket_ids=4, as_of=date)
    for name in RESULT_TABLES:
        a, b = as_cells(expected.table(name), name), as_cells(sink.read_result(spark, root, name), name)
        assert digest(a.columns, [tuple(r) for r in a.collect()]) == digest(b.columns, [tuple(r) for r in b.collect()]), name


def test_processing_time_trigger(spark):
    """The five-minute cadence as a stream that keeps running, here every second."""
    import time

    from tradescope.streaming.stream import stream_refresh

    root = _root(spark)
    frame(spark, [trade(k, 1.0) for k in range(1, 4)]).write.parquet(f"{root}/source")
    query = stream_refresh(spark, f"{root}/source", f"{root}/out", f"{root}/checkpoint", available_now=False, interval="1 second", variant="poller")
    try:
        query.processAllAvailable()
        assert sink.read_result(spark, f"{root}/out", "performance_rankings").first().trade_count == 3
        frame(spark, [trade(9, 1.0)]).write.mode("append").parquet(f"{root}/source")
        until = time.time() + 60
        while time.time() < until and inc.read_trades(spark, f"{root}/out").count() < 4:
            query.processAllAvailable()
        assert query.isActive and sink.processed_so_far(spark, f"{root}/out") == (9, 4)
    finally:
        query.stop()


def test_an_update_of_one_table_does_not_count_as_a_refresh(spark):
    root = _root(spark)
    rows = [trade(i, 1.0) for i in range(1, 6)]
    sink.refresh(spark, frame(spark, rows[:3]), root)
    run = sink.refresh(spark, frame(spark, rows), root, names=["pair_analytics"])
    assert run["status"] == "completed" and sink.processed_so_far(spark, root) == (3, 3)
    assert sink.read_result(spark, root, "pair_analytics").first().total_trades == 5
    assert sink.read_result(spark, root, "performance_rankings").first().trade_count == 3
    assert sink.refresh(spark, frame(spark, rows), root)["status"] == "completed"
    assert sink.read_result(spark, root, "performance_rankings").first().trade_count == 5


def test_windows_for_any_order_of_arrival(spark):
    """Windows equal a batch group-by whatever the order, replays and empty batches included; late rows are counted."""
    import random

    from tradescope.streaming.stream import read_windows, revise_windows

    rows = [trade(i, [1.0, -2.0, None, 0.5][i % 4], strategy=["a", "b"][i % 3 == 0]) for i in range(1, 61)] + [trade(99, 1.0, close_date=None), trade(98, 1.0, is_open=True)]
    whole = _root(spark)
    revise_windows(frame(spark, rows), 0, whole)
    want = _rows(read_windows(spark, whole).drop("late_rows"))
    assert sum(r.trades for r in read_windows(spark, whole).collect()) == 60 and len(want) == 60
    for seed in range(2):
        random.Random(seed).shuffle(rows)
        root = _root(spark)
        for k, part in enumerate([rows[:20], rows[20:25], [], rows[25:]]):
            revise_windows(frame(spark, part), k, root)
            revise_windows(frame(spark, part), k, root)
        got = read_windows(spark, root)
        assert _rows(got.drop("late_rows")) == want
        assert 0 < got.agg(F.sum("late_rows")).first()[0] < 60


def test_several_bots_through_refresh(spark):
    """Colliding ids, a bot without losers, a null pair: each bot's tables equal those of the bot alone."""
    from tradescope.plans.bots import BotTables
    from tradescope.plans.catalog import as_cells
    from tradescope.plans.tables import RESULT_TABLES, Tables
    from tradescope.sources.trades import union_bots
    from tools.check_oracle import digest

    date = dt.datetime(2024, 5, 1)
    one = frame(spark, [trade(i, [1.0, -1.0, 0.5, None][i % 4], pair=["A/X", "B/X"][i % 2], strategy=["s1", "s2"][i % 3 == 0]) for i in range(1, 25)])
    two = frame(spark, [{**trade(i, 2.0), "pair": None} if i == 3 else trade(i, 1.0 + i) for i in range(1, 9)] + [trade(50, -9.0, is_open=True)])
    both, root = union_bots({"one": one, "two": two}), _root(spark)
    sink.refresh(spark, both, root, as_of=date)
    history = sink.read_health_history(spark, root)
    assert {(r.bot_id, r.n) for r in history.groupBy("bot_id").agg(F.count("*").alias("n")).collect()} == {("one", 11), ("two", 11)}
    assert "bot_id" in sink.health_history_lag(history, bots=True).columns
    for bot, alone in (("one", one), ("two", two)):
        tables = Tables(alone, as_of=date)
        for name in RESULT_TABLES:
            a = as_cells(tables.table(name), name)
            b = as_cells(sink.read_result(spark, root, name).where(F.col("bot_id") == bot).drop("bot_id"), name)
            assert digest(a.columns, [tuple(r) for r in a.collect()]) == digest(b.columns, [tuple(r) for r in b.collect()]), (bot, name)
    assert BotTables(both.where("bot_id = 'three'"), as_of=date).table("pair_analytics").collect() == []


def test_corrected_and_reopened_trades_change_all_tables(spark, monkeypatch):
    """Extremes, runs, VaR and counts after corrections are those of the trades that are left; no full refresh."""
    from tools.check_oracle import digest
    from tradescope.plans.catalog import as_cells
    from tradescope.plans.tables import RESULT_TABLES, Tables

    monkeypatch.setattr(inc, "FANOUT", 2)
    root, date = _root(spark), dt.datetime(2024, 5, 1)
    rows = {i: trade(i, [1.0, -1.0, 0.5, 2.0, -3.0][i % 5], pair=["A/X", "B/X"][i % 2], strategy=["s1", "s2"][i % 3 == 0]) for i in range(1, 31)}
    rows[7] = trade(7, 99.0, pair="C/Y")  # the best trade, the only one of its pair
    rows[8] = trade(8, -90.0, trade_duration=None)
    step = lambda batch, k: inc.store_batch(spark, frame(spark, batch), k, root, 4, "sql", corrections=True)
    step(list(rows.values()), 0)
    changed = [trade(7, 0.25, pair="A/X"), trade(8, -0.5), trade(9, 1.0, is_open=True, close_date=None), trade(40, -2.0), rows[12], trade(77, 1.0, is_open=True)]
    assert step(changed, 1).notes["new"] == 3
    rows |= {7: changed[0], 8: changed[1], 40: changed[3]}
    del rows[9]
    again = [trade(9, -4.0)]
    step(again, 2)
    rows[9] = again[0]
    assert step([rows[20], trade(77, 5.0, is_open=True)], 3) is None
    reopened = [trade(i, 0.0, is_open=True) for i in (13, 14, 15)]  # most of a bucket
    inc.process_batch_incremental(spark, frame(spark, reopened), 4, root, bucket_ids=4, as_of=date, corrections=True)
    for i in (13, 14, 15):
        del rows[i]
    assert sorted(r.trade_id for r in inc.read_trades(spark, root).collect()) == sorted(rows)
    assert sink.processed_so_far(spark, root)[1] == len(rows)
    expected = Tables(frame(spark, list(rows.values())), bucket_ids=4, as_of=date)
    for name in RESULT_TABLES:
        a, b = as_cells(expected.table(name), name), as_cells(sink.read_result(spark, root, name), name)
        assert digest(a.columns, [tuple(r) for r in a.collect()]) == digest(b.columns, [tuple(r) for r in b.collect()]), name


def test_stored_leaves_take_in_the_batch_alone(spark, monkeypatch):
    root, seen = _root(spark), []
    plain = inc.grain_stats
    monkeypatch.setattr(inc, "grain_stats", lambda df, **k: (seen.append(df.count()), plain(df, **k))[1])
    first, second = [trade(i, float(i % 5 - 3)) for i in range(1, 41)], [trade(i, float(i % 7 - 4), pair="ETH/USDT") for i in range(41, 51)]
    inc.process_batch_incremental(spark, frame(spark, first), 0, root, corrections=True, as_of=dt.datetime(2024, 1, 1))
    inc.process_batch_incremental(spark, frame(spark, second), 1, root, corrections=True, as_of=dt.datetime(2024, 1, 2))
    assert seen == [40, 10]
    # A trade that opens again is taken out of its bucket, which is then counted anew.
    inc.process_batch_incremental(spark, frame(spark, [trade(2, None, is_open=True, close_date=None)]), 2, root, corrections=True, as_of=dt.datetime(2024, 1, 3))
    assert seen == [40, 10, 49]
    whole = _root(spark)
    left = frame(spark, [r for r in first + second if r["trade_id"] != 2])
    sink.refresh(spark, left, whole, full=True, as_of=dt.datetime(2024, 1, 3))
    for name in ("bot_health_metrics", "risk_metrics", "strategy_performance", "pair_analytics"):
        assert _rows(sink.read_result(spark, root, name).drop("last_calculation")) == _rows(sink.read_result(spark, whole, name).drop("last_calculation"))


def test_arrivals_read_stored_trades(spark, tmp_path):
    from tradescope.plans import catalog
    from tradescope.plans.tables import Tables
    from tradescope.sources.trades import trades_from_events

    rows = [(i, dt.datetime(2024, 1, 1) + dt.timedelta(minutes=i), 1, "click", float(i), f'{{"k": {i % 100}}}') for i in range(300)]
    events = spark.createDataFrame(rows, "event_id long, ts timestamp_ntz, user_id long, event_type string, value double, props string")
    events.write.parquet(f"{tmp_path}/events.parquet")
    trades = trades_from_events(spark.read.parquet(f"{tmp_path}/events.parquet"))
    # The JSON is parsed once for all columns that need it.
    assert trades._jdf.queryExecution().optimizedPlan().toString().count("get_json_object") == 1
    parts = catalog._parts(Tables(trades), 3)
    assert all("get_json_object" not in p._jdf.queryExecution().optimizedPlan().toString() for p in parts)
    assert sorted(r[0] for p in parts for r in p.select("trade_id").collect()) == [i + 1 for i in range(300) if i % 20 != 19]
