"""The shared-statistics refresh path equals the per-table path."""

from tools.check_oracle import digest
from tradescope.plans import catalog
from tradescope.plans.catalog import AS_OF, comparable
from tradescope.plans.tables import RESULT_TABLES, Tables

RISK_REPORTS = "rm_overall rm_sl_by_pair rm_strategy_compare rm_high_risk_pairs rm_risk_adjusted rm_sl_eff_distribution rm_volatility_vs_perf doc_high_risk".split()


def test_persisted_tables_equal_lazy(spark, sf001):
    lazy = Tables(sf001, as_of=AS_OF)
    shared = Tables(sf001, as_of=AS_OF).persist_results()
    try:
        for name in RESULT_TABLES:
            a = comparable(lazy.table(name))
            b = comparable(shared.table(name))
            ra = [tuple(r) for r in a.collect()]
            rb = [tuple(r) for r in b.select(*a.columns).collect()]
            assert digest(a.columns, ra)[0] == digest(a.columns, rb)[0], name
    finally:
        shared.release()


def test_building_a_plan_runs_no_job(spark, sf001):
    from tradescope.plans import reports

    tracker = spark.sparkContext.statusTracker()
    sf001.count()
    spark.sparkContext.setJobGroup("plan", "plan only")
    try:
        t = Tables(sf001, as_of=AS_OF)
        plans = [reports.pr_top10(t), reports.sp_ranking(t), reports.dp_overall(t), reports.bh_dashboard(t), t.timing_analysis]
        plans += [getattr(reports, n)(t) for n in RISK_REPORTS]
        plans += [catalog.CATALOG[n](t) for n in ("build_risk_overall", "build_risk_by_pair", "build_risk_by_strategy", "poll_risk")]
        assert len(plans) == 17 and list(tracker.getJobIdsForGroup("plan")) == []
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    t.release()


def test_reports_over_a_stored_version(spark, sf001):
    """Every report that reads result tables gives the same rows from a stored version, and scans no trades."""
    import uuid

    from tradescope.plans.stored import StoredTables
    from tradescope.session import shared_path
    from tradescope.sinks.refresh import refresh

    root = shared_path(spark, f"stored-{uuid.uuid4().hex[:8]}")
    refresh(spark, sf001, root, as_of=AS_OF)
    live, stored_reports, on_trades = Tables(sf001, as_of=AS_OF).persist_results(), [], []
    with StoredTables.open(spark, root) as stored:
        for name, report in catalog.REPORTS.items():
            try:
                df = report(stored)
            except ValueError:  # reads single trades
                on_trades.append(name)
                continue
            stored_reports.append(name)
            want = report(live)
            assert digest(df.columns, [tuple(r) for r in df.collect()]) == digest(want.columns, [tuple(r) for r in want.collect()]), name
    live.release()
    assert len(stored_reports) > 80 and "doc_recent_trades" in on_trades


def test_rows_are_dated_with_the_time_of_the_query(spark, sf001):
    import datetime as dt

    before = dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    row = Tables(sf001).pair_analytics.first()
    assert before - dt.timedelta(seconds=1) <= row.analysis_date <= dt.datetime.now(dt.timezone.utc).replace(tzinfo=None)
    from tradescope import api

    assert api.build_pair_analytics(sf001, as_of=AS_OF).first().analysis_date == AS_OF
    assert set(api.__all__) == {f"build_{n}" for n in RESULT_TABLES}
    for name in RESULT_TABLES:
        assert "analysis_date" in getattr(api, f"build_{name}")(sf001, variant="poller", as_of=AS_OF).columns
