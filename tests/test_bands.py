"""Every report on hand-made trades that reach all bands, against the oracle's own thresholds and labels."""

import datetime as dt
import random

import duckdb
import pytest

from helpers import frame, trade
from oracle import values
from oracle.prelude import with_prelude
from oracle.queries import Q
from tools.check_oracle import digest
from tradescope.plans import catalog
from tradescope.plans.tables import Tables


def make_trades():
    """Pairs and strategies of all kinds; profits are multiples of 1/4, so sums are exact in any order."""
    rnd, rows = random.Random(5), []
    start = dt.datetime(2024, 1, 1)

    def add(pair, strategy, profit, minutes, level, reason, stake=64.0):
        at = start + dt.timedelta(hours=rnd.randint(0, 8000), minutes=rnd.randint(0, 59))
        money = None if profit is None else profit * stake / 128
        rows.append(
            trade(
                len(rows) + 1, profit, pair=pair, strategy=strategy, profit_abs=money, profit_ratio=None if profit is None else profit / 128,
                trade_duration=minutes, stop_loss_pct=level, exit_reason=reason, stake_amount=stake, open_date=at,
                close_date=None if minutes is None else at + dt.timedelta(minutes=minutes),
            )
        )

    minutes = [15, 45, 60, 61, 120, 300, 480, 481, 900, 1440, 1441, 3000, None]
    levels = [None, -0.5, -1.0, -2.0, -3.5, -5.0, -7.5, -10.0, -12.0, -15.0, -22.0, -40.0]
    for k in range(64):  # from hopeless to excellent, from one trade to many, from calm to wild
        share, n, swing = (k % 9) / 8, [1, 2, 3, 5, 9, 12, 25, 60, 110][k // 8 % 9], [0.25, 1.0, 2.0, 4.0, 12.0, 30.0][k % 6]
        for i in range(n):
            win = i < share * n
            size = rnd.randint(1, 4) * swing / 4
            profit = round((size if win else -size) * 4) / 4
            reason = "stop_loss" if not win and rnd.random() < (k % 5) / 4 else rnd.choice(["roi", "exit_signal", None])
            add(f"C{k % 8}/Q{k // 8}", f"s{k % 7}", profit, minutes[(k + i) % 13], levels[(k * 5 + i // 3) % 12], reason, 16.0 * (1 + k % 4))
    for i in range(20):  # wins often and earns nothing; wins rarely
        add("WIN/Q", "steady", 0.25 if i % 10 else -4.0, 30, -2.0, "roi")
        add("ONE/Q", "calm", 1.0, 2000, -5.0, "roi")
        add("SL/Q", "guard", -2.0 if i % 2 else 3.0, 700, -2.0, "stop_loss" if i % 2 else "roi")
        add("BRISK/Q", "brisk", 1.0 if i % 2 else -1.0, 120, -2.0, "roi")
        add("CUT/Q", "late", -12.0, 5000, -12.0, "stop_loss")
    add("NIL/Q", "none", None, None, None, None)
    rows.append(trade(len(rows) + 1, None, is_open=True))
    return rows


ROWS = make_trades()


@pytest.fixture(scope="module")
def both(spark):
    df = frame(spark, ROWS)
    con = duckdb.connect()
    con.register("hand_arrow", df.toArrow())
    con.execute("CREATE TABLE hand_trades AS SELECT * FROM hand_arrow")
    return Tables(df, as_of=catalog.AS_OF).persist_results(), con


def answers(both, name):
    tables, con = both
    df = catalog.run(name, tables)
    res = con.execute(with_prelude(Q[name], "hand_trades"))
    cols = [d[0] for d in res.description]
    rows = res.fetchall()
    return df.columns, [tuple(r) for r in df.collect()], cols, rows


@pytest.mark.parametrize("name", sorted({*catalog.REPORTS, *catalog.BUILDERS, *catalog.POLLER} - {"src_normalize_trades"}))
def test_report_on_hand_made_trades(both, name):
    columns, got, cols, want = answers(both, name)
    assert sorted(columns) == sorted(cols)
    assert digest(columns, got) == digest(cols, want)


BANDED = {
    "pr_winrate_distribution": "WINRATE_BANDS",
    "sp_duration_distribution": "STRATEGY_DURATION_BANDS",
    "pa_winrate_bands": "PAIR_WINRATE_BANDS",
    "pr_profit_distribution": "PROFIT_BANDS",
}


@pytest.mark.parametrize("name", sorted(BANDED))
def test_every_label_occurs(both, name):
    _, got, _, _ = answers(both, name)
    seen = {v for r in got for v in r if isinstance(v, str)}
    assert {label for _, _, label in getattr(values, BANDED[name])} <= seen


@pytest.mark.parametrize("name", ["sp_consistency_distribution", "pa_volatility_bands", "pa_frequency_bands", "sl_level_bands", "rm_volatility_vs_perf"])
def test_several_bands_occur(both, name):
    assert len(answers(both, name)[1]) >= 3


def test_high_win_low_profit_has_rows(both):
    assert any("WIN/Q" in r for r in answers(both, "pr_high_win_low_profit")[1])
