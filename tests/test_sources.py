"""Source helpers: loose-type conformance and multi-bot union (SRC-1, SRC-5)."""

from pyspark.sql import functions as F

from helpers import frame, trade
from tradescope.plans.tables import Tables
from tradescope.sources.trades import TRADE_COLUMNS, conform, jdbc_options, normalize_trades, rejects, to_upstream, union_bots


def test_conform_parses_text_and_rejects_garbage(spark):
    raw = spark.createDataFrame(
        [("1", "BTC/USDT", "0", "s", "1.5", "2024-01-01 10:00:00"), ("2", "ETH/USDT", "1", "s", "oops", "not a date")],
        "trade_id string, pair string, is_open string, strategy string, profit_pct string, open_date string",
    )
    rows = conform(raw).orderBy("trade_id").collect()
    assert rows[0].trade_id == 1 and rows[0].is_open is False and rows[0].profit_pct == 1.5 and rows[0].open_date.hour == 10
    assert rows[1].is_open is True and rows[1].profit_pct is None and rows[1].open_date is None
    assert conform(raw).columns == TRADE_COLUMNS


def test_union_bots_one_analysis_each(spark):
    a = frame(spark, [trade(i, 1.0) for i in range(1, 4)])
    b = frame(spark, [trade(i, -1.0) for i in range(1, 6)])
    both = union_bots({"bot_a": a, "bot_b": b})
    per_bot = {
        bot: Tables(both.where(F.col("bot_id") == bot)).performance_rankings.first()
        for bot in ("bot_a", "bot_b")
    }
    assert per_bot["bot_a"].trade_count == 3 and per_bot["bot_a"].win_rate == 1.0
    assert per_bot["bot_b"].trade_count == 5 and per_bot["bot_b"].win_rate == 0.0


def test_flags_in_any_spelling_and_reject_counts(spark):
    words = ["TRUE", "t", "1", "Yes", "false", "F", "0", " no ", "maybe", None]
    raw = to_upstream(frame(spark, [trade(i, 1.0) for i in range(len(words))]))
    spelt = F.element_at(F.array(*[F.lit(w) for w in words]), (F.col("id") + 1).cast("int"))
    raw = raw.withColumn("is_open", spelt).withColumn("close_profit", F.when(F.col("id") == 3, "x").otherwise(F.col("close_profit").cast("string")))
    got = [r.is_open for r in normalize_trades(raw).orderBy("trade_id").collect()]
    assert got == [True] * 4 + [False] * 4 + [None] * 2
    counts = rejects(raw, normalize_trades).first()
    assert counts.rows_read == 10 and counts.is_open_rejected == 1 and counts.profit_pct_rejected == 1 and counts.open_date_rejected == 0


def test_jdbc_read_is_in_ranges():
    assert "partitionColumn" not in jdbc_options("u")
    assert jdbc_options("u", "t", (5, 904), 8) == {"url": "u", "dbtable": "t", "partitionColumn": "trade_id", "lowerBound": "5", "upperBound": "905", "numPartitions": "8"}
