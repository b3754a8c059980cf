"""The ``trades`` fact table: schema, readers, normalisation and the closed filter.

Every analytic reads *closed* trades only; ``closed`` is the single place where
that filter is applied so Catalyst pushes it into the Parquet scan together
with the column pruning of whichever builder consumes it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

TRADES_SCHEMA = T.StructType(
    [
        T.StructField("trade_id", T.LongType(), False),
        T.StructField("pair", T.StringType(), True),
        T.StructField("base_currency", T.StringType(), True),
        T.StructField("quote_currency", T.StringType(), True),
        T.StructField("is_open", T.BooleanType(), True),
        T.StructField("strategy", T.StringType(), True),
        T.StructField("profit_pct", T.DoubleType(), True),
        T.StructField("profit_abs", T.DoubleType(), True),
        T.StructField("profit_ratio", T.DoubleType(), True),
        T.StructField("trade_duration", T.LongType(), True),
        T.StructField("exit_reason", T.StringType(), True),
        T.StructField("stop_loss_pct", T.DoubleType(), True),
        T.StructField("stake_amount", T.DoubleType(), True),
        T.StructField("open_date", T.TimestampNTZType(), True),
        T.StructField("close_date", T.TimestampNTZType(), True),
    ]
)

TRADE_COLUMNS = [f.name for f in TRADES_SCHEMA.fields]


def load_trades(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """SRC-1: read a trades table with the explicit schema (no inference)."""
    return spark.read.schema(TRADES_SCHEMA).format(fmt).load(path)


def jdbc_options(url: str, table: str = "trades", bounds: tuple[int, int] | None = None, partitions: int = 16) -> dict[str, str]:
    """Reader options; with ``bounds`` of ``trade_id`` the table is read in ``partitions`` ranges of it, else in one task."""
    options = {"url": url, "dbtable": table}
    if bounds is not None:
        options |= {"partitionColumn": "trade_id", "lowerBound": str(bounds[0]), "upperBound": str(bounds[1] + 1), "numPartitions": str(partitions)}
    return options


def load_trades_jdbc(
    spark: SparkSession, url: str, table: str = "trades", bounds: tuple[int, int] | None = None, partitions: int = 16, **options: str
) -> DataFrame:
    """SRC-1 over JDBC (e.g. a bot's SQLite file when its driver is on the classpath).

    Without ``bounds`` one small query asks the database for the least and the
    greatest ``trade_id``, so the read itself is always in ranges.
    """
    reader = spark.read.format("jdbc").options(**options)
    if bounds is None:
        ends = f"(SELECT MIN(trade_id) AS low, MAX(trade_id) AS high FROM {table}) ends"
        row = reader.options(**jdbc_options(url, ends)).load().first()
        bounds = None if row[0] is None else (int(row[0]), int(row[1]))
    return conform(spark.read.format("jdbc").options(**options, **jdbc_options(url, table, bounds, partitions)).load())


# Spellings of a flag, compared in lower case; anything else is unknown (NULL).
TRUE_WORDS = ("1", "true", "t", "yes", "y")
FALSE_WORDS = ("0", "false", "f", "no", "n")


def parse_flag(value: Column) -> Column:
    text = F.lower(F.trim(value.cast("string")))
    return F.when(text.isin(*TRUE_WORDS), True).when(text.isin(*FALSE_WORDS), False)


def parse_timestamp(value: Column) -> Column:
    return F.coalesce(value.try_cast(T.TimestampNTZType()), F.try_to_timestamp(value.cast("string")).cast(T.TimestampNTZType()))


def rejects(raw: DataFrame, parsed: DataFrame | None = None) -> DataFrame:
    """One row: how many rows came in and, per column ``<name>_rejected``, how many values did not parse.

    ``parsed`` is ``conform`` (default) or ``normalize_trades``; a value counts
    as rejected if it is present in its source column and NULL afterwards.
    """
    source = {n: n for n in TRADE_COLUMNS} if parsed is None or parsed is conform else UPSTREAM_OF
    made = (parsed or conform)(raw.select("*", F.struct("*").alias("__raw")), keep="__raw")
    lost = [
        F.count(F.when(F.col(f"__raw.{source[n]}").isNotNull() & F.col(n).isNull(), 1)).alias(f"{n}_rejected")
        for n in TRADE_COLUMNS
        if source.get(n) in raw.columns
    ]
    return made.agg(F.count(F.lit(1)).alias("rows_read"), *lost)


def conform(df: DataFrame, keep: str | None = None) -> DataFrame:
    """Cast a loosely typed trades frame to ``TRADES_SCHEMA``.

    Text numbers and dates are parsed with ``try_*`` casts so a malformed value
    becomes NULL instead of failing the job (SQLite tolerates them); ``rejects``
    counts them. ``keep`` names one more column to pass on.
    """
    cols = [] if keep is None else [F.col(keep)]
    for field in TRADES_SCHEMA.fields:
        if field.name not in df.columns:
            cols.append(F.lit(None).cast(field.dataType).alias(field.name))
            continue
        c = F.col(field.name)
        if isinstance(field.dataType, T.BooleanType):
            c = parse_flag(c)
        elif isinstance(field.dataType, T.TimestampNTZType):
            c = parse_timestamp(c)
        else:
            c = c.try_cast(field.dataType)
        cols.append(c.alias(field.name))
    return df.select(*cols)


def split_pair(pair: Column | str = "pair") -> tuple[Column, Column]:
    """SRC-3: ``BASE/QUOTE`` -> (base, quote)."""
    p = F.col(pair) if isinstance(pair, str) else pair
    return F.split_part(p, F.lit("/"), F.lit(1)), F.split_part(p, F.lit("/"), F.lit(2))


# Column of the bot's own table that each of ours is parsed from.
UPSTREAM_OF = {
    "trade_id": "id",
    "pair": "pair",
    "is_open": "is_open",
    "strategy": "strategy",
    "profit_pct": "close_profit",
    "profit_abs": "close_profit_abs",
    "profit_ratio": "close_profit",
    "exit_reason": "exit_reason",
    "stop_loss_pct": "stop_loss_pct",
    "stake_amount": "stake_amount",
    "open_date": "open_date_utc",
    "close_date": "close_date_utc",
}


def normalize_trades(raw: DataFrame, keep: str | None = None) -> DataFrame:
    """SRC-2: map the bot's own trade columns onto ``TRADES_SCHEMA``.

    id -> trade_id, close_profit -> profit_ratio (x100 -> profit_pct),
    close_profit_abs -> profit_abs, open/close_date_utc -> open/close_date,
    minutes between open and close -> trade_duration, pair split into
    base/quote. Values that do not parse become NULL; ``rejects`` counts them.
    """
    open_ts, close_ts = parse_timestamp(F.col("open_date_utc")), parse_timestamp(F.col("close_date_utc"))
    base, quote = split_pair("pair")
    return raw.select(
        *([] if keep is None else [F.col(keep)]),
        F.col("id").try_cast("long").alias("trade_id"),
        F.col("pair"),
        base.alias("base_currency"),
        quote.alias("quote_currency"),
        parse_flag(F.col("is_open")).alias("is_open"),
        F.col("strategy"),
        (F.col("close_profit").try_cast("double") * F.lit(100.0)).alias("profit_pct"),
        F.col("close_profit_abs").try_cast("double").alias("profit_abs"),
        F.col("close_profit").try_cast("double").alias("profit_ratio"),
        F.timestamp_diff("MINUTE", open_ts, close_ts).alias("trade_duration"),
        F.col("exit_reason"),
        F.col("stop_loss_pct").try_cast("double").alias("stop_loss_pct"),
        F.col("stake_amount").try_cast("double").alias("stake_amount"),
        open_ts.alias("open_date"),
        close_ts.alias("close_date"),
    )


def to_upstream(trades: DataFrame) -> DataFrame:
    """The inverse mapping: a ``trades`` frame in the bot's own column names."""
    return trades.select(
        F.col("trade_id").alias("id"),
        "pair",
        "is_open",
        "strategy",
        F.col("profit_ratio").alias("close_profit"),
        F.col("profit_abs").alias("close_profit_abs"),
        "exit_reason",
        "stop_loss_pct",
        "stake_amount",
        F.col("open_date").alias("open_date_utc"),
        F.col("close_date").alias("close_date_utc"),
    )


def closed(trades: DataFrame) -> DataFrame:
    """SRC-4: completed trades (``is_open = 0``)."""
    return trades.where(~F.col("is_open"))


def with_bot(trades: DataFrame, bot_id: str) -> DataFrame:
    """SRC-5: tag one bot's trades; union several with ``unionByName``."""
    return trades.withColumn("bot_id", F.lit(bot_id))


def union_bots(frames: dict[str, DataFrame]) -> DataFrame:
    out = None
    for bot_id, df in frames.items():
        tagged = with_bot(df, bot_id)
        out = tagged if out is None else out.unionByName(tagged)
    return out


def open_closed_counts(trades: DataFrame) -> DataFrame:
    """SRC-6: ``count, sum(is_open), sum(1 - is_open)`` over all trades."""
    return trades.agg(
        F.count(F.lit(1)).alias("total_trades"),
        F.sum(F.col("is_open").cast("long")).alias("open_trades"),
        F.sum((~F.col("is_open")).cast("long")).alias("closed_trades"),
    )


# --------------------------------------------------------------------------
# Driver fixture: the ``events`` table re-read as trades (see FIXTURES.md §2).
# Every summed or squared value is a multiple of a power of two, so aggregate
# sums are exact in any order.
# --------------------------------------------------------------------------

# Fixed values of the fixture mapping: per-event-type profit offsets.
EVENT_PROFIT_OFFSETS = {"click": 30, "view": 40, "purchase": 45, "signup": 55, "error": 70}


def trades_from_events(events: DataFrame) -> DataFrame:
    """Derive a ``trades`` frame from the driver's ``events`` table (narrow: no shuffle)."""
    # A column of its own: several columns below need it, and each would parse the JSON again.
    events = events.withColumn("_k", F.get_json_object(F.col("props"), "$.k").cast("int"))
    e, k = F.col("event_id"), F.col("_k")
    offset = F.col("event_type")
    off = None
    for name, value in EVENT_PROFIT_OFFSETS.items():
        off = F.when(offset == name, F.lit(value)) if off is None else off.when(offset == name, F.lit(value))
    is_open = (e % 20) == 19
    profit = F.when(~is_open & ((e % 211) != 0), (k - off + (e % 12) - 6) / F.lit(4.0))
    stake = F.floor(F.col("value") * 4) / F.lit(4.0) + F.lit(1.0)
    duration = F.when(~is_open & ((e % 97) != 0), F.lit(1) + (e * 7919) % 3001)
    exit_reason = (
        F.when(is_open | ((e % 53) == 0), F.lit(None).cast("string"))
        .when((profit < 0) & ((k % 2) == 0), F.lit("stop_loss"))
        .when((k % 3) == 0, F.lit("roi"))
        .when((k % 3) == 1, F.lit("exit_signal"))
        .otherwise(F.lit("force_exit"))
    )
    stop_loss = F.when((e % 5) != 0, F.lit(-2.0) * (F.lit(1) + (F.lit(31) * e + k) % 8))
    month_shift = F.expr("(event_id div 7) % 12")
    open_date = F.col("ts").cast(T.TimestampNTZType()) + F.make_dt_interval(days=(F.lit(30) * month_shift).cast("int"))
    base = F.concat(F.lit("C"), (e % 12).cast("string"))
    quote = F.concat(F.lit("Q"), F.expr("(event_id div 12) % 3").cast("string"))
    return events.select(
        (e + 1).alias("trade_id"),
        F.concat(base, F.lit("/"), quote).alias("pair"),
        base.alias("base_currency"),
        quote.alias("quote_currency"),
        is_open.alias("is_open"),
        F.col("event_type").alias("strategy"),
        profit.alias("profit_pct"),
        (stake * profit / F.lit(128.0)).alias("profit_abs"),
        (profit / F.lit(100.0)).alias("profit_ratio"),
        duration.cast("long").alias("trade_duration"),
        exit_reason.alias("exit_reason"),
        stop_loss.alias("stop_loss_pct"),
        stake.alias("stake_amount"),
        open_date.alias("open_date"),
        F.when(~is_open, open_date + F.make_dt_interval(mins=duration.cast("int"))).alias("close_date"),
    )


def fixture_trades(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``trades`` for a driver scale-factor directory."""
    return trades_from_events(spark.read.parquet(f"{sf_dir}/events.parquet"))
