"""Exact order statistics without a row-level window, for one column or for all keys at once.

``element_at_fraction`` finds the value at position ``floor(level * n)`` of the
sorted column of each key. The first scan counts values by range: ranges are fixed
(``RANGES`` to each doubling of the magnitude), so their counts are exact, add up
across batches and bracket the position without any doubt. The second scan
reduces each key's bracket to distinct values with counts, which are materialised;
from there histograms narrow all keys' brackets together until each holds a single
value. The number of scans does not depend on the number of keys, and every step
separates the least from the greatest value of a bracket, so the search ends.

``count_ranges`` and ``count_values`` are the two halves of a rank index that can be
kept: an element is then found from the range counts and the values of one
range (``element_from_index``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

BUCKETS = 1024
#: Ranges to each doubling of the magnitude.
RANGES = 32
#: Larger than any ``RANGES * log2`` of a double, so that signs keep apart.
OFFSET = 100_000


def value_range(v: Column) -> Column:
    """The number of a value's range; it never decreases as the value grows."""
    size = F.floor(F.log2(F.abs(v)) * RANGES) + OFFSET
    infinite = F.lit(10 * OFFSET)
    plain = F.when(v == 0, F.lit(0)).when(v > 0, size).otherwise(-size)
    return F.when(F.isnan(v), infinite + 1).when(v == float("inf"), infinite).when(v == float("-inf"), -infinite).otherwise(plain).cast("long")


def _values(df: DataFrame, column: str, keys: Sequence[str]) -> DataFrame:
    return df.select(*keys, F.col(column).cast("double").alias("v")).where(F.col("v").isNotNull())


def count_values(df: DataFrame, column: str, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, v, n``: the distinct values of each key, and how often they occur."""
    return _values(df, column, keys).groupBy(*keys, "v").agg(F.count(F.lit(1)).alias("n"))


def count_ranges(values: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """``keys, place, n, low, high`` of values ``keys, v, n``: how many each range holds, and its ends."""
    return values.groupBy(*keys, value_range(F.col("v")).alias("place")).agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"))


def merge_ranges(parts: DataFrame, keys: Sequence[str] = ()) -> DataFrame:
    """Range counts of several batches as one."""
    return parts.groupBy(*keys, "place").agg(F.sum("n").alias("n"), F.min("low").alias("low"), F.max("high").alias("high"))


def _pick(counts: DataFrame, keys: Sequence[str], wanted: Column) -> DataFrame:
    """``keys, low, high, position``: per key the group that holds the wanted 0-based position, and the position in it.

    ``counts`` has a bounded number of rows per key (ranges, or buckets of a histogram).
    """
    order = Window.partitionBy(*keys).orderBy("place")
    so_far = counts.withColumn("until", F.sum("n").over(order)).withColumn("total", F.sum("n").over(Window.partitionBy(*keys)))
    at = so_far.withColumn("wanted", wanted).where((F.col("until") > F.col("wanted")) & (F.col("until") - F.col("n") <= F.col("wanted")))
    return at.select(*keys, "low", "high", (F.col("wanted") - F.col("until") + F.col("n")).alias("position"))


def _inside(values: DataFrame, brackets: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The values that lie in their key's bracket, with the bracket."""
    if not keys:
        row = brackets.first()
        found = values.where(F.col("v").between(F.lit(row["low"]), F.lit(row["high"])))
        return found.select("*", *[F.lit(row[c]).alias(c) for c in ("low", "high", "position")])
    ends = brackets.agg(F.min("low"), F.max("high")).first()
    same = [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]
    both = values.where(F.col("v").between(F.lit(ends[0]), F.lit(ends[1]))).alias("a").join(brackets.alias("b"), same)
    return both.where(F.col("v").between(F.col("low"), F.col("high"))).select(*[F.col(f"a.{k}").alias(k) for k in keys], "v", "n", "low", "high", "position")


def element_from_index(ranges: DataFrame, values: DataFrame, level: float, keys: Sequence[str] = (), out: str = "value") -> DataFrame:
    """``keys, out``: the element at 0-based ``floor(level * n)`` of each key's ascending values.

    ``ranges`` are the (merged) range counts of ``values`` (``keys, v, n``; a value
    may have several rows). Of ``values`` only the bracketing ranges are read, once.
    Without keys there is one row, NULL if there are no values.
    """
    from tradescope.operators.grains import pin

    def settle(brackets: DataFrame) -> DataFrame:
        """One row per key, computed once; without keys it is one row and needs no table."""
        return pin(brackets) if keys else values.sparkSession.createDataFrame(brackets.collect(), brackets.schema)

    wanted = F.least(F.floor(F.lit(level) * F.col("total")), F.col("total") - 1)
    brackets = settle(_pick(ranges, keys, wanted))
    if brackets.limit(1).count():
        found = _inside(values, brackets, keys)
        counted = pin(found.groupBy(*keys, "v").agg(F.sum("n").alias("n")))
        while brackets.where(F.col("low") < F.col("high")).limit(1).count():
            # Halves of the ends keep the width finite.
            part = F.try_divide(F.col("v") / 2 - F.col("low") / 2, F.col("high") / 2 - F.col("low") / 2)
            bucket = F.when(F.col("v") == F.col("high"), BUCKETS + 1).otherwise(F.floor(part * BUCKETS))
            rows = _inside(counted, brackets, keys).withColumn("place", bucket)
            histogram = rows.groupBy(*keys, "place").agg(F.sum("n").alias("n"), F.min("v").alias("low"), F.max("v").alias("high"), F.max("position").alias("asked"))
            brackets = settle(_pick(histogram, keys, F.col("asked")))
    elif not keys:
        return values.sparkSession.createDataFrame([(None,)], f"{out} double")
    return brackets.select(*keys, F.col("low").alias(out))


def element_at_fraction(df: DataFrame, column: str, level: float, keys: Sequence[str] = (), out: str = "value") -> DataFrame:
    """``keys, out``: the element at 0-based ``floor(level * n)`` of each key's ascending non-null values, in two scans of ``df``."""
    values = _values(df, column, keys).withColumn("n", F.lit(1).cast("long"))
    return element_from_index(count_ranges(values, keys), values, level, keys, out)
