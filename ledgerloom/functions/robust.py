"""Exact order statistics and robust cleaning by group.

Values are first counted by group and value, with partial aggregation, so a group of any number of rows
shrinks to its distinct values before it meets in one place; no list of a group is ever built. Ranks come
from running sums of the counts. All windows below share one partitioning, so one exchange serves them.

The upper median is the element n div 2 of the sorted values, counted from nought; quartiles are
the elements n div 4 and 3n div 4.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

DECADES = 2.5


def counted(rows: DataFrame, keys: Sequence[str], value: str) -> DataFrame:
    """keys, v, c: how often each value occurs; null and NaN values are left out."""
    v = F.col(value).cast("double")
    return rows.where(v.isNotNull() & ~F.isnan(v)).groupBy(*keys, v.alias("v")).agg(F.count(F.lit(1)).alias("c"))


def with_stats(df: DataFrame, keys: Sequence[str], prefix: str = "", weight: Column | None = None) -> DataFrame:
    """Adds n, q1, med and q3 (prefixed) of each group to counted values."""
    whole = Window.partitionBy(*keys)
    rising = whole.orderBy("v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    df = df.withColumn("__cum", F.sum("c").over(rising)).withColumn(f"{prefix}n", F.sum("c").over(whole))
    n = F.col(f"{prefix}n")

    def at(rank: Column) -> Column:
        return F.min(F.when(F.col("__cum") > rank, F.col("v"))).over(whole)

    return df.withColumns({
        f"{prefix}q1": at(F.floor(n / 4)), f"{prefix}med": at(F.floor(n / 2)), f"{prefix}q3": at(F.floor(3 * n / 4)),
    }).drop("__cum")


def summary(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """keys, n, q1, med, q3: one row for each group of counted values."""
    done = with_stats(df, keys)
    return done.groupBy(*keys).agg(*[F.first(c).alias(c) for c in ("n", "q1", "med", "q3")])


def tukey(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counted values within 1.5 interquartile ranges (groups of four and more) or three median deviations (two and three)."""
    s = with_stats(df, keys, "t_")
    iqr = F.col("t_q3") - F.col("t_q1")
    by_iqr = (iqr == 0) | F.col("v").between(F.col("t_q1") - 1.5 * iqr, F.col("t_q3") + 1.5 * iqr)
    whole = Window.partitionBy(*keys)
    dev = F.abs(F.col("v") - F.col("t_med"))
    # of two or three values the upper median deviation is the second smallest
    rank = F.sum("c").over(whole.orderBy(dev).rowsBetween(Window.unboundedPreceding, Window.currentRow))
    s = s.withColumn("__d", dev).withColumn("__r", rank)
    mad = F.min(F.when(F.col("__r") > F.floor(F.col("t_n") / 2), F.col("__d"))).over(whole)
    s = s.withColumn("__mad", mad)
    by_mad = (F.col("__mad") == 0) | (F.col("__d") / F.col("__mad") <= 3)
    keep = F.when(F.col("t_n") < 2, True).when(F.col("t_n") >= 4, by_iqr).otherwise(by_mad)
    return s.where(keep).select(*keys, "v", "c")


def iqr_clean(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counted positive values within 1.5 interquartile ranges, where the range is not nought."""
    s = with_stats(df.where("v > 0"), keys, "t_")
    iqr = F.col("t_q3") - F.col("t_q1")
    keep = (F.col("t_n") < 2) | (iqr <= 0) | F.col("v").between(F.col("t_q1") - 1.5 * iqr, F.col("t_q3") + 1.5 * iqr)
    return s.where(keep).select(*keys, "v", "c")


def log_clean(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Counted positive values within 2.5 decades of the upper median, then within 1.5 interquartile ranges of logarithms."""
    s = with_stats(df.where("v > 0"), keys, "a_")
    near = s.where(F.abs(F.log10("v") - F.log10("a_med")) <= DECADES).select(*keys, "v", "c")
    s = with_stats(near, keys, "b_")
    lo, hi, x = F.log10("b_q1"), F.log10("b_q3"), F.log10("v")
    iqr = hi - lo
    keep = (F.col("b_n") < 4) | (iqr == 0) | x.between(lo - 1.5 * iqr, hi + 1.5 * iqr)
    return s.where(keep).select(*keys, "v", "c")


def cross_fence(df: DataFrame, keys: Sequence[str], prefilter: bool) -> DataFrame:
    """keys, lo, hi: a decade and a half around the group's upper median of positive values.

    prefilter first drops what is over 2.5 decades off. Groups without a positive value have no row; outside joins
    treat them as unfenced.
    """
    s = with_stats(df.where("v > 0"), keys, "a_")
    if prefilter:
        near = s.where(F.abs(F.log10("v") - F.log10("a_med")) <= DECADES).select(*keys, "v", "c")
        s = with_stats(near, keys, "a_")
    med = s.groupBy(*keys).agg(F.first("a_med").alias("m"))
    return med.select(*keys, (F.col("m") * 10**-1.5).alias("lo"), (F.col("m") * 10**1.5).alias("hi"))
