"""Outliers by group of commodity and decade, and what is kept of them."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.functions import robust


def fences(rows: DataFrame, keys: Sequence[str], value: str, k: float = 1.5, least: int = 5) -> DataFrame:
    """keys, lo, hi of groups of least and more positive values whose interquartile range is not nought."""
    s = robust.summary(robust.counted(rows.where(F.col(value) > 0), keys, value), keys)
    iqr = F.col("q3") - F.col("q1")
    return s.where((F.col("n") >= least) & (iqr != 0)).select(*keys, (F.col("q1") - k * iqr).alias("lo"), (F.col("q3") + k * iqr).alias("hi"))


def flagged(rows: DataFrame, keys: Sequence[str], value: str, k: float = 1.5, least: int = 5) -> DataFrame:
    """The rows strictly outside their group's fences."""
    limits = fences(rows, keys, value, k, least)
    return rows.where(F.col(value) > 0).join(limits, list(keys)).where((F.col(value) < F.col("lo")) | (F.col(value) > F.col("hi"))).drop("lo", "hi")


def last_per_key(rows: DataFrame, key: str, order: Sequence[Column | str]) -> DataFrame:
    """The last row of each key in a set order; rows of a null key are left out."""
    place = F.struct(*order)
    kept = rows.where(F.col(key).isNotNull())
    return kept.groupBy(key).agg(F.max_by(F.struct(*[c for c in rows.columns if c != key]), place).alias("r")).select(key, "r.*")


def without(rows: DataFrame, marked: DataFrame, key: str) -> DataFrame:
    """Rows whose key is not among the marked ones; null keys stay."""
    return rows.join(marked.select(key).distinct(), key, "left_anti")
