"""Problem 6: percentiles of very large numeric columns.

Summaries are randomized compactor hierarchies (KLL): a full level is sorted and every other
value, from a random start, moves up with twice the weight; two summaries merge level by level.
Spark's own aggregates keep them on the JVM side with partial aggregation, so a group that holds
a third of all rows reaches the reducer as one summary from each task.

With K = 1024 the rank of an answered percentile is off by at most RANK_ERROR of the group's rows
with a probability of 99 %; groups of up to K values are answered exactly (the smallest value
whose share of values at or below it reaches the percentile).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

K = 1024
RANK_ERROR = 2.296 / K**0.9021
PERCENTILES = (0.05, 0.1, 0.25, 0.5, 0.75, 0.9, 0.95, 0.99)


def summaries(rows: DataFrame, keys: Sequence[str], value: str, portion: str | None = None, k: int = K) -> DataFrame:
    """One summary for each group, and portion if one is named: keys, portion, n, sketch.

    Null and NaN values are left out; a group without others gives no row. Null keys form a group.
    """
    v = F.col(value).cast("double")
    kept = rows.select(*keys, *([portion] if portion else []), v.alias("__v")).where(v.isNotNull() & ~F.isnan(v))
    return kept.groupBy(*keys, *([portion] if portion else [])).agg(
        F.count(F.lit(1)).alias("n"), F.kll_sketch_agg_double("__v", k).alias("sketch")
    )


def combined(parts: DataFrame, keys: Sequence[str], k: int = K) -> DataFrame:
    """Summaries of the same groups from any number of portions, merged level by level."""
    return parts.groupBy(*keys).agg(F.sum("n").alias("n"), F.kll_merge_agg_double("sketch", k).alias("sketch"))


def answers(merged: DataFrame, keys: Sequence[str], percentiles: Sequence[float] = PERCENTILES) -> DataFrame:
    """A column pNN for each percentile asked."""
    asked = F.kll_sketch_get_quantile_double("sketch", F.array(*[F.lit(float(p)) for p in percentiles]))
    got = merged.select(*keys, "n", asked.alias("q"))
    return got.select(*keys, "n", *[F.col("q")[i].alias(f"p{round(p * 100):02d}") for i, p in enumerate(percentiles)])
