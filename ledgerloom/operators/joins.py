"""Joins that the SQL planner has no name for: longest prefix, as-of, interval, priority and positional."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.pricing import sql_literal

#: Dimension tables above this many rows are not turned into expressions.
MOST_CASES = 1000


def longest_prefix(value: Column, rows: Sequence[tuple]) -> Column:
    """The row (as the index of rows) whose first element is the longest beginning of value; null if none is.

    The table becomes one CASE, longest first, so no row of the other side is moved or multiplied.
    """
    if len(rows) > MOST_CASES:
        raise ValueError("too many prefixes for one expression; resolve the distinct values in a join instead")
    out: Column | None = None
    for i, row in sorted(enumerate(rows), key=lambda x: -len(x[1][0])):
        hit = value.startswith(row[0])
        out = F.when(hit, i) if out is None else out.when(hit, i)
    return F.lit(None).cast("int") if out is None else out


def pick(index: Column, values: Sequence) -> Column:
    """The value at an index of a literal array, null for a null index."""
    return F.get(F.expr(sql_literal(list(values))), index)


def interval_case(value: Column, spans: Sequence[tuple[int, int, str]]) -> Column:
    """The label of the first span (lo, hi, label; both ends belong) that holds the value."""
    out: Column | None = None
    for lo, hi, label in spans:
        out = F.when(value.between(lo, hi), label) if out is None else out.when(value.between(lo, hi), label)
    return F.lit(None).cast("string") if out is None else out


def asof(left: DataFrame, right: DataFrame, on: Sequence[str], left_time: str, right_time: str, values: Sequence[str]) -> DataFrame:
    """Each left row with the values of the latest right row not after it; null where there is none.

    Both sides meet in one union, sorted once by key and time; the latest right value is carried forward by a
    window, so nothing is joined by inequality. Of right rows at one time the largest values count.
    """
    packed = F.struct(F.col(right_time).alias("__t"), *[F.col(v) for v in values])
    a = left.select("*", F.col(left_time).alias("__time"), F.lit(1).alias("__side"), F.lit(None).cast(right.select(packed.alias("p")).schema["p"].dataType).alias("__v"))
    b = right.select(*on, F.col(right_time).alias("__time"), F.lit(0).alias("__side"), packed.alias("__v"))
    both = a.unionByName(b, allowMissingColumns=True)
    order = Window.partitionBy(*on).orderBy("__time", "__side", "__v").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    filled = both.withColumn("__last", F.last("__v", ignorenulls=True).over(order)).where("__side = 1")
    return filled.select(*left.columns, *[F.col(f"__last.{v}").alias(v) for v in values])


def first_by_priority(rows: DataFrame, keys: Sequence[str], priority: Column, tie: Sequence[Column | str]) -> DataFrame:
    """One row for each key: that of least priority, ties by tie; rows of null priority are left out.

    The row travels inside min_by, with partial aggregation, instead of a window over the key.
    """
    order = F.struct(priority.alias("p"), *[F.col(t) if isinstance(t, str) else t for t in tie])
    kept = rows.where(priority.isNotNull())
    return kept.groupBy(*keys).agg(F.min_by(F.struct(*[c for c in rows.columns if c not in keys]), order).alias("r")).select(*keys, "r.*")


def answers_to_inputs(inputs: DataFrame, answers: DataFrame, batch: str = "batch", idx: str = "idx", pos: str = "pos") -> DataFrame:
    """Answers joined to their inputs by the echoed idx, the last of several; by position in batches that echo none.

    Answers to an idx that the batch does not have are dropped; inputs without an answer keep nulls.
    """
    echo = answers.groupBy(batch).agg(F.count(idx).alias("__n"))
    keyed = answers.join(echo, batch).withColumn(idx, F.when(F.col("__n") == 0, F.col(pos)).otherwise(F.col(idx))).where(F.col(idx).isNotNull())
    others = [c for c in answers.columns if c not in (batch, idx, pos)]
    last = keyed.groupBy(batch, idx).agg(F.max_by(F.struct(*others), F.col(pos)).alias("a"))
    return inputs.join(last, [batch, idx], "left").select(*inputs.columns, *[F.col(f"a.{c}").alias(c) for c in others])


def apply_verdicts(rows: DataFrame, verdicts: DataFrame, key: str, corrected: Sequence[str]) -> DataFrame:
    """rows with status kept, fixed, rejected or pending and the corrected values of fixed ones.

    verdicts: key, confirmed, fixed, and a column for each corrected value; no verdict leaves a row pending. Of several
    verdicts on one key any rejection counts.
    """
    one = verdicts.groupBy(key).agg(
        F.min("confirmed").alias("__ok"), F.max("fixed").alias("__fix"), *[F.max(c).alias(f"__{c}") for c in corrected]
    )
    status = F.when(F.col("__ok").isNull(), "pending").when(~F.col("__ok"), "rejected").when(F.col("__fix"), "fixed").otherwise("kept")
    joined = rows.join(one, key, "left").withColumn("status", status)
    for c in corrected:
        joined = joined.withColumn(c, F.when(F.col("status") == "fixed", F.coalesce(f"__{c}", F.col(c))).otherwise(F.col(c)))
    return joined.select(*rows.columns, "status")
