"""Yearly series of robust prices: medians, volatility, dispersion, indices and changes between periods."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom import dims
from ledgerloom.functions import pricing, robust
from ledgerloom.operators import joins

ID, YEAR, PRICE = "commodity_id", "year", "price_per_unit_usd"


def dominant(rows: DataFrame, key: str, value: Column) -> DataFrame:
    """key, top: the most frequent value of each key, ties to the smallest; counted before anything is ranked."""
    n = rows.groupBy(key, value.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    return n.groupBy(key).agg(F.min_by("__v", F.struct(-F.col("__n"), F.col("__v"))).alias("top"))


def by_dominant_unit(rows: DataFrame, unit: Column) -> DataFrame:
    """Rows quoted by their commodity's most frequent unit."""
    marked = rows.withColumn("__u", unit)
    return marked.join(dominant(rows, ID, unit), ID).where(F.col("__u") == F.col("top")).drop("__u", "top")


def canonical_rows(rows: DataFrame) -> DataFrame:
    """Rows by accepted units, of these by the dominant one, of these within bounds; a step that would leave nothing is skipped.

    Ids without accepted units or bounds are not restricted by them.
    """
    units, bounds = dims.canonical_rows(), dims.bound_rows()
    # looked up once in each row; the second projection only refers to what the first made
    r = rows.withColumns({
        "__u": pricing.plain_unit(F.col("unit")), "__iu": joins.longest_prefix(F.col(ID), units), "__ib": joins.longest_prefix(F.col(ID), bounds),
    })
    accepted = joins.pick(F.col("__iu"), [u for _, u in units])
    lo, hi = (joins.pick(F.col("__ib"), [b[i] for b in bounds]) for i in (1, 2))
    r = r.withColumns({
        "__ok": F.col("__iu").isNull() | F.array_contains(accepted, F.col("__u")),
        "__in": F.col("__ib").isNull() | F.coalesce(F.col(PRICE), F.lit(0.0)).between(lo, hi),
    })
    counts = r.groupBy(ID, "__u").agg(F.count(F.lit(1)).alias("n"), F.count_if("__ok").alias("k"))
    some = counts.groupBy(ID).agg(
        (F.sum("k") > 0).alias("any_ok"),
        F.min_by("__u", F.struct(-F.col("k"), F.col("__u"))).alias("top_ok"),
        F.min_by("__u", F.struct(-F.col("n"), F.col("__u"))).alias("top_all"),
    )
    r = r.join(some, ID).where(F.when(F.col("any_ok"), F.col("__ok") & (F.col("__u") == F.col("top_ok"))).otherwise(F.col("__u") == F.col("top_all")))
    inside = r.groupBy(ID).agg(F.count_if("__in").alias("n_in"))
    return r.join(inside, ID).where(F.col("__in") | (F.col("n_in") == 0)).select(*rows.columns)


def yearly_medians(rows: DataFrame, least: int = 2) -> DataFrame:
    """commodity_id, year, n, median: the upper median of each year after fences across years and within the year.

    Years of fewer than least fenced values are left out; that is tested before the year's own fence.
    """
    unit = F.coalesce(F.col("unit"), F.lit(""))
    # counted by value before anything is joined, so that the join moves distinct values and not rows
    c = robust.counted(rows.where((F.col(PRICE) > 0) & (F.col(YEAR) > 0)).withColumn("__u", unit), [ID, YEAR, "__u"], PRICE)
    c = c.join(dominant(rows, ID, unit), ID).where(F.col("__u") == F.col("top")).select(ID, YEAR, "v", "c")
    fence = robust.cross_fence(c.groupBy(ID, "v").agg(F.sum("c").alias("c")), [ID], prefilter=False)
    c = c.join(fence, ID).where(F.col("v").between(F.col("lo"), F.col("hi"))).select(ID, YEAR, "v", "c")
    c = c.withColumn("n", F.sum("c").over(Window.partitionBy(ID, YEAR))).where(F.col("n") >= least).drop("n")
    s = robust.summary(robust.iqr_clean(c, [ID, YEAR]), [ID, YEAR])
    return s.select(ID, YEAR, "n", F.col("med").alias("median"))


def trend(rows: DataFrame, least: int = 3, unit_rules: bool = True) -> DataFrame:
    """commodity_id, year, n, q1, median, q3 of cleaned prices: canonical unit, log fence, fence across years, Tukey's within the year."""
    base = canonical_rows(rows) if unit_rules else rows
    c = robust.counted(base.where(F.col(YEAR) > 0), [ID, YEAR], PRICE)
    everything = c.groupBy(ID, "v").agg(F.sum("c").alias("c"))
    clean = robust.log_clean(everything, [ID]).groupBy(ID).agg(F.min("v").alias("least"), F.max("v").alias("most"))
    fence = robust.cross_fence(everything, [ID], prefilter=True)
    limits = clean.join(fence, ID).select(ID, F.greatest("least", "lo").alias("lo"), F.least("most", "hi").alias("hi"))
    inside = c.join(limits, ID).where(F.col("v").between(F.col("lo"), F.col("hi"))).select(ID, YEAR, "v", "c")
    s = robust.summary(robust.tukey(inside, [ID, YEAR]), [ID, YEAR]).where(F.col("n") >= least)
    return s.select(ID, YEAR, "n", "q1", F.col("med").alias("median"), "q3")


def volatility(series: DataFrame) -> DataFrame:
    """The interquartile range over the median, null where the median is not positive."""
    return series.select(ID, YEAR, F.when(F.col("median") > 0, (F.col("q3") - F.col("q1")) / F.col("median")).alias("volatility"))


def price_index(medians: DataFrame, first: int, last: int, least: int = 2) -> DataFrame:
    """year, n, index: the interpolated median over commodities of each year's median against the mean of the base years, in per cent."""
    base = medians.where(F.col(YEAR).between(first, last)).groupBy(ID).agg(F.avg("median").alias("base"))
    rel = medians.join(base, ID).where(F.col("base") > 0).withColumn("rel", F.col("median") / F.col("base") * 100)
    return rel.groupBy(YEAR).agg(F.count(F.lit(1)).alias("n"), F.median("rel").alias("index")).where(F.col("n") >= least)


def dispersion(rows: DataFrame, least: int = 2) -> DataFrame:
    """commodity_id, year, n, cv: the population deviation over the mean of positive prices by the dominant unit."""
    kept = by_dominant_unit(rows, F.coalesce(F.col("unit"), F.lit(""))).where((F.col(PRICE) > 0) & (F.col(YEAR) > 0))
    s = kept.groupBy(ID, YEAR).agg(F.count(F.lit(1)).alias("n"), (F.stddev_pop(PRICE) / F.avg(PRICE)).alias("cv"))
    return s.where(F.col("n") >= least)


def log_cv(rows: DataFrame, group: str, least_years: int = 5) -> DataFrame:
    """group, n_years, cv: the population deviation over the absolute mean of the logarithms of yearly medians."""
    c = robust.counted(rows.where((F.col(PRICE) > 0) & (F.col(YEAR) > 0)), [group, YEAR], PRICE)
    yearly = robust.summary(robust.iqr_clean(c, [group, YEAR]), [group, YEAR]).withColumn("x", F.log10("med"))
    s = yearly.groupBy(group).agg(F.count(F.lit(1)).alias("n_years"), F.stddev_pop("x").alias("sd"), F.avg("x").alias("mean"))
    cv = F.when(F.col("mean") == 0, 0.0).otherwise(F.col("sd") / F.abs(F.col("mean")))
    return s.where(F.col("n_years") >= least_years).select(group, "n_years", cv.alias("cv"))


def period_change(medians: DataFrame, before: tuple[int, int], after: tuple[int, int]) -> DataFrame:
    """commodity_id, before, after, change: mean yearly medians of two spans of years and the change in per cent."""
    mean = lambda span: F.avg(F.when(F.col(YEAR).between(*span), F.col("median")))
    s = medians.groupBy(ID).agg(mean(before).alias("before"), mean(after).alias("after")).dropna()
    return s.withColumn("change", (F.col("after") / F.col("before") - 1) * 100)


def period_cv(medians: DataFrame, span: tuple[int, int]) -> DataFrame:
    """commodity_id, n_years, cv of the yearly medians within a span of years."""
    inside = medians.where(F.col(YEAR).between(*span))
    return inside.groupBy(ID).agg(F.count(F.lit(1)).alias("n_years"), (F.stddev_pop("median") / F.avg("median")).alias("cv")).where("n_years >= 2")
