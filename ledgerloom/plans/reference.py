"""Queries over the tables of the price pipeline, each with the DuckDB SQL that must give the same rows."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ledgerloom import dims
from ledgerloom.functions import pricing, robust
from ledgerloom.operators import backends, batching, joins, outliers, series
from ledgerloom.session import shared_path, table
from ledgerloom.sources import pages, sinks
from ledgerloom.streaming import incremental

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}

ID, YEAR, PRICE = series.ID, series.YEAR, series.PRICE


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql:
            ORACLES[f.__name__] = sql
        return f

    return add


def norm(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "normalized")


def r6(c):
    return F.round(c, 6)


def sql_list(items) -> str:
    return ", ".join("'" + str(x).replace("'", "''") + "'" for x in items)


def values(rows) -> str:
    cell = lambda x: "'" + x.replace("'", "''") + "'" if isinstance(x, str) else "[" + sql_list(x) + "]" if isinstance(x, list) else repr(x)
    return ", ".join("(" + ", ".join(map(cell, row)) + ")" for row in rows)


# ---- robust statistics and series -------------------------------------------------------------

_DOMINANT = """dom AS (SELECT commodity_id, arg_min(u, (-n, u)) AS top FROM
  (SELECT commodity_id, coalesce(unit, '') AS u, count(*) AS n FROM normalized GROUP BY ALL) GROUP BY 1)"""
_MEDIANS = f"""WITH {_DOMINANT},
obs AS (SELECT n.commodity_id, year, price_per_unit_usd AS p FROM normalized n JOIN dom ON n.commodity_id = dom.commodity_id AND coalesce(unit, '') = top
  WHERE price_per_unit_usd > 0 AND year > 0),
fence AS (SELECT commodity_id, list_sort(list(p))[count(*) // 2 + 1] AS m FROM obs GROUP BY 1),
cut AS (SELECT o.* FROM obs o JOIN fence f USING (commodity_id) WHERE p BETWEEN m * power(10, -1.5) AND m * power(10, 1.5)),
yr AS (SELECT commodity_id, year, list_sort(list(p)) AS s, count(*) AS n FROM cut GROUP BY 1, 2 HAVING count(*) >= 2),
q AS (SELECT *, s[n // 4 + 1] AS q1, s[3 * n // 4 + 1] AS q3 FROM yr),
kept AS (SELECT commodity_id, year, CASE WHEN q3 - q1 > 0 THEN list_filter(s, lambda x: x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) ELSE s END AS k FROM q),
med AS (SELECT commodity_id, year, len(k) AS n, k[len(k) // 2 + 1] AS median FROM kept)
"""


@query(_MEDIANS + "SELECT commodity_id, year, n, median FROM med")
def yearly_upper_median(spark, sf):
    """The flagship: robust yearly medians of every commodity."""
    return series.yearly_medians(norm(spark, sf), 2)


@query(_MEDIANS + """, base AS (SELECT commodity_id, avg(median) AS base FROM med WHERE year BETWEEN 1875 AND 1885 GROUP BY 1)
SELECT year, count(*) AS n, round(median(median / base * 100), 6) AS price_index FROM med JOIN base USING (commodity_id) WHERE base > 0 GROUP BY year HAVING count(*) >= 2""")
def price_index(spark, sf):
    return series.price_index(series.yearly_medians(norm(spark, sf), 2), 1875, 1885).select(YEAR, "n", r6("index").alias("price_index"))


@query(_MEDIANS + """, s AS (SELECT commodity_id, avg(median) FILTER (year BETWEEN 1850 AND 1860) AS before, avg(median) FILTER (year BETWEEN 1861 AND 1870) AS after
FROM med GROUP BY 1) SELECT commodity_id, round(before, 6) AS before, round(after, 6) AS after, round((after / before - 1) * 100, 6) AS change FROM s WHERE before IS NOT NULL AND after IS NOT NULL""")
def period_change(spark, sf):
    s = series.period_change(series.yearly_medians(norm(spark, sf), 2), (1850, 1860), (1861, 1870))
    return s.select(ID, r6("before").alias("before"), r6("after").alias("after"), r6("change").alias("change"))


@query(_MEDIANS + """SELECT commodity_id, count(*) AS n_years, round(stddev_pop(median) / avg(median), 6) AS cv FROM med WHERE year BETWEEN 1850 AND 1900 GROUP BY 1 HAVING count(*) >= 2""")
def period_cv(spark, sf):
    return series.period_cv(series.yearly_medians(norm(spark, sf), 2), (1850, 1900)).select(ID, "n_years", r6("cv").alias("cv"))


@query(_MEDIANS + f"""SELECT m.commodity_id, m.year, m.median, e.label FROM med m LEFT JOIN (VALUES {values(dims.EVENT_SPANS)}) e(lo, hi, label) ON m.year BETWEEN e.lo AND e.hi
WHERE m.commodity_id = 'FOOD-GRAIN-FLOUR'""")
def flour_with_events(spark, sf):
    m = series.yearly_medians(norm(spark, sf).where(F.col(ID) == "FOOD-GRAIN-FLOUR"), 2)
    return m.select(ID, YEAR, "median", joins.interval_case(F.col(YEAR), dims.EVENT_SPANS).alias("label"))


@query(f"""WITH {_DOMINANT}, s AS (SELECT n.commodity_id, year, count(*) AS n, stddev_pop(price_per_unit_usd) / avg(price_per_unit_usd) AS cv
FROM normalized n JOIN dom ON n.commodity_id = dom.commodity_id AND coalesce(unit, '') = top WHERE price_per_unit_usd > 0 AND year > 0 GROUP BY 1, 2 HAVING count(*) >= 2)
SELECT commodity_id, year, n, round(cv, 6) AS cv FROM s""")
def dispersion_cv(spark, sf):
    return series.dispersion(norm(spark, sf)).select(ID, YEAR, "n", r6("cv").alias("cv"))


@query("""WITH yr AS (SELECT category_l1, year, list_sort(list(price_per_unit_usd)) AS s, count(*) AS n FROM normalized WHERE price_per_unit_usd > 0 AND year > 0 GROUP BY 1, 2),
q AS (SELECT *, s[n // 4 + 1] AS q1, s[3 * n // 4 + 1] AS q3 FROM yr),
k AS (SELECT category_l1, year, CASE WHEN n >= 2 AND q3 - q1 > 0 THEN list_filter(s, lambda x: x BETWEEN q1 - 1.5 * (q3 - q1) AND q3 + 1.5 * (q3 - q1)) ELSE s END AS k FROM q),
m AS (SELECT category_l1, log10(k[len(k) // 2 + 1]) AS x FROM k)
SELECT category_l1, count(*) AS n_years, round(CASE WHEN avg(x) = 0 THEN 0 ELSE stddev_pop(x) / abs(avg(x)) END, 6) AS cv FROM m GROUP BY 1 HAVING count(*) >= 5""")
def log_cv_category(spark, sf):
    return series.log_cv(norm(spark, sf), "category_l1").select("category_l1", "n_years", r6("cv").alias("cv"))


_TUKEY = """CASE WHEN n < 2 THEN s WHEN n >= 4 THEN
    CASE WHEN s[3 * n // 4 + 1] = s[n // 4 + 1] THEN s ELSE list_filter(s, lambda x: x BETWEEN s[n // 4 + 1] - 1.5 * (s[3 * n // 4 + 1] - s[n // 4 + 1]) AND s[3 * n // 4 + 1] + 1.5 * (s[3 * n // 4 + 1] - s[n // 4 + 1])) END
  ELSE CASE WHEN list_sort(list_transform(s, lambda x: abs(x - s[n // 2 + 1])))[n // 2 + 1] = 0 THEN s
    ELSE list_filter(s, lambda x: abs(x - s[n // 2 + 1]) / list_sort(list_transform(s, lambda y: abs(y - s[n // 2 + 1])))[n // 2 + 1] <= 3) END END"""


@query(f"""WITH g AS (SELECT commodity_id, year, list_sort(list(price_per_unit_usd)) AS s, count(*) AS n FROM normalized WHERE price_per_unit_usd IS NOT NULL GROUP BY 1, 2)
SELECT commodity_id, year, n, len({_TUKEY}) AS kept FROM g""")
def tukey_clean_counts(spark, sf):
    c = robust.counted(norm(spark, sf), [ID, YEAR], PRICE)
    kept = robust.tukey(c, [ID, YEAR]).groupBy(ID, YEAR).agg(F.sum("c").alias("kept"))
    n = c.groupBy(ID, YEAR).agg(F.sum("c").alias("n"))
    return n.join(kept, (n[ID].eqNullSafe(kept[ID])) & (n[YEAR].eqNullSafe(kept[YEAR])), "left").select(n[ID], n[YEAR], "n", F.coalesce("kept", F.lit(0)).alias("kept"))


_LOGCLEAN = """g AS (SELECT commodity_id, list_sort(list(price_per_unit_usd)) AS s, count(*) AS n FROM normalized WHERE price_per_unit_usd > 0 GROUP BY 1),
near AS (SELECT commodity_id, list_filter(s, lambda x: abs(log10(x) - log10(s[n // 2 + 1])) <= 2.5) AS s FROM g),
b AS (SELECT commodity_id, s, log10(s[len(s) // 4 + 1]) AS lo, log10(s[3 * len(s) // 4 + 1]) AS hi FROM near),
lc AS (SELECT commodity_id, CASE WHEN len(s) < 4 OR hi = lo THEN s ELSE list_filter(s, lambda x: log10(x) BETWEEN lo - 1.5 * (hi - lo) AND hi + 1.5 * (hi - lo)) END AS s FROM b)"""


@query(f"WITH {_LOGCLEAN} SELECT commodity_id, len(s) AS kept FROM lc")
def log_clean_counts(spark, sf):
    c = robust.counted(norm(spark, sf), [ID], PRICE)
    return robust.log_clean(c, [ID]).groupBy(ID).agg(F.sum("c").alias("kept"))


@query(f"WITH {_LOGCLEAN} SELECT commodity_id, round(s[len(s) // 2 + 1] * power(10, -1.5), 6) AS lo, round(s[len(s) // 2 + 1] * power(10, 1.5), 6) AS hi FROM near")
def cross_year_fence(spark, sf):
    c = robust.counted(norm(spark, sf), [ID], PRICE)
    return robust.cross_fence(c, [ID], prefilter=True).select(ID, r6("lo").alias("lo"), r6("hi").alias("hi"))


_CANON = f"""alias(raw, canon) AS (VALUES {values(dims.alias_rows())}),
canon(prefix, units) AS (VALUES {values(dims.canonical_rows())}), bounds(prefix, lo, hi) AS (VALUES {values(dims.bound_rows())}),
ids AS (SELECT DISTINCT commodity_id FROM normalized),
idu AS (SELECT commodity_id, (SELECT arg_max(units, length(prefix)) FROM canon WHERE starts_with(commodity_id, prefix)) AS units,
  (SELECT arg_max(lo, length(prefix)) FROM bounds WHERE starts_with(commodity_id, prefix)) AS lo, (SELECT arg_max(hi, length(prefix)) FROM bounds WHERE starts_with(commodity_id, prefix)) AS hi FROM ids),
c0 AS (SELECT n.record_id, n.commodity_id, n.year, n.price_per_unit_usd AS p, coalesce(a.canon, trim(lower(coalesce(unit, '')), ' ')) AS u, i.units, i.lo, i.hi
  FROM normalized n JOIN idu i USING (commodity_id) LEFT JOIN alias a ON a.raw = trim(lower(coalesce(unit, '')), ' ')),
c1 AS (SELECT *, units IS NULL OR list_contains(units, u) AS ok FROM c0),
cnt AS (SELECT commodity_id, u, count(*) AS n, count(*) FILTER (ok) AS k FROM c1 GROUP BY 1, 2),
units_of AS (SELECT commodity_id, sum(k) > 0 AS any_ok, arg_min(u, (-k, u)) AS top_ok, arg_min(u, (-n, u)) AS top_all FROM cnt GROUP BY 1),
c2 AS (SELECT c1.*, lo IS NULL OR coalesce(p, 0) BETWEEN lo AND hi AS inside FROM c1 JOIN units_of s USING (commodity_id) WHERE CASE WHEN any_ok THEN ok AND u = top_ok ELSE u = top_all END),
nin AS (SELECT commodity_id, count(*) FILTER (inside) AS n_in FROM c2 GROUP BY 1),
canonical AS (SELECT c2.* FROM c2 JOIN nin USING (commodity_id) WHERE inside OR n_in = 0)"""


@query(f"WITH {_CANON} SELECT commodity_id, count(*) AS n, count(DISTINCT u) AS n_units FROM canonical GROUP BY 1")
def canonical_unit_rows(spark, sf):
    """Accepted units by longest prefix, the dominant of them, and physical bounds; with fallbacks."""
    kept = series.canonical_rows(norm(spark, sf)).withColumn("u", pricing.plain_unit(F.col("unit")))
    return kept.groupBy(ID).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("u").alias("n_units"))


_TREND = f"""WITH {_CANON},
obs AS (SELECT commodity_id, year, p FROM canonical WHERE year > 0 AND p IS NOT NULL),
g AS (SELECT commodity_id, list_sort(list(p)) AS s, count(*) AS n FROM obs WHERE p > 0 GROUP BY 1),
near AS (SELECT commodity_id, list_filter(s, lambda x: abs(log10(x) - log10(s[n // 2 + 1])) <= 2.5) AS s FROM g),
b AS (SELECT commodity_id, s, log10(s[len(s) // 4 + 1]) AS lo, log10(s[3 * len(s) // 4 + 1]) AS hi FROM near),
lim AS (SELECT commodity_id, s[len(s) // 2 + 1] AS m, CASE WHEN len(s) < 4 OR hi = lo THEN s ELSE list_filter(s, lambda x: log10(x) BETWEEN lo - 1.5 * (hi - lo) AND hi + 1.5 * (hi - lo)) END AS k FROM b),
cut AS (SELECT o.* FROM obs o JOIN lim USING (commodity_id) WHERE p BETWEEN greatest(k[1], m * power(10, -1.5)) AND least(k[-1], m * power(10, 1.5))),
y AS (SELECT commodity_id, year, list_sort(list(p)) AS s, count(*) AS n FROM cut GROUP BY 1, 2),
t AS (SELECT commodity_id, year, {_TUKEY} AS k FROM y),
trend AS (SELECT commodity_id, year, len(k) AS n, k[len(k) // 4 + 1] AS q1, k[len(k) // 2 + 1] AS median, k[3 * len(k) // 4 + 1] AS q3 FROM t WHERE len(k) >= 3)
"""


@query(_TREND + "SELECT * FROM trend")
def trend_series(spark, sf):
    return series.trend(norm(spark, sf))


@query(_TREND + "SELECT commodity_id, year, round(CASE WHEN median > 0 THEN (q3 - q1) / median END, 6) AS volatility FROM trend")
def volatility_iqr(spark, sf):
    return series.volatility(series.trend(norm(spark, sf))).select(ID, YEAR, r6("volatility").alias("volatility"))


@query(_TREND + """, top AS (SELECT commodity_id FROM (SELECT commodity_id, count(*) AS n FROM normalized GROUP BY 1 ORDER BY n DESC, commodity_id LIMIT 16) WHERE n >= 5)
SELECT commodity_id, year, median FROM trend SEMI JOIN top USING (commodity_id)""")
def top16_grid(spark, sf):
    rows = norm(spark, sf)
    top = rows.groupBy(ID).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), ID).limit(16).where("n >= 5")
    return series.trend(rows).join(top, ID, "left_semi").select(ID, YEAR, "median")


_FLAGS = """WITH b AS (SELECT record_id, ref, commodity_id, year, year // 10 * 10 AS decade, price_per_unit_usd AS p FROM normalized WHERE price_per_unit_usd > 0 AND year > 0),
g AS (SELECT commodity_id, decade, list_sort(list(p)) AS s, count(*) AS n FROM b GROUP BY 1, 2 HAVING count(*) >= 5),
f AS (SELECT commodity_id, decade, s[n // 4 + 1] AS q1, s[3 * n // 4 + 1] AS q3 FROM g),
flags AS (SELECT b.* FROM b JOIN f USING (commodity_id, decade) WHERE q3 <> q1 AND (p < q1 - 1.5 * (q3 - q1) OR p > q3 + 1.5 * (q3 - q1)))
"""


def _flags(spark, sf):
    rows = norm(spark, sf).where(F.col(YEAR) > 0).withColumn("decade", (F.floor(F.col(YEAR) / 10) * 10).cast("int"))
    return outliers.flagged(rows, [ID, "decade"], PRICE)


@query(_FLAGS + "SELECT record_id, decade FROM flags")
def outlier_flags_decade(spark, sf):
    return _flags(spark, sf).select("record_id", "decade")


@query(_FLAGS + "SELECT year, count(*) AS n FROM flags GROUP BY 1")
def outliers_per_year(spark, sf):
    return _flags(spark, sf).groupBy(YEAR).agg(F.count(F.lit(1)).alias("n"))


@query(_FLAGS + "SELECT ref, arg_max(record_id, record_id) AS record_id FROM flags WHERE ref IS NOT NULL GROUP BY ref")
def last_flag_per_ref(spark, sf):
    return outliers.last_per_key(_flags(spark, sf).select("ref", "record_id"), "ref", ["record_id"])


@query(_FLAGS + "SELECT category_l1, count(*) AS n FROM normalized WHERE ref NOT IN (SELECT ref FROM flags) GROUP BY 1")
def without_flagged_refs(spark, sf):
    """One flagged record takes its whole page with it; key record_id instead of ref spares the others."""
    rows = norm(spark, sf).where(F.col("ref").isNotNull())
    return outliers.without(rows, _flags(spark, sf), "ref").groupBy("category_l1").agg(F.count(F.lit(1)).alias("n"))


@query(f"WITH {_DOMINANT} SELECT commodity_id, top AS dominant_unit FROM dom")
def dominant_unit(spark, sf):
    return series.dominant(norm(spark, sf), ID, F.coalesce(F.col("unit"), F.lit(""))).withColumnRenamed("top", "dominant_unit")


# ---- reports ----------------------------------------------------------------------------------


@query("SELECT category_l1, count(*) AS n, round(count(*) * 100.0 / (SELECT count(*) FROM normalized), 6) AS share FROM normalized GROUP BY 1")
def category_share(spark, sf):
    n = norm(spark, sf).groupBy("category_l1").agg(F.count(F.lit(1)).alias("n"))
    total = n.agg(F.sum("n").alias("total"))  # one row
    return n.join(F.broadcast(total)).select("category_l1", "n", r6(F.col("n") * 100.0 / F.col("total")).alias("share"))


@query("SELECT category_l3 || ' (' || commodity_id || ')' AS label, count(*) AS n FROM normalized GROUP BY 1 ORDER BY n DESC, label LIMIT 25")
def top_commodities(spark, sf):
    label = F.concat("category_l3", F.lit(" ("), ID, F.lit(")")).alias("label")
    return norm(spark, sf).groupBy(label).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "label").limit(25)


@query("""WITH top AS (SELECT category_l2 FROM normalized GROUP BY 1 ORDER BY count(*) DESC, category_l2 LIMIT 5)
SELECT category_l2, year, count(*) AS n FROM normalized SEMI JOIN top USING (category_l2) WHERE year > 0 GROUP BY 1, 2""")
def top5_l2_by_year(spark, sf):
    rows = norm(spark, sf)
    top = rows.groupBy("category_l2").agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "category_l2").limit(5)
    return rows.where("year > 0").join(F.broadcast(top), "category_l2", "left_semi").groupBy("category_l2", YEAR).agg(F.count(F.lit(1)).alias("n"))


@query("SELECT year // 10 * 10 AS decade, count(*) AS n FROM normalized WHERE year > 0 GROUP BY 1")
def decade_counts(spark, sf):
    return norm(spark, sf).where("year > 0").groupBy((F.floor(F.col(YEAR) / 10) * 10).cast("int").alias("decade")).agg(F.count(F.lit(1)).alias("n"))


@query("""WITH y AS (SELECT year, count(*) AS n FROM normalized WHERE year > 0 GROUP BY 1)
SELECT min(year) AS first_year, max(year) AS last_year, arg_min(year, (-n, year)) AS peak_year,
(SELECT round(count(price_usd) * 100.0 / count(*), 6) FROM normalized) AS usd_share FROM y""")
def year_summary(spark, sf):
    y = norm(spark, sf).where("year > 0").groupBy(YEAR).agg(F.count(F.lit(1)).alias("n"))
    s = y.agg(F.min(YEAR).alias("first_year"), F.max(YEAR).alias("last_year"), F.min_by(YEAR, F.struct(-F.col("n"), F.col(YEAR))).alias("peak_year"))
    usd = norm(spark, sf).agg(r6(F.count("price_usd") * 100.0 / F.count(F.lit(1))).alias("usd_share"))
    return s.join(F.broadcast(usd))


@query("SELECT coalesce(time_unit, 'none') AS time_unit, count(*) AS n FROM normalized GROUP BY 1")
def time_unit_freq(spark, sf):
    return norm(spark, sf).groupBy(F.coalesce("time_unit", F.lit("none")).alias("time_unit")).agg(F.count(F.lit(1)).alias("n"))


_L1 = ("Food & Agriculture", "Labor & Services", "Real Estate", "Manufactured Goods", "Raw Materials", "Transportation", "Miscellaneous")


@query("SELECT year, " + ", ".join(f"count(*) FILTER (category_l1 = '{c}') AS \"{c}\"" for c in _L1) + " FROM normalized WHERE year > 0 GROUP BY 1")
def pivot_year_category(spark, sf):
    return norm(spark, sf).where("year > 0").groupBy(YEAR).pivot("category_l1", list(_L1)).agg(F.count(F.lit(1))).na.fill(0)


@query("SELECT CAST(least(floor(confidence * 20), 19) AS INT) AS bin, count(*) AS n FROM normalized WHERE confidence BETWEEN 0 AND 1 GROUP BY 1")
def confidence_histogram(spark, sf):
    return norm(spark, sf).where("confidence BETWEEN 0 AND 1").groupBy(F.least(F.floor(F.col("confidence") * 20), F.lit(19)).cast("int").alias("bin")).agg(F.count(F.lit(1)).alias("n"))


_BUCKET = "CASE " + " ".join(f"WHEN lower(coalesce(currency_original, '')) IN ({sql_list(v)}) THEN '{k}'" for k, v in dims.CURRENCY_BUCKETS.items()) + " ELSE 'other' END"


@query(f"SELECT era, {_BUCKET} AS bucket, count(*) AS n FROM normalized JOIN (VALUES {values(dims.ERAS)}) e(era, lo, hi) ON year BETWEEN lo AND hi GROUP BY 1, 2")
def era_currency_matrix(spark, sf):
    era = joins.interval_case(F.col(YEAR), [(lo, hi, name) for name, lo, hi in dims.ERAS])
    rows = norm(spark, sf).select(era.alias("era"), pricing.currency_bucket(F.col("currency_original")).alias("bucket")).where("era IS NOT NULL")
    return rows.groupBy("era", "bucket").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH n AS (SELECT year, count(*) AS normalized, count(price_usd) AS with_usd FROM normalized GROUP BY 1), u AS (SELECT year, count(*) AS unresolved FROM prices_unresolved GROUP BY 1)
SELECT coalesce(n.year, u.year) AS year, coalesce(normalized, 0) AS normalized, coalesce(with_usd, 0) AS with_usd, coalesce(unresolved, 0) AS unresolved FROM n FULL JOIN u ON n.year IS NOT DISTINCT FROM u.year""")
def resolved_by_year(spark, sf):
    n = norm(spark, sf).groupBy(YEAR).agg(F.count(F.lit(1)).alias("normalized"), F.count("price_usd").alias("with_usd"))
    u = table(spark, sf, "prices_unresolved").groupBy(F.col(YEAR).alias("uy")).agg(F.count(F.lit(1)).alias("unresolved"))
    z = lambda c: F.coalesce(c, F.lit(0)).alias(c)
    return n.join(u, n[YEAR].eqNullSafe(u["uy"]), "full").select(F.coalesce(YEAR, "uy").alias(YEAR), z("normalized"), z("with_usd"), z("unresolved"))


@query("SELECT currency_original, count(*) AS n, round(avg(confidence), 6) AS confidence FROM normalized GROUP BY 1")
def currency_report(spark, sf):
    return norm(spark, sf).groupBy("currency_original").agg(F.count(F.lit(1)).alias("n"), r6(F.avg("confidence")).alias("confidence"))


@query("""SELECT array_to_string(regexp_split_to_array(trim(lower(item_raw)), '\\s+')[1:3], ' ') AS cluster, count(*) AS n FROM prices_unresolved WHERE item_raw IS NOT NULL GROUP BY 1 ORDER BY n DESC, cluster LIMIT 20""")
def unresolved_clusters(spark, sf):
    rows = table(spark, sf, "prices_unresolved").where("item_raw IS NOT NULL")
    return rows.groupBy(pricing.item_cluster(F.col("item_raw")).alias("cluster")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "cluster").limit(20)


@query("""WITH i AS (SELECT CAST(left(date, 4) AS INT) AS year, count(DISTINCT (lccn, date)) AS issues FROM issues WHERE date <> '' GROUP BY 1),
d AS (SELECT CAST(left(key, 4) AS INT) AS year, count(DISTINCT key) AS done FROM done WHERE stage = 'pass1' AND key IS NOT NULL GROUP BY 1)
SELECT d.year, done, coalesce(issues, 0) AS issues, round(CASE WHEN issues > 0 THEN done * 100.0 / issues ELSE 0 END, 6) AS coverage FROM d LEFT JOIN i USING (year)""")
def coverage_by_year(spark, sf):
    i = table(spark, sf, "issues").where("date <> ''").groupBy(F.left("date", F.lit(4)).cast("int").alias(YEAR)).agg(F.count_distinct("lccn", "date").alias("issues"))
    d = table(spark, sf, "done").where("stage = 'pass1' AND key IS NOT NULL").groupBy(F.left("key", F.lit(4)).cast("int").alias(YEAR)).agg(F.count_distinct("key").alias("done"))
    cov = F.when(F.col("issues") > 0, F.col("done") * 100.0 / F.col("issues")).otherwise(0.0)
    return d.join(i, YEAR, "left").select(YEAR, "done", F.coalesce("issues", F.lit(0)).alias("issues"), r6(cov).alias("coverage"))


@query("""SELECT source, count(*) AS pages, count(*) FILTER (coalesce(trim(text, ' '), '') = '') AS empty_pages, coalesce(sum(length(text)), 0)::BIGINT AS chars,
count(*) FILTER (ocr_source = 'local') AS local_pages FROM documents GROUP BY 1""")
def page_census(spark, sf):
    empty = F.coalesce(F.trim("text"), F.lit("")) == ""
    return table(spark, sf, "documents").groupBy("source").agg(
        F.count(F.lit(1)).alias("pages"), F.count_if(empty).alias("empty_pages"), F.coalesce(F.sum(F.length("text")), F.lit(0)).alias("chars"),
        F.count_if(F.col("ocr_source") == "local").alias("local_pages"),
    )


# ---- joins, sets and rules --------------------------------------------------------------------


@query(f"""WITH fx(currency, usd_rate) AS (VALUES {values(dims.fx_rows())}), k AS (SELECT record_id, price_numeric AS p, lower(trim(currency_original)) AS key FROM normalized)
SELECT record_id, CASE WHEN key IN ({sql_list(dims.UNCERTAIN_NAMES)}) OR key IN ({sql_list(dims.CONTINENTAL_NAMES)}) THEN NULL
ELSE round(coalesce(a.usd_rate, b.usd_rate, c.usd_rate), 6) END AS rate FROM k LEFT JOIN fx a ON a.currency = key LEFT JOIN fx b ON b.currency = rtrim(key, 's') LEFT JOIN fx c ON c.currency = trim(replace(key, '.', ''))""")
def fx_lookup_fallback(spark, sf):
    key = F.lower(F.trim("currency_original"))
    rate = F.when(key.isin(*dims.UNCERTAIN_NAMES, *dims.CONTINENTAL_NAMES), None).otherwise(pricing.fixed_rate(F.col("currency_original")))
    return norm(spark, sf).select("record_id", r6(rate).alias("rate"))


@query("""SELECT record_id, CASE WHEN coalesce(year, 0) <= 0 THEN 0.01 WHEN year >= 1781 THEN 0.01 WHEN year >= 1780 THEN 0.025 WHEN year >= 1779 THEN 0.1 WHEN year >= 1778 THEN 0.33
WHEN year >= 1777 THEN 0.75 ELSE 1.0 END::DOUBLE AS rate FROM normalized""")
def asof_rate(spark, sf):
    return norm(spark, sf).select("record_id", pricing.continental_rate(F.col(YEAR)).alias("rate"))


@query("""SELECT n.record_id, d.ts AS done_at FROM (SELECT record_id, loaded_at, split_part(ref, '/', 1) AS lccn FROM normalized) n
ASOF LEFT JOIN (SELECT regexp_extract(key, '/([^_]+)_', 1) AS lccn, max(ts) AS ts FROM done WHERE key IS NOT NULL AND ts IS NOT NULL GROUP BY regexp_extract(key, '/([^_]+)_', 1), ts) d ON n.lccn = d.lccn AND n.loaded_at >= d.ts""")
def asof_done(spark, sf):
    """The newspaper's latest sentinel before a record was loaded."""
    left = norm(spark, sf).select("record_id", "loaded_at", F.substring_index("ref", "/", 1).alias("lccn"))
    right = table(spark, sf, "done").where("key IS NOT NULL AND ts IS NOT NULL").select(F.regexp_extract("key", "/([^_]+)_", 1).alias("lccn"), "ts", F.col("ts").alias("done_at"))
    return joins.asof(left, right, ["lccn"], "loaded_at", "ts", ["done_at"]).select("record_id", "done_at")


@query(f"""WITH b(prefix, lo, hi) AS (VALUES {values(dims.bound_rows())}), i AS (SELECT DISTINCT commodity_id FROM normalized),
r AS (SELECT commodity_id, (SELECT arg_max(prefix, length(prefix)) FROM b WHERE starts_with(commodity_id, prefix)) AS prefix FROM i)
SELECT commodity_id, r.prefix, lo, hi FROM r LEFT JOIN b USING (prefix)""")
def longest_prefix_bounds(spark, sf):
    b = dims.bound_rows()
    at = joins.longest_prefix(F.col(ID), b)
    cols = [joins.pick(at, [x[i] for x in b]).alias(n) for i, n in enumerate(("prefix", "lo", "hi"))]
    return norm(spark, sf).select(ID).distinct().select(ID, *cols)


@query("SELECT i.lccn, i.date, i.url FROM issues i WHERE NOT EXISTS (SELECT 1 FROM done d WHERE stage = 'pass1' AND d.key = left(i.date, 4) || '/' || i.lccn || '_' || i.date || '.jsonl')")
def anti_pending(spark, sf):
    """Issues that no sentinel of the stage names yet."""
    i = table(spark, sf, "issues").withColumn("key", F.concat(F.left("date", F.lit(4)), F.lit("/"), "lccn", F.lit("_"), "date", F.lit(".jsonl")))
    return sinks.pending(i, table(spark, sf, "done"), "pass1", "key").select("lccn", "date", "url")


@query("SELECT record_id FROM normalized WHERE ref IN (SELECT ref FROM prices_unresolved WHERE flagged_outlier)")
def semi_flagged(spark, sf):
    bad = table(spark, sf, "prices_unresolved").where("flagged_outlier").select("ref").distinct()
    return norm(spark, sf).join(bad, "ref", "left_semi").select("record_id")


@query("SELECT DISTINCT m.ref FROM mentions_price m WHERE m.ref IS NOT NULL AND NOT EXISTS (SELECT 1 FROM normalized n WHERE n.ref = m.ref)")
def requeue_unanswered(spark, sf):
    m = table(spark, sf, "mentions_price").where("ref IS NOT NULL").select("ref").distinct()
    return m.join(norm(spark, sf).select("ref").distinct(), "ref", "left_anti")


@query("""SELECT DISTINCT split_part(ref, '/', 1) AS lccn, regexp_extract(ref, '/(\\d{4}-\\d{2}-\\d{2})/', 1) AS date FROM normalized n
WHERE regexp_extract(ref, '/(\\d{4}-\\d{2}-\\d{2})/', 1) <> '' AND NOT EXISTS (SELECT 1 FROM issues i WHERE i.lccn = split_part(n.ref, '/', 1) AND i.date = regexp_extract(n.ref, '/(\\d{4}-\\d{2}-\\d{2})/', 1))""")
def manifest_missing(spark, sf):
    """Issues that records name and the issue list lacks."""
    named = norm(spark, sf).select(F.substring_index("ref", "/", 1).alias("lccn"), pricing.ref_date(F.col("ref")).alias("date")).where("date <> ''").distinct()
    return named.join(table(spark, sf, "issues").select("lccn", "date").distinct(), ["lccn", "date"], "left_anti")


@query("SELECT ref FROM normalized WHERE ref IS NOT NULL UNION SELECT ref FROM prices_unresolved WHERE ref IS NOT NULL")
def set_union(spark, sf):
    return norm(spark, sf).select("ref").unionByName(table(spark, sf, "prices_unresolved").select("ref")).where("ref IS NOT NULL").distinct()


@query("SELECT ref FROM normalized INTERSECT SELECT ref FROM prices_unresolved")
def set_intersect(spark, sf):
    return norm(spark, sf).select("ref").intersect(table(spark, sf, "prices_unresolved").select("ref"))


@query("SELECT ref FROM prices_unresolved EXCEPT SELECT ref FROM normalized")
def set_except(spark, sf):
    return table(spark, sf, "prices_unresolved").select("ref").subtract(norm(spark, sf).select("ref"))


@query(f"""SELECT lo, hi, count(*) AS n FROM normalized JOIN (VALUES {values(dims.YEAR_RANGES)}) r(lo, hi) ON year BETWEEN lo AND hi GROUP BY 1, 2""")
def merged_year_ranges(spark, sf):
    """The outputs of the five year ranges, merged twice over: no record is doubled."""
    rows = norm(spark, sf).select("record_id", YEAR)
    parts = [rows.where(F.col(YEAR).between(lo, hi)) for lo, hi in dims.YEAR_RANGES]
    label = joins.interval_case(F.col(YEAR), [(lo, hi, f"{lo}-{hi}") for lo, hi in dims.YEAR_RANGES])
    n = sinks.merged([*parts, *parts], "record_id").groupBy(label.alias("r")).agg(F.count(F.lit(1)).alias("n"))
    return n.select(F.split("r", "-")[0].cast("int").alias("lo"), F.split("r", "-")[1].cast("int").alias("hi"), "n")


@query("SELECT doc_id FROM documents WHERE length(trim(coalesce(text, ''), ' ')) < 80")
def short_pages(spark, sf):
    return table(spark, sf, "documents").where(~pages.long_enough(F.col("text"))).select("doc_id")


@query("""WITH r AS (SELECT ref, doc_id, CASE ocr_source WHEN 'pass0' THEN 1 WHEN 'loc' THEN 2 WHEN 'local' THEN 3 END AS p, text FROM documents WHERE length(trim(coalesce(text, ''), ' ')) > 0)
SELECT ref, arg_min(text, (p, text)) AS text FROM r WHERE p IS NOT NULL AND ref IS NOT NULL GROUP BY ref""")
def best_page_text(spark, sf):
    """For each page the condensed text, else the archive's, else the local one."""
    rows = table(spark, sf, "documents").where("ref IS NOT NULL").select("ref", F.col("ocr_source").alias("source"), "text")
    return pages.best_text(rows, ["ref"]).select("ref", "text")


@query("""WITH d AS (SELECT doc_id, ocr_source, regexp_extract(ref, '^(.*)/[^/]*$', 1) AS issue FROM documents WHERE ref IS NOT NULL AND ocr_source IS NOT NULL),
f AS (SELECT issue, bool_or(ocr_source = 'pass0') AS p FROM d GROUP BY 1) SELECT doc_id FROM d JOIN f USING (issue) WHERE (ocr_source = 'pass0') = p""")
def issue_source_choice(spark, sf):
    rows = table(spark, sf, "documents").where("ref IS NOT NULL AND ocr_source IS NOT NULL")
    rows = rows.select("doc_id", F.col("ocr_source").alias("source"), F.regexp_extract("ref", "^(.*)/[^/]*$", 1).alias("issue"))
    return pages.issue_source(rows, ["issue"]).select("doc_id")


@query("SELECT record_id, regexp_extract(ref, '/(\\d{4}-\\d{2}-\\d{2})/', 1) AS date, coalesce(TRY_CAST(left(regexp_extract(ref, '/(\\d{4}-\\d{2}-\\d{2})/', 1), 4) AS INT), 0) AS year FROM normalized")
def parse_ref_date(spark, sf):
    return norm(spark, sf).select("record_id", pricing.ref_date(F.col("ref")).alias("date"), pricing.ref_year(F.col("ref")).alias("year"))


_FIRST = "TRY_CAST(rtrim(nullif(regexp_extract(replace(price_raw, ',', ''), '\\d+\\.?\\d*'), ''), '.') AS DOUBLE)"


@query(f"""WITH x AS (SELECT record_id, price_numeric AS p, {_FIRST} AS n FROM normalized)
SELECT record_id, n AS first_number, coalesce(p > 0 AND n > 0 AND greatest(p / n, n / p) > 1000, false) AS insane FROM x""")
def price_sanity(spark, sf):
    return norm(spark, sf).select("record_id", pricing.first_number(F.col("price_raw")).alias("first_number"), pricing.insane(F.col("price_numeric"), F.col("price_raw")).alias("insane"))


@query(f"""WITH x AS (SELECT record_id, confidence AS c, price_numeric AS a, {_FIRST} AS b FROM normalized)
SELECT record_id, round(CASE WHEN a > 0 AND b > 0 AND greatest(a / b, b / a) <= 10 THEN (a + b) / 2 ELSE a END, 6) AS price,
round(CASE WHEN a IS NULL OR b IS NULL OR a <= 0 OR b <= 0 THEN least(c, 0.45) WHEN greatest(a / b, b / a) <= 10 THEN c ELSE least(c, 0.4) END, 6) AS confidence FROM x""")
def consensus_of_answers(spark, sf):
    """The stored price and the one read from the raw text as two answers."""
    rows = norm(spark, sf).withColumn("x", pricing.consensus(F.col("price_numeric"), pricing.first_number(F.col("price_raw")), F.col("confidence")))
    return rows.select("record_id", r6("x.price").alias("price"), r6("x.confidence").alias("confidence"))


@query(f"""SELECT record_id, CASE WHEN trim(lower(coalesce(unit, '')), ' ') IN ('', {sql_list(dims.VAGUE_UNITS)}) THEN c.std_unit ELSE trim(lower(unit), ' ') END AS unit,
CASE WHEN time_unit IN ({sql_list(dims.TIME_UNITS)}) THEN time_unit END AS time_unit, coalesce(c.category_l1, 'Miscellaneous') AS category_l1,
round(CASE WHEN c.commodity_id IS NULL THEN least(greatest(coalesce(n.confidence, 0), 0.5), 0.4) ELSE greatest(coalesce(n.confidence, 0), 0.5) END, 6) AS confidence
FROM normalized n LEFT JOIN commodity_ref c USING (commodity_id)""")
def normalised_fields(spark, sf):
    """Unit, time unit, category with a default row, and confidence of each record."""
    ref = table(spark, sf, "commodity_ref").select(ID, "std_unit", F.col("category_l1").alias("l1"))
    j = norm(spark, sf).join(F.broadcast(ref), ID, "left")  # the list has a fixed size
    conf = pricing.confidence(F.col("confidence"), F.col("l1").isNotNull(), F.lit(False))
    return j.select("record_id", pricing.stated_unit(F.col("unit"), F.col("std_unit")).alias("unit"), pricing.time_unit(F.col("time_unit")).alias("time_unit"),
                    F.coalesce("l1", F.lit("Miscellaneous")).alias("category_l1"), r6(conf).alias("confidence"))


@query("""SELECT record_id, round_even(CASE WHEN CASE WHEN coalesce(quantity, 0) = 0 THEN 1 ELSE quantity END > 0 THEN price_usd / CASE WHEN coalesce(quantity, 0) = 0 THEN 1 ELSE quantity END END, 6) AS per_unit FROM normalized""")
def per_unit_price(spark, sf):
    return norm(spark, sf).select("record_id", pricing.per_unit(F.col("price_usd"), F.col("quantity")).alias("per_unit"))


@query("SELECT event_type, json_extract_string(props, '$.k') AS k, count(*) AS n FROM events WHERE json_valid(props) GROUP BY 1, 2")
def json_fields(spark, sf):
    return table(spark, sf, "events").groupBy("event_type", F.get_json_object("props", "$.k").alias("k")).agg(F.count(F.lit(1)).alias("n"))


# ---- batches and control flow -----------------------------------------------------------------


@query("SELECT doc_id, source, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) // 20 AS BIGINT) AS chunk, CAST((row_number() OVER (PARTITION BY source ORDER BY doc_id) - 1) % 20 AS INT) AS idx FROM documents")
def fixed_chunks(spark, sf):
    return batching.chunks(table(spark, sf, "documents").select("doc_id", "source"), ["source"], ["doc_id"], 20)


_LANE = """WITH RECURSIVE d AS (SELECT doc_id, source, row_number() OVER (PARTITION BY source ORDER BY doc_id) AS i, CAST(ceil(length(coalesce(text, '')) / 4.0) AS BIGINT) + 20 AS size FROM documents),
"""


@query(_LANE + """p AS (SELECT doc_id, source, i, size, CAST(0 AS BIGINT) AS batch, size AS used FROM d WHERE i = 1 UNION ALL
SELECT d.doc_id, d.source, d.i, d.size, CASE WHEN p.used + d.size > 4000 THEN p.batch + 1 ELSE p.batch END, CASE WHEN p.used + d.size > 4000 THEN d.size ELSE p.used + d.size END
FROM p JOIN d ON d.source IS NOT DISTINCT FROM p.source AND d.i = p.i + 1) SELECT doc_id, batch FROM p""")
def next_fit_batches(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", (batching.text_tokens(F.col("text")) + 20).alias("size"))
    return batching.pack(d.withColumnRenamed("size", "tokens"), F.col("source"), ["doc_id"], "tokens", 4000).select("doc_id", "batch")


@query(_LANE + """p AS (SELECT doc_id, source, i, size, CAST(0 AS BIGINT) AS batch, size AS used FROM d WHERE i = 1 UNION ALL
SELECT d.doc_id, d.source, d.i, d.size, CASE WHEN p.used >= 4000 THEN p.batch + 1 ELSE p.batch END, CASE WHEN p.used >= 4000 THEN d.size ELSE p.used + d.size END
FROM p JOIN d ON d.source IS NOT DISTINCT FROM p.source AND d.i = p.i + 1) SELECT doc_id, batch FROM p""")
def whole_file_batches(spark, sf):
    d = table(spark, sf, "documents").select("doc_id", "source", (batching.text_tokens(F.col("text")) + 20).alias("tokens"))
    return batching.pack(d, F.col("source"), ["doc_id"], "tokens", 4000, whole=True).select("doc_id", "batch")


@query("""WITH m AS (SELECT *, abs(hash(0)) AS z FROM prices_unresolved), g AS (SELECT year AS batch, count(*) AS n, count(reason) AS r, count(DISTINCT reason) AS d FROM m GROUP BY 1)
SELECT batch, d = 1 AND r >= greatest(2, n // 2) AS refused FROM g""")
def refused_batches(spark, sf):
    a = table(spark, sf, "prices_unresolved").select(F.col(YEAR).alias("batch"), "reason")
    return batching.refused(a, "batch", "reason", dims.REFUSALS)


@query("""WITH b AS (SELECT record_id, price_numeric, CAST(row_number() OVER (PARTITION BY year ORDER BY record_id) - 1 AS INT) AS idx, year AS batch FROM normalized),
a AS (SELECT batch, idx, arg_max(price_numeric, record_id) AS answer FROM b WHERE idx % 3 <> 0 GROUP BY 1, 2) SELECT b.record_id, a.answer FROM b LEFT JOIN a ON a.batch = b.batch AND a.idx = b.idx""")
def answers_by_idx(spark, sf):
    """Every third input of a batch stays unanswered, some answers come twice."""
    b = norm(spark, sf).where("year IS NOT NULL").select("record_id", F.col(YEAR).alias("batch"), F.col("price_numeric").alias("p"))
    b = b.unionByName(norm(spark, sf).where("year IS NULL").select("record_id", F.col(YEAR).alias("batch"), F.col("price_numeric").alias("p")))
    b = b.withColumn("idx", F.row_number().over(Window.partitionBy("batch").orderBy("record_id")) - 1)
    a = b.where("idx % 3 <> 0 AND batch IS NOT NULL").select("batch", "idx", F.col("idx").alias("pos"), F.col("p").alias("answer"))
    early = a.withColumns({"pos": F.col("pos") - 1_000_000, "answer": F.lit(-1.0)})
    return joins.answers_to_inputs(b, a.unionByName(early)).select("record_id", "answer")


@query("""WITH v AS (SELECT ref, bool_and(coalesce(NOT flagged_outlier, true)) AS ok, bool_or(permanent) AS fix FROM prices_unresolved WHERE ref IS NOT NULL GROUP BY 1)
SELECT record_id, CASE WHEN v.ref IS NULL THEN 'pending' WHEN NOT ok THEN 'rejected' WHEN fix THEN 'fixed' ELSE 'kept' END AS status FROM normalized n LEFT JOIN v ON n.ref = v.ref""")
def verdict_merge(spark, sf):
    v = table(spark, sf, "prices_unresolved").where("ref IS NOT NULL").select("ref", F.coalesce(~F.col("flagged_outlier"), F.lit(True)).alias("confirmed"), F.col("permanent").alias("fixed"), F.col("confidence"))
    return joins.apply_verdicts(norm(spark, sf), v, "ref", ["confidence"]).select("record_id", "status")


@query("""WITH o AS (SELECT doc_id, source, regexp_extract(ref, '^(.*)/[^/]*$', 1) AS issue, lag(regexp_extract(ref, '^(.*)/[^/]*$', 1)) OVER (PARTITION BY source ORDER BY doc_id) AS before FROM documents)
SELECT doc_id, before IS NULL OR before <> issue AS header FROM o""")
def header_on_change(spark, sf):
    w = Window.partitionBy("source").orderBy("doc_id")
    d = table(spark, sf, "documents").select("doc_id", "source", F.regexp_extract("ref", "^(.*)/[^/]*$", 1).alias("issue"))
    return d.select("doc_id", F.coalesce(F.lag("issue").over(w) != F.col("issue"), F.lit(True)).alias("header"))


@query("SELECT date_trunc('hour', ts) AS start, event_type, count(*) AS n FROM events GROUP BY 1, 2")
def events_by_hour(spark, sf):
    return incremental.windowed_counts(table(spark, sf, "events"), "ts", "event_type").select(F.col("start").cast("timestamp_ntz").alias("start"), "event_type", "n")


@query("SELECT event_type, count(*) AS n FROM events GROUP BY 1")
def events_incremental(spark, sf):
    """The events through an available-now stream into a table, run twice; the second run finds nothing new."""
    root = shared_path(spark, "events")
    rows = table(spark, sf, "events").select("event_id", "event_type")
    rows.write.parquet(f"{root}/in")
    for _ in range(2):
        incremental.run_available(spark, f"{root}/in", "event_id bigint, event_type string", lambda df: df, f"{root}/out", f"{root}/checkpoint", "parquet")
    return spark.read.parquet(f"{root}/out").groupBy("event_type").agg(F.count(F.lit(1)).alias("n"))


@query("""WITH t AS (SELECT lccn, min(title) AS title FROM issues WHERE title IS NOT NULL AND trim(title, ' ') <> '' GROUP BY 1)
SELECT split_part(n.ref, '/', 1) AS lccn, coalesce(t.title, split_part(n.ref, '/', 1)) AS title, count(*) AS n FROM normalized n LEFT JOIN t ON t.lccn = split_part(n.ref, '/', 1) GROUP BY 1, 2""")
def titles_with_fallback(spark, sf):
    """Records by newspaper, named by its title where there is one; counted before the join."""
    t = table(spark, sf, "issues").where("title IS NOT NULL AND trim(title) <> ''").groupBy("lccn").agg(F.min("title").alias("t"))
    n = norm(spark, sf).groupBy(F.substring_index("ref", "/", 1).alias("lccn")).agg(F.count(F.lit(1)).alias("n"))
    return n.join(t, "lccn", "left").select("lccn", F.coalesce("t", "lccn").alias("title"), "n")


@query("SELECT coalesce(TRY_CAST(left(regexp_extract(ref, '/(\\d{4}-\\d{2}-\\d{2})/', 1), 4) AS INT), 0) AS year, t, count(*) AS n, count(price) AS priced FROM mentions_price GROUP BY 1, 2")
def mentions_by_year(spark, sf):
    m = table(spark, sf, "mentions_price")
    return m.groupBy(pricing.ref_year(F.col("ref")).alias(YEAR), "t").agg(F.count(F.lit(1)).alias("n"), F.count("price").alias("priced"))


@query("SELECT lower(trim(state, ' ')) AS state, count(*) AS n, count(DISTINCT lccn) AS papers FROM issues WHERE lower(trim(state, ' ')) IN ('ohio', 'new york') GROUP BY 1")
def issues_of_states(spark, sf):
    """The state filter, whatever the case."""
    state = F.lower(F.trim("state")).alias("state")
    return table(spark, sf, "issues").where(state.isin("ohio", "new york")).groupBy(state).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("lccn").alias("papers"))


@query("SELECT DISTINCT stage, key FROM done WHERE key IS NOT NULL QUALIFY row_number() OVER (PARTITION BY stage, key ORDER BY ts DESC) = 1")
def done_keys(spark, sf):
    """Each sentinel once, the latest of several."""
    d = table(spark, sf, "done").where("key IS NOT NULL")
    return d.groupBy("stage", "key").agg(F.max("ts").alias("ts")).select("stage", "key")


@query("""WITH r AS (SELECT category_l1, year // 10 * 10 AS decade, unit FROM normalized WHERE year > 0) SELECT category_l1, decade, count(*) AS n, grouping(category_l1, decade)::BIGINT AS level FROM r GROUP BY ROLLUP (category_l1, decade)""")
def category_rollup(spark, sf):
    rows = norm(spark, sf).where("year > 0").select("category_l1", (F.floor(F.col(YEAR) / 10) * 10).cast("int").alias("decade"))
    return rows.rollup("category_l1", "decade").agg(F.count(F.lit(1)).alias("n"), F.grouping_id().cast("bigint").alias("level"))


def _numbered_prices(spark, sf, size: int) -> DataFrame:
    m = table(spark, sf, "mentions_price").where("price IS NOT NULL").select("ref", F.col("price").alias("price_raw")).distinct()
    lanes = m.withColumn("lane", F.pmod(F.xxhash64("ref", "price_raw"), F.lit(512)))
    numbered = batching.chunks(lanes, ["lane"], ["ref", "price_raw"], size)
    return numbered.select(F.concat_ws("#", F.col("lane").cast("string"), F.col("chunk").cast("string")).alias("batch"), "idx", "price_raw")


_READ = "idx int, batch string, price_raw string, price_numeric double, currency_original string, quantity double, time_unit string, confidence double"


@query()
def prices_read_by_rule(spark, sf):
    """The price texts of all mentions through the rule backend, in batches of fifty; the backend reads no other field."""
    done = backends.run_batches(_numbered_prices(spark, sf, 50), backends.RuleBackend, _READ)
    return backends.answered(done).drop("price_raw")


class _Picky(backends.RuleBackend):
    """Fails on every batch in which a text has no digit."""

    def call(self, inputs):
        return None if any(not any(c.isdigit() for c in x["price_raw"]) for x in inputs) else super().call(inputs)


@query("""WITH p AS (SELECT DISTINCT ref, price FROM mentions_price WHERE price IS NOT NULL)
SELECT CASE WHEN regexp_matches(price, '\\d') THEN 'normalized' ELSE 'failed' END AS status, count(*) AS n FROM p GROUP BY 1""")
def routed_statuses(spark, sf):
    """Batches of eight through a backend that fails on some inputs: halving leaves just these as failed, a retry changes nothing."""
    items = _numbered_prices(spark, sf, 8)
    done = backends.retry_failed(items, backends.run_batches(items, _Picky, _READ), _Picky, _READ)
    return backends.with_status(done).groupBy("status").agg(F.count(F.lit(1)).alias("n"))
