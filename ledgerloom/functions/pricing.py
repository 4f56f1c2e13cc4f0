"""Rules on single records as column expressions: currency, units, sanity and confidence."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ledgerloom import dims

SANITY_RATIO, CONSENSUS_RATIO, CONFIDENCE_FLOOR = 1000.0, 10.0, 0.5


def sql_literal(x: object) -> str:
    if isinstance(x, (list, tuple)):
        return "array(" + ", ".join(map(sql_literal, x)) + ")"
    if isinstance(x, str):
        return "'" + x.replace("\\", "\\\\").replace("'", "\\'") + "'"
    return f"{x!r}D" if isinstance(x, float) else repr(x)


def literal_map(rows: list[tuple]) -> Column:
    """A map literal, parsed in one go; the optimizer folds it."""
    return F.expr("map(" + ", ".join(sql_literal(x) for row in rows for x in row) + ")")


def continental_rate(year: Column) -> Column:
    """As-of lookup in a handful of steps: the rate of the latest year not after the given one."""
    out = F.when(F.coalesce(year, F.lit(0)) <= 0, F.lit(0.01))
    for y, rate in sorted(dims.FX_CONTINENTAL, reverse=True):
        out = out.when(year >= y, F.lit(rate))
    return out.otherwise(1.0)


def fixed_rate(currency: Column) -> Column:
    """The rate of the name, else of the name without final s, else without points; null if none is known."""
    rates, key = literal_map(dims.fx_rows()), F.lower(F.trim(currency))
    keys = (key, F.rtrim(key, F.lit("s")), F.trim(F.replace(key, F.lit("."), F.lit(""))))
    return F.coalesce(*[F.element_at(rates, k) for k in keys])


def to_usd(price: Column, currency: Column, year: Column) -> Column:
    """struct(usd, uncertain). Null prices and currencies give (null, true)."""
    key = F.lower(F.trim(currency))
    continental, unsure = key.isin(*dims.CONTINENTAL_NAMES), key.isNull() | key.isin(*dims.UNCERTAIN_NAMES)
    rate = F.when(continental, continental_rate(year)).when(unsure, F.lit(None)).otherwise(fixed_rate(currency))
    usd = F.bround(price * rate, 6)
    return F.struct(usd.alias("usd"), (price.isNull() | rate.isNull() | F.coalesce(continental, F.lit(False))).alias("uncertain"))


def plain_unit(unit: Column) -> Column:
    """The unit's canonical name by alias, else its lower-case trimmed self; null counts as empty."""
    u = F.trim(F.lower(F.coalesce(unit, F.lit(""))))
    return F.coalesce(F.element_at(literal_map(dims.alias_rows()), u), u)


def stated_unit(unit: Column, standard: Column) -> Column:
    u = F.trim(F.lower(F.coalesce(unit, F.lit(""))))
    return F.when((u == "") | u.isin(*dims.VAGUE_UNITS), standard).otherwise(u)


def time_unit(unit: Column) -> Column:
    return F.when(unit.isin(*dims.TIME_UNITS), unit)


def per_unit(usd: Column, quantity: Column) -> Column:
    """Dollars for one unit; a missing or nought quantity counts as one, a negative one gives null."""
    q = F.when(F.coalesce(quantity, F.lit(0.0)) == 0, F.lit(1.0)).otherwise(quantity)
    return F.when(q > 0, F.bround(usd / q, 6))


def first_number(raw: Column) -> Column:
    """The first number of a text without its commas, null if there is none."""
    found = F.regexp_extract(F.replace(raw, F.lit(","), F.lit("")), r"\d+\.?\d*", 0)
    return F.when(found != "", F.rtrim(found, F.lit(".")).cast("double"))


def insane(price: Column, raw: Column) -> Column:
    """Whether a price is over a thousand times off the first number of its raw text, either way."""
    n = first_number(raw)
    return F.coalesce((price > 0) & (n > 0) & (F.greatest(price / n, n / price) > SANITY_RATIO), F.lit(False))


def consensus(first: Column, second: Column, confidence: Column) -> Column:
    """struct(price, confidence) of two answers: their mean where they agree within ten times, else the first with less confidence."""
    bad = first.isNull() | second.isNull() | (first <= 0) | (second <= 0)
    ratio = F.greatest(first / second, second / first)
    price = F.when(~bad & (ratio <= CONSENSUS_RATIO), (first + second) / 2).otherwise(first)
    sure = F.when(bad, F.least(confidence, F.lit(0.45))).when(ratio <= CONSENSUS_RATIO, confidence).otherwise(F.least(confidence, F.lit(0.4)))
    return F.struct(price.alias("price"), sure.alias("confidence"))


def confidence(stated: Column, known: Column, uncertain_fx: Column) -> Column:
    """Raised to the floor, then capped for unknown commodities and for uncertain rates, in this order."""
    c = F.greatest(F.coalesce(stated, F.lit(0.0)), F.lit(CONFIDENCE_FLOOR))
    c = F.when(known, c).otherwise(F.least(c, F.lit(0.4)))
    return F.when(uncertain_fx, F.least(c, F.lit(0.6))).otherwise(c)


def currency_bucket(currency: Column) -> Column:
    c, out = F.lower(F.coalesce(currency, F.lit(""))), None
    for name, members in dims.CURRENCY_BUCKETS.items():
        out = F.when(c.isin(*members), name) if out is None else out.when(c.isin(*members), name)
    return out.otherwise("other")


def ref_date(ref: Column) -> Column:
    """The date between slashes of a page reference, empty if there is none."""
    return F.regexp_extract(ref, r"/(\d{4}-\d{2}-\d{2})/", 1)


def ref_year(ref: Column) -> Column:
    return F.coalesce(F.left(ref_date(ref), F.lit(4)).try_cast("int"), F.lit(0))


def item_cluster(item: Column) -> Column:
    """The first three lower-case words."""
    return F.array_join(F.slice(F.split(F.trim(F.lower(item)), r"\s+"), 1, 3), " ")
