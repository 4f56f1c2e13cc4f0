"""Small lookup tables. All of these are fixed values."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

#: US dollars for one unit of a currency, by its lower-case name.
FX_FIXED = """
usd 1.0 | dollar 1.0 | dollars 1.0 | cent 0.01 | cents 0.01 | gbp 4.44 | pound 4.44 | pounds 4.44 | pound sterling 4.44 | £ 4.44 | shilling 0.222 |
shillings 0.222 | s 0.222 | pence 0.0185 | penny 0.0185 | d 0.0185 | farthing 0.0046 | old tenor 0.222 | old tenor pound 0.222 | lawful money 3.33 |
lawful money pound 3.33 | york currency shilling 0.125 | york shilling 0.125 | spanish dollar 1.0 | peso 1.0 | real 0.125 | reales 0.125 | maravedi 0.00185 |
maravedis 0.00185 | franc 0.193 | francs 0.193 | livre 0.193 | livres 0.193 | bit 0.125 | bits 0.125 | half-bit 0.0625 | picayune 0.0625 | picayunes 0.0625
"""
#: US dollars for a continental dollar from a year on; before all of them 1.0, without a year 0.01.
FX_CONTINENTAL = ((1775, 1.0), (1776, 1.0), (1777, 0.75), (1778, 0.33), (1779, 0.10), (1780, 0.025), (1781, 0.01))
CONTINENTAL_NAMES = ("continental", "continental dollar", "continental dollars", "continental currency")
UNCERTAIN_NAMES = ("uncertain", "unknown", "", "other")
#: Plain names of units by their aliases.
UNIT_ALIASES = {
    "bushel": "bu, bu., bus, buses, bushels", "peck": "peck, pecks", "gallon": "gallon, gallons, gal", "barrel": "barrel, barrels, bbl", "hogshead": "hogshead",
    "pound": "pound, pounds, lb, lbs", "ounce": "oz, ounce, ounces", "hundredweight": "hundredweight, cwt, cental, 100 lb, 100 lbs", "ton": "ton, tons",
    "dozen": "dozen, doz", "each": "each, unit, item", "head": "head", "acre": "acre, acres", "day": "day, daily", "week": "week, weekly",
    "month": "month, monthly", "year": "year, annual, annually", "hour": "hour", "cord": "cord", "box": "box", "case": "case", "sack": "sack", "package": "package",
}
SIXTY_POUNDS = ("60 lbs", "bushel")
#: Units accepted for the commodities whose id begins so; the longest beginning counts.
CANONICAL_UNITS = """
FOOD-GRAIN-WHEAT: bushel hundredweight pound; FOOD-GRAIN-CORN: bushel hundredweight pound; FOOD-GRAIN-FLOUR: barrel hundredweight pound sack;
FOOD-GRAIN-OATS: bushel pound hundredweight; FOOD-GRAIN-RYE: bushel pound; FOOD-GRAIN-BARLEY: bushel pound; FOOD-GRAIN-RICE: pound hundredweight bushel;
FOOD-MEAT-BEEF: pound hundredweight barrel; FOOD-MEAT-PORK: pound hundredweight barrel; FOOD-MEAT-POULTRY: pound dozen each; FOOD-MEAT-MUTTON: pound hundredweight;
FOOD-DAIRY-BUTTER: pound dozen; FOOD-DAIRY-CHEESE: pound; FOOD-DAIRY-MILK: gallon quart pint; FOOD-DAIRY-EGGS: dozen each; FOOD-POTATO: bushel pound hundredweight;
FOOD-BEV-COFFEE: pound; FOOD-BEV-TEA: pound ounce; FOOD-BEV-SUGAR: pound hundredweight; FOOD-BEV-MOLASSES: gallon barrel; FOOD-BEV-WHISKEY: gallon barrel;
FOOD-BEV-WINE: gallon bottle; LABOR-UNSKILLED: day week month hour year; LABOR-SKILLED: day week month hour year; LABOR-AGRI: day week month year;
LABOR-DOMESTIC: week month year; LABOR-FARM: day week month year; LABOR-PROFESSIONAL: year month week day; TRANS-HORSE: each head; TRANS-FARE-RAIL: each;
REAL-LAND: acre; REAL-HOUSE-SALE: each; RAW-COAL: ton hundredweight bushel; RAW-WOOD: cord thousand board; RAW-IRON: ton hundredweight pound; RAW-COTTON: pound bale;
RAW-WOOL: pound; RAW-LEATHER: pound side each; GOODS-CLOTHING: each yard dozen; GOODS-BOOTS-SHOES: each pair
"""
#: Least and greatest plausible dollars a unit, by the beginning of the commodity's id.
PRICE_BOUNDS = """
FOOD-GRAIN-WHEAT 0.05 20; FOOD-GRAIN-CORN 0.02 15; FOOD-GRAIN-OATS 0.02 10; FOOD-GRAIN-RYE 0.02 10; FOOD-GRAIN-BARLEY 0.02 10; FOOD-GRAIN-RICE 0.005 5;
FOOD-GRAIN-FLOUR 0.5 50; FOOD-MEAT-BEEF 0.01 5; FOOD-MEAT-PORK 0.01 5; FOOD-MEAT-POULTRY 0.01 5; FOOD-MEAT-MUTTON 0.01 5; FOOD-DAIRY-BUTTER 0.01 3;
FOOD-DAIRY-CHEESE 0.01 3; FOOD-DAIRY-MILK 0.01 5; FOOD-DAIRY-EGGS 0.01 5; FOOD-POTATO 0.01 10; FOOD-BEV-COFFEE 0.01 10; FOOD-BEV-TEA 0.01 20;
FOOD-BEV-SUGAR 0.001 5; FOOD-BEV-MOLASSES 0.01 5; LABOR 0.01 100000; REAL-LAND 0.1 100000; TRANS-HORSE 1 5000
"""
#: Units that say nothing, and time units that are kept.
VAGUE_UNITS = ("item", "service", "reward", "incident", "unit", "thing", "event", "transaction", "case", "instance", "occurrence")
TIME_UNITS = ("year", "month", "week", "day")
#: Reasons that refuse a batch as a whole.
REFUSALS = (
    "batch parsing not performed", "not parsed", "not mapped", "requires domain mapping", "ambiguous item or price not parsed", "ambiguous or non-price textual entry",
)
#: Eras, spans of events and the year ranges of parallel runs; both ends belong to them.
ERAS = (("colonial", 1770, 1791), ("early republic", 1792, 1860), ("civil war & after", 1861, 1882))
EVENT_SPANS = ((1861, 1865, "Civil War"), (1898, 1898, "Spanish-Am."), (1917, 1918, "WWI"), (1929, 1933, "Depression"), (1939, 1945, "WWII"), (1950, 1953, "Korea"))
YEAR_RANGES = ((1884, 1900), (1901, 1915), (1916, 1930), (1931, 1945), (1946, 1963))
#: Families of currencies.
CURRENCY_BUCKETS = {
    "USD/cents": ("usd", "dollar", "cent", "cents", "$"),
    "shilling/pence": ("shilling", "pence", "penny", "pound sterling", "s", "d"),
    "other colonial": ("old tenor", "lawful money", "continental", "livre", "real", "reale", "maravedi"),
}


def fx_rows() -> list[tuple[str, float]]:
    return [(name.strip(), float(rate)) for name, _, rate in (x.strip().rpartition(" ") for x in FX_FIXED.split("|"))]


def alias_rows() -> list[tuple[str, str]]:
    return [(a, unit) for unit, aliases in UNIT_ALIASES.items() for a in aliases.split(", ")] + [SIXTY_POUNDS]


def canonical_rows() -> list[tuple[str, list[str]]]:
    return [(p.strip(), units.split()) for p, _, units in (x.partition(":") for x in CANONICAL_UNITS.split(";"))]


def bound_rows() -> list[tuple[str, float, float]]:
    return [(p, float(lo), float(hi)) for p, lo, hi in (x.split() for x in PRICE_BOUNDS.split(";"))]


def dim(spark: SparkSession, name: str) -> DataFrame:
    """One of the tables above as a DataFrame of at most a few dozen rows."""
    rows, schema = {
        "fx": (fx_rows, "currency string, usd_rate double"),
        "continental": (lambda: list(FX_CONTINENTAL), "year_from int, rate double"),
        "unit_alias": (alias_rows, "raw string, canon string"),
        "canonical_units": (canonical_rows, "prefix string, units array<string>"),
        "price_bounds": (bound_rows, "prefix string, lo double, hi double"),
        "era": (lambda: list(ERAS), "era string, lo int, hi int"),
        "event_span": (lambda: list(EVENT_SPANS), "lo int, hi int, label string"),
        "year_range": (lambda: list(YEAR_RANGES), "lo int, hi int"),
    }[name]
    return spark.createDataFrame(rows(), schema)
