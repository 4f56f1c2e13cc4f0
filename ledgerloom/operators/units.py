"""Problem 5: quantities recorded in different units, sometimes with the unit only in the text.

1. Each row's label is the unit phrase that its text prices by, else what its unit column says.
2. A source is a newspaper's use of one label. The same entity (a commodity in a decade) is linked across the sources
   that price it: every source is paired with the HUBS largest of its entity, never all with all.
   Robust pairwise scale of two labels: the median, over all their pairs of sources, of the difference of median log
   prices. Offset: from a resistant line through the lower and upper third of those pairs.
3. Labels that are letter for letter a unit of the reference list are anchors. A label linked to settled ones takes the known
   conversion to which its scale against them snaps; offsets snap to nought, as no known conversion has another, and
   links with a plain offset are refused. Labels settled so anchor the next round, until a round settles none, so
   conversions spread through the whole graph of sources.
4. Words (UNIT_FORMS) settle what the graph leaves in doubt, and have the last word where both speak.
5. Prices are divided by the conversion to the commodity's standard unit.

Everything between the two scans of the rows is as large as the vocabulary of labels and newspapers, not as the rows.
"""

from __future__ import annotations

import functools
import math
from collections.abc import Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.functions.tokensets import TokenSets, edits, meant, words
from ledgerloom.session import cut_lineage

#: Maps above this many bytes are joined by a shuffle instead of a broadcast.
BROADCAST_BYTES = 16 << 20
#: A scale snaps to a conversion within this factor, if the next one is at least twice as far off.
SNAP = math.log(1.25)
#: Largest sources of an entity that its other sources are paired with.
HUBS = 3
#: Pairs of sources and rows that a label must share with settled ones.
LEAST_PAIRS, LEAST_ROWS = 3, 10
#: A link of so many pairs is refused where its offset makes up this share of the price; hub prices must spread by this factor to tell.
OFFSET_PAIRS, MOST_OFFSET, OFFSET_SPREAD = 12, 0.5, 1.5

#: Usual ways to write the units, as plain words.
UNIT_FORMS = {
    "pound": "lb, lbs, pd, pds, pound, pounds",
    "hundredweight": "cwt, hundredweight, hundred weight, hundwt, cental, centals, 100 lb, 100 lbs, 100 pounds, hundred pounds",
    "ton": "ton, tons, tn, tun, 2000 lbs, 2000 pounds",
    "ounce": "oz, ounce, ounces",
    "bushel": "bu, bus, bush, bushl, bushel, bushels",
    "peck": "pk, pck, peck, pecks",
    "barrel": "bbl, bbls, brl, barrel, barrels",
    "gallon": "gal, gall, gals, gallon, gallons",
    "quart": "qt, qts, quart, quarts",
    "pint": "pt, pts, pint, pints",
    "yard": "yd, yds, yard, yards",
    "foot": "ft, foot, feet, running foot",
    "dozen yards": "12 yds, 12 yards, doz yds, doz yards, dozen yds, dozen yards",
    "pair": "pair, pairs, pr, span",
    "dozen pairs": "12 pairs, 12 pr, doz pr, doz pairs, dozen pairs",
    "gross pairs": "gross, gross pairs, gross of pairs",
    "day": "day, days, dy, diem",
    "week": "week, weeks, wk, wks",
    "month": "mo, mos, mth, month, months",
    "year": "yr, yrs, year, years, annum",
    "acre": "ac, acre, acres",
    "section": "sec, section, sec of 640 acres, section of 640 acres",
    "quarter section": "quarter section, qr section, 1/4 section, quarter sec",
    "thousand board feet": "m feet, m ft, m ft b m, 1000 ft, 1000 feet, thousand feet, thousand ft, thousand board feet",
    "hundred board feet": "c feet, c ft, 100 ft, 100 feet, hundred feet, hundred ft, hundred board feet",
    "head": "head, hd, animal",
    "dozen": "doz, dz, dozen, 12",
    "hundred": "hundred, hund, 100, c",
    "ticket": "ticket, tickets, tkt, admission, seat",
    "trip": "trip, trips, passage",
    "round trip": "round trip, return trip, trip there and back",
    "dozen trips": "12 trips, doz trips, dozen trips",
}
#: What a unit column says when it says nothing.
VAGUE = ("", "n a", "n/a", "na", "see text", "lot", "case", "item", "unit", "none", "null", "package")

_NUMBER = r"\d+(?:\.\d+)?"
_PRICE = rf"(?:[$£] ?{_NUMBER}|{_NUMBER} ?(?:cents?|cts?|c|dollars?|dolls?|dols?)(?![a-z]))"


def plain(text: Column) -> Column:
    """Lower-case words with ` ; ` around fields; slashes read as per, punctuation gone but for points inside numbers."""
    t = F.regexp_replace(F.lower(text), r"(?<=\d),(?=\d{3}(?!\d))|['’]", "")
    t = F.regexp_replace(t, r"(?<=\d)\.(?=\d)", "\u0001")
    t = F.regexp_replace(t, r"(?<!\d)/|/(?!\d)", " per ")
    t = F.regexp_replace(t, r"[;|\r\n]+", " ; ")
    t = F.regexp_replace(t, r"[^\p{L}\p{N}$£/;\x01]+", " ")
    return F.concat(F.lit("; "), F.trim(F.translate(t, "\u0001", ".")), F.lit(" ;"))


def stated_unit(p: Column) -> Column:
    """The words that plain() text prices by (per lb., a pound, 3 lbs for ..., ... for 2 cwt), else null."""
    after = F.regexp_extract(p, rf"{_PRICE} (?:net )?(?:per|for each|by the|pr|each|an|a|the)(?= )(?! whole) ([^;]+?) ;", 1)
    before = F.regexp_extract(p, rf"; per ([^;]+?) {_PRICE}", 1)
    lot = F.regexp_extract(p, rf"; {_NUMBER} ([^;]+?) (?:for|at) {_PRICE}", 1)
    of = F.regexp_extract(p, rf"{_PRICE} for {_NUMBER} ([^;]+?) ;", 1)
    return F.coalesce(*[F.nullif(x, F.lit("")) for x in (after, before, lot, of)])


def unit_label(unit: Column) -> Column:
    """The words of a unit column, null where it is vague."""
    t = F.trim(F.regexp_replace(F.regexp_replace(F.lower(unit), r"['’]", ""), r"[^\p{L}\p{N}/]+", " "))
    t = F.regexp_replace(t, r"^(?:per|by the|for each|an|a|the|each) ", "")
    return F.when(t.isin(*VAGUE), None).otherwise(t)


class UnitNames:
    """Which unit_name of a commodity a label's words name; the label may end in words of another kind."""

    def __init__(self, units: dict[str, list[str]], forms: dict[str, str]):
        self.forms = {
            c: {f: u for u in us for f in ({u} | set(forms.get(u, "").split(", "))) - {""}} for c, us in units.items()
        }

    def name(self, commodity: str, label: str | None) -> str | None:
        forms = self.forms.get(commodity)
        if not forms or not label:
            return None
        tokens = label.split()
        for n in range(len(tokens), 0, -1):
            head = " ".join(tokens[:n])
            if head in forms:
                return forms[head]
            near = {u for f, u in forms.items() if len(f) >= 4 and abs(len(f) - len(head)) <= 1 and edits(head, f, 1) <= 1}
            if len(near) == 1:
                return near.pop()
        return None


class CommodityNames:
    """The entry that a typed commodity means: by id or by name, in other dress or misspelt; else None."""

    def __init__(self, entries: list[tuple[str, str]]):
        forms: dict[str, set[str]] = {}
        for e, name in entries:
            own = words(e)
            for form in {" ".join(own), " ".join(words(name)), " ".join(own[1:])} - {""}:
                forms.setdefault(form, set()).add(e)
        single = {f: next(iter(es)) for f, es in forms.items() if len(es) == 1}
        self.ids, self.exact = {e for e, _ in entries}, single
        self.similar = TokenSets({f: e for f, e in single.items() if len(f) > 3})

    def entry(self, value: str | None) -> str | None:
        if value is None or value in self.ids:
            return value
        tokens = words(value)
        whole = self.exact.get(" ".join(tokens))
        if whole:
            return whole
        near, cost = self.similar.best(tokens)
        if near and cost <= 1:
            return near
        spans = [(i, j) for i in range(len(tokens)) for j in range(i + 1, len(tokens) + 1) if " ".join(tokens[i:j]) in self.exact]
        if spans:  # an id or name among other words; of several the longest, if it is one entry's
            longest = max(len(" ".join(tokens[i:j])) for i, j in spans)
            best = [(i, j) for i, j in spans if len(" ".join(tokens[i:j])) == longest]
            inside = {self.exact[" ".join(tokens[i:j])] for i, j in best}
            if len(inside) == 1 and (near is None or near in inside) and meant(value, tokens[slice(*best[0])]):
                return inside.pop()
        return near


def _small(df: DataFrame, columns: list[str]) -> bool:
    """Whether the columns' letters and a fixed share for each row stay within BROADCAST_BYTES; else the shuffle joins."""
    bytes_ = F.sum(sum((F.coalesce(F.octet_length(c), F.lit(0)) for c in columns), F.lit(64)))
    return (df.agg(bytes_).first()[0] or 0) <= BROADCAST_BYTES


def labelled(rows: DataFrame) -> DataFrame:
    """record_id, paper, typed (commodity as typed), by_text, by_unit, price, decade of the rows that have a price."""
    price = F.col("price_per_unit_usd").cast("double")
    priced = rows.where(price.isNotNull() & ~F.isnan(price) & F.col("commodity_id").rlike(r"\S")).select(
        "record_id",
        (F.substring_index("ref", "/", 1) if "ref" in rows.columns else F.lit(None).cast("string")).alias("paper"),
        F.col("commodity_id").alias("typed"),
        plain(F.col("original_text")).alias("plain"),
        unit_label(F.col("unit")).alias("by_unit"),
        price.alias("price"),
        F.floor(F.col("year") / 10).alias("decade"),
    )
    return priced.select("record_id", "paper", "typed", stated_unit(F.col("plain")).alias("by_text"), "by_unit", "price", "decade")


def label_levels(marked: DataFrame, commodity_ref: DataFrame, unit_ref: DataFrame, forms: dict[str, str]) -> tuple[DataFrame, DataFrame, DataFrame]:
    """(named, level, conversions).

    named: typed, label -> entry, anchor (the unit that the label is letter for letter), worded (the unit that its words
    name by forms), either may be null. level: the median log price and number of rows of each entry, newspaper, label and
    decade. conversions: entry, unit -> std_unit, std_per_unit.
    """
    entries = [tuple(r) for r in commodity_ref.select("commodity_id", "commodity_name").dropna().distinct().collect()]
    units: dict[str, list[str]] = {}
    for r in unit_ref.select("commodity_id", "unit_name").dropna().distinct().collect():
        units.setdefault(r.commodity_id, []).append(r.unit_name)

    def name(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        entry = functools.lru_cache(1 << 16)(CommodityNames(entries).entry)
        unit = functools.lru_cache(1 << 16)(UnitNames(units, forms).name)
        own = {(e, u) for e, us in units.items() for u in us}
        for pdf in batches:
            found = [entry(x) for x in pdf["typed"]]
            both = list(zip(found, pdf["label"], strict=True))
            yield pd.DataFrame({
                "typed": pdf["typed"], "label": pdf["label"], "entry": found,
                "anchor": [x if (e, x) in own else None for e, x in both], "worded": [unit(e, x) for e, x in both],
            }, dtype=object)

    # one pass over the rows: every label of either kind, with the prices it was used for by newspaper and decade
    label = F.explode(F.array_distinct(F.array(F.col("by_text"), F.col("by_unit")))).alias("label")
    uses = marked.select("typed", "paper", "decade", "price", label, F.coalesce("by_text", "by_unit").alias("used")).where(F.col("label").isNotNull())
    used = (F.col("used") == F.col("label")) & (F.col("price") > 0)
    stats = uses.groupBy("typed", "label", F.when(used, F.col("paper")).alias("paper"), F.when(used, F.col("decade")).alias("decade")).agg(
        F.count_if(used).alias("n"), F.percentile_approx(F.when(used, F.log("price")), 0.5, 200).alias("level")
    )
    stats = cut_lineage(stats)
    kinds = "typed string, label string, entry string, anchor string, worded string"
    named = cut_lineage(stats.select("typed", "label").distinct().mapInPandas(name, kinds)).where(F.col("entry").isNotNull())
    conversions = unit_ref.select(F.col("commodity_id").alias("entry"), F.col("unit_name").alias("unit"), "std_unit", "std_per_unit").dropna()
    level = (
        stats.where("n > 0 AND decade IS NOT NULL").join(named.select("typed", "label", "entry"), ["typed", "label"])
        .groupBy("entry", "paper", "label", "decade")
        .agg(F.sum("n").alias("n"), (F.sum(F.col("n") * F.col("level")) / F.sum("n")).alias("level"))
    )
    return named, level, conversions.dropDuplicates(["entry", "unit"])


def links(level: DataFrame) -> DataFrame:
    """entry, label, other -> scale, offset, pairs, n: label's prices against other's, both ways round.

    Each source is paired with the HUBS largest sources of its entity. Offset is the share of label's price that a line
    through the lower and upper third of the pairs leaves at nought, null where the prices do not spread enough to tell.
    """
    place = Window.partitionBy("entry", "decade").orderBy(F.desc("n"), "label", "paper")
    hubs = level.withColumn("place", F.row_number().over(place)).where(F.col("place") <= HUBS)  # ranked before the shuffle too
    hubs = hubs.select("entry", "decade", F.col("label").alias("other"), F.col("n").alias("m"), F.col("level").alias("at"))
    pairs = level.join(hubs, ["entry", "decade"]).where(F.col("label") != F.col("other"))
    pairs = pairs.select("entry", "label", "other", F.least("n", "m").alias("n"), "level", "at")
    key = ["entry", "label", "other"]
    # both ways round, so that a label is linked whether it or the other was the hub
    turned = pairs.select("entry", F.col("other").alias("label"), F.col("label").alias("other"), "n", F.col("at").alias("level"), F.col("level").alias("at"))
    both = cut_lineage(pairs.unionByName(turned))
    scales = both.groupBy(*key).agg(
        F.expr("percentile_approx(level - at, 0.5)").alias("scale"), F.count(F.lit(1)).alias("pairs"), F.sum("n").alias("n"),
        F.expr("percentile_approx(at, array(0.3333, 0.6667))").alias("thirds"),
    )
    low, high = F.col("at") <= F.col("thirds")[0], F.col("at") >= F.col("thirds")[1]
    mid = lambda where, x: F.exp(F.percentile_approx(F.when(where, F.col(x)), 0.5))
    lines = both.join(scales.where(F.col("pairs") >= OFFSET_PAIRS).select(*key, "thirds"), key).groupBy(*key).agg(
        mid(low, "at").alias("x0"), mid(low, "level").alias("y0"), mid(high, "at").alias("x1"), mid(high, "level").alias("y1")
    )
    at_nought = (F.col("y0") * F.col("x1") - F.col("y1") * F.col("x0")) / (F.col("x1") - F.col("x0"))
    offset = F.when(F.col("x1") >= OFFSET_SPREAD * F.col("x0"), at_nought / ((F.col("y0") + F.col("y1")) / 2))
    return scales.drop("thirds").join(lines.select(*key, offset.alias("offset")), key, "left")


def snapped(linked: DataFrame, settled: DataFrame, conversions: DataFrame) -> DataFrame:
    """entry, label, scale, offset, pairs, n, unit, clear: each label's scale against the settled ones, by the standard unit, the nearest conversion, and whether it is beyond doubt.

    Links with a plain offset are left out: they are no conversion by a factor.
    """
    known = settled.join(conversions, ["entry", "unit"]).select("entry", F.col("label").alias("other"), F.log("std_per_unit").alias("of_other"))
    plain_ = F.coalesce(F.abs("offset") <= MOST_OFFSET, F.lit(True))
    scales = linked.where(plain_).join(known, ["entry", "other"]).groupBy("entry", "label").agg(
        F.expr("percentile(scale + of_other, 0.5, n)").alias("scale"), F.max_by("offset", "n").alias("offset"),
        F.sum("pairs").alias("pairs"), F.sum("n").alias("n"),
    )
    off = F.abs(F.col("scale") - F.log("std_per_unit"))
    own = ["entry", "label", "scale", "offset", "pairs", "n"]
    ranked = scales.join(conversions, "entry").groupBy(*own).agg(F.array_sort(F.collect_list(F.struct(off.alias("off"), F.col("unit")))).alias("by"))  # as many as a commodity has units
    clear = (F.col("by")[0]["off"] <= SNAP) & ((F.size("by") == 1) | (F.get("by", F.lit(1))["off"] >= 2 * F.col("by")[0]["off"]))
    clear &= (F.col("pairs") >= LEAST_PAIRS) & (F.col("n") >= LEAST_ROWS)
    return ranked.select(*own, F.col("by")[0]["unit"].alias("unit"), clear.alias("clear"))


def settle(named: DataFrame, level: DataFrame, conversions: DataFrame) -> DataFrame:
    """entry, label -> unit, by: anchors, then by scale in rounds until one settles no more, then by words, and by scale once more.

    Where words name another unit than the scale does, they win.
    """
    words_of = cut_lineage(named.groupBy("entry", "label").agg(F.max("anchor").alias("anchor"), F.max("worded").alias("worded")))
    linked = cut_lineage(links(level))
    settled = words_of.select("entry", "label", F.col("anchor").alias("unit"), F.lit("anchor").alias("by")).where("unit IS NOT NULL")
    for last in (False, True):
        if last:
            rest = words_of.where("worded IS NOT NULL").join(settled, ["entry", "label"], "left_anti")
            settled = settled.unionByName(cut_lineage(rest.select("entry", "label", F.col("worded").alias("unit"), F.lit("words").alias("by"))))
        while True:
            rest = linked.join(settled, ["entry", "label"], "left_anti")
            found = snapped(rest, settled.select("entry", "label", "unit"), conversions).where("clear").select("entry", "label", "unit")
            found = found.join(words_of, ["entry", "label"]).where("worded IS NULL OR worded = unit").select("entry", "label", "unit", F.lit("scale").alias("by"))
            found = cut_lineage(found)
            if not found.take(1):
                break
            settled = settled.unionByName(found)  # written tables put together
    return settled


def unsettled_labels(rows: DataFrame, commodity_ref: DataFrame, unit_ref: DataFrame, forms: dict[str, str] | None = None) -> DataFrame:
    """entry, label, n, decades: labels with prices that neither words nor scales settle, whose rows to_standard_units() leaves out."""
    named, level, conversions = label_levels(labelled(rows), commodity_ref, unit_ref, UNIT_FORMS if forms is None else forms)
    rest = level.join(settle(named, level, conversions), ["entry", "label"], "left_anti")
    return rest.groupBy("entry", "label").agg(F.sum("n").alias("n"), F.count_distinct("decade").alias("decades"))


def label_units(marked: DataFrame, commodity_ref: DataFrame, unit_ref: DataFrame, forms: dict[str, str]) -> DataFrame:
    """typed, label -> entry, quoted_unit, std_unit, std_per_unit, by for the labels that could be settled."""
    named, level, conversions = label_levels(marked, commodity_ref, unit_ref, forms)
    settled = settle(named, cut_lineage(level), conversions)
    return (
        named.select("typed", "label", "entry").join(settled, ["entry", "label"]).join(conversions, ["entry", "unit"])
        .select("typed", "label", "entry", F.col("unit").alias("quoted_unit"), "std_unit", "std_per_unit", "by")
    )


def label_scales(rows: DataFrame, commodity_ref: DataFrame, unit_ref: DataFrame) -> DataFrame:
    """entry, label, n, pairs, scale, offset, scale_unit, named_unit, agrees: what the prices alone say of every label, beside what its words say."""
    named, level, conversions = label_levels(labelled(rows), commodity_ref, unit_ref, UNIT_FORMS)
    anchors = named.select("entry", "label", F.col("anchor").alias("unit")).where("unit IS NOT NULL").distinct()
    found = snapped(links(cut_lineage(level)), anchors, conversions).where("clear")
    words_of = named.select("entry", "label", F.col("worded").alias("named_unit")).where("named_unit IS NOT NULL").distinct()
    both = found.join(words_of, ["entry", "label"], "left")
    return both.select("entry", "label", "n", "pairs", "scale", "offset", F.col("unit").alias("scale_unit"), "named_unit", (F.col("unit") == F.col("named_unit")).alias("agrees"))


def to_standard_units(rows: DataFrame, commodity_ref: DataFrame, unit_ref: DataFrame, forms: dict[str, str] | None = None) -> DataFrame:
    """record_id, entry, quoted_unit, std_unit, price_per_std_unit, by of every row whose unit could be settled; by tells how.

    Rows without a price, without a commodity of the list or without any settled unit give nothing.
    Null or empty texts fall back on the unit column. Empty tables give an empty result. Columns beyond
    those named in labelled() are not read. forms: other words for the units than UNIT_FORMS; {} leaves all to anchors and scales.
    """
    marked = cut_lineage(labelled(rows))
    found = cut_lineage(label_units(marked, commodity_ref, unit_ref, UNIT_FORMS if forms is None else forms))
    sized = F.broadcast if _small(found, found.columns[:5]) else lambda df: df
    values = F.struct("entry", "quoted_unit", "std_unit", "std_per_unit", "by")
    by_text = found.select("typed", F.col("label").alias("by_text"), values.alias("t"))
    by_unit = found.select("typed", F.col("label").alias("by_unit"), values.alias("u"))
    joined = marked.join(sized(by_text), ["typed", "by_text"], "left").join(sized(by_unit), ["typed", "by_unit"], "left")
    got = joined.select("record_id", "price", F.coalesce("t", "u").alias("f")).where("f IS NOT NULL")
    return got.select("record_id", "f.entry", "f.quoted_unit", "f.std_unit", (F.col("price") / F.col("f.std_per_unit")).alias("price_per_std_unit"), "f.by")
