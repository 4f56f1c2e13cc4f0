import numpy as np
from pyspark.sql import functions as F

from ledgerloom.operators import units


def stated(spark, *texts):
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, original_text string").withColumn("p", units.plain(F.col("original_text")))
    return [r.u for r in df.select("i", units.stated_unit(F.col("p")).alias("u")).orderBy("i").collect()]


def test_unit_phrases(spark):
    got = stated(
        spark, "lot 5; wheat; $1.20 per bu.; 60 bales received", "per lb. 5.2 cts.|x", "oats\n3 bu at $2.50 the whole", "$2.91 for 2 yd.", "11 100 lbs. for $6,277.50",
        "x; 5 c./Lb.; y", "at 3 dollars by the yr", "2 c. for each hund'wt", "terms cash; $4 net; 12 kegs offered", "$27 - a! \"M feet\"", "", None, "@ $143.90 pr. tons; lot 1",
    )
    assert got == ["bu", "lb", "bu", "yd", "100 lbs", "lb", "yr", "hundwt", None, "m feet", None, None, "tons"]


def test_names():
    n = units.UnitNames({"W": ["bushel", "pound", "hundredweight"], "T": ["ticket", "hundred", "dozen"]}, units.UNIT_FORMS)
    assert [n.name("W", x) for x in ("bushl", "ponnd", "cental", "lb sharp", "lot", None, "ton")] == ["bushel", "pound", "hundredweight", "pound", None, None, None]
    assert n.name("T", "100") == "hundred" and n.name("X", "lb") is None
    c = units.CommodityNames([("FOOD-GRAIN-WHEAT", "Wheat"), ("RAW-WOOL", "Raw Wool")])
    got = [c.entry(x) for x in ("FOOD-GRAIN-WHEAT", "food - grain - wheat", "FOOD-GARIN-WHEAT", "WHEAT?", "RMR-WOOL", "PIANOFORTE", "", None)]
    assert got == ["FOOD-GRAIN-WHEAT"] * 4 + ["RAW-WOOL", None, None, None]


def tables(spark, rows):
    cols = "record_id string, commodity_id string, original_text string, unit string, price_per_unit_usd double, year int, entry int"
    ref = spark.createDataFrame([("GRAIN", "Grain", "bushel")], "commodity_id string, commodity_name string, std_unit string")
    conv = spark.createDataFrame([("GRAIN", "bushel", "bushel", 1.0), ("GRAIN", "ton", "bushel", 33.3), ("GRAIN", "pound", "bushel", 1 / 60)],
                                 "commodity_id string, unit_name string, std_unit string, std_per_unit double")
    return spark.createDataFrame(rows, cols), ref, conv


def test_scales_settle_labels_without_a_known_name(spark):
    r = np.random.default_rng(2)
    rows = []
    for i in range(600):
        year, base = 1800 + i % 60, float(np.exp(r.normal(0, 0.1)))
        label, factor = [("bu", 1), ("zentner-x", 33.3), ("quux", 1 / 60), ("lb", 1 / 60)][i % 4]
        rows.append((f"r{i}", "GRAIN", f"lot; ${base * factor:.6f} per {label}", None, base * factor, year, 1))
    rows.append(("odd", "GRAIN", None, "rare label", 1.0, 1800, 1))
    rows.append(("vague", "GRAIN", "", "see text", 1.0, 1800, 1))
    rows.append(("null", "GRAIN", "x; $1 per bu", "bu", None, None, 1))
    got = {x.record_id: x for x in units.to_standard_units(*tables(spark, rows)).collect()}
    assert {got[f"r{i}"].quoted_unit for i in range(1, 600, 4)} == {"ton"}
    assert {got[f"r{i}"].quoted_unit for i in range(2, 600, 4)} == {"pound"}
    assert all(0.5 < x.price_per_std_unit < 2 for k, x in got.items())
    assert not {"odd", "vague", "null"} & set(got)
    said = units.label_scales(*tables(spark, rows)).collect()
    assert all(x.agrees for x in said if x.named_unit)


def test_empty_tables(spark):
    df, ref, conv = tables(spark, [("a", "GRAIN", "$1 per bu", "bu", 1.0, 1800, 1)])
    assert units.to_standard_units(df.limit(0), ref, conv).count() == 0
    assert units.to_standard_units(df, ref.limit(0), conv).count() == 0
    assert units.to_standard_units(df, ref, conv.limit(0)).count() == 0


def test_scales_spread_until_nothing_changes(spark):
    """Labels that follow one another over the decades: each shares three decades with the one before only."""
    rows = []
    for step, label in enumerate(["bu", "quux", "zorb", "mimsy", "wabe"]):
        for decade in range(3 * step, 3 * step + 6):
            rows += [(f"{label}{decade}-{i}", "GRAIN", f"lot; $1 per {label}", None, 1.0 + i / 100, 1700 + 10 * decade, 1) for i in range(5)]
    rows.append(("lone", "GRAIN", "lot; $1 per borogove", None, 1.0, 1400, 1))
    got = {r.record_id for r in units.to_standard_units(*tables(spark, rows)).collect()}
    assert got == {r[0] for r in rows} - {"lone"}
    assert [(r.label, r.n, r.decades) for r in units.unsettled_labels(*tables(spark, rows)).collect()] == [("borogove", 1, 1)]


def test_without_word_forms_scales_name_the_units(spark):
    r = np.random.default_rng(4)
    rows, want = [], {}
    for i in range(2000):
        year, base = 1800 + i % 60, float(np.exp(r.normal(0, 0.1)))
        label, factor, unit = [("bushel", 1, "bushel"), ("bu", 1, "bushel"), ("lb", 1 / 60, "pound"), ("pd", 1 / 60, "pound"), ("tn", 33.3, "ton")][i % 5]
        rows.append((f"r{i}", "GRAIN", f"lot; ${base * factor:.6f} per {label}", None, base * factor, year, 1))
        want[f"r{i}"] = unit
    got = {x.record_id: (x.quoted_unit, x.by) for x in units.to_standard_units(*tables(spark, rows), forms={}).collect()}
    assert {k: u for k, (u, _) in got.items()} == want
    assert {by for k, (_, by) in got.items() if want[k] != "bushel"} == {"scale"}


def test_a_link_with_an_offset_is_no_conversion(spark):
    """A charge of 20 a load is no factor: where prices spread, the line through them does not pass through nought."""
    rows = []
    for i in range(400):
        base = 1.0 + (i // 40)
        label, price = [("bushel", base), ("cartage", base + 20)][i % 2]
        rows.append((f"r{i}", "GRAIN", f"lot; ${price} per {label}", None, price, 1500 + 10 * (i // 40), 1))
    df, ref, conv = tables(spark, rows)
    named, level, conversions = units.label_levels(units.labelled(df), ref, conv, {})
    link = [x for x in units.links(level).collect() if x.label == "cartage"]
    assert len(link) == 1 and (link[0].offset is None or link[0].offset > 0.5)
    got = units.to_standard_units(df, ref, conv, forms={})
    assert {x.by for x in got.collect()} == {"anchor"} and got.count() == 200


def test_a_map_too_large_to_send_is_joined_by_shuffle(spark, monkeypatch):
    rows = [(f"r{i}", "GRAIN", "lot; $1 per bu", None, 1.0, 1800 + i, 1) for i in range(30)] + [("n", "GRAIN", None, None, 1.0, 1800, 1)]
    few = sorted(tuple(x) for x in units.to_standard_units(*tables(spark, rows)).collect())
    monkeypatch.setattr(units, "BROADCAST_BYTES", 0)
    assert few == sorted(tuple(x) for x in units.to_standard_units(*tables(spark, rows)).collect()) and len(few) == 30
