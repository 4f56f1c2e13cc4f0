import random

from ledgerloom.llm import canonical

PLACES = [("p1", "Saint Rookhaven", "CT", "Connecticut"), ("p2", "Marlburg Junction", "NY", "New York"), ("p3", "Twin Falls", "OH", "Ohio"), ("p4", "Twin Falls", "GA", "Georgia"), ("p5", "Orrin", "MA", "Massachusetts"), ("p6", "Orrin Mills", "MA", "Massachusetts")]


def test_places():
    judge = canonical.Places(PLACES).judge
    for value, want in {
        "St. Rookhaven, Conn.": "p1", "near SAINT ROOKHAVEN (town)": "p1", "Sa1nt Rookhavcn, CT": "p1", "N. Y. - Marlburg Jct.": "p2", "Marlbrug Juntcion": "p2",
        "Twin Falls": "none", "Twin Falls, Ohio": "p3", "GA, twin fals": "p4", "Orrin": "p5", "Orrin Mills, Mass.": "p6", "city of orrin mlls": "p6",
        "at sea": "none", "???": "none", "Saint Rookhaven, Ohio": "none", "17": "none", "CT": "none", "Zuotoghezulli, CT": "none",
    }.items():
        assert judge(value) == want, value


def test_misspelt_values_find_their_entry():
    r, judge = random.Random(4), canonical.Places(PLACES).judge
    for i in range(300):
        e, town, code, _ = PLACES[r.choice([0, 1, 5])]
        k = r.randrange(1, len(town) - 1)
        bad = r.choice([town[:k] + town[k + 1 :], town[:k] + "x" + town[k + 1 :], town[:k] + town[k] + town[k:], town[: k - 1] + town[k] + town[k - 1] + town[k + 1 :]])
        assert judge(f"{bad}, {code}") == e, bad


def test_names():
    judge = canonical.Names([("FOOD-GRAIN-WHEAT", "Wheat"), ("RAW-WOOL", "Raw Wool"), ("GOODS-TEXTILE-WOOL", "Woolen Cloth")]).judge
    for value, want in {"food/grain/wheat": "FOOD-GRAIN-WHEAT", "WHEAT?": "FOOD-GRAIN-WHEAT", "GRAIN-WHEAT": "FOOD-GRAIN-WHEAT", "FOOD-GARIN-WHEAAT": "FOOD-GRAIN-WHEAT", "raww wool": "RAW-WOOL",
                        "woolne cloth": "GOODS-TEXTILE-WOOL", "PIANOFORTE": "none", "0": "none", "<none>": "none"}.items():
        assert judge(value) == want, value


def test_longest_mentions_do_not_overlap():
    m = canonical.Mentions([("a b", 1), ("a b c", 2), ("c", 3), ("d", 4)])
    assert [(s, set(x)) for s, _, x in m.find("a b c d".split())] == [(0, {2}), (6, {4})]
    assert m.find("ab cx".split()) == [] and m.find([]) == [] and canonical.Mentions([]).find(["a"]) == []


def test_rows(spark):
    ref = spark.createDataFrame([(e, f"{t}, {c}", t, c, s) for e, t, c, s in PLACES], "place_id string, place_name string, town string, state_code string, state_name string")
    rows = spark.createDataFrame([("r1", "Saint Rookhaven, CT", 1), ("r2", "saint rookhaven", 1), ("r3", None, 1), ("r4", " ", 1), ("r5", "at sea", 1), ("r5", "at sea", 1), ("r6", "x" * 100_000, 1)], "record_id string, location string, id int")
    got = sorted(tuple(r) for r in canonical.resolve_places(rows, ref).collect())
    assert got == [("r2", "location", "p1"), ("r5", "location", "none"), ("r5", "location", "none"), ("r6", "location", "none")]
    assert canonical.resolve_places(rows.limit(0), ref).count() == 0
    assert {r.entry_id for r in canonical.resolve_places(rows, ref.limit(0)).collect()} == {"none"}


def test_slices_give_the_same(spark, monkeypatch):
    ref = spark.createDataFrame([(e, f"{t}, {c}", t, c, s) for e, t, c, s in PLACES], "place_id string, place_name string, town string, state_code string, state_name string")
    values = ["saint rookhaven", "Marlburg Jct.", "Twin Falls", "twin falls, ohio", "orrin mlls, mass.", "at sea", "Orrin"] * 3
    rows = spark.createDataFrame(list(enumerate(values)), "record_id int, location string")
    want = sorted(tuple(r) for r in canonical.resolve_places(rows, ref).collect())
    monkeypatch.setattr(canonical, "LARGEST_LIST", 2)
    assert sorted(tuple(r) for r in canonical.resolve_places(rows, ref).collect()) == want


def test_blank_ids_are_on_no_list(spark):
    ref = spark.createDataFrame([("RAW-WOOL", "Raw Wool")], "commodity_id string, commodity_name string")
    rows = spark.createDataFrame([("a", "RAW-WOOL"), ("b", "raw wool"), ("c", ""), ("d", None), ("e", " ")], "record_id string, commodity_id string")
    got = {r.record_id: r.entry_id for r in canonical.resolve_names(rows, ref).collect()}
    assert got == {"b": "RAW-WOOL", "c": "none", "e": "none"}


def test_a_mention_counts_however_long_the_value():
    from ledgerloom.operators.units import CommodityNames

    entries = [("FOOD-GRAIN-WHEAT", "Wheat"), ("RAW-WOOL", "Raw Wool"), ("RAW-COTTON", "Cotton")]
    for judge in (canonical.Names(entries).judge, lambda v: CommodityNames(entries).entry(v) or "none"):
        for value, want in {"RAW-WOOL (see remarks on page)": "RAW-WOOL", "wheat, as quoted by the merchants": "FOOD-GRAIN-WHEAT", "cotton spinning machinery": "none",
                            "raw wool or raw cotton of the season": "RAW-COTTON"}.items():
            assert judge(value) == want, value
