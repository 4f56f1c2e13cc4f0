import random

import pytest
from pyspark.sql import functions as F

from ledgerloom import dims
from ledgerloom.functions import pricing
from ledgerloom.operators import backends, batching, joins, outliers, series


def test_dims():
    assert (len(dims.fx_rows()), len(dims.alias_rows()), len(dims.canonical_rows()), len(dims.bound_rows())) == (38, 52, 40, 23)


def test_currency(spark):
    cases = [(10.0, "USD", 1800, 10.0, False), (2.0, "shillings", 0, 0.444, False), (1.0, "York shilling", 0, 0.125, False), (1.0, "continental", 1775, 1.0, True),
             (1.0, "Continental dollar", 1779, 0.1, True), (1.0, "continental", 1790, 0.01, True), (1.0, "continental", 0, 0.01, True), (1.0, "continental", 1700, 1.0, True),
             (1.0, "uncertain", 1800, None, True), (1.0, "", 1800, None, True), (1.0, None, 1800, None, True), (None, "usd", 1800, None, True), (1.0, "zloty", 1800, None, True),
             (3.0, "francss", 1800, 0.579, False)]
    df = spark.createDataFrame([(i, *c[:3]) for i, c in enumerate(cases)], "i int, p double, c string, y int")
    got = df.select("i", pricing.to_usd(F.col("p"), F.col("c"), F.col("y")).alias("u")).orderBy("i").collect()
    for (_, _, _, usd, unsure), r in zip(cases, got):
        assert r.u.uncertain == unsure and (r.u.usd is None if usd is None else r.u.usd == pytest.approx(usd))


def test_scalar_rules(spark):
    df = spark.createDataFrame([("Bu.", "$1,250.5 and 3", 1.0), ("cental", "none", None), ("60 lbs", "5.", 5001.0), (None, None, 2.0)], "u string, raw string, p double")
    r = df.select(pricing.plain_unit(F.col("u")).alias("u"), pricing.first_number(F.col("raw")).alias("n"), pricing.insane(F.col("p"), F.col("raw")).alias("x"),
                  pricing.stated_unit(F.col("u"), F.lit("std")).alias("s")).collect()
    assert [x.u for x in r] == ["bushel", "hundredweight", "bushel", ""] and [x.n for x in r] == [1250.5, None, 5.0, None]
    assert [x.x for x in r] == [True, False, True, False] and r[3].s == "std"
    c = spark.createDataFrame([(10.0, 50.0, 0.9), (10.0, 100.0, 0.9), (10.0, 110.0, 0.9), (10.0, None, 0.9), (10.0, -1.0, 0.3)], "a double, b double, c double")
    got = [tuple(x.k) for x in c.select(pricing.consensus(F.col("a"), F.col("b"), F.col("c")).alias("k")).collect()]
    assert got == [(30.0, 0.9), (55.0, 0.9), (10.0, 0.4), (10.0, 0.45), (10.0, 0.3)]
    k = spark.createDataFrame([(0.1, True, False), (0.1, False, False), (0.9, True, True), (None, True, False)], "c double, known boolean, fx boolean")
    assert [x.k for x in k.select(pricing.confidence(F.col("c"), F.col("known"), F.col("fx")).alias("k")).collect()] == [0.5, 0.4, 0.6, 0.5]
    q = spark.createDataFrame([(6.0, 3.0), (6.0, 0.0), (6.0, None), (6.0, -1.0), (None, 2.0)], "u double, q double")
    assert [x.k for x in q.select(pricing.per_unit(F.col("u"), F.col("q")).alias("k")).collect()] == [2.0, 6.0, 6.0, None, None]


def test_longest_prefix_and_intervals(spark):
    df = spark.createDataFrame([("AB-C",), ("AB",), ("A",), ("X",), (None,)], "v string")
    rows = [("A", 1), ("AB-C", 3), ("AB", 2)]
    got = df.select(joins.pick(joins.longest_prefix(F.col("v"), rows), [r[1] for r in rows]).alias("k")).collect()
    assert [r.k for r in got] == [3, 2, 1, None, None]
    assert df.select(joins.longest_prefix(F.col("v"), []).alias("k")).first().k is None
    y = spark.range(5).select(joins.interval_case(F.col("id"), [(1, 2, "a"), (2, 3, "b")]).alias("k"))
    assert [r.k for r in y.collect()] == [None, "a", "a", "b", None]


def test_asof_against_brute_force(spark):
    r = random.Random(3)
    left = [(i, r.choice("ab"), r.randrange(50)) for i in range(60)] + [(99, None, 5)]
    right = [(r.choice("ab"), r.randrange(50), r.random()) for _ in range(25)]
    got = joins.asof(spark.createDataFrame(left, "i int, k string, t int"), spark.createDataFrame(right, "k string, t int, x double"), ["k"], "t", "t", ["x"])
    for row in got.collect():
        best = max(((t, x) for k, t, x in right if k == row.k and t <= row.t), default=(None, None))
        assert row.x == best[1]
    assert got.count() == len(left)


def test_priority_answers_and_verdicts(spark):
    df = spark.createDataFrame([("p", 2, "b"), ("p", 1, "z"), ("p", 1, "a"), ("q", None, "c")], "k string, pr int, v string")
    assert [tuple(r) for r in joins.first_by_priority(df, ["k"], F.col("pr"), ["v"]).select("k", "v").collect()] == [("p", "a")]
    inputs = spark.createDataFrame([(b, i) for b in (1, 2, 3) for i in range(3)], "batch int, idx int")
    answers = spark.createDataFrame([(1, 2, 0, "x"), (1, 0, 1, "y"), (1, 0, 2, "late"), (1, 9, 3, "foreign"), (2, None, 0, "p0"), (2, None, 1, "p1")], "batch int, idx int, pos int, a string")
    got = {(r.batch, r.idx): r.a for r in joins.answers_to_inputs(inputs, answers).collect()}
    assert got == {(1, 0): "late", (1, 1): None, (1, 2): "x", (2, 0): "p0", (2, 1): "p1", (2, 2): None, (3, 0): None, (3, 1): None, (3, 2): None}
    rows = spark.createDataFrame([("a", 1.0), ("b", 1.0), ("c", 1.0), ("d", 1.0), (None, 1.0)], "id string, price double")
    v = spark.createDataFrame([("a", True, False, None), ("b", True, True, 5.0), ("c", False, False, None), ("c", True, False, None)], "id string, confirmed boolean, fixed boolean, price double")
    got = {r.id: (r.status, r.price) for r in joins.apply_verdicts(rows, v, "id", ["price"]).collect()}
    assert got == {"a": ("kept", 1.0), "b": ("fixed", 5.0), "c": ("rejected", 1.0), "d": ("pending", 1.0), None: ("pending", 1.0)}


def test_packing(spark):
    sizes = [5, 5, 1, 12, 3, None, 9]
    df = spark.createDataFrame([("l", i, s) for i, s in enumerate(sizes)] + [("m", 0, 4)], "lane_of string, i int, s int")
    got = {(r.i, r.batch) for r in batching.pack(df, F.col("lane_of"), ["lane_of", "i"], "s", 10).collect() if r.lane_of == "l"}
    assert got == {(0, 0), (1, 0), (2, 1), (3, 2), (4, 3), (5, 3), (6, 4)}
    got = {(r.i, r.batch) for r in batching.pack(df, F.col("lane_of"), ["lane_of", "i"], "s", 10, whole=True).collect() if r.lane_of == "l"}
    assert got == {(0, 0), (1, 0), (2, 1), (3, 1), (4, 2), (5, 2), (6, 2)}
    assert batching.pack(df.limit(0), F.col("lane_of"), ["i"], "s", 10).count() == 0
    assert [(r.chunk, r.idx) for r in batching.chunks(df.where("lane_of = 'l'"), ["lane_of"], ["i"], 3).orderBy("i").collect()] == [(i // 3, i % 3) for i in range(7)]
    assert batching.condense_budget(32_000, 0.2) == (24818, 5459) and batching.record_budget(128_000) == (753, 75812)
    with pytest.raises(ValueError):
        batching.condense_budget(32_000, 0.99)


def test_prompts_and_refusals(spark):
    p = spark.createDataFrame([(0, "i1", 1, "r1", "x"), (0, "i1", 2, "r2", "y"), (0, "i2", 3, "r3", "z")], "b int, issue string, o int, ref string, text string")
    assert batching.packed_text(p, ["b"], "issue", "o", "ref", "text").first().prompt == "### i1\n=== ref:r1 ===\nx\n=== ref:r2 ===\ny\n### i2\n=== ref:r3 ===\nz"
    bad = "not parsed"
    a = [("s74", bad if i < 74 else f"r{i}") for i in range(100)] + [("s75", bad if i < 75 else f"r{i}") for i in range(100)]
    a += [("one", "unclear")] * 4 + [("one", None)] * 4 + [("good", None)] * 5
    got = {r.b: r.refused for r in batching.refused(spark.createDataFrame(a, "b string, reason string"), "b", "reason", dims.REFUSALS).collect()}
    assert got == {"s74": False, "s75": True, "one": True, "good": False}


@pytest.mark.parametrize("raw, price, currency", [("$1.25", 1.25, "USD"), ("5s 6d", 5.5, "shilling"), ("£2 10s", 2.5, "pound"), ("$5–10", 7.5, "USD"), ("1,200", 1200.0, "uncertain"),
                                                  ("no digits", None, "uncertain"), (None, None, "uncertain"), ("12½ cents", 12.0, "uncertain"), ("6 cts. a lb", 6.0, "cent")])
def test_price_texts(raw, price, currency):
    got = backends.parse_price(raw)
    assert (got["price_numeric"], got["currency_original"]) == (price, currency)
    assert backends.parse_price("$8 quarterly")["quantity"] == 3.0
    assert backends.parse_price("$90 per annum")["time_unit"] == "year" and backends.parse_price("$5-10")["confidence"] <= 0.7


class Scripted:
    def __init__(self, limit):
        self.limit, self.calls = limit, []

    def call(self, inputs):
        self.calls.append(len(inputs))
        return None if len(inputs) > self.limit else [{"idx": x["idx"], "v": 1} for x in inputs if x["idx"] != 3 or len(inputs) == 1]


def test_halving_and_solo_retry():
    b = Scripted(2)
    answers, failed = backends.submit(b, [{"idx": i} for i in range(8)])
    assert [a["idx"] for a in answers] == list(range(8)) and not failed and b.calls.count(1) == 1
    answers, failed = backends.submit(Scripted(0), [{"idx": i} for i in range(16)])
    assert not answers and len(failed) == 16 and {f["_halving_depth"] for f in failed} == {3}
    dry = backends.NullBackend()
    assert backends.submit(dry, [{"idx": 0}])[0] == [] and dry.calls == 2
    assert backends.Routed(Scripted(0), Scripted(9)).call([{"idx": 0}]) == [{"idx": 0, "v": 1}]
    assert backends.parse_answer("```json\n[1]\n```") == [1] and backends.parse_answer("{}") is None and backends.parse_answer(None) is None


def test_rule_backend_over_batches(spark):
    rows = [(i // 3, i % 3, raw) for i, raw in enumerate(["$1", "5 cents", None, "£1", "x", "$2-4"])]
    df = spark.createDataFrame(rows, "batch int, idx int, price_raw string")
    got = backends.run_batches(df, backends.RuleBackend, "idx int, batch int, price_numeric double, currency_original string")
    assert {(r.batch, r.idx): r.price_numeric for r in got.collect()} == {(0, 0): 1.0, (0, 1): 5.0, (0, 2): None, (1, 0): 1.0, (1, 1): None, (1, 2): 3.0}


def test_outliers_and_last_per_ref(spark):
    rows = [("c", 1800, f"r{i}", f"p{i // 2}", float(v)) for i, v in enumerate([1, 2, 2, 3, 3, 4, 40, 0])] + [("d", 1800, f"s{i}", "q", float(v)) for i, v in enumerate([1, 2, 3, 99])]
    df = spark.createDataFrame(rows, "cid string, decade int, id string, ref string, p double")
    got = outliers.flagged(df, ["cid", "decade"], "p")
    assert [r.id for r in got.collect()] == ["r6"]  # buckets of four are too small, prices of nought do not count
    assert [r.id for r in outliers.last_per_key(df.where("cid = 'c'"), "ref", ["id"]).orderBy("ref").collect()] == ["r1", "r3", "r5", "r7"]
    assert outliers.without(df, got, "ref").count() == 10


def test_series_on_small_groups(spark):
    cols = "record_id string, commodity_id string, year int, unit string, price_per_unit_usd double"
    rows = [(f"a{i}", "FOOD-GRAIN-WHEAT", 1800 + i % 3, "bushel", 1.0 + i / 10) for i in range(12)] + [("b", "FOOD-GRAIN-WHEAT", 1800, "cask", 500.0), ("n", "FOOD-GRAIN-WHEAT", None, "bushel", None)]
    df = spark.createDataFrame(rows, cols)
    got = {r.year: r for r in series.yearly_medians(df).collect()}
    assert sorted(got) == [1800, 1801, 1802] and got[1800].median == pytest.approx(1.6)
    assert series.canonical_rows(df).count() == 12  # the cask is not accepted, the null price not within bounds
    assert series.yearly_medians(df.limit(0)).count() == 0 and series.trend(df.limit(0)).count() == 0
    ties = spark.createDataFrame([("x", "b"), ("x", "a"), ("y", None)], "commodity_id string, unit string")
    assert {r.commodity_id: r.top for r in series.dominant(ties, "commodity_id", F.coalesce("unit", F.lit(""))).collect()} == {"x": "a", "y": ""}


class Poisoned(backends.RuleBackend):
    def call(self, inputs):
        return None if any(x["price_raw"] == "poison" for x in inputs) else super().call(inputs)


def test_failed_rows_come_back_and_batches_stay_whole(spark):
    rows = [("a", i, "poison" if i == 3 else f"${i}") for i in range(8)] + [("b", i, f"{i} cents") for i in range(30)] + [(None, 0, "poison")]
    items = spark.createDataFrame(rows, "batch string, idx int, price_raw string")
    schema = "idx int, batch string, price_raw string, price_numeric double"
    sizes = spark.sparkContext.accumulator(0)

    class Counted(Poisoned):
        def call(self, inputs):
            sizes.add(len(inputs) == 30)
            return super().call(inputs)

    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        done = backends.run_batches(items, Counted, schema)
        got = done.collect()
        assert sizes.value == 1
        failed = {(r.batch, r.idx, r._failed_reason, r._halving_depth) for r in got if r._failed_reason}
        assert failed == {("a", 3, "no answer", 3), (None, 0, "no answer", 0)} and len(got) == 39
        assert backends.answered(done).count() == 37
        healed = backends.retry_failed(items, done, lambda: backends.RuleBackend(), schema)
        assert backends.with_status(healed).where("status = 'failed'").count() == 0 and healed.count() == 39
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "10000")
    empty = backends.run_batches(items.limit(0), Counted, schema)
    assert empty.count() == 0 and "_failed_reason" in empty.columns
