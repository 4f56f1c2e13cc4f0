import numpy as np
import pytest

from ledgerloom.operators import spikes


def series(n=60, noise=0.03, seed=1):
    r = np.random.default_rng(seed)
    return np.exp(np.cumsum(r.normal(0, 0.01, n)) + r.normal(0, noise, n))


def kinds(price, day=None):
    price = np.asarray(price, float)
    return [spikes.KINDS[k] for k in spikes.judge(np.arange(len(price)) if day is None else np.asarray(day), price)]


@pytest.mark.parametrize("seed", range(5))
def test_single_and_paired_spikes_up_and_down(seed):
    p = series(seed=seed)
    p[10] *= 6
    p[25], p[26] = p[25] * 5, p[26] * 4
    p[40] /= 7
    k = kinds(p)
    assert [i for i, x in enumerate(k) if x == "spike"] == [10, 25, 26, 40]


def test_level_shift_is_no_case():
    p = series()
    p[30:] *= 0.3
    assert set(kinds(p)) == {"plausible"}


def test_limits():
    p = series()
    p[3], p[4], p[50] = 0, -999, p[50] * 1e6
    assert [i for i, x in enumerate(kinds(p)) if x == "limit"] == [3, 4, 50]
    assert set(kinds([0] * 25)) == {"limit"}


def test_stuck_runs():
    p = series()
    p[20:29] = p[20]
    assert [i for i, x in enumerate(kinds(p)) if x == "stuck"] == list(range(20, 29))
    q = series()
    q[20:27] = q[20]  # seven dates are too few
    assert set(kinds(q)) == {"plausible"}
    slow = np.repeat(series(6), 12)  # a series that seldom changes
    assert set(kinds(slow)) == {"plausible"}


def test_copies_on_one_date_count_once():
    p, day = list(series(30)), list(range(30))
    p[12:12] = [p[12] * 8] * 4
    day[12:12] = [12] * 4
    assert [i for i, x in enumerate(kinds(p, day)) if x == "spike"] == [12, 13, 14, 15]
    q, days = list(series(30)), list(range(30))
    q[5:5], days[5:5] = [q[5]] * 9, [5] * 9  # ten copies of one date are no run of dates
    assert set(kinds(q, days)) == {"plausible"}


def rows_of(spark, prices, extra=()):
    data = [(f"r{i:04d}", "n", "c", f"18{i // 300:02d}-{i // 25 % 12 + 1:02d}-{i % 25 + 1:02d}", float(p)) for i, p in enumerate(prices)]
    return spark.createDataFrame(data + list(extra), "record_id string, np string, cid string, date string, price double")


def run(df, **kw):
    return {r.record_id: r.kind for r in spikes.implausible(df, ["np", "cid"], "date", "price", **kw).collect()}


def test_spark_run_with_nulls_ties_and_clashing_columns(spark):
    p = series(100)
    p[40] *= 9
    extra = [("x1", "n", "c", None, None), ("x2", None, "c", "1800-01-01", 5.0), ("x3", "n", "c", "1800-01-05", float("nan")), ("x4", "m", "c", "1800-01-05", 0.0)]
    df = rows_of(spark, p, extra).selectExpr("*", "1 AS source", "2 AS piece", "3 AS day", "4 AS core", "5 AS time")
    assert run(df) == {"r0040": "spike"}  # x4's series is too short to judge
    assert run(df.limit(0)) == {}


def test_large_sources_are_cut_without_loss(spark):
    p = series(1500, seed=3)
    for i in range(7, 1500, 50):
        p[i] *= 8
    df = rows_of(spark, p)
    assert run(df) == run(df, chunk=200) == {f"r{i:04d}": "spike" for i in range(7, 1500, 50)}
    one_date = df.selectExpr("record_id", "np", "cid", "'1900-01-01' AS date", "price")
    spikes.implausible(one_date, ["np", "cid"], "date", "price", chunk=200).count()


def test_large_sources_of_very_different_size_are_cut_each_by_its_own(spark):
    """Cut into as many pieces as the large one needs, the small one would leave groups of fewer than LEAST readings."""
    small, big = series(250, seed=4), series(20_000, seed=5)
    want = {f"s{i}" for i in range(7, 250, 40)} | {f"b{i}" for i in range(9, 20_000, 500)}
    date = lambda i: f"18{i // 300:02d}-{i // 25 % 12 + 1:02d}-{i % 25 + 1:02d}"
    data = [(f"{c}{i}", c, date(i), float(x) * (8 if f"{c}{i}" in want else 1)) for c, p in (("s", small), ("b", big)) for i, x in enumerate(p)]
    df = spark.createDataFrame(data, "record_id string, np string, date string, price double")
    got = {r.record_id for r in spikes.implausible(df, ["np"], "date", "price", chunk=200).collect()}
    assert got == want


def test_a_shift_is_told_from_an_outlier_by_what_follows():
    r = np.random.default_rng(6)
    x = np.log(0.5) + r.normal(0, 0.08, 60)
    x[30:] += 0.8
    x[31] -= 0.4
    x[32] -= 0.35  # the first readings after the shift waver, so that it begins as a run of one
    x[10] += 1.5
    found = spikes.outliers(x)
    assert found[10] and not found[25:40].any()
    off = np.zeros(60, bool)
    off[30] = True
    shift, outlier = spikes.shift_statistics(x, off, 30, 31, 0.1)
    assert shift > outlier
    shift, outlier = spikes.shift_statistics(x, np.arange(60) == 10, 10, 11, 0.1)
    assert shift < outlier


def test_large_sources_of_very_different_size_are_judged_alike(spark):
    r = np.random.default_rng(9)
    rows = []
    for source, n in (("huge", 6000), ("just large", 150), ("small", 60)):
        prices = np.exp(np.cumsum(r.normal(0, 0.01, n)) + r.normal(0, 0.03, n))
        prices[n // 2] *= 9
        prices[n // 4] = 0
        rows += [(f"{source}{i}", source, f"18{i // 300:02d}-{i % 300 // 25 + 1:02d}-{i % 25 + 1:02d}", float(p)) for i, p in enumerate(prices)]
    df = spark.createDataFrame(rows, "record_id string, source string, date string, price double")
    whole = {(x.record_id, x.kind) for x in spikes.implausible(df, ["source"], "date", "price").collect()}
    cut = {(x.record_id, x.kind) for x in spikes.implausible(df, ["source"], "date", "price", chunk=100).collect()}
    planted = {(f"{s}{n // 2}", "spike") for s, n in (("huge", 6000), ("just large", 150), ("small", 60))}
    planted |= {(f"{s}{n // 4}", "limit") for s, n in (("huge", 6000), ("just large", 150), ("small", 60))}
    assert planted <= whole and planted <= cut
    assert len(whole ^ cut) <= 0.002 * len(rows)
