import numpy as np

from ledgerloom.llm import percentiles as p


def test_portions_combine_within_the_bound(spark):
    r = np.random.default_rng(1)
    data = [("big", float(v), int(i % 7)) for i, v in enumerate(r.lognormal(0, 2, 60_000))] + [("small", float(v), 0) for v in (1, 2, 3, 4)] + [("small", None, 1), ("small", float("nan"), 1), ("none", None, 0), (None, 5.0, 0)]
    df = spark.createDataFrame(data, "g string, v double, day int").withColumnRenamed("day", "n")
    parts = p.summaries(df.withColumnRenamed("n", "day").selectExpr("*", "1 AS n", "2 AS sketch"), ["g"], "v", "day")
    got = {x.g: x for x in p.answers(p.combined(parts, ["g"]), ["g"]).collect()}
    assert set(got) == {"big", "small", None} and got["small"].n == 4 and got["small"].p50 == 2.0 and got[None].p99 == 5.0
    s = np.sort([v for g, v, _ in data if g == "big"])
    for q in p.PERCENTILES:
        rank = np.searchsorted(s, got["big"][f"p{round(q * 100):02d}"], side="right") / len(s)
        assert abs(rank - q) <= p.RANK_ERROR
    assert p.answers(p.combined(p.summaries(df.limit(0), ["g"], "v"), ["g"]), ["g"]).count() == 0
