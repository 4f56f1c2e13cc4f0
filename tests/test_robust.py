import math
import random

import pytest

from ledgerloom.functions import robust
from ledgerloom.functions.tokensets import TokenSets, edits, words


def keep_tukey(v):
    s = sorted(v)
    n = len(s)
    if n < 2:
        return s
    if n >= 4:
        q1, q3 = s[n // 4], s[3 * n // 4]
        return s if q1 == q3 else [x for x in s if q1 - 1.5 * (q3 - q1) <= x <= q3 + 1.5 * (q3 - q1)]
    m = s[n // 2]
    mad = sorted(abs(x - m) for x in s)[n // 2]
    return s if mad == 0 else [x for x in s if abs(x - m) / mad <= 3]


def keep_log(v):
    s = sorted(x for x in v if x > 0)
    if not s:
        return s
    m = math.log10(s[len(s) // 2])
    s = [x for x in s if abs(math.log10(x) - m) <= 2.5]
    if len(s) < 4:
        return s
    lo, hi = math.log10(s[len(s) // 4]), math.log10(s[3 * len(s) // 4])
    return s if hi == lo else [x for x in s if lo - 1.5 * (hi - lo) <= math.log10(x) <= hi + 1.5 * (hi - lo)]


@pytest.fixture(scope="module")
def groups():
    r = random.Random(5)
    out = {f"n{n}-{k}": [r.choice([r.lognormvariate(0, 1), 2.0, 3.0, r.lognormvariate(6, 2)]) for _ in range(n)] for n in (1, 2, 3, 4, 5, 9, 40) for k in range(6)}
    return out | {"flat": [7.0] * 9, "low": [0.0, -1.0, -5.0], "mad0": [1.0, 1.0, 9.0], "even": [1.0, 2.0, 3.0, 4.0]}


def counted(spark, groups):
    rows = [(g, v) for g, vs in groups.items() for v in vs] + [("nulls", None), ("nulls", float("nan"))]
    return robust.counted(spark.createDataFrame(rows, "g string, p double"), ["g"], "p")


def spread(df):
    out = {}
    for r in df.collect():
        out.setdefault(r.g, []).extend([r.v] * r.c)
    return {g: sorted(v) for g, v in out.items()}


def test_order_statistics(spark, groups):
    got = {r.g: r for r in robust.summary(counted(spark, groups), ["g"]).collect()}
    for g, v in groups.items():
        s, n = sorted(v), len(v)
        assert (got[g].n, got[g].q1, got[g].med, got[g].q3) == (n, s[n // 4], s[n // 2], s[3 * n // 4])
    assert got["even"].med == 3.0 and "nulls" not in got


def test_cleaning_against_plain_python(spark, groups):
    c = counted(spark, groups).cache()
    assert spread(robust.tukey(c, ["g"])) == {g: k for g, v in groups.items() if (k := keep_tukey(v))}
    assert spread(robust.log_clean(c, ["g"])) == {g: k for g, v in groups.items() if (k := keep_log(v))}
    fences = {r.g: r for r in robust.cross_fence(c, ["g"], prefilter=False).collect()}
    assert "low" not in fences and fences["even"].lo == pytest.approx(3 * 10**-1.5)


def test_edits_and_token_sets():
    assert [edits("wheat", x) for x in ("wheat", "wehat", "heat", "wheats", "wheet", "")] == [0, 1, 1, 1, 1, 5]
    assert edits("abcdef", "uvwxyz", 2) == 3
    assert words("Saint Rookh0use’s, N. Y.") == ["saint", "rookhouses", "n", "y"]
    t = TokenSets({"stage fare": "S", "raw wool": "W", "raw wood": "D"})
    assert t.best(["fare", "stgae"])[0] == "S" and t.best(["stagefare"])[0] == "S"
    assert t.best(["raw", "woo"])[0] is None  # as near to one as to the other
    assert t.best(["spectacles"])[0] is None and t.best([])[0] is None


def test_nearest_entry_is_found_however_many_share_more_pairs():
    """The nearest of many short names, against costing all of them."""
    r = random.Random(3)
    names = sorted({"".join(r.choice("abdeilmnorst") for _ in range(r.randrange(4, 7))) for _ in range(1500)})
    t = TokenSets({n: n for n in names})
    for _ in range(250):
        n = r.choice(names)
        k = r.randrange(1, len(n) - 1)
        value = r.choice([n[:k] + n[k + 1] + n[k] + n[k + 2 :], n[:k] + r.choice("abdeilmnorst") + n[k + 1 :]])
        cost = {m: edits(value, m) for m in names}
        least = min(cost[m] for m in names if cost[m] <= len(m) // 4)
        nearest = [m for m in names if cost[m] == least]
        assert t.best([value]) == (nearest[0] if len(nearest) == 1 else None, least), value
