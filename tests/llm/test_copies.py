import random
import re

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from ledgerloom.llm import copies

SCHEMA = "record_id string, original_text string, commodity_id string, id int, text int, name int, key int, cheap int, n int"


def frame(spark, rows):
    return spark.createDataFrame([(i, t, c, *[7] * 6) for i, t, c in rows], SCHEMA)


def pairs(spark, rows):
    return {(r.first_id, r.copy_id) for r in copies.copies(frame(spark, rows)).collect()}


def key(text, name):
    """Brute force, written apart from the expressions."""
    t, out = (text or "").lower(), []
    t = re.sub(r"(?<![\d.,])\d{1,3}(?:,\d{3})+(?!\d)", lambda m: m.group().replace(",", ""), t)
    for field in re.split(r"[;|\r\n]+", t):
        words = re.findall(r"\d+(?:\.\d+)*|[^\W\d_]+|[$£€¢]", field)
        if words:
            out.append(tuple(words))
    return (tuple(sorted(out)), tuple(sorted(re.findall(r"[^\W_]+", (name or "").lower())))) if out else None


def brute(rows):
    groups = {}
    for i, t, c in rows:
        if (k := key(t, c)) is not None:
            groups.setdefault(k, []).append(i)
    return {(min(g), i) for g in groups.values() for i in g if i != min(g)}


CASES = [
    ("a1", "lot 12,345; White wheat, No. 1; $1.25 per bu.", "FOOD-WHEAT"),
    ("a2", " (white  WHEAT  no. 1) | “lot 12345” | $ 1.25 per bu...", "food / wheat"),
    ("a3", "$1.25 per bu\r\nlot 12345\n\nwhite wheat no 1", "Food Wheat."),
    ("b1", "lot 12345; white wheat No. 1; $125 per bu.", "FOOD-WHEAT"),  # no point
    ("b2", "lot 12345; wheat white No. 1; $1.25 per bu.", "FOOD-WHEAT"),  # words in another order
    ("b3", "lot 12345; white wheat No. 1; 1.25 per bu.", "FOOD-WHEAT"),  # no currency sign
    ("b4", "lot 12345; white wheat No. 1; £1.25 per bu.", "FOOD-WHEAT"),
    ("b5", "lot 12345; white wheat No. 1; $1.25 per bu.", "FOOD-OATS"),
    ("c1", "1,20 x", None), ("c2", "1 20 x", ""), ("c3", "120 x", None), ("c4", "1,200 x", None), ("c5", "1200 X", None),
    ("d1", None, "FOOD-WHEAT"), ("d2", "", "FOOD-WHEAT"), ("d3", " ; | \n", "FOOD-WHEAT"), ("d4", None, "FOOD-WHEAT"),
    ("e1", "same", "A"), ("e1", "same", "A"),
]


def test_cases(spark):
    got = pairs(spark, CASES)
    assert got == {("a1", "a2"), ("a1", "a3"), ("c1", "c2"), ("c4", "c5")} == brute(CASES)
    n = {}
    for r in copies.collapsed(frame(spark, CASES)).collect():
        n.setdefault(r.record_id, []).append(r.n_copies)
    assert n["a1"] == [3] and n["d1"] == [1] and "a2" not in n and n["e1"] == [2, 2]


def test_empty_and_hot(spark):
    assert pairs(spark, []) == set()
    hot = [(f"h{i:04d}", random.Random(i).choice(["Same Thing; twice", "twice|same   thing"]), "X") for i in range(400)]
    assert len(pairs(spark, hot)) == 399
    assert len(pairs(spark, [("l1", "word " * 50_000, "X"), ("l2", "WORD\t" * 50_000, "x")])) == 1


@settings(max_examples=15, deadline=None)
@given(st.lists(st.tuples(st.text(alphabet="aB1,.;| $\n", max_size=8), st.sampled_from(["A-B", "b a", None])), max_size=12))
def test_against_brute_force(texts):
    from pyspark.sql import SparkSession

    rows = [(f"r{i:02d}", t, c) for i, (t, c) in enumerate(texts)]
    assert pairs(SparkSession.getActiveSession(), rows) == brute(rows)


@pytest.fixture(autouse=True)
def session(spark):
    return spark
