import random

import pytest

from ledgerloom.llm import spam

R = random.Random(1)
NOUNS = "wheat flour cheese hops cider tallow wool nails coffee calico lumber candles butter hides".split()
PEOPLE = "Elkanor Tamsin Orlo Phebe Hester Zadoc Corwin Dorcas".split()


def article(r, n=8):
    verbs = ["was heard to say that", "announced in the open meeting that", "wrote by the last mail that", "conceded before the magistrate that"]
    ends = ["though few believed it", "and the meeting broke up early", "which is mild for this time of the year", "says a letter from the county seat"]
    return " ".join(f"The {r.choice(['postmaster', 'drover', 'clerk', 'ferry keeper'])} {r.choice(verbs)} {r.choice(PEOPLE)} had bought the {r.choice(NOUNS)} for ${r.randrange(9, 99)}, {r.choice(ends)}." for _ in range(n))


def price_list(r):
    return "PRICES CURRENT, corrected weekly.\n" + "\n".join(f"{r.choice(NOUNS).title()}, {r.choice(['prime', 'fair'])} ..... {r.randrange(2, 90)} cents a {r.choice(['lb', 'bu', 'ton'])}." for _ in range(25))


def spam_page(r):
    k = r.randrange(5)
    if k == 0:
        return " ".join("#" + r.choice(NOUNS) + r.choice(["deal", "shop", "price", ""]) for _ in range(60))
    if k == 1:
        a, b = r.sample(NOUNS, 2)
        return ", ".join(r.choice([f"buy {a}", f"cheap {b}", f"best {a}"]) for _ in range(70))
    if k == 2:
        return "\n".join(f"[{r.choice(NOUNS)}](http://www.{r.choice(NOUNS)}{r.randrange(99)}.example/p?id={r.randrange(99)})" for _ in range(40))
    if k == 3:
        return " | ".join(f"{r.choice(NOUNS)} {r.choice(['near me', 'for sale', 'prices', 'sku 12', 'online'])}" for _ in range(60))
    w = r.choice(NOUNS)
    return f"If you want {w} get {w} from the {w} store of {w}. Buy {w} and {w} for {w} buyers. " * 8


@pytest.fixture(scope="module")
def pages():
    r = random.Random(8)
    rows = [(i, f"h{i % 9}", article(r) if i % 3 else price_list(r), False) for i in range(260)]
    rows += [(1000 + i, f"h{i % 9}", spam_page(r), True) for i in range(60)]
    rows += [(2000 + i, "h1", article(r, 10) + "\nSee also page 3: https://pages.invalid/x/1\n#wheat #hops", False) for i in range(20)]
    rows += [(3000 + i, None, article(r, 2) + "\n" + "\n".join(f"{r.choice(NOUNS)} - www.{r.choice(NOUNS)}{r.randrange(99)}.example" for _ in range(60)), True) for i in range(10)]
    return rows


def test_held_out_accuracy(spark, pages):
    df = spark.createDataFrame([(i, h, t, 1, 2) for i, h, t, _ in pages], "doc_id bigint, source string, text string, label int, score int")
    got = {r.doc_id: r.score > 0.5 for r in spam.scores(df).collect()}
    truth = {i: s for i, _, _, s in pages}
    assert set(got) == set(truth)
    wrong = [i for i in truth if got[i] != truth[i]]
    assert len(wrong) <= 3, wrong


def test_degenerate_tables(spark):
    cols = "doc_id bigint, source string, text string"
    assert spam.scores(spark.createDataFrame([], cols)).count() == 0
    one = spark.createDataFrame([(1, "h", article(R)), (2, "h", None), (3, "h", " "), (4, None, "wheat"), (4, None, "wheat"), (5, "h", "word " * 40_000)], cols)
    assert sorted(r.doc_id for r in spam.scores(one).collect()) == [1, 4, 4, 5]
    assert spam.features("") == spam.features("...") == [0.0] * len(spam.WORDWISE)


def test_the_forest_decides_where_the_labels_abstain(spark, pages):
    df = spark.createDataFrame([(i, h, t) for i, h, t, _ in pages], "doc_id bigint, source string, text string")
    truth = {i: s for i, _, _, s in pages}
    labels = {r.doc_id: r.label for r in spam.with_features(df, "doc_id", "text", "source").withColumn("label", spam.weak_label()).collect()}
    open_ = [i for i in truth if labels[i] is None]
    assert len(open_) >= 5 and all(labels[i] is None or bool(labels[i]) == truth[i] for i in truth)
    got = {r.doc_id: r.page_score > 0.5 for r in spam.scores(df).where("page_score IS NOT NULL").collect()}
    assert sum(got[i] == truth[i] for i in open_) >= 0.9 * len(open_)


def test_hosts_move_doubtful_pages_where_hosts_differ(spark):
    cols = "doc_id bigint, host string, page_score double"
    rows = [(i, f"farm{i % 5}", 0.9) for i in range(200)] + [(1000 + i, f"paper{i % 5}", 0.04) for i in range(200)]
    doubtful = [(5000, "farm1", 0.4), (5001, "paper1", 0.6), (5002, None, 0.6)]
    got = {r.doc_id: r.score for r in spam.smoothed(spark.createDataFrame(rows + doubtful, cols)).collect()}
    assert got[5000] > 0.5 > got[5001] and len(got) == 403
    r = random.Random(3)
    alike = [(i, f"h{i % 10}", r.choice([0.9, 0.05, 0.05])) for i in range(2000)]
    alike = [(i, h, p) for k, (i, h, p) in enumerate(alike)] + doubtful[:1]
    got = {x.doc_id: x.score for x in spam.smoothed(spark.createDataFrame(alike, cols)).collect()}
    assert all((got[i] > 0.5) == (p > 0.5) for i, _, p in alike)
    assert spam.smoothed(spark.createDataFrame([], cols)).count() == 0
