import json
import os

import pytest
from pyspark.sql import functions as F

from ledgerloom import schemas
from ledgerloom.sources import jsonl, pages, sinks
from ledgerloom.streaming import incremental


def lines(path, *rows):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "w") as f:
        f.write("\n".join(r if isinstance(r, str) else json.dumps(r) for r in rows))
    return str(path)


def test_tolerant_and_strict_scans(spark, tmp_path):
    p = lines(f"{tmp_path}/n.jsonl", {"ref": "a", "year": 1800, "price_usd": 1.5}, "", "not json", {"ref": "b"}, {"ref": "c", "year": "1801", "price_usd": 0}, {"ref": "d", "year": 1999, "price_usd": -1})
    got = {r.ref: (r.year, r.price_usd) for r in jsonl.prices(spark, p, 1770, 1963).collect()}
    assert got == {"a": (1800, 1.5), "c": (1801, 0.0)}
    assert {r.ref for r in jsonl.prices(spark, p, 0, 1963).collect()} == {"a", "b", "c"}
    assert jsonl.prices(spark, f"{tmp_path}/missing.jsonl").count() == 0 and jsonl.unresolved(spark, f"{tmp_path}/missing.jsonl").count() == 0
    with pytest.raises(Exception):
        jsonl.strict(spark, p, "ref string, year int").collect()


def test_mentions_by_file_and_sentinels(spark, tmp_path):
    lines(f"{tmp_path}/prices/1800/x_1800-01-01.jsonl", {"t": "$", "item": "i"}, {"t": "P", "item": "j"})
    lines(f"{tmp_path}/prices/1700/x_1700-01-01.jsonl", {"t": "$", "item": "old"})
    got = jsonl.price_mentions(spark, f"{tmp_path}/prices/*/*.jsonl").collect()
    assert [(r.item, r.file_key) for r in got] == [("i", "1800/x_1800-01-01.jsonl")]
    lines(f"{tmp_path}/done.json", json.dumps({"pages_done": ["a", "b"], "later_field": 1}, indent=1))
    lines(f"{tmp_path}/bad.json", "{oops")
    assert [r.key for r in jsonl.sentinel(spark, f"{tmp_path}/done.json", "pages_done").collect()] == ["a", "b"]
    assert jsonl.sentinel(spark, f"{tmp_path}/bad.json", "pages_done").count() == jsonl.sentinel(spark, f"{tmp_path}/none.json", "pages_done").count() == 0


@pytest.fixture
def tree(tmp_path):
    files = {"1800/n1/1800-01-01/seq-001.txt": "x" * 100, "1800/n1/1800-01-01/seq-002.txt": "", "1800/n1/1800-01-01/seq-002.ocr.txt": "local text", "1800/n1/1800-01-01/_pages.json": "[]",
             "1801/n2/1801-02-02/seq-001.txt": "", "1801/n2/1801-02-02/seq-001.ocr.txt": "", "1801/_tmp/1801-02-02/seq-001.txt": "junk"}
    for name, text in files.items():
        os.makedirs(os.path.dirname(f"{tmp_path}/{name}"), exist_ok=True)
        with open(f"{tmp_path}/{name}", "w") as f:
            f.write(text)
    return str(tmp_path)


def test_page_tree(spark, tree):
    files = pages.listing(spark, tree)
    assert files.count() == 5 and {r.ref for r in files.collect()} == {"n1/1800-01-01/seq-001", "n1/1800-01-01/seq-002", "n2/1801-02-02/seq-001"}
    got = {r.year: r for r in pages.census(files).collect()}
    assert (got[1800].loc_pages, got[1800].empty_pages, got[1800].local_pages, got[1800].usable_pages, got[1800].bytes) == (1, 1, 1, 2, 110)
    assert (got[1801].loc_pages, got[1801].empty_pages, got[1801].local_pages, got[1801].usable_pages) == (0, 1, 1, 0)
    assert {r.text for r in pages.texts(spark, tree).collect()} >= {"x" * 100, "local text"}
    assert pages.listing(spark, f"{tree}/nowhere").count() == 0


def test_choice_of_texts(spark):
    df = spark.createDataFrame([("i", "1", "loc", " "), ("i", "1", "local", "l"), ("i", "2", "loc", "a"), ("i", "2", "local", "b"), ("j", "1", "loc", None), ("j", "2", "pass0", "c"), ("j", "3", "loc", "d")],
                               "issue string, seq string, source string, text string")
    assert {(r.issue, r.seq, r.text) for r in pages.best_text(df, ["issue", "seq"]).collect()} == {("i", "1", "l"), ("i", "2", "a"), ("j", "2", "c"), ("j", "3", "d")}
    assert {(r.issue, r.seq) for r in pages.issue_source(df, ["issue"]).collect()} == {("i", "1"), ("i", "2"), ("j", "2")}


def test_markup(spark):
    body = '<Layout><Page><PrintSpace><TextBlock><TextLine><String CONTENT="a"/><SP/><String CONTENT="b"/></TextLine></TextBlock><TextBlock/><TextBlock><TextLine><String CONTENT="c"/></TextLine></TextBlock></PrintSpace></Page></Layout>'
    xml = [f"<alto>{body}</alto>", f'<alto xmlns="http://x/ns#">{body}</alto>', "<alto><broken", None]
    df = spark.createDataFrame([(i, x) for i, x in enumerate(xml)], "i int, x string")
    assert [r.t for r in df.select("i", pages.alto_text(F.col("x")).alias("t")).orderBy("i").collect()] == ["a b\nc", "a b\nc", "", ""]
    answers = ["```\n=== COMPRESSED ref:n/1 ===\none\ntwo\n=== COMPRESSED ref:n/2 ===\nthree\n```", "nothing", None]
    got = spark.createDataFrame([(a,) for a in answers], "a string").select(pages.condensed_blocks(F.col("a")).alias("b")).collect()
    assert [(x.ref, x.text) for x in got[0].b] == [("n/1", "one\ntwo"), ("n/2", "three")] and not got[1].b
    arrays = ['```json\n[{"idx": 1}]\n```', '[{"idx": 2}]', '{"idx": 3}', "[broken", None]
    got = spark.createDataFrame([(a,) for a in arrays], "a string").select(pages.fenced_array(F.col("a"), "struct<idx: int>").alias("b")).collect()
    assert [r.b[0].idx for r in got[:2]] == [1, 2] and got[2].b is None and not (got[3].b and got[3].b[0] and got[3].b[0].idx) and got[4].b is None
    res = spark.sql("SELECT array(named_struct('files', array(array(named_struct('mimetype', 'image/jp2', 'url', 'a'), named_struct('mimetype', 'text/xml', 'url', 'b'))))) AS r")
    assert res.select(pages.first_xml(F.col("r")).alias("u")).first().u == "b"


def test_sinks_resume_and_versions(spark, tmp_path):
    items = spark.createDataFrame([("a",), ("b",)], "key string")
    done = f"{tmp_path}/done"
    sinks.mark_done(spark, done, "s", items.where("key = 'a'"))
    d = spark.read.parquet(done)
    assert [r.key for r in sinks.pending(items, d, "s", "key").collect()] == ["b"] and sinks.pending(items, d, "other", "key").count() == 2
    assert sinks.recheck(d, "s").count() == 0
    sinks.rewrite(items, f"{tmp_path}/t")
    sinks.rewrite(items.where("key = 'b'"), f"{tmp_path}/t")
    assert [r.key for r in sinks.current(spark, f"{tmp_path}/t").collect()] == ["b"]
    sinks.route(items, F.when(F.col("key") == "a", "normalized").otherwise("failed"), f"{tmp_path}/r")
    assert sorted(x for x in os.listdir(f"{tmp_path}/r") if "=" in x) == ["status=failed", "status=normalized"]
    assert sinks.merged([items, items], "key").count() == 2


def test_second_run_finds_nothing(spark, tmp_path):
    lines(f"{tmp_path}/in/a.jsonl", {"t": "$", "item": "x"})
    args = (f"{tmp_path}/in", schemas.MENTION_PRICE, lambda df: df.where("t = '$'"), f"{tmp_path}/out", f"{tmp_path}/ck")
    incremental.run_available(spark, *args)
    incremental.run_available(spark, *args)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 1
    lines(f"{tmp_path}/in/b.jsonl", {"t": "$", "item": "y"}, {"t": "P"})
    incremental.run_available(spark, *args)
    assert spark.read.parquet(f"{tmp_path}/out").count() == 2
