import os

import pytest
from pyspark.sql import functions as F

from ledgerloom.llm import bpe

if not os.path.exists(bpe.VOCABULARY):
    pytest.skip("the vocabulary is not here", allow_module_level=True)

TEXTS = [
    "The price of wheat, 1.25 a bushel; hasn't been so low since 1843!", "", None, "   ", "\n\n\t x  y z", "don’t — “curly” ﬁne ﬂour ÆØÅ ßtraße", "<|endoftext|> is plain text",
    "👩‍🌾 field 小麦の値段 пшеница дёшево عدد", "supercalifragilisticexpialidocious " * 3, "x" * 3000, "12345678901234567890", "_____ $$$$$$ ....", "a\r\nb\x0b\x0cc\x1c\x85d", "ab" * 700 + "Ωθ" * 400, "﻿bom ​zero",
]


@pytest.fixture(scope="module")
def vocabulary():
    return bpe.Vocabulary()


def test_same_ids_as_the_library_and_round_trip(spark, vocabulary):
    from tokenizers import Tokenizer

    t = Tokenizer.from_file(bpe.VOCABULARY.replace(".tiktoken", ".json"))
    t.encode_special_tokens = True
    want = [e.ids for e in t.encode_batch([x or "" for x in TEXTS], add_special_tokens=False)]
    docs = spark.createDataFrame([(i, x, 1, 2) for i, x in enumerate(TEXTS)], "doc_id bigint, text string, words int, ids int")
    coded = bpe.encode(docs, vocabulary)
    assert coded.schema["ids"].dataType.simpleString() == "array<int>"
    got = {r.doc_id: list(r.ids) for r in coded.collect()}
    assert [got[i] for i in range(len(TEXTS))] == want
    back = {r.doc_id: r.text for r in coded.select("doc_id", bpe.decode(vocabulary, F.col("ids")).alias("text")).collect()}
    assert [back[i] for i in range(len(TEXTS))] == [x or "" for x in TEXTS]
    assert bpe.encode(docs.limit(0), vocabulary).count() == 0


def test_heap_and_fold_agree(spark, vocabulary):
    words = sorted({w for x in TEXTS if x for w in x.split() if 0 < len(w) <= 200})
    df = spark.createDataFrame([(w,) for w in words], "word string")
    got = {r.word: list(r.ids) for r in bpe.encode_words(df, vocabulary).collect()}
    assert all(got[w] == bpe.heap_merge(vocabulary.ranks, w.encode()) for w in words)


def test_frequent_and_rare_words_come_out_alike(spark, vocabulary, monkeypatch):
    docs = spark.createDataFrame([(i, f"Zebulonshire qwxzt{i % 7} frabjous{i}") for i in range(60)], "doc_id bigint, text string")
    sent = sorted((r.doc_id, list(r.ids)) for r in bpe.encode(docs, vocabulary).collect())
    monkeypatch.setattr(bpe, "FREQUENT", 0)
    assert sent == sorted((r.doc_id, list(r.ids)) for r in bpe.encode(docs, vocabulary).collect())


def test_joining_many_pieces(spark, vocabulary):
    text = "wheat & barley; " * 5000
    docs = spark.createDataFrame([(1, text)], "doc_id bigint, text string")
    assert bpe.encode(docs, vocabulary).select(bpe.decode(vocabulary, F.col("ids"))).first()[0] == text
