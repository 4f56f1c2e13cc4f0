"""The queries of this subpackage: callables of (spark, folder of the tables)."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.llm import bpe, canonical, copies, leaks, percentiles, spam
from ledgerloom.session import table


def p1_found(spark: SparkSession, sf: str) -> DataFrame:
    return copies.copies(table(spark, sf, "normalized"))


def p1_records(spark: SparkSession, sf: str) -> DataFrame:
    return copies.collapsed(table(spark, sf, "normalized"))


def p2_found(spark: SparkSession, sf: str) -> DataFrame:
    rows = table(spark, sf, "normalized")
    places = canonical.resolve_places(rows, table(spark, sf, "place_ref"))
    return places.unionByName(canonical.resolve_names(rows, table(spark, sf, "commodity_ref")))


def p6_percentiles(spark: SparkSession, sf: str) -> DataFrame:
    """From summaries of each month's load that are merged afterwards."""
    rows = table(spark, sf, "normalized").withColumn("portion", F.trunc("loaded_at", "month"))
    parts = percentiles.summaries(rows, ["commodity_id", "year"], "price_per_unit_usd", "portion")
    return percentiles.answers(percentiles.combined(parts, ["commodity_id", "year"]), ["commodity_id", "year"])


def p7_ids(spark: SparkSession, sf: str) -> DataFrame:
    return bpe.encode(table(spark, sf, "documents"), bpe.Vocabulary())


def p7_decoded(spark: SparkSession, sf: str) -> DataFrame:
    """The texts read back from their ids; null texts come back empty."""
    vocabulary = bpe.Vocabulary()
    coded = bpe.encode(table(spark, sf, "documents"), vocabulary)
    return coded.select("doc_id", bpe.decode(vocabulary, F.col("ids")).alias("text"))


def p8_spans(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.spans(table(spark, sf, "documents"), table(spark, sf, "eval_items"))


def p8_found(spark: SparkSession, sf: str) -> DataFrame:
    return p8_spans(spark, sf).select("doc_id", "item_id").distinct()


def p8_cleaned(spark: SparkSession, sf: str) -> DataFrame:
    return leaks.without_spans(table(spark, sf, "documents"), p8_spans(spark, sf))


def p9_scores(spark: SparkSession, sf: str) -> DataFrame:
    return spam.scores(table(spark, sf, "documents"))


def p9_found(spark: SparkSession, sf: str) -> DataFrame:
    return p9_scores(spark, sf).where("score > 0.5").select("doc_id")


QUERIES = {
    "p9_found": p9_found, "p9_scores": p9_scores,
    "p7_ids": p7_ids, "p7_decoded": p7_decoded, "p8_found": p8_found, "p8_spans": p8_spans, "p8_cleaned": p8_cleaned,
    "p1_found": p1_found, "p1_records": p1_records, "p2_found": p2_found, "p6_percentiles": p6_percentiles,
}
