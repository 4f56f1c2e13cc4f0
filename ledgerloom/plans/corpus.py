"""The pN_ queries of the core."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import compaction, spikes, units
from ledgerloom.session import table


def p3_found(spark: SparkSession, sf: str) -> DataFrame:
    records, _ = compaction.consolidate_bodies(spark, table(spark, sf, "price_files"))
    return records.select("record_id", "ref")


def p3_report(spark: SparkSession, sf: str) -> DataFrame:
    """The rows that the validated outputs hold together."""
    return p3_outputs(spark, sf).agg(F.sum("n_rows").alias("n_rows"))


def p3_outputs(spark: SparkSession, sf: str) -> DataFrame:
    """n_files, n_blocks, n_rows and n_bytes of each consolidated file."""
    _, report = compaction.consolidate_bodies(spark, table(spark, sf, "price_files"))
    return report.drop("output", "schema_key")


def p4_flagged(spark: SparkSession, sf: str) -> DataFrame:
    """Implausible readings and why; a series is one newspaper's prices of one commodity as written."""
    rows = table(spark, sf, "normalized").where("year <> 0").select(
        "record_id", F.substring_index("ref", "/", 1).alias("newspaper"), "commodity_id", "date", "price_per_unit_usd"
    )
    return spikes.implausible(rows, ["newspaper", "commodity_id"], "date", "price_per_unit_usd")


def p4_found(spark: SparkSession, sf: str) -> DataFrame:
    return p4_flagged(spark, sf).select("record_id")


def p5_standard(spark: SparkSession, sf: str) -> DataFrame:
    """Every settled price by the commodity's standard unit."""
    refs = table(spark, sf, "commodity_ref"), table(spark, sf, "unit_ref")
    return units.to_standard_units(table(spark, sf, "normalized"), *refs)


def p5_found(spark: SparkSession, sf: str) -> DataFrame:
    return p5_standard(spark, sf).where("quoted_unit <> std_unit").select("record_id", "quoted_unit")


def p5_scales(spark: SparkSession, sf: str) -> DataFrame:
    refs = table(spark, sf, "commodity_ref"), table(spark, sf, "unit_ref")
    return units.label_scales(table(spark, sf, "normalized"), *refs)


QUERIES = {"p4_found": p4_found, "p4_flagged": p4_flagged, "p5_found": p5_found, "p5_scales": p5_scales, "p5_standard": p5_standard, "p3_found": p3_found, "p3_report": p3_report, "p3_outputs": p3_outputs}
ORACLES = {
    "p3_found": r"""
WITH lines AS (SELECT trim(unnest(regexp_split_to_array(body, '\r\n|\n|\r')), chr(65279) || ' ' || chr(9)) AS line FROM price_files)
SELECT DISTINCT json_extract_string(line, '$.record_id') AS record_id, json_extract_string(line, '$.ref') AS ref
FROM lines WHERE CASE WHEN json_valid(line) THEN json_type(line) = 'OBJECT' AND json_extract_string(line, '$.record_id') IS NOT NULL ELSE false END""",
    "p3_report": r"""
WITH lines AS (SELECT trim(unnest(regexp_split_to_array(body, '\r\n|\n|\r')), chr(65279) || ' ' || chr(9)) AS line FROM price_files)
SELECT count(DISTINCT json_extract_string(line, '$.record_id')) AS n_rows
FROM lines WHERE CASE WHEN json_valid(line) THEN json_type(line) = 'OBJECT' ELSE false END""",
}
