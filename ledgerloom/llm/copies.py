"""Problem 1: duplicates hidden by formatting differences.

Progressive partition refinement. Level 1 groups by invariants that cost a few byte scans: the length
of the text without separators and how often some letters and every digit occur in it. No change
of dress alters them. Only members of classes with several members are carried on; level 2 gives
those the full key (fields folded and sorted, words of the commodity) and splits the classes by it.
Classes travel as (key, smallest id, count) with partial aggregation, never as lists of members,
so one group of copies may hold any share of the rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.session import cut_lineage

FIELD_BREAK = r"[;|\r\n\x0B\x0C\x{85}\x{2028}\x{2029}]+"
WORD = r"\p{N}+(?:\.\p{N}+)*|\p{L}[\p{L}\p{M}]*|\p{Sc}"
GROUPING_COMMA = r"(?<=(?<![\p{N}.,])\p{N}{1,3}(?:,\p{N}{3}){0,9}),(?=\p{N}{3}(?!\p{N}))"
HISTOGRAM = "eaotrnsd0123456789"


def folded(text: Column) -> Column:
    """Lower case, and without the commas that group a number's digits in threes."""
    return F.regexp_replace(F.lower(text), GROUPING_COMMA, "")


def fields_key(text: Column) -> Column:
    """The text's fields as words parted by blanks, without blank fields, sorted, one to a line."""
    fields = F.transform(
        F.split(folded(text), FIELD_BREAK), lambda f: F.array_join(F.regexp_extract_all(f, F.lit(WORD), F.lit(0)), " ")
    )
    return F.array_join(F.array_sort(F.filter(fields, lambda f: f != "")), "\n")


def words_key(name: Column) -> Column:
    """The words of a name, sorted; null counts as no words."""
    return F.array_join(F.array_sort(F.regexp_extract_all(F.lower(F.coalesce(name, F.lit(""))), F.lit(r"[\p{L}\p{M}\p{N}]+"), F.lit(0))), " ")


def invariants(text: Column, name: Column) -> Column:
    """One hash of what every dress of a record shares: lengths and part of the letter histogram."""
    stripped = F.regexp_replace(F.lower(text), r"[^\p{L}\p{M}\p{N}\p{Sc}]+", "")
    n = F.length(stripped)
    counts = [n - F.length(F.replace(stripped, F.lit(c), F.lit(""))) for c in HISTOGRAM]
    return F.xxhash64(n, *counts, F.length(F.regexp_replace(F.coalesce(name, F.lit("")), r"[^\p{L}\p{M}\p{N}]+", "")))


def classes(rows: DataFrame, id_col: str, text_col: str, name_col: str) -> tuple[DataFrame, DataFrame]:
    """(members, firsts): rows that may have copies with their key, and the classes of two or more.

    members has id, key; firsts has key, first_id, n_copies. Rows whose text is null or without a word
    are in neither: they are no one's copies. Other columns are not read and may have any name.
    An empty table gives two empty frames. Equal rows with the same id count as copies.
    """
    base = rows.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), F.col(name_col).alias("name"))
    base = base.where(F.col("text").rlike(r"[\p{L}\p{N}\p{Sc}]")).withColumn("cheap", invariants(F.col("text"), F.col("name")))
    several = base.groupBy("cheap").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("cheap")
    key = F.unhex(F.md5(F.concat_ws("\n\n", fields_key(F.col("text")), words_key(F.col("name"))).cast("binary")))
    # both uses of the members read what is written here; only rows that may have copies are
    members = cut_lineage(base.join(several, "cheap").select("id", key.alias("key")))
    firsts = members.groupBy("key").agg(F.min("id").alias("first_id"), F.count(F.lit(1)).alias("n_copies")).where("n_copies > 1")
    return members, firsts


def copies(rows: DataFrame, id_col: str = "record_id", text_col: str = "original_text", name_col: str = "commodity_id") -> DataFrame:
    """(first_id, copy_id): every record but the smallest of each class of two or more."""
    members, firsts = classes(rows, id_col, text_col, name_col)
    found = members.join(firsts.select("key", "first_id"), "key").where(F.col("id") != F.col("first_id"))
    return found.select("first_id", F.col("id").alias("copy_id"))


def collapsed(rows: DataFrame, id_col: str = "record_id", text_col: str = "original_text", name_col: str = "commodity_id") -> DataFrame:
    """(record_id, n_copies): one row for each record as such; those without text stay, one by one."""
    members, firsts = classes(rows, id_col, text_col, name_col)
    later = members.join(firsts.select("key", "first_id"), "key").where(F.col("id") != F.col("first_id")).select("id")
    kept = rows.select(F.col(id_col).alias("record_id")).join(later, F.col("record_id") == F.col("id"), "left_anti")
    counted = firsts.select(F.col("first_id").alias("record_id"), "n_copies")
    return kept.join(counted, "record_id", "left").select("record_id", F.coalesce("n_copies", F.lit(1)).cast("bigint").alias("n_copies"))
