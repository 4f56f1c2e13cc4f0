"""Trees of page files, page markup and the census of a raw archive."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators.joins import first_by_priority

LEAST_CHARS = 80
#: Reading order of the texts that a page may have.
PRIORITY = ("pass0", "loc", "local")
_BLOCKS = (
    "Layout struct<Page: array<struct<PrintSpace: array<struct<TextBlock: array<struct<TextLine: array<struct<String: array<struct<_CONTENT: string>>>>>>>>>>>"
)


def listing(spark: SparkSession, root: str, pattern: str = "seq-*.txt") -> DataFrame:
    """path, year, lccn, date, seq, source, ref, n_bytes of page files, from their paths; empty files are listed too.

    The listing comes from the file system, because file sources skip files of no bytes, which here say that a page was tried.
    """
    hadoop = spark._jvm.org.apache.hadoop.fs
    base = hadoop.Path(root)
    system = base.getFileSystem(spark._jsc.hadoopConfiguration())
    rows = []
    if system.exists(base):
        found = system.listFiles(base, True)
        while found.hasNext():
            f = found.next()
            rows.append((f.getPath().toString(), f.getLen()))
    files = spark.createDataFrame(rows, "path string, n_bytes bigint")
    part = lambda i: F.regexp_extract("path", r"/(\d{4})/([^/]+)/(\d{4}-\d{2}-\d{2})/(seq-\d+)(\.ocr)?\.txt$", i)
    out = files.select(
        "path", "n_bytes", part(1).try_cast("int").alias("year"), part(2).alias("lccn"), part(3).alias("date"), part(4).alias("seq"),
        F.when(part(5) != "", "local").otherwise("loc").alias("source"),
    )
    out = out.where(F.col("year").isNotNull() & ~F.col("lccn").startswith("_"))
    return out.withColumn("ref", F.concat_ws("/", "lccn", "date", "seq"))


def texts(spark: SparkSession, root: str) -> DataFrame:
    """path, text of whole page files, stripped; files of no bytes give no row."""
    files = spark.read.option("recursiveFileLookup", "true").option("pathGlobFilter", "seq-*.txt").text(root, wholetext=True)
    return files.select(F.col("_metadata.file_path").alias("path"), F.trim(F.regexp_replace("value", r"^\s+|\s+$", "")).alias("text"))


def census(files: DataFrame) -> DataFrame:
    """year, issues, pages with text, empty and local ones, usable pages and bytes, one row a year.

    local counts every local file, also empty ones and those beside an archive text; usable counts a page once.
    """
    page = files.groupBy("year", "lccn", "date", "seq").agg(
        F.max(F.when(F.col("source") == "loc", F.col("n_bytes"))).alias("loc"), F.max(F.when(F.col("source") == "local", F.col("n_bytes"))).alias("local")
    )
    return page.groupBy("year").agg(
        F.count_distinct("lccn", "date").alias("issues"), F.count_if(F.col("loc") > 0).alias("loc_pages"), F.count_if(F.col("loc") == 0).alias("empty_pages"),
        F.count("local").alias("local_pages"), F.count_if(F.greatest(F.coalesce("loc", F.lit(0)), F.coalesce("local", F.lit(0))) > 0).alias("usable_pages"),
        F.sum(F.coalesce("loc", F.lit(0)) + F.coalesce("local", F.lit(0))).alias("bytes"),
    )


def best_text(pages: DataFrame, keys: list[str], source: str = "source", text: str = "text") -> DataFrame:
    """One row for each page: its first non-empty text in the order of PRIORITY; pages without any are left out."""
    rank = F.array_position(F.lit(list(PRIORITY)), F.col(source))
    usable = F.length(F.trim(F.coalesce(F.col(text), F.lit("")))) > 0
    return first_by_priority(pages, keys, F.when(usable & (rank > 0), rank), [F.col(text)])


def issue_source(pages: DataFrame, issue: list[str], source: str = "source") -> DataFrame:
    """Condensed pages of the issues that have any, the raw pages of the others; the choice is by issue, not by page."""
    flag = pages.groupBy(*issue).agg(F.max(F.col(source) == "pass0").alias("__p"))
    return pages.join(flag, issue).where((F.col(source) == "pass0") == F.col("__p")).drop("__p")


def long_enough(text: Column, least: int = LEAST_CHARS) -> Column:
    return F.length(F.trim(F.coalesce(text, F.lit("")))) >= least


def alto_text(xml: Column) -> Column:
    """The words of an ALTO page, one line for each text block; with or without a namespace, empty if it cannot be read."""
    clean = F.regexp_replace(F.regexp_replace(xml, r"<(/?)[A-Za-z0-9]+:", "<$1"), r"\sxmlns(:\w+)?=\"[^\"]*\"", "")
    tree = F.from_xml(clean, _BLOCKS, {"attributePrefix": "_"})
    blocks = F.flatten(F.flatten(F.transform(tree["Layout"]["Page"], lambda p: F.transform(p["PrintSpace"], lambda s: s["TextBlock"]))))
    words = F.transform(blocks, lambda b: F.array_join(F.transform(F.flatten(F.transform(b["TextLine"], lambda t: t["String"])), lambda s: s["_CONTENT"]), " "))
    return F.coalesce(F.array_join(F.filter(words, lambda w: w != ""), "\n"), F.lit(""))


def condensed_blocks(answer: Column) -> Column:
    """array<struct<ref, text>> of the `=== COMPRESSED ref:X ===` blocks in an answer, without code fences."""
    body = F.regexp_replace(answer, r"(?m)^```[a-z]*\s*$", "")
    pattern = r"(?s)=== COMPRESSED ref:(\S+) ===\s*(.*?)(?==== COMPRESSED ref:|\z)"
    refs, texts_ = (F.regexp_extract_all(body, F.lit(pattern), F.lit(i)) for i in (1, 2))
    return F.transform(F.arrays_zip(refs.alias("ref"), texts_.alias("text")), lambda b: F.struct(b["ref"].alias("ref"), F.trim(F.regexp_replace(b["text"], r"\s+$", "")).alias("text")))


def fenced_array(answer: Column, element: str) -> Column:
    """array<element> of the JSON array in an answer, with or without a code fence; null for anything else."""
    body = F.trim(F.regexp_replace(answer, r"^\s*```[a-z]*\s*|\s*```\s*$", ""))
    return F.when(body.startswith("["), F.from_json(body, f"array<{element}>"))


def first_xml(resources: Column) -> Column:
    """The url of the first text/xml file of a page's resources."""
    return F.get(F.filter(F.flatten(F.transform(resources, lambda r: F.flatten(r["files"]))), lambda f: f["mimetype"] == "text/xml"), F.lit(0))["url"]
