"""Problem 3: far too many small files.

compact_parquet() copies the encoded column blocks of many Parquet files into a few large ones
without decoding a page (sources/parquet_blocks.py). records_of_bodies() takes the JSON lines of
tiny text files to one row for each record, so that they can be encoded once and then compacted.
"""

from __future__ import annotations

import math
from contextlib import ExitStack

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ledgerloom.operators import batching
from ledgerloom.session import cut_lineage, drop, shared_path
from ledgerloom.sources import parquet_blocks

TARGET_BYTES = 128 << 20
#: Outputs that are packed in one pass over a lane of the listing; lanes are packed side by side.
LANE_OUTPUTS = 64
#: What a line of a tiny file holds; all are read as text first, so that an odd type loses no record.
RECORD_FIELDS = {
    "record_id": "string", "ref": "string", "year": "int", "commodity_id": "string", "unit": "string",
    "price_per_unit_usd": "double", "confidence": "double", "note": "string",
}
REPORT = "output string, n_files long, n_blocks long, n_rows long, n_bytes long, schema_key string"


def _filesystem(path: str):
    from pyarrow import fs

    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def list_files(spark: SparkSession, folder: str) -> DataFrame:
    """(path, length) of the Parquet files under a folder, from the listing alone; nothing is opened."""
    return (
        spark.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
        .load(folder).select("path", "length")
    )


def compact_parquet(spark: SparkSession, source: str, target: str, target_bytes: int = TARGET_BYTES) -> DataFrame:
    """Copies every row group under source into files of about target_bytes under target; one row for each file.

    The listing is packed by size, so a task copies at most target_bytes, or one larger file, and holds a piece of a block and
    the footers only. A task that runs again writes the same file again. Files of different schemas never
    share an output. Each output is read back: blocks and rows must equal those of its parts, else
    the task fails. A folder without files gives an empty report. Blocks stay as small as they were: n_blocks tells
    how many an output holds.
    """
    files = list_files(spark, source)
    total = files.agg(F.coalesce(F.sum("length"), F.lit(0))).first()[0]
    lanes = max(1, math.ceil(total / (LANE_OUTPUTS * target_bytes)))
    packed = batching.pack(files, F.pmod(F.xxhash64("path"), F.lit(lanes)), ["path"], "length", target_bytes)

    def copy(pdf: pd.DataFrame) -> pd.DataFrame:
        by_schema: dict[str, list[tuple[str, tuple[int, int]]]] = {}
        for path in sorted(pdf["path"]):
            system, name = _filesystem(path)
            with system.open_input_file(name) as f:
                footer = parquet_blocks.read_footer(f)
            by_schema.setdefault(parquet_blocks.schema_key(footer), []).append((path, parquet_blocks.counts(footer)))
        rows, bin_ = [], f"{int(pdf['lane'].iloc[0]) & (1 << 64) - 1:016x}-{int(pdf['batch'].iloc[0]):05d}"
        for key, parts in sorted(by_schema.items()):
            system, folder = _filesystem(target)
            system.create_dir(folder, recursive=True)
            name, draft = f"{folder}/part-{bin_}-{key[:12]}.parquet", f"{folder}/_draft-{bin_}-{key[:12]}"

            def opened():
                for path, _ in parts:  # noqa: B023
                    with ExitStack() as stack:
                        at, inside = _filesystem(path)
                        yield stack.enter_context(at.open_input_file(inside))

            with system.open_output_stream(draft) as out:
                n = parquet_blocks.join_parts(opened(), out.write)
            system.move(draft, name)
            with system.open_input_file(name) as f:
                got = parquet_blocks.counts(parquet_blocks.read_footer(f))
            expected = (sum(c[0] for _, c in parts), sum(c[1] for _, c in parts))
            if got != expected:
                raise parquet_blocks.BlockError(f"{name} holds {got}, its parts held {expected}")
            rows.append((name, n["files"], n["blocks"], n["rows"], n["bytes"], key))
        return pd.DataFrame(rows, columns=["output", "n_files", "n_blocks", "n_rows", "n_bytes", "schema_key"])

    return packed.groupBy("lane", "batch").applyInPandas(copy, REPORT)


def records_of_bodies(files: DataFrame, body: str = "body", order: tuple[str, ...] = ("modified_at", "file_path")) -> DataFrame:
    """One row for each record_id that a complete JSON object on a line of a body gives.

    Lines end with LF, CR or CRLF; byte order marks, blank lines, other JSON values and cut off lines
    give nothing, nor do objects without a record_id. A record delivered more than once comes out
    once, as one whole copy: of those that name their page, if any does, the last by order (columns that files lacks are
    passed over) and line. Null and empty bodies give nothing. Partial aggregation keeps a record that is repeated
    endlessly from piling up.
    """
    place = [F.col(c).alias(f"o{i}") for i, c in enumerate(order) if c in files.columns]
    lines = files.select(*place, F.posexplode(F.split(F.col(body), r"\r\n|\n|\r")).alias("o9", "line"))
    lines = lines.withColumn("line", F.regexp_replace("line", r"^[\s\x{FEFF}]+|[\s\x{FEFF}]+$", ""))
    lines = lines.where(F.col("line").startswith("{") & F.col("line").endswith("}"))
    schema = ", ".join(f"{c} string" for c in RECORD_FIELDS) + ", _cut string"
    parsed = lines.withColumn("r", F.from_json("line", schema, {"columnNameOfCorruptRecord": "_cut"})).drop("line")
    parsed = parsed.where(F.col("r._cut").isNull() & F.col("r.record_id").isNotNull())
    fields = [c for c in RECORD_FIELDS if c != "record_id"]
    last = F.struct(F.col("r.ref").isNotNull().alias("named"), *[c for c in parsed.columns if c != "r"])
    whole = parsed.groupBy(F.col("r.record_id").alias("record_id")).agg(F.max_by(F.struct(*[F.col(f"r.{c}").alias(c) for c in fields]), last).alias("r"))
    return whole.select("record_id", *[F.expr(f"try_cast(r.{c} AS {RECORD_FIELDS[c]})").alias(c) for c in fields])


def consolidate_bodies(spark: SparkSession, files: DataFrame, target: str | None = None, target_bytes: int = TARGET_BYTES) -> tuple[DataFrame, DataFrame]:
    """(records, report): the tiny files' records encoded once, their blocks copied into few files, and these read.

    Both folders lie in the shared folder; the report has one row for each output.
    """
    staged, target = shared_path(spark, "encoded"), target or shared_path(spark, "compact")
    records_of_bodies(files).write.parquet(staged)
    report = cut_lineage(compact_parquet(spark, staged, target, target_bytes))  # one row for each large file
    schema = spark.read.parquet(staged).schema
    some = report.take(1)
    drop(spark, staged)  # every block of it has been copied and counted
    return (spark.read.schema(schema).parquet(target) if some else spark.createDataFrame([], schema)), report
