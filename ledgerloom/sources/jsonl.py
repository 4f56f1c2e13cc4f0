"""JSON-lines scans with explicit schemas: tolerant, strict, and by file."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ledgerloom import schemas

FIRST_YEAR, LAST_YEAR = 1770, 1963


def exists(spark: SparkSession, path: str) -> bool:
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    statuses = p.getFileSystem(spark._jsc.hadoopConfiguration()).globStatus(p)
    return statuses is not None and len(statuses) > 0


def tolerant(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Rows of the lines that are JSON objects; bad and blank lines and missing files give nothing.

    Numbers are read as text and cast, so a number in quotes or of another kind keeps its row; what cannot be
    cast becomes null.
    """
    wanted = T.StructType.fromDDL(schema)
    if not exists(spark, path):
        return spark.createDataFrame([], wanted)
    plain = lambda t: T.StringType() if not isinstance(t, (T.ArrayType, T.StructType)) else t
    text = T.StructType([T.StructField(f.name, plain(f.dataType)) for f in wanted.fields] + [T.StructField("_bad", T.StringType())])
    lines = spark.read.schema(text).option("mode", "PERMISSIVE").option("columnNameOfCorruptRecord", "_bad").json(path)
    cast = [F.col(f.name).try_cast(f.dataType.simpleString()).alias(f.name) if plain(f.dataType) != f.dataType else F.col(f.name) for f in wanted.fields]
    return lines.where(F.col("_bad").isNull()).select(*cast)


def strict(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """As written or not at all: a line that is no object of the schema ends the query with an error."""
    return spark.read.schema(schema).option("mode", "FAILFAST").json(path)


def prices(spark: SparkSession, path: str, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Price records of the years first..last, both included; a missing year counts as 0."""
    return tolerant(spark, path, schemas.PRICES).where(F.coalesce("year", F.lit(0)).between(first, last))


def unresolved(spark: SparkSession, path: str) -> DataFrame:
    return tolerant(spark, path, schemas.UNRESOLVED)


def price_mentions(spark: SparkSession, glob: str, first: int = FIRST_YEAR, last: int = LAST_YEAR) -> DataFrame:
    """Mentions of prices with file_key (`year/name`) of files under year folders in range."""
    if not exists(spark, glob):
        return spark.createDataFrame([], schemas.MENTION_PRICE + ", file_key string")
    rows = spark.read.schema(schemas.MENTION_PRICE).json(glob).withColumn("file_key", F.regexp_extract(F.col("_metadata.file_path"), r"(\d{4}/[^/]+)$", 1))
    year = F.left("file_key", F.lit(4)).try_cast("int")
    return rows.where((F.col("t") == "$") & year.between(first, last))


def sentinel(spark: SparkSession, path: str, key: str) -> DataFrame:
    """The keys that a multi-line JSON sentinel lists; a missing or corrupt file lists none, unknown fields are dropped."""
    if not exists(spark, path):
        return spark.createDataFrame([], "key string")
    rows = spark.read.schema(f"{key} array<string>, _bad string").option("multiLine", "true").option("columnNameOfCorruptRecord", "_bad").json(path)
    return rows.where("_bad IS NULL").select(F.explode(key).alias("key"))
