"""Writes that can be repeated: appends, routing by status, versions swapped by a pointer, and sentinels after the data."""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F


def append(df: DataFrame, path: str, form: str = "parquet") -> None:
    df.write.mode("append").format(form).save(path)


def route(df: DataFrame, status: Column, path: str) -> None:
    """One folder for each status (normalized, unresolved, failed, ...)."""
    df.withColumn("status", status).write.mode("append").partitionBy("status").parquet(path)


def mark_done(spark: SparkSession, path: str, stage: str, keys: DataFrame) -> None:
    """Appends (stage, key, ts) to the done table; call it after the data has been committed."""
    keys.select(F.lit(stage).alias("stage"), F.col(keys.columns[0]).cast("string").alias("key"), F.current_timestamp().alias("ts")).write.mode("append").parquet(path)


def pending(items: DataFrame, done: DataFrame, stage: str, key: str) -> DataFrame:
    """Items of a stage that no sentinel names."""
    return items.join(done.where(F.col("stage") == stage).select(F.col("key").alias(key)).distinct(), key, "left_anti")


def recheck(done: DataFrame, stage: str) -> DataFrame:
    """The done table without a stage, so that it runs again; outputs that exist still count."""
    return done.where(F.col("stage") != stage)


def _pointers(spark: SparkSession, root: str) -> tuple[object, object, list[str]]:
    """(file system, folder, names in order) of the pointers, each an empty file `number-version`."""
    folder = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_pointers")
    system = folder.getFileSystem(spark._jsc.hadoopConfiguration())
    return system, folder, sorted(f.getPath().getName() for f in system.listStatus(folder)) if system.exists(folder) else []


def rewrite(df: DataFrame, root: str) -> str:
    """A new version beside the old one, then a new pointer: readers see the old rows or the new ones, never a mixture or nothing.

    Pointers are added and never overwritten, so a run that ends half-way leaves the last whole version in place.
    """
    spark = df.sparkSession
    version = uuid.uuid4().hex
    df.write.parquet(f"{root}/v-{version}")
    system, folder, names = _pointers(spark, root)
    number = int(names[-1].split("-")[0]) + 1 if names else 0
    system.create(spark._jvm.org.apache.hadoop.fs.Path(folder, f"{number:012d}-{version}"), False).close()
    return f"{root}/v-{version}"


def current(spark: SparkSession, root: str) -> DataFrame:
    """The rows of the latest version."""
    return spark.read.parquet(f"{root}/v-{_pointers(spark, root)[2][-1].split('-')[1]}")


def merged(parts: list[DataFrame], key: str) -> DataFrame:
    """The outputs of several runs together, each key once: the union may be repeated without doubling anything."""
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p, allowMissingColumns=True)
    return out.dropDuplicates([key])
