"""Session settings and the folder shared by all executors."""

from __future__ import annotations

import os
import re
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession


def local_session(cores: int | str = "*", app: str = "ledgerloom") -> SparkSession:
    """A local session for tests and the benchmark; a cluster brings its own."""
    spark = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName(app)
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.driver.memory", os.environ.get("LEDGERLOOM_DRIVER_MEMORY", "8g"))
        .config("spark.cleaner.referenceTracking.cleanCheckpoints", "true")
        .config("spark.ui.enabled", "false")
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder of spark.checkpoint.dir, which every executor reaches.

    Only on one machine may the session name none; then a temporary folder is set. A cluster without one is an error.
    """
    jsc = spark.sparkContext._jsc.sc()
    named = spark.sparkContext.getConf().get("spark.checkpoint.dir") or spark.conf.get("spark.checkpoint.dir", None)
    if named is None:
        known = jsc.getCheckpointDir()
        if known.isDefined():
            return known.get()
        if not re.match(r"local(\[|$)", spark.sparkContext.master):
            raise ValueError("set spark.checkpoint.dir to a folder that all executors reach")
        named = "file://" + tempfile.mkdtemp(prefix="ledgerloom-")
    if not jsc.getCheckpointDir().isDefined():
        spark.sparkContext.setCheckpointDir(named)
    return named


_made: list[str] = []


def shared_path(spark: SparkSession, name: str) -> str:
    """A path under the shared folder that no other run uses; clean() deletes it."""
    _made.append(f"{shared_dir(spark).rstrip('/')}/{name}-{uuid.uuid4().hex}")
    return _made[-1]


def drop(spark: SparkSession, path: str) -> None:
    """Deletes a folder that this run has made."""
    p = spark._jvm.org.apache.hadoop.fs.Path(path)
    p.getFileSystem(spark._jsc.hadoopConfiguration()).delete(p, True)


def clean(spark: SparkSession) -> None:
    """Deletes the tables and checkpoints that this session wrote to the shared folder; call it when its results have been read."""
    while _made:
        drop(spark, _made.pop())
    known = spark.sparkContext._jsc.sc().getCheckpointDir()
    if known.isDefined():
        drop(spark, known.get())


_shipped: set[str] = set()


def ship(spark: SparkSession) -> None:
    """Sends this package to the workers of a cluster, once; on one machine they find it where the driver did."""
    context = spark.sparkContext
    if context.applicationId in _shipped or re.match(r"local(\[|$)", context.master):
        return
    _shipped.add(context.applicationId)
    package = Path(__file__).resolve().parent
    target = Path(tempfile.mkdtemp(prefix="ledgerloom-code-")) / "ledgerloom.zip"  # the driver serves it to the workers
    with zipfile.ZipFile(target, "w") as z:
        for f in sorted(package.rglob("*.py")):
            z.write(f, f"{package.name}/{f.relative_to(package)}")
    context.addPyFile(str(target))


def cut_lineage(df: DataFrame) -> DataFrame:
    """The rows written to the shared folder and read again, so that a lost executor costs no recomputation."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)


def written(df: DataFrame, name: str) -> DataFrame:
    """The rows as a table of the shared folder; smaller than a checkpoint and read by column."""
    path, schema = shared_path(df.sparkSession, name), df.schema
    df.write.parquet(path)
    return df.sparkSession.read.schema(schema).parquet(path)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    ship(spark)
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
