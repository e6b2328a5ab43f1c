"""Tables that a plan writes down once, to read them more than once."""

from __future__ import annotations

import atexit
import shutil
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_own: list[str] = []


def scratch_dir(spark: SparkSession) -> str | None:
    """The folder in spark.checkpoint.dir. Where driver and executors are one process and none is set, a folder of this machine until the process ends; None on a cluster that names none."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        return None
    if not _own:
        _own.append(tempfile.mkdtemp(prefix="sondeo-"))
        atexit.register(shutil.rmtree, _own[0], ignore_errors=True)
    return f"file://{_own[0]}"


def written_once(df: DataFrame, label: str) -> DataFrame:
    """df from a table written for it, so that what makes it runs once; df itself where no folder is shared.

    Tables stay until clear(), as the result is read after the call.
    """
    spark = df.sparkSession
    folder = scratch_dir(spark)
    if folder is None:
        return df
    path = f"{folder}/sondeo-scratch-{label}-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def spread(df: DataFrame, by: str | None = None) -> DataFrame:
    """df in at least as many partitions as there are cores; large input has them anyway and is left as it is.

    by: a column by which rows are dealt, if there is one that is spread evenly and the same on every run; without it
    a task sorts all rows that it reads, so that rows which are read again go where they went.
    """
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores, *([by] if by else [])) if df.rdd.getNumPartitions() < cores else df


def clear(spark: SparkSession) -> None:
    """Deletes what written_once() wrote. For when results that were made from it are no longer read."""
    if folder := scratch_dir(spark):
        pattern = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{folder}/sondeo-scratch-*")
        fs = pattern.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
        for status in fs.globStatus(pattern) or ():
            fs.delete(status.getPath(), True)
