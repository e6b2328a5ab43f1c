"""What the operators share: tables in the shared folder, grouping and ranking that survive hot keys."""

from __future__ import annotations

import atexit
import functools
import pickle
import shutil
import tempfile
import uuid
from collections.abc import Callable, Iterator

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

#: Parts into which the rows of one key are dealt before anything gathers them.
SALTS = 512
#: Rows of one key that may meet in one task.
HOT_ROWS = 100_000

_own_dir: list[str] = []
#: Tables that were written, by open tidied() call.
_written: list[list[str]] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares. Where driver and executors are one process (as in tests) and none is set, a folder of this machine, until the process ends."""
    found = spark.conf.get("spark.checkpoint.dir", None) or spark.sparkContext.getConf().get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError("spark.checkpoint.dir must name a folder that driver and executors share")
    if not _own_dir:
        _own_dir.append(tempfile.mkdtemp(prefix="sondeo-"))
        atexit.register(shutil.rmtree, _own_dir[0], ignore_errors=True)
    return f"file://{_own_dir[0]}"


def scratch_path(spark: SparkSession, label: str) -> str:
    """A new path in the shared folder; what is written there goes as tidied() says."""
    path = f"{shared_dir(spark)}/sondeo-{label}-{uuid.uuid4().hex}"
    if _written:
        _written[-1].append(path)
    return path


def materialize(df: DataFrame, label: str) -> DataFrame:
    """Writes df to the shared folder and reads it back: lineage ends there, and a lost executor costs no recomputation."""
    path = scratch_path(df.sparkSession, label)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def tidied(make: Callable[..., DataFrame]) -> Callable[..., DataFrame]:
    """make, after which only those of the tables that it wrote are left which its result still reads.

    They fall to the caller, if that is tidied too. Of what a failed call wrote nothing is left.
    """

    @functools.wraps(make)
    def run(spark: SparkSession, *args, **kwargs) -> DataFrame:
        _written.append([])
        read: list[str] = []
        try:
            out = make(spark, *args, **kwargs)
            read = out.inputFiles()
            return out
        finally:
            own = _written.pop()
            kept = {p for p in own if any(p.rpartition("/")[2] in f for f in read)}
            for p in own:
                if p not in kept:
                    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(p)
                    path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
            if _written:
                _written[-1] += sorted(kept)

    return run


def salt(*cols: str | Column, salts: int = SALTS) -> Column:
    return F.pmod(F.xxhash64(*cols), F.lit(salts)).cast("int")


def attach_by_key(rows: DataFrame, keys: list[str], values: DataFrame, salt_by: list[str], salts: int = SALTS, parts: DataFrame | None = None) -> DataFrame:
    """rows with the columns of values, which has one row for each of the keys (null keys are equal to each other).

    The keys of salted parts of rows get the values first, and rows get them from their part, so that a key with a third
    of all rows is never in one task. parts: the keys and _salt of rows, if they are known.
    """
    own = rows.withColumn("_salt", salt(*salt_by, salts=salts))
    parts = own.select(*keys, "_salt").distinct() if parts is None else parts.select(*keys, "_salt")
    more = [c for c in values.columns if c not in keys]
    a, b = parts.alias("a"), values.alias("b")
    by_part = a.join(b, [F.col(f"a.{k}").eqNullSafe(F.col(f"b.{k}")) for k in keys]).select("a.*", *(f"b.{c}" for c in more))
    x, y = own.alias("x"), by_part.alias("y")
    on = [F.col(f"x.{k}").eqNullSafe(F.col(f"y.{k}")) for k in [*keys, "_salt"]]
    return x.join(y, on).select(*(F.col(f"x.{c}") for c in rows.columns), *(F.col(f"y.{c}") for c in more))


def hot_keys(rows: DataFrame, key: str, most: int = HOT_ROWS) -> DataFrame | None:
    """The keys (written down) that more than `most` rows have, at most rows / most of them; None if there are none."""
    found = materialize(rows.groupBy(key).agg(F.count(F.lit(1)).alias("_n")).where(F.col("_n") > most).select(key), "hot")
    return None if found.isEmpty() else found


def join_by_key(rows: DataFrame, values: DataFrame, key: str, hot: DataFrame | None, most: int = 1_000_000) -> DataFrame:
    """rows joined to values (at most one row per key). hot: of hot_keys(): rows of such keys stay where they are and get
    their values by broadcast, if a count shows at most `most` of them, else in salted parts; rows of all others meet by key."""
    if hot is None:
        return rows.join(values, key)
    few = values.join(F.broadcast(hot), key, "left_semi") if hot.limit(most + 1).count() <= most else None
    if few is None:
        return attach_by_key(rows, [key], values, [c for c in rows.columns if c != key][:1])
    cold = rows.join(F.broadcast(hot), key, "left_anti").join(values, key)
    return cold.unionByName(rows.join(F.broadcast(hot), key, "left_semi").join(F.broadcast(few), key))


def smallest_of_group(rows: DataFrame, keys: list[str], id_col: str, salts: int = SALTS) -> DataFrame:
    """rows with keep_id (smallest id of the rows with the same keys) and group_size.

    Null keys are equal to each other; null ids count but are never the smallest.
    """
    parts = rows.withColumn("_salt", salt(id_col, salts=salts)).groupBy(*keys, "_salt").agg(F.min(id_col).alias("_least"), F.count(F.lit(1)).alias("_rows"))
    sums = parts.groupBy(*keys).agg(F.min("_least").alias("keep_id"), F.sum("_rows").alias("group_size"))
    return attach_by_key(rows, keys, sums, [id_col], salts, parts)


def rank_within(rows: DataFrame, key: str, order: list[str], total: int, part_rows: int = 20_000, part: Column | None = None) -> DataFrame:
    """rows with rank: 0, 1, ... within each (non-null) key, the same on every run.

    Rows are dealt into hashed parts of about part_rows; a key's ranks count on from part to part, so only the
    number of parts, never a key's rows, meets in one task. part: the number of a row's part instead of a hash; where it
    never falls in the given order, ranks follow that order from the first row to the last.
    """
    n = max(64, -(-total // part_rows))
    parts = rows.withColumn("_part", salt(*order, salts=n) if part is None else part)
    counts = parts.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_rows"))
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    starts = counts.select(key, "_part", F.coalesce(F.sum("_rows").over(before), F.lit(0)).alias("_start"))
    inside = Window.partitionBy(key, "_part").orderBy(*order)
    ranked = parts.withColumn("_at", F.row_number().over(inside) - 1)
    return ranked.join(starts, [key, "_part"]).withColumn("rank", (F.col("_start") + F.col("_at")).cast("long")).select(*rows.columns, "rank")


def semi_join(rows: DataFrame, ids: DataFrame, col: str, most: int = 1_000_000) -> DataFrame:
    """rows whose col is in ids (one column of that name). ids go to all executors only if a count shows at most `most` of them."""
    small = ids.limit(most + 1).count() <= most
    return rows.join(F.broadcast(ids) if small else ids, col, "left_semi")


def bounded_sample(rows: DataFrame, id_col: str, n: int) -> DataFrame:
    """At most n rows, the same on every run: of n hashed buckets of ids, one id each. Partial sums and the result are bounded by n, whatever the table's size."""
    known = rows.where(F.col(id_col).isNotNull())
    picked = known.groupBy(salt(id_col, F.lit("sample"), salts=n).alias("_bucket")).agg(F.min_by(id_col, F.xxhash64(id_col)).alias(id_col)).select(id_col)
    found = known.join(F.broadcast(picked), id_col, "left_semi")
    return found.orderBy(id_col, F.xxhash64(*found.columns)).limit(n)  # rows that repeat an id may be more than n


def only_kept(docs: DataFrame, kept: DataFrame, col: str, *more: str) -> DataFrame:
    """The rows of docs whose id, and values of the further columns, are in kept, one for each, and all rows without an id."""
    keys = [col, *more]
    known = docs.where(F.col(col).isNotNull()).join(kept.where(F.col(col).isNotNull()), keys, "left_semi").dropDuplicates(keys)
    return known.select(*docs.columns).union(docs.where(F.col(col).isNull()))


def free_name(docs: DataFrame, name: str) -> str:
    while name in docs.columns:
        name += "_"
    return name


def small_batches(spark: SparkSession, rows: int = 1000) -> None:
    """Texts go to Python in batches of at most so many rows; a smaller setting of the session stays."""
    key = "spark.sql.execution.arrow.maxRecordsPerBatch"
    if not 0 < int(spark.conf.get(key)) <= rows:
        spark.conf.set(key, rows)


def in_one_task(spark: SparkSession, work: Callable[[], dict[str, np.ndarray]]) -> dict[str, np.ndarray]:
    """Arrays that work() makes in a task: what is fitted to a bounded sample takes no time or threads of the driver, and is made again if its executor goes."""

    def run(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for _ in batches:
            yield pd.DataFrame({"made": [pickle.dumps(work())]})

    return pickle.loads(spark.range(0, 1, 1, 1).mapInPandas(run, "made binary").head()[0])


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")

