"""Cleaning of many files in a fixed number of jobs: files of one kind and one schema are one table."""

from __future__ import annotations

import datetime
import logging
import math
import re
from collections import defaultdict
from collections.abc import Iterator
from itertools import product
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import answers, dates
from ..functions.encoding import encoding_hits, fix_encoding
from ..functions.jsonrepair import json_outcome
from ..operators import columns as c
from ..operators.sampling import cleaned_name
from ..sources.scratch import spread, written_once
from .cleaning import BM_DATES, BV_DATE, Counters, clean_bm, clean_bv, kind_of
from .runs import OFFSET, list_files

log = logging.getLogger("sondeo")

#: The column that tells of which file a row is, in the written folders.
FILE = "file"
#: Rows, and bytes of raw texts, that one task sorts and writes. Packed bytes don't tell: a million rows that look alike are a few MB of Parquet, and hundreds in a sort.
TASK_ROWS, TASK_BYTES = 500_000, 128 << 20
#: Neighbouring rows of a file that stay together when it is dealt out.
CHUNK_ROWS = 100
#: All combinations of day and month orders that a column may have, one format list each.
_FORMATS = [tuple(f for sep, first in zip(dates.ORDERS, firsts, strict=True) for f in dates.ORDERS[sep][first]) for firsts in product(("month", "day"), repeat=len(dates.ORDERS))]


def schemas_of(spark: SparkSession, paths: list[str]) -> tuple[dict[str, str], dict[str, str]]:
    """(schema by path, what is wrong by path) of Parquet files, from their footers, in one job of many tasks.

    A path may be a folder of one table's files. Stores are those that pyarrow knows.
    """
    if not paths:
        return {}, {}

    def look(batches: Iterator) -> Iterator:
        import pandas as pd
        import pyarrow.dataset as pds
        from pyarrow import fs as pafs

        for pdf in batches:
            found = []
            for path in pdf["path"]:
                try:
                    store, inside = pafs.FileSystem.from_uri(path)
                    found.append((path, pds.dataset(inside, filesystem=store, format="parquet").schema.to_string(show_field_metadata=False, show_schema_metadata=False), None))
                except Exception as e:  # whatever is wrong with a file is told of that file
                    found.append((path, None, f"{type(e).__name__}: {e}"))
            yield pd.DataFrame(found, columns=["path", "schema", "error"])

    tasks = max(1, min(len(paths), 4 * spark.sparkContext.defaultParallelism))
    rows = spark.createDataFrame([(p,) for p in paths], "path string").repartition(tasks).mapInPandas(look, "path string, schema string, error string").collect()
    return {r.path: r.schema for r in rows if r.error is None}, {r.path: r.error for r in rows if r.error is not None}


def _names(paths: list[str]) -> dict[str, str]:
    """What each file's folder is called; names that two files share are told apart by a number."""
    out: dict[str, str] = {}
    for p in paths:
        name, k = cleaned_name(PurePosixPath(p.rstrip("/")).stem), 0
        while (full := f"{name}_{k}" if k else name) in out.values():
            k += 1
        out[p] = full
    return out


def _with_file(df: DataFrame, names: dict[str, str]) -> DataFrame:
    """df with the name of each row's file, and _chunk, a number that CHUNK_ROWS neighbouring rows share and that every run finds again. Folders are found by the beginning of the path, files by all of it."""
    path = F.regexp_replace(F.url_decode(F.replace(F.col("_metadata.file_path"), F.lit("+"), F.lit("%2B"))), "^file:/+", "/")
    known = df.sparkSession.createDataFrame([(re.sub("^file:/+", "/", p), n) for p, n in names.items()], f"_path string, {FILE} string")
    chunk = F.xxhash64("_metadata.file_path", F.floor(F.col("_metadata.row_index") / CHUNK_ROWS))
    found = df.withColumns({"_file_path": path, "_folder_path": F.regexp_replace(path, "/[^/]*$", ""), "_chunk": chunk})
    return found.join(F.broadcast(known), F.col("_path").isin(F.col("_file_path"), F.col("_folder_path"))).drop("_path", "_file_path", "_folder_path")


def _counts(df: DataFrame, raw_texts: list[str], dated: list[str]) -> list[Column]:
    """By file: rows, what was repaired, whether a date column has offsets throughout, and how its texts are read."""
    out = [F.count(F.lit(1)).alias("rows"), F.coalesce(F.sum("_bytes"), F.lit(0)).cast("long").alias("bytes"), F.coalesce(F.sum("_hits"), F.lit(0)).cast("long").alias("encoding_fixed")]
    if "_outcome" in df.columns:
        out += [F.count(F.when(F.col("_outcome") == k, 1)).alias(f"json_{k}") for k in ("fixed", "corrupted")]
        out.append(F.array_distinct(F.flatten(F.collect_set(F.transform("_items", lambda x: x["id"])))).alias("ids"))
    for i, n in enumerate(dated):
        text = isinstance(df.schema[n].dataType, T.StringType)
        offset = F.bool_and(c.col(n).rlike(OFFSET)) if text else F.lit(isinstance(df.schema[n].dataType, T.TimestampType))
        out.append(F.coalesce(offset, F.lit(False)).alias(f"offset_{i}"))
        out += dates.order_counts(c.col(n), f"{i}") if text else []
    return out


def _tasks(by_file: dict[str, dict]) -> tuple[dict[str, tuple[int, int]], int]:
    """(first task and number of tasks by file, all tasks): a large file has as many as TASK_ROWS and TASK_BYTES ask for, small ones share one."""
    out, task, load = {}, 0, 0.0
    for name, r in by_file.items():
        own = max(r["rows"] / TASK_ROWS, r["bytes"] / TASK_BYTES)
        if load and load + own > 1:
            task, load = task + 1, 0.0
        parts = max(1, math.ceil(own))
        out[name] = task, parts
        task, load = (task + parts, 0.0) if parts > 1 else (task, load + own)
    return out, task + (load > 0)


def _clean_group(spark: SparkSession, kind: str, paths: dict[str, str], out_dir: str, run_time: datetime.datetime, counters: Counters) -> None:
    raw = _with_file(spark.read.parquet(*paths), paths)
    texts = [n for n in c.text_columns(raw) if n != FILE]
    size = sum((F.coalesce(F.octet_length(c.col(n)), F.lit(0)).cast("long") for n in texts), F.lit(0).cast("long"))
    dated = [n for n in (BM_DATES if kind == "BM" else (BV_DATE,)) if n in raw.columns]
    df = raw.withColumns({"_hits": sum((encoding_hits(c.col(n)) for n in texts), F.lit(0)), "_bytes": size})
    if kind == "BM" and "answers" in raw.columns:
        df = written_once(spread(df, "_chunk").withColumns({"_outcome": json_outcome(fix_encoding(F.col("answers"))), "_items": answers.items(F.col("answers"))}), "files")
    by_file = {r[FILE]: r.asDict() for r in df.groupBy(FILE).agg(*_counts(df, texts, dated)).collect()}
    for r in by_file.values():
        counters.encoding_fixed += r["encoding_fixed"]
        counters.json_fixed += r.get("json_fixed", 0)
        counters.json_corrupted += r.get("json_corrupted", 0)
        counters.timezone_fixed += sum(r[f"offset_{i}"] for i in range(len(dated)))
    rows = sum(r["rows"] for r in by_file.values())
    if kind == "BM":
        counters.bm_processed += rows
    else:
        counters.bv_processed += rows

    # what differs from file to file: whether the answers or the raw column make the score, how dates are read, and which tasks write
    tasks, all_tasks = _tasks(by_file)
    told = [(name, *tasks[name], "nps_rate_recomendation" in (r.get("ids") or ()), [_FORMATS.index(dates.formats_from(r, f"{i}")) if f"{i}/month" in r else 0 for i in range(len(dated))]) for name, r in by_file.items()]
    df = df.join(F.broadcast(spark.createDataFrame(told, f"{FILE} string, _first int, _parts int, _answered boolean, _orders array<int>")), FILE)
    used = [sorted({t[-1][i] for t in told}) for i in range(len(dated))]
    read = {n: F.coalesce(*(F.when(F.element_at("_orders", i + 1) == k, dates.to_wall_clock(c.col(n), _FORMATS[k])) for k in used[i])) for i, n in enumerate(dated) if used[i]}
    if kind == "BM":
        df = df.withColumns(read)
        ids = answers.in_order({x for r in by_file.values() for x in r.get("ids") or ()})
        cleaned = clean_bm(df, run_time, ids, {}, parsed="_items" if "_items" in df.columns else None, answered=F.col("_answered"))
    else:
        cleaned = clean_bv(df, run_time, {}, read.get(BV_DATE))
    dealt = cleaned.drop("_hits", "_bytes", "_outcome", "_items", "_answered", "_orders").withColumn("_task", (F.col("_first") + F.pmod("_chunk", "_parts")).cast("int"))
    dealt.repartitionById(max(1, all_tasks), "_task").drop("_task", "_first", "_parts", "_chunk").write.mode("append").partitionBy(FILE).parquet(out_dir)


def clean_together(spark: SparkSession, paths: list[str] | str, out_dir: str, run_time: datetime.datetime) -> tuple[Counters, list[str]]:
    """runs.clean_files() for very many Parquet files: jobs are as many as kinds and schemas there are, not as files.

    Each file gets its folder, `file=<stem>_LIMPIO`, in out_dir, which must not hold any yet. What clean_files() decides
    file by file is decided by file here too: the column that makes the score, the order of day and month of a date
    column, and all counters. But files of one schema have the columns of all questions that occur in any of them.
    Files that can't be read, or have neither kind in their name, are logged and counted as errors; files without rows
    get no folder. A group that fails as a whole counts as an error for each of its files.
    """
    counters = Counters()
    all_paths = list_files(spark, paths) if isinstance(paths, str) else list(paths)
    routed: dict[str, str] = {}
    for p in all_paths:
        try:
            routed[p] = kind_of(PurePosixPath(p).name)
        except ValueError as e:
            log.error("could not clean %s: %s", p, e)
            counters.errors += 1
    found, wrong = schemas_of(spark, list(routed))
    for p, why in wrong.items():
        log.error("could not clean %s: %s", p, why)
        counters.errors += 1
    names, groups = _names(all_paths), defaultdict(dict)
    for p, schema in found.items():
        groups[routed[p], schema][p] = names[p]
    written: list[str] = []
    for (kind, _), group in sorted(groups.items()):
        try:
            _clean_group(spark, kind, group, out_dir, run_time, counters)
            written += list(group.values())
        except Exception:  # a run goes on with the next group, whatever is wrong with this one
            log.exception("could not clean %s", sorted(group))
            counters.errors += len(group)
    there = {s.rpartition("=")[2] for s in list_files(spark, f"{out_dir}/{FILE}=*")}
    return counters, [f"{out_dir}/{FILE}={n}" for n in sorted(written) if n in there]
