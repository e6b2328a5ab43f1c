"""Runs over files: sample, clean, load, verify."""

from __future__ import annotations

import datetime
import logging
from collections.abc import Callable
from dataclasses import dataclass, field
from pathlib import PurePosixPath

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..functions import dates, text
from ..functions.encoding import encoding_hits, fix_encoding
from ..functions.jsonrepair import json_outcome
from ..functions.scores import CATEGORIES
from ..operators import aggregate, profile
from ..operators import columns as c
from ..operators.sampling import SIZE, cleaned_name, exact_sample, sample_name
from ..sources import sinks, workbooks
from ..sources.runfolders import RunFolders
from ..sources.scratch import spread
from .cleaning import BM_DATES, BV_DATE, Counters, clean_file, kind_of

log = logging.getLogger("sondeo")

# What loaded tables are called and which columns they keep.
BM_TABLE, BV_TABLE = "banco_movil_clean", "banco_virtual_clean"
BM_KEPT = ("timestamp", "customer_id", "channel", "nps_recomendacion_score", "nps_recomendacion_motivo", "csat_satisfaccion_score", "csat_satisfaccion_motivo", "nps_score", "nps_category", "cleaned_date", "file_type", "month_year")
BV_KEPT = ("date_submitted", "country", "source_url", "device", "browser", "operating_system", "nps_score_bv", "nps_score", "nps_category", "cleaned_date", "file_type", "month_year")
BV_KEPT_PARTS = ("calificación", "motivo", "tags", "sentiment")
# Parts of names that make a column worth a look, and of those of dates.
KEY_PARTS = ("answer", "nps", "score", "timestamp", "date")
DATE_PARTS = ("date", "time", "fecha")
#: Rows of a smoke load that is given none: (customer, score, channel).
SMOKE_ROWS = (("first", 4, "branch"), ("second", 9, "branch"), ("third", None, "phone"))


#: An offset at the end of a date's text.
OFFSET = r"\d[ ]?(Z|[+-]\d{2}:?\d{2})$"


def metrics_of(df: DataFrame) -> list[Column]:
    """What a cleaning run counts over raw rows: rows, encoding rules that hit (answer lists too, as raw texts), answers repaired and beyond repair, date columns with offsets in all of their values."""
    hits = sum((encoding_hits(c.col(n)) for n in c.text_columns(df)), F.lit(0))
    outcome = json_outcome(fix_encoding(F.col("answers"))) if "answers" in df.columns else F.lit(None).cast("string")
    kinds = dict(df.dtypes)
    dated = [n for n in (*BM_DATES, BV_DATE) if n in kinds]
    offsets = [F.coalesce(F.bool_and(c.col(n).rlike(OFFSET)) if kinds[n] == "string" else F.lit(kinds[n] == "timestamp"), F.lit(False)).cast("int") for n in dated]
    return [
        F.count(F.lit(1)).alias("rows"),
        F.coalesce(F.sum(hits), F.lit(0)).cast("long").alias("encoding_fixed"),
        F.count(F.when(outcome == "fixed", 1)).alias("json_fixed"),
        F.count(F.when(outcome == "corrupted", 1)).alias("json_corrupted"),
        sum(offsets, F.lit(0)).alias("timezone_fixed"),
    ]


def _path(spark: SparkSession, path: str):
    found = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
    return found, found.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())


def list_files(spark: SparkSession, pattern: str) -> list[str]:
    """Paths that match a glob, of any store that Spark reads, by name; none if its folder is not there."""
    path, fs = _path(spark, pattern)
    return sorted(str(s.getPath()) for s in (fs.globStatus(path) or []))


def existing(spark: SparkSession, paths: list[str], missing: str = "skip") -> list[str]:
    """The paths that are there. For the others the workbooks in their folder are logged; missing="abort" then raises instead of going on."""
    if missing not in ("skip", "abort"):
        raise ValueError(f"missing is skip or abort, not {missing!r}")
    found = []
    for p in paths:
        path, fs = _path(spark, p)
        if fs.exists(path):
            found.append(p)
            continue
        folder = p.rpartition("/")[0] or "."
        log.error("not found: %s; workbooks in its folder: %s", p, [x.rpartition("/")[2] for x in list_files(spark, f"{folder}/*.xls*")])
        if missing == "abort":
            raise FileNotFoundError(p)
    return found


def log_to_file(path: str, level: int = logging.INFO) -> logging.Handler:
    """From now on what the library logs goes to a file of the driver's machine too, in UTF-8."""
    handler = logging.FileHandler(path, encoding="utf-8")
    handler.setFormatter(logging.Formatter("%(asctime)s - %(levelname)s - %(message)s"))
    log.addHandler(handler)
    log.setLevel(min(level, log.level or level))
    return handler


def _save(df: DataFrame, path: str, form: str) -> str:
    """Writes df as a folder of Parquet files, or as a workbook, and returns its path."""
    if form == "workbook":
        workbooks.register(df.sparkSession)
        path = f"{path}.xlsx"
    elif form != "parquet":
        raise ValueError(f"a form is parquet or workbook, not {form!r}")
    df.write.mode("overwrite").format(form).save(path)
    return path


def clean_files(spark: SparkSession, paths: list[str] | str, out_dir: str, run_time: datetime.datetime, read: Callable[[SparkSession, str], DataFrame] | None = None, form: str = "parquet") -> tuple[Counters, list[str]]:
    """Cleans each file (a list, or a glob) to a folder, or a workbook, of its own; one that fails is counted and the others go on. The summary is logged. For very many files see together.py."""
    counters, written = Counters(), []
    for path in list_files(spark, paths) if isinstance(paths, str) else paths:
        try:
            raw = spread(read(spark, path) if read else spark.read.parquet(path))  # below what is observed: above it, an empty shuffle would take the metrics away
            metrics = Observation()
            cleaned = clean_file(raw.observe(metrics, *metrics_of(raw)), PurePosixPath(path).name, run_time)
            target = _save(cleaned, f"{out_dir}/{cleaned_name(PurePosixPath(path).stem)}", form)
            found = metrics.get
            counters.encoding_fixed += found["encoding_fixed"]
            counters.json_fixed += found["json_fixed"]
            counters.json_corrupted += found["json_corrupted"]
            counters.timezone_fixed += found["timezone_fixed"]
            if kind_of(PurePosixPath(path).name) == "BM":
                counters.bm_processed += found["rows"]
            else:
                counters.bv_processed += found["rows"]
            written.append(target)
        except Exception:  # a run goes on with the next file, whatever is wrong with this one
            log.exception("could not clean %s", path)
            counters.errors += 1
    for line in counters.lines():
        log.info(line)
    return counters, written


def extract_sample(df: DataFrame, key: str, stem: str, out_dir: str, n: int = SIZE, form: str = "parquet") -> str:
    """Writes a sample of exactly n rows, or all, and returns its path, whose name tells its size. It is written once, under another name until it is whole."""
    metrics = Observation()
    partial = _save(exact_sample(df, key, n).observe(metrics, F.count(F.lit(1)).alias("n")), f"{out_dir}/_{stem}", form)
    target = f"{out_dir}/{sample_name(stem, metrics.get['n'])}{partial.removeprefix(f'{out_dir}/_{stem}')}"
    (made, fs), (path, _) = _path(df.sparkSession, partial), _path(df.sparkSession, target)
    fs.delete(path, True)
    if not fs.rename(made, path):
        raise OSError(f"could not rename {partial}")
    return target


def extraction_summary(samples: list[tuple[str, str, int]]) -> list[str]:
    """Lines for a log of what was taken: of (file, sample, rows)."""
    return [f"{a.rpartition('/')[2]} -> {b.rpartition('/')[2]} ({n:,} rows)" for a, b, n in samples] or ["no samples were taken"]


def describe(df: DataFrame) -> dict:
    """Profile of a cleaned or raw table: its size, key columns, statistics of scores, categories, dates. Two passes over the rows (profile.one_pass()); heads are of a few rows."""
    numeric = [n for n in df.columns if "nps" in n.lower() or "recomien" in n.lower() or n.startswith("csat_")]
    tops = [n for n in ("nps_category", "country", "device") if n in df.columns]
    ranges = ["date_submitted"] if "date_submitted" in df.columns else []
    found = profile.one_pass(df, numeric, tops, ranges, k=len(CATEGORIES))
    out: dict = {"rows": found["rows"], "columns": len(df.columns), "key_columns": c.with_any(df.columns, KEY_PARTS)}
    out["stats"] = [{"column": n, **x} for n, x in found["stats"].items()]
    for n, values in found["tops"].items():
        out["categories" if n == "nps_category" else f"top_{n}"] = dict(values) if n == "nps_category" else values[:3]
    if ranges:
        out["dates"] = found["ranges"]["date_submitted"]
    out["date_columns"] = c.with_any(df.columns, DATE_PARTS)
    shown = c.keep(df, out["key_columns"] or df.columns)
    out["head"] = [r.asDict() for r in shown.limit(3).collect()]
    if "answers" in df.columns:
        out["answers"] = [r.asDict() for r in first_answers(df).collect()]
    return out


def report(found: dict) -> list[str]:
    """A profile as lines for a log: counts with thousands apart, means with two digits."""
    lines = [f"{found['rows']:,} rows, {found['columns']} columns"]
    for x in found["stats"]:
        if x["n"]:
            lines.append(f"{x['column']}: {x['n']:,} values, mean {x['mean']:.2f}, from {x['least']:.1f} to {x['greatest']:.1f}")
    for name in ("categories", "top_country", "top_device"):
        values = found.get(name) or {}
        if values:
            lines.append(f"{name}: " + ", ".join(f"{v} {n:,}" for v, n in (values.items() if isinstance(values, dict) else values)))
    if found.get("dates") and found["dates"][0] is not None:
        lines.append(f"dates: {found['dates'][0]} to {found['dates'][1]}")
    return lines


def first_answers(df: DataFrame, k: int = 3, shown: int = 150) -> DataFrame:
    """Of the first k answer lists that are not null the beginning and what is wrong with them: a report, not a sample to work on."""
    rows = df.where(F.col("answers").isNotNull()).limit(k)
    return rows.select(F.substring("answers", 1, shown).alias("text"), *(x.alias(n) for n, x in profile.text_flags(F.col("answers")).items()))


def for_load(df: DataFrame, kind: str) -> DataFrame:
    """The columns that a loaded table keeps, placeholders of missing values as nulls, dates as timestamps."""
    wanted = BM_KEPT if kind == "BM" else (*BV_KEPT, *c.with_any(df.columns, BV_KEPT_PARTS))
    df = c.drop_blank_rows(c.keep(df, wanted))
    df = c.map_columns(df, c.text_columns(df), text.na_to_null)
    return c.map_columns(df, [n for n in ("timestamp", "date_submitted", "cleaned_date") if n in df.columns], dates.to_wall_clock)


def load(bm: DataFrame, bv: DataFrame, target: sinks.Target) -> dict[str, int]:
    """BM is appended, BV replaces its table; then both are counted. Neither step undoes the other."""
    target.append(for_load(bm, "BM"), BM_TABLE)
    target.replace(for_load(bv, "BV"), BV_TABLE)
    return {name: target.read(name).count() for name in (BM_TABLE, BV_TABLE)}


def load_once(bm: DataFrame, bv: DataFrame, target: sinks.Jdbc | RunFolders, run_id: str) -> dict[str, int]:
    """load(), all or nothing and at most once a run_id: BM is added to its table and BV replaces its own in one step.

    A load that was stopped has changed nothing and may be run again with its run_id; one that is done is not repeated.
    Returns the rows of both tables as they are then.
    """
    target.publish(run_id, [sinks.Write(BM_TABLE, for_load(bm, "BM")), sinks.Write(BV_TABLE, for_load(bv, "BV"), replace=True)])
    return {name: target.read(name).count() for name in (BM_TABLE, BV_TABLE)}


@dataclass
class Summary:
    """What a load did. Rows are those that were written, not those of the tables."""

    bm_inserted: int = 0
    bv_inserted: int = 0
    errors: int = 0
    tables: dict[str, int] = field(default_factory=dict)
    started: datetime.datetime | None = None
    ended: datetime.datetime | None = None

    @property
    def inserted(self) -> int:
        return self.bm_inserted + self.bv_inserted

    @property
    def valid(self) -> bool:
        """Without errors the run may go on to larger files."""
        return self.errors == 0

    def lines(self) -> list[str]:
        verdict = "valid: ready for larger files" if self.valid else "see to the errors before larger files"
        return [f"BM rows: {self.bm_inserted}", f"BV rows: {self.bv_inserted}", f"rows: {self.inserted}", f"errors: {self.errors}", f"time: {self.ended - self.started if self.ended and self.started else None}", verdict]


def load_files(spark: SparkSession, bm_path: str, bv_path: str, target: sinks.Target, read: Callable[[SparkSession, str], DataFrame] | None = None) -> Summary:
    """A whole load: both files must be there and the target must answer, or nothing is written; then each file is loaded, counted as it is written, and one that fails leaves the other in place. Logs rows to look at and the summary."""
    summary = Summary(started=datetime.datetime.now())
    existing(spark, [bm_path, bv_path], "abort")
    version = sinks.connected(target)
    if version is None:
        raise ConnectionError("the target does not answer")
    log.info("connected: %s", version)
    for kind, path, write, table in (("BM", bm_path, target.append, BM_TABLE), ("BV", bv_path, target.replace, BV_TABLE)):
        try:
            metrics = Observation()
            write(for_load(read(spark, path) if read else spark.read.parquet(path), kind).observe(metrics, F.count(F.lit(1)).alias("rows")), table)
            setattr(summary, f"{kind.lower()}_inserted", metrics.get["rows"])
        except Exception:  # a load goes on with the other file, whatever is wrong with this one
            log.exception("could not load %s", path)
            summary.errors += 1
    if summary.valid:
        summary.tables = {name: target.read(name).count() for name in (BM_TABLE, BV_TABLE)}
        for name, rows in summary.tables.items():
            log.info("%s: %s rows in the table", name, f"{rows:,}")
        if summary.tables[BV_TABLE] != summary.bv_inserted or summary.tables[BM_TABLE] < summary.bm_inserted:
            log.error("the tables do not hold what was written: %s", summary.tables)
            summary.errors += 1
        for name, rows in verify(target).items():
            log.info("%s: %s", name, rows)
    summary.ended = datetime.datetime.now()
    for line in summary.lines():
        log.info(line)
    return summary


def smoke_load(spark: SparkSession, target: sinks.Target, table: str, now: datetime.datetime, rows: DataFrame | None = None) -> DataFrame:
    """Rows (three of our own, if none are given) written to a table, read back and scored by channel: tells that a target works."""
    if rows is None:
        rows = spark.createDataFrame([(now, *r, "2024-08") for r in SMOKE_ROWS], "timestamp timestamp_ntz, customer_id string, nps_score int, channel string, month_year string")
    target.replace(rows, table)
    return aggregate.score_by(target.read(table), "channel")


def verify(target: sinks.Target, k: int = 3) -> dict[str, list]:
    """A few scored rows of each table."""
    shown = {BM_TABLE: ("nps_score", "nps_category", "nps_recomendacion_score"), BV_TABLE: ("nps_score", "device", "country")}
    return {name: scored_rows(target.read(name), cols, k).collect() for name, cols in shown.items()}


def scored_rows(df: DataFrame, cols: tuple[str, ...], k: int = 3) -> DataFrame:
    return c.keep(df.where("nps_score is not null"), cols).limit(k)
