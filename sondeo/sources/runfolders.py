"""Parquet tables whose loads are published by one record a run: all of its tables or none."""

from __future__ import annotations

import json
import logging
import uuid
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.reconcile import in_groups, sums_of
from .sinks import Write, counted

log = logging.getLogger("sondeo")


@dataclass
class RunFolders:
    """Tables under a folder of any store that Spark reads. Each run writes folders of its own; a table is what the records of runs name.

    A record is one file that appears whole, by a rename, after all folders are written. A run that was stopped before
    has none, so nothing of it is ever read, and it may be run again; one that has a record is not run again. Runs are
    published one after the other.
    """

    spark: SparkSession
    root: str

    def _path(self, name: str):
        path = self.spark.sparkContext._jvm.org.apache.hadoop.fs.Path(f"{self.root}/{name}")
        return path, path.getFileSystem(self.spark.sparkContext._jsc.hadoopConfiguration())

    def records(self) -> list[dict]:
        """What was published, first run first: run, tables (name, folder, replace, rows, checksum)."""
        pattern, fs = self._path("_runs/*.json")
        names = sorted(s.getPath().toString() for s in fs.globStatus(pattern) or ())
        if not names:
            return []
        texts = self.spark.read.text(names, wholetext=True).select(F.col("_metadata.file_name").alias("name"), "value").collect()
        return [json.loads(r["value"]) for r in sorted(texts, key=lambda r: r["name"])]

    def runs(self) -> dict[str, list[tuple[str, int, int]]]:
        return {r["run"]: [(t["name"], t["rows"], t["checksum"]) for t in r["tables"]] for r in self.records()}

    def publish(self, run_id: str, writes: Sequence[Write]) -> bool:
        """All tables of a run, once: False if the run is published already, and nothing is done."""
        records = self.records()
        if any(r["run"] == run_id for r in records):
            log.info("run %s is loaded already", run_id)
            return False
        tables = []
        for w in writes:
            folder = f"{w.table}/{uuid.uuid4().hex}"
            df, metrics = counted(w.df)
            df.write.parquet(f"{self.root}/{folder}")
            tables.append({"name": w.table, "folder": folder, "replace": w.replace, "rows": metrics.get["rows"], "checksum": metrics.get["checksum"]})
        self._record(len(records), {"run": run_id, "tables": tables})
        return True

    def _record(self, number: int, record: dict) -> None:
        path, fs = self._path(f"_runs/{number:08}.json")
        partial, _ = self._path(f"_runs/_{uuid.uuid4().hex}")
        out = fs.create(partial)
        out.write(json.dumps(record).encode())
        out.close()
        if fs.exists(path) or not fs.rename(partial, path):
            raise RuntimeError(f"another run was published meanwhile: {path.toString()}")

    def folders(self, table: str) -> list[str]:
        """The folders that make up a table now."""
        out: list[str] = []
        for t in (t for r in self.records() for t in r["tables"] if t["name"] == table):
            out = [*([] if t["replace"] else out), f"{self.root}/{t['folder']}"]
        return out

    def read(self, table: str) -> DataFrame:
        """The table; columns that only some runs have are null for the others."""
        found = self.folders(table)
        if not found:
            raise ValueError(f"no run has loaded {table}")
        return self.spark.read.option("mergeSchema", "true").parquet(*found)

    def query(self, sql: str) -> DataFrame:
        """SQL over all tables, by their names."""
        for name in dict.fromkeys(t["name"] for r in self.records() for t in r["tables"]):
            self.read(name).createOrReplaceTempView(name)
        return self.spark.sql(sql)

    def sums(self, table: str, groups: Sequence[str], measured: Sequence[tuple[str, str, str]]) -> DataFrame:
        return sums_of(self.read(table), groups, measured)

    def members(self, table: str, groups: Sequence[str], values: Sequence[Sequence]) -> DataFrame:
        return self.read(table).where(in_groups(groups, values))

    def clean(self) -> int:
        """Deletes the folders that no table is made of any more or never was: of stopped runs, and of replaced tables. Returns how many; not while a run is being published."""
        tables = {t["name"] for r in self.records() for t in r["tables"]}
        live = {f for name in tables for f in self.folders(name)}
        pattern, fs = self._path("[!_]*/*")
        gone = [s.getPath() for s in fs.globStatus(pattern) or () if not any(s.getPath().toString().endswith(f.removeprefix(self.root)) for f in live)]
        for path in gone:
            fs.delete(path, True)
        return len(gone)

    def version(self) -> str:
        return self.spark.range(1).select(F.version()).head()[0]
