"""Tables as targets: of the warehouse, or of a database over JDBC."""

from __future__ import annotations

import logging
import math
import os
from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Any, Protocol

from py4j.protocol import Py4JJavaError
from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.columns import col
from ..operators.reconcile import in_groups, sums_of

log = logging.getLogger("sondeo")

#: Rows of one INSERT, and connections of one write or read.
BATCH_ROWS, CONNECTIONS = 1000, 8
#: How long a connection may take to say that it still answers.
PING_SECONDS = 5
#: Values of a text column, at most, by which a read is dealt to connections.
MOST_VALUES = 500
#: Where a database keeps which runs it has loaded.
LOADS = "sondeo_loads"
# Columns of the loaded tables that are looked up, and so have indexes.
INDEXED = {"banco_movil_clean": ("nps_score", "nps_category", "month_year"), "banco_virtual_clean": ("nps_score", "device", "country")}
#: Columns with a bloom filter for each row group where their values are too many for a dictionary.
LOOKED_UP = ("nps_category", "device", "country", "customer_id")


class Target(Protocol):
    def append(self, df: DataFrame, table: str) -> None: ...
    def replace(self, df: DataFrame, table: str) -> None: ...
    def read(self, table: str) -> DataFrame: ...
    def query(self, sql: str) -> DataFrame: ...
    def sums(self, table: str, groups: Sequence[str], measured: Sequence[tuple[str, str, str]]) -> DataFrame: ...
    def members(self, table: str, groups: Sequence[str], values: Sequence[Sequence]) -> DataFrame: ...
    def drop(self, table: str) -> None: ...
    def version(self) -> str: ...


@dataclass
class Write:
    """One table of a load: rows are added to it (append) or take the place of all it has (replace)."""

    table: str
    df: DataFrame
    replace: bool = False


def counted(df: DataFrame) -> tuple[DataFrame, Observation]:
    """df with rows and checksum observed as it is written: the checksum is the same in any order of rows."""
    metrics = Observation()
    return df.observe(metrics, F.count(F.lit(1)).alias("rows"), checksum(df).alias("checksum")), metrics


def checksum(df: DataFrame) -> Column:
    """Of all rows, the sum of their hashes in a decimal that no number of rows overflows, folded to 63 bits. Equal for equal rows in any order."""
    total = F.sum(F.xxhash64(*(col(n) for n in df.columns)).cast("decimal(28,0)"))
    return F.coalesce((total % F.lit(2**63 - 1).cast("decimal(38,0)")).cast("long"), F.lit(0).cast("long"))


@dataclass
class Warehouse:
    """Parquet tables. Rows are sorted within files by month and score, so that row groups can be skipped.

    partition_by: columns (of those that a table has) whose values get folders of their own, such as month_year; a query
    for a month then reads its folder only. It must stay the same for all writes to a table. Rows meet by these columns
    in a rebalance, which adaptive execution splits where a value has more than its advisory partition size: a hot month
    is written by several tasks, to several files. looked_up: columns with bloom filters.
    """

    spark: SparkSession
    partition_by: tuple[str, ...] = ()
    looked_up: tuple[str, ...] = LOOKED_UP

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        parts = [n for n in self.partition_by if n in df.columns]
        order = parts + [n for n in ("month_year", "nps_score") if n in df.columns and n not in parts]
        if parts:
            df = df.hint("rebalance", *parts)
        writer = (df.sortWithinPartitions(*order) if order else df).write.mode(mode).format("parquet")
        for n in self.looked_up:
            if n in df.columns and n not in parts:
                writer = writer.option(f"parquet.bloom.filter.enabled#{n}", "true")
        (writer.partitionBy(*parts) if parts else writer).saveAsTable(table)

    def append(self, df: DataFrame, table: str) -> None:
        self._write(df, table, "append")

    def replace(self, df: DataFrame, table: str) -> None:
        self._write(df, table, "overwrite")

    def read(self, table: str) -> DataFrame:
        return self.spark.table(table)

    def query(self, sql: str) -> DataFrame:
        return self.spark.sql(sql)

    def sums(self, table: str, groups: Sequence[str], measured: Sequence[tuple[str, str, str]]) -> DataFrame:
        """The measures of reconcile.measures() by group."""
        return sums_of(self.read(table), groups, measured)

    def members(self, table: str, groups: Sequence[str], values: Sequence[Sequence]) -> DataFrame:
        """The rows of some groups, each a value per column."""
        return self.read(table).where(in_groups(groups, values))

    def drop(self, table: str) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {table}")

    def version(self) -> str:
        return self.spark.range(1).select(F.version()).head()[0]


@dataclass
class Jdbc:
    """Tables of a database; address and user come from the environment unless they are given."""

    spark: SparkSession
    url: str = field(default_factory=lambda: os.environ.get("SONDEO_JDBC_URL", ""))
    options: dict[str, str] = field(default_factory=lambda: {k: v for k, v in (("user", os.environ.get("SONDEO_JDBC_USER")), ("password", os.environ.get("SONDEO_JDBC_PASSWORD")), ("driver", os.environ.get("SONDEO_JDBC_DRIVER"))) if v})

    _connection: Any = field(default=None, init=False, repr=False, compare=False)

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        """CONNECTIONS tasks write; what makes the rows keeps its own partitions."""
        df.repartition(CONNECTIONS).write.jdbc(self.url, table, mode=mode, properties={"batchsize": str(BATCH_ROWS), **self.options})

    def append(self, df: DataFrame, table: str) -> None:
        self._write(df, table, "append")

    def replace(self, df: DataFrame, table: str) -> None:
        self._write(df, table, "overwrite")

    def read(self, table: str, by: str | None = None, parts: int = CONNECTIONS) -> DataFrame:
        """The table over one connection, or, dealt by a column, over `parts` of them: ranges of a number, date or timestamp, whose ends one query asks for, or groups of a text's values. Rows without a value are in one of the parts."""
        whole = self.spark.read.jdbc(self.url, table, properties=self.options)
        if by is None:
            return whole
        if isinstance(whole.schema[by].dataType, T.StringType):
            start = f'CAST("{by}" AS VARCHAR(255))'  # not every database compares texts of any length
            found = [r[0] for r in self.query(f"SELECT DISTINCT {start} AS v FROM {table}").limit(MOST_VALUES + 1).collect()]
            if len(found) > MOST_VALUES:
                raise ValueError(f"more than {MOST_VALUES} values of {by}: a read can't be dealt by it")
            texts = ["'" + x.replace("'", "''") + "'" for x in sorted(x for x in found if x is not None)]
            groups = [f"{start} IN ({', '.join(texts[i::parts])})" for i in range(min(parts, len(texts)))]
            return self.spark.read.jdbc(self.url, table, predicates=[*groups, f'"{by}" IS NULL'], properties=self.options)
        low, high = self.query(f'SELECT min("{by}") AS low, max("{by}") AS high FROM {table}').head()
        if low is None:
            return whole
        if not isinstance(whole.schema[by].dataType, (T.DateType, T.TimestampType, T.TimestampNTZType)):
            low, high = math.floor(low), math.ceil(high)
        dealt = {"partitionColumn": by, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(parts)}
        return self.spark.read.format("jdbc").options(url=self.url, dbtable=table, **dealt, **self.options).load()

    def sums(self, table: str, groups: Sequence[str], measured: Sequence[tuple[str, str, str]]) -> DataFrame:
        """The measures of reconcile.measures() by group, added up by the database."""
        by = self._comparable(table, groups)
        of = {"count": lambda n: f'COUNT("{n}")' if n else "COUNT(*)", "sum": lambda n: f'SUM("{n}")', "length": lambda n: f'SUM(CAST(LENGTH("{n}") AS BIGINT))'}
        listed = [*(f'{x} AS "{g}"' for g, x in by.items()), *(f'{of[f](n)} AS "{name}"' for name, f, n in measured)]
        found = self.query(f"SELECT {', '.join(listed)} FROM {table} GROUP BY {', '.join(by.values())}")
        return found.withColumns({name: F.round(name, 4) for name, f, _ in measured if f == "sum"})

    def _comparable(self, table: str, names: Sequence[str]) -> dict[str, str]:
        """What stands for each column where values are compared: not every database compares texts of any length."""
        kinds = self._columns(table)
        return {n: f'CAST("{n}" AS VARCHAR(255))' if any(x in kinds[n] for x in ("CHAR", "LOB", "TEXT")) else f'"{n}"' for n in names}

    def members(self, table: str, groups: Sequence[str], values: Sequence[Sequence]) -> DataFrame:
        """The rows of some groups, each a value per column, found by the database and dealt to connections."""
        by = self._comparable(table, groups)
        literal = lambda v: "'" + v.replace("'", "''") + "'" if isinstance(v, str) else repr(v) if isinstance(v, (int, float)) else f"'{v}'"
        one = lambda own: " AND ".join(f"{by[g]} IS NULL" if v is None else f"{by[g]} = {literal(v)}" for g, v in zip(groups, own, strict=True))
        tests = [f"({one(v)})" for v in values]
        dealt = [" OR ".join(tests[i::CONNECTIONS]) for i in range(min(CONNECTIONS, len(tests)))]
        return self.spark.read.jdbc(self.url, table, predicates=dealt or ["1 = 0"], properties=self.options)

    def _columns(self, table: str) -> dict[str, str]:
        """Names and types of the columns, in order; none if there is no such table."""

        def ask(c):
            for name in (table, table.upper(), table.lower()):
                rows, found = c.getMetaData().getColumns(None, None, name, None), {}
                while rows.next():
                    found[rows.getString("COLUMN_NAME")] = rows.getString("TYPE_NAME").upper()
                if found:
                    return found
            return {}

        return self._statement(ask)

    def names(self, table: str) -> list[str] | None:
        """The columns of a table, None if there is none."""
        return list(self._columns(table)) or None

    def create_indexes(self, tables: Sequence[str] = tuple(INDEXED)) -> list[str]:
        """Indexes of the looked-up columns that the tables have, made where they are missing; the names of the new ones. Large objects, as which some databases keep texts, have none."""

        def make(c):
            made = []
            for table in tables:
                there = set()
                for name in (table, table.upper()):
                    rows = c.getMetaData().getIndexInfo(None, None, name, False, False)
                    while rows.next():
                        there.add((rows.getString("INDEX_NAME") or "").lower())
                kinds = self._columns(table)
                for column in (n for n in INDEXED[table] if "LOB" not in kinds.get(n, "LOB")):
                    name = f"idx_{'bm' if 'movil' in table else 'bv'}_{column}"
                    if name not in there:
                        c.createStatement().execute(f'CREATE INDEX {name} ON {table}("{column}")')
                        made.append(name)
            return made

        return self._statement(make)

    def runs(self) -> dict[str, list[tuple[str, int, int]]]:
        """What each run that came through publish() loaded: table, rows, checksum."""
        out: dict[str, list[tuple[str, int, int]]] = {}
        for r in self.read(LOADS).collect() if self.names(LOADS) else ():
            out.setdefault(r["run_id"], []).append((r["table_name"], r["row_count"], r["row_checksum"]))
        return out

    def publish(self, run_id: str, writes: Sequence[Write]) -> bool:
        """All tables of a run in one transaction, once: False if the run is loaded already, and nothing is done.

        Rows go to staging tables first, over several connections, and are counted as they go; what the staging tables
        hold must agree. Then one transaction moves them and records the run. A load that is stopped anywhere before its
        end changes no table, and may be run again. A replaced table whose columns differ is dropped and the staging
        table takes its name.
        """
        if self.names(LOADS) is None:
            self._statement(lambda c: c.createStatement().execute(f'CREATE TABLE {LOADS} ("run_id" VARCHAR(200) NOT NULL, "table_name" VARCHAR(200) NOT NULL, "row_count" BIGINT, "row_checksum" BIGINT, PRIMARY KEY ("run_id", "table_name"))'))
        if run_id in self.runs():
            log.info("run %s is loaded already", run_id)
            return False
        staged = []
        for w in writes:
            stage = f"{w.table}_stage"
            df, metrics = counted(w.df)
            self.replace(df, stage)
            rows, total = metrics.get["rows"], metrics.get["checksum"]
            if (held := self.query(f"SELECT count(*) AS n FROM {stage}").head()[0]) != rows:
                raise RuntimeError(f"{stage} has {held} rows, {rows} were written")
            if not w.replace and self.names(w.table) is None:
                self._write(w.df.limit(0), w.table, "append")
            staged.append((w, stage, rows, total, list(w.df.columns), self.names(w.table)))
        product = self.version()

        def move(c):
            c.setAutoCommit(False)
            try:
                execute = lambda sql: c.createStatement().executeUpdate(sql)
                for w, stage, rows, total, own, there in staged:
                    if w.replace and there != own:
                        if there is not None:
                            execute(f"DROP TABLE {w.table}")
                        execute(f"RENAME TABLE {stage} TO {w.table}" if "Derby" in product else f"ALTER TABLE {stage} RENAME TO {w.table}")
                    else:
                        if w.replace:
                            execute(f"DELETE FROM {w.table}")
                        listed = ", ".join(f'"{n}"' for n in own)
                        execute(f"INSERT INTO {w.table} ({listed}) SELECT {listed} FROM {stage}")
                    line = c.prepareStatement(f"INSERT INTO {LOADS} VALUES (?, ?, ?, ?)")
                    line.setString(1, run_id)
                    line.setString(2, w.table)
                    line.setLong(3, rows)
                    line.setLong(4, total)
                    line.executeUpdate()
                c.commit()
            except Exception:
                c.rollback()
                raise
            finally:
                c.setAutoCommit(True)

        self._statement(move)
        for w, stage, *_ in staged:
            if self.names(stage) is not None:
                self.drop(stage)
        return True

    def _connect(self):
        jvm = self.spark.sparkContext._jvm
        if driver := self.options.get("driver"):
            jvm.org.apache.spark.sql.execution.datasources.jdbc.DriverRegistry.register(driver)
        properties = jvm.java.util.Properties()
        for k, v in self.options.items():
            properties.setProperty(k, v)
        return jvm.java.sql.DriverManager.getConnection(self.url, properties)

    def _statement(self, use):
        """use(connection). The driver's own statements share one connection, which is asked before each use whether it still answers and made anew if it doesn't; Spark's reads and writes have their own."""
        if self._connection is not None and not self._connection.isValid(PING_SECONDS):
            self.close()
        if self._connection is None:
            self._connection = self._connect()
        try:
            return use(self._connection)
        except Exception:
            self.close()
            raise

    def close(self) -> None:
        """Closes the shared connection; the next statement makes another."""
        held, self._connection = self._connection, None
        if held is not None:
            try:
                if not held.getAutoCommit():
                    held.rollback()
                held.close()
            except Py4JJavaError:  # it is broken already
                log.warning("a connection could not be closed")

    def drop(self, table: str) -> None:
        self._statement(lambda c: c.createStatement().execute(f"DROP TABLE {table}"))

    def version(self) -> str:
        """Name and version of the database, asked over a connection of its own."""
        return self._statement(lambda c: f"{c.getMetaData().getDatabaseProductName()} {c.getMetaData().getDatabaseProductVersion()}")

    def query(self, sql: str) -> DataFrame:
        return self.spark.read.format("jdbc").option("url", self.url).option("query", sql).options(**self.options).load()


# Declared columns of the loaded tables, for those who want them made before the first load.
DECLARED = {
    "banco_movil_clean": "timestamp TIMESTAMP_NTZ, customer_id STRING, channel STRING, nps_recomendacion_score STRING, nps_recomendacion_motivo STRING, csat_satisfaccion_score STRING, csat_satisfaccion_motivo STRING, nps_score DOUBLE, nps_category STRING, cleaned_date TIMESTAMP_NTZ, file_type STRING, month_year STRING",
    "banco_virtual_clean": "date_submitted TIMESTAMP_NTZ, country STRING, source_url STRING, device STRING, browser STRING, operating_system STRING, nps_score_bv STRING, nps_score DOUBLE, nps_category STRING, cleaned_date TIMESTAMP_NTZ, file_type STRING, month_year STRING",
}


def connected(target: Target, shown: int = 50) -> str | None:
    """The beginning of the target's version if it answers, else None; why not is logged."""
    try:
        return target.version()[:shown]
    except Exception:  # whatever keeps a connection from being made
        log.exception("no connection")
        return None


def declare_tables(spark: SparkSession) -> None:
    for name, cols in DECLARED.items():
        spark.sql(f"CREATE TABLE IF NOT EXISTS {name} ({cols}) USING parquet")
