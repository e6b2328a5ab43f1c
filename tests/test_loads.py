"""Loads that are all or nothing, tables that are dealt and skipped by their columns."""

import datetime
import json

import pytest
from pyspark.sql import functions as F

from sondeo.plans import cleaning, runs
from sondeo.sources import sinks
from sondeo.sources.runfolders import RunFolders

NOW = datetime.datetime(2025, 9, 1)


def derby(spark, name):
    return sinks.Jdbc(spark, f"jdbc:derby:memory:{name};create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})


@pytest.fixture(params=["folders", "jdbc"])
def target(request, spark, tmp_path):
    return RunFolders(spark, str(tmp_path / "runs")) if request.param == "folders" else derby(spark, f"once{tmp_path.name.replace('-', '')}{request.param}")


def frames(spark):
    bm = cleaning.clean_bm(spark.createDataFrame([("web", "8", "[]"), ("nan", "3", "[]")], "channel string, nps_score_original string, answers string"), NOW)
    bv = cleaning.clean_bv(spark.createDataFrame([("Perú",), (None,)], "Country string"), NOW).withColumn("nps_score", F.lit(9.0))
    return bm, bv


def contents(target):
    return {n: sorted(map(str, target.read(n).collect())) for n in (runs.BM_TABLE, runs.BV_TABLE)}


def test_a_run_loads_once(spark, target):
    bm, bv = frames(spark)
    assert runs.load_once(bm, bv, target, "august") == {runs.BM_TABLE: 2, runs.BV_TABLE: 2}
    before = contents(target)
    assert runs.load_once(bm.limit(0), bv.limit(0), target, "august") == {runs.BM_TABLE: 2, runs.BV_TABLE: 2} and contents(target) == before
    assert runs.load_once(bm, bv.limit(1), target, "it's september") == {runs.BM_TABLE: 4, runs.BV_TABLE: 1}
    assert {k: [(n, r) for n, r, _ in sorted(v)] for k, v in target.runs().items()} == {"august": [(runs.BM_TABLE, 2), (runs.BV_TABLE, 2)], "it's september": [(runs.BM_TABLE, 2), (runs.BV_TABLE, 1)]}
    wider = bv.withColumn("tags", F.lit("x"))
    assert runs.load_once(bm, wider, target, "october") == {runs.BM_TABLE: 6, runs.BV_TABLE: 2}
    assert {r.tags for r in target.read(runs.BV_TABLE).collect()} == {"x"}


def test_a_run_that_fails_between_its_tables_changes_none(spark, target):
    bm, bv = frames(spark)
    broken = bv.withColumn("nps_score", F.when(F.col("country").isNull(), F.raise_error(F.lit("stopped"))).otherwise(9.0))
    with pytest.raises(Exception, match="stopped"):
        runs.load_once(bm, broken, target, "first")
    assert target.runs() == {}
    runs.load_once(bm, bv, target, "first")
    before = contents(target)
    with pytest.raises(Exception, match="stopped"):
        runs.load_once(bm, broken, target, "second")
    assert contents(target) == before and list(target.runs()) == ["first"]
    assert runs.load_once(bm, bv, target, "second") == {runs.BM_TABLE: 4, runs.BV_TABLE: 2}


def test_a_transaction_that_fails_at_its_second_table_is_undone(spark):
    target, (bm, bv) = derby(spark, "undone"), frames(spark)
    runs.load_once(bm, bv, target, "first")
    before = contents(target)
    made, given = target._statement, []

    def failing(use):
        given.append(use)
        if use.__name__ == "move":
            return made(lambda c: use(Failing(c)))
        return made(use)

    class Failing:
        """A connection that breaks at the record of the second table."""

        def __init__(self, real):
            self.real, self.lines = real, 0

        def __getattr__(self, name):
            return getattr(self.real, name)

        def prepareStatement(self, sql):
            self.lines += 1
            if self.lines == 2:
                raise RuntimeError("connection lost")
            return self.real.prepareStatement(sql)

    target._statement = failing
    with pytest.raises(RuntimeError, match="lost"):
        runs.load_once(bm, bv.limit(1), target, "second")
    target._statement = made
    assert contents(target) == before and list(target.runs()) == ["first"]
    assert runs.load_once(bm, bv.limit(1), target, "second") == {runs.BM_TABLE: 4, runs.BV_TABLE: 1}


def test_folders_of_stopped_and_replaced_runs_can_be_cleaned(spark, tmp_path):
    target, (bm, bv) = RunFolders(spark, str(tmp_path / "runs")), frames(spark)
    assert target.records() == [] and target.clean() == 0
    with pytest.raises(ValueError):
        target.read(runs.BM_TABLE)
    runs.load_once(bm, bv, target, "a")
    bv.write.parquet(str(tmp_path / "runs" / runs.BV_TABLE / "stopped"))
    runs.load_once(bm, bv, target, "b")
    before = contents(target)
    assert target.clean() == 2 and contents(target) == before
    assert target.query(f"SELECT count(*) AS n FROM {runs.BM_TABLE}").head().n == 4
    with pytest.raises(RuntimeError, match="meanwhile"):
        target._record(1, {"run": "c", "tables": []})
    assert [json.loads(p.read_text())["run"] for p in sorted((tmp_path / "runs" / "_runs").glob("*.json"))] == ["a", "b"]


def test_checksums_tell_rows_apart_and_not_their_order(spark):
    df = spark.range(1000).selectExpr("id", "cast(id % 7 as string) as s")
    total = lambda x: x.agg(sinks.checksum(x).alias("c")).head().c
    assert total(df) == total(df.orderBy(F.desc("id")).repartition(5)) != total(df.where("id > 0").union(df.where("id = 1")))
    assert total(df.where("false")) == 0 and total(df.union(df)) != total(df)


def scanned(df):
    """Rows that the scan gave on, after whole row groups were skipped."""
    found = []

    def walk(p):
        if "FileScan" in p.nodeName() or "Scan parquet" in p.nodeName():
            found.append(p.metrics().apply("numOutputRows").value())
        for i in range(p.children().size()):
            walk(p.children().apply(i))

    plan = df._jdf.queryExecution().executedPlan()
    plan.executeCollect()
    walk(plan)
    return sum(found)


def test_a_hot_month_is_in_several_files_and_row_groups_are_skipped(spark):
    target = sinks.Warehouse(spark, ("month_year",))
    target.drop("hot_month")
    rows = spark.range(200_000).selectExpr("if(id % 20 = 0, '2025-07', '2025-08') as month_year", "cast(id % 11 as double) as nps_score", "concat('customer ', id * 7919 % 200003) as customer_id", "sha2(cast(id as string), 256) as filler")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    spark.conf.set("spark.hadoop.parquet.block.size", str(256 << 10))
    spark.sparkContext._jsc.hadoopConfiguration().set("parquet.block.size", str(256 << 10))
    try:
        target.append(rows, "hot_month")
    finally:
        spark.conf.unset("spark.sql.adaptive.advisoryPartitionSizeInBytes")
        spark.conf.unset("spark.hadoop.parquet.block.size")
        spark.sparkContext._jsc.hadoopConfiguration().unset("parquet.block.size")
    by_month = {}
    for f in target.read("hot_month").inputFiles():
        by_month.setdefault(f.split("month_year=")[1][:7], []).append(f)
    assert len(by_month["2025-08"]) >= 4 and target.read("hot_month").count() == 200_000
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        month = target.read("hot_month").where("month_year = '2025-08'")
        whole = scanned(month.select("customer_id", "nps_score"))
        by_score = scanned(month.where("nps_score = 10").select("customer_id", "nps_score"))
        present = month.select("customer_id").orderBy("customer_id").limit(1).head()[0]
        by_id = scanned(month.where(F.col("customer_id") == present).select("customer_id"))
        absent = scanned(month.where("customer_id = 'customer 1x'").select("customer_id"))
    finally:
        spark.conf.unset("spark.sql.adaptive.enabled")
    assert whole == 190_000 and by_score < whole / 3 and 0 < by_id < whole / 2 and absent < whole / 4
    target.drop("hot_month")


def test_jdbc_reads_are_dealt_and_writes_keep_their_makers_partitions(spark):
    target = derby(spark, "dealt")
    rows = spark.range(0, 5000, 1, 20).selectExpr("id", "cast(id % 11 as double) as nps_score", "if(id % 13 = 0, null, concat('it''s ', id % 5)) as country", "timestamp_ntz'2025-08-01 00:00:00' + make_dt_interval(0, 0, cast(id as int)) as at", "cast(null as int) as none")
    target.replace(rows, "dealt")
    for by, parts in (("id", 6), ("nps_score", 4), ("at", 5), ("country", 3)):
        back = target.read("dealt", by, parts)
        assert back.rdd.getNumPartitions() == parts + (by == "country")
        assert sorted(map(tuple, back.collect()), key=str) == sorted(map(tuple, rows.collect()), key=str)
        assert max(back.groupBy(F.spark_partition_id()).count().toPandas()["count"]) < 5000
    assert target.read("dealt", "none").count() == 5000
    with pytest.raises(ValueError):
        target.replace(rows.selectExpr("cast(id as string) as country"), "texts")
        target.read("texts", "country")


def test_indexes_are_made_once(spark):
    target, (bm, bv) = derby(spark, "indexed"), frames(spark)
    runs.load(bm, bv, target)
    assert target.create_indexes() == ["idx_bm_nps_score", "idx_bv_nps_score"]
    assert target.create_indexes() == []
    target._statement(lambda c: [c.createStatement().execute(x) for x in (f"DROP TABLE {runs.BV_TABLE}", f'CREATE TABLE {runs.BV_TABLE} ("country" VARCHAR(99), "device" VARCHAR(99))')])
    assert target.create_indexes() == ["idx_bv_device", "idx_bv_country"]


@pytest.mark.parametrize("kind", ["jdbc", "warehouse"])
def test_a_changed_row_is_named(spark, kind):
    from sondeo.operators import reconcile

    target = derby(spark, "reconciled") if kind == "jdbc" else sinks.Warehouse(spark)
    source = spark.range(400).selectExpr("id", "if(id % 50 = 0, null, concat('2025-', id % 5)) as month_year", "concat('c ', id % 7) as channel", "cast(id % 11 as double) as nps_score")
    assert kind == "jdbc" or not target.drop("reconciled")
    target.replace(source, "reconciled")
    assert reconcile.differing_groups(source, target, "reconciled", ["month_year"]).count() == 0 and reconcile.differing_rows(source, target, "reconciled", ["month_year"]).count() == 0
    changed = source.where("id <> 13").withColumn("nps_score", F.when(F.col("id") == 22, 0.5).otherwise(F.col("nps_score"))).withColumn("channel", F.when(F.col("id") == 100, "other").otherwise(F.col("channel"))).union(source.where("id = 31"))
    target.replace(changed, "reconciled")
    groups = {r.month_year: (r.source_rows, r.table_rows) for r in reconcile.differing_groups(source, target, "reconciled", ["month_year"]).collect()}
    assert set(groups) == {"2025-3", "2025-2", "2025-1", None} and groups["2025-3"] == (80, 79)
    for most in (500, 2):
        reconcile.MOST_GROUPS = most
        got = sorted((r.id, r.only_in) for r in reconcile.differing_rows(source, target, "reconciled", ["month_year"]).collect())
        assert got == [(13, "source"), (22, "source"), (22, "table"), (31, "table"), (100, "source"), (100, "table")]
    target.drop("reconciled")


def test_statements_share_a_connection_that_still_answers(spark):
    target = derby(spark, "shared")
    first = target._statement(lambda c: c)
    assert target._statement(lambda c: c) is first and target.version().startswith("Apache Derby")
    first.close()
    second = target._statement(lambda c: c)
    assert second is not first and not second.isClosed()
    with pytest.raises(Exception, match="NO_SUCH"):
        target.drop("NO_SUCH")
    assert second.isClosed() and target._statement(lambda c: c.isValid(1))
    target.close()
    target.close()
    assert sinks.connected(target)
