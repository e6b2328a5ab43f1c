import pytest

from sondeo.plans import catalogue
from tests.oracle import SMALL, same


@pytest.mark.parametrize("name", sorted(catalogue.SQL))
def test_query_equals_sql(spark, name):
    same(spark, catalogue.QUERIES[name], catalogue.SQL[name])


def test_sample_is_exact_distinct_and_stable(spark):
    first = catalogue.QUERIES["sample_exact_n"](spark, SMALL).collect()
    assert len(first) == len({r.event_id for r in first}) == 100
    events = spark.read.parquet(f"{SMALL}/events.parquet").repartition(7)
    from sondeo.operators.sampling import exact_sample

    assert {r.event_id for r in exact_sample(events, "event_id", 100).collect()} == {r.event_id for r in first}
    assert exact_sample(events, "event_id", 10**6).count() == 1000


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.mark.parametrize("bits, few", [(14, 4096), (6, 2)])
def test_sample_is_what_a_sort_by_hash_gives(spark, monkeypatch, bits, few):
    from pyspark.sql import functions as F

    from sondeo.operators import sampling

    monkeypatch.setattr(sampling, "BITS", bits)
    monkeypatch.setattr(sampling, "FEW", few)
    rows = spark.range(500).select("id", F.when(F.col("id") % 50 != 0, F.col("id")).alias("key"), (F.col("id") % 3).alias("_copy"))
    unique = rows.where("key is not null")
    for n in (1, 63, 489):
        want = {r.id for r in unique.orderBy(F.xxhash64("key", F.lit(42)), "key").limit(n).collect()}
        took = sampling.exact_sample(unique.repartition(5), "key", n)
        assert {r.id for r in took.collect()} == want
        assert "SinglePartition" not in plan_of(took) and "TakeOrdered" not in plan_of(took)
    hot = unique.withColumn("key", F.when(F.col("id") % 2 == 0, F.lit(7)).otherwise(F.col("key")))
    equal = hot.select("key").withColumn("m", F.create_map(F.lit("a"), F.col("key")))
    sizes = {id(df): df.count() for df in (rows, hot, equal)}
    for n in (0, 100, 489):
        for df in (rows, hot, equal):
            took = sampling.exact_sample(df, "key", n)
            assert took.count() == max(0, min(n, sizes[id(df)])) and took.columns == df.columns
            if df is not equal:
                assert took.select("id").distinct().count() == took.count()
        assert {r.id for r in sampling.exact_sample(hot, "key", n).collect()} == {r.id for r in sampling.exact_sample(hot.repartition(3, "_copy"), "key", n).collect()}
    assert sampling.exact_sample(rows.where("false"), "key", 5).count() == 0


def test_a_large_sample_is_a_filter(spark):
    from sondeo.operators.sampling import exact_sample

    rows = spark.read.parquet("/root/testdata/sf0.01/lineitem.parquet")
    took = exact_sample(rows.selectExpr("*", "concat(l_orderkey, '-', l_linenumber) as line"), "line", 40_000)
    assert took.count() == 40_000
    assert "Exchange" not in plan_of(took) and "Sort" not in plan_of(took) and "Limit" not in plan_of(took)


def test_entry_imports_without_the_llm_folders(tmp_path):
    import shutil
    import subprocess
    import sys
    from pathlib import Path

    repo = Path(__file__).parent.parent
    shutil.copytree(repo / "sondeo", tmp_path / "sondeo", ignore=shutil.ignore_patterns("llm", "__pycache__"))
    shutil.copy(repo / "__spark_entry__.py", tmp_path)
    code = "import __spark_entry__ as e; q = e.queries(); assert 'nps_by_channel' in q and not [n for n in q if n.startswith('op')]; e.oracle_sql()"
    subprocess.run([sys.executable, "-c", code], cwd=tmp_path, check=True)
