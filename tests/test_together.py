"""Many files in few jobs."""

import datetime

import pytest
from pyspark.sql import functions as F

from sondeo.plans import runs, together

NOW = datetime.datetime(2025, 9, 1)


def item(q, v):
    return f"{{'subQuestionId': '{q}', 'answerValue': {v}}}"


@pytest.fixture
def files(spark, tmp_path):
    """Files of two kinds and several schemas, a broken one, one of no kind, one without rows."""
    bm = "timestamp string, channel string, nps_score_original string, answers string"
    made = {
        "a_bm": (bm, [("13/1/2025 9:00", "Ã³", "2", f"[{item('nps_rate_recomendation', 9)}, {item('x', 1)}]"), ("8/1/2025 9:00", "b", "3", "[]")]),
        "b_bm": (bm, [("1/13/2025 9:00", "c", "7", "['k']x"), ("8/1/2025 9:00", None, "8", f"[{item('y', 'true')}]")]),
        "c_bm": (bm, [("2025-08-01T10:00:00-05:00", "d", "15", None), ("2025-08-02T10:00:00-05:00", "e", None, '[{"subQuestionId": "nps_rate_recomendation", "answerValue": 4}]')]),
        "d_bm": ("channel string", [("Â¿QuÃ©?",)]),
        "e_bv": ("`Date Submitted` string, `¿Qué tan probable es que nos recomiendes?` string, Country string", [("8/1/2025 10:00", "9", "PerÃº"), ("14/1/2025 10:00", "x", "b")]),
        "f_bv": ("`Date Submitted` string, `Nos recomiendas, es probable?` string, Country string", [("8/1/2025 10:00", "3", "c")]),
        "g_bm": (bm, []),
    }
    for name, (schema, rows) in made.items():
        spark.createDataFrame(rows, schema).coalesce(1).write.parquet(str(tmp_path / "in" / f"{name}.parquet"))
    (tmp_path / "in" / "bad_bm.parquet").write_bytes(b"no such format")
    (tmp_path / "in" / "neither.parquet").write_bytes(b"")
    return tmp_path


def rows_of(spark, folder, columns):
    df = spark.read.parquet(folder)
    return sorted((tuple(str(r[n]) if n in df.columns else "None" for n in columns) for r in df.collect()))


def test_as_file_by_file(spark, files):
    paths = sorted(str(p) for p in (files / "in").iterdir())
    one, apart = runs.clean_files(spark, paths, str(files / "apart"), NOW)
    counters, written = together.clean_together(spark, paths, str(files / "out"), NOW)
    assert counters == one and counters.errors == 2
    stem = lambda p: p.rpartition("/")[2].removeprefix("file=")
    assert [stem(p) for p in written] == sorted(stem(p) for p in apart if "g_bm" not in p)
    for folder in written:
        own = next(p for p in apart if stem(p) == stem(folder))
        names = spark.read.parquet(own).columns
        assert set(names) <= set(spark.read.parquet(folder).columns)
        assert rows_of(spark, folder, names) == rows_of(spark, own, names), folder
        extra = [n for n in spark.read.parquet(folder).columns if n not in names]
        assert spark.read.parquet(folder).where(" or ".join(f"`{n}` is not null" for n in extra) or "false").count() == 0


def test_jobs_do_not_grow_with_files(spark, tmp_path):
    def jobs(n):
        rows = spark.createDataFrame([(f"f{i}_bm", f"c{i}", f"[{item('nps_rate_recomendation', i % 11)}]") for i in range(n)], "stem string, channel string, answers string")
        for r in rows.collect():
            import pyarrow as pa
            import pyarrow.parquet as pq

            (tmp_path / f"in{n}").mkdir(exist_ok=True)
            pq.write_table(pa.table({"channel": [r.channel], "answers": [r.answers]}), tmp_path / f"in{n}" / f"{r.stem}.parquet")
        group = f"files{n}"
        spark.sparkContext.setJobGroup(group, group)
        counters, written = together.clean_together(spark, f"{tmp_path}/in{n}/*.parquet", str(tmp_path / f"out{n}"), NOW)
        found = len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
        assert (counters.bm_processed, counters.errors, len(written)) == (n, 0, n)
        assert spark.read.parquet(str(tmp_path / f"out{n}")).agg(F.sum("nps_score")).head()[0] == sum(i % 11 for i in range(n))
        return found

    assert jobs(60) <= jobs(3) + 3


def test_no_files(spark, tmp_path):
    assert together.clean_together(spark, [], str(tmp_path / "out"), NOW)[1] == []


def test_a_task_writes_so_many_rows_at_most(spark, tmp_path, monkeypatch):
    """However few bytes they pack to; small files share a task, and each has one file in its folder."""
    monkeypatch.setattr(together, "TASK_ROWS", 1_000)
    spark.range(12_000).select(F.lit("web").alias("channel"), F.lit("[]").alias("answers")).coalesce(1).write.parquet(str(tmp_path / "in" / "large_bm.parquet"))
    for i in range(6):
        spark.range(100 + i).select(F.lit("web").alias("channel"), F.lit("[]").alias("answers")).coalesce(1).write.parquet(str(tmp_path / "in" / f"small{i}_bm.parquet"))
    counters, written = together.clean_together(spark, f"{tmp_path}/in/*.parquet", str(tmp_path / "out"), NOW)
    assert (counters.bm_processed, counters.errors, len(written)) == (12_615, 0, 7)
    out = spark.read.parquet(str(tmp_path / "out")).groupBy("file", F.input_file_name().alias("path")).count().collect()
    large = [r["count"] for r in out if r["file"].startswith("large")]
    assert sum(large) == 12_000 and max(large) < 2_000
    assert sorted(r["count"] for r in out if r["file"].startswith("small")) == [100 + i for i in range(6)]


def test_tasks_of_files():
    sizes = {"a": (400_000, 0), "b": (50_000, 0), "c": (100_000, 0), "d": (1_700_000, 0), "e": (10, 300 << 20), "f": (1, 1)}
    assert together._tasks({n: {"rows": r, "bytes": b} for n, (r, b) in sizes.items()}) == ({"a": (0, 1), "b": (0, 1), "c": (1, 1), "d": (2, 4), "e": (6, 3), "f": (9, 1)}, 10)
    assert together._tasks({}) == ({}, 0)
