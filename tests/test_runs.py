"""Whole runs: routing, cleaning, loading, workbooks, streams."""

import datetime

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from sondeo.operators import aggregate
from sondeo.plans import cleaning, runs
from sondeo.sources import sinks, workbooks, xlsx
from sondeo.streaming.incremental import clean_new_files

NOW = datetime.datetime(2025, 9, 1)


@pytest.mark.parametrize("name, kind", [("agosto_bm_2025_muestra_281230.xlsx", "BM"), ("agosto_bv_2025_muestra_1904.xlsx", "BV"), ("AGOSTO_BV.xlsx", "BV"), ("submit_bv.xlsx", "BM")])
def test_routing(name, kind):
    assert cleaning.kind_of(name) == kind


def test_routing_of_other_names_fails():
    with pytest.raises(ValueError):
        cleaning.kind_of("agosto.xlsx")


def test_score_falls_back_by_dataset_not_by_row(spark):
    item = '[{"subQuestionId": "nps_rate_recomendation", "answerValue": 9}]'
    rows = [("a", item, "2"), ("b", "[]", "7")]
    df = spark.createDataFrame(rows, "customer_id string, answers string, nps_score_original string")
    got = {r.customer_id: (r.nps_score, r.nps_category) for r in cleaning.clean_bm(df, NOW).collect()}
    assert got == {"a": (9.0, "Promotor"), "b": (None, "Unknown")}
    got = {r.customer_id: (r.nps_score, r.nps_category) for r in cleaning.clean_bm(df.withColumn("answers", F.lit("[]")), NOW).collect()}
    assert got == {"a": (2.0, "Detractor"), "b": (7.0, "Neutral")}
    bare = cleaning.clean_bm(df.select("customer_id"), NOW)
    assert "nps_score" not in bare.columns and bare.first().month_year == cleaning.DEFAULT_MONTH


def test_bv_without_score_keeps_its_date_column(spark):
    df = spark.createDataFrame([("1", "8/1/2025 10:00", "PerÃº", "u")], "Number string, `Date Submitted` string, Country string, `Device` string")
    out = cleaning.clean_bv(df, NOW)
    assert out.columns == ["Date Submitted", "country", "device", "date_submitted", "month_year", "cleaned_date", "file_type"]
    row = out.first()
    assert (row.country, row.month_year, row.file_type) == ("Perú", "2025-08", "BV")


def test_files_are_cleaned_apart_and_counted(spark, tmp_path):
    bm = spark.createDataFrame([("aÃ³", "[{'subQuestionId': 'x', 'answerValue': 1}]"), ("b", "['k']x")], "channel string, answers string")
    bm.write.parquet(str(tmp_path / "in" / "agosto_bm.parquet"))
    spark.createDataFrame([("PerÃº",)], "Country string").write.parquet(str(tmp_path / "in" / "agosto_bv.parquet"))
    counters, written = runs.clean_files(spark, [str(tmp_path / "in" / f"{n}.parquet") for n in ("agosto_bm", "agosto", "agosto_bv")], str(tmp_path / "out"), NOW)
    assert (counters.bm_processed, counters.bv_processed, counters.errors) == (2, 1, 1)
    assert (counters.encoding_fixed, counters.json_fixed, counters.json_corrupted) == (2, 1, 1)
    assert [w.rpartition("/")[2] for w in written] == ["agosto_bm_LIMPIO", "agosto_bv_LIMPIO"]
    assert runs.describe(spark.read.parquet(written[1]))["rows"] == 1


def test_samples_and_cleaned_files_as_workbooks(spark, tmp_path):
    rows = spark.range(30).selectExpr("id", "concat('Ã³ ', id) as channel")
    made = [runs.extract_sample(rows, "id", "agosto_bm", str(tmp_path / "muestras"), n, "workbook") for n in (20, 99)]
    assert [m.rpartition("/")[2] for m in made] == ["agosto_bm_muestra_20.xlsx", "agosto_bm_muestra_30.xlsx"]
    assert runs.extraction_summary([("agosto_bm.xlsx", made[0], 20)]) == ["agosto_bm.xlsx -> agosto_bm_muestra_20.xlsx (20 rows)"] and runs.extraction_summary([]) == ["no samples were taken"]
    workbooks.register(spark)
    counters, written = runs.clean_files(spark, made, str(tmp_path / "limpias"), NOW, lambda s, p: s.read.format("workbook").load(p), "workbook")
    assert [w.rpartition("/")[2] for w in written] == ["agosto_bm_muestra_20_LIMPIO.xlsx", "agosto_bm_muestra_30_LIMPIO.xlsx"]
    assert sorted(p.name for p in (tmp_path / "limpias").iterdir()) == sorted(w.rpartition("/")[2] for w in written)
    assert {r.channel[:1] for r in spark.read.format("workbook").load(written[0]).collect()} == {"ó"}
    assert counters.bm_processed == 50 and "BM rows cleaned: 50" in counters.lines() and "valid: ready to load" in counters.lines()
    assert "see to the errors before loading" in cleaning.Counters(errors=1).lines()
    with pytest.raises(ValueError):
        runs.extract_sample(rows, "id", "x", str(tmp_path), 2, "csv")


def test_sample_names_its_size(spark, tmp_path):
    target = runs.extract_sample(spark.range(100).toDF("id"), "id", "agosto_bm", str(tmp_path), 20)
    assert target.endswith("agosto_bm_muestra_20") and spark.read.parquet(target).count() == 20
    assert runs.extract_sample(spark.range(100).toDF("id"), "id", "agosto_bm", str(tmp_path), 20) == target
    assert [p.name for p in tmp_path.iterdir()] == ["agosto_bm_muestra_20"] and spark.read.parquet(target).count() == 20


@pytest.mark.parametrize("kind", ["warehouse", "jdbc"])
def test_load_appends_bm_and_replaces_bv(spark, kind):
    target = sinks.Warehouse(spark) if kind == "warehouse" else sinks.Jdbc(spark, "jdbc:derby:memory:load;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    if kind == "warehouse":
        for t in (runs.BM_TABLE, runs.BV_TABLE):
            spark.sql(f"DROP TABLE IF EXISTS {t}")
    bm = cleaning.clean_bm(spark.createDataFrame([("web", "8", "[]"), ("nan", "3", "[]")], "channel string, nps_score_original string, answers string"), NOW)
    bv = cleaning.clean_bv(spark.createDataFrame([("Perú",)], "Country string"), NOW).withColumn("nps_score", F.lit(9.0))
    runs.load(bm, bv, target)
    assert runs.load(bm, bv, target) == {runs.BM_TABLE: 4, runs.BV_TABLE: 1}
    assert {r.channel for r in target.read(runs.BM_TABLE).collect()} == {"web", None}
    assert [r.nps_score for r in runs.verify(target)[runs.BV_TABLE]] == [9.0]


def test_inline_scores(spark):
    rows = [("CUST001", 9, "mobile"), ("CUST002", 7, "mobile"), ("CUST003", 10, "web")]
    df = spark.createDataFrame(rows, "customer_id string, nps_score int, channel string")
    assert sorted(tuple(r) for r in aggregate.score_by(df, "channel").collect()) == [("mobile", 8.0, 2, 1, 0), ("web", 10.0, 1, 1, 0)]


def test_workbook_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("á<&>", 1.5, None), (None, 2.0, "x")], "`¿a?` string, b double, c string")
    (tmp_path / "m.xlsx").write_bytes(xlsx.write_sheet(df))
    back = xlsx.read_sheet(spark, str(tmp_path / "m.xlsx"))
    assert back.columns == ["¿a?", "b", "c"]
    assert sorted(map(tuple, back.collect()), key=str) == sorted([("á<&>", "1.5", None), (None, "2.0", "x")], key=str)


def test_stream_takes_each_file_once(spark, tmp_path):
    schema = T.StructType([T.StructField("channel", T.StringType())])
    for n, rows in enumerate(([("aÃ³",)], [("b",), ("c",)])):
        spark.createDataFrame(rows, schema).coalesce(1).write.mode("append").parquet(str(tmp_path / "in"))
        clean_new_files(spark, str(tmp_path / "in"), schema, "BM", str(tmp_path / "out"), str(tmp_path / "check")).awaitTermination(60)
        assert spark.read.parquet(str(tmp_path / "out")).count() == (1, 3)[n]


def test_plan_pushes_down_and_exchanges_once(spark, tmp_path):
    spark.range(1000).selectExpr("id", "cast(id % 11 as double) as nps_score", "concat('c', id % 3) as channel", "'x' as other").write.parquet(str(tmp_path / "t"))
    df = aggregate.score_by(spark.read.parquet(str(tmp_path / "t")).where("nps_score is not null"), "channel")
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "IsNotNull(nps_score)" in plan and "other" not in plan and plan.count("Exchange hashpartitioning") == 1


def test_answers_are_parsed_once(spark):
    from sondeo.plans import catalogue
    from tests.oracle import SMALL

    plan = catalogue.bm_end_to_end(spark, SMALL)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("from_json") <= 4 and "Filter" not in plan


def test_missing_files(spark, tmp_path, caplog):
    (tmp_path / "agosto_bm.xlsx").write_bytes(b"x")
    there, gone = str(tmp_path / "agosto_bm.xlsx"), str(tmp_path / "agosto_bv.xlsx")
    assert runs.existing(spark, [gone, there]) == [there] and "agosto_bm.xlsx" in caplog.text
    with pytest.raises(FileNotFoundError):
        runs.existing(spark, [there, gone], "abort")
    with pytest.raises(ValueError):
        runs.existing(spark, [there], "other")
    assert [p.rpartition("/")[2] for p in runs.list_files(spark, f"{tmp_path}/*.xlsx")] == ["agosto_bm.xlsx"] and runs.list_files(spark, f"{tmp_path}/no/*.xlsx") == []


@pytest.mark.parametrize("kind", ["warehouse", "jdbc"])
def test_load_files_counts_and_sums_up(spark, tmp_path, kind):
    target = sinks.Warehouse(spark, ("month_year",)) if kind == "warehouse" else sinks.Jdbc(spark, "jdbc:derby:memory:summary;create=true", {"driver": "org.apache.derby.iapi.jdbc.AutoloadedDriver"})
    for t in (runs.BM_TABLE, runs.BV_TABLE) if kind == "warehouse" else ():
        target.drop(t)
    assert sinks.connected(target)
    cleaning.clean_bm(spark.createDataFrame([("web", "8", "[]"), ("nan", "3", "[]")], "channel string, nps_score_original string, answers string"), NOW).write.parquet(str(tmp_path / "bm"))
    cleaning.clean_bv(spark.createDataFrame([("Perú",)], "Country string"), NOW).withColumn("nps_score", F.lit(9.0)).write.parquet(str(tmp_path / "bv"))
    handler = runs.log_to_file(str(tmp_path / "log.txt"))
    done = runs.load_files(spark, str(tmp_path / "bm"), str(tmp_path / "bv"), target)
    runs.log.removeHandler(handler)
    assert (done.bm_inserted, done.bv_inserted, done.inserted, done.errors, done.valid) == (2, 1, 3, 0, True) and done.ended >= done.started
    assert "BM rows: 2" in (tmp_path / "log.txt").read_text()
    assert target.read(runs.BM_TABLE).count() == 2 and done.tables == {runs.BM_TABLE: 2, runs.BV_TABLE: 1}
    assert f"{runs.BV_TABLE}: 1 rows in the table" in (tmp_path / "log.txt").read_text()
    (tmp_path / "bad").mkdir()
    failed = runs.load_files(spark, str(tmp_path / "bm"), str(tmp_path / "bad"), target)
    assert failed.errors == 1 and not failed.valid and target.read(runs.BM_TABLE).count() == 4
    with pytest.raises(FileNotFoundError):
        runs.load_files(spark, str(tmp_path / "no"), str(tmp_path / "bv"), target)
    assert sinks.connected(sinks.Jdbc(spark, "jdbc:nothing:x")) is None
    with pytest.raises(ConnectionError):
        runs.load_files(spark, str(tmp_path / "bm"), str(tmp_path / "bv"), sinks.Jdbc(spark, "jdbc:nothing:x"))
    assert sorted(map(tuple, runs.smoke_load(spark, target, "smoke_rows", NOW).collect())) == [("branch", 6.5, 2, 1, 1), ("phone", None, 1, 0, 0)]
    for t in (runs.BM_TABLE, runs.BV_TABLE, "smoke_rows"):
        target.drop(t)


def test_declared_tables(spark):
    for t in sinks.DECLARED:
        sinks.Warehouse(spark).drop(t)
    sinks.declare_tables(spark)
    sinks.declare_tables(spark)
    assert spark.table(runs.BM_TABLE).columns == list(runs.BM_KEPT) and spark.table(runs.BV_TABLE).count() == 0
    for t in sinks.DECLARED:
        sinks.Warehouse(spark).drop(t)


def test_profile_shows_heads_and_flags(spark):
    df = spark.createDataFrame([("[{'a': 1}]", "x"), (None, "y"), ('[{"a": "Ã"}]', "z")], "answers string, other string")
    out = runs.describe(df)
    assert out["key_columns"] == ["answers"] and len(out["head"]) == 3 and out["date_columns"] == []
    assert [(r["single_quoted"], r["double_quoted"], r["broken_encoding"]) for r in sorted(out["answers"], key=lambda r: r["text"])] == [(False, True, True), (True, False, False)]


def test_workbooks_meet_by_name(spark, tmp_path):
    for name, df in (("a", spark.createDataFrame([("1", "2")], "x string, y string")), ("b", spark.createDataFrame([("3", "4", "5")], "y string, z string, x string"))):
        (tmp_path / f"{name}.xlsx").write_bytes(xlsx.write_sheet(df))
    back = xlsx.read_sheet(spark, f"{tmp_path}/*.xlsx")
    assert back.columns == ["x", "y", "z"] and sorted(map(tuple, back.collect())) == [("1", "2", None), ("5", "3", "4")]


def test_tables_of_sink_queries_can_be_dropped(spark):
    from sondeo.plans import catalogue
    from tests.oracle import SMALL

    assert catalogue.append_sink(spark, SMALL).count() == 2000 and catalogue._made
    names = [n for _, n in catalogue._made if "/" not in n]
    catalogue.drop_made_tables()
    assert not any(spark.catalog.tableExists(n) for n in names)


def test_single_quoted_text_is_told_without_parsing(spark):
    from sondeo.functions import jsonrepair

    texts = ["{'a': 1}", " [ {\n'a': 'b'}]", "[[{'a': 1}]]", '{"a": "\'"}', '["{\'a\'"]', "[]", "{}", "", "'a'", "{ }", None]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string")
    wrapped = F.coalesce(F.size(F.from_json(F.concat(F.lit("["), "t", F.lit("]")), "array<string>", jsonrepair.STRICT)) == 1, F.lit(False))
    found = rows.select("t", jsonrepair.is_json(F.col("t")).alias("told"), wrapped.alias("parsed")).collect()
    assert [r.told for r in found] == [r.parsed for r in found]
    assert sum(r.told for r in found) == 5


def test_text_without_marks_is_left_as_it_is(spark):
    from sondeo.functions import encoding

    texts = ["", "plain ó ñ", "Ã³", "aÂ", "Ã", "Â¿quÃ©?", "ÃÂ³", None]
    rows = spark.createDataFrame([(t,) for t in texts], "t string")
    for rules in (encoding.RULES, encoding.PLAIN_RULES):
        want = []
        for t in texts:
            for wrong, right in rules:
                t = t if t is None else t.replace(wrong, right)
            want.append(t)
        assert [r.x for r in rows.select(encoding.fix_encoding(F.col("t"), rules).alias("x")).collect()] == want


def test_a_profile_takes_two_passes(spark):
    df = spark.range(3000).selectExpr("cast(id % 11 as double) as nps_score", "case when id % 11 <= 6 then 'Detractor' when id % 11 <= 8 then 'Neutral' else 'Promotor' end as nps_category", "if(id % 10 = 0, null, concat('c', cast(sqrt(id % 100) as int))) as country", "concat('d', id) as device", "timestamp_ntz'2025-08-01 00:00:00' + make_dt_interval(cast(id % 5 as int)) as date_submitted", "'x' as csat_text").persist()
    df.count()
    spark.sparkContext.setJobGroup("profile", "profile")
    found = runs.describe(df.drop("device"))
    jobs = len(spark.sparkContext.statusTracker().getJobIdsForGroup("profile"))
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert jobs <= 7  # two passes of up to three jobs each, as stages of adaptive plans are submitted apart, and the head
    assert found["rows"] == 3000 and found["columns"] == 5
    assert found["categories"] == {r["value"]: r["n"] for r in profile_counts(df, "nps_category")}
    assert found["top_country"] == [(r["value"], r["n"]) for r in profile_counts(df, "country")[:3]]
    assert [x["n"] for x in found["stats"] if x["column"] == "csat_text"] == [0]
    full = runs.describe(df)
    assert full["top_device"] == [(r["value"], r["n"]) for r in profile_counts(df, "device")[:3]]  # nothing stands out: counted as a whole
    lines = runs.report(full)
    assert lines[0] == "3,000 rows, 6 columns" and any(x.startswith("nps_score: 3,000 values, mean 5.00, from 0.0 to 10.0") for x in lines) and not any("csat_text" in x for x in lines)
    assert runs.report(runs.describe(df.where("false")))[0] == "0 rows, 6 columns"
    df.unpersist()


def profile_counts(df, name):
    from sondeo.operators import profile

    return profile.value_counts(df, name).collect()
