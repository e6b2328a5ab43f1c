"""The registered queries over the test tables, each beside the SQL that must give the same rows.

The tables hold no broken texts, so some queries break rows first, by a rule on their key, in the query and in the SQL.
"""

from __future__ import annotations

import atexit
import datetime
import functools
import uuid
from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import answers, dates, jsonrepair, scores, text
from ..functions.encoding import PLAIN_RULES, encoding_hits, fix_encoding
from ..operators import aggregate, profile, reconcile
from ..operators import columns as c
from ..operators.sampling import exact_sample
from ..sources import workbooks
from ..sources.runfolders import RunFolders
from ..sources.sinks import Warehouse, checksum
from . import cleaning, runs, together

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}
RUN_TIME = datetime.datetime(2025, 8, 31, 12, 0, 0)

# SQL parts that several oracles share
_CLIP = "CASE WHEN {0} IS NULL THEN NULL ELSE greatest(0, least(10, {0})) END"
_CATEGORY = "CASE WHEN {0} IS NULL THEN 'Unknown' WHEN {0} <= 6 THEN 'Detractor' WHEN {0} <= 8 THEN 'Neutral' ELSE 'Promotor' END"
_NUMBER = r"'^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$'"
_NOT_KEPT = r"'[^\p{L}\p{N}_\s\x0B\x1C-\x1F\x{85}\p{Z}.,!?:;\-]'"
_SCORED = f"SELECT *, {_CLIP.format('floor(value / 10)')} AS score FROM events"


def query(sql: str | None = None) -> Callable[[Query], Query]:
    def register(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql:
            SQL[f.__name__] = sql
        return f

    return register


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _responses(spark: SparkSession, sf_dir: str) -> DataFrame:
    """events as responses: channel and clipped score."""
    return table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("channel"), "ts", scores.clip_score(F.floor(F.col("value") / 10).cast("double")).alias("nps_score"))


@query(f"SELECT event_type AS channel, round(avg(score), 6) AS avg_nps, count(*) AS total, count(CASE WHEN score >= 9 THEN 1 END) AS promoters, count(CASE WHEN score <= 6 THEN 1 END) AS detractors FROM ({_SCORED}) GROUP BY 1")
def nps_by_channel(spark, sf_dir):
    return aggregate.score_by(_responses(spark, sf_dir), "channel")


@query(f"SELECT event_type AS channel, round((count(CASE WHEN score >= 9 THEN 1 END) - count(CASE WHEN score <= 6 THEN 1 END)) * 100.0 / count(score), 6) AS net_score, count(score) AS scored FROM ({_SCORED}) GROUP BY 1")
def net_score(spark, sf_dir):
    return aggregate.net_score(_responses(spark, sf_dir), "channel")


@query(f"SELECT {_CATEGORY.format('score')} AS value, count(*) AS n FROM ({_SCORED}) GROUP BY 1")
def nps_category_counts(spark, sf_dir):
    return profile.value_counts(_responses(spark, sf_dir).select(scores.categorize(F.col("nps_score")).alias("nps_category")), "nps_category")


@query(f"SELECT event_id, CAST(score AS DOUBLE) AS nps_score, {_CATEGORY.format('score')} AS nps_category FROM ({_SCORED})")
def score_rows(spark, sf_dir):
    return _responses(spark, sf_dir).select("event_id", "nps_score", scores.categorize(F.col("nps_score")).alias("nps_category"))


@query(
    f"""WITH t AS (SELECT event_id, CASE event_id % 7 WHEN 0 THEN '' WHEN 1 THEN 'abc' WHEN 2 THEN '9d' WHEN 3 THEN 'nan' WHEN 4 THEN ' ' || CAST(CAST(floor(value / 5) AS INTEGER) AS VARCHAR) || ' ' ELSE CAST(CAST(floor(value / 10) AS INTEGER) AS VARCHAR) END AS raw FROM events),
    n AS (SELECT *, CASE WHEN regexp_matches(raw, {_NUMBER}) THEN TRY_CAST(trim(raw) AS DOUBLE) END AS x FROM t), s AS (SELECT event_id, raw, {_CLIP.format("x")} AS nps_score FROM n)
    SELECT event_id, raw, nps_score, {_CATEGORY.format("nps_score")} AS nps_category FROM s"""
)
def score_dirty_numeric(spark, sf_dir):
    k, whole = F.col("event_id") % 7, lambda d: F.floor(F.col("value") / d).cast("int").cast("string")
    raw = F.when(k == 0, "").when(k == 1, "abc").when(k == 2, "9d").when(k == 3, "nan").when(k == 4, F.concat(F.lit(" "), whole(5), F.lit(" "))).otherwise(whole(10))
    rows = table(spark, sf_dir, "events").select("event_id", raw.alias("raw")).withColumn("nps_score", scores.score(F.col("raw")))
    return rows.withColumn("nps_category", scores.categorize(F.col("nps_score")))


@query(f"WITH s AS (SELECT c_custkey, {_CLIP.format('c_acctbal')} AS nps_score FROM customer) SELECT c_custkey, nps_score, {_CATEGORY.format('nps_score')} AS nps_category FROM s")
def score_clip_negative(spark, sf_dir):
    rows = table(spark, sf_dir, "customer").select("c_custkey", scores.clip_score(F.col("c_acctbal")).alias("nps_score"))
    return rows.withColumn("nps_category", scores.categorize(F.col("nps_score")))


@query(
    f"""WITH a AS (SELECT event_id, 'answered' AS dataset, CASE WHEN event_id % 3 = 0 THEN floor(value / 10) END AS x FROM events), b AS (SELECT event_id, 'unanswered' AS dataset, floor(value / 10) AS x FROM events),
    s AS (SELECT event_id, dataset, CAST({_CLIP.format("x")} AS DOUBLE) AS nps_score FROM (SELECT * FROM a UNION ALL SELECT * FROM b)) SELECT *, {_CATEGORY.format("nps_score")} AS nps_category FROM s"""
)
def score_fallback_dataset(spark, sf_dir):
    """A dataset in which some rows answered scores by answers alone; one in which none did, by the raw column."""
    raw = table(spark, sf_dir, "events").select("event_id", F.floor(F.col("value") / 10).cast("string").alias("nps_score_original"))
    item = F.concat(F.lit('[{"subQuestionId": "nps_rate_recomendation", "answerValue": '), F.col("nps_score_original"), F.lit("}]"))
    some = raw.withColumn("answers", F.when(F.col("event_id") % 3 == 0, item))
    none = raw.withColumn("answers", F.lit("[]"))
    parts = [cleaning.clean_bm(df, RUN_TIME).select("event_id", F.lit(name).alias("dataset"), "nps_score", "nps_category") for name, df in (("answered", some), ("unanswered", none))]
    return parts[0].union(parts[1])


@query("SELECT event_id, json_extract_string(props, '$.k') AS k FROM events")
def json_extract(spark, sf_dir):
    item = F.concat(F.lit('[{"subQuestionId": "k", "answerValue": '), F.get_json_object("props", "$.k"), F.lit("}]"))
    return table(spark, sf_dir, "events").select("event_id", answers.answer(answers.items(item), "k").alias("k"))


@query("""SELECT event_id, '{"k": ' || json_extract_string(props, '$.k') || ', "t": "a ' || event_type || '"}' AS fixed, 'fixed' AS outcome FROM events""")
def json_repair_quotes(spark, sf_dir):
    k = F.get_json_object("props", "$.k")
    broken = F.concat(F.lit("{'k': "), k, F.lit(", 't': 'a "), F.col("event_type"), F.lit("'}"))
    repaired = table(spark, sf_dir, "events").select("event_id", jsonrepair.repair(broken).alias("r"))
    return repaired.select("event_id", F.col("r.text").alias("fixed"), F.col("r.outcome").alias("outcome"))


_BROKEN_OUTCOMES = "CASE event_id % 6 WHEN 0 THEN 'valid' WHEN 1 THEN 'fixed' WHEN 2 THEN 'corrupted' WHEN 3 THEN 'corrupted' WHEN 4 THEN 'corrupted' ELSE NULL END"


@query(f"SELECT {_BROKEN_OUTCOMES} AS outcome, count(*) AS n FROM events GROUP BY 1")
def json_corrupt_count(spark, sf_dir):
    k = F.col("event_id") % 6
    shapes = F.when(k == 0, F.col("props")).when(k == 1, F.replace("props", F.lit('"'), F.lit("'"))).when(k == 2, F.concat("props", F.lit(" xx"))).when(k == 3, F.lit("[{'a': None}]")).when(k == 4, F.lit("['k': 'v']"))
    return table(spark, sf_dir, "events").groupBy(jsonrepair.json_outcome(shapes).alias("outcome")).agg(F.count(F.lit(1)).alias("n"))


def _lists(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as answer lists: the question is known for users and assistants, else metric_<role>."""
    rows = table(spark, sf_dir, "conversations")
    q = F.when(F.col("role") == "user", "nps_text_recomendation").when(F.col("role") == "assistant", "csat_text_satisfied").otherwise(F.col("role"))
    item = F.to_json(F.struct(q.alias(answers.ID_KEY), F.col("text").alias(answers.VALUE_KEY)))
    listed = F.transform(F.sort_array(F.collect_list(F.struct("turn", item.alias("item")))), lambda x: x["item"])
    return rows.groupBy("conv_id").agg(F.concat(F.lit("["), F.array_join(listed, ", "), F.lit("]")).alias("answers"))


def _last(role: str) -> str:
    return f"max_by(text, turn) FILTER (WHERE role = '{role}')"


@query(f"SELECT conv_id, {_last('user')} AS nps_recomendacion_motivo, {_last('assistant')} AS csat_satisfaccion_motivo, {_last('system')} AS metric_system FROM conversations GROUP BY conv_id")
def json_expand_metrics(spark, sf_dir):
    return answers.expand(_lists(spark, sf_dir)).drop("answers")


@query("SELECT DISTINCT CASE role WHEN 'user' THEN 'nps_recomendacion_motivo' WHEN 'assistant' THEN 'csat_satisfaccion_motivo' ELSE 'metric_' || role END AS name FROM conversations")
def json_metric_discovery(spark, sf_dir):
    found = _lists(spark, sf_dir).select(F.explode(F.transform(answers.items(F.col("answers")), lambda x: x["id"])).alias("id")).distinct()
    known = F.create_map(*(F.lit(x) for pair in answers.COLUMNS.items() for x in pair))
    return found.select(F.coalesce(F.try_element_at(known, F.col("id")), F.concat(F.lit(answers.PREFIX), "id")).alias("name"))


#: Letters that are broken before they are repaired.
_BREAK = (("ó", "Ã³"), ("á", "Ã¡"), ("é", "Ã©"), ("í", "Ã­"), ("ú", "Ãº"), ("ñ", "Ã±"), ("¿", "Â¿"), ("¡", "Â¡"))


def _broken(col: Column) -> Column:
    for right, wrong in _BREAK:
        col = F.replace(col, F.lit(right), F.lit(wrong))
    return col


@query("SELECT doc_id, '¿' || text AS fixed FROM documents")
def encoding_fix(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", fix_encoding(_broken(F.concat(F.lit("¿"), "text"))).alias("fixed"))


@query("SELECT doc_id, CASE doc_id % 4 WHEN 0 THEN 1 WHEN 1 THEN 2 WHEN 2 THEN 3 ELSE 0 END AS hits FROM documents")
def encoding_hits_count(spark, sf_dir):
    k = F.col("doc_id") % 4
    plain = F.translate("text", "ÃÂ", "")
    raw = F.when(k == 0, F.concat(plain, F.lit("Ã³ y Ã³"))).when(k == 1, F.concat(F.lit("Â¿QuÃ©?"), plain)).when(k == 2, F.concat(F.lit("Â¿QuÃ©?Â"), plain)).otherwise(plain)
    return table(spark, sf_dir, "documents").select("doc_id", encoding_hits(raw).alias("hits"))


@query("SELECT doc_id, text || ' Í‰xito ÍšTIL' AS fixed, text || ' Ã‰xito ÃšTIL' AS plain FROM documents")
def encoding_dead_rules(spark, sf_dir):
    raw = F.concat("text", F.lit(" Ã‰xito ÃšTIL"))
    return table(spark, sf_dir, "documents").select("doc_id", fix_encoding(raw).alias("fixed"), fix_encoding(raw, PLAIN_RULES).alias("plain"))


@query("SELECT page_id, split_part(trim(url), '?', 1) AS source_url FROM pages")
def clean_url(spark, sf_dir):
    return table(spark, sf_dir, "pages").select("page_id", text.clean_url(F.concat(F.lit(" \t"), "url", F.lit(" "))).alias("source_url"))


@query("SELECT page_id, CASE page_id % 6 WHEN 0 THEN '' WHEN 1 THEN '' WHEN 2 THEN '' WHEN 3 THEN 'nan' WHEN 4 THEN 'NaN' ELSE split_part(trim(url), '?', 1) END AS source_url FROM pages")
def clean_url_nulls(spark, sf_dir):
    k = F.col("page_id") % 6
    raw = F.when(k == 0, None).when(k == 1, "").when(k == 2, "nan").when(k == 3, " nan ").when(k == 4, "NaN").otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", text.clean_url(raw).alias("source_url"))


@query(f"SELECT doc_id, regexp_replace('¡' || text || '! (10/10) 👍', {_NOT_KEPT}, '', 'g') AS feedback FROM documents")
def feedback_text(spark, sf_dir):
    return table(spark, sf_dir, "documents").select("doc_id", text.clean_feedback(F.concat(F.lit("¡"), "text", F.lit("! (10/10) 👍"))).alias("feedback"))


@query("SELECT 'events' AS source, strftime(ts, '%Y-%m') AS month_year, count(*) AS n FROM events GROUP BY 1, 2 UNION ALL SELECT 'orders', strftime(o_orderdate, '%Y-%m'), count(*) FROM orders GROUP BY 1, 2")
def month_year(spark, sf_dir):
    parts = [table(spark, sf_dir, t).groupBy(F.lit(t).alias("source"), dates.month_year(F.col(d)).alias("month_year")).agg(F.count(F.lit(1)).alias("n")) for t, d in (("events", "ts"), ("orders", "o_orderdate"))]
    return parts[0].union(parts[1])


@query("SELECT o_orderkey, CASE WHEN o_orderkey % 4 IN (0, 1, 2) THEN CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS at FROM orders")
def date_coerce(spark, sf_dir):
    k, d = F.col("o_orderkey") % 4, F.col("o_orderdate")
    raw = F.when(k == 0, F.date_format(d, "yyyy-MM-dd")).when(k == 1, F.date_format(d, "M/d/yyyy")).when(k == 2, F.concat(F.date_format(d, "yyyy-MM-dd"), F.lit(" 00:00:00"))).otherwise("nope")
    return table(spark, sf_dir, "orders").select("o_orderkey", dates.to_wall_clock(raw).alias("at"))


@query(
    """SELECT o_orderkey, CASE WHEN o_orderkey % 9 = 0 THEN NULL ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS day_first, CASE WHEN o_orderkey % 9 = 0 AND day(o_orderdate) > 12 THEN NULL
    WHEN o_orderkey % 9 = 0 THEN make_timestamp(year(o_orderdate), day(o_orderdate), month(o_orderdate), 0, 0, 0) ELSE CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) END AS month_first FROM orders"""
)
def date_orders(spark, sf_dir):
    """One column with the day first, one with the month first, each with some other texts: those of the second column are dates in the other order, read as the column is or not at all."""
    k, d = F.col("o_orderkey") % 9, F.col("o_orderdate")
    day, month = F.date_format(d, "d/M/yyyy"), F.date_format(d, "M/d/yyyy")
    raw = table(spark, sf_dir, "orders").select("o_orderkey", F.when(k == 0, "nope").otherwise(day).alias("day_first"), F.when(k == 0, day).otherwise(month).alias("month_first"))
    found = dates.column_formats(raw, ["day_first", "month_first"])
    return raw.select("o_orderkey", *(dates.to_wall_clock(F.col(n), f).alias(n) for n, f in found.items()))


@query("SELECT event_id, date_trunc('second', ts) AS at FROM events")
def tz_strip(spark, sf_dir):
    raw = F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00"))
    return table(spark, sf_dir, "events").select("event_id", dates.to_wall_clock(raw).alias("at"))


@query("SELECT c_mktsegment, c_custkey FROM customer")
def keep_projection(spark, sf_dir):
    return c.keep(table(spark, sf_dir, "customer"), ["c_mktsegment", "no such column", "c_custkey"])


@query("SELECT p_partkey, p_name AS country, p_brand AS device, p_size, p_retailprice FROM part")
def rename_drop(spark, sf_dir):
    part = c.rename(table(spark, sf_dir, "part"), {"p_name": "Country", "p_brand": "Device"})
    return c.rename(part.drop("p_type", "Hotjar User ID"), cleaning.BV_RENAMED)


@query("SELECT CASE WHEN event_id % 5 <> 0 THEN event_type END AS a, CASE WHEN event_id % 3 <> 0 THEN value END AS b FROM events WHERE event_id % 15 <> 0")
def dropna_all(spark, sf_dir):
    e = F.col("event_id")
    return c.drop_blank_rows(table(spark, sf_dir, "events").select(F.when(e % 5 != 0, F.col("event_type")).alias("a"), F.when(e % 3 != 0, F.col("value")).alias("b")))


@query(f"SELECT event_id, event_type AS channel, CAST(score AS DOUBLE) AS nps_score FROM ({_SCORED}) WHERE score IS NOT NULL ORDER BY event_id LIMIT 3")
def not_null_limit(spark, sf_dir):
    return _responses(spark, sf_dir).where("nps_score is not null").select("event_id", "channel", "nps_score").orderBy("event_id").limit(3)


def _stats_sql(name: str, x: str, source: str) -> str:
    return f"SELECT '{name}' AS \"column\", count({x}) AS n, round(avg({x}), 6) AS mean, CAST(min({x}) AS DOUBLE) AS least, CAST(max({x}) AS DOUBLE) AS greatest FROM {source}"


@query(f"{_stats_sql('quality', 'quality', 'labels')} UNION ALL {_stats_sql('toxic', 'toxic', 'labels')} UNION ALL {_stats_sql('doc_id', 'doc_id', 'labels')}")
def column_stats(spark, sf_dir):
    return profile.column_stats(table(spark, sf_dir, "labels"), ["quality", "toxic", "doc_id"])


@query("SELECT o_orderpriority AS value, count(*) AS n FROM orders GROUP BY 1")
def value_counts(spark, sf_dir):
    return profile.value_counts(table(spark, sf_dir, "orders"), "o_orderpriority")


@query(
    """SELECT 'rows' AS item, '' AS value, CAST(count(*) AS DOUBLE) AS n FROM lineitem UNION ALL SELECT 'mean', 'l_quantity', round(avg(l_quantity), 6) FROM lineitem UNION ALL SELECT 'least', 'l_quantity', min(l_quantity) FROM lineitem UNION ALL SELECT 'greatest', 'l_quantity', max(l_quantity) FROM lineitem
    UNION ALL SELECT 'l_returnflag', l_returnflag, n FROM (SELECT l_returnflag, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 2)
    UNION ALL SELECT 'part', part, n FROM (SELECT CAST(l_partkey AS VARCHAR) AS part, CAST(count(*) AS DOUBLE) AS n FROM lineitem GROUP BY 1 ORDER BY n DESC, 1 LIMIT 2)"""
)
def profile_in_one_pass(spark, sf_dir):
    """Statistics, and the most frequent values of a column with few and of one with very many about equally frequent ones."""
    rows = table(spark, sf_dir, "lineitem").select("l_quantity", "l_returnflag", F.col("l_partkey").cast("string").alias("part"))
    found = profile.one_pass(rows, ["l_quantity"], ["l_returnflag", "part"], k=2)
    stats = found["stats"]["l_quantity"]
    out = [("rows", "", float(found["rows"])), *((k, "l_quantity", float(stats[k])) for k in ("mean", "least", "greatest")), *((name, v, float(n)) for name, values in found["tops"].items() for v, n in values)]
    return spark.createDataFrame(out, "item string, value string, n double")


@query("SELECT source AS value, count(*) AS n FROM documents WHERE source IS NOT NULL GROUP BY 1 ORDER BY n DESC, value LIMIT 3")
def top3_source(spark, sf_dir):
    return profile.top_values(table(spark, sf_dir, "documents"), "source")


@query("SELECT min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders")
def date_range(spark, sf_dir):
    return profile.date_range(table(spark, sf_dir, "orders"), "o_orderdate")


@query("SELECT 'events' AS name, count(*) AS n FROM events UNION ALL SELECT 'orders', count(*) FROM orders")
def table_counts(spark, sf_dir):
    parts = [table(spark, sf_dir, t).agg(F.count(F.lit(1)).alias("n")).select(F.lit(t).alias("name"), "n") for t in ("events", "orders")]
    return parts[0].union(parts[1])


@query("SELECT event_id, event_id % 3 = 0 AS broken_encoding, event_id % 2 = 0 AS single_quoted, event_id % 2 = 1 AS double_quoted, event_id % 2 = 1 AS valid_json FROM events")
def text_diagnostics(spark, sf_dir):
    quote = F.when(F.col("event_id") % 2 == 0, F.replace("props", F.lit('"'), F.lit("'"))).otherwise(F.col("props"))
    inner = F.concat(F.lit("["), quote, F.when(F.col("event_id") % 3 == 0, F.when(F.col("event_id") % 2 == 0, ", 'Ã'").otherwise(', "Ã"')).otherwise(""), F.lit("]"))
    raw = table(spark, sf_dir, "events").select("event_id", inner.alias("raw"))
    return raw.select("event_id", *(x.alias(n) for n, x in profile.text_flags(F.col("raw")).items()))


def _through(spark: SparkSession, df: DataFrame, name: str, write: Callable[[Warehouse, DataFrame, str], None]) -> DataFrame:
    name = f"{name}_{uuid.uuid4().hex}"  # a warehouse may still hold the folder of a table that this catalogue doesn't know
    write(Warehouse(spark), df, name)
    _made.append((spark, name))
    return spark.table(name)


#: Tables, and folders (by their path), that sink queries wrote. They stay to the end of the process, as a result is read after its query returns.
_made: list[tuple[SparkSession, str]] = []


@atexit.register
def drop_made_tables() -> None:
    """Drops them, where their session still runs. Whoever runs such queries for long may call it between."""
    while _made:
        spark, name = _made.pop()
        if spark.sparkContext._jsc is None:
            continue
        if "/" in name:
            path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(name)
            path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(path, True)
        else:
            Warehouse(spark).drop(name)


@query("SELECT event_id, event_type FROM events UNION ALL SELECT event_id, event_type FROM events")
def append_sink(spark, sf_dir):
    def twice(target, df, name):
        target.append(df, name)
        target.append(df, name)

    return _through(spark, table(spark, sf_dir, "events").select("event_id", "event_type"), "sondeo_append", twice)


@query("SELECT event_id, event_type FROM events")
def replace_sink(spark, sf_dir):
    def twice(target, df, name):
        target.replace(df.limit(5), name)
        target.replace(df, name)

    return _through(spark, table(spark, sf_dir, "events").select("event_id", "event_type"), "sondeo_replace", twice)


@query("SELECT event_id, value, json_extract_string(props, '$.k') AS metric_k FROM events")
def positional_concat(spark, sf_dir):
    """Expanded columns stand beside those of their own row: a projection, where frames would be joined by position."""
    item = F.concat(F.lit('[{"subQuestionId": "k", "answerValue": '), F.get_json_object("props", "$.k"), F.lit("}]"))
    rows = table(spark, sf_dir, "events").select("event_id", "value", item.alias("answers"))
    return answers.expand(rows, ids=["k"]).drop("answers")


@query("SELECT page_id, CASE WHEN contains(lower(f), 'bm') THEN 'BM' WHEN contains(lower(f), 'bv') THEN 'BV' ELSE 'error' END AS file_type FROM (SELECT page_id, CASE page_id % 4 WHEN 0 THEN 'submit_bv' WHEN 1 THEN 'AGOSTO_BV' WHEN 2 THEN 'agosto_bm_2025' ELSE url END AS f FROM pages)")
def route_file_type(spark, sf_dir):
    f = F.when(F.col("page_id") % 4 == 0, "submit_bv").when(F.col("page_id") % 4 == 1, "AGOSTO_BV").when(F.col("page_id") % 4 == 2, "agosto_bm_2025").otherwise(F.col("url"))
    return table(spark, sf_dir, "pages").select("page_id", F.coalesce(cleaning.kind_column(f), F.lit("error")).alias("file_type"))


@query("SELECT event_id, TIMESTAMP '2025-08-31 12:00:00' AS cleaned_date, 'BM' AS file_type, '2024-08' AS month_year FROM events")
def metadata_columns(spark, sf_dir):
    return cleaning.clean_bm(table(spark, sf_dir, "events").select("event_id"), RUN_TIME)


@query()
def sample_exact_n(spark, sf_dir):
    """100 events; SQL has no such hash, so tests check size, distinctness and repeatability."""
    return exact_sample(table(spark, sf_dir, "events"), "event_id", 100)


@query(
    """WITH t AS (SELECT count(*) AS n FROM events), w AS (SELECT unnest([0, 1, n // 3, n - 1, n, n + 7]) AS wanted, n FROM t)
    SELECT DISTINCT CAST(wanted AS BIGINT) AS wanted, CAST(least(wanted, n) AS BIGINT) AS taken, CAST(least(wanted, n) AS BIGINT) AS ids, CAST(0 AS BIGINT) AS elsewhere FROM w"""
)
def sample_sizes(spark, sf_dir):
    """Of events, samples of different sizes: each as large as wanted, without repetitions, all rows from the table."""
    e = table(spark, sf_dir, "events")
    n, parts = e.count(), []
    for wanted in sorted({0, 1, n // 3, n - 1, n, n + 7}):
        took = exact_sample(e, "event_id", wanted)
        counts = took.agg(F.count(F.lit(1)).alias("taken"), F.countDistinct("event_id").alias("ids"))
        parts.append(counts.select(F.lit(wanted).cast("long").alias("wanted"), "taken", "ids", F.lit(took.join(e, "event_id", "left_anti").count()).cast("long").alias("elsewhere")))
    return functools.reduce(DataFrame.union, parts)


@query("SELECT event_type AS value, CAST(ceil(count(*) / 2) AS BIGINT) AS n FROM events GROUP BY 1")
def sample_of_repeated_keys(spark, sf_dir):
    """Half of the rows of each type, by a key that is the same for all of them: which ones, rows and not keys decide."""
    e = table(spark, sf_dir, "events").select("event_type")
    counts = {r["value"]: r["n"] for r in profile.value_counts(e, "event_type").collect()}
    parts = [exact_sample(e.where(F.col("event_type") == k), "event_type", -(-n // 2)) for k, n in sorted(counts.items())]
    return profile.value_counts(functools.reduce(DataFrame.union, parts), "event_type")


@query(
    f"""WITH s AS (SELECT event_id, event_type, ts, floor(value / 10) AS x FROM events), t AS (SELECT *, {_CLIP.format("x")} AS nps_score FROM s)
    SELECT date_trunc('second', ts) AS timestamp, 'C' || event_id AS customer_id, event_type || 'ó' AS channel, CAST(CAST(x AS INTEGER) AS VARCHAR) AS nps_recomendacion_score, 'Está bien ' || event_type AS nps_recomendacion_motivo,
           CAST(nps_score AS DOUBLE) AS nps_score, {_CATEGORY.format("nps_score")} AS nps_category, TIMESTAMP '2025-08-31 12:00:00' AS cleaned_date, 'BM' AS file_type, strftime(ts, '%Y-%m') AS month_year FROM t"""
)
def bm_end_to_end(spark, sf_dir):
    """Raw packed answers with broken quotes and encoding, cleaned and cut to what a load keeps."""
    e = table(spark, sf_dir, "events")
    item = lambda q, v: F.concat(F.lit("{'subQuestionId': '"), F.lit(q), F.lit("', 'answerValue': "), v, F.lit("}"))
    listed = F.concat(F.lit("["), item("nps_rate_recomendation", F.floor(F.col("value") / 10).cast("string")), F.lit(", "), item("nps_text_recomendation", F.concat(F.lit("'EstÃ¡ bien "), "event_type", F.lit("'"))), F.lit(", "), item("other", F.lit("1")), F.lit("]"))
    raw = e.select(F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias("timestamp"), F.concat(F.lit("C"), F.col("event_id")).alias("customer_id"), F.concat("event_type", F.lit("Ã³")).alias("channel"), listed.alias("answers"))
    return runs.for_load(cleaning.clean_bm(raw, RUN_TIME), "BM")


@query(
    f"""WITH t AS (SELECT p.page_id, p.url, d.text, CAST({_CLIP.format("p.page_id % 14 - 2")} AS DOUBLE) AS nps_score FROM pages p JOIN documents d ON p.page_id = d.doc_id)
    SELECT TIMESTAMP '2025-08-01 10:00:00' AS date_submitted, 'Perú' AS country, split_part(trim(url), '?', 1) AS source_url, CAST(page_id % 14 - 2 AS VARCHAR) AS nps_score_bv, nps_score, {_CATEGORY.format("nps_score")} AS nps_category,
           TIMESTAMP '2025-08-31 12:00:00' AS cleaned_date, 'BV' AS file_type, '2025-08' AS month_year, regexp_replace(text, {_NOT_KEPT}, '', 'g') AS "¿Cuál es el motivo?" FROM t"""
)
def bv_end_to_end(spark, sf_dir):
    """Raw question columns, cleaned and cut to what a load keeps. The join only makes the input."""
    p, d = table(spark, sf_dir, "pages"), table(spark, sf_dir, "documents").select(F.col("doc_id").alias("page_id"), "text")
    raw = p.join(d, "page_id").select(F.col("page_id").alias("Number"), F.lit("8/1/2025 10:00").alias("Date Submitted"), F.lit("PerÃº").alias("Country"), F.col("url").alias("Source URL"), (F.col("page_id") % 14 - 2).cast("string").alias("¿Qué tan probable es que nos recomiendes?"), F.col("text").alias("¿Cuál es el motivo?"))
    return runs.for_load(cleaning.clean_bv(raw, RUN_TIME), "BV")


@query("SELECT o_orderdate FROM orders")
def key_columns(spark, sf_dir):
    """Columns whose names have a key part; here the date."""
    orders = table(spark, sf_dir, "orders")
    return c.keep(orders, c.with_any(orders.columns, runs.KEY_PARTS))


@query(f"SELECT event_type AS channel, round(avg(score), 6) AS avg_nps, count(*) AS total, count(CASE WHEN score >= 9 THEN 1 END) AS promoters, count(CASE WHEN score <= 6 THEN 1 END) AS detractors FROM ({_SCORED}) GROUP BY 1")
def smoke_load(spark, sf_dir):
    """Responses written to a table, read back from it and scored."""
    name = f"sondeo_smoke_{uuid.uuid4().hex}"
    _made.append((spark, name))
    return runs.smoke_load(spark, Warehouse(spark), name, RUN_TIME, _responses(spark, sf_dir).drop("ts"))


@query("""SELECT event_id, '[{"a": "Ã‰xito ó", "n": ' || event_id || '}]' AS cleaned_text, event_id % 2 = 0 AS parsed FROM events WHERE event_id % 2 = 0
    UNION ALL SELECT event_id, '["a": "' || event_type || '"]', false FROM events WHERE event_id % 2 = 1""")
def simple_cleaning(spark, sf_dir):
    even = F.col("event_id") % 2 == 0
    raw = F.when(even, F.concat(F.lit("[{'a': 'Ã‰xito Ã³', 'n': "), F.col("event_id"), F.lit("}]"))).otherwise(F.concat(F.lit("['a': 'Â"), F.col("event_type"), F.lit("']")))
    return cleaning.simple_answers(table(spark, sf_dir, "events").select("event_id", raw.alias("answers"))).drop("answers")


@query("SELECT count(*) AS rows, count(CASE WHEN event_id % 3 = 0 THEN 1 END) * 2 + count(CASE WHEN event_id % 4 = 1 THEN 1 END) AS encoding_fixed, count(CASE WHEN event_id % 4 = 1 THEN 1 END) AS json_fixed, count(CASE WHEN event_id % 4 = 2 THEN 1 END) AS json_corrupted, 1 AS timezone_fixed FROM events")
def run_counters(spark, sf_dir):
    """What a cleaning run counts, over raw rows with broken texts, lists and one date column with offsets."""
    k = F.col("event_id") % 4
    listed = F.when(k == 0, "[]").when(k == 1, "[{'a': 'Ã³ y Ã³'}]").when(k == 2, "['k']x")
    raw = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 3 == 0, "Â¿QuÃ©?").otherwise("plain").alias("channel"), listed.alias("answers"), F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias("timestamp"), F.lit("2025-08-01").alias("answerDate"))
    return raw.agg(*runs.metrics_of(raw))


@query("SELECT event_id, CAST(NULL AS VARCHAR) AS none, CAST(event_id AS VARCHAR) AS last FROM events")
def answers_of_other_shapes(spark, sf_dir):
    """An object is no list of answers; of two answers to a question the last one counts, and items that are no objects are left out."""
    e = table(spark, sf_dir, "events").select("event_id")
    item = lambda v: F.concat(F.lit('{"subQuestionId": "k", "answerValue": '), v, F.lit("}"))
    listed = F.concat(F.lit("[1, "), item(F.lit("0")), F.lit(', "x", '), item(F.col("event_id").cast("string")), F.lit("]"))
    return e.select("event_id", answers.answer(answers.items(item(F.lit("1"))), "k").alias("none"), answers.answer(answers.items(listed), "k").alias("last"))


@query(
    """SELECT event_id, CASE event_id % 10 WHEN 0 THEN 'True' WHEN 1 THEN 'true' WHEN 2 THEN '100.0' WHEN 3 THEN '1e2' WHEN 4 THEN 'None' WHEN 5 THEN 'null' WHEN 6 THEN (1000 + event_id) || '.5' WHEN 7 THEN CAST(10000000 + event_id AS VARCHAR) || '.25'
    WHEN 8 THEN '1e+20' ELSE CAST(event_id AS VARCHAR) END AS value FROM events"""
)
def answer_types(spark, sf_dir):
    """Answers of different JSON types that read alike."""
    e, k = F.col("event_id"), F.col("event_id") % 10
    text = F.when(k == 0, "true").when(k == 1, '"true"').when(k == 2, "1e2").when(k == 3, '"1e2"').when(k == 4, "null").when(k == 5, '"null"').when(k == 6, F.concat(1000 + e, F.lit(".50"))).when(k == 7, F.concat(10000000 + e, F.lit(".25"))).when(k == 8, "1e20").otherwise(e.cast("string"))
    item = F.concat(F.lit('[{"subQuestionId": "k", "answerValue": '), text, F.lit("}]"))
    return table(spark, sf_dir, "events").select("event_id", answers.answer(answers.items(item), "k").alias("value"))


@query("SELECT 'banco_movil_clean' AS name, count(*) AS n, count(CASE WHEN event_id % 2 = 0 THEN 1 END) AS named FROM events")
def placeholders_to_null(spark, sf_dir):
    """What a load keeps: placeholders of missing values are nulls, rows all of nulls go."""
    raw = table(spark, sf_dir, "events").select(F.when(F.col("event_id") % 2 == 0, "web").otherwise("nan").alias("channel"), F.lit("x").alias("not kept"))
    kept = runs.for_load(raw, "BM")
    return kept.agg(F.lit(runs.BM_TABLE).alias("name"), F.count(F.lit(1)).alias("n"), F.count("channel").alias("named")) if kept.columns == ["channel"] else kept


def _folder(spark: SparkSession, what: str) -> str:
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/sondeo_{what}_{uuid.uuid4().hex}"
    _made.append((spark, path))
    return path


@query(
    """WITH f AS (SELECT event_id, 'file_' || event_id % 2 || '_bm_LIMPIO' AS file, event_id % 3 AS k FROM events)
    SELECT file AS item, CAST(count(*) AS BIGINT) AS n FROM f GROUP BY 1 UNION ALL SELECT 'agosto_bv_LIMPIO', count(*) FROM pages UNION ALL SELECT 'bm_processed', count(*) FROM f UNION ALL SELECT 'bv_processed', count(*) FROM pages
    UNION ALL SELECT 'encoding_fixed', count(CASE WHEN k = 1 THEN 1 END) + (SELECT count(*) FROM pages) FROM f UNION ALL SELECT 'json_fixed', count(CASE WHEN k = 0 THEN 1 END) FROM f UNION ALL SELECT 'json_corrupted', count(CASE WHEN k = 2 THEN 1 END) FROM f
    UNION ALL SELECT 'timezone_fixed', 2 UNION ALL SELECT 'errors', 1
    UNION ALL SELECT 'sum of scores', CAST(sum(CASE WHEN event_id % 2 = 0 AND k = 0 THEN event_id % 11 WHEN event_id % 2 = 1 THEN 3 END) AS BIGINT) FROM f"""
)
def clean_run(spark, sf_dir):
    """Two BM files and a BV file cleaned together, a third name of neither kind: rows by file and what was counted. In the second BM file no row answers the question, so the raw column makes its scores."""
    root, e = _folder(spark, "clean"), F.col("event_id")
    answered = F.concat(F.lit("[{'subQuestionId': 'nps_rate_recomendation', 'answerValue': "), (e % 11).cast("string"), F.lit("}]"))
    other = F.lit("[{'subQuestionId': 'x', 'answerValue': 1}]")
    raw = table(spark, sf_dir, "events").select("event_id", F.concat(F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss"), F.lit("-05:00")).alias("timestamp"), F.when(e % 3 == 1, F.lit("Ã³")).otherwise("web").alias("channel"), F.lit("3").alias("nps_score_original"), F.when(e % 3 == 0, F.when(e % 2 == 0, answered).otherwise(other)).when(e % 3 == 1, "[]").otherwise("['k']x").alias("answers"))
    for i in (0, 1):
        raw.where(e % 2 == i).drop("event_id").write.parquet(f"{root}/in/file_{i}_bm.parquet")
    table(spark, sf_dir, "pages").select(F.lit("PerÃº").alias("Country"), F.col("url").alias("Source URL")).write.parquet(f"{root}/in/agosto_bv.parquet")
    raw.limit(1).write.parquet(f"{root}/in/neither.parquet")
    counters, written = together.clean_together(spark, f"{root}/in/*.parquet", f"{root}/out", RUN_TIME)
    cleaned = spark.read.option("mergeSchema", "true").parquet(f"{root}/out")
    parts = [
        cleaned.where(F.col("file").isin([w.rpartition("=")[2] for w in written])).groupBy(F.col("file").alias("item")).agg(F.count(F.lit(1)).alias("n")),
        spark.createDataFrame([(k, v) for k, v in vars(counters).items()], "item string, n long"),
        cleaned.agg(F.sum("nps_score").cast("long").alias("n")).select(F.lit("sum of scores").alias("item"), "n"),
    ]
    return functools.reduce(DataFrame.union, parts)


@query("SELECT 'agosto_bm_muestra_' || (count(*) // 4) AS name, CAST(count(*) // 4 AS BIGINT) AS n, CAST(count(*) // 4 AS BIGINT) AS ids FROM events UNION ALL SELECT 'agosto_bm_muestra_' || count(*), count(*), count(*) FROM events")
def extract_run(spark, sf_dir):
    """A quarter of the events, and more than there are, as samples whose names tell their sizes."""
    e, root = table(spark, sf_dir, "events"), _folder(spark, "extract")
    n = e.count()
    made = [runs.extract_sample(e, "event_id", "agosto_bm", root, k) for k in (n // 4, n + 5)]
    parts = [spark.read.parquet(m).agg(F.lit(m.rpartition("/")[2]).alias("name"), F.count(F.lit(1)).alias("n"), F.countDistinct("event_id").alias("ids")) for m in made]
    return parts[0].union(parts[1])


@query(
    f"""WITH t AS (SELECT *, {_CATEGORY.format("score")} AS category FROM ({_SCORED}))
    SELECT format('{{:,}}', count(*)) || ' rows, 4 columns' AS line FROM t UNION ALL SELECT 'nps_score: ' || format('{{:,}}', count(score)) || ' values, mean ' || printf('%.2f', avg(score)) || ', from ' || printf('%.1f', CAST(min(score) AS DOUBLE)) || ' to ' || printf('%.1f', CAST(max(score) AS DOUBLE)) FROM t
    UNION ALL SELECT 'categories: ' || string_agg(category || ' ' || format('{{:,}}', n), ', ' ORDER BY n DESC, category) FROM (SELECT category, count(*) AS n FROM t GROUP BY 1)
    UNION ALL SELECT 'top_device: ' || string_agg(event_type || ' ' || format('{{:,}}', n), ', ' ORDER BY n DESC, event_type) FROM (SELECT event_type, count(*) AS n FROM t GROUP BY 1 ORDER BY n DESC, 1 LIMIT 3)
    UNION ALL SELECT 'dates: ' || strftime(min(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') || ' to ' || strftime(max(date_trunc('second', ts)), '%Y-%m-%d %H:%M:%S') FROM t"""
)
def describe_report(spark, sf_dir):
    """The profile of scored responses, as the lines that a run logs."""
    rows = _responses(spark, sf_dir).select("nps_score", scores.categorize(F.col("nps_score")).alias("nps_category"), F.col("channel").alias("device"), F.date_trunc("second", "ts").cast("timestamp_ntz").alias("date_submitted"))
    return spark.createDataFrame([(x,) for x in runs.report(runs.describe(rows))], "line string")


@query("SELECT event_id, event_type AS channel, CAST(score AS DOUBLE) AS nps_score, only_in FROM (SELECT event_id, event_type, score, 'source' AS only_in FROM (" + _SCORED + ") WHERE event_id % 500 IN (3, 7) UNION ALL SELECT event_id, event_type, 11 - score, 'table' FROM (" + _SCORED + ") WHERE event_id % 500 = 7 AND score IS NOT NULL) WHERE event_id % 500 = 3 OR score <> 5.5")
def reconcile_rows(spark, sf_dir):
    """A table that lacks some rows and has other scores in some: both are named, from their groups only."""
    rows = _responses(spark, sf_dir).select("event_id", "channel", "nps_score").withColumn("part", (F.col("event_id") % 50).cast("string")).where("nps_score is not null or event_id % 500 != 7")
    name = f"sondeo_reconcile_{uuid.uuid4().hex}"
    _made.append((spark, name))
    target = Warehouse(spark)
    target.replace(rows.where("event_id % 500 != 3").withColumn("nps_score", F.when(F.col("event_id") % 500 == 7, 11 - F.col("nps_score")).otherwise(F.col("nps_score"))), name)
    return reconcile.differing_rows(rows, target, name, ["part"]).drop("part")


@query("SELECT event_id AS whole, value AS number, CASE WHEN event_id % 5 = 0 THEN 'x' ELSE CAST(event_id AS VARCHAR) END AS mixed, CAST(NULL AS VARCHAR) AS empty FROM events")
def retype_numbers(spark, sf_dir):
    """Text columns of which all texts are whole numbers, all are numbers, some are none, none is there."""
    e = table(spark, sf_dir, "events")
    raw = e.select(F.col("event_id").cast("string").alias("whole"), F.col("value").cast("string").alias("number"), F.when(F.col("event_id") % 5 == 0, "x").otherwise(F.col("event_id").cast("string")).alias("mixed"), F.lit(None).cast("string").alias("empty"))
    return c.retype_numbers(raw)


@query("SELECT CAST(event_id AS VARCHAR) AS event_id, event_type, CAST(event_id % 11 AS VARCHAR) AS score, CASE WHEN event_id % 3 = 0 THEN NULL ELSE '<' || props || '>' END AS answers FROM events")
def workbook_round_trip(spark, sf_dir):
    """Written as a folder of workbooks, one a task, and read back as text."""
    path = f"{spark.conf.get('spark.sql.warehouse.dir')}/sondeo_books_{uuid.uuid4().hex}"
    _made.append((spark, path))
    workbooks.register(spark)
    rows = table(spark, sf_dir, "events").select("event_id", "event_type", (F.col("event_id") % 11).alias("score"), F.when(F.col("event_id") % 3 != 0, F.concat(F.lit("<"), "props", F.lit(">"))).alias("answers"))
    rows.write.format(workbooks.NAME).option("each", "task").mode("append").save(path)
    return spark.read.format(workbooks.NAME).load(path)


@query(
    """SELECT 'banco_movil_clean' AS name, step, CAST(k * (SELECT count(*) FROM events) AS BIGINT) AS n, true AS sums_agree FROM (VALUES ('first', 1), ('again', 1), ('second', 2)) s(step, k)
    UNION ALL SELECT 'banco_virtual_clean', step, CASE WHEN step = 'second' THEN (SELECT count(*) FROM pages WHERE page_id % 2 = 0) ELSE (SELECT count(*) FROM pages) END, true FROM (VALUES ('first'), ('again'), ('second')) s(step)"""
)
def load_once(spark, sf_dir):
    """Two runs, the first of them started twice: what each leaves in both tables, and whether checksums of what is read are those of what was written."""
    root = f"{spark.conf.get('spark.sql.warehouse.dir')}/sondeo_runs_{uuid.uuid4().hex}"
    _made.append((spark, root))
    target, out = RunFolders(spark, root), []
    bm = table(spark, sf_dir, "events").select(F.col("event_type").alias("channel"), F.col("ts").alias("timestamp"), F.lit("BM").alias("file_type"))
    bv = table(spark, sf_dir, "pages").select(F.col("url").alias("source_url"), "page_id")
    for step, run_id, pages in (("first", "august", bv), ("again", "august", bv.limit(1)), ("second", "september", bv.where("page_id % 2 = 0"))):
        counts = runs.load_once(bm, pages.drop("page_id"), target, run_id)
        written = {name: (rows, total) for name, rows, total in target.runs()[run_id]}
        for name, n in counts.items():
            newest = spark.read.parquet(target.folders(name)[-1])
            found = newest.agg(F.count(F.lit(1)), checksum(newest)).head()
            out.append((name, step, n, tuple(found) == written[name]))
    return spark.createDataFrame(out, "name string, step string, n long, sums_agree boolean")


@query("SELECT event_type AS channel, count(*) AS n FROM events GROUP BY 1")
def sql_to_frame(spark, sf_dir):
    """A SQL query through a target."""
    name = f"sondeo_sql_{uuid.uuid4().hex}"
    target = Warehouse(spark, partition_by=("channel",))
    target.replace(table(spark, sf_dir, "events").select("event_id", F.col("event_type").alias("channel")), name)
    _made.append((spark, name))
    return target.query(f"SELECT channel, count(*) AS n FROM {name} GROUP BY channel")


@query(f"SELECT 'BM' AS kind, least(3, count(score)) AS n, true AS scored, 0 AS elsewhere FROM ({_SCORED}) UNION ALL SELECT 'BV', least(3, count(score)), true, 0 FROM ({_SCORED}) WHERE score > 8")
def verify_rows(spark, sf_dir):
    """A few scored rows of both loaded tables, counted, and how many of them the tables don't hold: which ones they are is not fixed."""
    rows = _responses(spark, sf_dir)
    parts = []
    for kind, own, cols in (("BM", rows, ("nps_score", "channel")), ("BV", rows.where("nps_score > 8"), ("nps_score",))):
        there = own.select(*cols).distinct().withColumn("there", F.lit(True))
        shown = runs.scored_rows(own, cols).join(there, list(cols), "left")
        parts.append(shown.agg(F.lit(kind).alias("kind"), F.count(F.lit(1)).alias("n"), F.coalesce(F.bool_and(F.col("nps_score").isNotNull()), F.lit(True)).alias("scored"), F.count(F.when(F.col("there").isNull(), 1)).cast("int").alias("elsewhere")))
    return parts[0].union(parts[1])


def queries() -> dict[str, Query]:
    return dict(QUERIES)


def oracle_sql() -> dict[str, str]:
    return dict(SQL)
