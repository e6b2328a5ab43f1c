"""Cleaning of the two kinds of survey exports: packed answers (BM) and one column per question (BV)."""

from __future__ import annotations

import datetime
from collections.abc import Callable, Iterable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import answers, dates, jsonrepair, scores, text
from ..functions.encoding import PLAIN_RULES, fix_encoding
from ..operators import columns as c

# Names of columns and what marks them.
BM_DATES = ("timestamp", "answerDate")
BV_DATE, BV_DATE_KEPT = "Date Submitted", "date_submitted_original"
SCORE_PARTS, FEEDBACK_PARTS, URL_PARTS = ("recomien", "probable"), ("motiv", "calific"), ("url",)
BV_DROPPED = ("Number", "User", "Hotjar User ID", "Response URL")
BV_RENAMED = {"Country": "country", "Device": "device", "Browser": "browser", "OS": "operating_system", "Source URL": "source_url"}
DEFAULT_MONTH = "2024-08"
#: Kinds of files, as they are looked for in names.
KINDS = ("BM", "BV")


def kind_of(file_name: str) -> str:
    """BM or BV by the name of a file; BM is looked for first."""
    name = file_name.lower()
    for kind in KINDS:
        if kind.lower() in name:
            return kind
    raise ValueError(f"neither bm nor bv in {file_name!r}")


def kind_column(file_name: Column) -> Column:
    """kind_of() by row; null where it raises."""
    name = F.lower(file_name)
    return F.coalesce(*(F.when(F.contains(name, F.lit(k.lower())), k) for k in KINDS))


def _scored(df: DataFrame, name: str) -> DataFrame:
    df = df.withColumn("nps_score", scores.score(c.col(name)))
    return df.withColumn("nps_category", scores.categorize(F.col("nps_score")))


Formats = dict[str, tuple[str, ...]]


def _dated(df: DataFrame, names: Iterable[str], formats: Formats | None, to: Callable[[str], str] = lambda n: n) -> DataFrame:
    """Dates of the columns that are there, each column read in one order of day and month: in the given formats, or in those that dates.column_formats() finds."""
    own = [n for n in names if n in df.columns]
    found = dates.column_formats(df, own) if formats is None else formats
    return df.withColumns({to(n): dates.to_wall_clock(c.col(n), found.get(n, dates.FORMATS)) for n in own})


def clean_bm(df: DataFrame, run_time: datetime.datetime, questions: list[str] | None = None, formats: Formats | None = None, parsed: str | None = None, answered: Column | None = None) -> DataFrame:
    """Packed answers: text repaired, answers expanded, dates read, score and category, metadata.

    The score is that of the answers if any row answered that question, else the raw column's, for all rows alike.
    One projection. Finding the questions and the formats of dates, unless they are given, takes two small jobs over rows
    that are parsed and written down once; see answers.expand(), and for parsed. answered: where rows of several files are
    one table, whether in a row's file any row answered the question.
    """
    df = c.map_columns(df, [n for n in c.text_columns(df) if n != "answers"], fix_encoding)
    if "answers" in df.columns:
        df = answers.expand(df, "answers", questions, parsed)
    df = _dated(df, BM_DATES, formats)
    scored = next((n for n in ("nps_recomendacion_score", "nps_score_original") if n in df.columns), None)
    if answered is not None and {"nps_recomendacion_score", "nps_score_original"} <= set(df.columns):
        df = df.withColumn("nps_score", F.when(answered, scores.score(F.col("nps_recomendacion_score"))).otherwise(scores.score(F.col("nps_score_original"))))
        df = df.withColumn("nps_category", scores.categorize(F.col("nps_score")))
    elif scored:
        df = _scored(df, scored)
    month = dates.month_year(F.col("timestamp")) if "timestamp" in df.columns else F.lit(DEFAULT_MONTH)
    return df.withColumns({"cleaned_date": F.lit(run_time).cast("timestamp_ntz"), "file_type": F.lit("BM"), "month_year": month})


def clean_bv(df: DataFrame, run_time: datetime.datetime, formats: Formats | None = None, submitted: Column | None = None) -> DataFrame:
    """One column per question. The score is read before free text is cleaned, so its column may be both. Unless formats are given, or the dates themselves as submitted, one aggregate finds those of a date column that is text."""
    df = c.map_columns(df, c.text_columns(df), fix_encoding)
    if BV_DATE in df.columns:
        df = _dated(df, [BV_DATE], formats, lambda _: "date_submitted") if submitted is None else df.withColumn("date_submitted", submitted)
        df = df.withColumn("month_year", dates.month_year(F.col("date_submitted")))
    scored = c.first_with_all(df.columns, SCORE_PARTS)
    if scored:
        df = _scored(df, scored)
    df = c.map_columns(df, c.with_any(df.columns, URL_PARTS), lambda x: text.clean_url(x.cast("string")))
    df = c.map_columns(df, c.with_any(df.columns, FEEDBACK_PARTS), lambda x: text.clean_feedback(x.cast("string")))
    df = df.drop(*BV_DROPPED)
    if scored and scored in df.columns:
        df = c.rename(df, {scored: "nps_score_bv", BV_DATE: BV_DATE_KEPT})
    df = c.rename(df, BV_RENAMED)
    return df.withColumns({"cleaned_date": F.lit(run_time).cast("timestamp_ntz"), "file_type": F.lit("BV")})


def simple_answers(df: DataFrame, text_col: str = "answers") -> DataFrame:
    """df with cleaned_text and parsed: the reduced cleaning, without a rule for a bare U+00C3, in which every single quote becomes a double one.

    parsed tells whether the outcome is JSON; a text that is not stays as it is and counts for nothing.
    """
    cleaned = jsonrepair.swap_quotes(fix_encoding(c.col(text_col), PLAIN_RULES))
    df = df.withColumn("cleaned_text", cleaned)
    return df.withColumn("parsed", jsonrepair.is_json(F.col("cleaned_text")))


@dataclass
class Counters:
    """What a cleaning run did."""

    bm_processed: int = 0
    bv_processed: int = 0
    encoding_fixed: int = 0
    json_fixed: int = 0
    json_corrupted: int = 0
    timezone_fixed: int = 0
    errors: int = 0

    def lines(self) -> list[str]:
        """A run's summary for a log."""
        verdict = "valid: ready to load" if self.errors == 0 else "see to the errors before loading"
        return [f"BM rows cleaned: {self.bm_processed:,}", f"BV rows cleaned: {self.bv_processed:,}", f"rows: {self.bm_processed + self.bv_processed:,}", f"encoding repaired: {self.encoding_fixed:,}", f"answers repaired: {self.json_fixed:,}", f"answers beyond repair: {self.json_corrupted:,}", f"date columns freed of offsets: {self.timezone_fixed:,}", f"errors: {self.errors:,}", verdict]


def clean_file(df: DataFrame, file_name: str, run_time: datetime.datetime) -> DataFrame:
    return {"BM": clean_bm, "BV": clean_bv}[kind_of(file_name)](df, run_time)
